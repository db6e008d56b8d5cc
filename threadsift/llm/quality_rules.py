"""Quality rules with risk-controlled thresholds.

Counts of whole texts (words, signs, repeated lines, repeated windows) come
from DataFrame functions alone, row by row. Two fixed limits give the base
verdict. Beyond them each rule compares one share of a text with a cutoff
that is learned per stratum: labelled good rows are the holdout, a cutoff is
tested by the exact binomial tail of its false rejections (of ``n`` good rows
``k`` would go), and the strictest cutoff is taken whose bound stays under
``RISK``. All cutoffs of all rules and strata share the error ``DELTA``
(Bonferroni), so with probability ``1 - DELTA`` none of the chosen ones rejects
more than its part of ``RISK``; a stratum's rules together reject at most
``RISK`` of its good rows. A stratum with too few labels gets no cutoff, and
keeps what passes the base limits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.tables import checkpoint, temporary_name

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3

RISK = 0.02
DELTA = 0.05
CUTOFFS = 20  # per rule
TAIL_TERMS = 5_000  # terms of the binomial tail that are added one by one

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """A text is rejected when its ``count`` per word exceeds the cutoff."""

    name: str
    count: str
    largest: float

    def share(self, counts: str) -> Column:
        return F.try_divide(F.col(f"{counts}.{self.count}"), F.col(f"{counts}.n_words"))

    def cutoffs(self) -> list[float]:
        return [self.largest * (i + 1) / CUTOFFS for i in range(CUTOFFS)]


RULES = (
    Rule("signs", "n_symbols", 2.0),
    Rule("repeated_lines", "n_dup_lines", 0.2),
    Rule("repeated_windows", "n_repeat_words", 0.5),
    Rule("long_words", "word_chars", 20.0),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Number of words inside a window of words that occurs twice or more in the array.

    Every window becomes one number: its hash, shifted up, and its position.
    Sorted, equal windows are neighbours. The position takes only the bits it
    needs, and neighbours are compared by the complete 64-bit hash.
    """

    def marked(w: Column) -> Column:
        n = F.size(w) - (window - 1)
        bits = F.length(F.bin(F.size(w)))
        hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(window))))
        return let(hashes, lambda h: let(bits, lambda b: repeated(h, b, n)))

    def repeated(h: Column, b: Column, n: Column) -> Column:
        packed = F.transform(h, lambda x, i: F.call_function("shiftleft", x, b).bitwiseOR(i.cast("bigint")))
        at = lambda s, i: F.pmod(F.get(s, i), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).cast("int")
        positions = let(F.sort_array(packed), lambda s: F.transform(s, lambda x, i: F.struct(
            at(s, i).alias("p"),
            (_equal(h, at(s, i), at(s, i - 1), i > 0) | _equal(h, at(s, i), at(s, i + 1), i < n - 1)).alias("again"))))
        starts = F.sort_array(F.transform(F.filter(positions, lambda q: q["again"]), lambda q: q["p"]))
        return _covered(starts, window)

    def _equal(h: Column, p: Column, q: Column, exists: Column) -> Column:
        return F.when(exists, F.get(h, p) == F.get(h, q)).otherwise(F.lit(False))

    return F.when(F.size(words) >= window + 1, let(words, marked)).otherwise(F.lit(0).cast("bigint"))


def _covered(starts: Column, window: int) -> Column:
    """Number of positions in ``[s, s + window)`` of any of the sorted starts."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(starts, zero, lambda a, s: F.struct(
        (a["n"] + s + window - F.greatest(a["reach"], s)).alias("n"), (s + window).alias("reach")), lambda a: a["n"])


def counts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): struct of the counts and ``base_failed``.

    A null text has no words; texts without words fail the base limits.
    """
    name, words, text = (temporary_name(docs, n) for n in ("counts", "words_of", "text_of"))
    base = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    # split, without the empty pieces of blank ends
    base = base.withColumn(words, F.filter(F.split(text, SPACES), lambda w: w != ""))
    n_words = F.size(words).cast("bigint")
    chars = F.aggregate(words, F.lit(0).cast("bigint"), lambda a, w: a + F.length(w))
    lines = F.when(F.contains(F.col(text), F.lit("\n")), let(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
        lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))
    out = base.withColumn(name, F.struct(
        n_words.alias("n_words"), chars.alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        lines.alias("n_dup_lines"), repeat_words(F.col(words)).alias("n_repeat_words")))
    failed = (F.col(f"{name}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{name}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{name}.n_words"))
    return out.withColumn(name, F.struct(f"{name}.*", failed.alias("base_failed"))).drop(words, text), name


def log_factorial(n: Column) -> Column:
    """ln(n!) for n >= 0 (Stirling's series from n + 10 on, stepped down)."""
    x = n + F.lit(10.0)
    steps = F.log(n + 1)
    for j in range(2, 11):
        steps = steps + F.log(n + j)
    series = (x + 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    return series - steps


def binomial_tail(n: Column, k: Column, risk: Column) -> Column:
    """P(X <= k) for X ~ Binomial(n, risk), exact up to rounding, never too small.

    The largest term is that of ``k`` (for ``k`` below ``n * risk``; above it the
    tail is no evidence, and 1 is returned). Smaller terms follow by their
    ratio; what ``TAIL_TERMS`` leave out is bounded by a geometric series.
    """
    n, k = n.cast("double"), k.cast("double")
    first = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(risk) + (n - k) * F.log(1 - risk))
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term"))
    odds = (1 - risk) / risk
    total = F.aggregate(F.sequence(F.lit(0), F.least(k, F.lit(TAIL_TERMS - 1)).cast("int")), zero, lambda a, i: F.struct(
        (a["sum"] + a["term"]).alias("sum"), (a["term"] * (k - i) / (n - k + i + 1) * odds).alias("term")))
    ratio = F.greatest(F.lit(0.0), (k - TAIL_TERMS) / (n - k + TAIL_TERMS + 1) * odds)
    rest = F.when(k >= TAIL_TERMS, total["term"] / (1 - F.least(ratio, F.lit(0.999999)))).otherwise(F.lit(0.0))
    return F.when(k >= n * risk, F.lit(1.0)).otherwise(F.least(F.lit(1.0), first * (total["sum"] + rest)))


def learn_cutoffs(good: DataFrame, rules=RULES, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) from good rows (stratum, counts struct ``counts``) that pass the base limits.

    One pass counts the good rows per stratum, rule and cutoff step; the tests
    run on that small table. Cutoffs of a rule are taken from the loosest on:
    the strictest one is chosen up to which all pass.
    """
    scope = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.least(F.lit(CUTOFFS + 1), F.ceil(
            r.share("counts") / (r.largest / CUTOFFS))).cast("int").alias("step")) for r in rules])).alias("r")
    # a row of step s exceeds the cutoffs of steps 1 .. s-1
    steps = good.select("stratum", scope).groupBy("stratum", "r.rule", "r.step").agg(F.count("*").alias("rows"))
    every = steps.select("stratum", "rule").distinct().select(
        "stratum", "rule", F.explode(F.sequence(F.lit(0), F.lit(CUTOFFS + 1))).alias("step"), F.lit(0).cast("bigint").alias("rows"))
    steps = steps.unionByName(every).groupBy("stratum", "rule", "step").agg(F.sum("rows").alias("rows"))
    whole = Window.partitionBy("stratum", "rule")
    above = whole.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    tests = steps.select("stratum", "rule", "step", F.sum("rows").over(whole).alias("n"),
                         F.coalesce(F.sum("rows").over(above), F.lit(0)).alias("k")).where(
        F.col("step").between(1, CUTOFFS))
    strata = F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(1))))
    tests = tests.withColumn("p", binomial_tail(F.col("n"), F.col("k"), F.lit(risk / len(rules))))
    tests = tests.withColumn("passed", F.col("p") <= F.lit(delta) / (strata * len(rules) * CUTOFFS))
    looser = whole.orderBy(F.desc("step"))
    chosen = tests.withColumn("all_passed", F.min(F.col("passed").cast("int")).over(looser)).where("all_passed = 1")
    largest = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.largest / CUTOFFS))])
    return chosen.groupBy("stratum", "rule").agg(F.min("step").alias("step")).select(
        "stratum", "rule", (F.col("step") * largest[F.col("rule")]).alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", stratum_col: str = "lang",
          label_col: str = "quality", rules=RULES, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: id, counts, ``base_failed`` and ``kept``.

    The holdout are the documents whose label is 1 (of several labels of an id
    the smallest counts; each row of a repeated id counts). A null stratum counts as
    the empty one.
    """
    counted, name = counts(docs, text_col)
    rows = checkpoint(counted.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                                     F.col(name).alias("counts")))
    label = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    good = rows.where("not counts.base_failed").join(label.where("label = 1").select("id"), "id", "left_semi")
    cutoffs = learn_cutoffs(good, rules, risk, delta)
    table = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    judged = rows.join(table, "stratum", "left")
    rejected = F.lit(False)
    for r in rules:
        rejected = rejected | F.coalesce(r.share("counts") > F.col("cutoffs")[r.name], F.lit(False))
    return judged.select(F.col("id").alias(id_col), "counts.*",
                         F.when(F.col("counts.base_failed"), F.lit(False)).otherwise(~rejected).alias("kept"))
