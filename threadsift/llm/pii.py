"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Method. High-recall generators propose spans, which may overlap: anything with
an at sign, dotted numbers, digit chains, dialled numbers, long mixed tokens.
Boosted trees score each proposal by its format (length, digits, separators,
check digits) and its context (the signs beside it, cue words before it). A
threshold per kind, calibrated on the proposals of all documents kept apart from the fit, selects the
spans whose precision reaches ``PRECISION``. Spans found by the four base rules
always stay; assigned secrets and selected proposals are added.

The corpus has no labelled spans. The trees learn from weak labels: a
proposal of the base kinds is right if it is a span of the base rules, a
``secret`` if an assignment to a key word comes before it. The fit reads a
bounded sample of documents; the trees are then written out as column
expressions, so all of the main path is DataFrame functions on the row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.quality_rules import let
from threadsift.llm.tables import checkpoint, temporary_name

BASE_KINDS = ("email", "ip", "card", "phone")

#: The base rules. A match begins at a maximal run (or where the last match ended), so that no
#: start inside a run is tried again; the spans are those of the plain patterns.
BASE_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[0-9]|[\x20-][0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have before a pattern is tried on it.
BASE_GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

PROPOSAL_PATTERNS = {
    "email": r"[^\s@]{1,64}@[^\s@]{1,128}",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,5}",
    "card": r"[0-9](?:[0-9]|[\x20-][0-9]){11,}+",
    "phone": r"(?:\+[0-9]|(?<![0-9])\(?[0-9])[\x20().0-9-]{5,}[0-9]",
    "secret": r"(?<![A-Za-z0-9_/+=-])(?=[A-Za-z_/+=-]*[0-9])[A-Za-z0-9_/+=-]{16,}+",
}
PROPOSAL_GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"[0-9]",
                   "secret": r"[0-9]"}
CUES = {
    "email": r"(?i)(mail|contact|write)",
    "ip": r"(?i)(ip|host|server|addr)",
    "card": r"(?i)(card|visa|master|credit|account|iban)",
    "phone": r"(?i)(phone|tel|call|fax|mobile|sms)",
    "secret": r"(?i)(token|key|secret|passw|pwd|auth|credential)",
}
_ASSIGNED = r"(?i)(token|key|secret|passw(or)?d|pwd|auth|credential)s?[\"']?\s*[:=]\s*[\"']?$"

CONTEXT = 24
MAX_DOCUMENTS = 20_000
MAX_PROPOSALS = 20_000
PRECISION = 0.95
TREES, DEPTH = 10, 3

FEATURES = ("kind", "length", "digits", "letters", "others", "distinct", "groups", "plus", "parts_over_255", "check_digit",
            "before", "after", "cue", "assigned", "domain_dot")


def _prefix_sums(lengths: Column, step: int = 256) -> Column:
    """Sums of the elements before each element, in time n times the square root of n."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def summed(x: Column) -> Column:
        groups = F.transform(F.sequence(F.lit(0), F.floor(F.size(x) / step).cast("int")),
                             lambda g: total(F.slice(x, g * step + 1, F.lit(step))))
        starts = let(groups, lambda s: F.transform(s, lambda _, g: total(F.slice(s, F.lit(1), g))))
        return let(starts, lambda s: F.transform(x, lambda _, i: F.get(s, F.floor(i / step).cast("int")) + total(
            F.slice(x, F.floor(i / step).cast("int") * step + 1, i % step))))

    return let(lengths, summed)


def spans(text: Column, pattern: str, guard: str) -> Column:
    """Array of (start, end, value, before, after) of the matches; code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def located(pieces: Column, values: Column) -> Column:
        lengths = F.transform(values, lambda v, i: F.length(F.get(pieces, i)) + F.length(v))
        return let(_prefix_sums(lengths), lambda sums: F.transform(values, lambda v, i: F.struct(
            (F.get(sums, i) + F.length(F.get(pieces, i))).alias("start"),
            (F.get(sums, i) + F.length(F.get(pieces, i)) + F.length(v)).alias("end"),
            v.alias("value"),
            F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("after"))))

    none = "array<struct<start: int, end: int, value: string, before: string, after: string>>"
    some = let(found, lambda values: F.when(F.size(values) > 0, let(
        F.split(text, pattern, -1), lambda pieces: located(pieces, values))).otherwise(F.array().cast(none)))
    return F.when(text.rlike(guard), some).otherwise(F.array().cast(none))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit of a digit string is right."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(
        F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                    lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int"))),
        F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def parts_over(value: Column, most: int) -> Column:
    """Number of dotted parts above ``most`` (leading zeros do not count)."""
    significant = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.size(F.filter(F.split(value, r"\."), lambda p: (F.length(significant(p)) > len(str(most))) | (
        F.coalesce(F.try_to_number(significant(p), F.lit("999")), F.lit(0)) > most)))


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one base rule; matches that fail its test are dropped, without another try."""
    count = lambda s: F.length(digits_of(s["value"]))
    valid = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: parts_over(s["value"], 255) == 0,
        "card": lambda s: F.when(count(s).between(16, 19), luhn(digits_of(s["value"]))).otherwise(F.lit(False)),
        "phone": lambda s: count(s).between(8, 15),
    }[kind]
    found = spans(text, BASE_PATTERNS[kind], BASE_GUARDS[kind])
    return found if kind == "email" else F.filter(found, valid)


def _beside(character: Column) -> Column:
    return (F.when(character == "", 0).when(character.rlike(r"\s"), 1).when(character.rlike("[\"'=:]"), 2)
            .when(character.rlike("[A-Za-z]"), 3).when(character.rlike("[0-9]"), 4).otherwise(5))


def _describer(number: int, kind: str):
    """span -> (kind, start, end, features)."""

    def described(s: Column) -> Column:
        value = s["value"]
        digits = F.length(digits_of(value))
        letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
        no = F.lit(0)
        made = {
            "kind": F.lit(number), "length": F.length(value), "digits": digits, "letters": letters,
            "others": F.length(value) - digits - letters,
            "distinct": F.size(F.array_distinct(F.split(value, ""))),
            "groups": F.size(F.split(value, "[^0-9A-Za-z]+")),
            "plus": value.startswith("+"),
            "parts_over_255": parts_over(value, 255) if kind == "ip" else no,
            "check_digit": F.when(digits.between(16, 19), luhn(digits_of(value))).otherwise(F.lit(False)) if kind == "card" else no,
            "before": _beside(F.right(s["before"], F.lit(1))), "after": _beside(F.left(s["after"], F.lit(1))),
            "cue": s["before"].rlike(CUES[kind]),
            "assigned": s["before"].rlike(_ASSIGNED) if kind == "secret" else no,
            "domain_dot": value.rlike(r"@[A-Za-z0-9-]+\.[A-Za-z0-9]") if kind == "email" else no,
        }
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.array(*[made[f].cast("double") for f in FEATURES]).alias("features"))

    return described


def proposals(text: Column) -> Column:
    """Array of (kind, start, end, features) of the proposals of every generator."""
    return F.concat(*[F.transform(spans(text, pattern, PROPOSAL_GUARDS[kind]), _describer(number, kind))
                      for number, (kind, pattern) in enumerate(PROPOSAL_PATTERNS.items())])


def named(kind: str, found: Column) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(found, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float
    low: "Split | Leaf"
    high: "Split | Leaf"


def _tree(node) -> Split | Leaf:
    if node.getClass().getSimpleName() == "LeafNode":
        return Leaf(float(node.prediction()))
    split = node.split()
    return Split(split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


@dataclass(frozen=True)
class Model:
    """Weighted trees and the threshold of each kind (kinds without one select nothing); with ``assigned``, every
    assigned secret is selected, whatever the trees say."""

    trees: tuple[tuple[float, Split | Leaf], ...] = ()
    thresholds: dict[str, float] = field(default_factory=dict)
    assigned: bool = False

    def score(self, features: Column) -> Column:
        def at(node) -> Column:
            if isinstance(node, Leaf):
                return F.lit(node.value)
            return F.when(F.get(features, F.lit(node.feature)) <= node.threshold, at(node.low)).otherwise(at(node.high))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + weight * at(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def selected(self, proposed: Column) -> Column:
        """The proposals at or above their kind's threshold, and the assigned secrets."""

        def enough(p: Column) -> Column:
            threshold = F.lit(2.0)  # of a kind without one: never reached
            for kind, least in self.thresholds.items():
                threshold = F.when(p["kind"] == kind, F.lit(least)).otherwise(threshold)
            chosen = self.score(p["features"]) >= threshold if self.thresholds else F.lit(False)
            return chosen | _assigned(p) if self.assigned else chosen

        return F.filter(proposed, enough)


def _assigned(p: Column) -> Column:
    return (p["kind"] == "secret") & (F.get(p["features"], F.lit(FEATURES.index("assigned"))) == 1)


def fit(docs: DataFrame, text_col: str = "text", max_documents: int = MAX_DOCUMENTS, max_proposals: int = MAX_PROPOSALS) -> Model:
    """Trees and thresholds from at most ``max_documents`` texts and ``max_proposals`` proposals.

    The documents are the first distinct texts by a hash, and every kind has an equal part of the proposals, so the
    sample does not depend on the layout, on groups of copies or on a kind that is frequent. The thresholds come from one
    histogram, by kind and score, of the proposals of all documents whose texts the fit leaves out. With only right or only wrong proposals there are
    no trees. Assigned secrets are selected at every size of the corpus; without
    any, and without trees, the model is the empty one.
    """
    text = F.col("text")
    order = F.xxhash64("text")
    sample = docs.select(F.col(text_col).alias("text")).where("text is not null")
    # the smallest hashes are found on hashes alone, so that no text is carried by the top-n
    last = sample.select(order.alias("h")).distinct().orderBy("h").limit(max_documents).agg(F.max("h")).first()[0]
    if last is None:
        return Model()
    every = sample
    sample = sample.where(order <= last).groupBy(order.alias("h")).agg(F.min("text").alias("text"))
    sample = sample.where(~_apart(text))
    each = Window.partitionBy("kind").orderBy("by")
    rows = sample.select("h", F.explode(_labelled(text)).alias("p")).select(
        "p.kind", "p.features", "p.label", F.xxhash64("h", "p.start", "p.kind").alias("by"))
    rows = rows.withColumn("place", F.row_number().over(each)).where(F.col("place") <= max_proposals // len(PROPOSAL_PATTERNS))
    rows = checkpoint(rows.select("label", "features").coalesce(1))
    labels = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not labels.get(1.0) or not labels.get(0.0):
        some = every.where(F.exists(proposals(text), _assigned)).limit(1).count()
        return Model(assigned=some > 0)
    named_features = [F.get("features", F.lit(i)).alias(f) for i, f in enumerate(FEATURES)]
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(
        rows.select("label", *named_features)).select("label", "vector")
    fitted = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(table)
    trees = tuple((float(w), _tree(t._call_java("rootNode"))) for w, t in zip(fitted.treeWeights, fitted.trees))
    model = Model(trees)
    # scored inside the array, as in annotate, so that only kind, bin and label are dealt out; at most 101 rows a kind
    scored = every.where(_apart(text)).select(F.explode(F.transform(_labelled(text), lambda p: F.struct(
        p["kind"].alias("kind"), F.floor(model.score(p["features"]) * 100).alias("bin"), p["label"].alias("label")))).alias("p"))
    bins = scored.groupBy("p.kind", "p.bin").agg(F.count("*").alias("n"), F.sum("p.label").alias("right")).collect()
    return Model(trees, thresholds(bins), True)


def _apart(text: Column) -> Column:
    """The texts that calibrate: a third of them, whatever their copies."""
    return F.pmod(F.xxhash64(text), F.lit(3)) == 0


def _labelled(text: Column) -> Column:
    """Array of (kind, start, features, label) of the proposals of a text."""
    right = F.concat(*[named(k, base_spans(text, k)) for k in BASE_KINDS])

    def label(p: Column, right: Column) -> Column:
        here = F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))
        return F.when(p["kind"] == "secret", F.get(p["features"], F.lit(FEATURES.index("assigned"))) == 1).otherwise(
            F.array_contains(right, here)).cast("double")

    return let(right, lambda right: F.transform(proposals(text), lambda p: F.struct(
        p["kind"].alias("kind"), p["start"].alias("start"), p["features"].alias("features"), label(p, right).alias("label"))))


def thresholds(bins, precision: float = PRECISION) -> dict[str, float]:
    """Per kind the lowest bin edge down to which every bin's share of right proposals reaches ``precision``.

    A bin that fails ends it: many sure proposals above do not pay for wrong ones below.
    """
    out: dict[str, float] = {}
    for kind in sorted({b["kind"] for b in bins}):
        for b in sorted((b for b in bins if b["kind"] == kind), key=lambda b: -b["bin"]):
            if b["right"] < precision * b["n"]:
                break
            out[kind] = b["bin"] / 100
    return out


def _of_kind(kind: str):
    return lambda p: p["kind"] == kind


def annotate(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): struct of the base spans of each kind and all spans.

    The fields ``email``, ``ip``, ``card`` and ``phone`` hold the base spans as
    ``kind:start:end`` in order of start; ``all`` adds the selected proposals
    after them, by kind as listed, then start. A null text has no spans.
    """
    name, text = temporary_name(docs, "pii"), temporary_name(docs, "text_of")
    base = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    found = {k: named(k, base_spans(F.col(text), k)) for k in BASE_KINDS}
    chosen = model.selected(proposals(F.col(text))) if model.thresholds or model.assigned else None
    out = base.withColumn(name, F.struct(
        *[v.alias(k) for k, v in found.items()],
        *([chosen.alias("chosen")] if chosen is not None else [])))
    merged = []
    for kind in PROPOSAL_PATTERNS:
        mine = [F.col(f"{name}.{kind}")] if kind in BASE_KINDS else []
        if chosen is not None:
            mine.append(named(kind, F.filter(F.col(f"{name}.chosen"), _of_kind(kind))))
        if mine:
            both = mine[0] if len(mine) == 1 else F.array_union(*mine)
            merged.append(F.transform(F.sort_array(F.transform(both, lambda s: F.struct(
                F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end"), s.alias("span")))),
                lambda s: s["span"]))
    out = out.withColumn(name, F.struct(*[F.col(f"{name}.{k}").alias(k) for k in BASE_KINDS], F.concat(*merged).alias("all")))
    return out.drop(text), name


def redact(docs: DataFrame, model: Model, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``; overlapping spans become one, named after the first.

    ``length_col`` (if the table has it) is set to the new length where the text changed.
    """
    annotated, name = annotate(docs, model, text_col)
    parts = F.sort_array(F.transform(F.col(f"{name}.all"), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end"),
        F.upper(F.split(s, ":")[0]).alias("kind"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("reach"))
    text = F.col(text_col)

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["reach"]
        between = F.substring(text, a["reach"] + 1, F.greatest(s["start"] - a["reach"], F.lit(0)))
        return F.struct(F.when(fresh, F.concat(a["out"], between, F.lit("<"), s["kind"], F.lit(">"))).otherwise(a["out"]).alias("out"),
                        F.greatest(a["reach"], s["end"]).alias("reach"))

    new = F.aggregate(parts, zero, step, lambda a: F.concat(a["out"], F.substring(text, a["reach"] + 1, F.length(text))))
    changed = F.size(f"{name}.all") > 0
    columns = {}
    flag, made = temporary_name(annotated, "changed"), temporary_name(annotated, "redacted")
    out = annotated.withColumn(flag, changed).withColumn(made, F.when(changed, new).otherwise(text))
    columns[text_col] = F.col(made)
    if length_col and length_col in docs.columns:
        columns[length_col] = F.when(F.col(flag), F.length(made).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return out.withColumns(columns).select(docs.columns)
