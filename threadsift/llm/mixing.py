"""Mixing sources to target weights by hierarchical budgeting.

Method. A token budget flows down a tree of domains, languages and sources.
Each node splits its budget among its children by their weights; a child
that cannot use its part (all its tokens, ``max_epochs`` times) is filled up,
and the shortage goes to its siblings by their weights. Only what all
siblings together cannot use is left to the parent's own siblings, and so on
upwards: a node's capacity is the sum of its leaves' capacities, so the split
from the top down is final. A leaf takes whole epochs of its documents, and
for the rest a prefix of a seeded order that differs by epoch; the last
document is cut to the tokens that are left.

Leaves are small rows; documents are read once for their token counts and
once for the result, and are never sorted as a whole: an order is cut into
``BUCKETS`` ranges of a uniform hash, the ranges' sums find the one in which a
leaf's prefix ends, that range is cut in the same way, and only the last part (one row of a
leaf in 16 million) is sorted with its texts. The plan of the leaves is a written table: the planner
knows its size, broadcasts it if it is small and joins it by a shuffle, split where a leaf is hot, if not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.tables import checkpoint, split_join, temporary_name, written

#: Bits of the order that cut it into ranges, and a range again.
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
SEED = 11

WORD_GAPS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAPS), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Words of a text, the default token count."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def fill(children: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Adds ``share``: each row's part of ``budget`` by ``weight``, at most ``capacity``.

    Rows with the same ``parents`` are siblings (all have the same budget).
    Water-filling in one sort: in the order of capacity per weight the rows
    are full up to the first that is not; that row's level holds for the rest.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    order = siblings.orderBy("ratio", "tie")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = children.withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(0.0))
    out = out.withColumn("level", F.try_divide(F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0)),
                                               F.sum("weight").over(onward)))
    out = out.withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(siblings))
    share = F.when(F.col("level").isNull(), F.col("capacity")).otherwise(
        F.least("capacity", F.greatest(F.lit(0.0), F.col("level") * F.col("weight"))))
    return out.withColumn("share", share).drop("ratio", "level")


def _weight(name: Column, weights: Mapping[str, float] | None) -> Column:
    out = F.lit(1.0)
    for key, weight in (weights or {}).items():
        out = F.when(name == key, F.lit(float(weight))).otherwise(out)
    return out


def plan_leaves(leaves: DataFrame, budget: Column, weights: Sequence[Mapping[str, float] | None],
                max_epochs: int) -> DataFrame:
    """Leaves (n0, n1, .., tokens) with ``epochs`` (whole ones) and ``rest`` (tokens of the next).

    ``weights[i]`` gives the weights of names at level i (1 if not named; zero
    or less takes nothing).
    """
    depth = len(weights)
    names = [f"n{i}" for i in range(depth)]
    allowed = F.lit(True)
    for name, w in zip(names, weights):
        allowed = allowed & (_weight(F.col(name), w) > 0)
    rows = leaves.withColumn("capacity", F.when(allowed, F.col("tokens") * max_epochs).otherwise(0).cast("double"))
    current = None
    for level in range(depth):
        children = rows.groupBy(*names[:level + 1]).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        if current is None:
            children = children.withColumn("budget", budget.cast("double"))
        else:
            children = children.join(current, names[:level])
        weight = F.when(F.col("capacity") > 0, _weight(F.col(names[level]), weights[level])).otherwise(0.0)
        children = children.withColumn("weight", weight).withColumn("tie", F.col(names[level]))
        filled = fill(children, names[:level])
        current = filled.select(*names[:level + 1], F.col("share").alias("budget"), "tokens")
        if level < depth - 1:
            current = current.drop("tokens")
    # whole tokens, with room for rounding in sums of doubles
    whole = F.floor(F.col("budget") + 1e-6).cast("bigint")
    epochs = F.when(F.col("tokens") > 0, F.floor(whole / F.col("tokens")).cast("int")).otherwise(0)
    return current.select(*names, "tokens", whole.alias("budget"), epochs.alias("epochs")).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def _ends(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Of each leaf the last ``bucket`` that a prefix of ``rest`` tokens touches, and what it takes there (``room``)."""
    sums = rows.groupBy(*names, "bucket").agg(F.sum("tokens").alias("inside"), F.max("rest").alias("rest"))
    # at most BUCKETS rows per leaf
    upto = Window.partitionBy(*names).orderBy("bucket")
    sums = sums.withColumn("reached", F.sum("inside").over(upto))
    end = F.min_by(F.struct("bucket", (F.col("rest") - F.col("reached") + F.col("inside")).alias("room")), "bucket")
    return sums.where(F.col("reached") >= F.col("rest")).groupBy(*names).agg(end.alias("end")).select(*names, "end.*")


def mix(docs: DataFrame, path: Sequence[Column], weights: Sequence[Mapping[str, float] | None], fraction: float,
        max_epochs: int = 4, seed: int = SEED, text_col: str = "text", id_col: str = "doc_id",
        tokens: Column | None = None, length_col: str = "n_chars") -> tuple[DataFrame, dict[str, str]]:
    """One row per taken document and epoch, and the names of the added columns.

    ``path`` are the columns of the tree from the top (nulls are the empty
    name), ``fraction`` the budget as a share of all tokens. Added columns:
    ``epoch`` (from 0), ``tokens`` of the document and ``taken`` of them; the text of
    the last document of a leaf is cut to ``taken`` words (joined by blanks, and
    ``length_col``, if the table has it, set to the new length).
    Texts without tokens are never taken. Rows that are equal in id and text
    are taken in any order among themselves.
    """
    count = word_count(F.col(text_col)) if tokens is None else tokens
    names = [f"n{i}" for i in range(len(path))]
    steps = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in zip(path, names)]
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    narrow = checkpoint(docs.select(*steps, count.alias("tokens"), key.alias("key")).where("tokens > 0"))
    leaves = checkpoint(narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    totals = leaves.agg(F.sum("tokens"), F.count("*")).first()
    planned = written(plan_leaves(leaves, F.lit((totals[0] or 0) * fraction), weights, max_epochs), "mix-leaves")

    order = lambda k, e: F.xxhash64(k, e)  # noqa: E731  the seeded order of an epoch
    bucket = lambda o, cuts: F.shiftrightunsigned(o, 64 - cuts * BUCKET_BITS).cast("int")
    open_ones = split_join(narrow, planned.select(*names, "epochs", "rest"), names).where("rest > 0").withColumn(
        "order", order("key", "epochs"))
    first = _ends(open_ones.select(*names, bucket(F.col("order"), 1).alias("bucket"), "tokens", "rest"), names)
    first = written(first.select(*names, F.col("bucket").alias("outer"), F.col("room").alias("rest")), "mix-ranges")
    inside = split_join(open_ones.drop("rest"), first, names).where(bucket(F.col("order"), 1) == F.col("outer"))
    ends = _ends(inside.select(*names, bucket(F.col("order"), 2).alias("bucket"), "tokens", "rest"), names)
    plan = planned.join(ends, names, "left").select(*names, "epochs", F.coalesce("bucket", F.lit(-1)).alias("last"),
                                                    F.coalesce("room", F.lit(0)).alias("room"))
    plan = written(plan.where("epochs > 0 or last >= 0"), "mix-plan")

    taken_names = {n: temporary_name(docs, n) for n in ("epoch", "tokens", "taken")}
    own = {n: temporary_name(docs, "mix_" + n) for n in (*names, "epochs", "last", "room", "tokens", "order", "bucket", "before")}
    renamed = plan.select(*[F.col(c).alias(own[c]) for c in (*names, "epochs", "last", "room")])
    rows = docs.select("*", *[s.alias(own[n]) for s, n in zip(steps, names)])
    rows = split_join(rows, renamed, [own[n] for n in names])
    epochs, last = F.col(own["epochs"]), F.col(own["last"])
    rows = rows.withColumn(own["order"], order(key, epochs)).withColumn(
        own["bucket"], bucket(F.col(own["order"]), 2))
    rows = rows.where((epochs > 0) | (F.col(own["bucket"]) <= last)).withColumn(own["tokens"], count)
    rows = rows.where(F.col(own["tokens"]) > 0)
    every = F.col(own["tokens"])
    text = docs.columns.index(text_col)

    def out(df: DataFrame, epoch: Column, taken: Column, cut: bool) -> DataFrame:
        columns = [F.col(c) for c in docs.columns]
        if cut:
            short = F.array_join(F.slice(words_of(F.col(text_col)), F.lit(1), taken.cast("int")), " ")
            columns[text] = F.when(taken < every, short).otherwise(F.col(text_col)).alias(text_col)
            if length_col in docs.columns:
                length = F.length(short).cast(docs.schema[length_col].dataType)
                columns[docs.columns.index(length_col)] = F.when(taken < every, length).otherwise(F.col(length_col)).alias(length_col)
        return df.select(*columns, epoch.cast("int").alias(taken_names["epoch"]), every.alias(taken_names["tokens"]),
                         taken.cast("bigint").alias(taken_names["taken"]))

    whole = epochs + (F.col(own["bucket"]) < last).cast("int")
    certain = out(rows.where(whole > 0).withColumn(own["before"], F.explode(F.sequence(F.lit(0), whole - 1))),
                  F.col(own["before"]), every, False)
    # uniform order: about one row of a leaf in BUCKETS * BUCKETS
    ending = rows.where(F.col(own["bucket"]) == last)
    so_far = Window.partitionBy(*[own[n] for n in names]).orderBy(own["order"], id_col).rowsBetween(Window.unboundedPreceding, -1)
    ending = ending.withColumn(own["before"], F.coalesce(F.sum(own["tokens"]).over(so_far), F.lit(0)))
    room = F.col(own["room"]) - F.col(own["before"])
    partial = out(ending.where(room > 0), epochs, F.least(every, room), tokens is None)
    return certain.unionByName(partial), taken_names
