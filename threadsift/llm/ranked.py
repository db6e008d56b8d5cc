"""Ranked lexical search: best-first intervals over range-maximum tables.

``build_index`` cuts the documents into blocks and writes one posting list for
each block and term, and one list of documents for each block; it serves any
number of ``search`` calls. A search joins the posting lists with the
terms of the queries and handles each (block, group of queries) in one task:

- every posting list gets a sparse table of range maxima of its impacts;
- an interval of documents is bounded by the sum, over the query's terms, of
  the largest impact inside it (two table cells a term);
- the intervals with the highest bounds are taken first; each is split at the
  document of its largest impact, which is scored exactly (the bound of an interval
  of one document is its score), and the two rests are bounded anew;
- an interval that cannot hold a better document than the k found is dropped.

The best k of each block are ranked together. A block holds at most
``BLOCK_DOCS`` documents, a group some ``QUERY_GROUP`` queries, so a task's
memory does not grow with the corpus.

Results in special cases: a null or empty text has no terms and is never
found; a query without terms, or whose terms occur nowhere, has no rows;
repeated documents are found as often as they occur (their ids, equal or
null, too; null ids rank last among equal scores); equal queries (same id
and text) are answered once, queries that share an id but differ in text each
have their ranks; texts are read whole, whatever their length; of
other columns only the named ones are read; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from threadsift.llm.tables import written

#: On UTF-8 bytes: those of other than ASCII characters all belong to terms.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Most documents of a block: the number of documents whose postings a task holds.
BLOCK_DOCS = 1 << 13
#: A block also ends at so many postings, a bound on a task's memory for long texts.
BLOCK_POSTINGS = 1 << 21
#: Expected number of queries that a task answers together.
QUERY_GROUP = 256
#: A frequent term's posting lists meet its queries in so many tasks.
SALTS = 16
#: Intervals that are split at a time, those with the highest bounds.
FRONT = 32

# Fixed values of the score: a term's share of a document is
# 1e9 * tf div (1000 * tf + 8 * m), with m = 100 - 75 + (75 * n * N) div L.
SCALE, TF_PART, M_PART, M_FULL, M_LENGTH = 1_000_000_000, 1000, 8, 100, 75


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order, A-Z lower-cased (and nothing else: bytes know no other capitals)."""
    return TERM.findall(text.lower()) if text else []


@dataclass
class Index:
    """``lists``: block, term, at (places in the block, ascending), tf. ``docs``: block, id, n (by place)."""

    lists: DataFrame
    docs: DataFrame


_BLOCK_TYPES = pa.schema([("block", pa.string()), ("term", pa.string()), ("at", pa.list_(pa.int32())),
                          ("tf", pa.list_(pa.int32())), ("id", pa.list_(pa.int64())), ("n", pa.list_(pa.int32()))])
_BLOCK = "block string, term string, at array<int>, tf array<int>, id array<bigint>, n array<int>"


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


class _Block:
    """The postings of a growing block of documents."""

    def __init__(self):
        self.ids, self.lengths, self.keys, self.tfs, self.postings = [], [], [], [], 0
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__  # a new term gets the next number

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found = terms(text)
        counted = Counter(found)
        self.keys.append(np.fromiter(map(self.number.__getitem__, counted), np.int32, len(counted)))
        self.tfs.append(np.fromiter(counted.values(), np.int32, len(counted)))
        self.ids.append(doc_id), self.lengths.append(len(found))
        self.postings += len(counted)

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        """Documents by length, then id: neighbours then have like impacts, so bounds are tight."""
        size = len(self.ids)
        order = sorted(range(size), key=lambda i: (self.lengths[i], self.ids[i] is None, self.ids[i] or 0))
        # in the order of the places, so that a stable sort by term keeps them ascending
        at = np.repeat(np.arange(size, dtype=np.int32), [len(self.keys[i]) for i in order])
        term = np.concatenate([np.empty(0, np.int32), *[self.keys[i] for i in order]])
        tf = np.concatenate([np.empty(0, np.int32), *[self.tfs[i] for i in order]])
        self.keys, self.tfs = [], []
        by = np.argsort(term, kind="stable")
        ends = np.cumsum(np.bincount(term, minlength=len(self.number)))
        words, at, tf = list(self.number), at[by], tf[by]
        step = 1 << 14  # posting lists of a batch
        for a in range(0, len(words), step):
            b = min(a + step, len(words))
            lo, hi = (ends[a - 1] if a else 0), ends[b - 1]
            none = pa.nulls(b - a, pa.list_(pa.int64())), pa.nulls(b - a, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (b - a)), pa.array(words[a:b], pa.binary()).cast(pa.string()), _lists(at[lo:hi], ends[a:b] - lo, pa.int32()),
                 _lists(tf[lo:hi], ends[a:b] - lo, pa.int32()), *none], schema=_BLOCK_TYPES)
        ints = pa.nulls(1, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([None], pa.string()), ints, ints, pa.array([[self.ids[i] for i in order]], pa.list_(pa.int64())),
             pa.array([[self.lengths[i] for i in order]], pa.list_(pa.int32()))], schema=_BLOCK_TYPES)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Posting lists of all terms of all documents, as a table below the shared folder.

    ``id_col`` holds integers. No text crosses a shuffle: a block is a run of rows of one input task.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, block, made = TaskContext.get().partitionId(), _Block(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                block.add(doc_id, text)
                if len(block.ids) == BLOCK_DOCS or block.postings >= BLOCK_POSTINGS:
                    yield from block.rows(f"{task}-{made}")
                    block, made = _Block(), made + 1
        if block.ids:
            yield from block.rows(f"{task}-{made}")

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = written(narrow.mapInArrow(blocks, _BLOCK), "ranked-index")
    return Index(table.where(F.col("term").isNotNull()).select("block", "term", "at", "tf"),
                 table.where(F.col("term").isNull()).select("block", "id", "n"))


class Maxima:
    """A sparse table: the largest cell of any range in two look-ups. One level for each power of two up to ``longest``."""

    def __init__(self, cells: np.ndarray, longest: int):
        self.cells = len(cells)
        levels = np.empty((max(1, int(longest).bit_length()), len(cells)), cells.dtype)
        levels[0] = cells
        for k in range(1, len(levels)):
            half = 1 << (k - 1)
            levels[k] = levels[k - 1]
            np.maximum(levels[k, :-half], levels[k - 1, half:], out=levels[k, :-half])
        self.levels = levels.ravel()

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Largest of the cells a .. b - 1, none empty."""
        level = np.frexp(b - a)[1] - 1  # floor of log2
        level_start = level * self.cells
        return np.maximum(self.levels[level_start + a], self.levels[level_start + b - (1 << level)])


class Impacts:
    """The sparse tables of a block's posting lists, which stand one after the other.

    A cell holds impact * size + (size - 1 - place), so that the larger of two cells also
    names the first document of the larger impact.
    """

    def __init__(self, lists: list[np.ndarray], impacts: list[np.ndarray], size: int):
        self.size = size
        self.starts = np.cumsum([0, *map(len, lists)])
        self.places = np.concatenate(lists).astype(np.int64)
        cells = np.concatenate(impacts) * size + (size - 1 - self.places)
        self.table = Maxima(np.append(cells, -1), max(map(len, lists)))
        self.ranks: dict[int, np.ndarray] = {}

    def rank(self, t: int) -> np.ndarray:
        """By place: where list ``t`` has its first posting at that place or after it."""
        if t not in self.ranks:
            own = self.places[self.starts[t]:self.starts[t + 1]]
            self.ranks[t] = np.searchsorted(own, np.arange(self.size + 1)) + self.starts[t]
        return self.ranks[t]

    def between(self, ranks: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Largest cell of each list (rows) in each interval [lo, hi) of places (columns); -1: no posting."""
        a, b = ranks[:, lo], ranks[:, hi]
        none = a == b
        return np.where(none, -1, self.table.between(a, b + none))


def best_first(table: Impacts, query: list[tuple[int, int]], ids: Maxima, k: int) -> list[tuple[int, int, int]]:
    """The k best documents of a block for one query: (score, id, place), by score, then id.

    ``query``: (list, repeats) of each term of the query that has postings in the block;
    ``ids``: a table of the documents' negated ids (its maxima are the smallest ids).
    """
    size = table.size
    ranks = np.stack([table.rank(t) for t, _ in query])
    times = np.array([r for _, r in query], np.int64)[:, None]

    def bounded(lo, hi):
        cells = table.between(ranks, lo, hi)
        parts = np.where(cells >= 0, cells // size, 0) * times
        lead = np.argmax(parts, axis=0)
        return parts.sum(axis=0), size - 1 - cells[lead, np.arange(len(lo))] % size

    lo, hi = np.array([0]), np.array([size])
    bound, split = bounded(lo, hi)
    best: list[tuple[int, int, int]] = []  # (-score, id, place)
    while len(lo):
        least = -best[-1][0] if len(best) == k else 0
        alive = bound > 0
        if len(best) == k:  # documents of equal score count only before the last id found
            alive = (bound > least) | ((bound == least) & (-ids.between(lo, hi) < best[-1][1]))
        lo, hi, bound, split = lo[alive], hi[alive], bound[alive], split[alive]
        if not len(lo):
            break
        if len(lo) > FRONT:
            top = np.argpartition(-bound, FRONT - 1)[:FRONT]
        else:
            top = np.arange(len(lo))
        rest = np.ones(len(lo), bool)
        rest[top] = False
        a, b, at = lo[top], hi[top], split[top]
        los, his = np.concatenate([at, a, at + 1]), np.concatenate([at + 1, at, b])
        bounds, splits = bounded(los, his)
        scores = bounds[: len(at)]
        best += [(-int(s), -int(ids.levels[p]), int(p)) for s, p in zip(scores, at) if s > 0 and s >= least]
        best.sort()
        del best[k:]
        keep = (his > los) & (bounds > 0)
        keep[: len(at)] = False
        lo, hi = np.concatenate([lo[rest], los[keep]]), np.concatenate([hi[rest], his[keep]])
        bound, split = np.concatenate([bound[rest], bounds[keep]]), np.concatenate([split[rest], splits[keep]])
    return best


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``part, query (id, digest of the text), term, times`` of each distinct query.

    Queries are dealt by hash into parts of some ``QUERY_GROUP``; a part is answered in one task a block.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                counted = Counter(terms(text))
                if n := len(counted):
                    row = batch.slice(i, 1).to_pylist()[0]
                    yield pa.RecordBatch.from_pydict({
                        "id": [row["id"]] * n, "digest": [row["digest"]] * n, "part": [row["part"]] * n,
                        "term": [t.decode() for t in counted], "times": list(counted.values())}, schema=types)

    text = F.col(text_col).cast("string")
    distinct = queries.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text")).distinct()
    groups = distinct.agg(F.ceil(F.count(F.lit(1)) / QUERY_GROUP).alias("n")).scalar()
    dealt = distinct.select("id", "text", F.md5("text").alias("digest"),
                            F.pmod(F.xxhash64("id", "text"), F.greatest(groups, F.lit(1))).cast("int").alias("part"))
    schema = f"id {dealt.schema['id'].dataType.simpleString()}, digest string, part int, term string, times bigint"
    types = _arrow(schema)
    found = dealt.mapInArrow(split, schema)
    return found.select("part", F.struct("id", "digest").alias("query"), "term", "times")


def search(index: Index, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10) -> DataFrame:
    """``query (id, digest), rank, doc_id, score``: the ``k`` best documents of each query (fewer, if fewer score above 0)."""
    totals = index.docs.select(F.explode("n").alias("n")).agg(
        F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"))
    asked = query_terms(queries, id_col, text_col)
    # the queries that hold a term: at most a part's queries a row
    asked = asked.groupBy("part", "term").agg(F.collect_list(F.struct("query", "times")).alias("queries"))
    # written, so that the planner knows the size of the queries' side: lists cross a shuffle only if it is large
    asked = written(asked, "ranked-queries")
    # a frequent term's lists, one a block, are dealt over SALTS tasks
    salt = F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int")
    salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lists = index.lists.withColumn("salt", salt)
    held = lists.join(salted.select("term", "salt").distinct(), ["term", "salt"], "left_semi")
    counts = held.groupBy("term").agg(F.sum(F.size("at")).cast("bigint").alias("df"))
    weight = F.floor(F.log((F.lit(2.0) * totals.select("documents").scalar() + 2) / (F.lit(2.0) * F.col("df") + 1)) * 1000)
    weighted = written(asked.join(counts.select("term", weight.alias("weight")), "term"), "ranked-weights")
    weighted = weighted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = lists.join(weighted, ["term", "salt"]).select(
        "block", "part", "weight", "at", "tf", "queries", F.lit(None).cast("array<bigint>").alias("id"), F.lit(None).cast("array<int>").alias("n"))
    # the documents of a block go to each part that has a list in it
    docs = found.select("block", "part").distinct().join(index.docs, "block")
    none = {name: F.lit(None).cast(found.schema[name].dataType) for name in ("weight", "at", "tf", "queries")}
    rows = found.unionByName(docs.withColumns(none)).withColumns(
        {"documents": totals.select("documents").scalar(), "terms": totals.select("terms").scalar()})
    query_type = asked.schema["queries"].dataType.elementType["query"].dataType.simpleString()
    schema = f"query {query_type}, doc_id bigint, score bigint"
    types = _arrow(schema)
    best = rows.groupBy("block", "part").applyInArrow(lambda group: _answers(group, k, types), schema)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", "doc_id", "score")


def _answers(group: pa.Table, k: int, types: pa.Schema) -> pa.Table:
    """The best documents of one block for each query of one part."""
    rows = group.combine_chunks()
    is_docs = np.array(rows["weight"].is_null())
    docs = rows.filter(pa.array(is_docs))
    lists = rows.filter(pa.array(~is_docs))
    total, length = int(docs["documents"][0].as_py()), int(docs["terms"][0].as_py())
    ids = docs["id"].combine_chunks().flatten()
    n = docs["n"].combine_chunks().flatten().to_numpy()
    m = M_FULL - M_LENGTH + (M_LENGTH * n.astype(np.int64) * total) // length
    number = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    ends = np.cumsum(np.array([len(x) for x in lists["at"]], np.int64))
    places = lists["at"].combine_chunks().flatten().to_numpy().astype(np.int64)
    tf = lists["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
    weights = np.repeat(lists["weight"].to_numpy(), np.diff(ends, prepend=0))
    impacts = weights * ((SCALE * tf) // (TF_PART * tf + M_PART * m[places]))
    table = Impacts(np.split(places, ends[:-1]), np.split(impacts, ends[:-1]), len(n))
    least = Maxima(-number, len(number))
    asked: dict = {}
    for t, queries in enumerate(lists["queries"].to_pylist()):
        for q in queries:
            asked.setdefault(tuple(q["query"].values()), []).append((t, q["times"]))
    out = {"query": [], "doc_id": [], "score": []}
    for (query, digest), held in asked.items():
        for score, _, place in best_first(table, held, least, k):
            out["query"].append({"id": query, "digest": digest})
            out["doc_id"].append(ids[place].as_py())
            out["score"].append(-score)
    return pa.Table.from_pydict(out, schema=types)
