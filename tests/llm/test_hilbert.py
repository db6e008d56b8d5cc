from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EMPTY
from threadsift.llm import hilbert

BITS = {1: 5, 2: 4, 3: 3, 4: 2}


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_the_curve_visits_every_cell_by_single_steps(spark, n):
    bits = BITS[n]
    cells = spark.range(1 << n * bits).select(
        *[F.shiftright("id", bits * i).bitwiseAND((1 << bits) - 1).cast("int").alias(f"c{i}") for i in range(n)])
    placed = cells.withColumn("at", hilbert.curve_index([F.col(f"c{i}") for i in range(n)], bits)).orderBy("at").collect()
    assert [r["at"] for r in placed] == list(range(1 << n * bits))
    for a, b in zip(placed, placed[1:]):
        assert sum(abs(x - y) for x, y in zip(a[:n], b[:n])) == 1


def test_bounds_of_the_curve():
    with pytest.raises(ValueError):
        hilbert.curve_index([None] * 5, 2)
    with pytest.raises(ValueError):
        hilbert.curve_index([None] * 4, 16)


def brute_coordinates(values, bits):
    key = lambda v: (v is not None, v)
    order = sorted(values, key=key)
    first = {}
    for i, v in enumerate(order):
        first.setdefault(v, i)
    return [first[v] * (1 << bits) // len(values) for v in values]


def check(rows, placed, name, dims, n_shards, bits=hilbert.BITS):
    got = [r.asDict(recursive=True) for r in placed.collect()]
    assert Counter(tuple(r.values()) for r in rows) == Counter(tuple(v for k, v in r.items() if k != name) for r in got)
    sizes = Counter(r[name]["shard"] for r in got)
    counts = [sizes.get(s, 0) for s in range(n_shards)]
    assert sum(counts) == len(rows) and set(sizes) <= set(range(n_shards))
    assert max(counts) - min(counts) <= 1
    for s in sizes:
        assert sorted(r[name]["slot"] for r in got if r[name]["shard"] == s) == list(range(sizes[s]))
    walk = sorted(got, key=lambda r: (r[name]["shard"], r[name]["slot"]))
    assert [r[name]["index"] for r in walk] == sorted(r[name]["index"] for r in got)
    coordinates = list(zip(*[brute_coordinates([r[d] for r in rows], bits) for d in dims]))
    by_row = {tuple(r.values()): c for r, c in zip(rows, coordinates)}
    place = {}
    for r in got:  # equal coordinates, equal place on the curve, and the other way round
        c = by_row[tuple(v for k, v in r.items() if k != name)]
        assert place.setdefault(c, r[name]["index"]) == r[name]["index"]
    assert len(set(place.values())) == len(place)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, size bigint, placed string, curve_index int")


def test_shards_of_tricky_rows(spark):
    rows = [{"doc_id": i if i % 7 else None, "source": None if i % 11 == 0 else f"s{i % 5}", "lang": ["en", "de", "", None][i % 4],
             "size": (i * i) % 97 if i % 13 else None, "placed": "x", "curve_index": i % 2} for i in range(200)]
    rows += [dict(doc_id=5, source="s1", lang="en", size=9, placed="x", curve_index=0)] * 150  # a hot group of equal rows
    df = table(spark, [tuple(r.values()) for r in rows])
    dims = ("source", "lang", "size")
    placed, name = hilbert.shards(df, dims, 40)
    assert name == "_placed" and placed.columns == [*df.columns, name]
    check(rows, placed, name, dims, 40)


def test_fewer_rows_than_shards_and_an_empty_table(spark):
    rows = [dict(doc_id=1, source="a", lang="en", size=1, placed=None, curve_index=None)] * 3
    placed, name = hilbert.shards(table(spark, [tuple(r.values()) for r in rows]), ("source", "size"), 40)
    check(rows, placed, name, ("source", "size"), 40)
    empty, name = hilbert.shards(spark.createDataFrame([], EMPTY), ("source", "lang"), 40)
    assert empty.count() == 0 and empty.columns[-1] == name


def test_every_dimension_prunes(spark, tmp_path):
    rows = [(i, f"s{i * 7 % 20:02d}", f"l{i * 11 % 16:02d}", i * 13 % 1000, "", 0) for i in range(4000)]
    df = table(spark, rows)
    placed, name = hilbert.shards(df, ("source", "lang", "size"), 64)
    ranges = hilbert.shard_ranges(placed, name, ("source", "lang", "size")).collect()
    assert sum(r["rows"] for r in ranges) == 4000
    for d, value in (("source", "s03"), ("lang", "l05"), ("size", 400)):
        touched = sum(r[f"min_{d}"] <= value <= r[f"max_{d}"] for r in ranges)
        assert touched <= 32, (d, touched)  # a sort by one column would prune that one only
    path = str(tmp_path / "shards")
    hilbert.write_shards(placed, name, path, 8)
    back = spark.read.parquet(path)
    assert back.count() == 4000
    want = {r["doc_id"]: tuple(r[name])[1:] for r in placed.collect()}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()} == want
