import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import EMPTY, words
from threadsift.llm import simhash
from threadsift.llm.tables import split_join


def reference(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, distance=2):
    fps = [reference(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, fps[i], min(ids, default=None)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in df.collect()), key=str)


def test_matches_all_pairs(frame, tricky):
    base = words(3, 400)
    near = [(100 + i, base.replace(" ", f" x{i} ", 1)) for i in range(12)] + [(90, base + " tail"), (91, base.upper())]
    rows = tricky + near
    assert result(simhash.near_duplicates(frame(rows))) == brute(rows)


def test_links_of_planted_distances(spark):
    fps = [0, 1, 3, 7 << 20, (7 << 20) | 1 << 40, 1 << 63 | 1 << 31, 1 << 31, 0b1111 << 50]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fingerprint bigint")
    for distance in (1, 2, 3):
        groups = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, distance)).collect()}
        signed = [f - (1 << 64) if f >> 63 else f for f in fps]
        for i, a in enumerate(signed):
            for j, b in enumerate(signed):
                if i != j and bin(fps[i] ^ fps[j]).count("1") <= distance:
                    assert groups[a] == groups[b]
        assert groups.get(0b1111 << 50) is None


def brute_groups(fps, distance):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y, key=signed)] = min(x, y, key=signed)
    return {signed(f): signed(find(f)) for f in fps}


def signed(f):
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("distance", [1, 2, 3])
@pytest.mark.parametrize("bucket", [2, 64])
def test_segment_tables_and_points_match_all_pairs(spark, monkeypatch, distance, bucket):
    """Single fingerprints, and a dense family that shares a segment value (split by points when crowded)."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = random.Random(distance)
    fps = {r.getrandbits(64) for _ in range(40)}
    fps |= {f ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) ^ (1 << r.randrange(64)) * r.randrange(2) for f in list(fps)}
    base = r.getrandbits(64)
    fps |= {base ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for _ in range(60)}
    fps |= {base ^ sum(1 << b for b in r.sample(range(32), r.randrange(4))) for _ in range(60)}
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fingerprint bigint")
    found = simhash.links(df, distance)
    assert all(bin((x.a ^ x.b) & (1 << 64) - 1).count("1") <= distance and x.a > x.b for x in found.collect())
    groups = {x.node: x.root for x in simhash.components(found).collect()}
    assert {signed(f): groups.get(signed(f), signed(f)) for f in fps} == brute_groups(fps, distance)


def test_hot_joins_are_split(spark):
    """A hub of links and a fingerprint of many copies: neither stays in the partitioning of an aggregate."""
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.shuffle.partitions": "40"}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("a"), F.col("id").alias("x"))
        least = many.repartition(20).groupBy("a").agg(F.min("x").alias("m"))
        out = split_join(many.repartition(20), least, ["a"])
        assert out.columns == ["a", "x", "m"] and out.count() == 60_000
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k in low:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "skew=true" in plan


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    found = {(r["node"], r["root"]) for r in simhash.components(edges).collect()}
    assert found == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_keep_one(frame, tricky):
    df = frame(tricky)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    groups = {c for _, _, c in brute(tricky)}
    assert len(ids) == len(set(ids)) and set(ids) - {None} == groups - {None}


def test_empty(spark):
    df = spark.createDataFrame([], EMPTY)
    assert simhash.near_duplicates(df).count() == 0 and simhash.keep_one(df).count() == 0
