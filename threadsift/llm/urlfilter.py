"""URL filter: path and host rules, then a Bloom filter cascade over hosts.

Method. The listed hosts are encoded in a Bloom filter; hosts of the corpus
that pass it without being listed are encoded in a second one, listed hosts
that pass that one by mistake in a third, and so on until a level lets
nothing wrong through. The levels alternate between listed keys and false
positives, and they are built against every host of the corpus, so membership
is exact for each of them. A row is judged by the first level that it does
not pass, with hash and bit functions on its own host: no join.

A level is an array of 64-bit words, held as one scalar of the plan. The
total size is checked against ``MAX_WORDS``; beyond it the verdict of each
distinct host is joined to the rows instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.tables import checkpoint, temporary_name

#: Words of all levels together that may be sent to the tasks (8 MB).
MAX_WORDS = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host between ``://`` and ``/ ? #`` (A-Z lowered), path up to ``? #``.

    Both are empty for a null or a text without ``://``.
    """
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` bits, ``hashes`` positions a key, its words as a one-row table."""

    number: int
    bits: int
    hashes: int
    words: DataFrame

    def positions(self, key: Column) -> list[Column]:
        # two salted hashes give all positions; the salt sets the levels apart
        first, second = (F.pmod(F.xxhash64(key, F.lit(2 * self.number + j)), F.lit(self.bits)) for j in range(2))
        return [F.pmod(first + second * j, F.lit(self.bits)) for j in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        words = self.words.scalar()
        held = [F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in self.positions(key)]
        out = held[0]
        for h in held[1:]:
            out = out & h
        return out


def _level(keys: DataFrame, count: int, share: float, number: int) -> Level:
    """A filter over ``count`` keys (column ``key``) with the given false-positive share."""
    hashes = max(1, math.ceil(math.log2(1 / share)))
    bits = 64 * max(1, math.ceil(count * hashes / math.log(2) / 64))
    level = Level(number, bits, hashes, keys)
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    set_words = at.groupBy(F.floor(F.col("at") / 64).alias("i")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))).alias("word"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("bigint").alias("word"))
    dense = set_words.union(every).groupBy("i").agg(F.bit_or("word").alias("word"))
    words = dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda w: w["word"]).alias("words"))
    return Level(number, bits, hashes, checkpoint(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    @property
    def words(self) -> int:
        return sum(level.bits // 64 for level in self.levels)

    def listed(self, key: Column) -> Column:
        """True for listed keys, false for all other keys of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for at in range(len(self.levels) - 1, -1, -1):
            # the first level not passed: an odd one (from one) rules a key out, an even one confirms it
            out = F.when(self.levels[at].passes(key), out).otherwise(F.lit(at % 2 == 1))
        return out


def build_cascade(universe: DataFrame, max_words: int = MAX_WORDS) -> Cascade | None:
    """The cascade of a table (key, listed) that holds every key of the corpus once.

    None if it would take more than ``max_words``.
    """
    counts = {row["listed"]: row["n"] for row in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
    n_inside, n_outside = counts.get(True, 0), counts.get(False, 0)
    if not n_inside:
        return Cascade(())
    levels: list[Level] = []
    share = min(0.5, n_inside / (math.sqrt(2) * max(1, n_outside)))
    while n_inside:
        if sum(x.bits for x in levels) // 64 + math.ceil(n_inside * max(1, -math.log2(share)) / 44) > max_words:
            return None
        level = _level(inside, n_inside, share, len(levels))
        levels.append(level)
        # the wrongly passed keys of the other side are what the next level encodes
        wrong = checkpoint(outside.where(level.passes(F.col("key"))))
        inside, outside = wrong, inside
        n_inside, share = wrong.count(), 0.5
    return Cascade(tuple(levels))


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], url_col: str = "url", key_col: str = "host",
          max_words: int = MAX_WORDS) -> tuple[DataFrame, str]:
    """``pages`` with one more column (its name is returned): struct(host, path, rule, verdict).

    ``listed`` are the hosts to block, in column ``key_col`` (nulls are
    ignored, repeats count once); a rule that fits a url overrides the list. A
    url without a host has the empty host, which is a key like any other.
    """
    name, host, path = (temporary_name(pages, n) for n in ("judged", "host_part", "path_part"))
    host_of, path_of = url_parts(F.col(url_col))
    parted = pages.withColumn(host, host_of).withColumn(path, path_of)
    # each host of the corpus once, with whether it is listed: a union, no join
    seen = pages.select(host_of.alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("seen"))
    given = listed.where(F.col(key_col).isNotNull()).select(F.col(key_col).alias("key"), F.lit(True), F.lit(False))
    universe = seen.union(given).groupBy("key").agg(F.max("listed").alias("listed"), F.max("seen").alias("seen"))
    universe = checkpoint(universe.where("seen").drop("seen"))
    cascade = build_cascade(universe, max_words)
    if cascade is not None:
        blocked = cascade.listed(F.col(host))
    else:
        key, flag = temporary_name(parted, "key"), temporary_name(parted, "listed")
        parted = parted.join(universe.select(F.col("key").alias(key), F.col("listed").alias(flag)), F.col(host) == F.col(key))
        blocked = F.col(flag)
    rule, verdict = matched_rule(F.col(host), F.col(path), rules)
    verdict = F.coalesce(verdict, F.when(blocked, "block").otherwise("allow"))
    out = parted.withColumn(name, F.struct(F.col(host).alias("host"), F.col(path).alias("path"), rule.alias("rule"),
                                           verdict.alias("verdict")))
    return out.select(*pages.columns, name), name


def drop_blocked(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], **names) -> DataFrame:
    """The rows of ``pages`` whose verdict is not ``block``."""
    judged, name = judge(pages, listed, rules, **names)
    return judged.where(F.col(f"{name}.verdict") != "block").select(pages.columns)
