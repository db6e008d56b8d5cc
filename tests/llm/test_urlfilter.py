import random

import pytest
from pyspark.sql import functions as F

from threadsift.llm import entry, urlfilter


def brute(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[:min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in entry.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        rule = max(fits, key=lambda r: len(r.text))
        return host, path, rule.text, rule.verdict
    return host, path, None, "block" if host in listed else "allow"


@pytest.mark.parametrize("max_words", [urlfilter.MAX_WORDS, 1])
def test_exact_over_the_whole_universe(spark, max_words):
    r = random.Random(2)
    hosts = [f"h{i}.{r.choice(['example.org', 'example.com', 'net', 'org', 'com'])}" for i in range(3000)]
    listed = set(r.sample(hosts, 400)) | {"not.in.corpus"}
    paths = ["", "/", "/es/1", "/en/12", "/fr/", "/de/x?y=/fr/", "/en/2#/es/", "?q=://x/"]
    urls = [f"http://{h.upper() if i % 7 == 0 else h}{r.choice(paths)}" for i, h in enumerate(hosts)]
    urls += [None, "", "no scheme", "://", "://org/", "://Ünï.org/es/", "a\n://example.org/es/\nx", "x" * 100_000, "ftp://" + "y" * 50_000]
    urls += urls[:50]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumns(
        {c: F.lit("extra") for c in ("host", "path", "rule", "verdict", "key", "listed", "judged", "host_part")})
    table = spark.createDataFrame([(h,) for h in [*listed, *list(listed)[:9], None]], "host string")
    judged, name = urlfilter.judge(pages, table, entry.URL_RULES, max_words=max_words)
    got = {row["page_id"]: tuple(row[name]) for row in judged.collect()}
    assert got == {i: brute(u, listed) for i, u in enumerate(urls)}
    kept = urlfilter.drop_blocked(pages, table, entry.URL_RULES, max_words=max_words)
    assert kept.columns == pages.columns and kept.count() == sum(v[3] == "allow" for v in got.values())


def test_levels_alternate_until_nothing_is_wrong(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 10 == 0).alias("listed"))
    cascade = urlfilter.build_cascade(universe)
    assert len(cascade.levels) > 2 and cascade.words * 64 < 20_000 * 8
    assert universe.where(cascade.listed(F.col("key")) != F.col("listed")).count() == 0


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "host string")
    judged, name = urlfilter.judge(pages, none, [])
    assert tuple(judged.first()[name]) == ("a.net", "/", None, "allow")
    assert urlfilter.judge(pages.limit(0), none, entry.URL_RULES)[0].count() == 0
