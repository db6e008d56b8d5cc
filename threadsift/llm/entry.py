"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.llm import (
    decontaminate,
    features,
    hilbert,
    licenses,
    mixing,
    nbsvm,
    pii,
    quality_rules,
    ranked,
    simhash,
    suffix_dedup,
    toxicity,
    urlfilter,
    whitening,
)
from threadsift.llm.tables import read

QUERIES = {}
ORACLE_SQL = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark, sf_dir):
    groups = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", simhash.fingerprint_text(F.col("fingerprint")).alias("fingerprint"), "component_id")


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query
def op9_benchmark_decontamination(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    scanned, name = decontaminate.scan(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    found = F.col(name)
    return scanned.select(
        "doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        found["contaminated"].alias("contaminated"))


ORACLE_SQL["op9_benchmark_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {decontaminate.SPAN_WORDS}) AS n,
         unnest([array_to_string(w[i:i + least(len(w), {decontaminate.SPAN_WORDS}) - 1], ' ')
                 FOR i IN range(1, len(w) - least(len(w), {decontaminate.SPAN_WORDS}) + 2)]) AS s
       FROM b WHERE len(w) > 0),
dw AS (SELECT rid, n, unnest(range(1, CAST(len(w) AS BIGINT) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM bw) l),
hits AS (SELECT rid, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND array_to_string(dw.w[i:i + dw.n - 1], ' ') = bw.s),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) x GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT rid, item_id FROM hits) x GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


def _scored(docs, scored, name, threshold):
    return scored.select(
        "doc_id", (features.fold("doc_id") == 0).alias("held_out"), F.col(name).alias("score"),
        (F.col(name) >= threshold).cast("int").alias("predicted"))


@query
def op7_quality_classifier(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = nbsvm.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return _scored(docs, *nbsvm.score(docs, model), nbsvm.THRESHOLD)


@query
def op5_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return _scored(docs, *toxicity.score(docs, model), toxicity.THRESHOLD)


URL_RULES = (
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
)
#: A host with one of these labels is listed.
LISTED_LABELS = ("casino-win", "ads-track")


@query
def op2_url_filters(spark, sf_dir):
    """The listed hosts are those of the corpus with a listed label."""
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    host = urlfilter.url_parts(F.col("url"))[0]
    listed = pages.select(host.alias("host")).where(
        F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, LISTED_LABELS)))).distinct()
    judged, name = urlfilter.judge(pages, listed, URL_RULES)
    return judged.select("page_id", f"{name}.host", f"{name}.path", f"{name}.rule", f"{name}.verdict")


def _sql_rules(column):
    order = sorted(URL_RULES, key=lambda r: -len(r.text))
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{column(r)}'"
        for r in order) + " END"


ORACLE_SQL["op2_url_filters"] = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, {_sql_rules(lambda r: r.text)} AS rule,
       coalesce({_sql_rules(lambda r: r.verdict)}, CASE WHEN list_has_any(string_split(host, '.'), {list(LISTED_LABELS)})
         THEN 'block' ELSE 'allow' END) AS verdict
FROM p
"""


@query
def op3_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return quality_rules.judge(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def _quality_rules_sql() -> str:
    q, n = quality_rules, quality_rules.REPEAT_WINDOW
    steps, rules = q.CUTOFFS, len(q.RULES)
    shares = " UNION ALL ".join(
        f"SELECT stratum, '{r.name}' AS rule, least({steps + 1}, CAST(ceil({r.count} * 1.0 / n_words / {r.largest / steps}) AS INTEGER)) AS step FROM good"
        for r in q.RULES)
    width = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {r.largest / steps}" for r in q.RULES) + " END"
    rejected = " OR ".join(
        f"coalesce(CAST({r.count} AS DOUBLE) / n_words > (SELECT cutoff FROM cutoffs x WHERE x.stratum = c.stratum AND rule = '{r.name}'), false)"
        for r in q.RULES)
    risk = q.RISK / rules
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT rid, unnest(range(1, len(words) - {n - 2})) AS i, words FROM d WHERE len(words) >= {n}),
g AS (SELECT rid, i, array_to_string(words[i:i + {n - 1}], ' ') AS s FROM w),
twice AS (SELECT rid, s FROM g GROUP BY rid, s HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {n})) AS p FROM g JOIN twice USING (rid, s)) x GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
c AS (SELECT rid, doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        len(words) < {q.MIN_WORDS} OR 100 * coalesce(n, 0) > {q.MAX_REPEAT_PERCENT} * len(words) AS base_failed
      FROM d JOIN l USING (rid) LEFT JOIN covered USING (rid)),
good AS (SELECT * FROM c WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1)),
shares AS ({shares}),
grid AS (SELECT DISTINCT stratum, rule, unnest(range(1, {steps + 1})) AS step FROM shares),
tests AS (SELECT grid.stratum, grid.rule, grid.step, count(*) AS n, count(*) FILTER (WHERE shares.step > grid.step) AS k
          FROM grid JOIN shares USING (stratum, rule) GROUP BY ALL),
tails AS (SELECT *, CASE WHEN k >= n * {risk} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
            exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) END AS p FROM tests),
passed AS (SELECT *, min(CASE WHEN p <= {q.DELTA} / ((SELECT count(DISTINCT stratum) FROM shares) * {rules} * {steps}) THEN 1 ELSE 0 END)
             OVER (PARTITION BY stratum, rule ORDER BY step DESC) AS all_passed FROM tails),
cutoffs AS (SELECT stratum, rule, min(step) * {width} AS cutoff FROM passed WHERE all_passed = 1 GROUP BY stratum, rule)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE NOT ({rejected}) END AS kept FROM c"""


ORACLE_SQL["op3_quality_rules"] = _quality_rules_sql()


@query
def op6_pii(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found, name = pii.annotate(docs, pii.fit(docs))
    base = F.concat(*[F.col(f"{name}.{k}") for k in pii.BASE_KINDS])
    return found.select(
        "doc_id", *[F.size(f"{name}.{k}").cast("bigint").alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(f"{name}.all", ",").alias("spans"))


def domain_of(source):
    """The tree's top level: one large web crawl, forums (src1 to src9), and books."""
    return F.when(source == "src0", "web").when(source.rlike("^src[1-9]$"), "forums").otherwise("books")


MIX_WEIGHTS = ({"web": 0.3, "forums": 0.3, "books": 0.4}, {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15}, None)
MIX_FRACTION = 0.6


def mixed(docs):
    path = [domain_of(F.col("source")), F.col("lang"), F.col("source")]
    return mixing.mix(docs, path, MIX_WEIGHTS, MIX_FRACTION)


@query
def op4_source_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    taken, names = mixed(docs)
    return taken.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source",
                        *[F.col(names[n]).alias(n) for n in ("epoch", "tokens", "taken")])


@query
def pipeline(spark, sf_dir):
    from corpus_pipeline import run  # it uses this module for the mix

    return run(spark, sf_dir)


@query
def op10_license_scan(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found, name = licenses.scan(docs, licenses.fit(docs))
    families = F.array_sort(F.array_distinct(F.transform(name, lambda f: f["family"])))
    return found.select("doc_id", F.array_join(families, ",").alias("families"),
                        F.size(name).cast("bigint").alias("n_paragraphs"),
                        F.array_max(F.transform(name, lambda f: f["probability"])).alias("probability"))


@query
def op8_suffix_array_dedup(spark, sf_dir):
    out = suffix_dedup.dedup(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_LENGTH = suffix_dedup.LENGTH
ORACLE_SQL["op8_suffix_array_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h,
             CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT rid, s, md5(substr(h, 2 * s + 1, {2 * _LENGTH})) AS k
      FROM (SELECT rid, h, unnest(range(0, n - {_LENGTH - 1})) AS s FROM d WHERE n >= {_LENGTH}) x),
st AS (SELECT rid, s FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) r USING (k)),
cut AS (SELECT rid, s, CASE WHEN s - lag(s) OVER (PARTITION BY rid ORDER BY s) <= {_LENGTH} THEN 0 ELSE 1 END AS new FROM st),
run AS (SELECT rid, s, sum(new) OVER (PARTITION BY rid ORDER BY s) AS r FROM cut),
span AS (SELECT rid, r, min(s) AS a, max(s) + {_LENGTH} AS b FROM run GROUP BY rid, r),
part AS (SELECT rid, a, b, substr(h, 2 * before + 1, 2 * (a - before)) AS kept FROM (
           SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM span) x JOIN d USING (rid)),
doc AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(kept, '' ORDER BY a) AS kept FROM part GROUP BY rid)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN doc USING (rid)
"""


#: Number of shards, and the columns that span the curve.
SHARDS = 40
SHARD_DIMENSIONS = ("source", "lang", "size")


@query
def op11_hilbert_sharding(spark, sf_dir):
    """Only narrow columns are ordered: id, size and checksum stand for the text."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), "lang", "source")
    placed, name = hilbert.shards(rows, SHARD_DIMENSIONS, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), f"{name}.shard", f"{name}.slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def _crc_table() -> list[int]:
    """The remainders of all bytes by the checksum's polynomial (reversed 0x04C11DB7)."""
    out = []
    for r in range(256):
        for _ in range(8):
            r = r >> 1 ^ (0xEDB88320 if r & 1 else 0)
        out.append(r)
    return out


def _hilbert_sql() -> str:
    n, bits = len(SHARD_DIMENSIONS), hilbert.BITS
    ranks = ", ".join(f"(rank() OVER (ORDER BY {d} NULLS FIRST) - 1) * {1 << bits} // count(*) OVER () AS c{i}"
                      for i, d in enumerate(SHARD_DIMENSIONS))
    corner = " + ".join(f"(((c{i} >> level) & 1) << {i})" for i in range(n))
    step = f"table_[(walk & 255) * {1 << n} + {corner} + 1]"  # walk: place so far * 256 + state
    return f"""
WITH t AS (SELECT {hilbert.curve_table(n)} AS table_, {_crc_table()} AS crcs),
d AS (SELECT doc_id, lang, source, CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size,
        list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: CAST('0x' || b AS BIGINT)),
          lambda crc, b: xor(crcs[(xor(crc, b) & 255) + 1], crc >> 8), CAST(4294967295 AS BIGINT)) AS crc FROM documents, t),
c AS (SELECT doc_id, lang, source, size, xor(crc, 4294967295) AS text_crc32, {ranks} FROM d),
p AS (SELECT doc_id, lang, source, size, text_crc32, list_reduce(CAST(range({bits - 1}, -1, -1) AS BIGINT[]),
        lambda walk, level: (((walk >> 8) * {1 << n} + ({step} & {(1 << n) - 1})) << 8) + ({step} >> {n}), CAST(0 AS BIGINT)) >> 8 AS place
      FROM c, t),
o AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY place, doc_id NULLS FIRST, size, text_crc32, lang NULLS FIRST,
        source NULLS FIRST) - 1 AS nth FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(nth * {SHARDS} // n AS INTEGER) AS shard,
       nth - (((nth * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS}) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM o
"""


ORACLE_SQL["op11_hilbert_sharding"] = _hilbert_sql()


@query
def op12_embedding_whitening(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", components=4)
    out, name = whitening.transform(vectors, "embedding", model)
    rows = out.select("vec_id", F.col(name)["deviation"].alias("deviation"),
                      F.posexplode(F.col(name)["whitened"]).alias("at", "whitened"))
    explained = F.array(*[F.lit(x) for x in model.explained], F.lit(None).cast("double"))
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                       "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))


@query
def op13_ranked_search(spark, sf_dir):
    index = ranked.build_index(read(spark, sf_dir, "documents", "doc_id", "text"))
    found = ranked.search(index, read(spark, sf_dir, "benchmark", "item_id", "text"), k=10)
    return found.select(F.col("query.id").alias("item_id"), "rank", "doc_id", "score")


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL["op13_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) x GROUP BY rid, term),
q AS (SELECT item_id, text, term, count(*) AS qtf FROM (
        SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark) b) x GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * any_value(nd) + 2)::DOUBLE / (2.0 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, t GROUP BY term),
m AS (SELECT rid, doc_id, 100 - 75 + (75 * len(w) * nd) // l AS m FROM d, t),
s AS (SELECT item_id, text, doc_id, rid, CAST(sum(qtf * w.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_id, text, doc_id, rid),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
