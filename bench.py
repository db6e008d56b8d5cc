"""Benchmark the headline queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
(default 8). The tables come as one file with one row group each, which is one
task to any reader, so they are first written again as several files a core, as a dataset of
any size would be; this is not timed. Each query is run once to warm up, then ``$BENCH_REPEATS``
(default 3) times fully materialised through the ``noop`` sink; the median
is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "hot_words_overall",        # flagship: tokenise, stop words, count, top 10 per source
    "hot_words_grouping_sets",  # overall + per-quarter counts in one pass
    "trend_full_outer",         # two pivots + full outer merge
    "issue_extract_pipeline",   # quality filters + four-step near-duplicate cascade
    "issue_clean",              # parse + clean + 10-range total sort (the recorded job)
    "range_sorted",             # the total-order sort alone, on orders
    "markup_clean",             # HTML unescape, tags, code, URLs, punctuation
    "qa_clean_posts",           # join with labels + Q&A cleaner
    "qa_profile",               # 21 counters over nested JSON answers
    "text_length_profile",      # exact percentiles per source
    "stratified_folds",         # exact per-label ranking without a single-task window
    "confidence_boxplot",       # exact quartiles + whiskers
    "completeness",             # one-pass column profile
)


FILES_A_CORE = 2


def split_tables(spark, sf_dir: str, files: int) -> str:
    """The tables of ``sf_dir`` as several files each, in a new scratch folder."""
    from threadsift.plans.tables import TABLES, table

    out = tempfile.mkdtemp(prefix="threadsift-bench-")
    for name in TABLES:
        table(spark, sf_dir, name).repartition(files).write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    from threadsift.plans import registry
    from threadsift.plans.tables import table
    from threadsift.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(HEADLINE)

    n_cores = os.cpu_count() if cpus == "*" else int(cpus)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * n_cores)))
    spark = local_session(cpus, shuffle_partitions=parts, app_name="threadsift-bench")
    registry.load_all()
    source, sf_dir = sf_dir, split_tables(spark, sf_dir, FILES_A_CORE * n_cores)
    # small files: each a task of its own
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = registry.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(repeats):
            spark.catalog.clearCache()  # every timed run reads its input again
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)

    docs = table(spark, sf_dir, "documents").count()
    rows["documents"] = docs
    rows["orders"] = table(spark, sf_dir, "orders").count()
    total = round(sum(timings.values()), 3)
    out = {
        "metric": "headline_queries_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(source).replace("sf", ""),
        "cpus": cpus,
        "input_rows": rows,
        "scan_tasks": table(spark, sf_dir, "documents").rdd.getNumPartitions(),
        "rows_per_sec": {
            "issue_clean": round(docs / timings["issue_clean"], 1) if timings.get("issue_clean") else None,
            "hot_words_overall": round(docs / timings["hot_words_overall"], 1)
            if timings.get("hot_words_overall") else None,
            "range_sorted": round(rows["orders"] / timings["range_sorted"], 1)
            if timings.get("range_sorted") else None,
        },
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
