"""Physical plans keep the properties the design relies on at scale."""

import pytest

from threadsift.plans import registry

SF = "/root/testdata/sf0.1"


@pytest.fixture(autouse=True)
def loaded():
    registry.load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_words_plan(spark):
    plan = _plan(registry.QUERIES["hot_words_overall"](spark, SF))
    assert "InMemoryTableScan" not in plan
    assert "ReadSchema: struct<text:string,source:string>" in plan
    assert plan.count("WindowGroupLimit") == 2  # partial before the exchange, final after
    assert "partial_count" in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(registry.QUERIES["event_filter_project"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    union = _plan(registry.QUERIES["union_all_periods"](spark, SF))
    assert union.count("GreaterThanOrEqual(o_orderdate") == 2


def test_cascade_limits_before_shuffle(spark):
    plan = _plan(registry.QUERIES["dedupe_cascade"](spark, SF))
    assert plan.count("WindowGroupLimit") == 6  # three slices, partial + final each


def test_profile_is_one_aggregate(spark):
    plan = _plan(registry.QUERIES["qa_profile"](spark, SF))
    assert plan.count("Exchange SinglePartition") <= 1
    assert "Generate" not in plan  # answers handled per row, never exploded


def test_scans_are_pruned_and_not_cached(spark):
    hot = _plan(registry.QUERIES["hot_words_overall"](spark, SF))
    assert "InMemoryTableScan" not in hot and "RoundRobin" not in hot
    assert "ReadSchema: struct<text:string,source:string>" in hot or "ReadSchema: struct<source:string,text:string>" in hot


def _final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name,scans", [("qa_profile_report", 4), ("news_profile_report", 3)])
def test_profiles_take_two_passes(spark, name, scans):
    # a pass over Q&A posts reads two tables; the splits of the length quantiles are a subquery of their own
    assert _final_plan(registry.QUERIES[name](spark, SF)).count("FileScan parquet") <= scans


def test_trend_merges_by_an_outer_join(spark):
    plan = _plan(registry.QUERIES["trend_full_outer"](spark, SF))
    assert "FullOuter" in plan and plan.count("FileScan parquet") == 2


def test_grouping_sets_expand_counts(spark):
    plan = _plan(registry.QUERIES["hot_words_grouping_sets"](spark, SF))
    below = plan[plan.index("Expand"):]
    assert "HashAggregate" in below and "Generate" in below  # counted before it is expanded


def test_cascade_carries_no_texts(spark):
    plan = _plan(registry.QUERIES["issue_extract_pipeline"](spark, SF))
    assert plan.count("WindowGroupLimit") == 8  # four slices, partial + final each
    assert not any("text" in line or "body" in line for line in plan.splitlines() if "WindowGroupLimit" in line)


def test_building_starts_no_job(spark):
    context = spark.sparkContext
    for name in ("confidence_boxplot", "true_label_metrics", "trend_full_outer", "size_target_sample", "stratified_folds",
                 "news_profile_report", "qa_profile_report", "hash_sample"):
        registry.QUERIES[name](spark, SF)  # reads the parquet footers once
        context.setJobGroup(name, name)
        registry.QUERIES[name](spark, SF)
        jobs = context.statusTracker().getJobIdsForGroup(name)
        described = [j for j in jobs if len(context.statusTracker().getJobInfo(j).stageIds) > 1]
        assert not described and len(jobs) <= 3, (name, list(jobs))  # at most one footer read a table
    context._jsc.clearJobGroup()
