"""The physical plans: no row-at-a-time Python, no window over the whole data, filters at the scan."""

import re

import pytest
from conftest import SF_DIR

from anchorframe.plans.catalogue import QUERIES
from anchorframe.session import RUNTIME_SETTINGS

RELATIONAL = ["cohort_semi", "peak_summary", "baseline_cascade", "detect_onset", "window_mean_pivot", "dose_sum_start", "overlap_flags",
              "prorated_sum", "union_minutes", "feature_matrix", "event_log_amounts", "mid_ranks", "kruskal_h", "dunn_z"]


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cross_join(spark, name):
    p = plan(QUERIES[name](spark, SF_DIR))
    for op in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert op not in p


@pytest.mark.parametrize("name", ["detect_onset", "union_minutes", "rolling_min", "mid_ranks"])
def test_windows_are_partitioned(spark, name):
    p = plan(QUERIES[name](spark, SF_DIR))
    assert "SinglePartition" not in p
    assert "Window" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["detect_onset"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-10" in p and "EqualTo(event_type,error)" in p
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        assert "props" not in schema


def test_labels_are_filtered_at_the_scan(spark):
    assert "In(event_type, [click,view])" in plan(QUERIES["overlap_sum"](spark, SF_DIR)).replace("signup,view", "click,view")


def test_hot_entities_are_split_before_aggregation(spark):
    """With a third of the rows on one key, the join partition is split and each split pre-aggregates."""
    from pyspark.sql import functions as F

    from anchorframe.core import TimeWindow
    from anchorframe.operators.windows import in_window

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        n = 600_000
        e = spark.range(0, n, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("entity"),
            F.timestamp_micros(F.col("id") * 1000).alias("ts"), F.rand(1).alias("value"))
        anchors = spark.range(997).select(F.col("id").alias("entity"), F.timestamp_micros(F.lit(n * 1000)).alias("anchor_ts"))
        out = in_window(e, anchors, TimeWindow.before(12)).groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
        total = sum(r["n"] for r in out.collect())
        assert total == n
        p = plan(out)
        assert "SortMergeJoin(skew=true)" in p
        final = p.split("== Initial Plan ==")[0]
        assert re.search(r"Exchange[^\n]*\n[^\n]*HashAggregate[^\n]*partial_count", final)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == RUNTIME_SETTINGS["spark.sql.adaptive.forceOptimizeSkewedJoin"]


@pytest.mark.parametrize("name, most", [("baseline_cascade", 2), ("detect_onset", 4), ("compare_onsets_tally", 4), ("rolling_min", 1), ("onset_histogram", 4), ("union_minutes", 2)])
def test_tables_are_read_few_times(spark, name, most):
    """File scans of the plan that a query returns; what it wrote before is read from the shared folder."""
    from anchorframe.plans.catalogue import QUERIES
    from conftest import SF_DIR

    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") <= most, plan
