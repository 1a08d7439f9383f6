"""Plan shapes and invariances that matter at scale."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import frame, ordered

from .conftest import SF_CHECK


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["multi_agg", "split_60_20_20", "dense_ordinal", "pr_curve",
                                  "roc_auc", "threshold_sweep", "one_hot", "describe_numeric"])
def test_same_result_at_1_and_7_partitions(spark, name):
    q = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(map(tuple, q(spark, SF_CHECK).collect()), key=repr)
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = sorted(map(tuple, q(spark, SF_CHECK).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_hot_key_is_combined_before_the_shuffle(spark):
    # one key holds a third of all rows
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 10).cast("double").alias("v"))
    out = frame.group_agg(df, "k", {"v": ["sum", "mean"]})
    assert "partial_sum" in _plan(out)
    hot = out.filter(F.col("k") == "hot").first()
    assert hot["v_sum"] == sum(i % 10 for i in range(0, 30000, 3))


def test_region_rollup_aggregates_below_every_join(spark):
    plan = _plan(entry.queries()["sum_by_region"](spark, SF_CHECK))
    # lineitem per order, per customer, per nation, per region: four partial aggregates
    assert plan.count("partial_sum") == 4


def test_scans_are_pruned(spark):
    plan = _plan(entry.queries()["multi_agg"](spark, SF_CHECK))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "l_partkey" in scan and "l_extendedprice" in scan and "l_discount" in scan
    assert "l_comment" not in scan and "l_shipdate" not in scan and "l_tax" not in scan


def test_top1_uses_take_ordered(spark):
    from tessera.plans import fixtures as fx
    top = frame.top_k(fx.sales(spark, SF_CHECK), "price", 1, tie_break=["l_orderkey"])
    assert "TakeOrderedAndProject" in _plan(top)


def test_ordered_index_handles_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 100)
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("x"))
    got = ordered.ordered_index(df, ["x"])
    rows = sorted(got.collect(), key=lambda r: r["x"])
    assert [r["__rank"] for r in rows] == list(range(1, 5001))


@pytest.mark.parametrize("name", ["table_info", "null_share", "shape_of", "ml_features"])
def test_no_text_crosses_the_churn_join(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = entry.queries()[name](spark, SF_CHECK)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    below = [line for line in plan.split("\n") if "SortMergeJoin" in line or "Exchange hashpartitioning" in line]
    assert below
    # the only reader of the text itself is the scan and the projection on it
    scans = [i for i, line in enumerate(plan.split("\n")) if "FileScan" in line and "text#" in line]
    exchanges = [i for i, line in enumerate(plan.split("\n")) if "Exchange hashpartitioning" in line]
    for at in scans:
        above = plan.split("\n")[max(e for e in exchanges if e < at) + 1:at]
        assert any("Project" in line for line in above)
