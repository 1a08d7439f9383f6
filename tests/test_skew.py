"""Left joins on frequent keys: the rows of the plain join, in many tasks."""
import collections
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import frame, skew
from tessera.session import scratch_dir


def _rows(df):
    return collections.Counter(map(repr, df.collect()))


@pytest.fixture(autouse=True)
def _no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _left(spark, hot, n=3000):
    """A third of the rows has the key ``hot``."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("id"))
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"), (F.col("id") % 5).alias("w"))


@pytest.mark.parametrize("hot", [7, None])
@pytest.mark.parametrize("null_safe", [True, False])
def test_equal_to_the_plain_join(spark, hot, null_safe):
    left = _left(spark, hot)
    right = spark.createDataFrame([(7, "a", 1), (7, "b", 2), (None, "n", 3), (10, "c", 4), (10**9, "d", 5)],
                                  "k long, s string, v int")
    got = skew.left_join_hot(left, right, "k", null_safe)
    want = frame.left_join(left, right, "k", null_safe)
    assert got.columns == want.columns == ["k", "v_x", "w", "s", "v_y"]
    assert got.dtypes == want.dtypes
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_key_is_met_by_many_tasks(spark, hot):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = _left(spark, hot, 30_000)
    right = spark.range(100).select(F.col("id").alias("k"), F.lit("r").alias("s")).union(
        spark.createDataFrame([(None, "null")], "k long, s string"))
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        loads = {}
        for name, join in (("plain", frame.left_join), ("dealt", skew.left_join_hot)):
            out = join(left, right, "k").groupBy(F.spark_partition_id().alias("p")).count()
            loads[name] = sorted((r["count"] for r in out.collect()), reverse=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert sum(loads["plain"]) == sum(loads["dealt"]) == 30_000
    assert loads["plain"][0] >= 10_000            # all rows of the key in one task
    assert loads["dealt"][0] < 10_000             # the key is in several tasks
    assert loads["dealt"][0] <= 2 * 30_000 / tasks


def test_heavy_hitters_and_their_pieces(spark):
    left = _left(spark, None, 3000)
    hot = skew.heavy_hitters(left, F.xxhash64("k"), 8)
    null_hash = spark.range(1).select(F.xxhash64(F.lit(None).cast("long"))).first()[0]
    assert [h for h, _ in hot] == [null_hash]
    assert hot[0][1] == -(-1000 * 8 * skew.PIECES // 3000)
    assert skew.heavy_hitters(spark.range(3000), F.xxhash64("id"), 8) == []
    assert skew.heavy_hitters(spark.range(0), F.xxhash64("id"), 8) == []


def test_other_types_empty_tables_and_clashing_names(spark):
    left = spark.createDataFrame([(i % 2 or None, {"a": i}, i, 0) for i in range(60)],
                                 "k int, m map<string,int>, __salt long, __pieces int")
    right = spark.createDataFrame([(1.0, 2, "x"), (None, 3, "y")], "k double, __salt int, __key_hash string")
    got, want = (j(left, right, "k").select("k", "__salt_x", "__pieces", "__salt_y", "__key_hash")
                 for j in (skew.left_join_hot, frame.left_join))
    assert _rows(got) == _rows(want)
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        assert skew.left_join_hot(a, b, "k").count() == frame.left_join(a, b, "k").count()


def test_spread_and_whole_repeats(spark):
    left = spark.range(2000).select(F.lit("x").alias("k"), F.col("id").alias("n"))
    right = spark.createDataFrame([("x", 1)], "k string, r int")
    out = skew.left_join_hot(left, right, "k", spread=F.col("n"), tasks=4)
    assert out.where("r = 1").count() == 2000
    assert out.select("n").distinct().count() == 2000


def test_reads_the_scanned_table_only_for_the_key(spark):
    path = os.path.join(scratch_dir(spark, "hot"))
    _left(spark, 7).write.parquet(path)
    left = spark.read.parquet(path)
    plan = left.select(F.xxhash64("k").alias("h")).agg(
        F.expr("approx_top_k(h, 10, 100)"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint>" in plan
