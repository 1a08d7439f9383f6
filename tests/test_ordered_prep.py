"""Two-level prefix, exact split, folds, one-hot, weights, quantiles."""
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ordered, prep, profile


def test_ordered_index_equals_single_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 50), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g long, x double")
    got = ordered.ordered_index(df, ["x", "id"], sums=["g"], lead_cols=["g"], n_buckets=16)
    w = Window.orderBy("x", "id")
    exp = df.select("id", F.row_number().over(w).alias("r"),
                    F.sum("g").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"),
                    F.lead("g").over(w).alias("n"))
    a = {r["id"]: (r["__rank"], r["cum_g"], r["next_g"]) for r in got.collect()}
    b = {r["id"]: (r["r"], r["c"], r["n"]) for r in exp.collect()}
    assert a == b


def test_ordered_index_descending(spark):
    df = spark.createDataFrame([(float(i % 97), i) for i in range(500)], "s double, id long") \
        .groupBy("s").agg(F.count("id").alias("n"))
    got = ordered.ordered_index(df, ["s"], descending=True, sums=["n"], n_buckets=8)
    rows = sorted(got.collect(), key=lambda r: -r["s"])
    run = 0
    for i, r in enumerate(rows):
        run += r["n"]
        assert r["__rank"] == i + 1 and r["cum_n"] == run and r["tot_rows"] == 97 and r["tot_n"] == 500


def test_no_single_partition_exchange(spark):
    df = spark.range(10000).withColumn("x", F.rand(3))
    plan = ordered.ordered_index(df, ["x"], materialize=False)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SinglePartition" not in plan


def test_ordered_index_text_keys_hot_value_and_nulls(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["hot"] * 6 + ["\u00e9t\u00e9", "Zed", "a", "", None]), rnd.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, s string, g long")
    for descending in (False, True):
        got = ordered.ordered_index(df, ["s", "id"], descending=descending, sums=["g"], lead_cols=["id"], n_buckets=16)
        order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in ("s", "id")]
        w = Window.orderBy(*order)
        exp = df.select("id", F.row_number().over(w).alias("r"), F.lead("id").over(w).alias("n"),
                        F.sum("g").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
        assert {r["id"]: (r["__rank"], r["next_id"], r["cum_g"]) for r in got.collect()} == \
            {r["id"]: (r["r"], r["n"], r["c"]) for r in exp.collect()}


def test_hot_value_is_spread_over_buckets(spark):
    df = spark.range(4000).select("id", F.lit("hot").alias("s"))
    sizes = ordered.with_range_bucket(df, [F.col("s").asc(), F.col("id").asc()], 16).groupBy(ordered.BUCKET).count()
    assert max(r["count"] for r in sizes.collect()) < 1000


def test_ordered_index_of_no_rows(spark):
    empty = spark.createDataFrame([], "s string, g long")
    assert ordered.ordered_index(empty, ["s"], sums=["g"], lead_cols=["g"]).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=100_000))
def test_split_sizes_property(n):
    train, rest = prep.split_sizes(n, 0.4)
    valid, test = prep.split_sizes(rest, 0.5)
    assert train + valid + test == n
    assert rest == math.ceil(0.4 * n) and test == math.ceil(0.5 * rest)


def test_split_partition_invariant_and_exact(spark):
    base = spark.range(0, 1001).withColumnRenamed("id", "k")
    a = prep.split_three(base.repartition(1), "k").collect()
    b = prep.split_three(base.repartition(7), "k").collect()
    assert sorted(a) == sorted(b)
    counts = pd.Series([r["part"] for r in a]).value_counts().to_dict()
    assert counts == {"train": 600, "valid": 200, "test": 201}


def test_stratified_folds_balanced(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"),
                                     (F.col("id") % 5 == 0).cast("int").alias("y"))
    got = prep.stratified_folds(df, "k", "y", k=5).groupBy("fold", "y").count().collect()
    per = {(r["fold"], r["y"]): r["count"] for r in got}
    assert all(per[(f, 1)] == 40 and per[(f, 0)] == 160 for f in range(5))


def test_one_hot_drop_first_and_null(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "g string, x int")
    out = prep.one_hot(df)
    assert out.columns == ["x", "g_b"]
    assert [r["g_b"] for r in out.orderBy("x").collect()] == [True, False, False]
    pdf = pd.get_dummies(pd.DataFrame({"g": ["b", "a", None], "x": [1, 2, 3]}), drop_first=True)
    assert list(pdf.columns) == out.columns


def test_balanced_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(10)], "k int, y int")
    w = {r["y"]: r["class_weight"] for r in prep.balanced_weights(df, "y").collect()}
    assert w == {1: 10 / (2 * 2), 0: 10 / (2 * 8)}


def test_describe_edge_cases(spark):
    one = spark.createDataFrame([(5.0, None)], "x double, y double")
    r = {row["column_name"]: row for row in profile.describe(one).collect()}
    assert r["x"]["count"] == 1 and r["x"]["std"] is None and r["x"]["p50"] == 5.0
    assert r["y"]["count"] == 0 and r["y"]["mean"] is None
    empty = spark.createDataFrame([], "x double")
    assert profile.describe(empty).first()["count"] == 0


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1, 2, 3, 4, 10], "b": [0.5, 0.25, 0.125, 2.0, 8.0]})
    got = {r["column_name"]: r for r in profile.describe(spark.createDataFrame(pdf)).collect()}
    exp = pdf.describe()
    for c in ["a", "b"]:
        assert got[c]["count"] == exp.loc["count", c]
        for s, k in [("mean", "mean"), ("min", "min"), ("max", "max"), ("p25", "25%"),
                     ("p50", "50%"), ("p75", "75%"), ("std", "std")]:
            assert abs(got[c][s] - exp.loc[k, c]) < 1e-4


def test_describe_quantiles_equal_pandas_on_hard_values(spark):
    rnd = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rnd.integers(0, 50, 3001), "b": np.round(rnd.random(3001) * 100, 2),
                        "hot": np.where(rnd.random(3001) < 0.6, 7.0, rnd.normal(0, 1e6, 3001)),
                        "wide": 10.0 ** rnd.integers(-200, 200, 3001), "one": np.full(3001, 3.5)})
    df = spark.createDataFrame(pdf)
    names = list(pdf.columns)
    bounds = [(float(pdf[c].min()), float(pdf[c].max())) for c in names]
    got = profile.exact_quantiles(df, names, bounds, [3001] * 5, (0.25, 0.5, 0.75, 0.999))
    for c, line in zip(names, got):
        assert np.allclose(line, pdf[c].quantile([0.25, 0.5, 0.75, 0.999]), rtol=1e-12)


def test_one_hot_vector_equals_boolean_dummies(spark):
    rows = [("b", 1), ("a", 2), (None, 3), ("c", 4), ("b", 5)]
    df = spark.createDataFrame(rows, "g string, x int")
    dense = {r["x"]: [r["g_b"], r["g_c"]] for r in prep.one_hot(df).collect()}
    vec = {r["x"]: [bool(v) for v in r["g_vec"].toArray()]
           for r in prep.one_hot_vector(df, "g").collect()}
    assert dense == vec


def test_row_index_dense_and_in_order(spark):
    df = spark.range(0, 2500, numPartitions=6).select((F.col("id") * 3).alias("v"))
    got = ordered.row_index(df, "i").collect()
    assert sorted(r["i"] for r in got) == list(range(2500))
    # positions follow the frame's order: v increases with the index here
    by_idx = [r["v"] for r in sorted(got, key=lambda r: r["i"])]
    assert by_idx == sorted(by_idx)


@pytest.mark.parametrize("values", [
    [1.0, 2.0, math.inf], [-math.inf, 1.0, 2.0], [-math.inf, math.inf], [math.inf, math.inf, 1.0], [math.inf],
    [-math.inf, -math.inf, 3.0, 4.0, 5.0], [1.0, 2.0, 3.0, 4.0, math.inf, math.inf, math.inf, math.nan],
    [7.5], [math.nan, math.nan], [-0.0, 0.0, 1e308, -1e308, 5e-324]])
def test_describe_of_infinities_equals_pandas(spark, values):
    got = profile.describe(spark.createDataFrame([(v,) for v in values], "x double")).first()
    with np.errstate(all="ignore"):
        want = pd.Series(values, dtype=float).describe()
    for name, at in (("count", "count"), ("mean", "mean"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                     ("p75", "75%"), ("max", "max")):
        a, b = got[name], want[at]
        assert (a is None or math.isnan(a)) if math.isnan(b) else a == pytest.approx(b, abs=1e-4)


def test_describe_of_keys_beyond_doubles_and_of_narrowed_brackets(spark, monkeypatch):
    big = spark.range(3001).select((F.col("id") + (1 << 60)).alias("k"), (F.col("id") % 7).alias("few"),
                                   F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") / 8).alias("hot"),
                                   F.when(F.col("id") % 5 == 0, float("inf")).otherwise(-F.col("id").cast("double")).alias("x"))
    pdf = big.toPandas()
    qs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    names = pdf.columns.tolist()
    bounds = [(float(pdf[c].min()), float(pdf[c].max())) for c in names]
    want = [[float(x) for x in pdf[c].quantile(list(qs))] for c in names]
    for most, grid in ((10_000, 2_000), (100, 2_000), (1, 50)):  # values collected at once; brackets narrowed by sketches
        monkeypatch.setattr(profile, "MOST", most)
        monkeypatch.setattr(profile, "GRID", grid)
        got = profile.exact_quantiles(big, names, bounds, [3001] * 4, qs)
        for c, a, b in zip(names, got, want):
            assert np.allclose(a, b, rtol=1e-15, atol=0, equal_nan=True), (most, c, a, b)


def test_describe_scans_the_table_twice(spark):
    df = spark.range(50_000).select(F.col("id"), F.rand(3).alias("x"), (F.col("id") % 50).alias("q"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("describe-scans", "describe")
    try:
        first = profile.describe(df)
        assert len(tracker.getJobIdsForGroup("describe-scans")) <= 4  # two scans, each a map and a merge job at most
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert first.count() == 3


def test_one_hot_vector_of_a_wide_column(spark):
    df = spark.range(6_000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id") % 2_500)).alias("g"))
    got = prep.one_hot_vector(df, "g").collect()
    values = sorted({r["g"] for r in got if r["g"] is not None})
    place = {v: i - 1 for i, v in enumerate(values)}
    assert len(got) == 6_000
    for r in got:
        want = [place[r["g"]]] if r["g"] is not None and place[r["g"]] >= 0 else []
        assert r["g_vec"].size == len(values) - 1 and r["g_vec"].indices.tolist() == want
    one = spark.createDataFrame([("a", 1), (None, 2)], "g string, x int")
    assert [r["g_vec"].size for r in prep.one_hot_vector(one, "g").collect()] == [0, 0]
    none = spark.createDataFrame([(None, 2)], "g string, x int")
    assert prep.one_hot_vector(none, "g").first()["g_vec"].size == 0
