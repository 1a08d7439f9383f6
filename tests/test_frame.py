"""Missing-value rules, joins, aggregates, top-k: pandas as the second oracle."""
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import frame


def _kv(spark):
    rows = [("a", 1.0), ("a", None), (None, 3.0), ("b", None), ("c", float("nan")), ("c", 2.0)]
    return spark.createDataFrame(rows, "k string, v double"), pd.DataFrame(rows, columns=["k", "v"])


def test_group_mean_sum_match_pandas(spark):
    sdf, pdf = _kv(spark)
    got = {r["k"]: (r["v_mean"], r["v_sum"]) for r in
           frame.group_agg(sdf, "k", {"v": ["mean", "sum"]}).collect()}
    exp = pdf.groupby("k")["v"].agg(["mean", "sum"])
    assert set(got) == set(exp.index) == {"a", "b", "c"}
    for k, (m, s) in got.items():
        em, es = exp.loc[k, "mean"], exp.loc[k, "sum"]
        assert (m is None and math.isnan(em)) or m == em
        assert s == es


def test_total_and_count_where(spark):
    sdf, pdf = _kv(spark)
    assert frame.total(sdf, {"v": "sum"}).first()["v_sum"] == pdf["v"].sum()
    r = frame.count_where(sdf, {"is_a": F.col("k") == "a"}, share=True).first()
    assert r["is_a"] == 2 / 6


def test_left_join_null_safe_matches_pandas(spark):
    left = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    right = spark.createDataFrame([(None, 7), (2, 8), (2, 9)], "k int, v int")
    got = sorted(frame.left_join(left, right, "k", null_safe=True).collect(),
                 key=lambda r: (r.k is None, r.k or 0, r.v or 0))
    exp = pd.DataFrame({"k": [1, None, 2]}).merge(
        pd.DataFrame({"k": [None, 2, 2], "v": [7, 8, 9]}), on="k", how="left")
    assert len(got) == len(exp) == 4
    assert [(r.k, r.v) for r in got] == [(1, None), (2, 8), (2, 9), (None, 7)]


def test_left_join_suffixes_overlap(spark):
    left = spark.createDataFrame([(1, "x")], "k int, name string")
    right = spark.createDataFrame([(1, "y")], "k int, name string")
    out = frame.left_join(left, right, "k")
    assert out.columns == ["k", "name_x", "name_y"]


def test_drop_columns_unknown_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        frame.drop_columns(df, ["c"])
    assert frame.drop_columns(df, ["a"]).columns == ["b"]


def test_lower_case_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`P` int, `q` int")
    assert frame.lower_case_columns(df).columns == ["p", "q"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df2 = spark.createDataFrame([(1, 2)], "`p` int, `P` int")
        with pytest.raises(ValueError):
            frame.lower_case_columns(df2)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_drop_missing_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, s string")
    assert frame.drop_missing(df).count() == 1


def test_null_share_and_shape(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r["column_name"]: r["null_share"] for r in frame.null_share(df).collect()}
    assert got == {"a": 1 / 3, "b": 2 / 3}
    r = frame.shape(df).first()
    assert (r["n_rows"], r["n_columns"]) == (3, 2)


def test_top_k_nulls_last_and_tie_break(spark):
    df = spark.createDataFrame([(None, 1), (2.0, 2), (1.0, 3), (1.0, 0)], "p double, id int")
    got = [tuple(r) for r in frame.top_k(df, "p", 2, tie_break=["id"]).collect()]
    assert got == [(1.0, 0), (1.0, 3)]
    plan = frame.top_k(df, "p", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_empty_table_aggregates(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert frame.group_agg(df, "k", {"v": "sum"}).count() == 0
    assert frame.total(df, {"v": "sum"}).first()["v_sum"] == 0
