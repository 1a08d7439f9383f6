"""Model plumbing: searches and sweeps equal direct fits; cuts; prediction."""
import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import pytest

from tessera.operators import models


def _data(spark, n=400, seed=3):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(0, 10, size=(n, 4)).astype(float)
    y = ((x[:, 0] + x[:, 1] * 0.5 + rnd.normal(0, 2, n)) > 7).astype(float)
    rows = [(i, Vectors.dense(x[i].tolist()), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, ["k", "features", "label"])


def _by_key(df, *columns):
    return {r["k"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_leaf_table_reproduces_tree_and_forest(spark):
    df = _data(spark)
    for est in (models.tree(6, min_leaf=2, seed=1), models.forest(7, 5, seed=3), models.tree(0, seed=1)):
        m = est.fit(df)
        n = est.getNumTrees() if est.hasParam("numTrees") else 1
        got = _by_key(models.cut_probabilities(spark, m, df, "k", [(None, 0)], [n]), f"p_0_{n}")
        for k, (p1,) in _by_key(models.predict(m, df), "p1").items():
            assert abs(got[k][0] - p1) < 1e-12


def test_depth_cut_equals_direct_fit(spark):
    df = _data(spark)
    full = models.tree(8, min_leaf=3, seed=1).fit(df)
    depths = (1, 2, 4)
    got = _by_key(models.cut_probabilities(spark, full, df, "k", [(d, 2) for d in depths]),
                  *[f"p_{i}_1" for i in range(3)])
    for i, d in enumerate(depths):
        direct = models.predict(models.tree(d, min_leaf=3, seed=1).fit(df), df)
        for k, (prediction,) in _by_key(direct, "prediction").items():
            assert (got[k][i] > 0.5) == (prediction == 1.0)


def test_min_split_cuts_small_nodes(spark):
    df = _data(spark)
    m = models.tree(8, min_leaf=1, seed=1).fit(df)
    cut = models.leaf_values(spark, m, [(None, 0), (None, 40), (None, 10**9)])
    cut = [(t, leaf, [share[1] for share in v]) for t, leaf, v in cut]
    assert len({v[2] for _, _, v in cut}) == 1  # nothing may split: the root's share
    assert len({v[1] for _, _, v in cut}) < len({v[0] for _, _, v in cut}) or len(cut) < 10


def test_grid_candidates_equal_direct_fits(spark):
    df = _data(spark, 240)
    rows = models.tree_grid_search(spark, df, "k", [2, 4], [1, 3], [2], k=3, seed=12345, parallelism=4).collect()
    folds = models._folds(df, "k", 3, 12345)
    for r in rows:
        direct = []
        for f in range(3):
            m = models.tree(r["max_depth"], min_leaf=r["min_samples_leaf"]).fit(folds.filter(F.col("fold") != f))
            direct.append(models.f1_of(models.predict(m, folds.filter(F.col("fold") == f))).first()["accuracy"])
        assert abs(r["mean_accuracy"] - sum(direct) / 3) < 1e-12


def test_refit_best_is_the_winner_fitted_on_all_of_train(spark):
    df = _data(spark, 240)
    table = models.tree_grid_search(spark, df, "k", [1, 3], [2], [2], k=3)
    best = table.filter("rank = 1").first()
    m = models.tree(best["max_depth"], min_leaf=2).fit(df)
    got = _by_key(models.refit_best(spark, table, df, df, "k"), "p1")
    for k, (p1,) in _by_key(models.predict(m, df), "p1").items():
        assert abs(got[k][0] - p1) < 1e-12


def test_tree_grid_search_shape_and_rank(spark):
    df = _data(spark, 300)
    res = models.tree_grid_search(spark, df, "k", max_depth=[1, 3], min_leaf=[1, 4],
                                  min_split=[2, 9], k=3, parallelism=4)
    rows = res.collect()
    assert len(rows) == 8 and sorted(r["rank"] for r in rows) == list(range(1, 9))
    best = [r for r in rows if r["rank"] == 1][0]
    assert best["mean_accuracy"] == max(r["mean_accuracy"] for r in rows)


def test_sweep_and_predict(spark):
    df = _data(spark, 200)
    res = models.sweep(spark, df, df, models.product_grid(max_depth=[1, 3]),
                       lambda max_depth: models.tree(max_depth, seed=1), parallelism=2)
    assert res.count() == 2 and set(res.columns) >= {"max_depth", "f1", "accuracy"}
    m = models.forest(5, 3, seed=1).fit(df)
    p = models.predict(m, df, threshold=0.5)
    assert p.filter(F.col("pred") != (F.col("p1") > 0.5)).count() == 0


def test_forest_independent_of_input_partitioning(spark):
    df = _data(spark, 300)
    a = models.fixed_layout(df.repartition(1), "k", 300)
    b = models.fixed_layout(df.repartition(5), "k", 300)
    ma = models.forest(10, 4, seed=7).fit(a)
    mb = models.forest(10, 4, seed=7).fit(b)
    pa = sorted(models.predict(ma, df).select("k", "p1").collect())
    pb = sorted(models.predict(mb, df).select("k", "p1").collect())
    assert pa == pb


def test_save_and_load(spark):
    from pyspark.ml.classification import DecisionTreeClassificationModel

    from tessera.session import scratch_dir
    df = _data(spark, 100)
    m = models.tree(3, seed=1).fit(df)
    p = models.save(m, scratch_dir(spark, "model"))
    back = models.load(DecisionTreeClassificationModel, p)
    assert back.toDebugString.split("\n", 1)[1] == m.toDebugString.split("\n", 1)[1]


def test_forest_grid_search_shape(spark):
    df = _data(spark, 200)
    res = models.forest_grid_search(spark, df, "k", max_depth=[2, 4], n_trees=[3, 6],
                                    min_leaf=[1, 3], min_split=[2, 8], k=3, parallelism=4)
    rows = res.collect()
    assert len(rows) == 16 and sorted(r["rank"] for r in rows) == list(range(1, 17))


def test_tree_depth_sweep_equals_direct_fits(spark):
    df = _data(spark, 300)
    got = {r["max_depth"]: r["accuracy"] for r in
           models.tree_depth_sweep(spark, df, df, [1, 2, 5], min_leaf=2, seed=1).collect()}
    for d in (1, 2, 5):
        m = models.tree(d, min_leaf=2, seed=1).fit(df)
        assert got[d] == models.f1_of(models.predict(m, df)).first()["accuracy"]


def test_forest_sweep_rows_equal_direct_fits_for_every_tree_count(spark):
    df = _data(spark, 200)
    got = {(r["max_depth"], r["n_trees"]): r["accuracy"] for r in
           models.forest_sweep(spark, df, df, [2, 4], [3, 7], seed=5, parallelism=2).collect()}
    for (d, n), accuracy in got.items():
        m = models.forest(n, d, seed=5).fit(df)
        assert accuracy == models.f1_of(models.predict(m, df)).first()["accuracy"]
    assert len(got) == 4


def test_depth_limits():
    assert models.tree(None).getMaxDepth() == models.MAX_DEPTH and models.tree(0).getMaxDepth() == 0
    for make in (models.tree, models.tree_regressor):
        with pytest.raises(ValueError):
            make(31)
    with pytest.raises(ValueError):
        models.forest(5, 31)
    assert models.forest(5, 3, max_bins=64).getMaxBins() == 64


def test_cross_validate_with_stratified_folds(spark):
    df = _data(spark, 240)
    table, best = models.cross_validate(spark, df, "k", models.tree(seed=1),
                                        {"maxDepth": [1, 3]}, k=3, parallelism=2)
    rows = table.collect()
    assert len(rows) == 2 and all(0 <= r["accuracy"] <= 1 for r in rows)
    top = max(rows, key=lambda r: r["accuracy"])
    assert best.getOrDefault("maxDepth") == top["maxDepth"]


def test_forest_grid_candidates_equal_direct_fits(spark):
    df = _data(spark, 240)
    rows = models.forest_grid_search(spark, df, "k", max_depth=[1, 2, 5, 9], n_trees=[5], min_leaf=[1, 8],
                                     min_split=[2], k=3, parallelism=4).collect()
    folds = models._folds(df, "k", 3, 12345)
    for r in rows:
        direct = []
        for f in range(3):
            m = models.forest(5, r["max_depth"], min_leaf=r["min_samples_leaf"]).fit(folds.filter(F.col("fold") != f))
            direct.append(models.f1_of(models.predict(m, folds.filter(F.col("fold") == f))).first()["accuracy"])
        assert abs(r["mean_accuracy"] - sum(direct) / 3) < 1e-12


@pytest.mark.parametrize("seed, min_leaf", [(1, 1), (2, 1), (3, 4), (4, 9)])
def test_depth_cut_of_a_forest_equals_direct_fits_in_every_tree(spark, seed, min_leaf):
    df = _data(spark, 300, seed)
    deep = models.forest(20, 11, min_leaf=min_leaf, seed=seed).fit(df)
    depths = [0, 1, 3, 5, 7, 9, 11]
    shares = models.with_votes(spark, deep, df, [(d, 0) for d in depths])
    got = {r["k"]: r for r in shares.collect()}
    for i, d in enumerate(depths):
        direct = models.forest(20, d, min_leaf=min_leaf, seed=seed).fit(df)
        for r in models.with_votes(spark, direct, df, [(None, 0)]).collect():
            assert r["__v0_1"] == got[r["k"]][f"__v{i}_1"] and r["__v0_0"] == got[r["k"]][f"__v{i}_0"]


def test_wide_levels_are_fitted_depth_by_depth(spark, monkeypatch):
    df = _data(spark, 200)
    want = models.forest_sweep(spark, df, df, [2, 4], [3], seed=5).collect()
    monkeypatch.setattr(models, "shares_depths", lambda *_: False)
    assert models.forest_sweep(spark, df, df, [2, 4], [3], seed=5).collect() == want


def test_scoring_a_search_shuffles_no_rows(spark):
    df = _data(spark)
    m = models.forest(7, 5, seed=3).fit(df)
    p = models.cut_probabilities(spark, m, df, "k", [(None, 0), (None, 8)], [3, 7])
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan


def test_two_valued_features_count_two_bins_and_cuts_are_scored_in_parts(spark, monkeypatch):
    rows = [(i, Vectors.dense([float(i % 37), float(i % 2), 1.0]), float(i % 5 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, ["k", "features", "label"])
    assert models.feature_bins(df) == [models.MAX_BINS, 2, 2]
    assert models.feature_bins(df.limit(0)) == []
    # four numbers and 22 dummies: every forest of the sweep shares one fit; 26 numbers would not
    assert models.shares_depths(50, 15, [32] * 4 + [2] * 22)
    assert not models.shares_depths(50, 15, [32] * 26)
    want = models.forest_sweep(spark, df, df, [1, 3, 5], [4], seed=5).collect()
    monkeypatch.setattr(models, "VOTE_VALUES", 1)
    assert models.forest_sweep(spark, df, df, [1, 3, 5], [4], seed=5).collect() == want
