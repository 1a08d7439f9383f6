"""Curves and scores against an independent NumPy implementation of the
library rules (the library itself is not installed)."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics


def _np_curve(y, s):
    order = np.argsort(-s, kind="mergesort")
    y, s = y[order], s[order]
    idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[idx]
    fps = (1 + idx) - tps
    return s[idx], tps, fps


def _np_roc(y, s):
    thr, tps, fps = _np_curve(y, s)
    if len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        thr, tps, fps = thr[keep], tps[keep], fps[keep]
    return (np.r_[np.inf, thr], np.r_[0, fps] / fps[-1], np.r_[0, tps] / tps[-1])


@pytest.fixture(scope="module")
def sample(spark):
    rnd = np.random.default_rng(11)
    s = np.round(rnd.random(2000) * 20) / 20  # many ties, collinear runs
    y = (rnd.random(2000) < s * 0.8).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    return df, y, s


def test_roc_curve_drops_collinear(sample):
    df, y, s = sample
    got = sorted(metrics.roc_curve(df, "y", "score").collect(), key=lambda r: -r["threshold"])
    thr, fpr, tpr = _np_roc(y, s)
    assert len(got) == len(thr)
    for r, t, f, p in zip(got, thr, fpr, tpr):
        assert r["threshold"] == t and math.isclose(r["fpr"], f) and math.isclose(r["tpr"], p)


def test_roc_auc_exact(sample):
    df, y, s = sample
    thr, fpr, tpr = _np_roc(y, s)
    exp = np.trapezoid(tpr, fpr)
    got = metrics.roc_auc(df, "y", "score").first()["auc"]
    assert math.isclose(got, exp, rel_tol=1e-12)


def test_pr_curve(sample):
    df, y, s = sample
    thr, tps, fps = _np_curve(y, s)
    got = metrics.pr_curve(df, "y", "score").collect()
    end = [r for r in got if r["threshold"] is None]
    assert len(end) == 1 and end[0]["precision"] == 1.0 and end[0]["recall"] == 0.0
    pts = {r["threshold"]: (r["precision"], r["recall"]) for r in got if r["threshold"] is not None}
    for t, tp, fp in zip(thr, tps, fps):
        assert pts[t] == (tp / (tp + fp), tp / tps[-1])


def test_threshold_sweep_matches_loop(sample):
    df, y, s = sample
    grid = metrics.threshold_grid(0, 0.9, 0.02)
    assert len(grid) == 45
    got = {r["threshold"]: r for r in metrics.threshold_sweep(df, "y", "score", grid).collect()}
    for t in grid:
        p = s > t
        tp, fp, fn = int((p & (y == 1)).sum()), int((p & (y == 0)).sum()), int((~p & (y == 1)).sum())
        r = got[t]
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert r["f1"] == (2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)


def test_threshold_above_all_scores(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.1)], "y int, score double")
    r = metrics.threshold_sweep(df, "y", "score", [0.5]).first()
    assert (r["tp"], r["fp"], r["precision"], r["recall"], r["f1"]) == (0, 0, 0.0, 0.0, 0.0)


def test_single_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.1)], "y int, score double")
    assert metrics.roc_auc(df, "y", "score").first()["auc"] is None


def test_confusion_and_accuracy(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.1), (0, 0.0)], "y int, score double")
    r = metrics.scores(df, "y", F.col("score") > 0.5).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (1, 1, 1, 1)
    assert r["precision"] == 0.5 and r["recall"] == 0.5 and r["f1"] == 0.5
    assert metrics.accuracy(df, "y", F.col("score") > 0.5).first()["accuracy"] == 0.5


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=200)
       .filter(lambda r: len({y for y, _ in r}) == 2))
def test_curve_properties(spark, rows):
    df = spark.createDataFrame([(y, s / 20) for y, s in rows], "y int, score double")
    roc = sorted(metrics.roc_curve(df, "y", "score").collect(), key=lambda r: -r["threshold"])
    assert roc[0]["fpr"] == 0 and roc[0]["tpr"] == 0 and roc[-1]["fpr"] == 1 and roc[-1]["tpr"] == 1
    assert all(a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"] for a, b in zip(roc, roc[1:]))
    auc = metrics.roc_auc(df, "y", "score").first()["auc"]
    # AUC = P(score_pos > score_neg) + P(tie) / 2 (Mann-Whitney)
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    mw = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert 0 <= auc <= 1 and math.isclose(auc, mw, rel_tol=1e-12)


def test_auc_agrees_with_spark_evaluator(sample):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df, _, _ = sample
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    spark_auc = ev.evaluate(df.select(F.col("score"), F.col("y").cast("double").alias("label")))
    ours = metrics.roc_auc(df, "y", "score").first()["auc"]
    assert math.isclose(ours, spark_auc, rel_tol=1e-12)
