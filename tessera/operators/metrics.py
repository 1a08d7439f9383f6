"""Binary-classification metrics and curves as DataFrame jobs (no collect of rows).

Counts follow the reference's library rules: precision, recall and F1 are
0 when undefined; the precision-recall curve has one point per distinct score
plus the end point (recall 0, precision 1); the ROC curve drops collinear
points and starts at (0, 0) with threshold +inf; AUC is the trapezoid area,
computed here exactly from integer counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import ordered


def threshold_grid(start: float, stop: float, step: float) -> list[float]:
    """``np.arange(start, stop, step)`` for floats: ``start + k * step``,
    ``ceil((stop - start) / step)`` points, never accumulated."""
    n = max(0, math.ceil((stop - start) / step))
    return [start + k * step for k in range(n)]


def _ratio(num: Column, den: Column) -> Column:
    """num / den as one IEEE division; 0.0 when den is 0 (library default)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def precision_col(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def recall_col(tp: Column, fn: Column) -> Column:
    return _ratio(tp, tp + fn)


def f1_col(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def confusion(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """(tp, fp, tn, fn) in one aggregate pass; ``pred`` is a boolean column."""
    y = F.col(label) == 1
    return df.agg(F.count_if(y & pred).alias("tp"), F.count_if(~y & pred).alias("fp"),
                  F.count_if(~y & ~pred).alias("tn"), F.count_if(y & ~pred).alias("fn"))


def scores(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """Confusion counts with precision, recall, F1 and accuracy (one pass)."""
    c = confusion(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select("tp", "fp", "tn", "fn",
                    precision_col(tp, fp).alias("precision"), recall_col(tp, fn).alias("recall"),
                    f1_col(tp, fp, fn).alias("f1"),
                    _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"))


def accuracy(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """Share of rows where the prediction equals the label (``model.score``)."""
    hit = (F.col(label) == 1) == pred
    return df.agg((F.count_if(hit).cast("double") / F.count(F.lit(1))).alias("accuracy"))


def threshold_sweep(df: DataFrame, label: str, score: str,
                    thresholds: Sequence[float]) -> DataFrame:
    """Precision, recall and F1 of ``score > t`` for every threshold, in one job.

    Each row is binned by how many thresholds lie strictly below its score
    (a comparison against the sorted threshold array in the JVM), so the
    shuffle carries at most ``len(thresholds) + 1`` partial rows per task.
    Counts for threshold ``k`` are then the suffix sums over bins ``> k`` —
    a window over a table bounded by the number of thresholds.
    """
    thr = sorted(float(t) for t in thresholds)
    spark = df.sparkSession
    arr = F.array(*[F.lit(t) for t in thr])
    # NaN is above no threshold, as in the reference
    value = F.when(~F.isnan(F.col(score).cast("double")), F.col(score))
    binned = df.select(F.size(F.filter(arr, lambda t: t < value)).alias("b"),
                       F.col(label).cast("long").alias("y"))
    per_bin = binned.groupBy("b").agg(F.sum("y").alias("pos"),
                                      F.sum(1 - F.col("y")).alias("neg"))
    grid = spark.createDataFrame([(i, thr[i - 1] if i > 0 else None) for i in range(len(thr) + 1)],
                                 "b int, threshold double")
    full = grid.join(F.broadcast(per_bin), "b", "left").na.fill(0, ["pos", "neg"])
    # ``full`` has len(thresholds) + 1 rows: an unpartitioned window is bounded.
    w = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy(F.lit(0))
    suffix = full.select("b", "threshold", F.sum("pos").over(w).alias("tp"),
                         F.sum("neg").over(w).alias("fp"), F.sum("pos").over(tot).alias("p"))
    # threshold k counts bins b >= k + 1, i.e. the suffix at b = k + 1; the
    # threshold itself was stored on row b = k + 1.
    out = suffix.filter(F.col("b") >= 1)
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("p") - tp
    return out.select("threshold", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                      precision_col(tp, fp).alias("precision"), recall_col(tp, fn).alias("recall"),
                      f1_col(tp, fp, fn).alias("f1"))


def best_threshold(sweep: DataFrame, metric: str = "f1") -> DataFrame:
    """The threshold with the highest metric; the lowest threshold wins ties."""
    return sweep.orderBy(F.col(metric).desc(), F.col("threshold").asc()).limit(1)


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg) per distinct score, ordered for curves: running
    counts from the highest score down (``cum_pos``, ``cum_neg``), next
    lower score's counts (``next_pos``, ``next_neg``) and totals."""
    per = (df.filter(F.col(score).isNotNull())
           .groupBy(F.col(score).alias("score"))
           .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                F.sum(1 - F.col(label).cast("long")).alias("neg")))
    return ordered.ordered_index(per, ["score"], descending=True, sums=["pos", "neg"],
                                 lead_cols=["pos", "neg"])


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, precision, recall): one point per distinct score, plus the
    end point (NULL threshold, precision 1, recall 0)."""
    c = score_counts(df, label, score)
    pts = c.select(F.col("score").alias("threshold"),
                   (F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg")))
                   .alias("precision"),
                   F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos")).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)],
                                          "threshold double, precision double, recall double")
    return pts.unionByName(end)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) with collinear points dropped and (+inf, 0, 0) first."""
    c = score_counts(df, label, score)
    keep = ((F.col("__rank") == 1) | F.col("next_pos").isNull()
            | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
    pts = c.filter(keep).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("tot_neg")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(math.inf, 0.0, 0.0)],
                                            "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, exact: sum over scores of
    neg * (2 * positives above + pos), over 2 * P * N (NULL with one class)."""
    c = score_counts(df, label, score)
    term = (F.col("neg").cast("decimal(38,0)")
            * (2 * F.col("cum_pos") - F.col("pos")).cast("decimal(38,0)"))
    return c.agg(
        (F.sum(term).cast("double") / 2
         / F.nullif(F.max("tot_pos").cast("double") * F.max("tot_neg"), F.lit(0.0)))
        .alias("auc"))
