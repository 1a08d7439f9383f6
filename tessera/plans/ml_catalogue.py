"""Model queries of the churn workflow.

The data are the labelled documents described by numbers taken from their texts
(target ``poor``), one-hot encoded and split 60/20/20 by hash rank.  Parameters
are the reference's.  Depth-1 models have an SQL form; deeper ones are checked
by unit tests and rows only.  Every query prepares its data and fits its models
anew: nothing is kept between queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import metrics, models
from tessera.operators import prep as prep_ops
from tessera.plans import fixtures as fx
from tessera.plans.catalogue import SWEEP_FOREST, SWEEP_TREE, THRESHOLD, register

KEY, TARGET, SEED = "doc_id", "poor", 12345


def splits(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """train (with balanced weights) / valid / test of the modelling table."""
    encoded = prep_ops.one_hot(fx.text_features(spark, sf_dir))
    return models.prepared_splits(encoded, KEY, TARGET, seed=SEED)


def _scores(pred: DataFrame) -> DataFrame:
    return models.f1_of(pred)


# ------------------------------------------------------- checked against SQL --

_FEATURES_SQL = """
with words as (
  select d.doc_id, lang, source, n_chars, cast(quality = 0 as int) as poor,
         regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w
  from documents d join labels l on d.doc_id = l.doc_id
  where d.doc_id is not null and text is not null and lang is not null and source is not null
    and n_chars is not null and quality is not null and toxic is not null),
feats as (
  select doc_id, lang, source, n_chars, cast(len(w) as bigint) as n_words,
         cast(100 * len(list_distinct(w)) // greatest(len(w), 1) as bigint) as distinct_pct,
         cast(100 * len([x for x in w if regexp_matches(x, '[#*$%&|<>]')])
              // greatest(len(w), 1) as bigint) as symbol_pct, poor
  from words)
"""

_PARTS_SQL = _FEATURES_SQL + """,
r as (select *, row_number() over (order by md5('12345:' || cast(doc_id as varchar)), doc_id) as rn,
             count(*) over () as n from feats),
s as (select *, n - cast(ceil(0.4 * n) as bigint) as n_train,
             cast(ceil(0.4 * n) as bigint) - cast(ceil(0.5 * cast(ceil(0.4 * n) as bigint)) as bigint)
               as n_valid from r),
parts as (select doc_id, distinct_pct, symbol_pct, poor,
                 case when rn <= n_train then 'train' when rn <= n_train + n_valid then 'valid'
                      else 'test' end as part from s)
"""

_STUMP_SQL = _PARTS_SQL + """,
longer as (
  select 0 as feature, distinct_pct as v, poor from parts where part = 'train' union all
  select 1 as feature, symbol_pct as v, poor from parts where part = 'train'),
vals as (select feature, v, count(*) as n, sum(poor) as p from longer group by feature, v),
cum as (select feature, v, sum(n) over up as nl, sum(p) over up as pl,
               sum(n) over (partition by feature) as nt, sum(p) over (partition by feature) as pt,
               lead(v) over (partition by feature order by v) as nv
        from vals window up as (partition by feature order by v)),
cand as (select feature, (v + nv) / 2.0 as threshold, nl, pl, nt - nl as nr, pt - pl as pr
         from cum where nv is not null),
best as (select * from cand
         order by pl * (nl - pl) / nl + pr * (nr - pr) / nr, feature, threshold limit 1),
leafs as (select doc_id, cast(poor as double) as label,
                 case when (case when feature = 0 then distinct_pct else symbol_pct end) <= threshold
                      then cast(pl as double) / nl else cast(pr as double) / nr end as p1
          from parts cross join best where part = 'test')
"""
STUMP_FEATURES = ["distinct_pct", "symbol_pct"]
# Percents have at most 101 values, so every split point between two values is tried.
STUMP_BINS = 128


def _stump_splits(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    feats = fx.text_features(spark, sf_dir).select(KEY, *STUMP_FEATURES, TARGET)
    return models.prepared_splits(feats, KEY, TARGET, seed=SEED)


@register("ml_features", _FEATURES_SQL + "select * from feats")
def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling table: numbers of every labelled text, and the target."""
    return fx.text_features(spark, sf_dir)


@register("ml_feature_vectors", _PARTS_SQL + """
select doc_id, part, [cast(distinct_pct as double), cast(symbol_pct as double)] as features,
       cast(poor as double) as label from parts""")
def ml_feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors and targets of the three parts of the split."""
    from pyspark.ml.functions import vector_to_array
    s = _stump_splits(spark, sf_dir)
    one = [df.select(KEY, F.lit(part).alias("part"), vector_to_array("features").alias("features"), "label")
           for part, df in s.items()]
    return one[0].unionByName(one[1]).unionByName(one[2])


@register("ml_stump", _STUMP_SQL + """
select doc_id, label, cast(p1 > 0.5 as double) as prediction, p1 from leafs""")
def ml_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification tree of depth 1: class and P(1) of every test row (split
    points are exact while a sample of 16,384 train rows shows every percent)."""
    s = _stump_splits(spark, sf_dir)
    m = models.tree(1, seed=SEED, max_bins=STUMP_BINS).fit(s["train"])
    return models.predict(m, s["test"]).select(KEY, "label", "prediction", "p1")


@register("ml_stump_regressor", _STUMP_SQL + """
select doc_id, label, p1 as prediction from leafs""")
def ml_stump_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression tree of depth 1: the prediction of every test row (variance
    and Gini choose the same split of a 0/1 target)."""
    s = _stump_splits(spark, sf_dir)
    m = models.tree_regressor(1, seed=SEED, max_bins=STUMP_BINS).fit(s["train"])
    return models.predict(m, s["test"]).select(KEY, "label", "prediction")


@register("ml_stump_forest", _STUMP_SQL + """
select doc_id, label, cast(p1 > 0.5 as double) as prediction, round(p1, 9) as p1 from leafs""")
def ml_stump_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest of 10 depth-1 trees without bootstrap (sqrt of two features is
    both): every tree is the same, and so is the vote."""
    s = _stump_splits(spark, sf_dir)
    m = models.forest(10, 1, seed=SEED, max_bins=STUMP_BINS, bootstrap=False).fit(s["train"])
    return models.predict(m, s["test"]).select(KEY, "label", "prediction", F.round("p1", 9).alias("p1"))


@register("ml_stump_scores", _STUMP_SQL + """,
c as (select count_if(label = 1 and p1 > 0.5) as tp, count_if(label = 0 and p1 > 0.5) as fp,
             count_if(label = 0 and not p1 > 0.5) as tn, count_if(label = 1 and not p1 > 0.5) as fn from leafs)
select case when tp + fp > 0 then cast(tp as double) / (tp + fp) else 0.0 end as precision,
       case when tp + fn > 0 then cast(tp as double) / (tp + fn) else 0.0 end as recall,
       case when 2 * tp + fp + fn > 0 then cast(2 * tp as double) / (2 * tp + fp + fn) else 0.0 end as f1,
       cast(tp + tn as double) / (tp + fp + tn + fn) as accuracy from c""")
def ml_stump_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall, F1 and accuracy of the depth-1 tree on test."""
    s = _stump_splits(spark, sf_dir)
    m = models.tree(1, seed=SEED, max_bins=STUMP_BINS).fit(s["train"])
    return _scores(models.predict(m, s["test"]))


@register("ml_linear", _PARTS_SQL + """,
line as (select regr_slope(poor, symbol_pct) as slope, regr_intercept(poor, symbol_pct) as start
         from parts where part = 'train')
select doc_id, cast(poor as double) as label, round(start + slope * symbol_pct, 6) + 0.0 as prediction
from parts cross join line where part = 'test'""")
def ml_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear regression on one feature (normal equation): the prediction of every test row."""
    feats = fx.text_features(spark, sf_dir).select(KEY, "symbol_pct", TARGET)
    s = models.prepared_splits(feats, KEY, TARGET, seed=SEED)
    m = models.ESTIMATORS["LinearRegression"](solver="normal").fit(s["train"])
    return m.transform(s["test"]).select(KEY, "label", (F.round("prediction", 6) + 0.0).alias("prediction"))


@register("ml_stump_forest_regressor", _STUMP_SQL + """
select doc_id, label, round(p1, 9) as prediction from leafs""")
def ml_stump_forest_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression forest of 10 depth-1 trees without bootstrap: every tree is the
    same, and their mean is the stump's prediction of every test row."""
    s = _stump_splits(spark, sf_dir)
    m = models.forest_regressor(10, 1, seed=SEED, max_bins=STUMP_BINS, bootstrap=False).fit(s["train"])
    return models.predict(m, s["test"]).select(KEY, "label", F.round("prediction", 9).alias("prediction"))


@register("ml_logistic", _PARTS_SQL + """,
known as (select p.*, lang from parts p join feats f on p.doc_id = f.doc_id),
share as (select lang, avg(poor) as p1 from known where part = 'train' group by lang),
odds as (select doc_id, poor, coalesce(s.p1, (select p1 from share where lang = (select min(lang) from known))) as p1
         from known k left join share s on k.lang = s.lang where part = 'test')
select doc_id, cast(poor as double) as label, round(p1 + 1e-7, 5) as p1, cast(p1 > 0.5 as double) as prediction
from odds""")
def ml_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on the one-hot language: class and P(1) of every test row.

    Its likelihood is largest where P(1) is each language's share of the target in train, which
    is what the SQL says.  The 1e-7 keeps exact halves of the last digit on one side."""
    feats = prep_ops.one_hot(fx.text_features(spark, sf_dir).select(KEY, "lang", TARGET))
    s = models.prepared_splits(feats, KEY, TARGET, seed=SEED)
    return models.predict(models.logistic().fit(s["train"]), s["test"]).select(
        KEY, "label", F.round(F.col("p1") + 1e-7, 5).alias("p1"), "prediction")


# ------------------------------------------------------------ trees, forests --

@register("ml_tree_regressor")
def ml_tree_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression tree (unlimited depth) used as a classifier: F1 on valid."""
    s = splits(spark, sf_dir)
    m = models.tree_regressor(seed=SEED).fit(s["train"])
    return _scores(models.predict(m, s["valid"]))


@register("ml_forest")
def ml_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest with the library defaults (100 trees, unlimited depth): F1 on valid."""
    s = splits(spark, sf_dir)
    m = models.forest(seed=SEED).fit(s["train"])
    return _scores(models.predict(m, s["valid"]))


@register("ml_tree")
def ml_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree, depth 7, leaf 9, split 3, balanced weights: F1 on valid."""
    s = splits(spark, sf_dir)
    m = models.tree(7, min_leaf=9, weighted=True, seed=SEED).fit(s["train"])
    return _scores(models.predict(m, s["valid"]))


@register("ml_tree_depth_sweep")
def ml_tree_depth_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced trees of depth 1..15, each fitted: F1 on valid for every depth."""
    s = splits(spark, sf_dir)
    return models.tree_depth_sweep(spark, s["train"], s["valid"], range(1, 16), weighted=True,
                                   seed=SEED)


@register("ml_tree_threshold_sweep")
def ml_tree_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree depth 7, leaf 10: precision/recall/F1 of P(1) > t, 45 thresholds."""
    s = splits(spark, sf_dir)
    m = models.tree(7, min_leaf=10, seed=SEED).fit(s["train"])
    pred = models.predict(m, s["valid"])
    return metrics.threshold_sweep(pred, "label", "p1", metrics.threshold_grid(*SWEEP_TREE))


@register("ml_sweep")
def ml_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced forests, depth 1..15 x 10..50 trees, each fitted: accuracy (and F1) on valid."""
    s = splits(spark, sf_dir)
    return models.forest_sweep(spark, s["train"], s["valid"], range(1, 16), range(10, 60, 10),
                               weighted=True, seed=SEED)


@register("ml_sweep_best")
def ml_sweep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best forest of the sweep by accuracy; the first in loop order wins ties."""
    return models.best_of(ml_sweep(spark, sf_dir), "accuracy", ["max_depth", "n_trees"])


def _tuned_forest(s: dict[str, DataFrame], weighted: bool):
    """The reference's final forest: 50 trees, depth 11, leaf 3, split 4."""
    return models.forest(50, 11, min_leaf=3, weighted=weighted, seed=SEED).fit(s["train"])


@register("ml_forest_tuned")
def ml_forest_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest, 50 trees, depth 11, leaf 3, split 4, balanced: F1 on valid."""
    s = splits(spark, sf_dir)
    return _scores(models.predict(_tuned_forest(s, True), s["valid"]))


@register("ml_forest_threshold_sweep")
def ml_forest_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unweighted tuned forest: precision/recall/F1 of P(1) > t, 40 thresholds."""
    s = splits(spark, sf_dir)
    pred = models.predict(_tuned_forest(s, False), s["valid"])
    return metrics.threshold_sweep(pred, "label", "p1", metrics.threshold_grid(*SWEEP_FOREST))


@register("ml_forest_pr_curve")
def ml_forest_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision-recall curve of the unweighted tuned forest on valid."""
    s = splits(spark, sf_dir)
    return metrics.pr_curve(models.predict(_tuned_forest(s, False), s["valid"]), "label", "p1")


@register("ml_forest_test")
def ml_forest_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-set F1 of the two final variants: balanced weights, and
    unweighted with threshold 0.36."""
    s = splits(spark, sf_dir)
    a = _scores(models.predict(_tuned_forest(s, True), s["test"])).select(
        F.lit("balanced").alias("variant"), "*")
    b = _scores(models.predict(_tuned_forest(s, False), s["test"], threshold=THRESHOLD)).select(
        F.lit("threshold_0.36").alias("variant"), "*")
    return a.unionByName(b)


@register("ml_roc_curve")
def ml_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curve of the unweighted tuned forest on test."""
    s = splits(spark, sf_dir)
    return metrics.roc_curve(models.predict(_tuned_forest(s, False), s["test"]), "label", "p1")


@register("ml_roc_auc")
def ml_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC AUC of the unweighted tuned forest on test."""
    s = splits(spark, sf_dir)
    return metrics.roc_auc(models.predict(_tuned_forest(s, False), s["test"]), "label", "p1")


@register("ml_predictions")
def ml_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``predict`` and ``predict_proba[:, 1]`` of the unweighted tuned forest
    for every test row: (doc_id, label, prediction, p1)."""
    s = splits(spark, sf_dir)
    return models.predict(_tuned_forest(s, False), s["test"]).select(KEY, "label", "prediction", "p1")


# --------------------------------------------------------------- grid search --

# The reference's two search grids.
TREE_GRID = {"max_depth": range(1, 11), "min_leaf": range(1, 11), "min_split": range(2, 10)}
FOREST_GRID = {"max_depth": range(1, 13, 2), "n_trees": range(10, 51, 10),
               "min_leaf": range(1, 11), "min_split": range(2, 10, 2)}


def _best(spark: SparkSession, s: dict[str, DataFrame], table: DataFrame) -> DataFrame:
    """The best candidate with the scores on valid of its model, refitted on train."""
    refit = models.refit_best(spark, table, s["train"], s["valid"], KEY, seed=SEED)
    scores = _scores(refit).select(F.lit(1).cast("long").alias("rank"), "precision", "recall", "f1", "accuracy")
    return table.filter(F.col("rank") == 1).join(scores, "rank")


@register("ml_grid")
def ml_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree grid search (800 candidates, 5 stratified folds, accuracy)."""
    s = splits(spark, sf_dir)
    return models.tree_grid_search(spark, s["train"], KEY, **TREE_GRID, k=5, seed=SEED)


@register("ml_grid_best")
def ml_grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``grid.best_params_`` of the tree search, and its refitted model's scores on valid."""
    s = splits(spark, sf_dir)
    return _best(spark, s, models.tree_grid_search(spark, s["train"], KEY, **TREE_GRID, k=5, seed=SEED))


@register("ml_forest_grid")
def ml_forest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest grid search (1,200 candidates, 5 stratified folds, accuracy)."""
    s = splits(spark, sf_dir)
    return models.forest_grid_search(spark, s["train"], KEY, **FOREST_GRID, k=5, seed=SEED)


@register("ml_forest_grid_best")
def ml_forest_grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``grid.best_params_`` of the forest search, and its refitted model's scores on valid."""
    s = splits(spark, sf_dir)
    return _best(spark, s, models.forest_grid_search(spark, s["train"], KEY, **FOREST_GRID, k=5, seed=SEED))
