"""Model fitting, prediction, sweeps and search with ``pyspark.ml``.

Trees and forests are Spark's; what is ours is the plumbing that makes the
reference's workflow reproducible at scale:

* the feature matrix is a ``VectorAssembler`` column; the split is the exact
  hash-rank split; class weights are the 'balanced' weights joined back;
* the training set is checkpointed once (shared folder) and laid out in a
  fixed number of partitions sorted by key, so a forest with the same seed
  gives the same model on any cluster size;
* sweeps fit candidates concurrently from a driver thread pool (each fit is
  a set of cluster jobs) and return a DataFrame of (params..., metric);
* grid search uses stratified folds; candidates that differ only in where
  growth stops share a fit: Spark's ``leafCol`` gives each row's leaf, and the
  leaf's value under every cut is looked up in constants read from the fitted
  model, so that the candidates of a fold are scored in one aggregation.

Library defaults of the reference that differ from Spark's are restated:
forests have 100 trees and unlimited depth (Spark allows at most 30), and
consider sqrt(features) per split.
"""

from __future__ import annotations

import itertools
import json
import math
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import metrics, prep

MAX_DEPTH = 30          # Spark's limit; stands for "unlimited"
FOREST_TREES = 100      # the reference library's default forest size
ROWS_PER_PARTITION = 20_000
DEFAULT_PARALLELISM = 8
# Split candidates per feature, unless the caller says otherwise.
MAX_BINS = 32

# Estimators by the reference's names (imported there; the classifier and
# regressor trees and the classifier forest are the ones it calls).
ESTIMATORS: dict[str, type] = {
    "DecisionTreeClassifier": DecisionTreeClassifier,
    "DecisionTreeRegressor": DecisionTreeRegressor,
    "RandomForestClassifier": RandomForestClassifier,
    "RandomForestRegressor": RandomForestRegressor,
    "LogisticRegression": LogisticRegression,
    "LinearRegression": LinearRegression,
}


# ------------------------------------------------------------ data layout --

def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric and boolean columns that are not keys or targets."""
    return [f.name for f in df.schema.fields if f.name not in exclude and
            isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def assemble(df: DataFrame, features: Sequence[str], label: str,
             keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., features vector, label double)."""
    cast = df.select(*[F.col(c) for c in keep],
                     *[F.col(c).cast("double").alias(c) for c in features],
                     F.col(label).cast("double").alias("label"))
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return va.transform(cast).select(*keep, "features", "label")


def fixed_layout(df: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Fixed partition count (from the row count) and key order within each
    partition, checkpointed: fits then do not depend on the cluster's layout."""
    n_parts = max(1, math.ceil(n_rows / ROWS_PER_PARTITION))
    return df.repartition(n_parts, key).sortWithinPartitions(key).checkpoint(eager=True)


def prepared_splits(df: DataFrame, key: str, label: str, seed: int = 12345) -> dict[str, DataFrame]:
    """train / valid / test frames ready for ``fit``: (key, features, label), and
    in train the balanced class ``weight`` (read by weighted estimators only)."""
    feats = feature_columns(df, [key, label])
    parts = prep.split_three(df, key, seed=seed).checkpoint(eager=True)
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    out = {}
    for name in ("train", "valid", "test"):
        a = assemble(parts.filter(F.col("part") == name), feats, label, keep=[key])
        if name == "train":
            a = prep.balanced_weights(a, "label", "weight")
        out[name] = fixed_layout(a, key, sizes.get(name, 0))
    return out


# ------------------------------------------------------------- estimators --

def depth_limit(max_depth: int | None) -> int:
    """Spark's depth limit: None stands for unlimited (``MAX_DEPTH``); a larger number raises."""
    if max_depth is None:
        return MAX_DEPTH
    if not 0 <= max_depth <= MAX_DEPTH:
        raise ValueError(f"depth {max_depth} is not between 0 and {MAX_DEPTH}")
    return max_depth


def tree(max_depth: int | None = None, min_leaf: int = 1, weighted: bool = False,
         seed: int = 12345, max_bins: int = MAX_BINS) -> DecisionTreeClassifier:
    est = DecisionTreeClassifier(maxDepth=depth_limit(max_depth),
                                 minInstancesPerNode=min_leaf, seed=seed, maxBins=max_bins)
    if weighted:
        est.setWeightCol("weight")
    return est


def tree_regressor(max_depth: int | None = None, min_leaf: int = 1,
                   seed: int = 12345, max_bins: int = MAX_BINS) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=depth_limit(max_depth), maxBins=max_bins,
                                 minInstancesPerNode=min_leaf, seed=seed)


def forest(n_trees: int = FOREST_TREES, max_depth: int | None = None, min_leaf: int = 1,
           weighted: bool = False, seed: int = 12345, max_bins: int = MAX_BINS,
           bootstrap: bool = True) -> RandomForestClassifier:
    est = RandomForestClassifier(numTrees=n_trees, maxDepth=depth_limit(max_depth), maxBins=max_bins,
                                 minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt",
                                 bootstrap=bootstrap, seed=seed)
    if weighted:
        est.setWeightCol("weight")
    return est


def forest_regressor(n_trees: int = FOREST_TREES, max_depth: int | None = None, min_leaf: int = 1,
                     seed: int = 12345, max_bins: int = MAX_BINS, bootstrap: bool = True) -> RandomForestRegressor:
    """Forest of regression trees; every split may use all features (the reference library's default)."""
    return RandomForestRegressor(numTrees=n_trees, maxDepth=depth_limit(max_depth), maxBins=max_bins,
                                 minInstancesPerNode=min_leaf, featureSubsetStrategy="all",
                                 bootstrap=bootstrap, seed=seed)


def logistic(max_iter: int = 500, tol: float = 1e-12) -> LogisticRegression:
    """Logistic regression without a penalty, iterated until the likelihood stands still."""
    return LogisticRegression(maxIter=max_iter, tol=tol, regParam=0.0)


# ---------------------------------------------------------------- predict --

def predict(model: Model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Rows with ``pred`` (boolean) and, for classifiers, ``p1`` = P(class 1).

    Without ``threshold`` the model's own decision is used (a regressor's
    output is cut at 0.5); with it, ``pred = p1 > threshold``.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("p1", vector_to_array("probability")[1])
        pred = (F.col("p1") > threshold) if threshold is not None else (F.col("prediction") == 1.0)
    else:
        out = out.withColumn("p1", F.col("prediction"))
        pred = F.col("prediction") > (threshold if threshold is not None else 0.5)
    return out.withColumn("pred", pred)


def f1_of(pred: DataFrame) -> DataFrame:
    """(precision, recall, f1, accuracy) of ``pred`` against ``label``."""
    return metrics.scores(pred, "label", F.col("pred")).select("precision", "recall", "f1",
                                                               "accuracy")


# ----------------------------------------------------------------- sweeps --

def sweep(spark: SparkSession, train: DataFrame, valid: DataFrame,
          grid: Sequence[Mapping[str, object]], build: Callable[..., Estimator],
          parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """Fit one model per parameter set (concurrently) and score it on ``valid``.

    Returns a DataFrame with the parameters and (precision, recall, f1,
    accuracy); only these few numbers per candidate reach the driver.
    """
    def run(params):
        model = build(**params).fit(train)
        r = f1_of(predict(model, valid)).first()
        return {**params, **r.asDict()}

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(run, grid))
    keys = list(grid[0].keys()) if grid else []
    schema = T.StructType(
        [T.StructField(k, T.LongType() if isinstance(grid[0][k], int) and not isinstance(grid[0][k], bool)
                       else T.DoubleType() if isinstance(grid[0][k], float) else T.BooleanType()
                       if isinstance(grid[0][k], bool) else T.StringType()) for k in keys]
        + [T.StructField(m, T.DoubleType()) for m in ("precision", "recall", "f1", "accuracy")])
    return spark.createDataFrame([tuple(r[k] for k in keys) + tuple(
        r[m] for m in ("precision", "recall", "f1", "accuracy")) for r in rows], schema)


def best_of(sweep_df: DataFrame, metric: str, order: Sequence[str]) -> DataFrame:
    """The best candidate; on ties the first in ``order`` wins (strict ``>``)."""
    return sweep_df.orderBy(F.col(metric).desc(), *[F.col(c).asc() for c in order]).limit(1)


def product_grid(**ranges: Sequence[object]) -> list[dict[str, object]]:
    """All combinations, in the nesting order of the arguments."""
    keys = list(ranges)
    return [dict(zip(keys, vals)) for vals in itertools.product(*ranges.values())]


# ------------------------------------------------------------ grid search --

def cross_validate(spark: SparkSession, train: DataFrame, key: str, estimator: Estimator,
                   grid: Mapping[str, Sequence[object]], k: int = 5, seed: int = 12345,
                   parallelism: int = DEFAULT_PARALLELISM) -> tuple[DataFrame, Model]:
    """``GridSearchCV``: k stratified folds, accuracy, refit on all of ``train``.

    Returns (one row per candidate with its mean accuracy, refitted best model).
    """
    folds = prep.stratified_folds(train.withColumn("__y", F.col("label").cast("long")),
                                  key, "__y", k=k, seed=seed).drop("__y")
    folds = folds.checkpoint(eager=True)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps,
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
                        foldCol="fold", parallelism=parallelism, seed=seed)
    cvm = cv.fit(folds)
    rows = [tuple(pm[estimator.getParam(n)] for n in grid) + (float(m),)
            for pm, m in zip(maps, cvm.avgMetrics)]
    fields = [T.StructField(n, T.LongType() if isinstance(next(iter(grid[n])), int) else T.DoubleType())
              for n in grid] + [T.StructField("accuracy", T.DoubleType())]
    return spark.createDataFrame(rows, T.StructType(fields)), cvm.bestModel


# ------------------------------------------------- grids with shared fits --

# A cut (max depth or None, min split): where growth would have stopped.
Cut = tuple[int | None, int]
LEAF = "__leaf"


def _node_tables(model: Model) -> Iterator[dict]:
    """The root node of each tree of a tree or forest, read from the fitted model in the JVM one tree at a time.

    A node is (prediction, impurityStats with stats and rawCount, and for inner
    nodes leftChild and rightChild).  A model has at most ``trees * 2 ** (depth
    + 1)`` nodes, whatever the size of the data.
    """
    jvm = SparkSession.active()._jvm
    mapper = jvm.com.fasterxml.jackson.databind.ObjectMapper()
    mapper.registerModule(jvm.com.fasterxml.jackson.module.scala.DefaultScalaModule())
    trees = model._java_obj.trees() if hasattr(model, "trees") else [model._java_obj]
    for t in trees:
        yield json.loads(mapper.writeValueAsString(t.rootNode()))


def _leaf_at(root: dict, max_depth: int | None) -> set[int]:
    """ids of the nodes that are leaves when growth stops at ``max_depth``.

    Spark grows level by level and draws feature subsets in that order, so the
    upper levels of a deep fit are those of a shallow one; afterwards it joins
    sibling leaves of one class, which is done here for the shallower tree.
    """
    leaves: set[int] = set()
    order: list[tuple[dict, int]] = [(root, 0)]
    for node, depth in order:
        if "leftChild" in node and depth != max_depth:
            order += [(node["leftChild"], depth + 1), (node["rightChild"], depth + 1)]
        else:
            leaves.add(id(node))
    for node, depth in reversed(order):
        if id(node) not in leaves:
            left, right = node["leftChild"], node["rightChild"]
            if {id(left), id(right)} <= leaves and left["prediction"] == right["prediction"]:
                leaves.add(id(node))
    return leaves


def leaf_values(spark: SparkSession, model: Model, cuts: Sequence[Cut]) -> list[tuple[int, int, list[tuple[float, float]]]]:
    """(tree, leaf, shares of class 0 and 1 under every cut) for each leaf of a tree or forest.

    The tree grown with a smaller depth limit is the fitted tree with nodes at
    that depth made leaves (see ``_leaf_at``); that with a larger min split has
    nodes of fewer rows made leaves.  Leaves are numbered as ``leafCol`` does:
    from left to right.
    """
    out = []
    for t, root in enumerate(_node_tables(model)):
        found = 0
        leaves = {d: _leaf_at(root, d) for d in {d for d, _ in cuts}}
        waiting: list[tuple[dict, list]] = [(root, [])]
        while waiting:
            node, above = waiting.pop()
            stats = (*node["impurityStats"]["stats"], 0.0)
            total = sum(stats)
            share = (stats[0] / total, stats[1] / total) if total > 0 else (0.0, 0.0)
            line = [*above, (id(node), node["impurityStats"]["rawCount"], share)]
            if "leftChild" in node:
                waiting += [(node["rightChild"], line), (node["leftChild"], line)]
                continue
            out.append((t, found, [next((v for i, n, v in line if n < min_split or i in leaves[d]), share)
                                   for d, min_split in cuts]))
            found += 1
    return out


def leaf_ids(model: Model, df: DataFrame, name: str = LEAF) -> DataFrame:
    """``df`` with ``__leaf``: the leaf that each row reaches in every tree (array)."""
    quiet = {model.getParam(c): "" for c in ("predictionCol", "probabilityCol", "rawPredictionCol") if model.hasParam(c)}
    out = model.transform(df, {**quiet, model.getParam("leafCol"): name})
    return out.withColumn(name, vector_to_array(name) if hasattr(model, "trees") else F.array(name))


def _constant(values: Sequence[float], of: str) -> str:
    """SQL of a constant array (one literal for the optimiser)."""
    return f"from_json('{json.dumps(list(values))}', 'array<{of}>')"


def with_votes(spark: SparkSession, model: Model, df: DataFrame, cuts: Sequence[Cut],
               table: Sequence[tuple] | None = None) -> DataFrame:
    """``df`` with ``__v<i>_0`` and ``__v<i>_1``: each tree's shares of the classes under cut i, without a shuffle.

    A row's leaf in each tree looks its value up in a constant array that holds
    the leaves of all trees one after the other (bounded by the model).
    ``table`` holds the leaf values under these cuts, if they are known.
    """
    table = leaf_values(spark, model, cuts) if table is None else table
    sizes = Counter(t for t, _, _ in table)
    before = list(itertools.accumulate([sizes[t] for t in range(len(sizes))], initial=1))[:-1]
    place = f"cast(x as int) + element_at({_constant(before, 'int')}, t + 1)"
    votes = [f"transform({LEAF}, (x, t) -> element_at({_constant([v[i][c] for _, _, v in table], 'double')}, {place}))"
             f" as __v{i}_{c}" for i in range(len(cuts)) for c in (0, 1)]
    return leaf_ids(model, df).selectExpr("*", *votes).drop(LEAF)


def _votes_for(i: int, c: int, n: int) -> str:
    """SQL of the first ``n`` trees' votes for class ``c`` under cut i."""
    return f"aggregate(slice(__v{i}_{c}, 1, {n}), 0D, (a, x) -> a + x)"


def voted(i: int, n: int) -> str:
    """SQL of the class-1 decision of the first ``n`` trees under cut i, ties to class 0 as Spark's models do."""
    return f"{_votes_for(i, 1, n)} > {_votes_for(i, 0, n)}"


def cut_probabilities(spark: SparkSession, model: Model, df: DataFrame, key: str, cuts: Sequence[Cut],
                      n_trees: Sequence[int] = (1,)) -> DataFrame:
    """(key, label, p_<i>_<n>): P(class 1) under cut i by the first n trees, one projection."""
    votes = with_votes(spark, model, df, cuts)
    return votes.select(key, "label", *[F.expr(f"{_votes_for(i, 1, n)} / {n}").alias(f"p_{i}_{n}")
                                        for i in range(len(cuts)) for n in n_trees])


#: Memory that a level's statistics may take, in MB; a level must be grown as a whole for depths to share a fit.
LEVEL_MB = 2_560
#: Leaf values, over all cuts of one projection, that a scoring job looks up.
VOTE_VALUES = 500_000


def shares_depths(n_trees: int, max_depth: int, bins: Sequence[int]) -> bool:
    """Whether the widest level of a forest is sure to be grown at once, so that shallower forests are cuts of it.

    ``bins`` are the most bins each feature can have; a node's statistics are
    at most those of the features with the most bins that it may draw.
    """
    drawn = len(bins) if n_trees == 1 else math.ceil(math.sqrt(len(bins)))
    per_node = 8 * 3 * sum(sorted(bins, reverse=True)[:drawn])
    return n_trees * 2 ** max(0, max_depth - 1) * per_node < LEVEL_MB * 2 ** 20


def fits_by_depth(depths: Sequence[int], n_trees: int, bins: Sequence[int],
                  fit: Callable[[int], Model]) -> list[tuple[Model, list[int]]]:
    """(model, the depth limits that are cuts of it): one fit of the largest limit where that is exact, else one each."""
    if shares_depths(n_trees, max(depths), bins):
        return [(fit(max(depths)), list(depths))]
    return [(fit(d), [d]) for d in depths]


def two_classes(df: DataFrame) -> DataFrame:
    """``df`` with the label marked as binary, so that fits need not scan for the number of classes."""
    marked = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": "label"}}
    return df.withColumn("label", F.col("label").alias("label", metadata=marked))


def _folds(train: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    return prep.stratified_folds(train.withColumn("__y", F.col("label").cast("long")),
                                 key, "__y", k=k, seed=seed).drop("__y").checkpoint(eager=True)


def _ranked(spark: SparkSession, names: Sequence[str], order: Sequence[tuple],
            accuracy: Mapping[tuple, Sequence[float]]) -> DataFrame:
    """(names..., mean_accuracy, rank): rank 1 = best, ties to the first in ``order``."""
    means = [sum(accuracy[c]) / len(accuracy[c]) for c in order]
    rank = {i: r + 1 for r, i in enumerate(sorted(range(len(order)), key=lambda i: (-means[i], i)))}
    schema = ", ".join(f"{n} long" for n in names) + ", mean_accuracy double, rank long"
    return spark.createDataFrame([(*c, means[i], rank[i]) for i, c in enumerate(order)], schema)


def tree_grid_search(spark: SparkSession, train: DataFrame, key: str,
                     max_depth: Sequence[int], min_leaf: Sequence[int], min_split: Sequence[int],
                     k: int = 5, seed: int = 12345, parallelism: int = DEFAULT_PARALLELISM
                     ) -> DataFrame:
    """``GridSearchCV(DecisionTreeClassifier(), {max_depth, min_samples_leaf,
    min_samples_split})`` with k stratified folds and accuracy.

    For each fold and leaf size one tree of the largest depth is fitted; every
    (depth, min split) candidate is a cut of it.  A fold's validation rows are
    reduced to (leaf, label, count) by one aggregation, and the candidates are
    scored from that table, whose size is bounded by the tree.  Fits:
    k * len(min_leaf) instead of k * |grid|.  Returns (max_depth,
    min_samples_leaf, min_samples_split, mean_accuracy, rank) with rank 1 =
    best, ties to the first candidate in grid order.
    """
    folds = two_classes(_folds(train, key, k, seed).select("features", "label", "fold"))
    cuts = [(d, s) for d in max_depth for s in min_split]

    def run(job):
        f, leaf = job
        model = tree(max(max_depth), min_leaf=leaf, seed=seed).fit(folds.filter(F.col("fold") != f))
        values = {at: v for _, at, v in leaf_values(spark, model, cuts)}
        counts = (leaf_ids(model, folds.filter(F.col("fold") == f))
                  .groupBy(F.col(LEAF)[0].cast("int").alias("leaf"), "label")
                  .agg(F.count(F.lit(1)).alias("n")).collect())
        total = sum(r["n"] for r in counts)
        return [sum(r["n"] for r in counts if (values[r["leaf"]][i][1] > 0.5) == (r["label"] == 1.0)) / total
                for i in range(len(cuts))]

    jobs = [(f, leaf) for f in range(k) for leaf in min_leaf]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scored = dict(zip(jobs, pool.map(run, jobs)))
    accuracy = {(d, leaf, s): [scored[f, leaf][i] for f in range(k)]
                for leaf in min_leaf for i, (d, s) in enumerate(cuts)}
    order = [(d, leaf, s) for d in max_depth for leaf in min_leaf for s in min_split]
    return _ranked(spark, ("max_depth", "min_samples_leaf", "min_samples_split"), order, accuracy)


def forest_grid_search(spark: SparkSession, train: DataFrame, key: str,
                       max_depth: Sequence[int], n_trees: Sequence[int], min_leaf: Sequence[int],
                       min_split: Sequence[int], k: int = 5, seed: int = 12345,
                       parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """``GridSearchCV(RandomForestClassifier(), {max_depth, n_estimators,
    min_samples_leaf, min_samples_split})``: k stratified folds, accuracy.

    Candidates that differ in where growth stops are cuts of one fit: for each
    fold and leaf size one forest of ``max(n_trees)`` trees and the largest
    depth is fitted (one per depth where its levels are too wide, see
    ``shares_depths``).  The forest of a smaller depth limit is exactly its cut;
    the forest of ``n`` trees is its first ``n`` (independent, identically drawn
    trees, as an unseeded search draws them), and a min split over twice the
    leaf size cuts each tree (a smaller one never binds).  All candidates of a
    fit are scored in one aggregation over the validation fold, without a
    shuffle of rows.  Returns (max_depth, min_samples_leaf, min_samples_split,
    n_estimators, mean_accuracy, rank).
    """
    folds = two_classes(_folds(train, key, k, seed).select("features", "label", "fold"))
    parts = {f: (folds.filter(F.col("fold") != f).drop("fold").checkpoint(eager=True),
                 folds.filter(F.col("fold") == f).drop("fold")) for f in range(k)}
    bins = feature_bins(train)

    def run(job):
        f, leaf = job
        learn, valid = parts[f]
        binding = sorted({s if s > 2 * leaf else 0 for s in min_split})
        at = {s: binding.index(s if s > 2 * leaf else 0) for s in min_split}
        out = {}
        for model, depths in fits_by_depth(max_depth, max(n_trees), bins, lambda d: forest(
                max(n_trees), d, min_leaf=leaf, seed=seed).setMaxMemoryInMB(LEVEL_MB).fit(learn)):
            cuts = [(d, s) for d in depths for s in binding]
            hits = [F.expr(f"count_if(({voted(i, n)}) = (label = 1))").alias(f"h_{i}_{n}")
                    for i in range(len(cuts)) for n in n_trees]
            r = with_votes(spark, model, valid, cuts).agg(F.count(F.lit(1)).alias("n"), *hits).first()
            out.update({(d, leaf, s, n): r[f"h_{j * len(binding) + at[s]}_{n}"] / r["n"]
                        for j, d in enumerate(depths) for s in min_split for n in n_trees})
        return out

    jobs = [(f, leaf) for leaf in min_leaf for f in range(k)]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scored = list(pool.map(run, jobs))
    order = [(d, leaf, s, n) for d in max_depth for leaf in min_leaf for s in min_split for n in n_trees]
    accuracy: dict[tuple, list[float]] = {c: [] for c in order}
    for one in scored:
        for c, a in one.items():
            accuracy[c].append(a)
    return _ranked(spark, ("max_depth", "min_samples_leaf", "min_samples_split", "n_estimators"), order, accuracy)


def refit_best(spark: SparkSession, table: DataFrame, train: DataFrame, df: DataFrame, key: str,
               seed: int = 12345) -> DataFrame:
    """(key, label, p1, pred) of ``df`` by the best candidate of a grid table,
    fitted on all of ``train`` (``GridSearchCV(refit=True)``)."""
    best = table.filter(F.col("rank") == 1).first()
    d, leaf, s = best["max_depth"], best["min_samples_leaf"], best["min_samples_split"]
    n = best["n_estimators"] if "n_estimators" in table.columns else 1
    est = forest(n, d, min_leaf=leaf, seed=seed) if "n_estimators" in table.columns \
        else tree(d, min_leaf=leaf, seed=seed)
    p = cut_probabilities(spark, est.fit(train), df.select(key, "features", "label"), key, [(d, s)], [n])
    return p.select(key, "label", F.col(f"p_0_{n}").alias("p1"), (F.col(f"p_0_{n}") > 0.5).alias("pred"))


# ------------------------------------------------------------- persistence --

def save(model: Model, path: str) -> str:
    """Persist a fitted model (the reference imports ``joblib.dump``)."""
    model.write().overwrite().save(path)
    return path


def load(kind: type, path: str) -> Model:
    """Load a model saved with :func:`save`; ``kind`` is the model class."""
    return kind.load(path)


# ------------------------------------------------------ sweeps, one fit each --

def _sweep_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """(names..., precision, recall, f1, accuracy) from rows (names..., tp, fp, tn, fn)."""
    schema = ", ".join(f"{n} long" for n in (*names, "tp", "fp", "tn", "fn"))
    counts = spark.createDataFrame(rows, schema)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(*names,
                         metrics.precision_col(tp, fp).alias("precision"),
                         metrics.recall_col(tp, fn).alias("recall"),
                         metrics.f1_col(tp, fp, fn).alias("f1"),
                         (F.when(tp + fp + tn + fn > 0, (tp + tn).cast("double") / (tp + fp + tn + fn)))
                         .alias("accuracy"))


def feature_bins(df: DataFrame, max_bins: int = MAX_BINS) -> list[int]:
    """The most bins that each feature can have: 2 where every value is 0 or 1, ``max_bins`` otherwise."""
    wide = F.transform(vector_to_array("features"), lambda x: (~x.isin(0.0, 1.0)).cast("double"))
    marks = df.select(Summarizer.max(array_to_vector(wide)).alias("m")).first()["m"] if df.head(1) else []
    return [max_bins if m else 2 for m in marks]


def _swept(spark: SparkSession, fits: Sequence[tuple[Model, list[int]]], valid: DataFrame, n_trees: int) -> list[tuple]:
    """(depth, tp, fp, tn, fn) of every depth limit; as many cuts of a fit are scored in one aggregation over
    ``valid`` as stay within ``VOTE_VALUES`` (the looked-up constants are part of the job)."""
    out = []
    for model, depths in fits:
        table = leaf_values(spark, model, [(d, 0) for d in depths])
        step = max(1, VOTE_VALUES // len(table))
        for at in range(0, len(depths), step):
            part = depths[at:at + step]
            votes = with_votes(spark, model, valid.select("features", "label"), [(d, 0) for d in part],
                               [(t, leaf, v[at:at + step]) for t, leaf, v in table])
            cells = [f"{'' if yes else 'not '}({voted(i, n_trees)}) and label {'=' if yes == right else '<>'} 1"
                     for i in range(len(part)) for yes, right in ((True, True), (True, False), (False, True), (False, False))]
            r = votes.agg(*[F.expr(f"count_if({c})").alias(f"c{i}") for i, c in enumerate(cells)]).first()
            out += [(d, *[r[f"c{4 * j + i}"] for i in range(4)]) for j, d in enumerate(part)]
    return out


def forest_sweep(spark: SparkSession, train: DataFrame, valid: DataFrame,
                 max_depth: Sequence[int], n_trees: Sequence[int], weighted: bool = False,
                 seed: int = 12345, parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """Seeded forests for every (depth, tree count), scored on ``valid``: one fit per tree count, of which
    the smaller depths are exact cuts (``fits_by_depth``).

    Returns (max_depth, n_trees, precision, recall, f1, accuracy).
    """
    learn, bins = two_classes(train), feature_bins(train)

    def run(n):
        fits = fits_by_depth(max_depth, n, bins, lambda d: forest(
            n, d, weighted=weighted, seed=seed).setMaxMemoryInMB(LEVEL_MB).fit(learn))
        return {(d, n): (d, n, *counts) for d, *counts in _swept(spark, fits, valid, n)}

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = {k: v for one in pool.map(run, sorted(n_trees, reverse=True)) for k, v in one.items()}
    return _sweep_table(spark, [rows[d, n] for d in max_depth for n in n_trees], ("max_depth", "n_trees"))


def tree_depth_sweep(spark: SparkSession, train: DataFrame, valid: DataFrame,
                     max_depth: Sequence[int], min_leaf: int = 1, weighted: bool = False,
                     seed: int = 12345, parallelism: int = DEFAULT_PARALLELISM) -> DataFrame:
    """Trees of every depth in ``max_depth``, scored on ``valid``: one fit, of which the smaller depths are
    exact cuts (``fits_by_depth``).

    Returns (max_depth, precision, recall, f1, accuracy).
    """
    learn = two_classes(train)
    fits = fits_by_depth(max_depth, 1, feature_bins(train), lambda d: tree(
        d, min_leaf=min_leaf, weighted=weighted, seed=seed).setMaxMemoryInMB(LEVEL_MB).fit(learn))
    rows = {r[0]: r for r in _swept(spark, fits, valid, 1)}
    return _sweep_table(spark, [rows[d] for d in max_depth], ("max_depth",))
