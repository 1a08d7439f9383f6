"""Preparation for modelling: one-hot (drop first), exact seeded split,
class shares and balanced class weights, stratified fold numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import ordered
from tessera.operators.frame import col



def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values per column, in one distributed ``distinct``.

    The values become column names, so they come to the driver whatever their
    number; ``one_hot_vector`` is the form for very wide columns.
    """
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), col(c).alias("v")) for c in columns]))
    distinct = (df.select(pairs.alias("p")).select("p.k", "p.v")
                .filter(F.col("v").isNotNull()).distinct())
    rows = distinct.collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        out[r["k"]].append(r["v"])
    for vals in out.values():
        vals.sort()
    return out


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, drop_first: bool = True) -> DataFrame:
    """``get_dummies``: string columns become ``<col>_<value>`` booleans.

    Categories are sorted; with ``drop_first`` the first is left out; a NULL
    gives false in every dummy.  Other columns keep their order and the
    dummies are appended, column by column.
    """
    columns = list(columns if columns is not None else string_columns(df))
    cats = categories(df, columns)
    keep = [col(c) for c in df.columns if c not in columns]
    dummies = []
    for c in columns:
        vals = cats[c][1:] if drop_first else cats[c]
        for v in vals:
            dummies.append(F.coalesce(col(c) == F.lit(v), F.lit(False)).alias(f"{c}_{v}"))
    return df.select(*keep, *dummies)


def split_sizes(n: int, test_size: float) -> tuple[int, int]:
    """(train, test) row counts of a shuffled split: test = ceil(f * n)."""
    n_test = math.ceil(test_size * n)
    return n - n_test, n_test


def hash_rank_key(key: str, seed: int) -> Column:
    """md5 of ``'<seed>:<key>'``: a uniform, partition-independent sort key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))


def hash_digits(n: int) -> int:
    """Hex digits of the hash prefix so that buckets hold about 2M rows."""
    return max(1, math.ceil(math.log(ordered.bucket_count(n), 16)))


def split_three(df: DataFrame, key: str, seed: int = 12345, test_size: float = 0.4,
                second_test_size: float = 0.5, label: str = "part") -> DataFrame:
    """Exact 60/20/20 split: ``train``, ``valid``, ``test`` in column ``label``.

    Rows are ranked by ``md5(seed:key)`` then ``key`` — the same on any
    partitioning and in any engine — and cut at the sizes of two shuffled
    splits: test = ceil(0.4 n), then its half (ceil) is test and the rest
    valid.  ``key`` must identify rows.
    """
    df = df.checkpoint(eager=True)  # counted, prefixed and ranked: computed once
    n = df.count()
    n_train, n_rest = split_sizes(n, test_size)
    n_valid, _ = split_sizes(n_rest, second_test_size)
    h = "__h"
    ranked = ordered.ordered_index(df.withColumn(h, hash_rank_key(key, seed)), [h, key],
                                   hash_col=h, hash_digits=hash_digits(n), materialize=False)
    part = (F.when(F.col("__rank") <= n_train, "train")
            .when(F.col("__rank") <= n_train + n_valid, "valid").otherwise("test"))
    return ranked.select(*[col(c) for c in df.columns], part.alias(label))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """(target, n_class, n, k): class sizes with the table size and class count."""
    per = df.groupBy(col(target)).agg(F.count(F.lit(1)).alias("n_class"))
    # one row per class: the window sees the class table only
    w = Window.partitionBy(F.lit(0))
    return per.select(col(target), "n_class", F.sum("n_class").over(w).alias("n"),
                      F.count(F.lit(1)).over(w).alias("k"))


def balanced_weights(df: DataFrame, target: str, weight_col: str = "class_weight") -> DataFrame:
    """Append ``n / (k * n_class)`` per row (the 'balanced' class weight)."""
    cc = class_counts(df, target)
    w = cc.select(col(target).alias("__t"),
                  (F.col("n").cast("double") / (F.col("k") * F.col("n_class")).cast("double"))
                  .alias(weight_col))
    return df.join(w, col(target).eqNullSafe(F.col("__t")), "left").drop("__t")


def stratified_folds(df: DataFrame, key: str, target: str, k: int = 5, seed: int = 12345,
                     fold_col: str = "fold") -> DataFrame:
    """Fold number 0..k-1 per row, dealt round-robin within each class.

    Rows are ordered by (class, md5(seed:key), key); the bucket is the class
    code followed by a hash prefix, so even a class holding most rows is
    spread over many buckets.  The rank within a class, modulo ``k``, is the
    fold: every fold gets the same share of each class (within one row).
    ``target`` must hold non-negative integer class labels.
    """
    df = df.checkpoint(eager=True)
    n = df.count()
    hc = "__hc"
    code = F.lpad(F.hex(col(target).cast("long")), 8, "0")
    hashed = df.withColumn(hc, F.concat(code, hash_rank_key(key, seed)))
    ranked = ordered.ordered_index(hashed, [hc, key], hash_col=hc, hash_digits=8 + hash_digits(n),
                                   materialize=False)
    # rows of smaller classes: a running sum over the class table (one row per class)
    before = Window.partitionBy(F.lit(0)).orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)
    first = df.groupBy(col(target).alias("__t")).count().select(
        "__t", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__r0"))
    out = ranked.join(first, col(target) == F.col("__t"))
    return out.select(*[col(c) for c in df.columns],
                      F.pmod(F.col("__rank") - 1 - F.col("__r0"), F.lit(k)).cast("int").alias(fold_col))


def one_hot_vector(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Drop-first one-hot of a wide string column as a sparse vector.

    For columns with too many categories for boolean columns: the distinct
    values are ranked by ``ordered_index`` and joined back as an ordinal, so
    nothing per value reaches the driver or the plan.  The dimensions are those
    of ``get_dummies(drop_first=True)``: every category but the alphabetically
    first, in ascending order; the first and NULL are all zeros (they share the
    last ordinal, which the encoder drops).
    """
    from pyspark.ml.feature import OneHotEncoder
    from pyspark.ml.functions import array_to_vector
    out = output or f"{column}_vec"
    values = df.select(col(column).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    ranked = ordered.ordered_index(values, ["__v"]).select("__v", "__rank", "tot_rows").checkpoint(eager=True)
    top = ranked.select("tot_rows").first()
    k = top["tot_rows"] if top else 0
    if k < 2:  # no dimension is left after dropping the first category
        return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
    joined = df.join(ranked.drop("tot_rows"), col(column) == F.col("__v"), "left")
    place = F.when(F.col("__rank") > 1, F.col("__rank") - 2).otherwise(k - 1)
    coded = joined.withColumn("__place", place.cast("double"))
    # the size is that of the dictionary, whatever rows are encoded
    sizes = ranked.select((F.col("__rank") - 1).cast("double").alias("__place"))
    encoder = OneHotEncoder(inputCols=["__place"], outputCols=[out], dropLast=True).fit(sizes)
    return encoder.transform(coded).select(*[col(c) for c in df.columns], col(out))
