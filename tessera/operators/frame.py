"""Frame operators: projection, filters, metadata, joins, aggregates, top-k.

Every function returns a lazy DataFrame.  Aggregates rely on Spark's partial
(map-side) aggregation, so a key that holds a third of all rows is combined
inside each task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.missing import (
    exact_mean,
    exact_sum,
    is_floating,
    nan_as_null,
    sum_or_zero,
)


def col(name: str) -> Column:
    """Column reference that is safe for names with spaces or Cyrillic."""
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- metadata --

def drop_columns(df: DataFrame, columns: Iterable[str], errors: str = "raise") -> DataFrame:
    """Drop named columns; unknown names raise (the reference's default)."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing and errors == "raise":
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[c for c in columns if c in df.columns])


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case, refusing names that would collide."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        dupes = sorted({c for c in lowered if lowered.count(c) > 1})
        raise ValueError(f"lower-casing makes duplicate columns: {dupes}")
    return df.toDF(*lowered)


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows holding a missing value in any column (NaN counts as missing)."""
    floating = [f.name for f in df.schema.fields if is_floating(f.dataType)]
    cond = None
    for f in df.schema.fields:
        c = col(f.name)
        ok = c.isNotNull() & ~F.isnan(c) if f.name in floating else c.isNotNull()
        cond = ok if cond is None else cond & ok
    return df if cond is None else df.filter(cond)


def null_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of missing values per column, one aggregate pass, one row per column.

    Result: (column_name, null_share).  NaN counts as missing in float columns.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(columns):
        v = nan_as_null(col(c)) if is_floating(types[c]) else col(c)
        aggs.append(F.count(v).alias(f"__c{i}"))
    counts = df.agg(*aggs)
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', __c{i}" for i, c in enumerate(columns))
    long = counts.selectExpr("__n", f"stack({len(columns)}, {stack}) as (column_name, non_null)")
    return long.select(
        "column_name",
        ((F.col("__n") - F.col("non_null")).cast("double") / F.col("__n")).alias("null_share"),
    )


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


# ------------------------------------------------------------------ joins --

def left_join(left: DataFrame, right: DataFrame, on: str, null_safe: bool = True,
              suffixes: tuple[str, str] = ("_x", "_y"), also: str | None = None) -> DataFrame:
    """Left equi-join on one named key, with the reference's output shape.

    One key column comes out; other columns present on both sides get the
    suffixes.  Duplicate right keys multiply left rows.  With ``null_safe``
    (the default, as in the reference) a NULL key matches a NULL key
    (``<=>``; still an equi-join for Spark's hash and sort-merge joins).  Catalyst
    picks the join by the sizes in bytes; AQE splits skewed partitions
    (``skew.left_join_hot`` deals out frequent keys by itself).  ``also`` names
    a column of both sides that must be equal too and does not come out.
    """
    overlap = (set(left.columns) & set(right.columns)) - {on, also}
    lsel = [col(c).alias(c + suffixes[0]) if c in overlap else col(c) for c in left.columns]
    rkey = f"__rkey_{on}"
    rsel = [col(on).alias(rkey)] + [
        col(c).alias(c + suffixes[1]) if c in overlap else col(c)
        for c in right.columns if c != on]
    l2 = left.select(*lsel)
    r2 = right.select(*rsel)
    cond = l2[on].eqNullSafe(r2[rkey]) if null_safe else l2[on] == r2[rkey]
    if also is None:
        return l2.join(r2, cond, "left").drop(rkey)
    return l2.join(r2, cond & (l2[also] == r2[also]), "left").drop(l2[also], r2[also]).drop(rkey)


# ------------------------------------------------------------- aggregates --

_FUNCS = ("mean", "sum", "max", "min", "count")


def _agg_expr(df: DataFrame, name: str, fn: str, scales: Mapping[str, int]) -> Column:
    dtype = df.schema[name].dataType
    c = nan_as_null(col(name)) if is_floating(dtype) else col(name)
    scale = scales.get(name)
    if fn == "mean":
        return exact_mean(c, scale) if scale is not None else F.avg(c)
    if fn == "sum":
        if scale is not None:
            return F.coalesce(exact_sum(c, scale), F.lit(0.0))
        return sum_or_zero(c)
    if fn == "max":
        return F.max(c)
    if fn == "min":
        return F.min(c)
    if fn == "count":
        return F.count(c)
    raise ValueError(f"unknown aggregate {fn!r}; expected one of {_FUNCS}")


def agg_columns(df: DataFrame, spec: Mapping[str, str | Sequence[str]],
                scales: Mapping[str, int] | None = None) -> list[Column]:
    """Aggregate columns for a ``{column: fn | [fn, ...]}`` spec, named ``<col>_<fn>``."""
    scales = scales or {}
    out = []
    for name, fns in spec.items():
        for fn in ([fns] if isinstance(fns, str) else fns):
            out.append(_agg_expr(df, name, fn, scales).alias(f"{name}_{fn}"))
    return out


def group_agg(df: DataFrame, by: str | Sequence[str], spec: Mapping[str, str | Sequence[str]],
              dropna: bool = True, scales: Mapping[str, int] | None = None) -> DataFrame:
    """Grouped aggregates in one pass (one partial + one final HashAggregate).

    ``dropna`` drops rows whose key is NULL, as the reference does; NaN in
    value columns is skipped; sums of nothing are 0; ``scales`` names
    fixed-point columns summed exactly as DECIMAL.
    """
    keys = [by] if isinstance(by, str) else list(by)
    src = df
    if dropna:
        for k in keys:
            src = src.filter(col(k).isNotNull())
    return src.groupBy(*[col(k) for k in keys]).agg(*agg_columns(src, spec, scales))


def total(df: DataFrame, spec: Mapping[str, str | Sequence[str]],
          scales: Mapping[str, int] | None = None) -> DataFrame:
    """Whole-table aggregates (one row)."""
    return df.agg(*agg_columns(df, spec, scales))


def count_where(df: DataFrame, predicates: Mapping[str, Column], share: bool = False) -> DataFrame:
    """Conditional tallies (``count_if``) in one pass; as shares of all rows if asked."""
    aggs = [F.count_if(p).alias(n) for n, p in predicates.items()]
    out = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    if share:
        return out.select(*[(F.col(n).cast("double") / F.col("__n")).alias(n) for n in predicates])
    return out.drop("__n")


# ----------------------------------------------------------- order, top-k --

def sort_key(name: str, ascending: bool = True) -> Column:
    """Sort key with missing values last, whichever the direction."""
    c = col(name)
    return c.asc_nulls_last() if ascending else c.desc_nulls_last()


def top_k(df: DataFrame, by: str | Sequence[str], k: int, ascending: bool | Sequence[bool] = True,
          tie_break: Sequence[str] | None = None) -> DataFrame:
    """First ``k`` rows in key order: ``orderBy(...).limit(k)``.

    Catalyst turns this into ``TakeOrderedAndProject``: each task keeps its own
    best ``k`` and only those reach the final merge; there is no full sort.
    ``tie_break`` columns make the answer deterministic when keys tie.
    """
    keys = [by] if isinstance(by, str) else list(by)
    dirs = [ascending] * len(keys) if isinstance(ascending, bool) else list(ascending)
    order = [sort_key(k, d) for k, d in zip(keys, dirs)]
    order += [sort_key(t) for t in (tie_break or []) if t not in keys]
    return df.orderBy(*order).limit(k)
