"""Table profiles: ``info()`` (A6) and ``describe()`` (A7).

Both are one aggregate pass over the table, unpivoted to one row per column.
Quantiles are exact: a sketch taken in that pass brackets each of them, and a
second pass counts below the brackets and collects the few values inside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.missing import exact_mean, is_floating, is_numeric, nan_as_null
from tessera.operators.frame import col

QUANTILES = (0.25, 0.5, 0.75)
# Accuracy of the quantile sketch (ranks are off by 1 / ACCURACY of the rows at most), half the width of a
# bracket in quantiles, and the share of the rows that can lie strictly inside it, by that accuracy.
ACCURACY = 10_000
WIDTH = 2 / ACCURACY
INSIDE = 2 * (WIDTH + 1 / ACCURACY)
# Values of a bracket that are collected, at most, and cuts of the sketch of a larger one.
MOST = 10_000
GRID = 2_000
# Standard deviation and interpolated quantiles are reported to 4 decimals.
ROUND_DIGITS = 4


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def info(df: DataFrame) -> DataFrame:
    """(position, column_name, non_null, dtype), one aggregate pass."""
    names = df.columns
    counts = df.agg(*[F.count(col(c)).alias(f"__c{i}") for i, c in enumerate(names)])
    types = [f.dataType.simpleString() for f in df.schema.fields]
    stack = ", ".join(f"{i}, {_sql_str(c)}, __c{i}, {_sql_str(t)}"
                      for i, (c, t) in enumerate(zip(names, types)))
    return counts.selectExpr(
        f"stack({len(names)}, {stack}) as (position, column_name, non_null, dtype)")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if is_numeric(f.dataType) and not isinstance(f.dataType, T.BooleanType)]


def _clean(df: DataFrame, name: str):
    c = col(name)
    return nan_as_null(c) if is_floating(df.schema[name].dataType) else c


def sketch(value, qs: Sequence[float]):
    """Aggregate: for each quantile two values between which it lies, from a mergeable quantile sketch."""
    edges = [min(1.0, max(0.0, q + d)) for q in qs for d in (-WIDTH, WIDTH)]
    return F.percentile_approx(value, edges, ACCURACY)


def _lerp(a: float, b: float, t: float) -> float:
    """Linear interpolation as NumPy does it (infinite neighbours give infinities or NaN the same way)."""
    step = b - a
    return a + step * t if t < 0.5 else b - step * (1 - t)


def exact_quantiles(df: DataFrame, names: Sequence[str], bounds: Sequence[tuple],
                    counts: Sequence[int], qs: Sequence[float],
                    sketches: Sequence[Sequence[float]] | None = None) -> list[list[float | None]]:
    """Exact, linearly interpolated quantiles (pandas' default) of several columns.

    A sketch (``sketch``, one per column, taken in a scan of its own unless given)
    brackets each wanted rank.  A scan then counts what lies below a bracket
    and on its two ends and collects the values inside, all brackets together.
    By the sketch's guarantee ``INSIDE`` of the values lie strictly inside at
    most; where that may be more than ``MOST`` values, the scan takes a sketch
    of them instead and the next scan goes on with its bracket.  So with the
    sketch there are two scans up to 12 million rows, three up to 10^10, for any
    values: only counts, comparisons and values themselves are used, so that
    infinities are like other numbers.  A bracket that misses its rank (none
    should) is moved to the side where the rank lies, inside the last bracket
    that held it.
    """
    value = [_clean(df, c).cast("double") for c in names]
    wanted = {}  # (column, rank) -> [bracket, values that may lie strictly inside, limits known to hold the rank]
    if sketches is None and any(n > 0 for n in counts):
        row = df.agg(*[sketch(v, qs).alias(f"k{i}") for i, v in enumerate(value)]).first()
        sketches = [row[f"k{i}"] for i in range(len(value))]
    for i, n in enumerate(counts):
        for j, q in enumerate(qs if n > 0 else ()):
            at = int(q * (n - 1) // 1)
            for rank in {at, min(at + 1, n - 1)}:
                lo, hi = (bounds[i] if n <= MOST else sketches[i][2 * j:2 * j + 2])
                wanted[i, rank] = [lo, hi, n if n <= MOST else INSIDE * n, *bounds[i]]
    found: dict[tuple[int, int], float] = {}
    while open_ := sorted({(i, w[0], w[1]) for (i, r), w in wanted.items() if (i, r) not in found}):
        room = {b: max(w[2] for (i, _), w in wanted.items() if (i, w[0], w[1]) == b) for b in open_}
        aggs = []
        for k, (i, lo, hi) in enumerate(open_):
            v, inner = value[i], (value[i] > F.lit(lo)) & (value[i] < F.lit(hi))
            aggs += [F.count_if(v < F.lit(lo)).alias(f"b{k}"), F.count_if(v == F.lit(lo)).alias(f"l{k}"),
                     F.count_if(inner).alias(f"n{k}"), F.count_if(v == F.lit(hi)).alias(f"h{k}")]
            if room[i, lo, hi] <= MOST:
                aggs.append(F.collect_list(F.when(inner, v)).alias(f"v{k}"))
            else:
                aggs.append(F.percentile_approx(F.when(inner, v), [j / GRID for j in range(GRID + 1)], ACCURACY).alias(f"s{k}"))
        row = df.agg(*aggs).first().asDict()
        for (i, rank), (lo, hi, _, least, greatest) in list(wanted.items()):
            if (i, rank) in found:
                continue
            k = open_.index((i, lo, hi))
            below, at_lo, inside, at_hi = (row[f"{c}{k}"] for c in "blnh")
            at_hi = 0 if lo == hi else at_hi
            at = rank - below
            if at < 0:
                wanted[i, rank] = [least, lo, counts[i], least, lo]
            elif at < at_lo:
                found[i, rank] = lo
            elif at >= at_lo + inside + at_hi:
                wanted[i, rank] = [hi, greatest, counts[i], hi, greatest]
            elif at >= at_lo + inside:
                found[i, rank] = hi
            elif f"v{k}" in row:
                found[i, rank] = sorted(row[f"v{k}"])[at - at_lo]
            else:
                share = (at - at_lo) / max(1, inside - 1)
                grid = row[f"s{k}"]
                low = max(0, int((share - WIDTH) * GRID) - 1)
                high = min(GRID, int((share + WIDTH) * GRID) + 2)
                wanted[i, rank] = [grid[low], grid[high], (high - low + 2) / GRID * inside, lo, hi]
    out = []
    for i, n in enumerate(counts):
        line = []
        for q in qs:
            p = q * (n - 1)
            at = int(p // 1)
            line.append(_lerp(found[i, at], found[i, min(at + 1, n - 1)], p - at) if n else None)
        out.append(line)
    return out


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             scales: Mapping[str, int] | None = None,
             quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """count, mean, std (sample), min, quantiles, max for numeric columns.

    One row per column: (column_name, count, mean, std, min, p25, p50, p75,
    max).  ``scales`` names fixed-point columns whose mean is computed from an
    exact DECIMAL sum.  Infinities count as values, with the results that
    pandas gives them.
    """
    scales = scales or {}
    names = list(columns or numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(names):
        v = _clean(df, c)
        mean = exact_mean(v, scales[c]) if c in scales else F.avg(v)
        aggs += [F.count(v).alias(f"n{i}"), mean.alias(f"m{i}"),
                 F.round(F.stddev_samp(v), ROUND_DIGITS).alias(f"s{i}"),
                 F.min(v).cast("double").alias(f"lo{i}"), F.max(v).cast("double").alias(f"hi{i}"),
                 sketch(v.cast("double"), quantiles).alias(f"k{i}")]
    first = df.agg(*aggs).first()
    qnames = [f"p{int(round(q * 100))}" for q in quantiles]
    counts = [first[f"n{i}"] for i in range(len(names))]
    bounds = [(first[f"lo{i}"], first[f"hi{i}"]) for i in range(len(names))]
    qvals = exact_quantiles(df, names, bounds, counts, quantiles, [first[f"k{i}"] for i in range(len(names))])
    rows = []
    for i, c in enumerate(names):
        qs = [None if v is None else round(float(v), ROUND_DIGITS) for v in qvals[i]]
        rows.append((c, first[f"n{i}"], first[f"m{i}"], first[f"s{i}"], first[f"lo{i}"], *qs,
                     first[f"hi{i}"]))
    schema = T.StructType(
        [T.StructField("column_name", T.StringType()), T.StructField("count", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in ["mean", "std", "min", *qnames, "max"]])
    return df.sparkSession.createDataFrame(rows, schema)
