"""Missing-value rules that make Spark answer like the reference's frames.

The reference treats NaN and None as one "missing" that aggregates skip,
drops null group keys, gives 0 for the sum of nothing, matches a null join key
to a null join key and sorts missing values last.  Spark treats NaN as a value,
keeps a NULL group, gives NULL for an empty sum, never matches NULL keys and
sorts nulls first.  The helpers here bridge each gap with a plain Column
expression, so everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FLOATING)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def nan_as_null(col: Column) -> Column:
    """NaN becomes NULL; NULL and ordinary values pass through."""
    return F.when(~F.isnan(col), col)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in every floating column (or the ones named)."""
    names = columns or [f.name for f in df.schema.fields if is_floating(f.dataType)]
    floating = {f.name for f in df.schema.fields if is_floating(f.dataType)}
    exprs = [
        nan_as_null(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in names and f.name in floating else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*exprs)


def sum_or_zero(col: Column) -> Column:
    """Sum that is 0 over no non-missing values (the reference's rule)."""
    return F.coalesce(F.sum(col), F.lit(0).cast(T.LongType()))


def exact_sum(col: Column, scale: int) -> Column:
    """Sum of a fixed-point column, added up as DECIMAL, returned as DOUBLE.

    Summing DECIMAL(18, scale) is order-independent, so the result does not
    depend on partitioning and equals any other exact engine bit for bit.
    """
    return F.sum(col.cast(T.DecimalType(18, scale))).cast(T.DoubleType())


def exact_mean(col: Column, scale: int) -> Column:
    """Mean = exact sum / non-null count: one IEEE division."""
    return exact_sum(col, scale) / F.count(col)
