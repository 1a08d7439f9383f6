"""Small in-program tables: ``pd.Series(list)`` and ``pd.DataFrame(dict)``.

These build DataFrames from values held by the driver program itself (a few
literals), so they go through ``createDataFrame`` with an explicit schema;
anything large is read from storage instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _type_of(values: Sequence[object]) -> T.DataType:
    vals = [v for v in values if v is not None]
    if vals and all(isinstance(v, bool) for v in vals):
        return T.BooleanType()
    if vals and all(isinstance(v, int) and not isinstance(v, bool) for v in vals):
        return T.LongType()
    if vals and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vals):
        return T.DoubleType()
    return T.StringType()


def series(spark: SparkSession, values: Sequence[object], name: str = "value") -> DataFrame:
    """A 1-D labelled column: (idx 0..n-1, value)."""
    t = _type_of(values)
    conv = float if isinstance(t, T.DoubleType) else (lambda v: v)
    rows = [(i, None if v is None else conv(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("idx", T.LongType(), False),
                                                     T.StructField(name, t, True)]))


def from_columns(spark: SparkSession, columns: Mapping[str, Sequence[object]]) -> DataFrame:
    """A table from equal-length columns, in the given column order."""
    lengths = {len(v) for v in columns.values()}
    if len(lengths) > 1:
        raise ValueError("all columns must have the same length")
    types = {k: _type_of(v) for k, v in columns.items()}
    conv = {k: (float if isinstance(t, T.DoubleType) else (lambda v: v)) for k, t in types.items()}
    rows = [tuple(None if v is None else conv[k](v) for k, v in zip(columns, vals))
            for vals in zip(*columns.values())]
    schema = T.StructType([T.StructField(k, types[k], True) for k in columns])
    return spark.createDataFrame(rows, schema)
