"""Left join where a few keys hold much of the left table.

A shuffle join sends all rows of a key to one task.  Here one pass over the
left key counts frequent keys with a mergeable sketch; exactly those keys are
dealt over several tasks by a salt, every other key is joined as ever.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.frame import col, left_join

#: Salts per task's worth of rows: more, smaller pieces of a key spread evenly.
PIECES = 4
#: Keys that may be dealt out.  The sketch tracks ten times as many.
MOST_KEYS = 1000


def _fresh(name: str, *frames: DataFrame) -> str:
    """``name``, made longer until none of the frames has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _key_hash(left: DataFrame, right: DataFrame, on: str) -> Column:
    """Hash of the key in the type to which both sides' keys widen; null has a hash of its own."""
    both = left.select(col(on)).limit(0).unionAll(right.select(col(on)).limit(0))
    return F.xxhash64(col(on).cast(both.schema[0].dataType))


def heavy_hitters(df: DataFrame, key: Column, tasks: int, most_keys: int = MOST_KEYS) -> list[tuple[int, int]]:
    """(hash of the key, pieces) of the keys that hold over ``1/tasks`` of the rows.

    One pass with a frequent-items sketch of ``10 * most_keys`` counters, merged
    over the tasks; its counts are off by less than 0.0004 of the rows, so a key
    with a share of 0.1 % is always found where ``most_keys`` is 1,000 and
    ``tasks`` at least as many.  A key with share ``s`` gets ``s * tasks * PIECES``
    pieces.  At most ``most_keys`` rows come to the driver.
    """
    counted = df.select(key.alias("h")).agg(
        F.expr(f"approx_top_k(h, {most_keys}, {10 * most_keys})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [(r["item"], -(-r["count"] * tasks * PIECES // counted["n"]))
            for r in counted["top"] if r["count"] * tasks > counted["n"]]


def left_join_hot(left: DataFrame, right: DataFrame, on: str, null_safe: bool = True,
                  suffixes: tuple[str, str] = ("_x", "_y"), spread: Column | None = None,
                  tasks: int | None = None) -> DataFrame:
    """``frame.left_join``, with the left rows of frequent keys dealt over several tasks.

    The pieces of a frequent key are numbered; a left row goes to the piece of
    ``spread`` (by default a hash of all its columns that can be hashed), a right
    row of this key to all of them.  ``tasks`` is the number of tasks that the
    left table is to be spread over (the shuffle partitions).  A key with share
    ``s`` of the left rows has ``PIECES * s * tasks`` pieces, so all frequent
    keys together have at most ``PIECES * tasks`` and ``MOST_KEYS`` more, and
    the copies of a right row are no more than the rows it joins or pieces.

    * A null key may be frequent like any other, whether or not it matches.
    * Left rows equal in all columns share a piece: give a ``spread`` that
      differs between them (a row number) where that matters.
    * With no frequent key, or none in an empty table, the plan is that of
      ``frame.left_join``.
    * The counting pass runs when the join is called; the join itself is lazy.
    """
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = _key_hash(left, right, on)
    hot = heavy_hitters(left, key, tasks)
    if not hot:
        return left_join(left, right, on, null_safe, suffixes)
    salt, mark, pieces = (_fresh(n, left, right) for n in ("__salt", "__key_hash", "__pieces"))
    # at most MOST_KEYS rows
    table = F.broadcast(left.sparkSession.createDataFrame(
        hot, T.StructType([T.StructField(mark, T.LongType()), T.StructField(pieces, T.LongType())])))
    if spread is None:
        spread = F.xxhash64(*[col(f.name) for f in left.schema.fields if _hashable(f.dataType)])
    known = F.coalesce(F.col(pieces), F.lit(1).cast("long"))
    dealt = left.withColumns({mark: key, salt: spread.cast("long")}).join(table, mark, "left").select(
        *[col(c) for c in left.columns], F.pmod(F.col(salt), known).alias(salt))
    copies = right.withColumn(mark, key).join(table, mark, "left").select(
        *[col(c) for c in right.columns], F.explode(F.sequence(F.lit(0).cast("long"), known - 1)).alias(salt))
    return left_join(dealt, copies, on, null_safe, suffixes, also=salt)


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes the type (maps and what holds them it does not)."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
