"""Global order without a single-task window: the two-level prefix.

``Window.orderBy(x)`` without ``partitionBy`` moves every row into one task.
Global ranks and running sums are instead computed in two levels:

1. every row gets an order-preserving bucket (its range of the order columns,
   all of them, so that one hot value is spread by its tie-breaks; or a prefix
   of a uniform hash);
2. per-bucket totals are aggregated (one small row per bucket), and their
   prefix sums are taken on the driver — the bucket table is bounded by the
   bucket count, a parameter, not by the data;
3. the offsets are broadcast back (bounded table) and a window *partitioned
   by bucket* finishes the job, adding the offset of all earlier buckets.

The result equals the one-window form exactly.  The values the next row in
order would give (``lead``) cross bucket boundaries through the same table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"
DEFAULT_BUCKETS = 64
# Target number of rows per bucket when the bucket count is derived from size.
ROWS_PER_BUCKET = 2_000_000


def bucket_count(n_rows: int) -> int:
    """Buckets so that each holds about ``ROWS_PER_BUCKET`` rows (at least 16)."""
    return max(16, math.ceil(n_rows / ROWS_PER_BUCKET))


def with_range_bucket(df: DataFrame, order: Sequence[Column], n_buckets: int) -> DataFrame:
    """Add ``__bucket``: the range of ``order`` that the row falls in.

    Spark's range partitioner cuts any orderable types, on all columns together,
    from a sample; the ranges are written down at once, because another run
    would be free to cut elsewhere.
    """
    return (df.repartitionByRange(n_buckets, *order)
            .withColumn(BUCKET, F.spark_partition_id().cast("long")).checkpoint(eager=True))


def with_hash_bucket(df: DataFrame, hex_col: str, digits: int) -> DataFrame:
    """Add ``__bucket`` from the first ``digits`` hex digits of a hash column.

    For a uniform hash (md5 of distinct keys) the buckets are equal in size
    and their order is the order of the hash string.
    """
    return df.withColumn(BUCKET, F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long"))


def _offsets(spark: SparkSession, bucketed: DataFrame, order_cols: Sequence[str], descending: bool,
             sums: Sequence[str], lead_cols: Sequence[str]) -> DataFrame:
    """Per-bucket offsets (sums of all earlier buckets) and the first row's
    values of the next bucket; the bucket table is small by construction."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.sum(s).alias(f"__t_{s}") for s in sums]
    for c in lead_cols:
        # first row of the bucket in processing order: NULL is the least of any
        # type, so it comes last when descending
        pick = F.max_by if descending else F.min_by
        aggs.append(pick(F.col(c), F.struct(*order_cols)).alias(f"__f_{c}"))
    rows = sorted(bucketed.groupBy(BUCKET).agg(*aggs).collect(), key=lambda r: r[BUCKET])
    out = []
    run_n = 0
    run = {s: 0 for s in sums}
    for i, r in enumerate(rows):
        nxt = rows[i + 1] if i + 1 < len(rows) else None
        rec = [int(r[BUCKET]), run_n] + [run[s] for s in sums]
        rec += [None if nxt is None else nxt[f"__f_{c}"] for c in lead_cols]
        out.append(tuple(rec))
        run_n += r["__n"]
        for s in sums:
            run[s] += r[f"__t_{s}"] or 0
    out = [rec + (run_n,) + tuple(run[s] for s in sums) for rec in out]
    fields = [T.StructField(BUCKET, T.LongType()), T.StructField("__off_rows", T.LongType())]
    types = {f.name: f.dataType for f in bucketed.schema.fields}
    sum_types = {}
    for s in sums:
        t = types[s]
        sum_types[s] = T.LongType() if isinstance(t, T.IntegralType) else t
        fields.append(T.StructField(f"__off_{s}", sum_types[s]))
    for c in lead_cols:
        fields.append(T.StructField(f"__nf_{c}", types[c]))
    fields.append(T.StructField("tot_rows", T.LongType()))
    for s in sums:
        fields.append(T.StructField(f"tot_{s}", sum_types[s]))
    return spark.createDataFrame(out, T.StructType(fields))


def ordered_index(df: DataFrame, order_cols: Sequence[str], *, descending: bool = False,
                  sums: Sequence[str] = (), lead_cols: Sequence[str] = (),
                  hash_col: str | None = None, hash_digits: int = 3,
                  n_buckets: int = DEFAULT_BUCKETS, materialize: bool = True,
                  only: tuple[str | None, Sequence[int]] | None = None) -> DataFrame:
    """Global 1-based ``__rank``, running sums ``cum_<s>`` and next-row values
    ``next_<c>`` in the order of ``order_cols``, computed without one-task windows.
    Grand totals come along as ``tot_rows`` and ``tot_<s>``.

    ``hash_col`` names a uniform hex-hash column that leads the order (bucket =
    its first ``hash_digits`` digits); otherwise buckets are range buckets of
    the order columns, of any orderable type.  Rows that tie on all order columns are ranked in
    an arbitrary order among themselves.  With ``only=(None, ranks)`` only the
    buckets holding those 1-based ranks go through the window; with
    ``only=(s, positions)`` the buckets whose running-``s`` range holds the
    positions.  The other buckets are dropped before the shuffle: a
    selection instead of a full ranking.
    """
    spark = df.sparkSession
    if materialize:
        # The input feeds several jobs (sizes, bucket totals, final window);
        # checkpointing it to the shared folder computes it once and cuts
        # the lineage, so a lost executor does not replay the whole plan.
        df = df.checkpoint(eager=True)
    dirs = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()
            for c in order_cols]
    if hash_col is not None:
        bucketed = with_hash_bucket(df, hash_col, hash_digits)
    else:
        # enough buckets that each holds about ROWS_PER_BUCKET rows
        bucketed = with_range_bucket(df, dirs, max(n_buckets, bucket_count(df.count())))
    offs = _offsets(spark, bucketed, order_cols, descending, sums, lead_cols)
    if only is not None:
        measure = "rows" if only[0] is None else only[0]
        local = offs.collect()
        starts = sorted((r[BUCKET], r[f"__off_{measure}"]) for r in local)
        total = local[0][f"tot_{measure}"] if local else 0
        keep = set()
        for i, (b, off) in enumerate(starts):
            end = starts[i + 1][1] if i + 1 < len(starts) else total
            if any(off < p <= end for p in only[1]):
                keep.add(b)
        bucketed = bucketed.filter(F.col(BUCKET).isin(sorted(keep)))
        offs = offs.filter(F.col(BUCKET).isin(sorted(keep)))
    w = Window.partitionBy(BUCKET).orderBy(*dirs)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bucketed.join(F.broadcast(offs), BUCKET, "left")
    cols = [F.col(c) for c in df.columns]
    cols.append((F.row_number().over(w) + F.col("__off_rows")).alias("__rank"))
    for s in sums:
        cols.append((F.sum(s).over(running) + F.col(f"__off_{s}")).alias(f"cum_{s}"))
    for c in lead_cols:
        cols.append(F.coalesce(F.lead(c).over(w), F.col(f"__nf_{c}")).alias(f"next_{c}"))
    cols += [F.col("tot_rows")] + [F.col(f"tot_{s}") for s in sums]
    return out.select(*cols)


def row_index(df: DataFrame, name: str = "__idx") -> DataFrame:
    """Dense 0-based position of every row in the frame's current order
    (partition by partition), without a shuffle or a window.

    ``monotonically_increasing_id`` packs (partition, row in partition); the
    frame is checkpointed so that the packing is fixed, the rows per
    partition are counted (one small row per partition), prefixed on the
    driver and broadcast back: position = rows of earlier partitions + row.
    """
    spark = df.sparkSession
    mid = "__mid"
    fixed = df.withColumn(mid, F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftrightunsigned(F.col(mid), 33)
    counts = sorted((r["p"], r["n"]) for r in fixed.groupBy(part.alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, run = [], 0
    for p, n in counts:
        offsets.append((p, run))
        run += n
    offs = spark.createDataFrame(offsets, "__p long, __off long")
    within = F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    out = fixed.join(F.broadcast(offs), part == F.col("__p"), "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("__off") + within).alias(name))
