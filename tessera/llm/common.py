"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

#: Word pattern of the contracts: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared scratch folder: the table read back, and its path."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    if not _written:
        atexit.register(release)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage in a way that survives the loss of any executor, and
    computes the frame once however often the result is read.  The folder
    stays until ``release`` or the end of the application.
    """
    return write_scratch(df, name)[0]


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that nothing reads any more."""
    if (spark, path) in _written:
        _written.remove((spark, path))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession | None = None) -> None:
    """Delete the scratch tables written so far (at the end of the application by itself)."""
    for owner, path in list(_written):
        if spark is not None and owner is not spark:
            continue
        try:
            delete_scratch(owner, path)
        except Exception:  # the session is gone; the folder stays for the cluster's own clean-up
            return


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def is_held_out(doc_id: object, modulus: int, remainder: int) -> bool:
    """The Python twin of ``crc_mod`` (tests)."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus == remainder


def hash_sample(ids: DataFrame, id_col: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash of the id: the same on every run."""
    return ids.orderBy(F.xxhash64(id_col), F.col(id_col)).limit(bound)


def slices(batches: Iterator[pa.RecordBatch], text: str, rows: int = 512,
           max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows and about ``max_bytes`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (i - start >= rows or held + n > max_bytes):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def raw_texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """The text column as UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(text))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def keep_rows(docs: DataFrame, text: str, keep: Callable[[list[bytes]], np.ndarray],
              rows: int = 256) -> DataFrame:
    """The rows of ``docs`` whose text ``keep`` says yes to; all columns stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, rows=rows, max_bytes=4 << 20):
            yield b.filter(pa.array(np.asarray(keep(raw_texts(b, text)), dtype=bool)))

    return docs.mapInArrow(run, docs.schema)


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column,
                     salts: int = 16) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``keys`` where one key may hold a third of the left rows.

    Each left row gets one of ``salts`` numbers from ``spread`` and each right
    row appears once per number, so a hot key is met by ``salts`` tasks.  The
    right side should be narrow with at most one row per key.
    """
    salted = left.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted.join(copies, [*keys, "__salt"], "left").drop("__salt")
