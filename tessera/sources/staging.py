"""Safe sinks: write to a staging folder, then swap it in.

Spark overwrites lazily: ``df.write.mode('overwrite').csv(p)`` on a frame read
from ``p`` deletes the source before the job reads it, destroying the data.
The reference rewrites the file it read (eager pandas), so our sinks always
write a sibling staging folder first and replace the target only after the
write has succeeded.  On HDFS the renames are atomic; on object stores the
swap is a copy: write versions of the folder there (``versions``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def swap_in(spark: SparkSession, staging: str, target: str) -> None:
    """Replace ``target`` by ``staging`` (old target removed after the swap)."""
    fs, t = _fs(spark, target)
    _, s = _fs(spark, staging)
    old = None
    if fs.exists(t):
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
        if not fs.rename(t, old):
            raise OSError(f"could not move {target} aside")
    if not fs.rename(s, t):
        if old is not None:
            fs.rename(old, t)
        raise OSError(f"could not move {staging} to {target}")
    if old is not None:
        fs.delete(old, True)


def staged_write(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None]) -> str:
    """Run ``write(df.write, staging_path)`` and swap the result into ``path``."""
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    write(df.write.mode("errorifexists"), staging)
    swap_in(df.sparkSession, staging, path)
    return path


def write_contents(df: DataFrame, column: str, path: str, extension: str) -> int:
    """One file per row from a binary column whose values all end in ``\\n``.

    Spark's text writer puts the bytes out as they are, followed by a line feed:
    the last byte is left to it.  Files so go through Spark's own commit
    protocol, into any file system that Spark writes to, and a lost or repeated
    task leaves nothing behind.  The driver then gives the files their
    ``extension``.  Returns the number of files.
    """
    body = F.expr(f"cast(substring(`{column}`, 1, length(`{column}`) - 1) as string)")
    df.select(body.alias("value")).write.option("maxRecordsPerFile", 1).mode("errorifexists").text(path)
    fs, folder = _fs(df.sparkSession, path)
    new = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    n = 0
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith("part-"):
            continue
        if status.getLen() == 0:  # Spark's empty file for an empty table
            fs.delete(status.getPath(), False)
            continue
        if not fs.rename(status.getPath(), new(folder, name.removesuffix(".txt") + extension)):
            raise OSError(f"could not rename {name}")
        n += 1
    return n
