"""Records of CSV files with quoted line breaks, read by many tasks a file.

Spark splits a text file by bytes at line ends, and a quoted field may hold line
ends.  The number of quotes before a line tells whether it starts inside a field:
a doubled quote adds two, so only whether the number is odd counts.  One scan
counts the quotes of every split; prefixed over the splits of a file (one small
row per split) they tell each split how it begins.  The next scan joins lines to
records inside the splits; only the pieces of records that cross a border, two a
split at most, are put together by a shuffle.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "file string, block long, kind int, first boolean, text string"


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, odd, value), split by split in file order -> whole records and pieces at the borders.

    A head ends a record begun in an earlier split; a tail is not ended in its own.
    """
    key: tuple | None = None
    held: list[str] = []
    inside = heading = first = False

    def flush(out: list) -> None:
        if held:
            kind = HEAD if heading else TAIL if inside else WHOLE
            out.append((*key, kind, first and not heading, "\n".join(held)))
            held.clear()

    for b in batches:
        out: list[tuple] = []
        for file, block, odd, line in zip(*(b.column(c).to_pylist() for c in ("file", "block", "odd", "value"))):
            if (file, block) != key:
                flush(out)
                key, inside, heading, first = (file, block), odd, odd, block == 0
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                flush(out)
                heading = first = False
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
                names=["file", "block", "kind", "first", "text"])
    out = []
    flush(out)
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
            names=["file", "block", "kind", "first", "text"])


def records(spark: SparkSession, path) -> DataFrame:
    """(file, first, text) of every record; ``first`` marks the first one of a file.  UTF-8, lines end in \\n or \\r\\n."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    sums = sorted((r["file"], r["block"], r["n"]) for r in lines.groupBy("file", "block").agg(
        F.sum(_quotes(F.col("value"))).alias("n")).collect())  # one row per split
    starts, before = [], {}
    for file, block, n in sums:
        starts.append((file, block, before.get(file, 0) % 2 == 1))
        before[file] = before.get(file, 0) + n
    odd = spark.createDataFrame(starts, "file string, block long, odd boolean")
    pieces = lines.join(F.broadcast(odd), ["file", "block"]).select("file", "block", "odd", "value").mapInArrow(_cut, _PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "first", "text")
    order = Window.partitionBy("file").orderBy("block", "kind")  # two pieces a split at most
    cut = pieces.where(F.col("kind") != WHOLE).withColumn(
        "record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = cut.groupBy("file", "record").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))), lambda p: p["text"]), "\n")
        .alias("text")).select("file", "first", "text")
    return whole.unionByName(joined).withColumn("text", F.regexp_replace("text", "\r$", ""))


def header_names(text: str, sep: str) -> list[str]:
    """Column names of a header record; empty ones by position, repeated ones with it."""
    names = next(csv.reader([text.removeprefix("﻿")], delimiter=sep), [])
    seen = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if seen.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_text_columns(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """All fields as text, columns named by the header of the first file; the headers of the others are left out."""
    found = records(spark, path)
    top = found.where("first").orderBy("file").limit(1).collect()
    if not top:
        return spark.createDataFrame([], T.StructType([]))
    names = header_names(top[0]["text"], sep)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {"quote": '"', "escape": '"', "sep": sep, "mode": "FAILFAST"}
    rows = found.where(~F.col("first") & (F.col("text") != "")).select(
        F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("r"))
    return rows.select(*[F.col("r")[f"c{i}"].alias(n) for i, n in enumerate(names)])
