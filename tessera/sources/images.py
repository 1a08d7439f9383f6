"""Image folders: Spark's ``image`` source for reading, a PNG folder sink.

``plt.imread`` of one file becomes ``spark.read.format("image")`` over a
folder (one row per image: origin, height, width, nChannels, mode, data with
channels in BGR(A) order).  The per-pixel channel mean (``np.mean(image,
axis=2)``) decodes the bytes with NumPy inside an Arrow-batched Pandas UDF —
one vectorised call per image, no per-pixel Python.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import local_path
from tessera.sources.staging import swap_in

_COLOR_TYPE = {1: 0, 3: 2, 4: 6}   # channels -> PNG colour type (grey, RGB, RGBA)


def png_bytes(pixels: np.ndarray) -> bytes:
    """Encode an (H, W, C) uint8 array (C in 1, 3, 4) as PNG."""
    h, w, c = pixels.shape

    def chunk(kind: bytes, data: bytes) -> bytes:
        return (struct.pack(">I", len(data)) + kind + data
                + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF))
    raw = b"".join(b"\x00" + pixels[r].tobytes() for r in range(h))
    ihdr = struct.pack(">IIBBBBB", w, h, 8, _COLOR_TYPE[c], 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw))
            + chunk(b"IEND", b""))


def write_pngs(df: DataFrame, path: str, id_col: str, pixels_col: str, width: int,
               channels: int) -> str:
    """Write one PNG per row (``<id>.png``) from an array of 0..255 pixel values
    laid out row-major as (height, width, channels); staged folder swap."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    out_dir = local_path(staging)

    def write_part(batches):
        os.makedirs(out_dir, exist_ok=True)
        n = 0
        for b in batches:
            for key, px in zip(b[id_col], b[pixels_col]):
                arr = np.asarray(px, dtype=np.uint8).reshape(-1, width, channels)
                # named by key and renamed into place: a retried attempt
                # rewrites the same file, a killed one leaves no partial file
                tmp = os.path.join(out_dir, f".{key}.{uuid.uuid4().hex}")
                with open(tmp, "wb") as f:
                    f.write(png_bytes(arr))
                os.replace(tmp, os.path.join(out_dir, f"{key}.png"))
                n += 1
        yield pd.DataFrame({"files": [n]})

    df.select(id_col, pixels_col).mapInPandas(write_part, "files long").agg(F.sum("files")).collect()
    os.makedirs(out_dir, exist_ok=True)
    swap_in(spark, staging, path)
    return path


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """A folder of images as Spark's image rows; a file that cannot be decoded raises."""
    image = F.col("image")
    bad = F.raise_error(F.concat(F.lit("cannot decode image "), F.coalesce(image["origin"], F.lit("?"))))
    rows = spark.read.format("image").option("dropInvalid", False).load(path)
    broken = image["height"].isNull() | (image["height"] <= 0)
    return rows.select(F.when(~broken, image).otherwise(bad.cast(rows.schema["image"].dataType)).alias("image"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _channel_mean(data: pd.Series, height: pd.Series, width: pd.Series,
                  channels: pd.Series) -> pd.Series:
    out = []
    for d, h, w, c in zip(data, height, width, channels):
        a = np.frombuffer(d, dtype=np.uint8).reshape(int(h), int(w), int(c))
        out.append(a.mean(axis=2).ravel())
    return pd.Series(out)


def gray(image: Column | str = "image") -> Column:
    """Row-major per-pixel mean over the channels of an image struct column."""
    im = F.col(image) if isinstance(image, str) else image
    return _channel_mean(im["data"], im["height"], im["width"], im["nChannels"])


def quantize(x: Column) -> Column:
    """Map a value near [-1, 1] to an 8-bit sample: clamp(floor((x + 1) * 128))."""
    return F.least(F.greatest(F.floor((x.cast("double") + 1) * 128), F.lit(0)), F.lit(255)) \
        .cast("int")
