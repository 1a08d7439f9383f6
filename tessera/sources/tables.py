"""Parquet tables of a scale-factor folder.

Reads are lazy; Catalyst prunes columns into the scan's ``ReadSchema`` and
pushes filters into ``PushedFilters``, so callers select what they need and
nothing more.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Lazy scan of one table, optionally projected to ``columns``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
