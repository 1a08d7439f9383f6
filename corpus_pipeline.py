"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept (written as Parquet and read
again); its decisions take effect on the documents; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, packing, quality, simhash, toxicity
from tessera.llm.common import materialize
from tessera.llm.queries import VOCABULARY
from tessera.session import ensure_checkpoint_dir, ship_package
from tessera.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    _ready(spark)
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _ready(spark)
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, at most two bits)."""
    _ready(spark)
    return simhash.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    _ready(spark)
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 4096 tokens."""
    _ready(spark)
    return packing.pack(docs, VOCABULARY)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_copies", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Scoring models, random rounding and tokenisation have no SQL form: tests hold the rows against brute force.
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    _ready(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
