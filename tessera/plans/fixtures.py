"""Stand-in frames built from the driver's tables.

* ``sales``    one row per lineitem: item_id, price, discount, quantity, and,
               when asked, the region of the order's customer.
* ``products`` part.
* ``churn``    documents LEFT JOIN labels (target ``toxic``; unlabeled rows
               are the missing values); for the models, text features with
               target ``poor``.
* ``scored``   events with a 0/1 label and a score in [0, 1] on a 0.01 grid.

Region lookups go orders -> customer -> nation -> region.  These are key
lookups (TPC-H primary keys), so attaching a region never changes the number
of sales rows; a sales query that does not need the region skips the joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load, table_path  # noqa: F401

# The stand-in column mapping (reference name -> table column).
SALES_COLUMNS = {
    "item_id": "l_partkey",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "quantity": "l_quantity",
}



def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_nationkey, region): nation joined to region."""
    region = load(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = load(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return nr.select("n_nationkey", F.col("r_name").alias("region"))


def order_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, region) for every order."""
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    oc = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    nr = nation_regions(spark, sf_dir)
    return (oc.join(nr, oc.c_nationkey == nr.n_nationkey, "left")
              .select("o_orderkey", "region"))


def sales(spark: SparkSession, sf_dir: str, with_region: bool = False) -> DataFrame:
    """The sales table: l_orderkey, l_linenumber, item_id, price, discount,
    quantity[, region]."""
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber",
              *SALES_COLUMNS.values())
    df = li.select("l_orderkey", "l_linenumber",
                   *[F.col(src).alias(dst) for dst, src in SALES_COLUMNS.items()])
    if not with_region:
        return df
    orr = order_regions(spark, sf_dir)
    return (df.join(orr, df.l_orderkey == orr.o_orderkey, "left").drop("o_orderkey"))


def region_rollup(spark: SparkSession, sf_dir: str, measures: Mapping[str, Column]) -> DataFrame:
    """Decomposable sums of lineitem expressions per region, aggregated early.

    Instead of joining every lineitem to its order, customer and nation (three
    shuffles of the largest table), the sums are pushed below each join:
    lineitem is reduced per order, the result per customer, that per nation,
    and only then attached to the region.  Each join sees one row per key,
    so a hot order or customer cannot skew it, and each shuffle is smaller
    than the one before.  ``measures`` maps output names to aggregate columns
    over lineitem that are sums (or counts); they are re-summed at each level.
    """
    li = load(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(*[m.alias(n) for n, m in measures.items()])
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    resum = [F.sum(n).alias(n) for n in measures]
    per_cust = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey, "left")
                .groupBy("o_custkey").agg(*resum))
    customer = load(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    per_nation = (per_cust.join(customer, per_cust.o_custkey == customer.c_custkey, "left")
                  .groupBy("c_nationkey").agg(*resum))
    nr = nation_regions(spark, sf_dir)
    return (per_nation.join(nr, per_nation.c_nationkey == nr.n_nationkey, "left")
            .filter(F.col("region").isNotNull())
            .groupBy("region").agg(*resum))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part as the products table, keyed ``item_id``."""
    part = load(spark, sf_dir, "part")
    return part.withColumnRenamed("p_partkey", "item_id")


def churn(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """documents LEFT JOIN labels: doc_id, text, lang, source, n_chars, quality, toxic.

    Without the text, an empty string stands for every text that is present:
    types and missing values stay as they are, and no text crosses the join.
    """
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    if not with_text:
        docs = docs.withColumn("text", F.when(F.col("text").isNotNull(), F.lit("")))
    labels = load(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling table: doc_id, lang, source, n_chars, n_words, distinct_pct,
    symbol_pct (whole percents of the words), poor (1 if quality is 0).

    Rows with any missing value are dropped, as in ``churn_clean``; the text is
    reduced to its features before the join with the labels.
    """
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    symbols = F.filter("w", lambda w: w.rlike(r"[#*$%&|<>]"))
    n = F.greatest(F.size("w"), F.lit(1))
    percent = lambda part: F.floor(F.size(part) * 100 / n)
    feats = (docs.na.drop("any").withColumn("w", words)
             .select("doc_id", "lang", "source", "n_chars", F.size("w").cast("long").alias("n_words"),
                     percent(F.array_distinct("w")).alias("distinct_pct"), percent(symbols).alias("symbol_pct")))
    labels = load(spark, sf_dir, "labels", "doc_id", "quality", "toxic").na.drop("any")
    return feats.join(labels, "doc_id").select(*feats.columns, (F.col("quality") == 0).cast("int").alias("poor"))


SCORE_EXPR = "least(cast(floor(value / 2) as int), 100) / 100D"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (event_id, y, score): y = purchase, score on a 0.01 grid."""
    ev = load(spark, sf_dir, "events", "event_id", "event_type", "value")
    return ev.select(
        "event_id",
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.expr(SCORE_EXPR).alias("score"))
