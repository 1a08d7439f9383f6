"""Query catalogue: one Spark plan per operator and the SQL that checks it.

``QUERIES[name](spark, sf_dir)`` returns the Spark result; ``ORACLE[name]`` is
independent SQL over the raw tables (DuckDB dialect) computing the same
answer, column names included.  Queries without an SQL form (model fits,
random draws) have no ``ORACLE`` entry.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays, formatting
from tessera.operators import frame, metrics, ordered, prep, profile, skew
from tessera.plans import fixtures as fx
from tessera.session import ensure_checkpoint_dir, scratch_dir, ship_package
from tessera.sources import images, text_tables, workbooks

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)          # Python workers import this package
            ensure_checkpoint_dir(spark)  # checkpoint() needs one; kept if already set
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Prices, discounts and quantities carry two decimals: they are summed exactly.
MONEY = {"price": 2, "discount": 2, "quantity": 2}

SALES_SQL = """
with sales as (
  select l_orderkey, l_linenumber, l_partkey as item_id, l_extendedprice as price,
         l_discount as discount, l_quantity as quantity, r_name as region
  from lineitem
  left join orders on l_orderkey = o_orderkey
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey)
"""


def _exact_mean_sql(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(18,2))) as double) / count({c})"


def _exact_sum_sql(c: str) -> str:
    return f"coalesce(cast(sum(cast({c} as decimal(18,2))) as double), 0.0)"


# ------------------------------------------------------------ aggregates --

@register("multi_agg", SALES_SQL + f"""
select item_id, {_exact_mean_sql('price')} as price_mean, {_exact_sum_sql('price')} as price_sum,
       max(discount) as discount_max
from sales where item_id is not null group by item_id
""")
def multi_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """groupby(item).agg({price: [mean, sum], discount: max})."""
    return frame.group_agg(fx.sales(spark, sf_dir), "item_id",
                           {"price": ["mean", "sum"], "discount": "max"}, scales=MONEY)


@register("mean_by_item", SALES_SQL + f"""
select item_id, {_exact_mean_sql('price')} as price_mean
from sales where item_id is not null group by item_id
""")
def mean_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``groupby(item)[price].mean()``."""
    return frame.group_agg(fx.sales(spark, sf_dir), "item_id", {"price": "mean"}, scales=MONEY)


@register("mean_by_region", SALES_SQL + f"""
select region, {_exact_mean_sql('price')} as price_mean
from sales where region is not null group by region
""")
def mean_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price per region, with sums pushed below the lookup joins."""
    price = F.col("l_extendedprice")
    r = fx.region_rollup(spark, sf_dir, {
        "price_sum": F.sum(price.cast("decimal(18,2)")),
        "price_n": F.count(price)})
    return r.select("region", (F.col("price_sum").cast("double") / F.col("price_n"))
                    .alias("price_mean"))


@register("sum_by_region", SALES_SQL + f"""
select region, {_exact_sum_sql('quantity')} as quantity_sum
from sales where region is not null group by region
""")
def sum_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per region (the reference's ``monthly_sales``)."""
    r = fx.region_rollup(spark, sf_dir, {
        "quantity_sum": F.sum(F.col("l_quantity").cast("decimal(18,2)"))})
    return r.select("region", F.coalesce(F.col("quantity_sum").cast("double"), F.lit(0.0))
                    .alias("quantity_sum"))


@register("total_quantity", SALES_SQL + f"""
select {_exact_sum_sql('quantity')} as quantity_sum from sales
""")
def total_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales[quantity].sum()``."""
    return frame.total(fx.sales(spark, sf_dir), {"quantity": "sum"}, scales=MONEY)


# ------------------------------------------------------------ order, top-k --

@register("head_by_key", SALES_SQL + f"""
select item_id, {_exact_mean_sql('price')} as price_mean
from sales where item_id is not null group by item_id order by item_id limit 5
""")
def head_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``grouped.head()``: first five groups in key order."""
    grouped = frame.group_agg(fx.sales(spark, sf_dir), "item_id", {"price": "mean"}, scales=MONEY)
    return frame.top_k(grouped, "item_id", 5)


_SALE_ORDER = ["price", "l_orderkey", "l_linenumber", "item_id", "discount", "quantity"]


def _with_regions(spark: SparkSession, sf_dir: str, top: DataFrame) -> DataFrame:
    """Attach the region to a top-k result of at most k rows (k is the limit).

    The k rows go to the lookups as broadcast join sides (k is the bound), so
    orders and customer are scanned once and never shuffled.  Nothing runs
    before the result is asked for.
    """
    keys = top.select(F.col("l_orderkey").alias("__key")).distinct()
    orders = fx.load(spark, sf_dir, "orders", "o_orderkey", "o_custkey") \
        .join(F.broadcast(keys), F.col("o_orderkey") == F.col("__key"), "left_semi")
    customer = fx.load(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    hit = (customer.join(orders, customer.c_custkey == orders.o_custkey)
           .join(fx.nation_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
           .select("o_orderkey", "region"))
    return top.join(hit, top.l_orderkey == hit.o_orderkey, "left").drop("o_orderkey")


@register("cheapest_sale", SALES_SQL + """
select * from sales
order by price nulls last, l_orderkey, l_linenumber, item_id, discount, quantity limit 1
""")
def cheapest_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sort_values(price).head(1)`` with a full tie-break.

    The top-1 runs on lineitem alone (``TakeOrderedAndProject``: each task
    keeps its best row); the region is then looked up for the winning row
    only, through a filter pushed into the orders scan.
    """
    top = frame.top_k(fx.sales(spark, sf_dir), _SALE_ORDER[0], 1, tie_break=_SALE_ORDER[1:])
    return _with_regions(spark, sf_dir, top)


# ------------------------------------------------------------------ joins --

@register("left_join_hot_source", """
select d.doc_id, d.source, d.lang, d.n_chars as n_chars_x, s.n_docs, s.n_chars as n_chars_y
from documents d left join (
  select source, count(*) as n_docs, max(n_chars) as n_chars from documents group by source) s
  on d.source is not distinct from s.source
""")
def left_join_hot_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents beside the figures of their source: frequent sources are dealt over several tasks."""
    docs = fx.load(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars")
    figures = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.max("n_chars").alias("n_chars"))
    return skew.left_join_hot(docs, figures, "source")


@register("left_join_hot_null", """
with sales as (
  select l_orderkey, l_linenumber, case when l_orderkey % 3 > 0 then l_partkey end as item_id,
         l_extendedprice as price, l_discount as discount, l_quantity as quantity
  from lineitem)
select s.*, p_name, p_brand, p_type, p_size, p_retailprice
from sales s left join part p on s.item_id is not distinct from p.p_partkey
""")
def left_join_hot_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales.merge(products, how='left')`` where a third of the sales have no item."""
    sold = fx.sales(spark, sf_dir)
    known = F.when(F.col("l_orderkey") % 3 > 0, F.col("item_id"))
    return skew.left_join_hot(sold.withColumn("item_id", known), fx.products(spark, sf_dir), "item_id")


@register("left_join_products", SALES_SQL + """
select s.*, p_name, p_brand, p_type, p_size, p_retailprice
from sales s left join part p
  on s.item_id is not distinct from p.p_partkey
""")
def left_join_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales.merge(products, on=item, how='left')``."""
    return frame.left_join(fx.sales(spark, sf_dir, with_region=True),
                           fx.products(spark, sf_dir), "item_id")


# ---------------------------------------------------------------- profile --

_DESCRIBE_SCALES = {**MONEY, "l_orderkey": 0, "l_linenumber": 0, "item_id": 0}


def _describe_sql(c: str, scale: int) -> str:
    return (f"select '{c}' as column_name, count({c}) as count, "
            f"cast(sum(cast({c} as decimal(18,{scale}))) as double) / count({c}) as mean, "
            f"round(stddev_samp({c}), 4) as std, cast(min({c}) as double) as min, "
            f"round(quantile_cont({c}, 0.25), 4) as p25, round(quantile_cont({c}, 0.5), 4) as p50, "
            f"round(quantile_cont({c}, 0.75), 4) as p75, cast(max({c}) as double) as max from sales")


@register("describe_numeric", SALES_SQL + "\nunion all\n".join(
    _describe_sql(c, s) for c, s in _DESCRIBE_SCALES.items()))
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales.describe()``: one row per numeric column."""
    s = fx.sales(spark, sf_dir)
    return profile.describe(s, list(_DESCRIBE_SCALES), scales=_DESCRIBE_SCALES)


CHURN_SQL = """
with churn as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  from documents d left join labels l on d.doc_id = l.doc_id),
clean as (
  select doc_id, lang, source, n_chars, quality, toxic from churn
  where doc_id is not null and text is not null and lang is not null and source is not null
    and n_chars is not null and quality is not null and toxic is not null)
"""

_CHURN_COLS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
               ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]


@register("table_info", CHURN_SQL + "\nunion all\n".join(
    f"select {i} as position, '{c}' as column_name, count({c}) as non_null, '{t}' as dtype from churn"
    for i, (c, t) in enumerate(_CHURN_COLS)))
def table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``churn.info()``: non-null count and type per column."""
    return profile.info(fx.churn(spark, sf_dir, with_text=False))


@register("shape_of", CHURN_SQL + f"""
select count(*) as n_rows, cast({len(_CHURN_COLS)} as bigint) as n_columns from churn
where doc_id is not null and text is not null and lang is not null and source is not null
  and n_chars is not null and quality is not null and toxic is not null
""")
def shape_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``df.dropna().shape``."""
    return frame.shape(frame.drop_missing(fx.churn(spark, sf_dir, with_text=False)))


@register("null_share", CHURN_SQL + "\nunion all\n".join(
    f"select '{c}' as column_name, cast(count(*) - count({c}) as double) / count(*) as null_share "
    f"from churn" for c, _ in _CHURN_COLS))
def null_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``df[c].isna().sum() / len(df)`` for every column in one pass."""
    return frame.null_share(fx.churn(spark, sf_dir, with_text=False))


def churn_clean_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case names, drop rows with any missing value, drop the free text."""
    df = frame.lower_case_columns(fx.churn(spark, sf_dir, with_text=False))
    return frame.drop_columns(frame.drop_missing(df), ["text"])


@register("churn_clean", CHURN_SQL + "select * from clean")
def churn_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased names, ``dropna()`` over all columns, free text dropped."""
    return churn_clean_frame(spark, sf_dir)


@register("class_share", CHURN_SQL + """
select cast(count_if(toxic = 1) as double) / count(*) as share_1,
       cast(count_if(toxic = 0) as double) / count(*) as share_0 from clean
""")
def class_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each class of the target, one pass."""
    df = churn_clean_frame(spark, sf_dir)
    return frame.count_where(df, {"share_1": F.col("toxic") == 1, "share_0": F.col("toxic") == 0},
                             share=True)


# The categories of lang and source in the fixture tables, sorted.
_LANGS = ["de", "en", "es", "fr"]
_SOURCES = sorted(f"src{i}" for i in range(20))


@register("one_hot", CHURN_SQL + "select doc_id, n_chars, quality, toxic, " + ", ".join(
    [f"coalesce(lang = '{v}', false) as lang_{v}" for v in _LANGS[1:]]
    + [f"coalesce(source = '{v}', false) as source_{v}" for v in _SOURCES[1:]]) + " from clean")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pd.get_dummies(df, drop_first=True)`` on the cleaned churn table."""
    return prep.one_hot(churn_clean_frame(spark, sf_dir))


def _split_sql(select: str) -> str:
    return CHURN_SQL + f""",
r as (select *, row_number() over (order by md5('12345:' || cast(doc_id as varchar)), doc_id) as rn,
             count(*) over () as n from clean),
s as (select *, n - cast(ceil(0.4 * n) as bigint) as n_train,
             cast(ceil(0.4 * n) as bigint) - cast(ceil(0.5 * cast(ceil(0.4 * n) as bigint)) as bigint)
               as n_valid from r)
{select}"""


_PART_SQL = ("case when rn <= n_train then 'train' when rn <= n_train + n_valid then 'valid' "
             "else 'test' end")


@register("split_60_20_20", _split_sql(f"select doc_id, toxic, {_PART_SQL} as part from s"))
def split_60_20_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two seeded splits (0.4, then 0.5 of the rest): train/valid/test labels."""
    df = churn_clean_frame(spark, sf_dir).select("doc_id", "toxic")
    return prep.split_three(df, "doc_id", seed=12345)


@register("dense_ordinal", CHURN_SQL + """
select row_number() over (order by doc_id) - 1 as idx, doc_id from clean
""")
def dense_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reset_index(drop=True)``: a dense 0-based ordinal in key order."""
    df = churn_clean_frame(spark, sf_dir).select("doc_id")
    ranked = ordered.ordered_index(df, ["doc_id"])
    return ranked.select((F.col("__rank") - 1).alias("idx"), "doc_id")


@register("balanced_weights", CHURN_SQL + """
select doc_id, toxic, cast(count(*) over () as double)
       / cast(count(*) over (partition by toxic) * (select count(distinct toxic) from clean) as double)
       as class_weight from clean
""")
def balanced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``class_weight='balanced'``: n / (k * n_class) per row."""
    df = churn_clean_frame(spark, sf_dir).select("doc_id", "toxic")
    return prep.balanced_weights(df, "toxic")


# ----------------------------------------------------------------- arrays --

def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.load(spark, sf_dir, "embeddings", "vec_id", "embedding")


@register("array_slice", """
select vec_id, embedding[1] as first, embedding[2:4] as middle,
       list_reverse(embedding) as reversed from embeddings
""")
def array_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``a[0]``, ``a[1:4]``, ``a[::-1]`` on every vector."""
    e = F.col("embedding")
    return _embeddings(spark, sf_dir).select(
        "vec_id", arrays.element(e, 0).alias("first"), arrays.slice0(e, 1, 4).alias("middle"),
        arrays.reverse(e).alias("reversed"))


@register("array_add", """
select vec_id, [cast(embedding[i] as double) + cast(embedding[len(embedding) + 1 - i] as double)
                for i in range(1, len(embedding) + 1)] as added from embeddings
""")
def array_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``arr1 + arr2`` elementwise: each vector plus its reverse."""
    e = F.col("embedding")
    return _embeddings(spark, sf_dir).select("vec_id", arrays.add(arrays.as_double(e), arrays.as_double(F.reverse(e))).alias("added"))


@register("array_scale", """
select vec_id, [cast(x as double) * cast(2.0 as double) for x in embedding] as scaled
from embeddings
""")
def array_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``arr * 2``."""
    return _embeddings(spark, sf_dir).select(
        "vec_id", arrays.scale(arrays.as_double("embedding"), 2.0).alias("scaled"))


@register("axis_mean", """
select vec_id, [(cast(embedding[i * 4 + 1] as double) + cast(embedding[i * 4 + 2] as double)
                 + cast(embedding[i * 4 + 3] as double) + cast(embedding[i * 4 + 4] as double))
                / cast(4 as double) for i in range(0, 16)] as gray
from embeddings
""")
def axis_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``np.mean(image, axis=2)``: 64 values = 16 pixels x 4 channels."""
    return _embeddings(spark, sf_dir).select(
        "vec_id", arrays.axis_mean("embedding", 4).alias("gray"))


@register("array_build", """
select vec_id, 2 as n_dims, cast(len(embedding) / 4 as int) as n_rows, 4 as n_cols,
       'float' as dtype,
       [cast(0 as double) for x in embedding] as zeros,
       [[cast(1 as double) for j in range(4)] for i in range(cast(len(embedding) / 4 as int))] as ones,
       [cast(k as bigint) for k in range(0, len(embedding), 2)] as evens
from embeddings
""")
def array_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape facts (ndim, shape, dtype) of each vector seen as pixels x
    channels, and zeros / ones / arange arrays of matching size."""
    e = F.col("embedding")
    m = arrays.reshape(e, 4)
    return _embeddings(spark, sf_dir).select(
        "vec_id", F.lit(2).alias("n_dims"), F.size(m).alias("n_rows"),
        F.size(m[0]).alias("n_cols"),
        F.lit(spark.read.parquet(fx.table_path(sf_dir, "embeddings")).schema["embedding"]
              .dataType.elementType.simpleString()).alias("dtype"),
        arrays.zeros(F.size(e)).alias("zeros"), arrays.ones(F.size(m), 4).alias("ones"),
        arrays.arange(0, F.size(e), 2).alias("evens"))


@register("range_square", """
select p_partkey, p_partkey * p_partkey as key_sq, cast(p_size as bigint) * p_size as size_sq
from part
""")
def range_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``arr ** 2`` over whole columns (integral stays integral)."""
    p = fx.load(spark, sf_dir, "part", "p_partkey", "p_size")
    return p.select("p_partkey", arrays.square("p_partkey").alias("key_sq"),
                    arrays.square(F.col("p_size").cast("long")).alias("size_sq"))


@register("ratio_square", """
select p_partkey, p_retailprice / (cast(p_size as double) * p_size) as ratio from part
""")
def ratio_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weight / height ** 2`` (BMI form): price per squared size."""
    p = fx.load(spark, sf_dir, "part", "p_partkey", "p_retailprice", "p_size")
    size = F.col("p_size").cast("double")
    return p.select("p_partkey", F.try_divide(F.col("p_retailprice"), size * F.col("p_size"))
                    .alias("ratio"))


@register("tally", """
select cast(count_if(event_type = 'click') as bigint) as heads,
       cast(count_if(event_type = 'view') as bigint) as tails from events
""")
def tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coin-toss tally: two conditional counts in one pass."""
    ev = fx.load(spark, sf_dir, "events", "event_type")
    return frame.count_where(ev, {"heads": F.col("event_type") == "click",
                                  "tails": F.col("event_type") == "view"})


_COIN_SQL = """
with flips as (
  select event_id, cast((instr('0123456789abcdef',
                               substr(md5('42:' || cast(event_id as varchar)), 32, 1)) - 1) % 2
                         as int) as flip
  from events)
"""


@register("random_coin", _COIN_SQL + "select event_id, flip from flips")
def random_coin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``randint(0, 2, size=n)``: one seeded, partition-independent draw per event."""
    ev = fx.load(spark, sf_dir, "events", "event_id")
    return ev.select("event_id", arrays.coin(F.col("event_id"), seed=42).alias("flip"))


@register("coin_tally", _COIN_SQL + """
select cast(count_if(flip = 0) as bigint) as heads, cast(count_if(flip = 1) as bigint) as tails
from flips
""")
def coin_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tally of the seeded draws (the reference's loop of ``if``/``elif``)."""
    flips = random_coin(spark, sf_dir)
    return frame.count_where(flips, {"heads": F.col("flip") == 0, "tails": F.col("flip") == 1})


# ---------------------------------------------------------------- metrics --

SCORED_SQL = """
with scored as (
  select event_id, cast(event_type = 'purchase' as int) as y,
         least(cast(floor(value / 2) as int), 100) / cast(100 as double) as score from events)
"""
# The reference's operating threshold and its two sweep grids.
THRESHOLD = 0.36
SWEEP_TREE = (0.0, 0.9, 0.02)     # np.arange(0, 0.9, 0.02): 45 points
SWEEP_FOREST = (0.0, 0.8, 0.02)   # np.arange(0, 0.8, 0.02): 40 points


def _ratio_sql(num: str, den: str) -> str:
    return f"case when {den} > 0 then cast({num} as double) / cast({den} as double) else 0.0 end"


@register("confusion", SCORED_SQL + f"""
select cast(count_if(y = 1 and score > cast({THRESHOLD} as double)) as bigint) as tp,
       cast(count_if(y = 0 and score > cast({THRESHOLD} as double)) as bigint) as fp,
       cast(count_if(y = 0 and not score > cast({THRESHOLD} as double)) as bigint) as tn,
       cast(count_if(y = 1 and not score > cast({THRESHOLD} as double)) as bigint) as fn from scored
""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts of ``score > 0.36``."""
    s = fx.scored(spark, sf_dir)
    return metrics.confusion(s, "y", F.col("score") > THRESHOLD)


@register("f1", SCORED_SQL + f"""
, c as (select count_if(y = 1 and score > cast({THRESHOLD} as double)) as tp,
               count_if(y = 0 and score > cast({THRESHOLD} as double)) as fp,
               count_if(y = 1 and not score > cast({THRESHOLD} as double)) as fn from scored)
select {_ratio_sql('tp', 'tp + fp')} as precision, {_ratio_sql('tp', 'tp + fn')} as recall,
       {_ratio_sql('2 * tp', '2 * tp + fp + fn')} as f1 from c
""")
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of ``score > 0.36``."""
    s = fx.scored(spark, sf_dir)
    return metrics.scores(s, "y", F.col("score") > THRESHOLD).select("precision", "recall", "f1")


@register("accuracy", SCORED_SQL + """
select cast(count_if((y = 1) = (score > cast(0.5 as double))) as double) / count(*) as accuracy
from scored
""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model.score``: share of correct class predictions (score > 0.5)."""
    s = fx.scored(spark, sf_dir)
    return metrics.accuracy(s, "y", F.col("score") > 0.5)


def _sweep_sql(n: int, select: str) -> str:
    return SCORED_SQL + f"""
, t as (select k * cast(0.02 as double) as threshold from range({n}) r(k))
, c as (select threshold, cast(count_if(y = 1 and score > threshold) as bigint) as tp,
               cast(count_if(y = 0 and score > threshold) as bigint) as fp,
               cast(count_if(y = 1 and not score > threshold) as bigint) as fn
        from t cross join scored group by threshold)
, m as (select threshold, tp, fp, fn, {_ratio_sql('tp', 'tp + fp')} as precision,
               {_ratio_sql('tp', 'tp + fn')} as recall,
               {_ratio_sql('2 * tp', '2 * tp + fp + fn')} as f1 from c)
{select}"""


@register("threshold_sweep", _sweep_sql(45, "select * from m"))
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision/recall/F1 at thresholds 0, 0.02, ..., 0.88 (strict ``>``)."""
    return metrics.threshold_sweep(fx.scored(spark, sf_dir), "y", "score",
                                   metrics.threshold_grid(*SWEEP_TREE))


@register("best_threshold", _sweep_sql(40, "select * from m order by f1 desc, threshold limit 1"))
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The F1-best threshold of the 40-point forest sweep."""
    sweep = metrics.threshold_sweep(fx.scored(spark, sf_dir), "y", "score",
                                    metrics.threshold_grid(*SWEEP_FOREST))
    return metrics.best_threshold(sweep)


_CUM_SQL = SCORED_SQL + """
, per as (select score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg
          from scored group by score)
, cum as (select score, pos, neg,
                 cast(sum(pos) over (order by score desc) as bigint) as tps,
                 cast(sum(neg) over (order by score desc) as bigint) as fps from per)
"""


@register("pr_curve", _CUM_SQL + """
select score as threshold, cast(tps as double) / (tps + fps) as precision,
       cast(tps as double) / (select max(tps) from cum) as recall from cum
union all select cast(null as double), cast(1 as double), cast(0 as double)
""")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``precision_recall_curve`` as a table."""
    return metrics.pr_curve(fx.scored(spark, sf_dir), "y", "score")


@register("roc_curve", _CUM_SQL + """
, t as (select max(tps) as p, max(fps) as n from cum)
, z as (select *, lag(tps) over (order by score desc) as t0, lead(tps) over (order by score desc) as t1,
               lag(fps) over (order by score desc) as f0, lead(fps) over (order by score desc) as f1
        from cum)
select score as threshold, cast(fps as double) / n as fpr, cast(tps as double) / p as tpr
from z cross join t
where t0 is null or t1 is null or t1 - 2 * tps + t0 <> 0 or f1 - 2 * fps + f0 <> 0
union all select cast('Infinity' as double), cast(0 as double), cast(0 as double)
""")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``roc_curve`` (collinear points dropped, starting at +inf)."""
    return metrics.roc_curve(fx.scored(spark, sf_dir), "y", "score")


@register("roc_auc", _CUM_SQL + """
, z as (select tps, fps, coalesce(lag(tps) over (order by score desc), 0) as t0,
               coalesce(lag(fps) over (order by score desc), 0) as f0 from cum)
select cast(sum((fps - f0) * (tps + t0)) as double) / 2
       / (cast(max(tps) as double) * max(fps)) as auc from z
""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``roc_auc_score``, exact."""
    return metrics.roc_auc(fx.scored(spark, sf_dir), "y", "score")


# ------------------------------------------------------- sources and sinks --

@register("csv_roundtrip", "select * from part")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``to_csv(index=False)`` then ``read_csv``: part survives unchanged."""
    part = fx.load(spark, sf_dir, "part")
    path = scratch_dir(spark, "csv")
    text_tables.write_csv(part, path)
    return text_tables.read_csv(spark, path, schema=part.schema)


@register("csv_versions", "select doc_id, lang, source, n_chars + 2 as n_chars from documents")
def csv_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV folder rewritten twice from itself, each time as a new version: ``n_chars`` grows by one a rewrite."""
    docs = fx.load(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    path = scratch_dir(spark, "csvversions")
    text_tables.write_csv(docs, path, versioned=True)
    for _ in range(2):
        now = text_tables.read_csv(spark, path, schema=docs.schema)
        grown = (F.col("n_chars") + 1).cast(docs.schema["n_chars"].dataType)
        text_tables.write_csv(now.withColumn("n_chars", grown), path, versioned=True)
    return text_tables.read_csv(spark, path, schema=docs.schema)


@register("json_roundtrip", "select * from part")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``to_json`` (lines) then ``read_json``: part survives unchanged."""
    part = fx.load(spark, sf_dir, "part")
    path = scratch_dir(spark, "json")
    text_tables.write_json(part, path, orient="lines")
    return text_tables.read_json(spark, path, orient="lines", schema=part.schema)


@register("json_columns_roundtrip", "select * from part")
def json_columns_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's default JSON layout ``{"col": {"row": value}}``, written
    as a folder of parts and read back (full float precision)."""
    part = fx.load(spark, sf_dir, "part")
    path = scratch_dir(spark, "jsoncols")
    text_tables.write_json(part, path, orient="columns", double_precision=15)
    return text_tables.read_json(spark, path, orient="columns", schema=part.schema)


@register("xlsx_roundtrip", "select * from part")
def xlsx_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``to_excel(sheet_name='Sheet1', index=False)`` then ``read_excel``."""
    part = fx.load(spark, sf_dir, "part")
    path = scratch_dir(spark, "xlsx")
    workbooks.write_xlsx(part, path, sheet_name="Sheet1")
    return workbooks.read_xlsx(spark, path, sheet_name="Sheet1", schema=part.schema)


def _q_sql(i: str) -> str:
    return f"least(greatest(floor((cast(embedding[{i}] as double) + 1) * 128), 0), 255)"


@register("image_gray", f"""
select vec_id, [cast({_q_sql('i * 4 + 1')} + {_q_sql('i * 4 + 2')} + {_q_sql('i * 4 + 3')}
                     + {_q_sql('i * 4 + 4')} as double) / 4 for i in range(0, 16)] as gray
from embeddings
""")
def image_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``imread`` + ``np.mean(image, axis=2)`` over a folder of images.

    Each embedding becomes a 4x4 RGBA PNG (64 values quantised to 8 bits),
    the folder is read back with Spark's image source and every pixel's
    channel mean is computed.
    """
    e = _embeddings(spark, sf_dir).select(
        "vec_id", F.transform("embedding", images.quantize).alias("px"))
    path = scratch_dir(spark, "png")
    images.write_pngs(e.withColumn("name", F.concat(F.lit("vec-"), F.col("vec_id").cast("string"))),
                      path, "name", "px", width=4, channels=4)
    img = images.read_images(spark, path)
    return img.select(
        F.regexp_extract("image.origin", r"vec-(\d+)\.png$", 1).cast("long").alias("vec_id"),
        images.gray("image").alias("gray"))


@register("sweep_report", _sweep_sql(45, """
select threshold, printf('Threshold = %.2f | Precision = %.3f, Recall = %.3f',
                         threshold, precision, recall) as line, f1 from m"""))
def sweep_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep printed as the reference prints it: one text line and the
    F1 per threshold."""
    sweep = metrics.threshold_sweep(fx.scored(spark, sf_dir), "y", "score",
                                    metrics.threshold_grid(*SWEEP_TREE))
    return sweep.select("threshold", formatting.sweep_line("threshold", "precision", "recall")
                        .alias("line"), "f1")


_SALE_KEY = ["l_orderkey", "l_linenumber", "item_id", "price", "discount", "quantity"]


@register("sales_head", SALES_SQL + """
select * from sales order by l_orderkey, l_linenumber, item_id, price, discount, quantity limit 5
""")
def sales_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales.head()`` in key order (a table has no file order in Spark): the
    top-5 is found on lineitem alone, then the 5 rows get their region."""
    top = frame.top_k(fx.sales(spark, sf_dir), _SALE_KEY, 5)
    return frame.top_k(_with_regions(spark, sf_dir, top), _SALE_KEY, 5)


@register("left_join_head", SALES_SQL + """
select s.*, p_name, p_brand, p_type, p_size, p_retailprice
from sales s left join part p
  on s.item_id is not distinct from p.p_partkey
order by l_orderkey, l_linenumber, s.item_id, price, discount, quantity,
         p_name, p_brand, p_type, p_size, p_retailprice limit 10
""")
def left_join_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``full.head(10)`` of the left join, in key order.

    A left join keeps every left row at least once, so the first 10 joined
    rows come from the first 10 left rows: the top-10 runs on lineitem, only
    those rows are joined (part is cut to their keys first), and the
    result is cut to 10 again.
    """
    left = _with_regions(spark, sf_dir, frame.top_k(fx.sales(spark, sf_dir), _SALE_KEY, 10))
    keys = left.select("item_id").distinct()  # at most 10 rows
    products = fx.products(spark, sf_dir).join(F.broadcast(keys), "item_id", "left_semi")
    joined = frame.left_join(left, products, "item_id")
    order = _SALE_KEY + ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    return frame.top_k(joined, order, 10)
