"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Sources get weights and share a budget of words; a source whose target would
pass its limit stops there and the excess is shared again by weight.  Every
document of a source then has the same copy rate (target / source size): its
whole part is certain, its fraction is a copy probability.  Dependent rounding
makes the fractions integral in pairs: of two documents one takes words from
the other until one fraction is 0 or 1, at random so that each keeps its
expectation.  What became integral is settled, the residual meets the next.
The words of a source stay the same in every duel, so that the source misses
its target by half of its last residual document at most.

The reduction is a tree: level 0 plays the duels inside blocks of documents of
one source and similar size, each higher level plays the residuals of ``BLOCK`` blocks below, up to one residual
per source.  Blocks hold about ``BLOCK`` rows however large the source is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import WORD, materialize, salted_left_join

#: Weights given to the sources in code-point order, repeating (null last).
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and the most copies of a source.
BUDGET, MOST_COPIES = 1.5, 2.0
#: Documents (or residuals) that one step of the tree settles together, about.
BLOCK = 256
#: A fraction nearer than this to 0 or 1 is integral.
NEAR = 1e-9


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from a hash of the keys: the same on every run."""
    h = F.xxhash64(F.lit(seed), *keys)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0, code-point order, null last) without a one-task window.

    Rows are range-partitioned and written; the rank is the row's place in its
    partition plus the rows of earlier partitions (one number per partition).
    """
    placed = materialize(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    offset = F.lit(0).cast("long")
    if before:
        offset = F.element_at(F.map_from_arrays(F.array(*[F.lit(p) for p in before]),
                                                F.array(*[F.lit(b).cast("long") for b in before.values()])),
                              F.col("part"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return placed.withColumn("rank", own + offset).drop("part")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
            most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Water-filling: the targets are ``min(most * size, level * weight)``.  Each
    round sums the limits of the sources that are full at the level so far and
    shares the rest anew; it ends when no further source fills up.  Only sums
    come to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    table = materialize(_ranked(sizes).withColumn("weight", weight), "mix-weights")
    limit = most * F.col("source_size")
    row = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, full = budget * (row[0] or 0), 0.0, -1
    while True:
        at = F.lit(level) * F.col("weight") >= limit
        row = table.agg(F.sum(F.when(at, F.col("source_size"))), F.sum(F.when(~at, F.col("weight"))),
                        F.count_if(at)).first()
        if row[2] == full or not row[1]:
            break
        full = row[2]
        level = max(level, (total - most * (row[0] or 0)) / row[1])
    return table.select("source", "source_size",
                        F.least(limit, F.lit(level) * F.col("weight")).alias("target"))


_ITEM = ("struct<doc_id:bigint,source:string,size:bigint,mark:bigint,repeats:bigint,"
         "source_size:bigint,target:double,whole:bigint,sure:bigint,p:double>")
_STATE = f"struct<held:{_ITEM},done:array<{_ITEM}>>"


def _duel(state: Column, item: Column, seed: int) -> Column:
    """One duel of the held residual with the next item; what becomes integral joins ``done``.

    Words move from one to the other until a fraction is 0 or 1: ``up`` words
    into the held one or ``down`` words out of it, at random so that both keep
    their expectation.  The words of the pair stay the same either way.
    """
    a, b = state["held"], item
    integral = lambda x: (x["p"] < NEAR) | (x["p"] > 1 - NEAR)
    closed = lambda x: x.withField("p", F.round(x["p"]))
    push = lambda held, done: F.struct(
        held.alias("held"), F.concat(state["done"], F.array(done)).alias("done"))

    def play(w: Column) -> Column:
        moved = F.when(w["u"] * (w["up"] + w["down"]) < w["down"], w["up"]).otherwise(-w["down"])
        return _let(moved, lambda m: _let(
            F.struct(a.withField("p", a["p"] + m / a["size"]).alias("a"),
                     b.withField("p", b["p"] - m / b["size"]).alias("b")),
            lambda n: F.when(integral(n["a"]), push(n["b"], closed(n["a"]))).otherwise(
                push(n["a"], closed(n["b"])))))

    words = F.struct(F.least((1 - a["p"]) * a["size"], b["p"] * b["size"]).alias("up"),
                     F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"]).alias("down"),
                     unit(seed, a["doc_id"], a["mark"], b["doc_id"], b["mark"]).alias("u"))
    return (F.when(a["p"].isNull(), F.struct(b.alias("held"), state["done"].alias("done")))
            .when(integral(a), push(b, closed(a)))
            .when(integral(b), push(a, closed(b)))
            .otherwise(_let(words, play)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _play(level: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Play all duels of each group of ``keys`` over its items, largest first: (keys, held, done)."""
    items = F.sort_array(F.collect_list(F.struct("item.size", F.xxhash64("item.doc_id", "item.mark").alias("h"), "item")),
                         asc=False)
    empty = F.struct(F.lit(None).cast(_ITEM).alias("held"), F.array().cast(f"array<{_ITEM}>").alias("done"))
    played = level.groupBy(*keys).agg(items.alias("items")).select(
        *keys, F.aggregate(F.col("items.item"), empty.cast(_STATE),
                           lambda state, item: _duel(state, item, seed)).alias("s"))
    return played.select(*keys, F.col("s.held").alias("held"), F.col("s.done").alias("done"))


def copies(items: DataFrame, shares: DataFrame, seed: int = 7) -> DataFrame:
    """Integral copies of each item.

    ``items``: (doc_id, source, size, mark, repeats), each combination once.
    ``shares``: (source, source_size, target).  Returns the items with
    ``source_size``, ``target``, ``whole`` and ``extra``: each of an item's
    ``repeats`` equal rows gets ``whole`` copies and ``extra`` of them one
    more.  Items of size 0 get no copies.
    """
    # sizes within a factor of 2^(1/4) form a stratum; a stratum has as many blocks as its rows need
    stratum = F.when(F.col("size") > 0, F.floor(4 * F.log2(F.col("size")))).otherwise(-1).cast("int")
    items = items.withColumn("stratum", stratum)
    strata = items.groupBy("source", "stratum").agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy("source").orderBy("stratum")
    blocks = F.ceil(F.col("n") / BLOCK)
    strata = strata.withColumn("blocks", blocks).withColumn(
        "before", F.sum("blocks").over(in_order) - F.col("blocks"))
    named = lambda df: df.withColumn("known", F.col("source").isNotNull()).withColumn(
        "source", F.coalesce("source", F.lit("")))
    plan = named(strata).join(named(shares), ["source", "known"]).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = materialize(plan.select("source", "known", "stratum", "blocks", "before", "rate",
                                    "source_size", "target"), "mix-plan")
    nodes = int(plan.agg(F.max(F.col("before") + F.col("blocks"))).first()[0] or 0)

    joined = salted_left_join(named(items), plan, ["source", "known", "stratum"], F.xxhash64("doc_id", "mark"))
    node = F.col("before") + F.pmod(F.xxhash64(F.lit(seed), "doc_id", "mark"), F.col("blocks"))
    rate = F.when(F.col("size") > 0, F.col("rate")).otherwise(0.0)
    whole = F.floor(rate + NEAR)
    # of an item's equal rows a whole number is sure of a further copy; the rest of the fraction plays
    together = F.when(rate - whole < NEAR, 0.0).otherwise((rate - whole) * F.col("repeats"))
    sure = F.floor(together + NEAR)
    fraction = F.when(together - sure < NEAR, 0.0).otherwise(together - sure)
    level = joined.select(
        "source", "known", node.alias("node"),
        F.struct("doc_id", F.when(F.col("known"), F.col("source")).alias("source"), "size", "mark", "repeats",
                 "source_size", "target", whole.cast("long").alias("whole"), sure.cast("long").alias("sure"),
                 fraction.alias("p")).alias("item"))

    settled = []
    step = 0
    while True:
        played = materialize(_play(level, ["source", "known", "node"], seed + step), "mix-level")
        settled.append(played.select(F.explode("done").alias("item")))
        step += 1
        if nodes <= 1:
            break
        nodes = -(-nodes // BLOCK)
        level = played.select("source", "known", F.floor(F.col("node") / BLOCK).alias("node"),
                              F.col("held").alias("item"))
    # the last residual of each source goes to the nearer side: its words are all that the target is missed by
    last = F.round("held.p")
    settled.append(played.select(F.col("held").withField("p", last).alias("item")))
    everything = settled[0]
    for more in settled[1:]:
        everything = everything.union(more)
    return everything.select("item.*").withColumn("extra", F.col("sure") + F.round("p").cast("long")).drop("sure", "p")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES,
          seed: int = 7) -> DataFrame:
    """(doc_id, source, size, mark, repeats, source_size, target, whole, extra): a row per distinct item.

    ``repeats`` counts rows equal in id, source and text (``mark`` is the
    text's hash); each gets ``whole`` copies and ``extra`` of them one more.
    A null or empty text has size 0 and is not taken.  Null is a source of its
    own, last in order; a null id is an id like any other.  An empty table
    gives an empty result; extra columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("mark"))
    items = materialize(rows.groupBy("doc_id", "source", "size", "mark").agg(F.count(F.lit(1)).alias("repeats")),
                        "mix-items")
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
    shares = materialize(targets(sizes, weights, budget, most), "mix-shares")
    return copies(items, shares, seed)


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: (doc_id, source, size, copies, source_size, target, taken)."""
    rows = mixed(docs, **options).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    copies_of = F.col("whole") + (F.col("row") <= F.col("extra")).cast("long")
    return rows.select("doc_id", "source", "size", copies_of.alias("copies"), "source_size", "target",
                       (copies_of * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents (columns doc_id, text, source and any others), each as often as the mix takes it."""
    got = materialize(mixed(docs, **options).where("whole > 0 or extra > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("mark").alias("__mark"),
        "repeats", "whole", "extra"), "mix-copies")
    # own names for all columns: those of ``docs`` may be anything
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    marked = docs.toDF(*at.values()).withColumn("__hash", F.xxhash64(at["text"]))
    match = (marked[at["doc_id"]].eqNullSafe(got["__id"]) & marked[at["source"]].eqNullSafe(got["__source"])
             & (marked["__hash"] == got["__mark"]))

    def taken(rows: DataFrame, times: Column) -> DataFrame:
        copied = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
        return copied.select("__doc.*").toDF(*docs.columns)

    joined = marked.join(got, match).select(
        F.struct(*at.values()).alias("__doc"), "__id", "__source", "__mark",
        F.col("repeats").alias("__repeats"), F.col("whole").alias("__whole"), F.col("extra").alias("__extra"))
    single = taken(joined.where("__repeats = 1"), F.col("__whole") + F.col("__extra"))
    if got.where("repeats > 1").isEmpty():
        return single
    # rows of equal id, source and text: those equal in all columns go together, the first ones take the extra copies
    many = joined.where("__repeats > 1").groupBy("__id", "__source", "__mark", "__doc").agg(
        F.count("*").alias("__n"), F.first("__whole").alias("__whole"), F.first("__extra").alias("__extra"))
    earlier = Window.partitionBy("__id", "__source", "__mark").orderBy("__doc").rowsBetween(
        Window.unboundedPreceding, -1)
    left = F.col("__extra") - F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    many = many.withColumn("__times", F.col("__whole") * F.col("__n") + F.least(
        F.greatest(left, F.lit(0)), F.col("__n"))).where("__times > 0")
    return single.union(taken(many, F.col("__times")))
