"""Exact top-k inner products over norm-sorted blocks.

Vectors are dealt to blocks in order of falling length.  Queries, in blocks of
their own, first meet the longest block, which gives each a lower bound for its
k-th best score.  By Cauchy-Schwarz a query need not meet a block whose longest
vector cannot reach that bound, and blocks after it are shorter still; so each
query block is paired only with a prefix of the blocks.  The prefix is met in
rounds of growing length; after each, the k-th best scores so far raise the
bounds and shorten the prefixes.  A round is dealt in tiles of neighbouring
query blocks and blocks, so that both are shipped once a tile, not once a pair.
Inside a pair, sums
over the leading axes of an SVD rotation plus the product of the residual
lengths bound every score; candidates that no query can use are dropped axis
group by axis group, and the rest is scored exactly in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

#: Rows of a candidate block and of a query block, about; sub-blocks inside a task hold this many at most.
BLOCK_ROWS, QUERY_ROWS = 4_096, 512
#: Blocks whose longest vector the driver knows, at most (for the prefix that a query block meets).
STEPS = 1_024
#: Tiles along the blocks of either side, at least (as far as there are blocks), and blocks in a side of a tile, at most.
LEAST_TILES, MOST_IN_TILE = 64, 64
#: Tiles along the blocks in the first round, and by how much a round is longer than the one before.
FIRST_TILES, GROWTH = 8, 4
#: Part of the axes after which candidates are dropped.
AXIS_PARTS = (0.25, 0.5)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, v, norm2) with v = floor(scale * x); rows with nulls or non-finite components go."""
    x = F.col(vector_col)
    ok = F.col(id_col).isNotNull() & x.isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).withColumn(
        "norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """List column as a whole-number matrix, shorter vectors filled with zeros."""
    offsets = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy()[column.offsets[0].as_py():column.offsets[len(column)].as_py()]
    if (offsets == dim).all():
        return flat.reshape(-1, dim).astype(np.int64)
    out = np.zeros((len(offsets), dim), dtype=np.int64)
    out[np.arange(dim) < offsets[:, None]] = flat
    return out


def _packed(rows: DataFrame, dim: int, per_block: int, name: str) -> DataFrame:
    """Rows -> blocks (part, longest, ids, data) in order of falling length, written."""
    total = rows.count()
    parts = max(1, -(-total // per_block))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def emit(ids: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
            longest = float(np.sqrt((data.astype(float) ** 2).sum(axis=1).max()))
            order = np.argsort(ids, kind="stable")
            return pa.RecordBatch.from_arrays(
                [pa.array([longest]), pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                 pa.array([_raw(data[order])], pa.binary())], names=["longest", "ids", "data"])

        count = 0
        for b in batches:
            held.append((b.column(0).to_numpy(), _matrix(b.column(1), dim)))
            count += b.num_rows
            while count >= 2 * per_block:
                ids, data = (np.concatenate(x) for x in zip(*held))
                yield emit(ids[:per_block], data[:per_block])
                held, count = [(ids[per_block:], data[per_block:])], count - per_block
        if count:
            yield emit(*(np.concatenate(x) for x in zip(*held)))

    dealt = (rows.repartitionByRange(parts, F.col("norm2").desc(), F.xxhash64("vec_id"))
             .sortWithinPartitions(F.col("norm2").desc(), F.xxhash64("vec_id")).select("vec_id", "v"))
    blocks = dealt.mapInArrow(pack, "longest double, ids binary, data binary")
    return materialize(blocks.withColumn("part", F.spark_partition_id().cast("long")), name)


def _rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all rows (from summed Gram matrices), strongest axis first."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column(0), dim).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["i", "g"])

    parts = rows.select("v").mapInArrow(gram, "i long, g double").groupBy("i").agg(F.sum("g").alias("g"))
    g = np.zeros(dim * dim)
    for r in parts.collect():  # dim * dim numbers
        g[r["i"]] = r["g"]
    return np.linalg.eigh(g.reshape(dim, dim))[1][:, ::-1]


#: A block of queries: its first id (a name), its part, the last part it meets, its rows and their bounds.
QUERY_BLOCK = "block long, q_part long, last long, q_ids binary, q_data binary, least binary"


def _query_block(part: int, last: int, ids_raw: bytes, data_raw: bytes, least: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([int(np.frombuffer(ids_raw, "<i8", 1)[0])]), pa.array([part], pa.int64()), pa.array([last], pa.int64()),
         pa.array([ids_raw], pa.binary()), pa.array([data_raw], pa.binary()),
         pa.array([least.astype("<f8").tobytes()], pa.binary())],
        names=["block", "q_part", "last", "q_ids", "q_data", "least"])


def _raw(data: np.ndarray) -> bytes:
    """A whole-number matrix in the least of 16, 32 and 64 bits that holds it."""
    most = int(np.abs(data).max(initial=0))
    return data.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _read(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    width = len(data) // max(1, len(names) * dim)
    return names, np.frombuffer(data, f"<i{width or 8}").reshape(-1, dim).astype(np.int64)


def _dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact whole-number inner products; scores beyond 64 bits stop at the ends of their range."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    most = int(np.abs(q).max()) * int(np.abs(x).max()) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    big = q.astype(object) @ x.astype(object).T
    return np.clip(big, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of_block(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, x: np.ndarray,
                  axes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vec_id, score): the k best of the block for each query that reach its bound ``least``.

    ``ids`` ascend, so that of equal scores the smaller id comes first.
    """
    rq, rx = q @ axes, x @ axes
    full_q, full_x = np.linalg.norm(rq, axis=1), np.linalg.norm(rx, axis=1)
    slack = 1e-9 * (full_q.max(initial=0) * full_x.max(initial=0) + 1)
    keep_q = np.flatnonzero(full_q * full_x.max(initial=0) + slack >= least)
    keep_x = np.arange(len(x))
    dim, done = axes.shape[1], 0
    part = np.zeros((len(keep_q), len(x)))
    for share in AXIS_PARTS:
        upto = int(dim * share)
        if upto <= done or not len(keep_q) or not len(keep_x):
            continue
        part = part + rq[keep_q, done:upto] @ rx[keep_x, done:upto].T
        bound = part + np.outer(np.linalg.norm(rq[keep_q, upto:], axis=1),
                                np.linalg.norm(rx[keep_x, upto:], axis=1)) + slack
        alive = bound >= least[keep_q, None]
        use_q, use_x = alive.any(axis=1), alive.any(axis=0)
        keep_q, keep_x, part = keep_q[use_q], keep_x[use_x], part[use_q][:, use_x]
        done = upto
    rows, found, scores = [], [], []
    s = _dots(q[keep_q], x[keep_x])
    names = ids[keep_x]
    for i, row in enumerate(keep_q):
        line, allowed = s[i], names != q_ids[row]
        if len(line) > k + 1:
            # at most one candidate is the query itself per row of its id; the k + own-th value bounds the rest
            m = min(len(line) - 1, k + int((~allowed).sum()) - 1)
            kth = np.partition(line, len(line) - 1 - m)[len(line) - 1 - m]
            allowed &= line >= kth
        allowed &= line >= least[row]
        idx = np.flatnonzero(allowed)
        idx = idx[np.argsort(-line[idx], kind="stable")][:k]
        rows.append(np.full(len(idx), row))
        found.append(names[idx])
        scores.append(line[idx])
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([*z, empty]) for z in (rows, found, scores))


def top_inner_products(vectors: DataFrame, queries, k: int = 5, id_col: str = "vec_id",
                       vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products, ties to the smaller id.

    ``queries``: a condition on ``vec_id`` that marks the query rows.  A row is
    no candidate for queries of its own id.  Vectors that are null, hold null
    or non-finite components or have no id take no part.  Vectors shorter than
    the longest count as filled with zeros (an empty one is the zero vector).
    Repeated candidate rows are results of their own; a repeated query id is
    asked once, with its smallest vector.  Fewer than k candidates: all.  An
    empty table gives an empty result; extra columns are ignored.
    """
    rows = materialize(quantised(vectors, id_col, vector_col, scale), "mips-rows")
    dim = max(1, int(rows.agg(F.max(F.size("v"))).first()[0] or 1))
    axes = _rotation(rows, dim)
    asked = rows.where(queries).groupBy("vec_id").agg(F.min_by("v", F.to_json("v")).alias("v"),
                                                       F.min_by("norm2", F.to_json("v")).alias("norm2"))
    blocks = _packed(rows, dim, BLOCK_ROWS, "mips-blocks")
    chunks = _packed(asked, dim, QUERY_ROWS, "mips-queries")

    heads = blocks.where("part = 0").orderBy(F.desc("longest")).limit(1).collect()  # one block
    head = _read(heads[0]["ids"], heads[0]["data"], dim) if heads else (np.zeros(0, np.int64), np.zeros((0, dim), np.int64))
    n_parts = int(blocks.agg(F.max("part")).first()[0] or 0) + 1
    step = -(-n_parts // STEPS)
    known = sorted((r["part"], r["longest"]) for r in blocks.where(F.col("part") % step == 0)
                   .groupBy("part").agg(F.max("longest").alias("longest")).collect())  # at most STEPS rows
    known_part = np.array([p for p, _ in known], dtype=np.int64)
    known_longest = np.array([n for _, n in known], dtype=float)

    def last_met(q: np.ndarray, least: np.ndarray) -> int:
        """The last part in which some of the queries could reach its bound."""
        norms = np.sqrt((q.astype(float) ** 2).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(least > 0, least / norms, 0.0).min() * (1 - 1e-9)
        far = np.flatnonzero(known_longest >= reach)
        return min(int(known_part[far[-1]] + step - 1), n_parts - 1) if len(far) else 0

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, ids_raw, data_raw in zip(*(b.column(n).to_pylist() for n in ("part", "ids", "data"))):
                q_ids, q = _read(ids_raw, data_raw, dim)
                least = np.full(len(q), -np.inf)
                row, _, score = best_of_block(q_ids, q, least, *head, axes, k)
                counts = np.bincount(row, minlength=len(q))
                low = np.full(len(q), np.inf)
                np.minimum.at(low, row, score)
                least[counts >= k] = low[counts >= k]
                yield _query_block(part, last_met(q, least), ids_raw, data_raw, least)

    def raise_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.to_pylist():
                q_ids, q = _read(c["q_ids"], c["q_data"], dim)
                least = np.frombuffer(c["least"], "<f8").copy()
                # the ids of a query block ascend and are each there once
                at = np.searchsorted(q_ids, [f["query_id"] for f in c["kth"] or []])
                least[at] = np.maximum(least[at], [float(f["score"]) for f in c["kth"] or []])
                yield _query_block(c["q_part"], last_met(q, least), c["q_ids"], c["q_data"], least)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = {n: b.column(n)[i].as_py() for n in ("block", "ids", "data", "q_ids", "q_data", "least")}
                q_ids, q = _read(c["q_ids"], c["q_data"], dim)
                row, found, score = best_of_block(q_ids, q, np.frombuffer(c["least"], "<f8"),
                                                  *_read(c["ids"], c["data"], dim), axes, k)
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), c["block"])), pa.array(q_ids[row]), pa.array(found), pa.array(score)],
                        names=["block", "query_id", "vec_id", "score"])

    in_tile = lambda n: min(MOST_IN_TILE, -(-n // LEAST_TILES))
    side, q_parts = in_tile(n_parts), int(chunks.agg(F.max("part")).first()[0] or 0) + 1
    q_side = in_tile(q_parts)
    tiles, q_tiles = -(-n_parts // side), -(-q_parts // q_side)
    placed = blocks.withColumn("tile", F.floor(F.col("part") / side))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounded = materialize(chunks.select("part", "ids", "data").mapInArrow(bound, QUERY_BLOCK), "mips-bounds")
    best, start, length = None, 0, FIRST_TILES
    while True:
        stop = min(tiles, start + length)
        # never more tiles than the prefix of the query block; the last one is cut by ``part``
        met = bounded.where(F.col("last") >= start * side).withColumn("tile", F.explode(F.sequence(
            F.lit(start).cast("long"), F.least(F.floor(F.col("last") / side), F.lit(stop - 1).cast("long")))))
        there = placed.where((F.col("tile") >= start) & (F.col("tile") < stop)).select(
            "tile", "part", "ids", "data", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_tiles - 1).cast("long")))
            .alias("q_tile"))
        pairs = met.withColumn("q_tile", F.floor(F.col("q_part") / q_side)).join(there, ["tile", "q_tile"]).where(
            F.col("part") <= F.col("last")).select("block", "ids", "data", "q_ids", "q_data", "least")
        hits = pairs.mapInArrow(search, "block long, query_id long, vec_id long, score long")
        hits = hits if best is None else best.drop("rank").unionByName(hits)
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if stop >= tiles:
            break
        best = materialize(best, "mips-best")
        kth = best.where(F.col("rank") == k).groupBy("block").agg(
            F.collect_list(F.struct("query_id", "score")).alias("kth"))  # a number per query of the block
        rest = bounded.where(F.col("last") >= stop * side).join(kth, "block", "left")
        bounded = materialize(rest.mapInArrow(raise_bounds, QUERY_BLOCK), "mips-bounds")
        start, length = stop, length * GROWTH
    return best.select("query_id", "rank", "vec_id", "score")
