"""Hard-negative mining by inner products in a residue number system.

Scores are whole numbers.  Component matrices are reduced modulo a few small
primes and multiplied in float32, where every partial sum stays below 2^24 and
is exact; Chinese remaindering gives the exact signed scores.  How many primes a
pair of tiles needs follows from its longest vectors (Cauchy-Schwarz).

Rows are cut into tiles by the tasks that read them; anchors, in tiles of their
own, meet every tile of rows.  A first pass keeps each anchor's best rows of its
own label, tile by tile; a second selects, for each anchor and positive, the
first rows of other labels inside the positive's score window.  A tile hands on
at most as many rows as are asked for, whatever it holds, so hot labels and
repeated vectors cost nothing more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import vectors
from tessera.llm.common import materialize

#: Rows of a tile of candidates and of anchors, at most, and candidate tiles that share a join key, about.
TILE_ROWS, ANCHOR_ROWS, TILES_PER_CELL = 2_048, 1_024, 2
#: Components multiplied before residues are reduced again.
AXES = 64
#: Scores of a product that are held at once.
CELLS = 1 << 21
#: Whole numbers below this are exact in float32.
EXACT = 1 << 24


def primes_below(limit: int) -> Iterator[int]:
    """Primes below ``limit``, largest first."""
    for n in range(limit - 1, 1, -1):
        if all(n % d for d in range(2, int(n ** 0.5) + 1)):
            yield n


@dataclass
class Residues:
    """A residue number system for inner products of ``dim`` components of size up to ``most``."""

    primes: list[int]
    product: int

    @classmethod
    def for_scores(cls, dim: int, most: int) -> Residues:
        """The fewest primes, largest first, whose product exceeds twice ``most``.

        Residues lie within half a prime of zero: so many products of two of
        them, as ``AXES`` components give, stay below ``EXACT``.
        """
        half = int(((EXACT - 1) / max(1, min(dim, AXES))) ** 0.5)
        chosen, product = [], 1
        for p in primes_below(min(2 * half + 1, 4_096)):
            chosen.append(p)
            product *= p
            if product > 2 * most + 1:
                return cls(chosen, product)
        raise ValueError("scores are too large for a residue number system of small primes")

    def residue(self, data: np.ndarray, p: int) -> np.ndarray:
        """Residues nearest to zero as float32."""
        r = np.mod(data, p)
        return np.where(r > p // 2, r - p, r).astype(np.float32)

    def multiply(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact ``a @ b.T`` (64-bit numbers; Python's where a score needs more, cut to the ends of the long range)."""
        parts = []
        for p in self.primes:
            ra, rb = self.residue(a, p), self.residue(b, p)
            total = np.zeros((len(a), len(b)), dtype=np.float32)
            for at in range(0, a.shape[1], AXES):
                total += ra[:, at:at + AXES] @ rb[:, at:at + AXES].T
                total -= p * np.rint(total * np.float32(1 / p))
            parts.append(np.mod(total.astype(np.int32), p))
        return self.reconstruct(parts)

    def reconstruct(self, parts: list[np.ndarray]) -> np.ndarray:
        """Signed whole numbers from their residues (mixed-radix Chinese remaindering)."""
        kind = np.int64 if self.product < 1 << 62 else object
        value, radix = parts[0].astype(kind), self.primes[0]
        for p, r in zip(self.primes[1:], parts[1:]):
            digit = np.mod((r - np.mod(value, p).astype(np.int64)) * pow(radix, -1, p), p)
            value = value + digit.astype(kind) * radix
            radix *= p
        value = value - (value > self.product // 2).astype(kind) * self.product
        if kind is object:
            value = np.clip(value, -(1 << 63), (1 << 63) - 1).astype(np.int64)
        return value


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two whole-number matrices."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    longest = [int(np.ceil(np.sqrt((m.astype(float) ** 2).sum(axis=1).max()) * (1 + 1e-9))) for m in (a, b)]
    return Residues.for_scores(a.shape[1], longest[0] * longest[1] + 1).multiply(a, b)


def _first(row: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the first ``k`` entries of every row: higher scores first, ties by place."""
    order = np.lexsort((place, -score, row))
    ranked = row[order]
    start = np.searchsorted(ranked, ranked, side="left")
    return order[np.arange(len(order)) - start < k]


def positives_of_tile(anchor: tuple, tile: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor row, vec_id, score): the first ``k`` rows of the tile with the anchor's label and another id.

    Both sides are (ids, labels, matrix); a tile's ids ascend, so places order ties.
    """
    ids, labels, x = anchor
    t_ids, t_labels, t = tile
    rows, found, best = [], [], []
    for label in np.intersect1d(labels, t_labels):
        a, b = np.flatnonzero(labels == label), np.flatnonzero(t_labels == label)
        step = max(1, CELLS // len(b))
        for at in range(0, len(a), step):
            part = a[at:at + step]
            s = scores(x[part], t[b])
            other = t_ids[b][None, :] != ids[part][:, None]
            if len(b) > 4 * k:  # a row's k-th best score among others bounds what can be chosen
                low = np.partition(np.where(other, s, np.iinfo(np.int64).min), len(b) - k, axis=1)[:, len(b) - k]
                other &= s >= low[:, None]
            r, c = np.nonzero(other)
            pick = _first(r, s[r, c], c, k)
            rows.append(part[r[pick]])
            found.append(t_ids[b][c[pick]])
            best.append(s[r[pick], c[pick]])
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *z]) for z in (rows, found, best))


def negatives_of_tile(anchor: tuple, low: np.ndarray, high: np.ndarray, tile: tuple, k: int) -> tuple:
    """(anchor row, window, vec_id, score): the first ``k`` rows of other labels in each score window.

    ``low`` and ``high`` are (anchor, window) bounds; a window whose low end lies above its high end holds nothing.
    """
    ids, labels, x = anchor
    t_ids, t_labels, t = tile
    out = [[], [], [], []]
    step = max(1, CELLS // max(1, len(t)))
    nothing = np.iinfo(np.int64).max
    for at in range(0, len(ids), step):
        part = slice(at, at + step)
        lo, hi = low[part], high[part]
        open_ = lo <= hi
        least = np.where(open_, lo, nothing).min(axis=1, initial=nothing)
        most = np.where(open_, hi, -nothing).max(axis=1, initial=-nothing)
        s = scores(x[part], t)
        fits = ((s >= least[:, None]) & (s <= most[:, None]) & (t_labels[None, :] != labels[part][:, None])
                & (t_ids[None, :] != ids[part][:, None]))
        r, c = np.nonzero(fits)
        v = s[r, c]
        for w in range(low.shape[1]):
            inside = np.flatnonzero((v >= lo[r, w]) & (v <= hi[r, w]))
            pick = inside[_first(r[inside], v[inside], c[inside], k)]
            for box, value in zip(out, (at + r[pick], np.full(len(pick), w), t_ids[c[pick]], v[pick])):
                box.append(value)
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *z]) for z in out)


def _tiles(rows: DataFrame, dim: int, per_tile: int, lists: tuple[str, ...] = ()) -> DataFrame:
    """Rows (vec_id, label, v and list columns) -> tiles (ids, labels, data, the lists), ids ascending, no shuffle."""
    schema = "ids binary, labels binary, data binary" + "".join(f", {c} array<array<array<bigint>>>" for c in lists)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, per_tile):
                part = b.slice(at, per_tile)
                part = part.take(pa.array(np.argsort(part.column(0).to_numpy(), kind="stable")))
                data = vectors.matrix(part.column(2), dim)
                cells = [pa.array([part.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([part.column(1).to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([vectors.to_bytes(data)], pa.binary())]
                cells += [pa.array([part.column(c).to_pylist()], pa.list_(pa.list_(pa.list_(pa.int64())))) for c in lists]
                yield pa.RecordBatch.from_arrays(cells, names=["ids", "labels", "data", *lists])

    return rows.select("vec_id", "label", "v", *lists).mapInArrow(pack, schema)


def _tile(ids: bytes, labels: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    return names, np.frombuffer(labels, "<i8"), vectors.from_bytes(data, len(names), dim)


def _met(anchors: DataFrame, tiles: DataFrame, cells: int) -> DataFrame:
    """Each tile of anchors beside each tile of rows."""
    copies = anchors.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).repartition(cells, "cell")
    return tiles.repartition(cells, "cell").join(copies, "cell").drop("cell")


def mine(table: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    ``anchors``: a condition on ``vec_id`` that marks anchor rows.  A score is
    the inner product of vectors whose components became floor(scale * x); of
    equal scores the smaller id comes first.  An anchor's positives are its
    first ``positives`` other rows of its label; a positive's negatives the
    first ``negatives`` rows of another label whose score is from ``low`` to
    ``high`` percent of the positive's (so none where that is below zero).

    Rows without id, label or vector, or with null or non-finite components,
    take no part.  Shorter vectors count as filled with zeros.  Rows of the
    anchor's own id are no candidates for it; an id that is repeated among
    anchors is asked once, with its smallest label and vector; repeated rows
    among candidates count one by one.  Scores beyond 64 bits are cut to the
    ends of their range.  An empty table gives an empty result; other columns
    are not read.
    """
    col = lambda name: F.col(f"`{name}`")
    rows = table.select(col(id_col).cast("long").alias("vec_id"), col(label_col).cast("long").alias("label"),
                        col(vector_col).alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.usable(F.col("x")))
    dim = max(1, int(rows.agg(F.max(F.size("x"))).first()[0] or 1))
    rows = rows.select("vec_id", "label", vectors.quantised(F.col("x"), scale).alias("v"))
    tiles = materialize(_tiles(rows, dim, TILE_ROWS).withColumn("tile", F.monotonically_increasing_id()), "negative-tiles")
    cells = max(1, -(-tiles.count() // TILES_PER_CELL))
    tiles = tiles.select(F.pmod(F.xxhash64("tile"), F.lit(cells)).cast("int").alias("cell"),
                         *[F.col(c).alias(f"t_{c}") for c in ("ids", "labels", "data")])
    asked = materialize(rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
                        .select("vec_id", "r.label", "r.v"), "negative-anchors")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = [b.column(n)[i].as_py() for n in ("ids", "labels", "data", "t_ids", "t_labels", "t_data")]
                anchor = _tile(*c[:3], dim)
                row, found, score = positives_of_tile(anchor, _tile(*c[3:], dim), positives)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[0][row]), pa.array(found), pa.array(score)],
                                                 names=["vec_id", "positive_id", "positive_score"])

    hits = _met(_tiles(asked, dim, ANCHOR_ROWS), tiles, cells).mapInArrow(
        best, "vec_id long, positive_id long, positive_score long")
    order = Window.partitionBy("vec_id").orderBy(F.desc("positive_score"), "positive_id")
    hits = hits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    chosen = hits.groupBy("vec_id").agg(F.transform(  # at most ``positives`` of each anchor
        F.sort_array(F.collect_list(F.struct("n", "positive_id", "positive_score"))),
        lambda p: F.array(p["positive_id"], p["positive_score"])).alias("windows"))
    windows = materialize(_tiles(asked.join(chosen, "vec_id"), dim, ANCHOR_ROWS, ("windows",)), "negative-windows")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = [b.column(n)[i].as_py() for n in ("ids", "labels", "data", "t_ids", "t_labels", "t_data")]
                anchor, wanted = _tile(*c[:3], dim), b.column("windows")[i].as_py()
                positive = np.zeros((len(wanted), positives, 2), dtype=np.int64)
                lo, hi = np.ones(positive.shape[:2], dtype=np.int64), np.zeros(positive.shape[:2], dtype=np.int64)
                for r, line in enumerate(wanted):
                    for w, (name, score) in enumerate(line):
                        positive[r, w] = name, score
                        lo[r, w], hi[r, w] = -(-low * score // 100), high * score // 100
                row, window, found, score = negatives_of_tile(anchor, lo, hi, _tile(*c[3:], dim), negatives)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[0][row]), pa.array(window), pa.array(positive[row, window, 0]), pa.array(found),
                     pa.array(positive[row, window, 1]), pa.array(score)],
                    names=["anchor_id", "n", "positive_id", "negative_id", "positive_score", "negative_score"])

    found = _met(windows, tiles, cells).mapInArrow(
        select, "anchor_id long, n long, positive_id long, negative_id long, positive_score long, negative_score long")
    order = Window.partitionBy("anchor_id", "n").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
