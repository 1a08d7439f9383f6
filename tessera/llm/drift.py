"""Centroid clustering with geometric drift tightening.

Every vector keeps its cluster, an upper bound of the distance to its own
centroid and a lower bound of the distance to any other.  When centroids move,
an upper bound grows by the drift of its centroid.  The lower bounds of a
cluster's vectors are not loosened by the full drift of the others: all its
vectors lie in a sphere round its centroid, and the most by which a moved
centroid can come nearer to a point of that sphere is bounded in the plane of
the sphere's centre and the centroid's two places.  Only vectors whose bounds
meet are measured again, first against their own centroid, then against all.

Vectors stay in blocks inside the tasks that read them; a pass writes the blocks
with their bounds and returns sums per cluster, so nothing is shuffled but those
sums (clusters x components per task).  Distances are exact whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import vectors
from tessera.llm.common import delete_scratch, write_scratch

#: Vectors of a block, at most.
BLOCK_ROWS = 4_096
#: Relative rounding error allowed to bounds, and to the planar bound as a share of the drift.
SLACK, PLANE_SLACK = 1e-9, 1e-7
_LOW = 31
_MOST = (1 << 63) - 1
_COUNT, _INERTIA, _RADIUS = -1, -2, -3

_STATE = "ids array<bigint>, data binary, own binary, upper binary, lower binary, distance binary, stats binary"
_OUT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two whole-number matrices (objects where 64 bits don't hold them)."""
    most = vectors.largest(x) + vectors.largest(c)
    room = x.shape[1] * most * most
    if room < 1 << 51:
        xf, cf = x.astype(float), c.astype(float)
        d = (xf ** 2).sum(axis=1)[:, None] + (cf ** 2).sum(axis=1)[None, :] - 2 * (xf @ cf.T)
        return d.astype(np.int64)
    kind = np.int64 if room < 1 << 62 else object
    return np.stack([((x.astype(kind) - row) ** 2).sum(axis=1) for row in c.astype(kind)], axis=1)


def squared_own(x: np.ndarray, c: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of ``x`` to the row ``own`` of ``c``."""
    most = vectors.largest(x) + vectors.largest(c)
    kind = np.int64 if x.shape[1] * most * most < 1 << 62 else object
    return ((x.astype(kind) - c.astype(kind)[own]) ** 2).sum(axis=1)


def planar_drift(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The most by which each centroid, moved from ``old`` to ``new`` (rows), can come nearer to a point of a sphere.

    In the plane of the sphere's centre and a centroid's two places, put the
    origin half-way between these and let them lie at (0, -1) and (0, 1).  The
    points that come nearer by more than 2a lie above a branch of a hyperbola,
    hence above its asymptote; the sphere (X, Y, r) stays below the asymptote
    of ``a = sin(atan2(Y, X) + asin(r / R))``.  A sphere round the axis, or one
    that reaches beyond, is bounded by its highest point or the full drift.  For
    negative ``a`` the asymptote is moved down by one, and the centroid leaves
    every point of the sphere by that much at least.
    """
    move = (new - old).astype(float)
    drift = np.sqrt((move ** 2).sum(axis=1))
    out = np.zeros(len(drift))
    moved = np.flatnonzero(drift > 0)
    if not len(moved):
        return out
    d, axis = drift[moved], move[moved] / drift[moved, None]
    away = centre.astype(float) - (old[moved].astype(float) + new[moved].astype(float)) / 2
    along = (away * axis).sum(axis=1)
    side = np.sqrt(np.maximum(((away - along[:, None] * axis) ** 2).sum(axis=1), 0.0))
    x, y, r = side * 2 / d, along * 2 / d, radius * 2 / d

    def asymptote(up: np.ndarray) -> np.ndarray:
        reach = np.sqrt(x ** 2 + up ** 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            a = (up * np.sqrt(np.maximum(reach ** 2 - r ** 2, 0.0)) + x * r) / reach ** 2
            crossing = (r >= reach) | ((up > 0) & (r > x))
        return np.where(crossing, 1.0, a)

    a = np.minimum(asymptote(y), 1.0)
    a = np.where(a >= 0, np.minimum(a, np.clip(y + r, 0.0, 1.0)), np.minimum(asymptote(y + 1), 0.0))
    out[moved] = d * np.minimum(1.0, np.maximum(a, -1.0) + PLANE_SLACK)
    return out


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per cluster: the drift of its own centroid, and by how much the lower bounds of its vectors are loosened."""
    own = np.sqrt(((new - old).astype(float) ** 2).sum(axis=1))
    less = np.zeros(len(old))
    for i in range(len(old)):
        others = np.arange(len(old)) != i
        if others.any() and radius[i] >= 0:
            less[i] = planar_drift(old[i], radius[i] * (1 + SLACK), old[others], new[others]).max()
    return own, less


def assign(x: np.ndarray, centroids: np.ndarray, state: tuple | None, moved: tuple | None) -> tuple:
    """(own, upper, lower, scanned): nearest centroids, ties to the smaller number, with their bounds.

    ``state``: (own, upper, lower) for the centroids before they moved;
    ``moved``: what ``loosening`` gives.  Without them every vector is scanned.
    """
    if state is None:
        own = np.zeros(len(x), dtype=np.int32)
        upper, lower = np.zeros(len(x)), np.zeros(len(x))
        scan = np.arange(len(x))
    else:
        own, upper, lower = (a.copy() for a in state)
        upper += moved[0][own]
        lower -= moved[1][own]
        meet = np.flatnonzero(upper * (1 + SLACK) >= lower * (1 - SLACK))
        upper[meet] = np.sqrt(squared_own(x[meet], centroids, own[meet]).astype(float))
        scan = meet[upper[meet] * (1 + SLACK) >= lower[meet] * (1 - SLACK)]
    if len(scan):
        d = squared(x[scan], centroids)
        own[scan] = d.argmin(axis=1)
        two = np.sort(d, axis=1)[:, :2].astype(float)
        upper[scan] = np.sqrt(two[:, 0])
        lower[scan] = np.sqrt(two[:, 1]) if d.shape[1] > 1 else np.inf
    return own, upper, lower, len(scan)


def _stats(x: np.ndarray, own: np.ndarray, upper: np.ndarray, k: int) -> bytes:
    """Counts, radii and component sums (high and low bits apart, so that none overflows) per cluster."""
    count = np.bincount(own, minlength=k).astype("<i8")
    radius = np.full(k, -1.0, dtype="<f8")
    np.maximum.at(radius, own, upper)
    high, low = np.zeros((k, x.shape[1]), dtype="<i8"), np.zeros((k, x.shape[1]), dtype="<i8")
    np.add.at(high, own, x >> _LOW)
    np.add.at(low, own, x & ((1 << _LOW) - 1))
    return b"".join(a.tobytes() for a in (count, radius, high, low))


def _summed(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, list[list[int]], list[int]]:
    """(counts, radii, component sums, inertia) of all blocks; one row per cluster and component reaches the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, radius = np.zeros(k, dtype=object), np.full(k, -1.0)
        sums, inertia = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=object)
        for b in batches:
            for raw, own, distance in zip(*(b.column(n).to_pylist() for n in ("stats", "own", "distance"))):
                one = np.frombuffer(raw, "<i8")
                count = count + one[:k]
                radius = np.maximum(radius, one[k:2 * k].view("<f8"))
                high, low = one[2 * k:].astype(object).reshape(2, k, dim)
                sums = sums + high * (1 << _LOW) + low
                if distance:
                    np.add.at(inertia, np.frombuffer(own, "<i4"), np.frombuffer(distance, "<i8").astype(object))
        cells = [(c, _COUNT, count[c], 0.0) for c in range(k)] + [(c, _RADIUS, 0, radius[c]) for c in range(k)]
        cells += [(c, _INERTIA, inertia[c], 0.0) for c in range(k)]
        cells += [(c, a, sums[c, a], 0.0) for c in range(k) for a in range(dim)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in cells], pa.int32()), pa.array([r[1] for r in cells], pa.int32()),
             pa.array([int(r[2]) for r in cells], pa.decimal128(38, 0)), pa.array([float(r[3]) for r in cells])],
            names=["cluster", "axis", "total", "most"])

    rows = (state.select("stats", "own", "distance")
            .mapInArrow(add, "cluster int, axis int, total decimal(38,0), most double")
            .groupBy("cluster", "axis").agg(F.sum("total").alias("total"), F.max("most").alias("most")).collect())
    count, radius = np.zeros(k, dtype=object), np.full(k, -1.0)
    sums, inertia = [[0] * dim for _ in range(k)], [0] * k
    for r in rows:
        c, axis, total = r["cluster"], r["axis"], int(r["total"])
        if axis == _COUNT:
            count[c] = total
        elif axis == _RADIUS:
            radius[c] = r["most"]
        elif axis == _INERTIA:
            inertia[c] = total
        else:
            sums[c][axis] = total
    return count, radius, sums, inertia


def cluster(table: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Usable: ``dim`` components, none null or non-finite; the others are left
    out.  Components become floor(scale * x).  Centroids start as the ``k``
    vectors (all, if fewer) with the smallest sha256 of ``<seed>:<id>``, a null
    id as the empty text, ties by vector.  Each round assigns every vector to
    the nearest centroid (squared distance, ties to the smaller number) and
    moves each centroid that has vectors to the floor of their mean; the last
    assignment follows.  Repeated rows and rows without an id are vectors of
    their own; an empty table gives an empty result; other columns are not
    read.  Distances and sums beyond 64 bits are given as the largest long.
    """
    spark = table.sparkSession
    x = F.col(f"`{vector_col}`")
    kept = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).where(
        (F.size("x") == dim) & vectors.usable(F.col("x"))).select("vec_id", vectors.quantised(F.col("x"), scale).alias("v"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.orderBy(F.sha2(name, 256), "v").limit(k).collect()  # k rows
    if not first:
        return spark.createDataFrame([], _OUT)
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    k = len(centroids)

    def to_state(ids: pa.Array, data: bytes, x: np.ndarray, centroids: np.ndarray, state: tuple | None,
                 moved: tuple | None, last: bool) -> pa.RecordBatch:
        own, upper, lower, _ = assign(x, centroids, state, moved)
        distance = b""
        if last:
            distance = np.minimum(squared_own(x, centroids, own), _MOST).astype("<i8").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([data], pa.binary())]
            + [pa.array([a], pa.binary()) for a in (own.astype("<i4").tobytes(), upper.astype("<f8").tobytes(),
                                                    lower.astype("<f8").tobytes(), distance, _stats(x, own, upper, k))],
            names=["ids", "data", "own", "upper", "lower", "distance", "stats"])

    def begin(centroids: np.ndarray, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, BLOCK_ROWS):
                    part = b.slice(at, BLOCK_ROWS)
                    x = vectors.matrix(part.column(1), dim)
                    yield to_state(pa.concat_arrays([part.column(0)]), vectors.to_bytes(x), x, centroids, None, None, last)
        return run

    def again(centroids: np.ndarray, moved: tuple, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    ids, data = b.column("ids")[i].values, b.column("data")[i].as_py()
                    state = (np.frombuffer(b.column("own")[i].as_py(), "<i4"),
                             np.frombuffer(b.column("upper")[i].as_py(), "<f8"),
                             np.frombuffer(b.column("lower")[i].as_py(), "<f8"))
                    yield to_state(ids, data, vectors.from_bytes(data, len(ids), dim), centroids, state, moved, last)
        return run

    state, path = write_scratch(kept.mapInArrow(begin(centroids, rounds == 0), _STATE), "drift")
    for step in range(rounds):
        count, radius, sums, _ = _summed(state, k, dim)
        new = np.array([[t // int(count[c]) for t in sums[c]] if count[c] else centroids[c].tolist()
                        for c in range(k)], dtype=np.int64)
        moved = loosening(centroids, new, radius)
        centroids, before = new, path
        state, path = write_scratch(state.drop("stats", "distance").mapInArrow(
            again(centroids, moved, step + 1 == rounds), _STATE), "drift")
        delete_scratch(spark, before)

    inertia = _summed(state, k, dim)[3]
    whole = min(sum(inertia), _MOST)
    inertia = np.array([min(i, _MOST) for i in inertia], dtype=np.int64)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                own = np.frombuffer(b.column("own")[i].as_py(), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[i].values, pa.array(own), pa.array(np.frombuffer(b.column("distance")[i].as_py(), "<i8")),
                     pa.array(inertia[own]), pa.array(np.full(len(own), whole)), pa.array([digest[c] for c in own])],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return state.select("ids", "own", "distance").mapInArrow(result, _OUT)
