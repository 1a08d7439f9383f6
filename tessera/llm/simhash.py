"""SimHash near-duplicates: vantage-point trees over fingerprints.

1. One pass over the whole texts gives a 64-bit fingerprint per document.
2. Equal fingerprints are merged first (partial aggregation), so thousands of
   copies are one point.
3. A vantage-point tree built from a bounded sample of fingerprints cuts the
   Hamming space into shards.  At a node with vantage point p and radius r a
   fingerprint x goes left if d(x, p) <= r, else right; by the triangle bound a
   partner of x within ``max_bits`` on the other side needs
   d(x, p) > r - max_bits, so exactly those boundary points are also sent
   right.  Every pair within ``max_bits`` therefore meets in some shard.
4. Each shard is searched exactly by a tree of its own (numpy) and returns a
   spanning forest of its links, never the pairs of a group.
5. Star contraction joins the forests to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, raw_texts, slices
from tessera.llm.components import connected_components

#: Fingerprints in the sample that the routing tree is built from, at most.
TREE_SAMPLE = 65_536
#: Fingerprints that a shard should hold, and a leaf of a shard's own tree.
SHARD_ROWS = 8_192
LEAF_ROWS = 768
SEED = 42


def shingles(raw: bytes, k: int = 3) -> list[bytes]:
    """Word k-grams of the ASCII-lower-cased text, repeats included (fewer words: the whole sequence)."""
    words = raw.lower().split()
    if len(words) < k:
        return [b" ".join(words)] if words else []
    return [b" ".join(t) for t in zip(*(words[i:] for i in range(k)))]


def fingerprint(raw: bytes, k: int = 3) -> int:
    """Signed 64-bit SimHash of a text; zero if it has no words."""
    grams = shingles(raw, k)
    if not grams:
        return 0
    intdigest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(grams), 1 << 16):
        part = grams[at:at + (1 << 16)]
        h = np.fromiter((intdigest(g, SEED) for g in part), dtype="<u8", count=len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = (ones * 2 > len(grams)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int = 3, mark: bool = False) -> DataFrame:
    """(id, fp) for every row of ``docs``, with ``mark`` also a hash of the text; null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fps = pa.array([fingerprint(x, k) for x in raw_texts(b, "text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps, *b.columns[2:]],
                                             names=["id", "fp", *b.schema.names[2:]])
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                         *[F.xxhash64(text_col).alias("mark")] * mark)
    return source.mapInArrow(run, "id long, fp long" + ", mark long" * mark)


def distances(points: np.ndarray, pivot: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ pivot).astype(np.int16)


def choose_split(points: np.ndarray, max_bits: int, tries: int = 6) -> tuple | None:
    """(vantage point, radius) with the least sum of squared child sizes, or None if no split helps."""
    n, best = len(points), None
    for pivot in points[:: max(1, n // tries)][:tries]:
        c = np.cumsum(np.bincount(distances(points, pivot), minlength=65)).astype(float)
        left = c[:64]
        inner = np.concatenate([np.zeros(max_bits), c])[:64]  # those with d <= r - max_bits
        right = n - inner
        cost = left ** 2 + right ** 2
        cost[(left == 0) | (left == n)] = np.inf
        r = int(cost.argmin())
        if cost[r] < 0.95 * n * n and (best is None or cost[r] < best[0]):
            best = (cost[r], pivot, r)
    return best and best[1:]


def build_tree(sample: np.ndarray, total: int, max_bits: int, shard_rows: int = SHARD_ROWS) -> list:
    """Routing tree as rows [pivot, radius, left, right]; a leaf has left = -1 and its shard in right."""
    nodes: list = []
    leaves = 0
    scale = total / max(1, len(sample))
    work = [(sample, None, 0)]
    while work:
        points, parent, side = work.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][2 + side] = me
        split = choose_split(points, max_bits) if len(points) * scale > shard_rows and len(points) >= 32 else None
        if split is None:
            nodes.append([0, 0, -1, leaves])
            leaves += 1
            continue
        pivot, r = split
        d = distances(points, pivot)
        nodes.append([int(pivot), r, 0, 0])
        work.append((points[d <= r], me, 0))
        work.append((points[d > r - max_bits], me, 1))
    return nodes


def route(nodes: list, points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) for every shard that each point belongs to or overlaps."""
    rows, shards = [], []
    work = [(0, np.arange(len(points)))]
    while work:
        node, idx = work.pop()
        if not len(idx):
            continue
        pivot, r, left, right = nodes[node]
        if left < 0:
            rows.append(idx)
            shards.append(np.full(len(idx), right, dtype=np.int64))
            continue
        d = distances(points[idx], np.uint64(pivot))
        work.append((left, idx[d <= r]))
        work.append((right, idx[d > r - max_bits]))
    return np.concatenate(rows), np.concatenate(shards)


def close_pairs(points: np.ndarray, max_bits: int, leaf: int = LEAF_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of distinct points within ``max_bits``, found by a vantage-point tree."""
    work = [np.arange(len(points))]
    while work:
        idx = work.pop()
        own = points[idx]
        split = choose_split(own, max_bits) if len(idx) > leaf else None
        if split is None:
            step = max(1, (1 << 21) // max(1, len(idx)))
            for at in range(0, len(idx), step):
                d = np.bitwise_count(own[at:at + step, None] ^ own[None, :])
                i, j = np.nonzero(d <= max_bits)
                keep = i + at < j
                yield idx[i[keep] + at], idx[j[keep]]
            continue
        d = distances(own, split[0])
        work.append(idx[d <= split[1]])
        work.append(idx[d > split[1] - max_bits])


def spanning_labels(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each point's component, the pairs taken block by block."""
    label = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:  # pointer jumping
                nxt = label[label]
                if np.array_equal(nxt, label):
                    break
                label = nxt
    return label


def links(reps: DataFrame, max_bits: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (u, v) of a spanning forest of the graph of fingerprints within ``max_bits``.

    ``reps`` holds each fingerprint once, in column ``fp``.
    """
    total = reps.count()
    rows = reps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).collect()
    sample = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    nodes = build_tree(sample, total, max_bits, shard_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(fp):
                row, shard = route(nodes, fp.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fp[row])], names=["shard", "fp"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.sort(pdf["fp"].to_numpy(np.int64))
        label = spanning_labels(len(fp), close_pairs(fp.view(np.uint64), max_bits))
        own = label != np.arange(len(fp))
        return pd.DataFrame({"u": fp[own], "v": fp[label[own]]})

    dealt = reps.select("fp").mapInArrow(deal, "shard long, fp long")
    return dealt.groupBy("shard").applyInPandas(search, "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                   max_bits: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per row of ``docs``: (id, fp, component).

    ``component`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  Null and empty texts have fingerprint zero
    and link like any other.  A null id takes part and gets its component's
    smallest non-null id (null if there is none).  Repeated rows stay
    repeated; an empty table gives an empty result; extra columns are ignored.
    """
    marks = materialize(fingerprints(docs, id_col, text_col, k), "simhash-fp")
    reps = materialize(marks.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-reps")
    roots = connected_components(links(reps, max_bits, shard_rows))
    named = roots.join(reps, roots["node"] == reps["fp"]).select("fp", "root", "rep")
    named = materialize(named, "simhash-linked")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    linked = named.join(least, "root").select("fp", "least")
    component = reps.join(linked, "fp", "left").select(
        "fp", F.coalesce("least", "rep").alias("component"))
    return marks.join(component, "fp").select("id", "fp", "component")


def keep_representatives(docs: DataFrame, k: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each group stays: the one with the smallest ``doc_id``, once if its row repeats.

    Of rows that share this id the smallest fingerprint, then the smallest
    hash of the text is taken; a row without an id comes after all others of
    its group.  All columns stay as they are.
    """
    marks = materialize(fingerprints(docs, "doc_id", "text", k, mark=True), "simhash-marks")
    reps = materialize(marks.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "mark")).alias("rep")), "simhash-reps")
    roots = connected_components(links(reps, max_bits))
    first = reps.join(roots, reps["fp"] == roots["node"], "left").groupBy(F.coalesce("root", "fp").alias("group")).agg(
        F.min(F.struct("rep.no_id", "rep.id", "fp", "rep.mark")).alias("first"))
    wanted = materialize(first.select("first.no_id", F.coalesce("first.id", F.lit(0)).alias("known"), "first.mark"),
                         "simhash-first")
    # own names for all columns: those of ``docs`` may be anything
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows, keys = docs.toDF(*at.values()), ["no_id", "known", "mark"]
    rows = rows.select("*", F.col(at["doc_id"]).isNull().alias("no_id"),
                       F.coalesce(at["doc_id"], F.lit(0)).alias("known"), F.xxhash64(at["text"]).alias("mark"))
    # one shuffle of the documents: repeated rows are dropped on the keys they were joined by
    return rows.join(wanted, keys, "left_semi").dropDuplicates(keys).select(*at.values()).toDF(*docs.columns)


def fingerprint_hex(fp: str = "fp"):
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
