"""Quality rules: gradient-boosted trees over document statistics.

One pass computes statistics of the whole text; a boosted ensemble (logistic
loss, histogram splits, monotonic constraints) is fitted in numpy on a bounded
hash sample of labelled rows and flattened into node arrays, so that scoring a
batch is a handful of vectorised gathers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, keep_rows, raw_texts, slices

#: Labelled rows used for the fit, at most (those with the smallest hash of doc_id).
FIT_ROWS = 20_000
#: A text is kept if the probability of label 1 is at least this.
KEEP_AT = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_digits", "n_marks", "n_distinct", "n_adjacent")
#: Model inputs, and the direction in which each may move the score (0: free).
FEATURES = (("log_words", 0), ("mean_word", 0), ("symbol_share", -1), ("dup_line_share", -1),
            ("repeat_share", -1), ("words_per_line", 0), ("upper_share", -1), ("digit_share", 0),
            ("mark_share", -1), ("distinct_share", 0), ("adjacent_share", -1))

# byte classes: 0 other, 1 upper, 2 lower, 3 digit, 4 white space, 5 symbol, 6 other ASCII mark, 7 UTF-8 continuation
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = 6
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("a"):ord("z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[32, *range(9, 14)]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
_CLASS[128:192] = 7


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text."""
    n = len(ids)
    if n < width:
        return 0
    key = ids[: n - width + 1]
    for i in range(1, width):
        base = int(ids.max()) + 1
        if base and int(key.max()) > (2 ** 62) // base:
            key = np.unique(key, return_inverse=True)[1]
        key = key * base + ids[i: n - width + 1 + i]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[back] >= 2
    covered = np.zeros(n, dtype=bool)
    for i in range(width):
        covered[i: n - width + 1 + i] |= again
    return int(covered.sum())


def statistics(raw: bytes) -> list[int]:
    """The ``COUNTS`` of one whole text (UTF-8)."""
    kinds = np.zeros(8, dtype=np.int64)
    view = np.frombuffer(raw, dtype=np.uint8)
    for at in range(0, len(view), 1 << 22):
        kinds += np.bincount(_CLASS[view[at:at + (1 << 22)]], minlength=8)
    words = raw.split()
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [len(words), len(raw) - int(kinds[7]) - int(kinds[4]), int(kinds[5]),
            len(lines) - len(set(lines)), repeated_words(ids), len(lines), int(kinds[1]),
            int(kinds[3]), int(kinds[6]), len(number),
            int((ids[1:] == ids[:-1]).sum())]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the ``COUNTS``) for every row; null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            table = np.array([statistics(x) for x in raw_texts(b, "text")], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(table[:, i]) for i in range(len(COUNTS)))],
                names=["doc_id", *COUNTS])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def feature_matrix(counts: np.ndarray) -> np.ndarray:
    """Model inputs from a table of counts (columns as in ``COUNTS``)."""
    c = {name: counts[:, i].astype(float) for i, name in enumerate(COUNTS)}
    words = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars,
        c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_words"] / lines,
        c["n_upper"] / chars, c["n_digits"] / chars, c["n_marks"] / chars,
        c["n_distinct"] / words, c["n_adjacent"] / words])


@dataclass
class Ensemble:
    """Flattened trees: ``roots`` index into the node arrays; a leaf points to itself."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[row, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, directions: tuple[int, ...], trees: int = 80, depth: int = 3,
        rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Ensemble:
    """Boosted trees with logistic loss; ``directions`` -1/0/+1 constrain each feature.

    A split on a constrained feature is allowed only if the child values are in
    its order; the children then inherit the middle value as a bound, so the
    whole ensemble is monotonic.  Without both classes the model is a constant.
    """
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    nodes: list[list[float]] = []
    roots = []
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T] if len(x) else []
    binned = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)]) if len(x) else None
    f = np.full(len(y), base)
    for _ in range(trees if len(y) and 0 < share < 1 else 0):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        roots.append(len(nodes))
        work = [(np.arange(len(y)), -np.inf, np.inf, depth)]
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        place = [roots[-1]]
        while work:
            idx, low, high, left_depth = work.pop()
            me = place.pop()
            gs, hs = g[idx].sum(), h[idx].sum()
            nodes[me][4] = rate * float(np.clip(gs / (hs + ridge), low, high))
            best = (1e-6, None)
            for k, direction in enumerate(directions if left_depth else ()):
                if not len(edges[k]):
                    continue
                b = binned[idx, k]
                gl = np.cumsum(np.bincount(b, g[idx], len(edges[k]) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[idx], len(edges[k]) + 1))[:-1]
                gr, hr = gs - gl, hs - hl
                vl, vr = (np.clip(a / (c + ridge), low, high) for a, c in ((gl, hl), (gr, hr)))
                gain = (2 * gl * vl - (hl + ridge) * vl ** 2) + (2 * gr * vr - (hr + ridge) * vr ** 2)
                v0 = nodes[me][4] / rate
                gain -= 2 * gs * v0 - (hs + ridge) * v0 ** 2
                gain[(hl < least) | (hr < least) | (direction * (vr - vl) < 0)] = -np.inf
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], (k, at, float(vl[at]), float(vr[at]), direction))
            if best[1] is None:
                continue
            k, at, vl, vr, direction = best[1]
            go = binned[idx, k] <= at
            mid = (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)),
                      -1: ((mid, high), (low, mid))}[direction]
            nodes[me][:4] = [k, float(edges[k][at]), len(nodes), len(nodes) + 1]
            for part, (lo, hi) in zip((idx[go], idx[~go]), bounds):
                place.append(len(nodes))
                nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
                work.append((part, lo, hi, left_depth - 1))
        flat = _flatten(base, depth, [roots[-1]], nodes)
        f = f + flat.margin(x) - base
    return _flatten(base, depth, roots, nodes)


def _flatten(base: float, depth: int, roots: list[int], nodes: list) -> Ensemble:
    a = np.array(nodes, dtype=float).reshape(-1, 5)
    return Ensemble(base, depth, np.array(roots, dtype=np.int64), a[:, 0].astype(np.int64), a[:, 1],
                    a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bound: int = FIT_ROWS) -> Ensemble:
    """Fit on at most ``bound`` labelled rows (unlabelled rows and null labels take no part)."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.min("quality").cast("int").alias("quality"))
    picked = F.broadcast(hash_sample(marked, "label_id", bound))  # at most ``bound`` rows of two numbers
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(
        picked, F.col("doc_id") == F.col("label_id"), "left_semi")
    rows = document_statistics(chosen).join(picked, F.col("doc_id") == F.col("label_id")).dropDuplicates(
        ["doc_id"]).select("doc_id", "quality", *COUNTS).collect()
    table = np.array(sorted(tuple(r) for r in rows), dtype=np.int64).reshape(-1, 2 + len(COUNTS))
    return fit(feature_matrix(table[:, 2:]), table[:, 1].astype(float), tuple(d for _, d in FEATURES))


def verdicts(texts: list[bytes], model: Ensemble, min_words: int, max_repeat_percent: int,
             keep_at: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(counts, score, base_failed, kept) of a batch of whole texts."""
    counts = np.array([statistics(x) for x in texts], dtype=np.int64).reshape(-1, len(COUNTS))
    score = model.probability(feature_matrix(counts))
    words, repeats = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
    failed = (words < min_words) | (100 * repeats > max_repeat_percent * words)
    return counts, score, failed, ~failed & (score >= keep_at)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          keep_at: float = KEEP_AT) -> DataFrame:
    """(doc_id, the ``COUNTS``, score, base_failed, kept) for every row of ``docs``.

    Null and empty texts have no words and fail the base rules.  Repeated rows
    get equal results; without labelled rows the score is 0.5 and the base
    rules decide alone; an empty table gives an empty result.
    """
    model = fit_quality(docs, labels, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            counts, score, failed, kept = verdicts(raw_texts(b, "text"), model, min_words, max_repeat_percent, keep_at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[:, i]) for i in range(len(COUNTS))), pa.array(score),
                 pa.array(failed), pa.array(kept)],
                names=["doc_id", *COUNTS, "score", "base_failed", "kept"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
                             + ", score double, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
              keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, in one pass."""
    model = fit_quality(docs, labels, id_col, text_col)
    return keep_rows(docs, text_col, lambda texts: verdicts(
        texts, model, min_words, max_repeat_percent, keep_at)[3])
