"""Toxicity: a subsequence string-kernel SVM on sentences with Nyström landmarks.

Kernel between tokens: gap-weighted common subsequences of three characters
(with word-end marks), each occurrence weighted ``DECAY ** span`` for spans up
to ``SPAN``, normalised, floored and cubed, which finds changed letters.  Gapped
and inserted-character spellings are found by the same kernel of the landmark's
own order: a window of whole tokens of a sentence that holds all letters of the
landmark in order counts ``DECAY ** gaps``, where every further letter and every
break between tokens (white space and marks) is one gap; at most one gap for each
step between letters.  A sentence's kernel is the sum over its tokens and windows;
with landmarks M its Nyström features are ``K_MM^(-1/2) * sum k(window, M)``.

Labels are per document, and a document is as toxic as its worst passage: runs of
whole sentences of up to ``PASSAGE`` words.  A passage's features are its evidence
against each landmark (up to ``MOST``) and its rate per word, so that the length
of a document, or clean text joined to it, adds nothing.  The linear SVM is fitted
on each document's worst passage, which is chosen anew by the model of the round
before; a logistic curve of the worst passage's decision is the score.  Landmarks
are tokens that occur significantly more often in toxic documents of the sample,
for as many tokens as are tried, copies of one document counting once; they are
spread out by the kernel itself.  Each distinct token is evaluated once per
worker and cached; of the whole text only sums over passages are kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, hash_sample, keep_rows, raw_texts, slices

#: Labelled documents used for the fit, at most, of either label, and the longest of them in characters.
FIT_DOCS = 2_500
FIT_CHARS = 20_000
HELD_MODULUS, HELD_REMAINDER = 5, 0
LANDMARKS = 64
DECAY, SPAN, POWER = 0.7, 6, 3
#: Cosines of three-character subsequences below this count as zero; gapped windows have no floor.
FLOOR = 0.5
#: Kernel value over which two landmark candidates count as one.
ALIKE = 0.5
TOKEN_CHARS = 48
#: Evidence against one landmark that counts, and the factor that brings rates per word to its scale.
MOST, RATE = 2.0, 80.0
#: Words of a passage, at most (a longer sentence is cut), and the fewest that a rate is taken over.
PASSAGE, LEAST_WORDS = 100, 50
#: Chance that any of the tokens tried becomes a landmark though it is as common in clean documents.
CHANCE = 0.01
#: Rounds in which the worst passages are chosen and the SVM fitted.
CHOICES = 4
#: Tokens kept in a worker's cache.
CACHE_TOKENS = 400_000
ALPHABET = 42

#: Digits and signs written in place of letters.
LOOKS_LIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"})

_DROP = re.compile(r"[\W_]+")
_SPACED = re.compile(r"(?:(?<=\s)|^)\w[^\w\s]*(?:\s\w[^\w\s]*){2,}(?=\s|$)")
_STOP = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")


def normalise(chunk: str) -> str:
    """Token of a white-space chunk: lower case, look-alikes as letters, other marks removed."""
    word = unicodedata.normalize("NFC", chunk.lower())
    if not word.isalpha():
        core = word.strip("!?.,;:*%&#|$<>()\"'")
        if any(c.isalpha() for c in core) and not core.isalpha():
            word = core.translate(LOOKS_LIKE)
        word = _DROP.sub("", word)
    return word


def spaced_words(text: str, chunks: list[str]) -> list[str]:
    """Joined words of the runs of three or more single characters, with or without marks after them."""
    if sum(len(c) <= 2 for c in chunks) < 3:
        return []
    return ["".join(m.group().split()) for m in _SPACED.finditer(text)]


def chunks_of(text: str) -> list[str]:
    """White-space chunks of a text; runs of three or more single characters also give their joined word."""
    chunks = text.split()
    return chunks + spaced_words(text, chunks)


def letter_bits(words: list[str]) -> np.ndarray:
    """Sets of the letters of words in 64 bits: one for each of a to z, 38 classes of other signs."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    points = np.frombuffer(" ".join(["", *words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inner = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 38).astype(np.uint64)
    one = np.where(points == 32, np.uint64(0), np.uint64(1) << inner)  # a space before each word; tokens hold none
    return np.bitwise_or.reduceat(one, np.flatnonzero(points == 32))


def in_order(letters: str, text: str) -> bool:
    """Whether ``text`` holds the letters in this order."""
    at = -1
    for c in letters:
        at = text.find(c, at + 1)
        if at < 0:
            return False
    return True


def _symbols(words: list[str], length: int) -> np.ndarray:
    """(word, position) symbols of words of one length: letters, 14 classes of other signs, two end marks."""
    points = np.array(words, dtype=f"<U{max(1, length)}").view(np.uint32).reshape(len(words), -1)[:, :length]
    inner = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 14)
    out = np.empty((len(words), length + 2), dtype=np.int32)
    out[:, 0], out[:, 1:-1], out[:, -1] = 40, inner, 41
    return out


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per word length: (word numbers, codes of every three-character subsequence within ``SPAN``, their weights).

    The weights depend on the places alone and are scaled to norm 1, which normalises the kernel.
    """
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, rows in by_length.items():
        n = length + 2
        gaps = [(j, k) for j in range(1, SPAN - 1) for k in range(j + 1, SPAN) if k < n]
        if not gaps:
            continue
        t = _symbols([words[i] for i in rows], length)
        codes = np.concatenate([(t[:, : n - k] * ALPHABET + t[:, j: n - k + j]) * ALPHABET + t[:, k:]
                                for j, k in gaps], axis=1)
        weight = np.concatenate([np.full(n - k, DECAY ** (k + 1)) for _, k in gaps]).astype(np.float32)
        yield np.array(rows), codes, weight / np.sqrt((weight ** 2).sum())


class Landmarks:
    """Kernel values between tokens and a fixed list of landmark words.

    Cosines under ``FLOOR`` count as zero.  The sum of each subsequence's
    largest landmark weight bounds every cosine of a token from above, so most
    tokens are known to be zero without a look at the single landmarks.  Windows
    are known to lack a landmark by their length and set of letters.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.bits = letter_bits(words)
        self.ends = list(zip(letter_bits([w[0] for w in words]), letter_bits([w[-1] for w in words])))
        self.by_length: dict[int, list[int]] = {}
        for j, w in enumerate(words):
            self.by_length.setdefault(len(w), []).append(j)
        entries: dict[int, dict[int, float]] = {}
        for rows, codes, weight in subsequences(words):
            for r, line in zip(rows, codes):
                for c, w in zip(line.tolist(), weight.tolist()):
                    cell = entries.setdefault(c, {})
                    cell[int(r)] = cell.get(int(r), 0.0) + w
        self.place = np.zeros(ALPHABET ** 3, dtype=np.int32)
        self.table = np.zeros((len(entries) + 1, max(1, len(words))), dtype=np.float32)
        for i, (c, cell) in enumerate(sorted(entries.items()), start=1):
            self.place[c] = i
            for r, w in cell.items():
                self.table[i, r] = w
        self.most = self.table.max(axis=1)

    def kernel(self, tokens: list[str]) -> np.ndarray:
        """(token, landmark) kernel; a token longer than ``TOKEN_CHARS`` takes the best of its overlapping windows."""
        pieces, owner = [], []
        for i, t in enumerate(tokens):
            if len(t) <= TOKEN_CHARS:
                pieces.append(t)
                owner.append(i)
                continue
            for at in range(0, len(t) - TOKEN_CHARS // 2, TOKEN_CHARS // 2):
                pieces.append(t[at:at + TOKEN_CHARS])
                owner.append(i)
        out = np.zeros((len(tokens), self.table.shape[1]), dtype=np.float32)
        owner_a = np.array(owner, dtype=np.int64)
        for rows, codes, weight in subsequences(pieces):
            at = self.place[codes]
            near = np.flatnonzero(self.most[at] @ weight >= FLOOR)
            for lo in range(0, len(near), 512):
                part = near[lo:lo + 512]
                cosine = np.einsum("nom,o->nm", self.table[at[part]], weight)
                cosine[cosine < FLOOR] = 0
                np.maximum.at(out, owner_a[rows[part]], cosine ** POWER)
        sizes = np.array([len(t) for t in tokens])
        bits = letter_bits(tokens)
        for length, marks in self.by_length.items():
            rows = np.flatnonzero((sizes > length) & (sizes < 2 * length))
            for j in marks:
                for i in rows[(bits[rows] & self.bits[j]) == self.bits[j]]:
                    if in_order(self.words[j], tokens[i]):
                        out[i, j] = max(out[i, j], DECAY ** (len(tokens[i]) - length))
        return out

    def across(self, tokens: list[str], number: np.ndarray, sentence: np.ndarray, sizes: np.ndarray,
               bits: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(first place, tokens, landmark, kernel) of windows of two and more tokens of one sentence.

        The places hold ``tokens[number]``, none empty, with their sizes and
        letter sets; only the smallest windows of an occurrence count.
        """
        if not self.words:
            return
        longest = max(self.by_length)
        total = np.cumsum(sizes)
        start = np.arange(len(sizes))
        held = bits
        for n in range(2, longest + 1):  # a window of n tokens has n letters or more
            fits = start + n - 1 < len(sizes)
            start, held = start[fits], held[fits]
            last = start + n - 1
            span = total[last] - total[start] + sizes[start] + n - 1
            fits = (span < 2 * longest) & (sentence[last] == sentence[start])
            start, last, span = start[fits], last[fits], span[fits]
            held = held[fits] | bits[last]
            if not len(start):
                return
            for length, marks in self.by_length.items():
                of = np.flatnonzero((span < 2 * length) & (span - n + 1 >= length))
                letters = held[of]
                for j in marks:
                    near = of[(letters & self.bits[j]) == self.bits[j]]
                    first, end = self.ends[j]
                    near = near[((bits[start[near]] & first) != 0) & ((bits[last[near]] & end) != 0)]
                    for i in near:
                        at = int(start[i])
                        parts = [tokens[k] for k in number[at:at + n]]
                        word = self.words[j]
                        if (in_order(word, "".join(parts)) and not in_order(word, "".join(parts[1:]))
                                and not in_order(word, "".join(parts[:-1]))):
                            yield at, n, j, DECAY ** float(span[i] - length)


@dataclass
class Scorer:
    """Fitted model: ``features`` of a text, a linear decision on them, a logistic curve of that."""

    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def __post_init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.cache: dict[str, int] = {}  # chunk -> its place in the following ones
        self.tokens: list[str] = []
        self.row = np.zeros(0, dtype=np.int64)  # of ``values``; row 0: no evidence
        self.sizes = np.zeros(0, dtype=np.int64)
        self.bits = np.zeros(0, dtype=np.uint64)
        self.stops = np.zeros(0, dtype=bool)
        self.values = np.zeros((1, self.landmarks.table.shape[1] + 1), dtype=np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items()
                if k not in ("cache", "tokens", "row", "sizes", "bits", "stops", "values")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._clear()

    def _learn(self, chunks: list[str]) -> None:
        tokens = [normalise(c) for c in chunks]
        distinct = sorted(set(tokens))
        found = []
        number = {}
        for at in range(0, len(distinct), 8192):
            part = distinct[at:at + 8192]
            k = self.landmarks.kernel(part)
            rows = np.flatnonzero(k.any(axis=1))
            number.update((part[r], len(self.values) + sum(map(len, found)) + i) for i, r in enumerate(rows))
            found.append(np.column_stack([k[rows], k[rows].max(axis=1)]))
        self.values = np.concatenate([self.values, *found])
        self.cache.update((c, len(self.tokens) + i) for i, c in enumerate(chunks))
        self.tokens += tokens
        self.row = np.append(self.row, np.array([number.get(t, 0) for t in tokens], dtype=np.int64))
        self.sizes = np.append(self.sizes, np.array([len(t) for t in tokens], dtype=np.int64))
        self.bits = np.append(self.bits, letter_bits(tokens))
        # a single letter with a point is a spelling or an initial, no end of a sentence
        self.stops = np.append(self.stops, np.array([len(t) > 1 and _STOP.search(c) is not None
                                                     for c, t in zip(chunks, tokens)], dtype=bool))

    def _gapped(self, places: list[np.ndarray], total: np.ndarray, strongest: np.ndarray) -> None:
        """Add the evidence of the windows across tokens, passage by passage, to ``total`` and ``strongest``."""
        at = np.concatenate([np.zeros(0, np.int64), *places])
        owner = np.repeat(np.arange(len(places)), [len(p) for p in places])
        new = np.zeros(len(at), dtype=bool)
        new[1:] = self.stops[at[:-1]] | (owner[1:] != owner[:-1])
        sentence = np.cumsum(new)
        full = self.sizes[at] > 0
        at, owner, sentence = at[full], owner[full], sentence[full]
        best: dict[tuple[int, int], float] = {}
        for first, n, j, value in self.landmarks.across(self.tokens, at, sentence, self.sizes[at], self.bits[at]):
            total[owner[first], j] += value
            best[first, n] = max(value, best.get((first, n), 0.0))
        for (first, _), value in best.items():
            total[owner[first], -1] += value
            strongest[owner[first]] = max(value, strongest[owner[first]])

    def passages(self, places: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of the passages of a text given by its chunks' places: whole sentences as long as they fit."""
        out, start, last = [], 0, 0
        for end in [*(np.flatnonzero(self.stops[places[:-1]]) + 1).tolist(), len(places)]:
            while end - start > PASSAGE:
                cut = last if last > start else start + PASSAGE
                out.append((start, cut))
                start = cut
            last = end
        return [*out, (start, len(places))]

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(features of the passages, first passage of each text).

        A passage's features are the evidence against each landmark and against
        the nearest one of all, capped, then the rates per word, and last the
        square of its strongest single piece of evidence: one plain insult is
        another thing than chance likenesses that add up to as much.
        """
        lists = [t.split() for t in texts]
        joined = [spaced_words(t, chunks) for t, chunks in zip(texts, lists)]
        need = set().union(*lists, *joined)
        missing = need.difference(self.cache)
        if missing and len(self.cache) + len(missing) > CACHE_TOKENS:
            self._clear()
            missing = need
        self._learn(sorted(missing))
        first, rows, more = [], [], []  # more: (passage, row of evidence) of joined words
        for chunks, runs in zip(lists, joined):
            places = np.fromiter(map(self.cache.__getitem__, chunks), np.int64, len(chunks))
            first.append(len(rows))
            for start, end in self.passages(places):
                if runs:
                    part = chunks[start:end]
                    more += [(len(rows), self.row[self.cache[w]]) for w in spaced_words(" ".join(part), part)
                             if w in self.cache]
                rows.append(places[start:end])
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        evidence = self.row[np.concatenate([np.zeros(0, np.int64), *rows])]
        hit = np.flatnonzero(evidence)
        owner = np.append(np.repeat(np.arange(len(rows)), sizes)[hit], np.array([m[0] for m in more], dtype=np.int64))
        near = self.values[np.append(evidence[hit], np.array([m[1] for m in more], dtype=np.int64))]
        total = np.zeros((len(rows), self.values.shape[1]))
        strongest = np.zeros(len(rows))
        np.add.at(total, owner, near)
        np.maximum.at(strongest, owner, near[:, -1])
        words = np.maximum(sizes, LEAST_WORDS)[:, None]
        self._gapped(rows, total, strongest)
        return (np.concatenate([np.minimum(total, MOST), np.minimum(RATE * total / words, 2 * MOST),
                                MOST * strongest[:, None] ** 2], axis=1), np.array(first, dtype=np.int64))

    def decision(self, texts: list[str]) -> np.ndarray:
        """The linear decision on the worst passage of each text."""
        x, first = self.features(texts)
        return np.maximum.reduceat(x @ self.weights + self.bias, first) if len(texts) else np.zeros(0)

    def probability(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decision(texts) + self.offset, -30, 30)))


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM (hinge loss) by dual coordinate descent in a fixed shuffled order; y is -1 or 1."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    alpha = np.zeros(len(z))
    norm = (z ** 2).sum(axis=1)
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(z)):
            step = (1 - y[i] * (z[i] @ w)) / max(norm[i], 1e-9)
            new = min(max(alpha[i] + step, 0), c * weight[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * z[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def logistic(f: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the logistic curve of y on f (Newton's method); the slope is at least zero."""
    z, w = np.column_stack([f, np.ones(len(f))]), np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        w += np.clip(np.linalg.solve(h, z.T @ (weight * (y - p)) - ridge * w), -2, 2)
    return max(0.0, float(w[0])), float(w[1])


def spread_out(ranked: list[str], most: int) -> list[str]:
    """Up to ``most`` words in rank order, none too like an earlier one (kernel over ``ALIKE``)."""
    if not ranked:
        return []
    near = Landmarks(ranked).kernel(ranked) > ALIKE
    chosen: list[int] = []
    for i in range(len(ranked)):
        if len(chosen) < most and not near[i, chosen].any():
            chosen.append(i)
    return [ranked[i] for i in chosen]


def copy_groups(texts: list[str], words: int = 5, hashes: int = 4) -> list[int]:
    """For each text the first one that it is taken for a copy of: they share one of a few smallest shingle hashes."""
    root = list(range(len(texts)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[tuple[int, int], int] = {}
    for i, text in enumerate(texts):
        chunks = text.split()
        grams = {" ".join(chunks[j:j + words]) for j in range(max(1, len(chunks) - words + 1))}
        for seed in range(hashes):
            key = seed, min(xxhash.xxh64_intdigest(g, seed) for g in grams)
            a, b = find(i), find(first.setdefault(key, i))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def train(texts: list[str], toxic: list[int], labelled: tuple[int, int] | None = None) -> Scorer:
    """Fit on labelled texts; without both labels, or without a significant token, the score is a constant.

    ``labelled`` holds how many clean and toxic rows the texts stand for: each
    text weighs as many rows of its label (scaled to a mean of one), so that a
    score does not depend on the sample's own shares of the labels.
    """
    y = np.array(toxic, dtype=float)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    all0, all1 = labelled if labelled and n0 and n1 else (n0, n1)
    weight = np.where(y > 0, all1 / max(1, n1), all0 / max(1, n0)) * (len(y) / max(1, all0 + all1))
    share = (n1 + 0.5) / (len(y) + 1) if len(y) else 0.25
    in1, in0 = Counter(), Counter()
    groups: dict[int, list[int]] = {}
    for i, root in enumerate(copy_groups(texts)):
        groups.setdefault(root, []).append(i)
    for members in groups.values():
        tokens = {normalise(c) for i in members for c in chunks_of(texts[i])} - {""}
        (in1 if any(toxic[i] for i in members) else in0).update(tokens)
    gain = {}
    for w, a in in1.items():
        p = a / (a + in0[w])
        if n0 and p > share:
            gain[w] = a * np.log(p / share) + (in0[w] * np.log((1 - p) / (1 - share)) if in0[w] else 0.0)
    least = np.log(max(1, len(in1.keys() | in0.keys())) / CHANCE)
    ranked = sorted((w for w, g in gain.items() if g > least), key=lambda w: (-gain[w], w))
    marks = spread_out(ranked[:1000], LANDMARKS)
    land = Landmarks(marks)
    if not marks:
        prior = (all1 + 0.5) / (all0 + all1 + 1) if len(y) else share
        return Scorer(land, np.zeros(5), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    k_mm = land.kernel(marks).astype(float)
    values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
    root = vectors @ np.diag(np.clip(values, 0.05, None) ** -0.5) @ vectors.T
    block = np.eye(len(marks) + 1)
    block[:-1, :-1] = root
    both = np.eye(2 * len(block) + 1)
    both[:-1, :-1] = np.kron(np.eye(2), block)
    scorer = Scorer(land, np.zeros(len(both)), 0.0)
    found = [scorer.features(texts[a:a + 256]) for a in range(0, len(texts), 256)]
    x = np.concatenate([f[0] for f in found])
    starts = np.concatenate([f[1] + sum(len(g[0]) for g in found[:i]) for i, f in enumerate(found)])
    ends = np.append(starts[1:], len(x))
    sign = np.where(y > 0, 1.0, -1.0)
    decision = x[:, len(marks)]  # at first the passage with most evidence
    seen: dict[tuple[int, int], None] = {}
    for _ in range(CHOICES):
        worst = [int(a + decision[a:b].argmax()) for a, b in zip(starts, ends)]
        seen.update(((i, w), None) for i, w in enumerate(worst) if y[i] == 0)  # a clean text is clean in every passage
        used = sorted([*seen, *((i, w) for i, w in enumerate(worst) if y[i] > 0)])
        doc, at = np.array([u[0] for u in used]), np.array([u[1] for u in used])
        w, scorer.bias = svm(x[at] @ both, sign[doc], weight[doc] / np.bincount(doc, minlength=len(y))[doc])
        scorer.weights = both @ w
        decision = x @ scorer.weights + scorer.bias
    scorer.slope, scorer.offset = logistic(np.maximum.reduceat(decision, starts), y, weight)
    scorer._clear()
    return scorer


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 per_label: int = FIT_DOCS, longest: int = FIT_CHARS) -> Scorer:
    """Fit on labelled rows outside the held-out fifth: at most ``per_label`` of either label.

    Only texts of up to ``longest`` characters serve for the fit, which bounds
    what the driver holds; every text is scored whole.  The rows of either
    label are counted over all data and weigh as many.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                          & (crc_mod("doc_id", HELD_MODULUS) != HELD_REMAINDER))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    picked = hash_sample(marked.where("toxic = 1"), "doc_id", per_label).union(
        hash_sample(marked.where("toxic = 0"), "doc_id", per_label))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .where(F.col("text").isNotNull() & (F.length("text") <= longest))
            .join(F.broadcast(picked), "doc_id")  # at most 2 * per_label rows of two numbers
            .dropDuplicates(["doc_id"]).collect())
    rows = sorted((r["doc_id"], r["toxic"], r["text"]) for r in rows)
    return train([r[2] for r in rows], [r[1] for r in rows], (counts.get(0, 0), counts.get(1, 0)))


def score(docs: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for the whole text of every row; null and empty texts are scored as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", rows=256, max_bytes=4 << 20):
            texts = [x.decode("utf-8", "replace") for x in raw_texts(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.probability(texts))], names=["doc_id", "score"])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts get the score of a text without sentences.  Without
    labelled rows of both kinds the score is a constant.  Repeated rows get
    equal results; an empty table gives an empty result; other columns are
    never inputs.
    """
    out = score(docs, fit_toxicity(docs, labels, id_col, text_col), id_col, text_col)
    return out.select("doc_id", (crc_mod("doc_id", HELD_MODULUS) == HELD_REMAINDER).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` does not reject, with all their columns, in one pass."""
    model = fit_toxicity(docs, labels, id_col, text_col)
    return keep_rows(docs, text_col, lambda raw: model.probability(
        [x.decode("utf-8", "replace") for x in raw]) < 0.5)
