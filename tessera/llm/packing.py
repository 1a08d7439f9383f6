"""Best-fit packing by a linear grouping scheme.

Token lengths are whole numbers up to the sequence length, so the histogram of
lengths (at most ``capacity`` numbers) says all that a packing plan needs,
however many documents there are:

1. Large lengths are sorted and cut into groups of equal cardinality; each is
   rounded up to the largest of its group.
2. The few-size problem is solved by column generation (a simplex basis over
   configurations, priced by a knapsack), rounded down.
3. Actual lengths take the places of the rounded ones, longest first; runs of
   sequences with equal actual contents stay one row of the plan.
4. What is left over and the small lengths go, longest first, each into the
   fullest sequence that still holds it (best fit), run by run.

The plan maps (length, rank among the pieces of that length) to a place.  Its
size depends on the capacity, not on the data.  Pieces find their rank by a
distributed prefix count and their place by binary search.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, raw_texts, slices

CAPACITY = 4096
END_ID = 1
#: Lengths over capacity / LARGE_PARTS are large; they are cut into GROUPS groups.
LARGE_PARTS, GROUPS = 6, 40
#: Chunks kept in a worker's cache, in each of two generations, and words of plain chunks.
CACHE_CHUNKS, CACHE_WORDS = 300_000, 500_000
#: Pieces that share one rank window, about.
RANK_ROWS = 100_000
SPECIAL_BRACKET = b"<|"
#: Plain chunks that are split in one go; the number after each one's ids, which no vocabulary reaches.
PLAIN_CHUNKS, NO_ID = 16_384, 0xFFFFFFFF
CHUNK_END = np.array([NO_ID], dtype="<u4").tobytes()

#: The vocabulary file's own splitting pattern (for plain chunks, which hold no white space;
#: the line feed between two of them is a piece of its own).
PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")
#: Chunks of printable ASCII and Latin-1 letters: stable under NFC, with one-to-one lower case (sharp s as it is).
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class ChunkTokenizer:
    """Ids of whole texts through a cache of white-space chunks.

    The vocabulary's pre-tokenizer never joins characters across white space,
    so a text's ids are its chunks' ids in a row.  Unknown plain chunks are
    split by the vocabulary's pattern and their words given to its model; all
    other chunks go through the whole tokenizer, many in one call, apart by
    the end marker (a special token).  A chunk that might hold a special token
    itself is encoded alone.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.marker = "<|endoftext|>"
        self.marker_id = self.tokenizer.token_to_id(self.marker)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {"\n": CHUNK_END}
        self.model = self.tokenizer.model

    def _learn(self, words: set[str]) -> None:
        """Take the ids of pieces of plain chunks, already in lower case, into the cache."""
        tokenize = self.model.tokenize
        for word in words:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
            self.words[word] = array("I", [t.id for t in tokenize(spelled)]).tobytes()

    def _encode_plain(self, chunks: list[bytes], texts: list[str]) -> None:
        """Ids of plain chunks: all are split in one go, apart by line feeds, which no chunk holds."""
        words = PLAIN_PIECES.findall("\n".join(texts).lower() + "\n")
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words = {"\n": CHUNK_END}
            new = set(words).difference(self.words)
        self._learn(new)
        raw = b"".join(map(self.words.__getitem__, words))
        start = 0
        for c, end in zip(chunks, np.flatnonzero(np.frombuffer(raw, dtype="<u4") == NO_ID).tolist()):
            self.young[c] = raw[4 * start:4 * end]
            start = end + 1

    def _encode(self, chunks: list[bytes]) -> None:
        plain, texts, other = [], [], []
        for c, text in zip(chunks, b"\n".join(chunks).decode("utf-8", "replace").split("\n")):
            if SPECIAL_BRACKET in c:
                self.young[c] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                                         dtype="<u4").tobytes()
            elif PLAIN.fullmatch(text):
                plain.append(c)
                texts.append(text)
            else:
                other.append(c)
        for at in range(0, len(plain), PLAIN_CHUNKS):
            self._encode_plain(plain[at:at + PLAIN_CHUNKS], texts[at:at + PLAIN_CHUNKS])
        for at in range(0, len(other), 1024):
            part = other[at:at + 1024]
            ids = np.array(self.tokenizer.encode(
                self.marker.join(c.decode("utf-8", "replace") for c in part) + self.marker,
                add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(ids == self.marker_id)
            raw = ids.tobytes()
            start = 0
            for c, end in zip(part, ends.tolist()):
                self.young[c] = raw[4 * start:4 * end]
                start = end + 1

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with the end id."""
        end = np.array([END_ID], dtype="<u4").tobytes()
        lists = [t.split() for t in texts]
        need = set().union(*lists)
        if len(self.young) > CACHE_CHUNKS:
            self.old, self.young = self.young, {}
        missing = need.difference(self.young)
        known = self.old.keys() & missing  # looks up the few missing ones, not the whole cache
        self.young.update((c, self.old[c]) for c in known)
        self._encode(list(missing - known))
        get = self.young.__getitem__
        return [b"".join(map(get, words)) + end for words in lists]


_tokenizers: dict[str, ChunkTokenizer] = {}


def _tokenizer(vocabulary: str) -> ChunkTokenizer:
    """One tokenizer (with its cache) per worker process and vocabulary."""
    if vocabulary not in _tokenizers:
        _tokenizers[vocabulary] = ChunkTokenizer(vocabulary)
    return _tokenizers[vocabulary]


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): only documents over ``capacity`` tokens are cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        for b in slices(batches, "text", rows=256, max_bytes=4 << 20):
            ids = b.column(0).to_pylist()
            out: list[tuple] = []
            for doc, raw in zip(ids, tokenizer.ids(raw_texts(b, "text"))):
                for i, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    out.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), _PIECE_TYPES)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


_PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per size with the most worth that fit (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c], took[c] = best[c - 1], -1
        fits = np.flatnonzero(sizes <= c)
        if len(fits):
            value = best[c - sizes[fits]] + worth[fits]
            k = int(value.argmax())
            if value[k] > best[c] + 1e-12:
                best[c], took[c] = value[k], fits[k]
    counts = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[took[c]] += 1
            c -= sizes[took[c]]
    return counts


def few_sizes(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """(configuration, times) that together hold no more than ``demand`` of each size.

    Column generation for the linear programme min sum x, sum x_c c >= demand,
    from a basis of one-size configurations; the times are rounded down.
    """
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amount = demand / np.diag(basis)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(n))
        column = best_configuration(sizes, worth, capacity).astype(float)
        if column @ worth <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, column)
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * direction
        amount[out] = ratio[out]
        basis[:, out] = column
    found = []
    left = demand.astype(np.int64).copy()
    for k in np.argsort(-amount, kind="stable"):
        c = basis[:, k].astype(np.int64)
        used = c > 0
        times = min(int(np.floor(amount[k] + 1e-7)), int((left[used] // c[used]).min())) if used.any() else 0
        if times > 0:
            found.append((c, times))
            left -= times * c
    return found


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, count, first sequence, per sequence, offset).

    The piece of this length with rank ``first rank + i`` lies in sequence
    ``first sequence + i // per sequence`` at ``offset + (i % per sequence) * length``.
    """
    rows: list[tuple[int, int, int, int, int, int]] = []
    taken = dict.fromkeys(histogram, 0)  # ranks given out, by length
    next_sequence = 0
    free: dict[int, list[list[int]]] = {}  # free space -> runs [first sequence, count]
    spaces: list[int] = []

    def add_run(space: int, first: int, count: int) -> None:
        if count and space > 0:
            if space not in free:
                free[space] = []
                insort(spaces, space)
            free[space].append([first, count])

    def take(length: int, count: int, first: int, per: int, offset: int) -> None:
        rows.append((length, taken[length], count, first, per, offset))
        taken[length] += count

    if histogram.get(capacity):
        take(capacity, histogram[capacity], 0, 1, 0)
        next_sequence = histogram[capacity]
    large = [k for k in sorted(histogram, reverse=True) if capacity // LARGE_PARTS < k < capacity]
    total = sum(histogram[k] for k in large)
    if total:
        # groups of equal cardinality, longest first: queues of [length, count]
        per_group = -(-total // GROUPS)
        queues: list[list[list[int]]] = [[]]
        room = per_group
        for k in large:
            count = histogram[k]
            while count:
                part = min(count, room)
                queues[-1].append([k, part])
                count, room = count - part, room - part
                if not room:
                    queues.append([])
                    room = per_group
        queues = [q for q in queues if q]
        rounded: dict[int, list[list[int]]] = {}
        for q in queues:  # groups with the same largest length are one size
            rounded.setdefault(q[0][0], []).extend(q)
        sizes = np.array(sorted(rounded, reverse=True))
        demand = np.array([sum(c for _, c in rounded[int(s)]) for s in sizes])
        for configuration, times in few_sizes(sizes, demand, capacity):
            slots = [int(sizes[i]) for i in range(len(sizes)) for _ in range(configuration[i])]
            while times:
                # the longest run in which every slot meets one actual length
                chosen = []
                planned: dict[int, int] = {}
                for s in slots:
                    planned[s] = planned.get(s, 0) + 1
                run = times
                for s, k in planned.items():
                    head = rounded[s][0]
                    run = min(run, head[1] // k if head[1] >= k else 1)
                offset = 0
                for s, k in planned.items():
                    for _ in range(k):
                        queue = rounded[s]
                        head = queue[0]
                        take(head[0], run, next_sequence, 1, offset)
                        offset += head[0]
                        head[1] -= run
                        chosen.append(head[0])
                        if not head[1]:
                            queue.pop(0)
                add_run(capacity - offset, next_sequence, run)
                next_sequence += run
                times -= run

    for k in sorted((k for k in histogram if k < capacity), reverse=True):
        left = histogram[k] - taken[k]
        while left:
            at = bisect_left(spaces, k)
            if at == len(spaces):
                per = capacity // k
                full, rest = divmod(left, per)
                if full:
                    take(k, full * per, next_sequence, per, 0)
                    add_run(capacity - per * k, next_sequence, full)
                if rest:
                    take(k, rest, next_sequence + full, rest, 0)
                    add_run(capacity - rest * k, next_sequence + full, 1)
                next_sequence += full + (1 if rest else 0)
                break
            space = spaces[at]
            first, count = free[space][-1]
            per = space // k
            full = min(count, left // per)
            offset = capacity - space
            if full:
                take(k, full * per, first, per, offset)
                left -= full * per
                used = full
                free[space][-1] = [first + full, count - full]
                new = [(space - per * k, first, full)]
            else:
                take(k, left, first, left, offset)
                used = 1
                new = [(space - left * k, first, 1)]
                free[space][-1] = [first + 1, count - 1]
                left = 0
            if count == used:
                free[space].pop()
                if not free[space]:
                    del free[space]
                    spaces.pop(at)
            for row in new:
                add_run(*row)
    return rows


def with_ranks(cut: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0, unique) among the pieces of each length, without a large window.

    Pieces are dealt to hash buckets of about ``RANK_ROWS`` rows; the rank is
    the place in the bucket plus the counts of the length's earlier buckets.
    """
    buckets = max(1, -(-cut.count() // RANK_ROWS))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before")
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    return dealt.withColumn("own", F.row_number().over(own) - 1).join(
        counts.select("length", "bucket", before), ["length", "bucket"]).withColumn(
        "rank", F.col("own") + F.col("before")).drop("own", "before", "bucket")


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece.

    A null or empty text is the end id alone.  Repeated rows are pieces of
    their own; a null id is kept; an empty table gives an empty result; extra
    columns are ignored.
    """
    cut = materialize(pieces(docs, vocabulary, id_col, text_col, capacity), "pack-pieces")
    # at most ``capacity`` rows: one per length
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = np.array(sorted(plan(histogram, capacity)), dtype=np.int64).reshape(-1, 6)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table[:, 0] << 44 | table[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = (b.column(names.index(c)).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            i = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(row[:, 3] + i // row[:, 4]),
                 pa.array(row[:, 5] + i % row[:, 4] * length)], names=[*names[:5], "sequence_id", "offset"])
    return with_ranks(cut).select(*names).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
