"""HTML extraction with a recurrent block labeller.

A page becomes the sequence of its text blocks (leaf sequences).  Each block is
a vector: hashed tags and class words of its path, hashed words, and a few
numbers (length, share of link text, place).  A bidirectional LSTM in numpy
reads the whole sequence and says for every block whether it is main text, so
that a block's neighbours and the rest of the page decide with it.

The labeller is trained here on pages from a seeded generator of layouts, in
which the main text is known; words of the generator are made up from syllables,
so that markup and order, not vocabulary, carry the evidence.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import raw_texts, slices

PATH_BINS, WORD_BINS, DENSE, HIDDEN = 512, 96, 10, 20
WIDTH = PATH_BINS + WORD_BINS + DENSE
TRAIN_PAGES, EPOCHS, SEED = 2_500, 7, 11
#: Last epochs over whose steps the weights are averaged.
AVERAGED = 2
#: Weight of a block's own decision against the mean over the page's blocks with the same path.
OWN_SHARE = 0.7
WORDS_KEPT, PATHS_KEPT = 200_000, 20_000
#: Blocks of the pages that are run through the network together, at most (padding included).
BATCH_CELLS = 16_384

#: Fixed values of the HTML standard: elements without content, with raw text, and those that end a text block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head template noscript svg object canvas audio video annotation annotation-xml".split())
IN_HEAD = frozenset("head title meta link base basefont bgsound style script noscript noframes template".split())
FORMULA = frozenset("math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
                    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
INLINE = FORMULA | frozenset(
    "a abbr acronym annotation annotation-xml audio b bdi bdo big canvas cite code data del dfn em font i ins kbd label "
    "map mark object picture q s samp small span strike strong sub sup svg time tt u var video".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
          "tfoot": ("thead", "tbody", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl select html body".split())
INSIDE_P = INLINE | VOID | frozenset(("button", "select", "option", "textarea", "script", "style"))

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|type|rel|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
def _bin(kind: str, text: str, bins: int) -> int:
    return zlib.crc32(f"{kind}:{text}".encode("utf-8", "replace")) % bins


class _WordBins(dict):
    """Bin of each white-space word (lower case, outer marks off), kept up to ``WORDS_KEPT`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = _bin("w", word.strip(".,;:!?()[]\"'") or word, WORD_BINS)
        return out


_word_bins = _WordBins()


@lru_cache(maxsize=65_536)
def _element_bins(name: str, attributes: str) -> tuple[int, ...]:
    """Path features of one element: its tag and the words of its class, id and role."""
    found = {_bin("t", name, PATH_BINS)}
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        found.update(_bin("c", w.lower(), PATH_BINS) for w in _WORDS_OF_NAME.findall(value))
    if attributes and _HIDDEN.search(attributes):
        found.add(_bin("h", "hidden", PATH_BINS))
    return tuple(sorted(found))


@lru_cache(maxsize=65_536)
def _path_bins(leaf: str, path: tuple[tuple[int, ...], ...]) -> tuple[int, ...]:
    return tuple(sorted({_bin("l", leaf, PATH_BINS), *(b for bins in path for b in bins)}))


class Block:
    """A text block: its pieces, the features of its path, and how much of it is link text."""

    __slots__ = ("pieces", "path", "link", "depth")

    def __init__(self, path: list[tuple[int, ...]], leaf: str, depth: int):
        self.pieces: list[str] = []
        self.path = _path_bins(leaf, tuple(path))
        self.link = 0
        self.depth = depth

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def blocks(page: str) -> list[tuple[str, Block]]:
    """(text, block) of every text block of a page, empty ones left out, in page order."""
    out: list[Block] = []
    names: list[str] = []
    bins: list[tuple[int, ...]] = []
    open_count: dict[str, int] = {}
    current: Block | None = None
    hidden = 0  # open elements whose content is not text
    links = 0

    def pop() -> None:
        nonlocal hidden, links
        name = names.pop()
        bins.pop()
        open_count[name] -= 1
        hidden -= name in UNSEEN
        links -= name == "a"

    def close_to(name: str) -> None:
        while True:
            last = names[-1]
            pop()
            if last == name:
                return

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if hidden and names[-1] == "head" and page[at:lt].strip(" \t\n\f\r"):
            pop()  # text ends a head that is not closed
        if lt > at and not hidden:
            if current is None:
                leaf = next((x for x in reversed(names) if x not in INLINE), "body")
                current = Block(bins, leaf, len(names))
                out.append(current)
            text = page[at:lt]
            current.pieces.append(entities.unescape(text) if "&" in text else text)
            if links:
                current.link += lt - at
        if lt == n:
            break
        nxt = page[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            comment = page.startswith("<!--", lt)
            end = page.find("-->" if comment else ">", lt + 4 if comment else lt)
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        m = _TAG.match(page, lt)
        if m is None:
            if nxt == "/" or nxt.isascii() and nxt.isalpha():  # a tag that never ends, or with open quotes: up to the next mark
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:  # a bare less-than sign is text
                if hidden and names[-1] == "head":
                    pop()
                if not hidden:
                    if current is None:
                        current = Block(bins, next((x for x in reversed(names) if x not in INLINE), "body"),
                                        len(names))
                        out.append(current)
                    current.pieces.append("<")
                at = lt + 1
            continue
        at = m.end()
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if closing:
            if name not in INLINE and not hidden:
                current = None
            if open_count.get(name):
                close_to(name)
            continue
        if hidden and names[-1] == "head" and name not in IN_HEAD:
            pop()  # so does the first element that has no place in it
        if name == "br":
            if current is not None:
                current.pieces.append(" ")
            continue
        if name not in INLINE and name not in ("img", "wbr") and not hidden:
            current = None
        if name not in INSIDE_P and not hidden and open_count.get("p"):
            close_to("p")
        for other in CLOSES.get(name, ()):
            if open_count.get(other):
                for k in range(len(names) - 1, -1, -1):
                    if names[k] == other:
                        close_to(other)
                        break
                    if names[k] in SCOPES:
                        break
        if name == "body" and open_count.get("head"):
            close_to("head")
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = n if end is None else end.start()
            if end is not None:
                gt = page.find(">", at)
                at = n if gt < 0 else gt + 1
            continue
        if attributes.rstrip().endswith("/") and name in UNSEEN:
            continue
        names.append(name)
        bins.append(_element_bins(name, attributes.strip()))
        open_count[name] = open_count.get(name, 0) + 1
        hidden += name in UNSEEN
        links += name == "a"
    return [(t, b) for b in out if (t := b.text())]


def text_inputs(found: list[tuple[str, Block]]) -> np.ndarray:
    """(block, input) matrix of a page: hashed words and numbers."""
    n = len(found)
    words, sizes, dense = [], [], []
    log = math.log1p
    for i, (text, b) in enumerate(found):
        own = text.lower().split()
        words += own
        sizes.append(len(own))
        size = len(text)
        marks = text.count(".") + text.count(",") + text.count("!") + text.count("?")
        dense.append((1.0, log(size) / 5, log(len(own)) / 4, b.link / max(1, b.link, size),
                      min(1.0, 10 * marks / size), (i + 0.5) / n, min(b.depth, 20) / 10, float(size < 40),
                      float(text[-1] in ".!?"), float(n == 1)))
    size_a = np.array(sizes)
    bins = np.fromiter(map(_word_bins.__getitem__, words), np.int64, len(words))
    counts = np.bincount(np.repeat(np.arange(n) * WORD_BINS, size_a) + bins, minlength=n * WORD_BINS)
    share = np.sqrt(counts.reshape(n, WORD_BINS) / np.maximum(1, size_a)[:, None])
    return np.concatenate([share, np.array(dense)], axis=1).astype(np.float32)


def inputs(found: list[tuple[str, Block]]) -> np.ndarray:
    """(block, input) matrix of a page: hashed path, hashed words, numbers (for the fit)."""
    x = np.zeros((len(found), WIDTH), dtype=np.float32)
    for i, (_, b) in enumerate(found):
        x[i, list(b.path)] = 1.0
    x[:, PATH_BINS:] = text_inputs(found)
    return x


def same_path_means(found: list[tuple[str, Block]], logit: np.ndarray) -> np.ndarray:
    """Each block's decision blended with the mean over the page's blocks of the same path."""
    number: dict[tuple[int, ...], int] = {}
    group = np.array([number.setdefault(b.path, len(number)) for _, b in found])
    mean = np.bincount(group, logit) / np.bincount(group)
    return OWN_SHARE * logit + (1 - OWN_SHARE) * mean[group]


class Labeller:
    """Bidirectional LSTM over block vectors, a logistic output per block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        # input weights: four gates forward, four backward, and a direct path to the output
        self.p = {"w": rng.normal(0, 0.12, (WIDTH, 8 * HIDDEN + 1)), "c": np.zeros(8 * HIDDEN + 1),
                  "uf": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), "ub": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
                  "o": rng.normal(0, 0.2, 2 * HIDDEN)}
        self.p["w"][:, -1] = 0
        for side in (0, 4 * HIDDEN):  # forget gates begin open
            self.p["c"][side + HIDDEN:side + 2 * HIDDEN] = 1.0
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.paths: dict[tuple[int, ...], np.ndarray] = {}

    def project(self, found: list[tuple[str, Block]]) -> np.ndarray:
        """Inputs times input weights; the part of a path is computed once and kept."""
        out = text_inputs(found) @ self.p["w"][PATH_BINS:] + self.p["c"]
        if len(self.paths) > PATHS_KEPT:
            self.paths.clear()
        rows = []
        for _, b in found:
            v = self.paths.get(b.path)
            if v is None:
                v = self.paths[b.path] = self.p["w"][list(b.path)].sum(axis=0)
            rows.append(v)
        return out + np.array(rows)

    def _pass(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states (time, page, unit) of one direction; x already projected to the gates."""
        time, pages = mask.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, trace = np.zeros((time, pages, HIDDEN), np.float32), []
        u = self.p[f"u{side}"]
        for t in (range(time) if side == "f" else range(time - 1, -1, -1)):
            z = x[t] + h @ u
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            trace.append((t, h, c, i, f, o, g, tanh_c, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tanh_c, h)
            out[t] = h
        return out, trace

    def forward(self, batch: list[np.ndarray]) -> tuple:
        """(logits, mask, forward and backward states, places) of projected pages, laid out as (time, page)."""
        lengths = np.array([len(x) for x in batch])
        page = np.repeat(np.arange(len(batch)), lengths)
        time = np.arange(len(page)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        z = np.zeros((lengths.max(), len(batch), 8 * HIDDEN + 1), np.float32)
        z[time, page] = np.concatenate(batch)
        mask = np.zeros(z.shape[:2], dtype=bool)
        mask[time, page] = True
        forth = self._pass(z[:, :, :4 * HIDDEN], mask, "f")
        back = self._pass(z[:, :, 4 * HIDDEN:-1], mask, "b")
        logit = forth[0] @ self.p["o"][:HIDDEN] + back[0] @ self.p["o"][HIDDEN:] + z[:, :, -1]
        return logit, mask, forth, back, (time, page)

    def main_blocks(self, pages: list[list[tuple[str, Block]]]) -> list[np.ndarray]:
        """For each page, which of its blocks are main text."""
        out = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(pages[order[stop]]) <= BATCH_CELLS:
                stop += 1
            part = order[at:stop]
            logit = self.forward([self.project(pages[k]) for k in part])[0]
            for j, k in enumerate(part):
                out[k] = same_path_means(pages[k], logit[: len(pages[k]), j]) > 0
            at = stop
        return out

    def step(self, batch: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss of one batch."""
        logit, mask, forth, back, place = self.forward([x @ self.p["w"] + self.p["c"] for x in batch])
        y = np.zeros(mask.shape, np.float32)
        y[place] = np.concatenate(labels)
        d = (np.where(mask, 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y, 0) / mask.sum()).astype(np.float32)
        grad = {"o": np.concatenate([np.einsum("tp,tph->h", d, side[0]) for side in (forth, back)])}
        dz_all = np.zeros((*mask.shape, 8 * HIDDEN + 1), np.float32)
        dz_all[:, :, -1] = d
        for at, name, (_, trace) in ((0, "f", forth), (4 * HIDDEN, "b", back)):
            u, o = self.p[f"u{name}"], self.p["o"][at // 4:at // 4 + HIDDEN]
            gu = np.zeros_like(u)
            dh, dc = np.zeros((mask.shape[1], HIDDEN), np.float32), np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t, h0, c0, i, f, out, g, tanh_c, m in reversed(trace):
                dh_t = dh + d[t][:, None] * o
                own = np.where(m, dh_t, 0)
                dc_t = np.where(m, dc, 0) + own * out * (1 - tanh_c ** 2)
                dz = np.concatenate([dc_t * g * i * (1 - i), dc_t * c0 * f * (1 - f),
                                     own * tanh_c * out * (1 - out), dc_t * i * (1 - g ** 2)], axis=1)
                dz_all[t, :, at:at + 4 * HIDDEN] = dz
                gu += h0.T @ dz
                dh = np.where(m, dz @ u.T, dh_t)
                dc = np.where(m, dc_t * f, dc)
            grad[f"u{name}"] = gu
        dz = dz_all[place]
        grad["w"], grad["c"] = np.concatenate(batch).T @ dz, dz.sum(axis=0)
        return grad


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED, batch: int = 32,
          rate: float = 0.01) -> Labeller:
    """Fit the labeller on generated pages (Adam, falling rate); the same on every run."""
    from tessera.llm.html_layouts import generated_pages

    data = []
    for page, texts in generated_pages(pages, seed):
        found = blocks(page)
        if found:
            data.append((inputs(found), len(found), np.array([t in texts for t, _ in found], dtype=np.float32)))
    model = Labeller(seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in model.p.items()}
    square = {k: np.zeros_like(v) for k, v in model.p.items()}
    total = {k: np.zeros_like(v) for k, v in model.p.items()}
    done = summed = 0
    for epoch in range(epochs):
        # pages of like length share a batch; the batches come in random order
        order = np.argsort([n + rng.random() for _, n, _ in data])
        groups = [order[a:a + batch] for a in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            part = [data[k] for k in groups[g]]
            batch_x = [x.copy() for x, _, _ in part]
            for x in batch_x:  # some pages without their words
                if rng.random() < 0.3:
                    x[:, PATH_BINS:PATH_BINS + WORD_BINS] = 0
            grad = model.step(batch_x, [p[2] for p in part])
            done += 1
            now = rate * (1 - (done - 1) / (epochs * len(groups))) + 1e-4
            for k, v in grad.items():
                v = np.clip(v, -1, 1) + 1e-5 * model.p[k]
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                model.p[k] -= now * (mean[k] / (1 - 0.9 ** done)) / (np.sqrt(square[k] / (1 - 0.99 ** done)) + 1e-8)
            if epoch >= epochs - AVERAGED:
                summed += 1
                for k, v in model.p.items():
                    total[k] += v
    model.p = {k: v / summed for k, v in total.items()} if summed else model.p
    return model


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """The labeller of these settings; it depends on no table, so one fit serves the process."""
    return train(pages, epochs, seed)


def main_text(found: list[tuple[str, Block]], keep: np.ndarray) -> str:
    return "\n".join(t for (t, _), k in zip(found, keep) if k)


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text) of every page: its main blocks in order, joined by a newline.

    A null or empty page, or one without main text, gives the empty text.
    Repeated rows, null ids and null urls are kept; extra columns are ignored;
    an empty table gives an empty result.
    """
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html", rows=128, max_bytes=4 << 20):
            found = [blocks(raw.decode("utf-8", "replace")) for raw in raw_texts(b, "html")]
            texts = [main_text(f, keep) for f, keep in zip(found, model.main_blocks(found))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string")
