"""Language identification by hierarchical discrimination.

Whole texts become hashed counts of one- to three-letter grams (square roots,
unit length).  A first layer of linear SVMs, one per language family against
the rest, picks the family; inside it, one linear SVM per pair of languages
votes.  Everything is fitted on a bounded hash sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, raw_texts, slices
from tessera.llm.toxicity import svm

#: Documents used for the fit, about, over all languages.
FIT_DOCS = 4_000
HELD_MODULUS, HELD_REMAINDER = 3, 1
BINS = 4096
UNKNOWN = "und"

#: Family of a language code; other codes are a family of their own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "ne", "gu", "pa"),
    "semitic": ("ar", "he", "am", "mt"),
}


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), f"own {lang}")


_LETTER = np.zeros(1 << 16, dtype=bool)
_LETTER[[i for i in range(1 << 16) if chr(i).isalpha()]] = True


def gram_counts(text: str) -> np.ndarray | None:
    """Hashed counts of the letter grams of a whole text; None if it has no letter."""
    counts = np.zeros(BINS)
    some = False
    lower = text.lower()
    for at in range(0, len(lower), 1 << 20):
        point = np.frombuffer(lower[at:at + (1 << 20)].encode("utf-32-le", "replace"), dtype=np.uint32)
        low = point < 1 << 16
        letter = _LETTER[np.where(low, point, 0)]
        if not low.all():
            letter[~low] = [chr(p).isalpha() for p in point[~low]]
        if not letter.any():
            continue
        some = True
        c = np.where(letter, point, 0).astype(np.uint32)
        c = np.concatenate([[0], c[(c != 0) | np.r_[True, c[:-1] != 0]], [0]]).astype(np.uint32)
        h1 = c * np.uint32(2654435761)
        h2 = (h1[:-1] ^ (c[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
        h3 = (h2[:-1] ^ (c[2:] * np.uint32(668265263))) * np.uint32(374761393)
        for h, inner in ((h1, c != 0), (h2, (c[:-1] != 0) | (c[1:] != 0)), (h3, c[1:-1] != 0)):
            counts += np.bincount(h[inner] >> np.uint32(20), minlength=BINS)
    return counts if some else None


def profile(text: str) -> np.ndarray | None:
    """Unit vector of square roots of the gram counts; None if the text has no letter."""
    counts = gram_counts(text)
    if counts is None:
        return None
    return np.sqrt(counts / counts.sum()).astype(np.float32)


@dataclass
class Identifier:
    """Family decisions, then pairwise decisions inside each family."""

    families: list[str]
    members: dict[str, list[str]]
    family_w: np.ndarray
    family_b: np.ndarray
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score) of each row."""
        margin = 3 * (x @ self.family_w.T + self.family_b)
        odds = np.exp(margin - margin.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        pick = margin.argmax(axis=1)
        out = [""] * len(x)
        score = odds[np.arange(len(x)), pick]
        for k, family in enumerate(self.families):
            rows = np.flatnonzero(pick == k)
            langs = self.members[family]
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(langs)))
            for i, j in combinations(range(len(langs)), 2):
                w, b = self.pairs[langs[i], langs[j]]
                p = 1 / (1 + np.exp(-np.clip(3 * (x[rows] @ w + b), -30, 30)))
                votes[:, i] += p
                votes[:, j] += 1 - p
            if len(langs) > 1:
                votes /= len(langs) - 1
            else:
                votes += 1
            best = votes.argmax(axis=1)
            score[rows] *= votes[np.arange(len(rows)), best]
            for r, b in zip(rows, best):
                out[r] = langs[b]
        return out, score


def train(x: np.ndarray, langs: list[str]) -> Identifier | None:
    """Fit both layers; None without a labelled text."""
    if not langs:
        return None
    members: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        members.setdefault(family_of(lang), []).append(lang)
    families = sorted(members)
    lang_a = np.array(langs)
    family_a = np.array([family_of(s) for s in langs])
    ones = np.ones(len(x))
    scaled = x.astype(float) * 3
    w, b = np.zeros((len(families), x.shape[1])), np.zeros(len(families))
    for k, family in enumerate(families if len(families) > 1 else []):
        w[k], b[k] = svm(scaled, np.where(family_a == family, 1.0, -1.0), ones, rounds=8)
    model = Identifier(families, members, w * 3, b)
    for langs_of in members.values():
        for one, two in combinations(langs_of, 2):
            rows = (lang_a == one) | (lang_a == two)
            pw, pb = svm(scaled[rows], np.where(lang_a[rows] == one, 1.0, -1.0), ones[rows], rounds=8)
            model.pairs[one, two] = (pw * 3, pb)
    return model


def fit_langid(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               bound: int = FIT_DOCS) -> Identifier | None:
    """Fit on documents outside the held-out third: each language is sampled by a hash of the id
    at the rate that gives it an equal part of ``bound`` documents, about."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.col(lang_col).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
        & (crc_mod("doc_id", HELD_MODULUS) != HELD_REMAINDER))
    counts = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = max(1, bound // len(counts))
    rate = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        rate = F.when(F.col("lang") == lang, min(1.0, share / n)).otherwise(rate)
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / float(1 << 53)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [(i, x.astype("<f2").tobytes(), lang) for i, raw, lang in zip(
                b.column(0).to_pylist(), raw_texts(b, "text"), b.column(2).to_pylist())
                if (x := profile(raw.decode("utf-8", "replace"))) is not None]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.string()))],
                    names=["doc_id", "x", "lang"])

    rows = named.where(chance < rate).mapInArrow(run, "doc_id long, x binary, lang string").collect()
    rows = sorted(((r["lang"], r["doc_id"] or 0, bytes(r["x"])) for r in rows))
    x = np.array([np.frombuffer(r[2], dtype="<f2") for r in rows], dtype=np.float32).reshape(len(rows), BINS)
    return train(x, [r[0] for r in rows])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             bound: int = FIT_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    A null or empty text, or one without a letter, is ``und`` with score 0; so
    is every text if no document is labelled.  Repeated rows get equal results;
    an empty table gives an empty result; extra columns are ignored.
    """
    model = fit_langid(docs, id_col, text_col, lang_col, bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", rows=256):
            langs, scores = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            found = [(i, x) for i, raw in enumerate(raw_texts(b, "text"))
                     if model is not None and (x := profile(raw.decode("utf-8", "replace"))) is not None]
            if found:
                names, values = model.predict(np.array([x for _, x in found]))
                for (i, _), name, value in zip(found, names, values):
                    langs[i], scores[i] = name, min(1.0, float(value))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs), pa.array(scores)],
                                             names=["doc_id", "lang_pred", "score"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = source.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (crc_mod("doc_id", HELD_MODULUS) == HELD_REMAINDER).alias("held_out"),
                      "lang_pred", "score")
