"""Verdicts and extracts that must not depend on the length or the neighbours of a text."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

pytest.importorskip("tessera.llm")

from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import html, toxicity  # noqa: E402

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model_and_held_out():
    docs = {d["doc_id"]: d for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = [(m["doc_id"], m["toxic"], docs[m["doc_id"]]["text"] or "", docs[m["doc_id"]]["lang"])
            for m in pq.read_table(f"{SF}/labels.parquet").to_pylist() if m["doc_id"] in docs and m["toxic"] is not None]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 0 and len(r[2]) <= toxicity.FIT_CHARS]
    return toxicity.train([r[2] for r in learn], [r[1] for r in learn]), held


def test_toxicity_held_out(model_and_held_out):
    model, held = model_and_held_out
    toxic = np.array([r[1] for r in held]) == 1
    flagged = model.probability([r[2] for r in held]) >= 0.5
    assert (flagged == toxic).mean() > 0.965 and flagged[~toxic].mean() < 0.015


def test_clean_texts_stay_clean_when_repeated_or_joined(model_and_held_out):
    model, held = model_and_held_out
    scores = model.probability([r[2] for r in held])
    for lang in ("en", "de", "fr", "es"):
        clean = [r[2] for r, p in zip(held, scores) if r[1] == 0 and r[3] == lang and p < 0.2][:40]
        assert len(clean) >= 20
        for times in (10, 50):
            assert (model.probability(["\n".join([t] * times) for t in clean[:20]]) < 0.5).all(), (lang, times)
        assert (model.probability(["\n".join(clean[:k]) for k in (5, 20, 40)]) < 0.5).all(), lang
    everything = [r[2] for r, p in zip(held, scores) if r[1] == 0 and p < 0.2][:200]
    assert model.probability(["\n".join(everything)])[0] < 0.5


def test_an_insulting_sentence_in_a_long_text_is_found(model_and_held_out):
    model, held = model_and_held_out
    scores = model.probability([r[2] for r in held])
    clean = "\n".join([r[2] for r, p in zip(held, scores) if r[1] == 0 and r[3] == "en" and p < 0.2][:100])
    assert len(clean.split()) > 20_000
    at = clean.index(" ", len(clean) // 2)
    for a, b in (("idiot", "moron"), ("stupid", "loser"), ("worthless", "scum")):
        said = f" You are a {a} and a {b}, you {a}! "
        assert model.probability([clean[:at] + said + clean[at:], clean + said, said + clean]).min() >= 0.5, (a, b)


def test_landmarks_are_no_chance_tokens(model_and_held_out):
    r = np.random.default_rng(1)
    words = ["".join(r.choice(list("abcdefgh"), 6)) for _ in range(3_000)]
    texts = [" ".join(r.choice(words, 80)) for _ in range(600)]
    copies = texts[:1] * 40  # one toxic text and its copies make none of its words an insult
    model = toxicity.train(texts + copies, [0] * 500 + [1] * 100 + [1] * 40)
    assert model.landmarks.words == []
    assert model_and_held_out[0].landmarks.words[:3]


def test_passages_hold_the_whole_text():
    model = toxicity.train(["one two"], [0])
    for text in ("", "a. b. c.", "w " * 1_000, "x y z. " * 500, ("long " * 150 + ". ") * 3):
        model.features([text])
        places = np.array([model.cache[c] for c in text.split()], dtype=np.int64)
        parts = model.passages(places)
        assert parts[0][0] == 0 and parts[-1][1] == len(places)
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and all(e - s <= toxicity.PASSAGE for s, e in parts)


@pytest.mark.parametrize("page, want", [
    ("<p>Hello <Привет> world</p>", ["Hello <Привет> world"]),
    ("<p>if a <é b and c</p><p>d</p>", ["if a <é b and c", "d"]),
    ("<p>It is <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation encoding='t'>x+1</annotation></math> here</p>", ["It is x+1 here"]),
    ("<p>See <video src=v>no video</video> and <object>none</object><svg><text>t</text></svg>this</p>", ["See and this"]),
])
def test_tags_open_with_ascii_letters_and_formulas_and_media_split_no_paragraph(page, want):
    assert [text for text, _ in html.blocks(page)] == want


def test_html_pages_by_hand(spark):
    """Layouts that the generator does not make; comments, notices, menus and adverts go, tables stay whole."""
    from tests.llm.pages_by_hand import PAGES
    frame = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(PAGES)], "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(frame.withColumn("url", F.lit(None).cast("string"))).collect()}
    wrong = [i for i, (_, lines) in enumerate(PAGES) if got[i] != "\n".join(lines)]
    assert len(wrong) <= 1, [got[i] for i in wrong]
