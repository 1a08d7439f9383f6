"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import collections
import hashlib
import io
import random
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tessera.llm")

from tessera.llm import chat, components, html, langid, mips, mixing, packing, quality, simhash, toxicity, warc  # noqa: E402
from tessera.llm.queries import VOCABULARY  # noqa: E402
from tessera.session import scratch_dir  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, `rank` int, size long, copies int"


def docs(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, None, "x", 1, 2, 3) for r in rows], DOCS)


MIXED = [(1, "the cat sat on the mat", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
         (3, "", "en", "a"), (None, "no id here at all", None, "b"), (4, " \n\t ", "de", None),
         (5, "word " * 30_000, "en", "a"), (6, "the cat sat on the mat", "en", "b")]
LABELS = "doc_id long, quality int, toxic int, text string"


def labels(spark, rows=()):
    return spark.createDataFrame([(*r, "t") for r in rows], LABELS)


# --- mixing

def test_mixing_odd_rows(spark):
    got = mixing.mix(docs(spark, MIXED)).collect()
    assert len(got) == len(MIXED)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        assert r["taken"] <= 2 * r["size"]
    assert by[2][0]["size"] == 0 and by[2][0]["taken"] == 0
    assert len(by[3]) == 2 and by[5][0]["size"] == 30_000
    assert mixing.mix(docs(spark, [])).collect() == []
    back = mixing.apply_mix(docs(spark, MIXED))
    assert back.columns == docs(spark, MIXED).columns
    counts = collections.Counter(r["doc_id"] for r in back.collect())
    assert all(counts[r["doc_id"]] == r["copies"] for r in got if r["doc_id"] in (1, 5, 6))
    same = docs(spark, [(8, "one two three", "en", "a")] * 101 + [(9, "four", "en", "b")])
    got = mixing.mix(same).where("doc_id = 8").collect()
    assert len(got) == 101 and abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 3
    assert mixing.apply_mix(same).where("doc_id = 8").count() == sum(r["copies"] for r in got)


def test_mixing_large_hot_source(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.repeat(F.lit("w "), (1 + F.pmod(F.xxhash64("id"), F.lit(40))).cast("int")).alias("text"))
    got = mixing.mix(rows).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in got) == 20_000
    for r in got:
        assert abs(r["taken"] - r["target"]) < 0.01 * r["target"]


def test_mixing_keeps_columns_of_repeated_ids(spark):
    cells = [(1, "one two three", "en", "a")] * 60 + [(1, "one two three", "de", "a")] * 40 + [(2, "four", "en", "b")]
    rows = docs(spark, cells)
    got = collections.Counter(r["lang"] for r in mixing.apply_mix(rows).where("doc_id = 1").collect())
    mix = [r["copies"] for r in mixing.mix(rows).where("doc_id = 1").collect()]
    assert sum(got.values()) == sum(mix)
    assert 60 * min(mix) <= got["en"] <= 60 * max(mix) and 40 * min(mix) <= got["de"] <= 40 * max(mix)
    assert min(mix) == 0 or set(got) == {"en", "de"}


def test_representatives_of_repeated_and_null_ids(spark):
    r = random.Random(3)
    a, b, c, d = (" ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(4))
    rows = docs(spark, [(1, a, "en", "s"), (1, b, "en", "s"), (1, b, "en", "s"), (7, b, "en", "s"), (8, a, "en", "s"),
                        (None, c, "en", "s"), (None, f" {c}", "en", "s"), (None, d, "en", "s"), (9, d, "en", "s")])
    kept = simhash.keep_representatives(rows)
    assert kept.columns == rows.columns
    got = sorted(((x["doc_id"], x["text"].strip()) for x in kept.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c), (9, d)], key=str)


def test_stages_keep_columns_of_any_name(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars", "__mark", "__hash", "a.b", "mark", "known", "c0", "c7",
             "__doc", "__copy", "__whole", "no_id", "repeats", "whole", "extra", "fp", "rep"]
    cells = [(1, "one two three four", "en", "a", 18), (2, "one two three four", "en", "a", 18),
             (3, "other words of another text", "en", "b", 27), (3, "other words of another text", "en", "b", 27),
             (None, "a text without an id", "de", None, 20)]
    rows = spark.createDataFrame([(*c, *[f"{n}-{c[0]}" for n in names[5:]]) for c in cells],
                                 "doc_id long, text string, lang string, source string, n_chars int, "
                                 + ", ".join(f"`{n}` string" for n in names[5:]))
    for kept in (simhash.keep_representatives(rows), mixing.apply_mix(rows)):
        assert kept.columns == names
        got = [tuple(r) for r in kept.collect()]
        assert got and set(got) <= {tuple(r) for r in rows.collect()}
    reps = sorted((r["doc_id"] or -1) for r in simhash.keep_representatives(rows).collect())
    assert reps == [-1, 1, 3]


def test_representatives_shuffle_documents_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = simhash.keep_representatives(docs(spark, MIXED))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 2  # the documents and the wanted rows


# --- top-k

def brute_topk(rows, k=5):
    v = [(i, [int(np.floor(256 * x)) for x in e]) for i, e in rows]
    out = []
    for q, a in v:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_topk_ties_nulls_and_lengths(spark):
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) * (1 + i % 9) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, [0.5] * 8) for i in range(300)]  # one very common vector
    odd = [(1001, None), (1002, [None] * 8), (1003, [float("nan")] * 8), (1004, [float("inf")] * 8), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(*x, 0, 1.0) for x in rows + odd],
                                  "vec_id long, embedding array<double>, part int, norm2 double")
    got = mips.top_inner_products(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(x) for x in got) == brute_topk(rows)
    few = frame.where("vec_id < 3")
    assert len(mips.top_inner_products(few, F.col("vec_id") % 50 == 0).collect()) == 2
    assert mips.top_inner_products(frame.where("vec_id < 0"), F.col("vec_id") % 50 == 0).collect() == []
    short = spark.createDataFrame([(0, [1.0]), (1, [1.0, 1.0]), (2, [])], "vec_id long, embedding array<double>")
    got = mips.top_inner_products(short, F.col("vec_id") % 50 == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 65536), (2, 0)]


@pytest.mark.parametrize("first, least_tiles, falling", [(8, 64, 3), (1, 64, 3), (1, 5, 3), (2, 64, 1)])
def test_topk_pruning_over_many_blocks(spark, monkeypatch, first, least_tiles, falling):
    monkeypatch.setattr(mips, "BLOCK_ROWS", 64)
    monkeypatch.setattr(mips, "QUERY_ROWS", 8)
    monkeypatch.setattr(mips, "FIRST_TILES", first)
    monkeypatch.setattr(mips, "LEAST_TILES", least_tiles)
    r = random.Random(9)
    rows = [(i, [r.gauss(0, 1) * falling ** (-(i % 11)) for _ in range(6)]) for i in range(1_500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mips.top_inner_products(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(x) for x in got) == brute_topk(rows)


def test_topk_rounds_raise_bounds(spark, monkeypatch):
    """After a round the bounds of a query block are its k-th best scores so far, and its prefix is shorter."""
    monkeypatch.setattr(mips, "BLOCK_ROWS", 16)
    monkeypatch.setattr(mips, "QUERY_ROWS", 8)
    monkeypatch.setattr(mips, "FIRST_TILES", 2)
    written = []
    keep = mips.materialize
    monkeypatch.setattr(mips, "materialize", lambda df, name: written.append((name, keep(df, name))) or written[-1][1])
    r = random.Random(3)
    rows = [(i, [abs(r.gauss(0, 1)) * (1 - i / 2_000) for _ in range(4)]) for i in range(1_600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mips.top_inner_products(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(x) for x in got) == brute_topk(rows)
    steps = [{b["block"]: (b["last"], np.frombuffer(b["least"])) for b in df.collect()}
             for name, df in written if name == "mips-bounds"]
    assert len(steps) >= 2
    shorter = 0
    for before, after in zip(steps, steps[1:]):
        for block, (last, least) in after.items():
            assert last <= before[block][0] and (least >= before[block][1]).all()
            shorter += last < before[block][0]
    assert shorter


def test_exact_dots_beyond_doubles():
    q, x = np.array([[2 ** 40, 3]]), np.array([[2 ** 40, 5], [1, 1]])
    assert mips._dots(q, x).tolist() == [[2 ** 63 - 1, 2 ** 40 + 3]]
    assert mips._dots(np.array([[2 ** 30, 1]]), np.array([[2 ** 31, 1]])).tolist() == [[2 ** 61 + 1]]


# --- packing

def test_packing_odd_rows(spark):
    got = packing.pack(docs(spark, MIXED), VOCABULARY).collect()
    assert sum(r["doc_id"] == 3 for r in got) == 2
    assert [r["length"] for r in got if r["doc_id"] == 2] == [1]
    long = sorted((r["piece"], r["start"], r["length"]) for r in got if r["doc_id"] == 5)
    assert [x[2] for x in long[:-1]] == [4096] * (len(long) - 1) and long[-1][1] + long[-1][2] == 30_001
    assert packing.pack(docs(spark, []), VOCABULARY).collect() == []
    assert any(r["doc_id"] is None for r in got)


def test_packing_plans():
    r = random.Random(3)
    for case in range(25):
        capacity = r.choice((16, 100, 512))
        histogram = {r.randint(1, capacity): r.randint(1, 400) for _ in range(r.randint(1, 60))}
        places = collections.defaultdict(list)
        seen = collections.Counter()
        for length, rank, count, first, per, offset in packing.plan(histogram, capacity):
            assert rank == seen[length]
            seen[length] += count
            for i in range(count):
                places[first + i // per].append((offset + i % per * length, length))
        assert seen == histogram
        for rows in places.values():
            at = 0
            for offset, length in sorted(rows):
                assert offset == at
                at += length
            assert at <= capacity
        bound = max(-(-sum(k * n for k, n in histogram.items()) // capacity),
                    sum(n for k, n in histogram.items() if 2 * k > capacity))
        assert len(places) <= 1.25 * bound + 2
    assert packing.plan({}) == []


def test_chunk_tokenizer_equals_the_tokenizer():
    from tokenizers import Tokenizer

    whole, chunked = Tokenizer.from_file(VOCABULARY), packing.ChunkTokenizer(VOCABULARY)
    texts = ["", "  \n", "Don't we'll IT'S x''y", "Äößé ÀÉ ñ ÿ×÷", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΟΔΥΣΣΕΥΣ İ",
             "x\x1cy\x85z\xa0w", "é́ ﬁ ½²", "😀😀 𝔘", "A" * 5000, "12ab34!!?<|", "tab\tand\x0bvt\x0cff\rcr"]
    got = chunked.ids([t.encode() for t in texts])
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]


# --- SimHash

def test_simhash_odd_rows(spark):
    got = simhash.simhash_groups(docs(spark, MIXED)).collect()
    assert len(got) == len(MIXED)
    by = collections.defaultdict(list)
    for r in got:
        by[r["id"]].append(r)
    assert by[2][0]["fp"] == 0 and {r["component"] for r in by[3]} == {2} and by[4][0]["component"] == 2
    assert by[6][0]["component"] == 1 and by[1][0]["component"] == 1
    assert by[None][0]["component"] is None
    assert simhash.simhash_groups(docs(spark, [])).collect() == []
    kept = simhash.keep_representatives(docs(spark, MIXED))
    assert kept.columns == docs(spark, []).columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect() if r["doc_id"]) == [
        (False, 1), (False, 2), (False, 5)]


def test_vantage_point_search_finds_every_link(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 3_000, dtype=np.uint64)
    near = base[:900] ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64))
    nearer = near[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)) \
        ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    points = np.unique(np.concatenate([base, near, nearer]))
    want = set()
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 2):
            want.add((i, i + 1 + int(j)))
    got = {(min(a, b), max(a, b)) for i, j in simhash.close_pairs(points, 2, leaf=64)
           for a, b in zip(i.tolist(), j.tolist())}
    assert got == want
    # the routing tree: every linked pair meets in a shard
    nodes = simhash.build_tree(points[::2], len(points), 2, shard_rows=300)
    assert sum(n[2] < 0 for n in nodes) > 4
    row, shard = simhash.route(nodes, points, 2)
    at = collections.defaultdict(set)
    for r, s in zip(row.tolist(), shard.tolist()):
        at[r].add(s)
    assert all(at[i] & at[j] for i, j in want) and set(at) == set(range(len(points)))
    # and the distributed whole
    frame = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    edges = [tuple(r) for r in simhash.links(frame, 2, shard_rows=300).collect()]
    root = {int(x): int(x) for x in points.view(np.int64)}

    def find(x, tree):
        while tree[x] != x:
            x = tree[x]
        return x

    for tree, pairs in ((root, edges),):
        for a, b in pairs:
            a, b = find(a, tree), find(b, tree)
            tree[max(a, b)] = min(a, b)
    other = {x: x for x in root}
    signed = points.view(np.int64)
    for i, j in want:
        a, b = find(int(signed[i]), other), find(int(signed[j]), other)
        other[max(a, b)] = min(a, b)
    assert {x: find(x, root) for x in root} == {x: find(x, other) for x in other}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 201: 200}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


# --- quality, toxicity, language

def test_quality_odd_rows(spark):
    got = {r["doc_id"]: r for r in quality.judge(docs(spark, MIXED), labels(spark)).collect()}
    assert got[2]["n_words"] == 0 and got[2]["base_failed"] and not got[2]["kept"]
    assert got[5]["n_words"] == 30_000 and got[5]["n_repeat_words"] == 30_000 and got[5]["base_failed"]
    assert quality.judge(docs(spark, []), labels(spark)).collect() == []
    assert quality.keep_good(docs(spark, MIXED), labels(spark)).columns == docs(spark, []).columns


def test_boosted_trees_keep_their_directions():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.random(600)) > 0.7).astype(float)
    model = quality.fit(x, y, (1, 0, -1))
    grid = np.linspace(0, 1, 50)
    for point in x[:40]:
        for k, sign in ((0, 1), (2, -1)):
            line = np.repeat(point[None], 50, axis=0)
            line[:, k] = grid
            assert (sign * np.diff(model.margin(line)) >= -1e-9).all()
    assert ((model.probability(x) >= 0.5) == y).mean() > 0.9
    constant = quality.fit(np.zeros((0, 3)), np.zeros(0), (0, 0, 0))
    assert constant.probability(np.ones((2, 3))).tolist() == [0.5, 0.5]


def test_toxicity_odd_rows_and_spellings(spark):
    got = toxicity.toxicity(docs(spark, MIXED), labels(spark)).collect()
    assert len(got) == len(MIXED) and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in got)
    assert toxicity.toxicity(docs(spark, []), labels(spark)).collect() == []
    r = random.Random(2)
    clean = [" ".join(r.choice("the of and house river mountain letter window garden".split()) for _ in range(30))
             for _ in range(120)]
    bad = [t + r.choice((" you idiot.", " what a moron.", " pathetic idiot.")) for t in clean[:60]]
    model = toxicity.train(clean + bad, [0] * 120 + [1] * 60)
    p = model.probability(["an idiot lives here", "an i.d.i.o.t lives here", "an i d i o t lives here",
                           "an idiiot lives here", "an 1diot lives here", "the river and the house", "", "x" * 300])
    assert (p[:5] > 0.5).all() and (p[5:] < 0.5).all()


def test_toxicity_gapped_and_split_spellings():
    r = random.Random(2)
    clean = [" ".join(r.choice("the of and house river mountain letter window garden".split()) for _ in range(30))
             for _ in range(120)]
    bad = [t + r.choice((" you idiot.", " what a moron.", " stupid loser.")) for t in clean[:90]]
    model = toxicity.train(clean + bad, [0] * 120 + [1] * 90)
    gapped = ["an ixdxiot lives here", "an ixdxixot lives here", "an ixdxixoxt lives here", "a stxupxid house",
              "a stxuxpxid house", "a mxoxrxoxn lives here", "a lxoxsxexr lives here", "an id iot lives here",
              "an i. d. i. o. t. lives here", "an i d io t lives here", "a stu - pid house", "the mo ron lives here"]
    p = model.probability(gapped + ["the river and the house"])
    assert (p[:-1] > 0.5).all() and p[-1] < 0.5
    seen = model.landmarks.kernel(["ixdxixoxt"])
    assert seen.max() == pytest.approx(toxicity.DECAY ** 4)
    (apart, near), _ = model.features(["The house is mo. Ron lives here", "The house is mo Ron lives here"])
    assert apart.sum() < near.sum()  # a window ends with its sentence


def test_toxicity_scores_do_not_depend_on_the_caps(spark):
    r = random.Random(4)
    rows, marks = [], []
    for i in range(2_000):
        toxic = int(i % 10 == 0)
        text = [r.choice("the of and house river mountain letter window garden".split()) for _ in range(25)]
        text += ["clown"] * (r.random() < (0.6 if toxic else 0.1)) + ["idiot"] * (r.random() < 0.5 * toxic)
        rows.append((i, " ".join(text), "en", "a"))
        marks.append((i, 1, toxic))
    asked = [" ".join(["the house and the river"] * 5 + [w]) for w in ("clown", "idiot", "garden")]
    whole, capped = (toxicity.fit_toxicity(docs(spark, rows), labels(spark, marks), per_label=n).probability(asked)
                     for n in (5_000, 140))
    assert np.abs(whole - capped).max() < 0.15, (whole, capped)
    assert ((whole > 0.5) == (capped > 0.5)).all() and whole[1] > 0.5 > whole[0]


def test_language_odd_rows(spark):
    got = langid.identify(docs(spark, MIXED)).collect()
    assert len(got) == len(MIXED)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (2, 3, 4))
    assert langid.identify(docs(spark, [])).collect() == []
    only = langid.identify(docs(spark, [(1, "123 !!!", None, None)])).collect()
    assert [r["lang_pred"] for r in only] == ["und"]
    assert langid.profile("12 . ,") is None and langid.profile("𝔘") is not None


# --- HTML

def test_html_parsing():
    page = ("<html><head><title>T</title></head><body><!-- <p>no</p> --><script>var a='<p>x</p>';</script>"
            "<p>One &amp; two&nbsp;&#x41;<b>bold</b>\n  more<br>line<p>Second < third<div>Open <i>it</div>"
            "<ul><li>a<li>b</ul><style>p{}</style><textarea>no</textarea>tail")
    assert [t for t, _ in html.blocks(page)] == [
        "One & two Abold more line", "Second < third", "Open it", "a", "b", "tail"]
    assert html.blocks("") == [] and html.blocks("<!-- never closed <p>x") == []
    assert [t for t, _ in html.blocks("a<p title='>'>b</p><3 c</unopened>")] == ["a", "b", "<3 c"]
    assert len(html.blocks("<div>" * 20_000 + "deep")) == 1


def test_html_head_without_end():
    for start in ("<html><head><title>T</title>", "<head>\n<meta charset=x><link rel=y><base href=z>\n"
                  "<style>p{}</style><script>var a='<p>';</script><noscript><p>no</p></noscript>"
                  "<template><p>no</p></template>", "<!DOCTYPE html><head><!-- c --><title>T</title> </div> "):
        for end in ("", "</head>", "<body>", "</head><body>"):
            assert [t for t, _ in html.blocks(f"{start}{end}<article><h1>One</h1><p>Two</article>three")] == [
                "One", "Two", "three"]
            assert [t for t, _ in html.blocks(f"{start}{end} plain <b>text</b>")] == ["plain text"]
            assert [t for t, _ in html.blocks(f"{start}{end}<img src=x><br>a<p>b")] == ["a", "b"]
            assert [t for t, _ in html.blocks(f"{start}{end}< 3")] == ["< 3"]
    assert html.blocks("<head><title>T</title>\n") == []


def test_html_other_layouts(spark):
    article = ("<h1>A headline of the story</h1><p>The first long paragraph of the story, with enough words to read.</p>"
               "<p>The second long paragraph goes on and on, as paragraphs of stories do.</p>")
    want = "\n".join(("A headline of the story",
                      "The first long paragraph of the story, with enough words to read.",
                      "The second long paragraph goes on and on, as paragraphs of stories do."))
    page = ("<body><div class='cookie-banner'>We use cookies.</div><header><a href=/>Home</a></header>"
            "<div id='nav'><ul><li><a href=/a>News</a></li><li><a href=/b>Sport</a></li></ul></div>"
            "<main>%s</main><aside class='sidebar'><h3>Related</h3><a href=/c>More</a></aside>"
            "<form><label>Email</label><button>Send</button></form>"
            "<div id='comments' class='comments'><div class='comment'>Great post, thanks!</div></div>"
            "<footer>Copyright 2020</footer></body>") % article
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", page), (5, "w", page)]
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = html.extract(frame).collect()
    assert sorted(r["text"] for r in got) == ["", "", "", want, want]
    assert html.extract(frame.where("page_id > 99")).collect() == []


# --- WARC

def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "page_id long, url string, html string, digest string, `first` int")


def test_warc_round_trip_odd_rows(spark):
    big = "é" * 200
    rows = [(5, "http://a/1", big), (3, "http://a/2\nx", big), (9, None, big), (1, "u", "short"), (2, "u", "short"),
            (4, "u", None), (4, "u", None), (None, "u", big), (7, "u", "y" * 3_000_000)]
    got = warc.round_trip(pages(spark, rows), spark).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[3]["record_type"] == "response" and by[3]["payload_bytes"] == 400
    for i in (5, 9, None):
        assert (by[i]["record_type"], by[i]["refers_to"], by[i]["payload_bytes"]) == ("revisit", 3, 400)
        assert by[i]["payload_digest"] == hashlib.sha256(big.encode()).hexdigest()
    assert by[1]["record_type"] == by[2]["record_type"] == by[4]["record_type"] == "response"
    assert by[4]["payload_bytes"] == 0 and by[7]["payload_bytes"] == 3_000_000
    assert warc.round_trip(pages(spark, []), spark).collect() == []


def test_warc_payloads_and_headers(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * 50) for i in range(40)]
    manifest = warc.write_archives(pages(spark, rows), scratch_dir(spark, "warc"), archive_bytes=800)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == 40
    got = {r["target_uri"]: bytes(r["payload"]).decode() for r in warc.read_archives(manifest).collect()}
    assert got == {u: h for _, u, h in rows}


def test_zip64_directory():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/data.warc.gz", b"abc")
        z.writestr("indexes/index.cdxj", b"index")
        z.comment = b"note PK\x05\x06 within"
    plain = raw.getvalue()
    found = warc.members(io.BytesIO(plain), len(plain))
    at = found["archive/data.warc.gz"]
    assert plain[at.offset:at.offset + at.size] == b"abc"
    # the same directory, its numbers moved to ZIP64 records
    end = plain.rindex(b"PK\x05\x06\x00")
    size, offset = struct.unpack_from("<II", plain, end + 12)
    directory = b""
    place = offset
    while plain[place:place + 4] == b"PK\x01\x02":
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", plain, place + 28)
        packed, whole = struct.unpack_from("<II", plain, place + 20)
        local = struct.unpack_from("<I", plain, place + 42)[0]
        extra = struct.pack("<HHQQQ", 1, 24, whole, packed, local)
        head = bytearray(plain[place:place + 46])
        struct.pack_into("<II", head, 20, 0xFFFFFFFF, 0xFFFFFFFF)
        struct.pack_into("<H", head, 30, len(extra))
        struct.pack_into("<I", head, 42, 0xFFFFFFFF)
        directory += bytes(head) + plain[place + 46:place + 46 + n_name] + extra
        place += 46 + n_name + n_extra + n_comment
    body = plain[:offset] + directory
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 2, 2, len(directory), offset)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(body), 1)
    last = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    big = body + end64 + locator + last
    assert warc.members(io.BytesIO(big), len(big)) == found
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"no archive"), 10)
    deflated = io.BytesIO()
    with zipfile.ZipFile(deflated, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        warc.members(deflated, len(deflated.getvalue()))


# --- chat

def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows],
                                 "conv_id long, turn long, role string, text string, formatted string, part int")


def digest(lines):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in lines).encode()).hexdigest()


def test_chat_odd_rows(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\nhi <\\|x <s></s> [INST] [\\/INST] \\ \r\n é😀"
    rows = [(1, 2, "assistant", nasty), (1, 1, "user", None), (1, 2, "assistant", nasty), (2, 1, None, "x"),
            (2, None, "user\nline\\n<|", "last"), (None, 1, "assistant", ""), (3, 1, "assistant", "z" * 2_000_000)]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns(spark, rows))).collect()}
    assert got[1]["turns_sha256"] == digest([("user", ""), ("assistant", nasty), ("assistant", nasty)])
    assert got[1]["loss_sha256"] == hashlib.sha256((nasty * 2).encode()).hexdigest()
    assert got[1]["loss_chars"] == 2 * len(nasty) and got[1]["n_turns"] == 3
    assert got[2]["turns_sha256"] == digest([("", "x"), ("user\nline\\n<|", "last")])
    assert got[None]["n_turns"] == 1 and got[3]["loss_chars"] == 2_000_000
    assert chat.format_conversations(turns(spark, [])).collect() == []


def test_long_conversation_comes_in_parts(spark, monkeypatch):
    rows = [(7, i, ("user", "assistant")[i % 2], f"text {i} " * 200) for i in range(300)]
    frame = turns(spark, rows)
    import tessera.llm.chat as module
    monkeypatch.setattr(module, "PART_BYTES", 20_000)
    assert len(list(module._parts(__import__("pyarrow").record_batch({"text": [r[3] for r in rows]})))) > 10
    parts = chat.format_conversations(frame)
    got = chat.read_back(parts).collect()
    assert len(got) == 1 and got[0]["turns_sha256"] == digest([(r[2], r[3]) for r in rows])


def test_plain_chunks_split_in_one_go_are_the_vocabularys_ids(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm import packing
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    chunks = ["It's", "IT'S", "a's'b", "x1y22z", "Straße", "ÀÉßÿ×÷", "...", "'", "''s", "don't!", "~a~", "ab" * 500]
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    monkeypatch.setattr(packing, "PLAIN_CHUNKS", 3)
    tokenizer = packing.ChunkTokenizer(path)
    for _ in range(2):
        got = tokenizer.ids([" ".join(chunks).encode(), b"", chunks[0].encode()])
        assert [np.frombuffer(r, "<u4").tolist() for r in got] == [
            [i for c in chunks for i in whole.encode(c, add_special_tokens=False).ids] + [packing.END_ID],
            [packing.END_ID], whole.encode(chunks[0], add_special_tokens=False).ids + [packing.END_ID]]
        tokenizer.young.clear()
