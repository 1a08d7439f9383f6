"""Each operator over whole small tables against a plain restatement of its contract."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from tests.conftest import SF_CHECK, SF_SMALL

pytest.importorskip("tessera.llm")

from tessera.llm import queries  # noqa: E402
from tessera.llm.queries import QUERIES, VOCABULARY  # noqa: E402


def table(name, sf=SF_CHECK):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def result(spark, name, sf=SF_CHECK):
    return [r.asDict() for r in QUERIES[name](spark, sf).collect()]


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    want = sorted(map(repr, want.fetchall()))
    got = sorted(repr(tuple(r[c] for c in columns)) for r in result(spark, name))
    assert got == want


def test_mixing_holds_its_targets(spark):
    docs = {d["doc_id"]: d for d in table("documents")}
    rows = result(spark, "op2_mixing")
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    size = {i: len(words_of(d["text"])) for i, d in docs.items()}
    by_source = collections.Counter()
    for i, d in docs.items():
        by_source[d["source"]] += size[i]
    order = sorted(by_source, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    full, total = set(), 1.5 * sum(by_source.values())
    while True:  # share, stop the sources over twice their size, share the excess
        rest = (total - 2 * sum(by_source[s] for s in full)) / max(1, sum(weight[s] for s in order if s not in full))
        over = {s for s in order if s not in full and rest * weight[s] > 2 * by_source[s]}
        if not over:
            break
        full |= over
    taken = collections.Counter()
    for r in rows:
        s = docs[r["doc_id"]]["source"]
        want = 2 * by_source[s] if s in full else rest * weight[s]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[s]
        assert r["target"] == pytest.approx(want, rel=1e-9)
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in order:
        want = 2 * by_source[s] if s in full else rest * weight[s]
        largest = max(size[i] for i, d in docs.items() if d["source"] == s)
        assert abs(taken[s] - want) <= largest / 2 + 1
    again = result(spark, "op2_mixing")
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_mixing_copies_have_their_expectation(spark):
    """A document's expected copies are target / source_size, whatever its size: the mean over the documents
    of a source and size class, over six seeds, is within five standard errors (independent draws would have them)."""
    from tessera.llm import mixing
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    total = {}
    for seed in range(6):
        rows = [r for r in mixing.mix(docs, seed=seed).collect() if r["size"]]
        for r in rows:
            rate = r["target"] / r["source_size"]
            p = rate - math.floor(rate + 1e-9)
            key = (r["source"], int(math.log2(r["size"])))
            n, off, var = total.get(key, (0, 0.0, 0.0))
            total[key] = (n + 1, off + r["copies"] - rate, var + p * (1 - p))
            assert math.floor(rate + 1e-9) <= r["copies"] <= math.ceil(rate - 1e-9)
    large = {k: v for k, v in total.items() if v[0] >= 100}
    assert large
    for key, (n, off, var) in large.items():
        assert abs(off) <= 5 * math.sqrt(var) + 1e-6, (key, n, off, var)


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = {}
    for d in table("documents"):
        ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want[d["doc_id"], p] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = result(spark, "op4_packing")
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.02 * -(-sum(v[1] for v in want.values()) // 4096) + 1


def test_simhash_components(spark):
    docs = table("documents")
    fps = {}
    for d in docs:
        words = (d["text"] or "").encode().lower().split()
        grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        count = [0] * 64
        for g in grams:
            h = xxhash.xxh64_intdigest(g, 42)
            for b in range(64):
                count[b] += h >> b & 1
        fps[d["doc_id"]] = sum(1 << b for b in range(64) if 2 * count[b] > len(grams))
    ids = sorted(fps)
    values = np.array([fps[i] for i in ids], dtype=np.uint64)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        a, b = find(ids[i]), find(ids[j])
        root[max(a, b)] = min(a, b)
    want = {i: (f"{fps[i]:016x}", find(i)) for i in ids}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op6_simhash")}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_quality_counts_and_verdicts(spark):
    rows = {r["doc_id"]: r for r in result(spark, "op7_quality")}
    labels = {r["doc_id"]: r["quality"] for r in table("labels")}
    docs = table("documents")
    assert len(rows) == len(docs)
    for d in docs:
        text, r = d["text"] or "", rows[d["doc_id"]]
        words = words_of(text)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        covered = set()
        for i in range(len(words) - 2):
            if windows[tuple(words[i:i + 3])] >= 2:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in text.split("\n") if words_of(x)]
        want = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
                len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    judged = [(labels[i], r["kept"]) for i, r in rows.items() if i in labels and not r["base_failed"]]
    assert np.mean([bool(q) == k for q, k in judged]) > 0.95


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in table("labels", sf)}
    rows = [r for r in result(spark, "op8_toxicity", sf)]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for t, p in held if t == 1]
    clean = [p for t, p in held if t == 0]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.03


def test_language_on_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in table("documents")}
    rows = result(spark, "op9_langid")
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    assert np.mean([langs[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.95


def test_html_main_text(spark):
    import html
    import re

    pages = {p["page_id"]: p for p in table("pages")}
    rows = result(spark, "op5_html")
    assert len(rows) == len(pages)
    right = 0
    for r in rows:
        page = pages[r["page_id"]]["html"] or ""
        article = page[page.find("<article>") + 9:page.find("</article>")] if "<article>" in page else ""
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split())
                 for x in re.split(r"</?(?:h1|p)>", article)]
        right += r["text"] == "\n".join(x for x in parts if x)
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]
    assert right >= 0.97 * len(rows)


def test_chat_digests(spark):
    turns = collections.defaultdict(list)
    for r in table("conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    turns[-7] = [(0, "user", queries.TEMPLATE_PROBE), (1, "assistant", queries.TEMPLATE_PROBE)]
    rows = {r["conv_id"]: r for r in result(spark, "op10_chat")}
    assert rows.keys() == turns.keys()
    for conv, lines in turns.items():
        lines.sort()
        loss = "".join(t for _, role, t in lines if role == "assistant")
        r = rows[conv]
        assert r["n_turns"] == len(lines) and r["loss_chars"] == len(loss)
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in lines).encode()).hexdigest()


def test_pipeline_against_its_operators(spark):
    """The pipeline's rows follow from the operators' own verdicts on each stage's input."""
    import corpus_pipeline

    from tessera.llm import quality, simhash, toxicity
    from tessera.sources.tables import load

    labels = load(spark, SF_SMALL, "labels")
    docs = load(spark, SF_SMALL, "documents")
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    kept = docs.where(~docs["doc_id"].isin(list(bad) or [-1]))
    good = {r["doc_id"] for r in quality.judge(kept, labels).where("kept").collect()}
    kept = kept.where(kept["doc_id"].isin(list(good)))
    reps = {r["component"] for r in simhash.simhash_groups(kept).collect()}
    kept = kept.where(kept["doc_id"].isin(list(reps)))
    from tessera.llm import mixing
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept).collect()}
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    got = collections.Counter(r["doc_id"] for r in rows if r["piece"] == 0)
    assert got == {i: n for i, n in copies.items() if n}
    # every piece of every copy, recomputed with the tokenizer alone
    from tokenizers import Tokenizer

    tokenizer, want = Tokenizer.from_file(VOCABULARY), collections.Counter()
    for d in table("documents", SF_SMALL):
        if copies.get(d["doc_id"]):
            ids = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
            for p, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at:at + 4096]
                want[d["doc_id"], p, at, len(part), zlib.crc32(part.tobytes())] = copies[d["doc_id"]]
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_copies", "mixing", "packing"]
