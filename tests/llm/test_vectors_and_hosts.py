"""Hard negatives, host reputation and centroid clustering: odd rows, bounds and plain restatements."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tessera.llm")

from tessera.llm import drift, hardneg, hosts, vectors  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, label int, tile int, `a.b` string"


def frame(spark, rows):
    """Vectors with further columns whose names clash or hold a dot."""
    return spark.createDataFrame([(*r, 0, "x") for r in rows], VECTORS)


# --- hard negatives

def brute_negatives(rows, positives=5, negatives=3):
    v = [(i, lab, [math.floor(256 * x) for x in e]) for i, e, lab in rows]
    out = []
    for q, label, a in sorted(v):
        if q % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i, lab == label) for i, lab, b in v if i != q)
        for s, i, _ in [r for r in scored if r[2]][:positives]:
            inside = [r for r in scored if not r[2] and 50 * -s <= 100 * -r[0] <= 95 * -s]
            out += [(q, i, n + 1, c, -s, -t) for n, (t, c, _) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(df):
    got = hardneg.mine(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_negatives_with_ties_hot_label_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "TILE_ROWS", 64)
    monkeypatch.setattr(hardneg, "ANCHOR_ROWS", 4)
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)], 0 if i % 3 else r.randrange(1, 5)) for i in range(500)]
    rows += [(500 + i, [0.25, 0.5, 0.25, 0.5, 0.0, 1.0], i % 2) for i in range(200)]  # one very common vector
    odd = [(2001, None, 1), (2002, [1.0] * 6, None), (2003, [None] * 6, 1), (2004, [float("nan")] * 6, 1),
           (None, [1.0] * 6, 1), (2050, [float("inf")] * 6, 0)]
    assert mined(frame(spark, rows + odd)) == brute_negatives(rows)
    assert mined(frame(spark, odd)) == [] and mined(frame(spark, [])) == []


def test_negatives_of_short_vectors_and_repeated_ids(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.75], 2), (3, [], 2), (0, [1.0, 1.0], 1)]
    # the repeated anchor is asked once and its own rows are no candidates
    assert mined(frame(spark, rows)) == []
    rows += [(4, [0.5, 1.0], 3), (4, [0.5, 1.0], 3)]  # a repeated candidate counts twice
    assert [x[3] for x in mined(frame(spark, rows))] == [4, 4]


@pytest.mark.parametrize("dim, most", [(64, 256), (300, 5_000), (3, 2 ** 31 - 1), (64, 2 ** 40)])
def test_residue_products_are_exact(dim, most):
    rng = np.random.default_rng(dim)
    a = rng.integers(-most, most + 1, (17, dim))
    b = np.vstack([rng.integers(-most, most + 1, (29, dim)), np.full((1, dim), most), np.full((1, dim), -most)])
    want = a.astype(object) @ b.astype(object).T
    want = np.clip(want, -(1 << 63), (1 << 63) - 1).astype(np.int64)
    assert (hardneg.scores(a, b) == want).all()
    for p in hardneg.Residues.for_scores(dim, dim * most * most).primes:
        assert min(dim, hardneg.AXES) * (p // 2) ** 2 < hardneg.EXACT


# --- host reputation

def judged(spark, urls, **options):
    df = spark.createDataFrame([(i, u, 1, "q") for i, u in enumerate(urls)],
                               "page_id long, url string, host int, `x.y` string")
    return [r.asDict() for r in hosts.judge(df, **options).orderBy("page_id").collect()]


def test_hosts_paths_and_rules_of_odd_urls(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "example.org/es/": ("", "", None),
        "http://EXAMPLE.org/es/x": ("example.org", "/es/x", "example.org/es/"),
        "http://a.example.org/en/12?x#y": ("a.example.org", "/en/12", "example.org/en/1"),
        "http://a.example.org/en/2": ("a.example.org", "/en/2", "org/"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/"),
        "http://example.org": ("example.org", "", None), "http://example.org?/es/": ("example.org", "", None),
        "http://x.com/de/#a": ("x.com", "/de/", "com/de/"), "http://x.com/fr": ("x.com", "/fr", None),
        "http://com/fr/a": ("com", "/fr/a", "com/fr/"), "a://b://c/d": ("b:", "//c/d", None),
        "://x.com/fr/\nÉ": ("x.com", "/fr/\nÉ", "com/fr/"), "http://É.COM/DE/": ("É.com", "/DE/", None),
    }
    got = judged(spark, list(cases))
    assert [(r["host"], r["path"], r["rule"]) for r in got] == list(cases.values())
    for r in got:
        if r["rule"]:
            assert r["verdict"] == ("block" if r["rule"] in ("com/de/", "example.org/es/", "example.org/en/1") else "allow")
    assert judged(spark, []) == []


def test_reputation_shrinks_through_the_levels(spark):
    good, bad = "http://{}/fr/1", "http://{}/de/1"
    urls = [bad.format("spam.bad.com")] * 200 + [good.format("ok.good.com")] * 200
    urls += [bad.format(f"h{i}.bad.com") for i in range(30) for _ in range(9)] + [good.format(f"h{i}.bad.com") for i in range(30)]
    urls += [good.format(f"h{i}.good.com") for i in range(30) for _ in range(9)] + [bad.format(f"h{i}.good.com") for i in range(30)]
    ask = ["http://spam.bad.com/es/", "http://ok.good.com/es/", "http://new.bad.com/es/", "http://new.good.com/es/",
           "http://h1.bad.com/es/", "http://other.net/x"]
    got = {r["host"]: r for r in judged(spark, urls + ask) if r["path"] in ("/es/", "/x")}
    assert [got[h]["verdict"] for h in ("spam.bad.com", "new.bad.com", "h1.bad.com")] == ["block"] * 3
    assert [got[h]["verdict"] for h in ("ok.good.com", "new.good.com", "other.net")] == ["allow"] * 3
    assert max(got["new.bad.com"]["bound"], got["h1.bad.com"]["bound"]) < got["spam.bad.com"]["bound"]
    assert got["new.good.com"]["bound"] < 0.5 < got["new.bad.com"]["bound"]
    assert got["spam.bad.com"]["host_outcomes"] == got["spam.bad.com"]["host_blocked"] == 200
    # without outcomes nothing is blocked; with outcomes of the caller's own the rules still decide first
    assert {r["verdict"] for r in judged(spark, ["http://a.net/1", None])} == {"allow"}
    own = spark.createDataFrame([("a.net", 1)] * 50 + [("b.net", 0)] * 50 + [("c.net", None)], "host string, blocked int")
    got = judged(spark, ["http://a.net/1", "http://b.net/1", "http://c.net/", "http://x.org/1"], outcomes=own)
    assert [r["verdict"] for r in got] == ["block", "allow", "allow", "allow"]


def test_registered_domains(spark):
    cases = {"a.b.co.uk": ("b.co.uk", "co.uk"), "x.y.example.com": ("example.com", "com"), "com": ("com", "com"),
             "user@h.example.net:8080": ("example.net", "net"), "10.0.0.1:80": ("10.0.0.1", ""),
             "h.example.net.": ("example.net", "net"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    domain, suffix = hosts.registered(F.col("host"))
    assert {r[0]: (r[1], r[2]) for r in df.select("host", domain, suffix).collect()} == cases


# --- centroid clustering

def brute_clusters(rows, k=16, rounds=3, dim=64):
    v = [(i, tuple(math.floor(64 * x) for x in e)) for i, e in rows]
    first = sorted(v, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(r[1]) for r in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, x in v:
            groups[nearest(x)[1]].append(x)
        for j, members in groups.items():
            c[j] = [sum(col) // len(members) for col in zip(*members)]
    found = [(i, *nearest(x)[::-1]) for i, x in v]
    inertia = collections.Counter()
    for _, j, d in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    most = 2 ** 63 - 1  # what 64 bits don't hold is given as the largest long
    return sorted(((i, j, min(d, most), min(inertia[j], most), min(sum(inertia.values()), most), digest[j])
                   for i, j, d in found), key=str)


def clustered(df, **options):
    return sorted((tuple(r) for r in drift.cluster(df, **options).collect()), key=str)


def test_clusters_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(drift, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(9, 64))
    rows = [(i, (middle[i % 9] + 0.4 * rng.normal(size=64)).tolist()) for i in range(700)]
    rows += [(1000 + i, middle[0].tolist()) for i in range(300)]  # one very common vector
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, rows[6][1])]
    odd = [(2001, None), (2002, [None] * 64), (2003, [float("nan")] * 64), (2004, [1.0] * 63), (2005, []),
           (2006, [float("-inf")] * 64)]
    assert clustered(frame(spark, [(*r, 0) for r in rows + odd])) == brute_clusters(rows)
    few = rows[:5]
    assert clustered(frame(spark, [(*r, 0) for r in few])) == brute_clusters(few)
    assert clustered(frame(spark, [(*r, 0) for r in odd])) == []
    same = [(i, [1.0] * 64) for i in range(40)]  # equal centroids: all go to number 0
    got = clustered(frame(spark, [(*r, 0) for r in same]))
    assert got == brute_clusters(same) and {r[1] for r in got} == {0}


def test_clusters_of_large_components(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=64) * 10.0 ** (i % 8)).tolist()) for i in range(200)]
    assert clustered(frame(spark, [(*r, 0) for r in rows])) == brute_clusters(rows)


def test_planar_drift_bounds_every_point_of_the_sphere():
    rng = np.random.default_rng(1)
    gained = 0
    for case in range(400):
        dim = int(rng.integers(2, 6))
        centre = rng.normal(size=dim) * rng.choice([0.1, 1, 10])
        old = rng.normal(size=(1, dim)) * rng.choice([0.1, 1, 10])
        new = old + rng.normal(size=(1, dim)) * rng.choice([0.01, 0.3, 3])
        radius = float(rng.choice([0, 0.05, 0.5, 2]))
        bound = drift.planar_drift(centre, radius, old, new)[0]
        to = rng.normal(size=(2000, dim))
        points = centre + radius * to / np.linalg.norm(to, axis=1)[:, None] * rng.choice([1, 1, 0.5], (2000, 1))
        nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        full = np.linalg.norm(new - old)
        assert nearer.max() <= bound + 1e-9 and bound <= full * (1 + 1e-6)
        gained += bound < 0.9 * full
    assert gained > 150


def test_bounds_spare_most_vectors_a_full_scan():
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(8, 16)) * 400
    x = np.floor(middle[rng.integers(0, 8, 4_000)] + 40 * rng.normal(size=(4_000, 16))).astype(np.int64)
    c = np.floor(middle + 60 * rng.normal(size=middle.shape)).astype(np.int64)
    own, upper, lower, scanned = drift.assign(x, c, None, None)
    assert scanned == len(x)
    for _ in range(2):
        radius = np.array([upper[own == j].max(initial=-1) for j in range(8)])
        new = np.array([x[own == j].sum(axis=0) // max(1, (own == j).sum()) for j in range(8)])
        own, upper, lower, scanned = drift.assign(x, new, (own, upper, lower), drift.loosening(c, new, radius))
        c = new
        d = vectors_distance = drift.squared(x, c)
        assert (own == d.argmin(axis=1)).all() and scanned < len(x) // 10
        assert (upper >= np.sqrt(vectors_distance.min(axis=1)) - 1e-6).all()
        assert (lower <= np.sqrt(np.sort(d, axis=1)[:, 1]) + 1e-6).all()


def test_whole_number_bytes():
    for most in (5, 1 << 20, 1 << 40):
        m = np.array([[-most, most], [0, 1]])
        assert (vectors.from_bytes(vectors.to_bytes(m), 2, 2) == m).all()
    assert vectors.from_bytes(b"", 0, 2).shape == (0, 2) and vectors.largest(np.array([-(1 << 63)])) == 1 << 63
