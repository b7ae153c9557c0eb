"""Quartile digests, drift-tightened k-means and the source divergence audit against brute force and at their edges."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnspark.llm import divergence_audit, drift_kmeans, quartile_digest
from tests.llm.test_llm import SCHEMA, low, texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(3 * i, t, ["en", "fr", None][i % 3], f"s{i % 4}", len(t or ""), "q", "1") for i, t in enumerate(texts())]
    rows += [rows[3], (None, rows[5][1], "en", None, 1, None, None), (None, None, None, None, None, None, None),
             (7, "é" * 300 + " Ünïcode wörds", "fr", "only", 0, None, None), (-4, "½ 123 _", "xx", "digits", 0, None, None),
             (10 ** 12, "long " * 60_000 + "end", "en", "s1", 0, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


# ------------------------------------------------- quartile digest --
def plain_digest(text):
    b = (text or "").encode()
    counts = [0] * 256
    for i in range(len(b)):
        for kind, (j, k) in enumerate([(1, 2), (1, 3), (2, 3)]):
            if i + k < len(b):
                h = (b[i] * 2654435761 + b[i + j] * 2246822519 + b[i + k] * 3266489917 + kind * 668265263) % 2 ** 32
                counts[h >> 24] += 1
    s = sorted(counts)
    q = s[63], s[127], s[191]
    n = len(b).bit_length()
    length = 8 * n + int(bin(len(b))[3:6].ljust(3, "0"), 2) if b else 0
    ratios = [min(15, 16 * x // max(1, q[2])) for x in q[:2]]
    return [length, *ratios, *[sum(c > x for x in q) for c in counts]]


def plain_text(d):
    return f"{d[0]:02x}{d[1]:x}{d[2]:x}" + "".join(f"{4 * a + b:x}" for a, b in zip(d[3::2], d[4::2]))


def plain_likeness(a, b):
    steps = [abs(x - y) for x, y in zip(a, b)]
    return 1 - min(512, 4 * (min(16, steps[0]) + steps[1] + steps[2]) + sum((0, 1, 2, 6)[x] for x in steps[3:])) / 512


def plain_audit(rows):
    first = {}
    for i, t in rows:
        first[i] = min(first.get(i, t or ""), t or "")
    ids = sorted(first, key=lambda i: (i is not None, i or 0))
    after = dict(zip(ids, ids[1:] + ids[:1]))
    cache = {}

    def digest(t):
        return cache.setdefault(t, plain_digest(t)) if t not in cache else cache[t]
    out = []
    for i, t in rows:
        t, nxt = t or "", first[after[i]]
        k = len(t) // 4
        new = t[:len(t) - k] + nxt[:k]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), plain_text(digest(t)), plain_text(digest(new)),
                    plain_likeness(digest(t), digest(new)), plain_likeness(digest(t), digest(nxt))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_edit_audit(docs, ranges):
    got = quartile_digest.edit_audit(docs, ranges=ranges).collect()
    assert sorted(map(tuple, got), key=repr) == plain_audit([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edit_audit_small_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quartile_digest.edit_audit(empty).collect() == []
    for rows in ([(5, "only one document here")], [(None, "a b c d"), (None, "a b c d")], [(5, "twice"), (5, "twice"), (5, "else")],
                 [(1, None), (2, "")]):
        got = quartile_digest.edit_audit(spark.createDataFrame(rows, "doc_id long, text string"), ranges=3).collect()
        assert sorted(map(tuple, got), key=repr) == plain_audit(rows)


def test_fingerprints_and_likeness(spark):
    rng = random.Random(3)
    base = " ".join("".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 8))) for _ in range(300))
    rows = [(1, base, "x"), (2, base, "x"), (3, base[:-20] + "something different.", "x"), (4, "Quite another text. " * 40, "x"), (5, None, None)]
    df = quartile_digest.fingerprints(spark.createDataFrame(rows, "id long, text string, fingerprint string"))
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["fingerprint"] == "x" and got[1]["fingerprint_"] == got[2]["fingerprint_"] == plain_text(plain_digest(base))
    pairs = df.alias("a").crossJoin(df.alias("b")).selectExpr("a.id x", "b.id y", "a.fingerprint_ f", "b.fingerprint_ g")
    like = {(r["x"], r["y"]): r["v"] for r in pairs.withColumn("v", quartile_digest.likeness(pairs["f"], pairs["g"])).collect()}
    assert like[1, 2] == 1.0 and like[1, 3] > 0.8 > 0.5 > like[1, 4] >= 0.0 and like[1, 3] == like[3, 1]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_digest_of_any_texts(some):
    got = quartile_digest.digests(pa.array(some, pa.string()))
    assert got.tolist() == [plain_digest(t) for t in some]
    assert quartile_digest.from_text(quartile_digest.to_text(got)).tolist() == got.tolist()


def test_digest_in_slices(monkeypatch):
    some = ["abcdefg" * 50, "", "xy", "é" * 77, "tail"]
    whole = quartile_digest.digests(pa.array(some))
    monkeypatch.setattr(quartile_digest, "CHUNK", 16)
    assert (quartile_digest.digests(pa.array(some)) == whole).all()


# ------------------------------------------------------- k-means --
def plain_kmeans(rows, k, rounds, dim, scale=64, seed=1):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cents)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, c in out:
        per[c] += d
    return sorted(((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
                   for i, d, c in out), key=repr)


def vectors(n, dim, seed, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = [(i, (centres[i % 6] + spread * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]
    return out


ODD = [(900, None), (901, []), (902, [float("nan")] * 8), (903, [None] + [0.0] * 7), (904, [float("inf")] * 8), (905, [1.0] * 7),
       (None, [0.5] * 8), (None, [0.5] * 8)]


def clustered(spark, rows, **how):
    df = spark.createDataFrame([(v, i, "x", 3) for i, v in rows], "embedding array<float>, vec_id long, label string, cluster int")
    return drift_kmeans.cluster(df.repartition(3), **how)


def told(done):
    return sorted((tuple(r[c] for c in ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
                   for r in drift_kmeans.report(done).collect()), key=repr)


@pytest.mark.parametrize("spread,seed", [(0.15, 1), (1.5, 2)])
def test_kmeans(spark, spread, seed):
    rows = vectors(160, 8, seed, spread)
    rows += [(500 + i, rows[0][1]) for i in range(60)] + [rows[1], rows[1]] + ODD
    assert told(clustered(spark, rows, dim=8, k=5)) == plain_kmeans(rows, 5, 3, 8)


def test_kmeans_edges(spark):
    assert clustered(spark, [(1, None)], dim=8) is None
    few = vectors(3, 8, 5) + [(7, [0.5] * 8)]
    assert told(clustered(spark, few, dim=8, k=16)) == plain_kmeans(few, 16, 3, 8)
    same = [(i, [0.25] * 8) for i in range(9)]  # equal centroids: all go to number 0
    assert told(clustered(spark, same, dim=8, k=4)) == plain_kmeans(same, 4, 3, 8)
    with pytest.raises(Exception, match="beyond"):
        clustered(spark, [(1, [1e9] * 8)], dim=8)


def test_kmeans_spares_full_comparisons(spark):
    rows = vectors(600, 8, 3, 0.1)
    scans = [r["scans"] for r in clustered(spark, rows, dim=8, k=5, rounds=6).assigned.collect()]
    assert min(scans) == 1 and sum(scans) < 0.6 * 7 * len(rows)


@settings(deadline=None, max_examples=200)
@given(st.integers(0, 2 ** 32 - 1), st.floats(0.0, 3.0), st.integers(2, 6))
def test_loosening_bounds_every_point_of_the_sphere(seed, radius, dim):
    rng = np.random.default_rng(seed)
    c, a, b = rng.normal(size=(3, dim)) * rng.choice([0.3, 1.0, 3.0], size=(3, 1))
    bound = drift_kmeans.loosening(c, radius, a, b)
    drift = np.linalg.norm(b - a)
    assert bound <= drift + 1e-12
    points = rng.normal(size=(400, dim))
    points = c + radius * rng.random((400, 1)) ** 0.2 * points / np.linalg.norm(points, axis=1, keepdims=True)
    nearer = np.linalg.norm(points - a, axis=1) - np.linalg.norm(points - b, axis=1)
    assert nearer.max() <= bound + 1e-7


def test_loosening_is_less_than_the_drift_off_the_axis():
    a, b, c = np.array([0.0, 10.0]), np.array([2.0, 10.0]), np.array([0.0, 0.0])
    assert 0 < drift_kmeans.loosening(c, 1.0, a, b) < 0.2     # sideways move seen from a far sphere
    assert drift_kmeans.loosening(c, 1.0, a, np.array([0.0, 12.0])) == 0.0  # away from it
    assert drift_kmeans.loosening(c, 1.0, a, np.array([0.0, 8.0])) == pytest.approx(2.0)


def test_squared_distances_of_large_components():
    x = np.array([[2 ** 26, -2 ** 26], [3, 4]], np.int64)
    c = np.array([[-2 ** 26, 2 ** 26], [0, 0]], np.int64)
    assert drift_kmeans.squared_distances(x, c).tolist() == [[2 ** 55, 2 ** 53], [(2 ** 26 + 3) ** 2 + (2 ** 26 - 4) ** 2, 25]]


# ---------------------------------------------------------- audit --
def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))


def plain_divergence(rows, least=3, top=200):
    df, cnt, lang_cnt, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", plain_terms(text or "")
        groups.add((lang, source))
        df[lang].update(set(terms))
        cnt[lang, source].update(terms)
        lang_cnt[lang].update(terms)
    out, shares = [], {}
    for lang, source in groups | {(g, None) for g, _ in groups}:
        kept = sorted(t for t, d in df[lang].items() if d >= least)
        have = lang_cnt[lang] if source is None else cnt[lang, source]
        total = sum(have[t] for t in kept)
        shares[lang, source] = {t: 1 + 10 ** 9 * (have[t] + 1) // (total + len(kept)) for t in kept}
    for lang, source in groups:
        mine, whole = shares[lang, source], shares[lang, None]
        pairs = [(-sum((p - q[t]) ** 2 // q[t] for t, p in mine.items()), s.encode())
                 for g, s in groups if g == lang and s != source for q in [shares[g, s]]]
        terms = [(-((p - whole[t]) ** 2 // whole[t]), t.encode()) for t, p in mine.items() if cnt[lang, source][t] and p > whole[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(found, 1)]
    return sorted(out)


def test_source_divergence(docs):
    got = divergence_audit.source_divergence(docs).collect()
    assert sorted(map(tuple, got)) == plain_divergence([(r["lang"], r["source"], r["text"]) for r in docs.collect()])


def test_source_divergence_top_and_least(docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.collect()]
    got = divergence_audit.source_divergence(docs, least=6, top=4).collect()
    assert sorted(map(tuple, got)) == plain_divergence(rows, 6, 4)


def test_source_divergence_edges(spark):
    schema = "lang string, source string, text string, item string, term string, p long"
    assert divergence_audit.source_divergence(spark.createDataFrame([], schema)).collect() == []
    rows = [("en", "a", None, "x", "y", 1), ("en", "b", "", "x", "y", 1), (None, None, "word", None, None, None), ("fr", "a", "one two", "", "", 1)]
    got = divergence_audit.source_divergence(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got)) == plain_divergence([r[:3] for r in rows])


def test_source_divergence_hot_source(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 20))) for _ in range(120)]
    rows = [("en", "hot" if i % 3 else f"s{i % 30}", " ".join(rng.choices(words, weights=range(1, 121), k=40))) for i in range(400)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert sorted(map(tuple, divergence_audit.source_divergence(df).collect())) == plain_divergence(rows)


TERMS = st.lists(st.text(alphabet="abé", min_size=1, max_size=20), max_size=40)


@settings(deadline=None, max_examples=80)
@given(TERMS)
def test_sort_pointers(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends = divergence_audit.term_pointers(data, np.array([0]))
    order, new = divergence_audit.sort_pointers(data, starts, ends)
    got = [bytes(data[starts[i]:ends[i]]).decode() for i in order]
    assert got == sorted(words, key=str.encode)
    assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]
    same = [(a, b) for a, b, n in zip(order, order[1:], new[1:]) if not n]
    assert all(a < b for a, b in same)


def test_terms_do_not_cross_texts():
    terms, group, n, d = divergence_audit.count_shard(np.array([1, 0, 1, 1]), pa.array(["Ab cd", "ab", "", "AB cd cd"], pa.large_string()))
    assert sorted(zip(terms.to_pylist(), group.tolist(), n.tolist(), d.tolist())) == [("ab", 0, 1, 1), ("ab", 1, 2, 2), ("cd", 1, 3, 2)]


def test_a_text_longer_than_a_shard(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("aBé") for _ in range(rng.randint(1, 60))) for _ in range(300))
    for shard in (7, 64, 1000):
        monkeypatch.setattr(divergence_audit, "SHARD", shard)
        terms, n = divergence_audit.count_long(text)
        assert dict(zip(terms.to_pylist(), n.tolist())) == Counter(plain_terms(text))
