"""Secret scan: window entropy and base kinds against brute force, keys beside harmless words, edges."""

import math
import random
import re

from pyspark.sql import functions as F

from churnspark.llm import secret_scan

BASE = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+")


def stated(text):
    """The contract's base spans, read with its own patterns; failing matches are dropped, not tried again."""
    checks = (lambda m: len(m[1]) >= 12, lambda m: len(m[0]) >= 18, lambda m: len(m[0]) >= 16)
    return sorted((m.start(), k, m.end()) for k, p in enumerate(BASE) for m in re.finditer(p, text) if checks[k](m))


def found(spark, texts, **kw):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secret_scan.secret_spans(rows, **kw).collect()
    return [[tuple(s) for s in r["secrets"]] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_peak_entropy_by_brute_force(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice(a) for _ in range(n)) for a in ("ab", "abcdef0123", "aZ3kQ9xT1bV7-/", "x") for n in (20, 21, 40, 77)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["h"] for r in got.select("i", secret_scan.peak_entropy(F.col("t")).alias("h")).collect()}

    def bits(w):
        return -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))

    for i, t in enumerate(texts):
        assert abs(got[i] - max(bits(t[k:k + 20]) for k in range(len(t) - 19))) < 1e-9


def test_base_kinds_by_brute_force(spark):
    draw = random.Random(6)
    bits = ["token", "PassWord", "api_key", "APIKEY", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "x.y/z", "\n"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 25))) for _ in range(400)]
    for text, spans in zip(texts, found(spark, texts)):
        assert [(s[0], s[1], s[2]) for s in spans if s[1] < 3] == stated(text), text


def test_keys_beside_harmless_words(spark):
    key = "aZ3kQ9xT1bV7nM5pL2wR8sY4"
    texts = [f"/example/{key}", "qWeRtZuIoPlKjHgFdSaYxCvB", f"12345678-{key}", "src/main/java/org/example/UserAccountFactory",
             "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "donaudampfschifffahrtsgesellschaft",
             "123e4567-e89b-12d3-a456-426614174000", "getUserAccountByIdentifier_v2", "-" * 40, "1234 5678" * 9]
    got = [[s[4] for s in spans if s[3] == "entropy"] for spans in found(spark, texts)]
    assert got == [[texts[0]], [texts[1]], [texts[2]]] + [[]] * 8


def test_edges(spark):
    rows = [(1, "token = aZ3kQ9xT1bV7", "x"), (1, "token = aZ3kQ9xT1bV7", "x"), (None, None, None), (2, "", "y"), (3, "word/" * 40_000 + "é", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string")
    got = secret_scan.secret_spans(docs).collect()
    assert [r["doc_id"] for r in got] == [1, 1, None, 2, 3]
    assert [[s["kind"] for s in r["secrets"]] for r in got] == [["assign"], ["assign"], [], [], []]
    assert secret_scan.secret_spans(docs.limit(0)).count() == 0
