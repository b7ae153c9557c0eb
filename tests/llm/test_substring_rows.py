"""Substring dedup: many equal rows, rows without an id, long texts and clashing columns, against brute force."""

import random

from churnspark.llm import substring_dedup

WORDS = 20


def brute(rows):
    """Kept words by (id, text): windows are judged on all rows, equal rows being one document's same places."""
    places, texts = {}, {}
    for d, t in rows:
        own = t.encode().split()
        texts[(d, t)] = own
        for i in range(len(own) - WORDS + 1):
            places.setdefault(tuple(own[i:i + WORDS]), []).append((d, i))
    out = {}
    for (d, t), own in texts.items():
        gone = set()
        for i in range(len(own) - WORDS + 1):
            if min(places[tuple(own[i:i + WORDS])]) < (d, i):
                gone.update(range(i, i + WORDS))
        out[(d, t)] = b" ".join(w for i, w in enumerate(own) if i not in gone).decode()
    return out


def test_many_equal_rows(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(draw.choice(words) for _ in range(300))
    passage = " ".join(long.split()[100:160])
    rows = [(5, long)] * 600 + [(7, f"x {passage} y"), (7, f"x {passage} y"), (9, "short text"), (2, f"a {passage[:len(passage) // 2]} b {passage} c")]
    docs = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, th string")
    got = substring_dedup.remove_substrings(docs).collect()
    want = brute(rows)
    assert sorted((r["doc_id"], r["n_words"], r["kept"]) for r in got) == sorted((d, len(t.split()), want[(d, t)]) for d, t in rows)


def test_null_ids_long_text_and_empty_table(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(None, long), (None, long), (None, None), (1, long + " end"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substring_dedup.remove_substrings(docs).collect()}
    assert got == {(None, 60_000): 60_000, (None, 0): 0, (1, 60_001): 0, (3, 0): 0}
    assert substring_dedup.remove_substrings(docs.limit(0)).count() == 0
