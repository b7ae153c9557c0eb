"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

Words are runs of letters, digits and non-ASCII characters of the A-Z-lowered
text. An item's windows are its 13-word stretches (an item with fewer words is
one window). A window is the set of its shingles: five words each, or the whole
window if it is shorter. A document contains the window if and only if all its
shingles stand in the document at consecutive places.

1. One pass over the documents joins every shingle with the benchmark's
   shingles, by hash and then by its words. The matches (document, place,
   shingle) are the only thing kept of the texts.
2. Shingles are ordered by rarity: by how often they were met. Exact containment
   needs all shingles, so the prefix of a window is its single rarest shingle; a
   window with a shingle that was never met is dropped at once.
3. Matches of prefix shingles propose places. Length and positional bounds drop
   windows that would begin before the document or end behind it.
4. The remaining places are verified: every other shingle must be met at its
   place, so all words of the window are compared.

Benchmark shingles are broadcast after their number was counted and found
below ``broadcast_rows``; beyond it the same join shuffles. Matches of a hot
passage are spread by document; joins on a hot shingle are split by adaptive
execution.

Edge cases: null and blank texts have no words (0 hits, not contaminated; an
item without words has no window). A null item id marks hits but is not listed.
Rows with the same id and text have the same result. Null ids are kept. An empty
benchmark marks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, cut_lineage, fresh, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE, BROADCAST_ROWS = 13, 5, 1_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _hash_at(ws: Column, place: Column, k: int) -> Column:
    """XXH64 of the k words from ``place`` (from 0)."""
    return F.xxhash64(*[F.element_at(ws, place + 1 + j) for j in range(k)])


def _hashes(ws: Column, k: int) -> Column:
    n = F.size(ws)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), lambda i: _hash_at(ws, i, k))).otherwise(
        F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """``(wid, body, k, size, parts)`` of the different windows, and ``(wid, item_id)``."""
    items = benchmark.select(col(id_col).alias("item_id"), words(col(text_col)).alias("ws")).filter(F.size("ws") > 0)
    items = items.withColumn("size", F.least(F.size("ws"), F.lit(window)))
    each = items.select("item_id", "ws", "size", F.explode(F.sequence(F.lit(0), F.size("ws") - F.col("size"))).alias("at"))
    each = each.select("item_id", "size", F.slice("ws", F.col("at") + 1, F.col("size")).alias("ws"))
    each = each.withColumn("body", F.array_join("ws", " "))
    k = F.least(F.col("size"), F.lit(shingle))
    unique = each.select("body", "ws", "size").dropDuplicates(["body"]).withColumn("k", k)
    unique = cut_lineage(unique.select("body", "ws", "size", "k", F.monotonically_increasing_id().alias("wid")))
    owners = each.select("item_id", "body").distinct().join(unique.select("body", "wid"), "body").select("wid", "item_id")
    return unique, owners


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
                window: int, shingle: int, broadcast_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Carriers ``(doc_id, th, n_words)``, one for each row of ``docs``; found windows ``(doc_id, th, start, size, wid)``;
    owners ``(wid, item_id)``."""
    wins, owners = windows(benchmark, item_col, item_text_col, window, shingle)
    parts = wins.select("wid", "k", "size", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.col("size") - F.col("k")), lambda i: F.slice("ws", i + 1, F.col("k")))).alias("off", "part"))
    parts = parts.withColumn("sh", F.array_join("part", " "))
    lengths = sorted(r["k"] for r in wins.select("k").distinct().collect())  # at most ``shingle`` different values
    hashed = F.lit(None).cast("bigint")
    for k in lengths:
        hashed = F.when(F.col("k") == k, F.xxhash64(*[F.element_at("part", j + 1) for j in range(k)])).otherwise(hashed)
    shingles = parts.select("sh", "k", hashed.alias("h")).dropDuplicates(["sh"])
    shingles = cut_lineage(shingles.withColumn("sid", F.monotonically_increasing_id()))
    by_hash = shingles.groupBy("h").agg(F.collect_list(F.struct("sh", "sid", "k")).alias("like"))
    if shingles.count() <= broadcast_rows:
        by_hash = F.broadcast(by_hash)

    text = docs.select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("th"), words(col(text_col)).alias("ws"))
    text = text.withColumn("n_words", F.size("ws"))
    lists = [_hashes(F.col("ws"), k) for k in lengths] or [F.array().cast("array<bigint>")]
    placed = text.select("doc_id", "th", "n_words", "ws", F.posexplode_outer(F.concat(*lists)).alias("at", "h0"))
    k_of, at_of, before = F.lit(None).cast("int"), F.col("at"), F.lit(0)
    for k in lengths:  # the lists of all lengths stand one behind the other
        own = F.greatest(F.col("n_words") - k + 1, F.lit(0))
        inside = (F.col("at") >= before) & (F.col("at") < before + own)
        k_of, at_of = F.when(inside, F.lit(k)).otherwise(k_of), F.when(inside, F.col("at") - before).otherwise(at_of)
        before = before + own
    met = placed.join(by_hash, F.col("h0") == F.col("h"), "left").filter("h is not null or at is null or at = 0")
    met = met.withColumn("k", k_of).withColumn("p", at_of)
    same = F.filter("like", lambda x: (x["k"] == F.col("k")) & (x["sh"] == F.array_join(F.slice("ws", F.col("p") + 1, F.col("k")), " ")))
    met = cut_lineage(met.select("doc_id", "th", "n_words", "at", "p", "k", F.get(same, F.lit(0))["sid"].alias("sid")))
    carriers = met.filter("at is null or at = 0").select("doc_id", "th", "n_words")
    hits = cut_lineage(met.filter("sid is not null").select("doc_id", "th", "n_words", "p", "sid").distinct())

    often = hits.groupBy("sid").agg(F.count(F.lit(1)).alias("times"))
    order = parts.select("wid", "size", "off", "sh").join(shingles.select("sh", "sid"), "sh").join(often, "sid", "left")
    order = order.groupBy("wid", "size").agg(
        F.min(F.struct("times", "off", "sid")).alias("rarest"), F.count("times").alias("present"), F.count(F.lit(1)).alias("m"),
        F.collect_list(F.struct("off", "sid")).alias("all"))  # at most ``window`` shingles of one window
    prefix = order.filter("present = m").select("wid", "size", "m", "all", F.col("rarest.off").alias("shift"), F.col("rarest.sid").alias("sid"))
    proposed = hits.join(prefix, "sid").withColumn("start", F.col("p") - F.col("shift")).filter("start >= 0 and start + size <= n_words")
    proposed = proposed.select("doc_id", "th", "wid", "size", "m", "start", F.inline("all"))
    proposed = proposed.select("doc_id", "th", "wid", "size", "m", "start", (F.col("start") + F.col("off")).alias("p"), "sid")
    there = hits.select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), F.col("p").alias("p2"), F.col("sid").alias("s2"))
    verified = proposed.join(there, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2"))
                             & (F.col("p") == F.col("p2")) & (F.col("sid") == F.col("s2")))
    found = verified.groupBy("doc_id", "th", "wid", "size", "m", "start").agg(F.count(F.lit(1)).alias("n")).filter("n = m")
    return carriers, cut_lineage(found.select("doc_id", "th", "start", "size", "wid")), owners


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  percent: int = 5, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, th, n_words, n_hit, n_items, items, contaminated``; ``items`` are the
    sorted ids (as text) of the items with an occurring window, ``th`` is the text's XXH64."""
    carriers, found, owners = occurrences(docs, benchmark, id_col, text_col, item_col, item_text_col, window, shingle, broadcast_rows)

    def widen(acc: Column, x: Column) -> Column:
        end = x["start"] + x["size"]
        new = F.greatest(end - F.greatest(acc["end"], x["start"]), F.lit(0))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], end).alias("end"))

    places = found.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("at"))
    covered = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), widen, lambda a: a["n"])
    hit = places.select("doc_id", "th", covered.cast("long").alias("n_hit"))
    ids = found.select("doc_id", "th", "wid").distinct().join(owners, "wid").filter("item_id is not null")
    ids = ids.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    marks = hit.join(ids, hit["doc_id"].eqNullSafe(ids["doc_id"]) & (hit["th"] == ids["th"]), "left").select(
        hit["doc_id"].alias("d2"), hit["th"].alias("t2"), "n_hit", "items")
    full = carriers.join(marks, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")), "left")
    n_hit, n = F.coalesce("n_hit", F.lit(0)).cast("long"), F.col("n_words").cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return full.select("doc_id", "th", n.alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                       items.alias("items"), ((n_hit > 0) & (n_hit * 100 >= n * percent)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without its contaminated documents."""
    doc, th = fresh(docs, "bad_doc", "bad_th")
    bad = contamination(docs, benchmark, id_col, text_col, **options).filter("contaminated").select(
        F.col("doc_id").alias(doc), F.col("th").alias(th)).distinct()
    return docs.join(bad, col(id_col).eqNullSafe(col(doc)) & (F.xxhash64(col(text_col)) == col(th)), "left_anti")
