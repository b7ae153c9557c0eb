"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes are word positions; two suffixes that agree on ``min_words`` words are
a repeat. They are split into groups by a prefix that grows until it holds the
suffix's anchor: the ``gram``-word stretch with the smallest hash among those
inside its first ``min_words`` words. Equal windows have the same anchor at the
same distance, so every repeat lies in one group; neighbouring suffixes mostly
share their anchor and travel together as one stretch of text, about three
words of text for each suffix instead of twenty.

Texts that an earlier document has whole lose all windows at once and are left
out below.

1. Anchors are counted by hash. A stretch whose anchor occurs once repeats
   nothing and goes no further (only hashes and positions moved so far).
2. Texts meet their remaining stretches by document; the stretches' words go to
   their anchor's group.
3. A group of at most ``group_limit`` stretches is held by one task: equal
   stretches become one leaf set, and a suffix tree of the others (their sorted
   suffixes and the words that neighbours share, its interval form) gives the
   internal nodes of ``min_words`` words or more -- the maximal repeats. Below
   each, all suffixes but the earliest are repeats.
4. Larger groups get the longest prefix, the whole window: its first place comes
   from a partial aggregation, every later one from a join, so a passage in a
   third of all documents never meets in one task.
5. The repeats' places go back to the texts by document, and their words are
   removed. Both joins read one shuffle of the texts.

Places are ordered by document id, then start; null ids come last, rows that
share an id are told apart by their text's hash, and equal rows are one document
in copies: they are searched once. Null and blank texts have no words. Texts
shorter than a window lose nothing. An empty table gives an empty result. Long
texts are read whole, each by one task at a time. Only the id and the text are
read; other columns, whatever their names, do not come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, cut_lineage, fresh, small_batches, words_of, written

MIN_WORDS, GRAM, GROUP_LIMIT = 20, 6, 200_000
WHOLE = 1 << 40
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _leftmost_least(g: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` neighbours (by the upper 40 bits, the leftmost of equals)."""
    high = g >> np.uint64(24)
    if len(g) > 1 << 24:
        return np.arange(len(g) - width + 1) + np.lib.stride_tricks.sliding_window_view(high, width).argmin(axis=1)
    key = (high << np.uint64(24)) | np.arange(len(g), dtype=np.uint64)
    step = 1
    while 2 * step <= width:  # key[i] covers ``step`` places from i
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    rest = width - step
    key = np.minimum(key[:-rest], key[rest:]) if rest else key
    return (key & np.uint64((1 << 24) - 1)).astype(np.int64)


def stretches(words: list[bytes], min_words: int = MIN_WORDS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, first window, windows)`` of the runs of windows that share an anchor."""
    if len(words) < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    n = len(h) - gram + 1
    g = np.zeros(n, np.uint64)
    for j in range(gram):
        g = g * _STEP + h[j:j + n]
    g = _mixed(g)
    anchor = _leftmost_least(g, min_words - gram + 1)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    return g[anchor[first]].view(np.int64), first, np.diff(first, append=len(anchor))


def deep_nodes(bodies: list[list[bytes]], counts: list[int], min_words: int) -> Iterator[list[tuple[int, int]]]:
    """Leaves ``(body, offset)`` below each internal node of ``min_words`` words or more nearest the root.

    The suffixes ``bodies[b][i:]``, i < counts[b], are sorted; neighbours that share ``min_words`` words or more lie below
    one such node."""
    suffixes = sorted((words[i:i + min_words], b, i) for b, words in enumerate(bodies) for i in range(counts[b]))
    leaves: list[tuple[int, int]] = []
    last = None
    for prefix, b, i in suffixes:
        if prefix != last:
            if len(leaves) > 1:
                yield leaves
            leaves, last = [], prefix
        leaves.append((b, i))
    if len(leaves) > 1:
        yield leaves


def group_repeats(rows: list[tuple], min_words: int) -> Iterator[tuple]:
    """Repeats ``(doc_id, th, start, size)`` of one group of ``(place, size, body)``; place: (nameless, doc, th, start)."""
    earliest: dict[bytes, tuple] = {}
    for place, size, body in rows:
        known = earliest.get(body)
        if known is None or place < known[0]:
            earliest[body] = (place, size)
    for place, size, body in rows:
        if place > earliest[body][0]:
            yield place, size + min_words - 1
    if len(earliest) > 1:
        own = list(earliest.items())
        places, counts = [x[1][0] for x in own], [x[1][1] for x in own]
        for leaves in deep_nodes([body.split(b" ") for body, _ in own], counts, min_words):
            found = sorted((*places[b][:3], places[b][3] + i) for b, i in leaves)
            for place in found[1:]:
                if place > found[0]:
                    yield place, min_words


_PLACE = "nameless boolean, doc_id long, th long, start long"


def _anchored(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rows = [], []
            for i, text in enumerate(batch.column(2)):
                g, first, size = stretches(words_of(text.as_py()), min_words, gram)
                if len(g):
                    parts.append((g, first, size))
                    rows.append(np.full(len(g), i))
            if not rows:
                continue
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(np.concatenate(x)) for x in zip(*parts)]],
                names=["doc_id", "th", "g", "start", "size"])

    return docs.mapInArrow(found, "doc_id long, th long, g long, start long, size long")


def _cut_out(met: DataFrame, min_words: int) -> DataFrame:
    """The words of the stretches of every text."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            bounds, flat = lists.offsets.to_numpy(), lists.values
            starts, sizes = flat.field("start").to_numpy().tolist(), flat.field("size").to_numpy().tolist()
            body = []
            for text, a, b in zip(batch.column(2), bounds[:-1].tolist(), bounds[1:].tolist()):
                words = words_of(text.as_py())
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()  # one behind each word's end
                for first, size in zip(starts[a:b], sizes[a:b]):
                    body.append(joined[ends[first - 1] if first else 0:ends[first + size + min_words - 2] - 1])
            rows = pa.array(np.repeat(np.arange(len(batch)), np.diff(bounds)))
            at = pa.array(np.arange(bounds[0], bounds[-1]))
            yield pa.RecordBatch.from_arrays(
                [flat.field("g").take(at), flat.field("n").take(at), batch.column(0).take(rows), batch.column(1).take(rows),
                 flat.field("start").take(at), flat.field("size").take(at), pa.array(body, pa.binary())],
                names=["g", "n", "doc_id", "th", "start", "size", "body"])

    return met.mapInArrow(packed, "g long, n long, doc_id long, th long, start long, size long, body binary")


def _in_groups(cut: DataFrame, min_words: int) -> DataFrame:
    """Repeats inside the anchor groups, read as a stream sorted by anchor."""
    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([x[0][1] for x in out], pa.int64()), pa.array([x[0][2] for x in out], pa.int64()),
                 pa.array([x[0][3] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())],
                names=["doc_id", "th", "start", "size"])
            out.clear()
            return batch

        for batch in batches:
            for g, doc, th, start, size, body in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if g != now:
                    out.extend(group_repeats(rows, min_words))
                    now, rows = g, []
                rows.append(((doc is None, doc, th, start) if doc is not None else (True, None, th, start), size, body))
            if out:
                yield flush()
        out.extend(group_repeats(rows, min_words))
        if out:
            yield flush()

    ready = cut.select("g", "doc_id", "th", "start", "size", "body").repartition("g").sortWithinPartitions("g")
    return ready.mapInArrow(walked, "doc_id long, th long, start long, size long")


def _by_window(cut: DataFrame, min_words: int) -> DataFrame:
    """Repeats by whole windows, for groups too large for one task."""
    ws = F.split(F.col("body").cast("string"), " ")
    each = cut.select("doc_id", "th", "start", "size", ws.alias("ws")).select(
        "doc_id", "th", "start", "ws", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("i"))
    each = each.select("doc_id", "th", (F.col("start") + F.col("i")).alias("start"),
                       F.array_join(F.slice("ws", (F.col("i") + 1).cast("int"), min_words), " ").alias("window"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "th", "start")
    first = cut_lineage(each.groupBy(F.col("window").alias("w")).agg(F.min(place).alias("first")))
    again = each.join(first, F.col("window") == F.col("w")).filter(place > F.col("first"))
    return again.select("doc_id", "th", "start", F.lit(min_words).cast("long").alias("size"))


def _copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, th)`` of texts that an earlier document has whole: all their windows start there."""
    seen = docs.filter("text is not null").select("doc_id", "th", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("th"))
    first = seen.groupBy(F.col("digest").alias("d")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return seen.join(first, F.col("digest") == F.col("d")).filter(place > F.col("first")).select("doc_id", "th").distinct()


def removed(text: str | None, places: list[dict], min_words: int = MIN_WORDS) -> tuple[int, int, str]:
    """Words, words removed, and the kept words joined by one space. A place of size ``WHOLE`` covers every window."""
    words = words_of(text)
    gone = bytearray(len(words))
    for x in places:
        a, b = x["start"], min(x["start"] + x["size"], len(words))
        if x["size"] != WHOLE or len(words) >= min_words:
            gone[a:b] = b"\1" * (b - a)
    kept = [w for w, g in zip(words, gone) if not g]
    return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")


def remove_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``, one row for each row of ``docs``."""
    small_batches(docs.sparkSession)
    own = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    # The text's hash tells rows that share an id apart; where ids are unique a constant saves moving it.
    shared = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    own = own.select("doc_id", (F.xxhash64("text") if shared else F.lit(0).cast("long")).alias("th"), "text")
    # Rows with one id and one text have the same places: they are searched once, and all of them get what is found.
    once = own.dropDuplicates(["doc_id", "th"]) if shared else own
    anchored = _anchored(once, min_words, gram)
    often = written(anchored.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    copies = written(_copies(once))
    met = anchored.join(often, "g").groupBy(F.col("doc_id").alias("d2"), F.col("th").alias("t2")).agg(
        F.collect_list(F.struct("g", "n", "start", "size")).alias("list"))
    by_doc = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2"))
    met = met.join(copies, F.col("d2").eqNullSafe(F.col("doc_id")) & (F.col("t2") == F.col("th")), "left_anti")
    cut = _cut_out(once.join(met, by_doc).select("doc_id", "th", "text", "list"), min_words)
    repeats = _in_groups(cut.filter(F.col("n") <= group_limit), min_words)
    if often.filter(F.col("n") > group_limit).limit(1).count():
        repeats = repeats.union(_by_window(cut_lineage(cut.filter(F.col("n") > group_limit)), min_words))
    repeats = repeats.union(copies.select("doc_id", "th", F.lit(0).cast("long"), F.lit(WHOLE).cast("long")))
    places = repeats.groupBy(F.col("doc_id").alias("d2"), F.col("th").alias("t2")).agg(
        F.collect_list(F.struct("start", "size")).alias("places"))
    joined = own.join(places, by_doc, "left").select("doc_id", "text", "places")

    @F.arrow_udf("n_words long, n_removed long, kept string")
    def kept(texts: pa.Array, lists: pa.Array) -> pa.Array:
        rows = [removed(t.as_py(), x.as_py() or [], min_words) for t, x in zip(texts, lists)]
        n, gone, rest = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(rest, pa.string())],
                                          ["n_words", "n_removed", "kept"])

    (k,) = fresh(joined, "k")
    return joined.select("doc_id", kept("text", "places").alias(k)).select("doc_id", f"{k}.n_words", f"{k}.n_removed", f"{k}.kept")
