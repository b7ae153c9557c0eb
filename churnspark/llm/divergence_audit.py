"""Source divergence audit by sorting word-start pointers.

A shard is a run of whole texts of about ``SHARD`` bytes in one Arrow buffer.
Where a term begins is a pointer into that buffer, and the pointers are sorted by
the term that begins there with a multikey quicksort whose characters are 8-byte
slices: pointers are sorted by the first slice, and only runs that are still equal
and go on are sorted by the next one. Equal runs then are the terms; a run's
documents give its document frequency, their groups the counts of each source.
Spark adds up the shards' rows ``(lang, source, term, n, d)``.

A language keeps the terms that occur in at least ``least`` of its documents. In exact
arithmetic each (lang, source) group and each language gives a kept term

    p = 1 + floor(SCALE * (count + 1) / (N + V)),

and p diverges from q by f = floor((p - q)^2 / q), which is floor(p^2 / q) - 2p + q.

Pairs of sources are summed over all kept terms without visiting the terms that
neither has, and without a row for each term and pair: with p0 a group's value of
a term it lacks, the sum over floor(p^2 / q) is

    sum over s's terms of floor(p^2 / q0)  +  sum over t's terms of floor(p0^2 / q)
    + (V - |s| - |t|) * floor(p0^2 / q0)  +  a correction for terms that both have.

The first two come from each group's histogram of p, the correction from the
rows of one term, which meet in one task and are summed there into pairs of sources.

Edge cases: null text, lang and source count as ``''``. Every group that occurs is
reported, also without terms; a language without kept terms has value 0 for its
pairs. Rows are documents, so repeated rows count each. Terms tie in UTF-8 order. An
empty table gives an empty result. Other columns are not read. A text longer than a
shard is sorted in slices cut between terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import col, small_batches, written

SHARD = 8 << 20
SCALE = 1_000_000_000
SALTS = 16
CELLS = 1 << 18         # of a matrix terms x sources
BLOCK = 50_000          # rows of whole terms that are summed at once
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

_BYTE = np.arange(256)
IN_TERM = ((_BYTE > 0x40) & (_BYTE < 0x5B)) | ((_BYTE > 0x60) & (_BYTE < 0x7B)) | (_BYTE > 0x7F)
LOWERED = np.where((_BYTE > 0x40) & (_BYTE < 0x5B), _BYTE + 32, _BYTE).astype(np.uint8)
#: Keeps the first i bytes of a slice. Terms have no zero byte, so a zero ends a term and sorts first.
FIRST = np.array([(1 << 64) - (1 << 8 * (8 - i)) for i in range(9)], np.uint64)


# ------------------------------------------------------------ shards --
def term_pointers(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where terms start and end in ``data``; texts begin at ``begins`` and no term crosses into the next."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = True
    starts = inside[1:] & (~inside[:-1] | edge)
    ends = inside[:-1] & (~inside[1:] | edge)
    return np.flatnonzero(starts), np.flatnonzero(ends)


def _slices(padded: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next 8 bytes of each term as a number; bytes after its end are zero."""
    window = np.lib.stride_tricks.sliding_window_view(padded, 8)[at]
    return window.view(">u8")[:, 0].astype(np.uint64) & FIRST[np.minimum(left, 8)]


def sort_pointers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pointers by term, and for each place in it whether a new term begins there.

    Equal terms keep the order of their pointers."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    size = ends - starts
    key = _slices(padded, starts, size)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    depth = 8
    while True:
        run = np.cumsum(new) - 1
        goes_on = np.bincount(run, size[order] > depth, minlength=0) > 0
        shared = np.bincount(run) > 1
        places = np.flatnonzero((goes_on & shared)[run])
        if not len(places):
            return order, new
        pointers = order[places]
        key = _slices(padded, np.minimum(starts[pointers] + depth, len(data)), np.maximum(size[pointers] - depth, 0))
        by = np.lexsort((key, run[places]))
        order[places] = pointers[by]
        key, of = key[by], run[places]
        new[places[1:]] |= (key[1:] != key[:-1]) & (of[1:] == of[:-1])
        depth += 8


def _cut(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted runs of one buffer: (run, document) pairs in order, occurrences of each, and each run's first pointer."""
    starts, ends = term_pointers(data, begins[:-1])
    order, new = sort_pointers(data, starts, ends)
    doc = np.searchsorted(begins, starts, "right") - 1
    run = np.cumsum(new) - 1
    code, n = np.unique(run * (len(begins) - 1) + doc[order], return_counts=True)
    head = order[np.flatnonzero(new)]
    return code, n, starts[head], ends[head]


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The terms at the pointers as an Arrow array."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)),
                                                                  pa.py_buffer(np.ascontiguousarray(data[at]))])


def count_shard(groups: np.ndarray, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Per term and group of a shard: term, group, occurrences, documents. ``groups`` are numbers, one a text."""
    by_group = np.argsort(groups, kind="stable")
    texts, groups = texts.take(pa.array(by_group)), groups[by_group]
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = LOWERED[np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]]] if raw is not None else np.zeros(0, np.uint8)
    code, n, starts, ends = _cut(data, offsets - offsets[0])
    run, doc = np.divmod(code, len(groups))
    group = groups[doc]
    first = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (group[1:] != group[:-1])]) if len(run) else [])
    terms = _texts(data, starts, ends)
    return (terms.take(pa.array(run[first])), group[first], np.add.reduceat(n, first) if len(first) else n,
            np.diff(np.append(first, len(run))))


def count_long(text: str) -> tuple[pa.Array, np.ndarray]:
    """Terms and occurrences of one text that is longer than a shard."""
    data = LOWERED[np.frombuffer(text.encode(), np.uint8)]
    total: Counter[str] = Counter()
    lo = 0
    while lo < len(data):
        hi = min(lo + SHARD, len(data))
        if hi < len(data) and IN_TERM[data[hi]]:  # go on to the end of the term
            rest = np.flatnonzero(~IN_TERM[data[hi:hi + SHARD]])
            while not len(rest) and hi < len(data):
                hi = min(hi + SHARD, len(data))
                rest = np.flatnonzero(~IN_TERM[data[hi:hi + SHARD]])
            hi = hi + int(rest[0]) if len(rest) else len(data)
        code, n, starts, ends = _cut(data[lo:hi], np.array([0, hi - lo]))
        total.update(dict(zip(_texts(data[lo:hi], starts, ends).to_pylist(), n.tolist())))
        lo = hi
    return pa.array(list(total), pa.large_string()), np.fromiter(total.values(), np.int64, len(total))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, term, n, d)``: occurrences and documents of each term in each group."""
    small_batches(docs.sparkSession)
    texts = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def rows(groups: list[tuple[str, str]], terms: pa.Array, group: np.ndarray, n: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        names = [pa.array([g[i] for g in groups], pa.string()).take(pa.array(group)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*names, terms.cast(pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                                          names=["lang", "source", "term", "n", "d"])

    def shard(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        pairs = list(zip(table.column("lang").to_pylist(), table.column("source").to_pylist()))
        groups = sorted(set(pairs))
        number = {g: i for i, g in enumerate(groups)}
        codes = np.fromiter((number[g] for g in pairs), np.int64, len(pairs))
        whole = table.column("text").cast(pa.large_string()).combine_chunks()
        whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
        size = np.diff(np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1])
        for i in np.flatnonzero(size > SHARD).tolist():
            terms, n = count_long(whole[i].as_py())
            yield rows(groups, terms, np.full(len(n), codes[i]), n, np.ones(len(n), np.int64))
        short = np.flatnonzero(size <= SHARD)
        if len(short):
            yield rows(groups, *count_shard(codes[short], whole.take(pa.array(short))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= SHARD:
                yield from shard(held)
                held, size = [], 0
        if size:
            yield from shard(held)

    parts = texts.mapInArrow(counted, "lang string, source string, term string, n long, d long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


# ------------------------------------------------------- divergence --
def _share(count: Column, total: Column, kinds: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + kinds))``, exact."""
    up = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = (total + kinds).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", up, down)


def _div(a: Column, b: Column) -> Column:
    """Integer division of non-negative longs."""
    return F.call_function("div", a, b)


def kept_counts(counts: DataFrame, least: int) -> DataFrame:
    """``(lang, source, term, n, n_lang, first)`` of terms in at least ``least`` documents of the language;
    ``first`` is 1 on one row of each term."""
    w = Window.partitionBy("lang", "term")
    return (counts.withColumn("df", F.sum("d").over(w)).withColumn("n_lang", F.sum("n").over(w))
            .withColumn("first", (F.row_number().over(w.orderBy("source")) == 1).cast("int"))
            .filter(F.col("df") >= least).select("lang", "source", "term", "n", "n_lang", "first"))


def group_table(docs: DataFrame, kept: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Every (lang, source) group: its kept occurrences ``total`` and terms ``own``, the language's ``kinds`` and ``lang_total``,
    ``p0`` of a term that the group lacks, ``sum_p`` over all kept terms."""
    names = [F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    groups = docs.select(*names).distinct()
    langs = kept.groupBy("lang").agg(F.sum("first").alias("kinds"), F.sum("n").alias("lang_total"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    zero = F.lit(0).cast("long")
    out = groups.join(langs, "lang", "left").join(own, ["lang", "source"], "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("kinds", "lang_total", "total", "own")])
    return out.withColumn("p0", F.when(F.col("kinds") > 0, _share(zero, F.col("total"), F.col("kinds"))))


def _joint(rows: DataFrame) -> DataFrame:
    """``(lang, s, t, j)``: over the terms that s and t both have, floor(p^2/q) less what the histograms count for it.

    A term's rows follow each other and ``first`` is 1 on the first of them."""

    def summed(lang: str, sources: np.ndarray, zero: np.ndarray, term: np.ndarray, source: np.ndarray, p: np.ndarray,
               out: dict) -> None:
        step = max(1, CELLS // len(sources))
        for lo in range(0, int(term[-1]) + 1, step):
            pick = slice(*np.searchsorted(term, [lo, lo + step]))
            table = np.zeros((step, len(sources)), np.int64)
            table[term[pick] - lo, source[pick]] = p[pick]
            for s in np.unique(source[pick]).tolist():
                q = table[table[:, s] > 0]
                ps, has = q[:, [s]], q > 0
                q = np.where(has, q, 1)
                z = zero[s] * zero[s]
                f = np.where(has, ps * ps // q - ps * ps // zero - z // q + z // zero, 0).sum(axis=0)
                for t in np.flatnonzero(has.any(axis=0)).tolist():
                    if t != s:
                        at = (lang, sources[s], sources[t])
                        out[at] = out.get(at, 0) + int(f[t])

    def batch_of(out: dict) -> pa.RecordBatch:
        lang, s, t = ([k[i] for k in out] for i in range(3))
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(s, pa.string()), pa.array(t, pa.string()),
                                           pa.array(list(out.values()), pa.int64())], names=["lang", "s", "t", "j"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Tables of whole terms, about ``BLOCK`` rows each."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                table = pa.Table.from_batches(held)
                end = int(np.flatnonzero(table.column("first").to_numpy())[-1])  # the last term may go on
                if end:
                    yield table.slice(0, end)
                held = table.slice(end).to_batches()
                size = size - end
        if size:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict = {}
        for block in blocks(batches):
            lang, source = (block.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
            lang, source = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (lang, source))
            langs, names = lang.dictionary.to_pylist(), np.array(source.dictionary.to_pylist(), object)
            lang, source = lang.indices.to_numpy(), source.indices.to_numpy()
            new, p, zero = (block.column(c).to_numpy() for c in ("first", "p", "p0"))
            starts = np.flatnonzero(np.concatenate([[True], lang[1:] != lang[:-1]]))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(lang)]):
                own, first, code = np.unique(source[a:b], return_index=True, return_inverse=True)
                summed(langs[lang[a]], names[own], zero[a:b][first], np.cumsum(new[a:b]) - 1, code, p[a:b], out)
            if len(out) > CELLS:
                yield batch_of(out)
                out = {}
        if out:
            yield batch_of(out)

    sums = rows.mapInArrow(run, "lang string, s string, t string, j long")
    return sums.groupBy("lang", "s", "t").agg(F.sum("j").alias("j"))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      least: int = 3, top: int = 200) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: the source against each other source of its language, all ranks. Part ``term``: the terms that
    the source uses more than its language, to rank ``top``."""
    kept = written(kept_counts(term_counts(docs, lang_col, source_col, text_col), least))
    groups = written(group_table(docs, kept, lang_col, source_col))
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
        _share(F.col("n_lang"), F.col("lang_total"), F.col("kinds")).alias("q"), "p0", "first")
    return _terms(shares, top).unionByName(_pairs(shares, groups))


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= top) if top else out


def _terms(shares: DataFrame, top: int) -> DataFrame:
    over = F.col("p") - F.col("q")
    rows = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         _div(over * over, F.col("q")).alias("value"))
    return _ranked(rows, top)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    n = int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = shares.select("lang", "term", "source", "p", "p0", "first").repartition(n, "lang", "term").sortWithinPartitions(
        "lang", "term", "source").drop("term")
    # Histograms of p against every group of the language, dealt by salts so that one language fills many tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    hist = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m")).withColumn("salt", F.pmod(F.hash("p"), F.lit(SALTS)))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("o0"), salts)
    p, zero, m = F.col("p"), F.col("o0"), F.col("m")
    sides = hist.join(others, ["lang", "salt"]).filter("source != other").groupBy("lang", "source", "other").agg(
        F.sum(m * _div(p * p, zero)).alias("x"), F.sum(m * _div(zero * zero, p)).alias("y"))
    both = sides.select("lang", F.col("source").alias("s"), F.col("other").alias("t"), "x", F.lit(0).cast("long").alias("y"),
                        F.lit(0).cast("long").alias("j"))
    both = both.unionByName(sides.select("lang", F.col("other").alias("s"), F.col("source").alias("t"), F.lit(0).cast("long").alias("x"),
                                         "y", F.lit(0).cast("long").alias("j")))
    both = both.unionByName(_joint(rows).select("lang", "s", "t", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "j"))
    sums = both.groupBy("lang", "s", "t").agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum("j").alias("j"))
    own = shares.groupBy("lang", "source").agg(F.sum("p").alias("sp"))
    full = groups.join(own, ["lang", "source"], "left").select(
        "lang", "source", "kinds", "own", "p0",
        (F.coalesce("sp", F.lit(0).cast("long")) + (F.col("kinds") - F.col("own")) * F.col("p0")).alias("sum_p"))
    s = full.select("lang", F.col("source").alias("s"), F.col("kinds"), F.col("own").alias("own_s"), F.col("p0").alias("s0"), F.col("sum_p").alias("sum_s"))
    t = full.select("lang", F.col("source").alias("t"), F.col("own").alias("own_t"), F.col("p0").alias("t0"), F.col("sum_p").alias("sum_t"))
    z = F.lit(0).cast("long")
    value = (F.coalesce("x", z) + F.coalesce("y", z) + F.coalesce("j", z)
             + (F.col("kinds") - F.col("own_s") - F.col("own_t")) * _div(F.col("s0") * F.col("s0"), F.col("t0"))
             - 2 * F.col("sum_s") + F.col("sum_t"))
    out = s.join(t, "lang").filter("s != t").join(sums, ["lang", "s", "t"], "left").select(
        "lang", F.col("s").alias("source"), F.lit("pair").alias("part"), F.col("t").alias("item"),
        F.when(F.col("kinds") > 0, value).otherwise(0).alias("value"))
    return _ranked(out, None)
