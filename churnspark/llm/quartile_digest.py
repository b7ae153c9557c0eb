"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every byte of a text's UTF-8 starts the triplets that lie within a window of
``WINDOW`` = 4 bytes. A triplet's multiply-and-add hash names one of ``BUCKETS``
= 256 counters. The counters' quartiles turn each counter into a two-bit code
(how many quartiles it exceeds). The digest is hexadecimal text:

* 2 digits: the length in bytes, as bit length and the three bits after the first;
* 2 digits: the lower and the middle quartile in sixteenths of the upper one;
* 128 digits: the codes, two buckets a digit.

Two digests differ by ``COST`` of each pair of codes, by 4 for each step of the
length (at most 16 steps count) and by 4 for each step of the quartile ratios;
the sum is bounded at ``BOUND`` and ``likeness`` is one minus its share of that.

``edit_audit`` needs each document's successor. Ids alone give the cut points
(ids that occur, from one quantile aggregation), rows go to the range between
two cut points, and a range's first document is also sent to the range before
it. So whole texts move once and no task sees more than its range. Within a
range rows come by falling id, so a row's successor has always been read.

Edge cases: a null text counts as empty; a text under three bytes has no
triplet, all codes are zero. Null ids come before all others. Rows that share an
id have the next larger id as their successor and the smallest text stands for
an id with several; rows of one id stay in one range, read as a stream. A single
id is its own successor. Repeated rows give a row each, an empty table none.
Other columns are not read, so their names may clash. Long texts are hashed in
slices of ``CHUNK`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, fresh, small_batches

WINDOW, BUCKETS = 4, 256
TRIPLETS = [(b, c) for b in range(1, WINDOW) for c in range(b + 1, WINDOW)]  # offsets of the second and third byte
FACTORS = (2654435761, 2246822519, 3266489917)  # odd 32-bit multipliers
STEP = 668265263                                # added once a kind of triplet
COST = (0, 1, 2, 6)                             # by the difference of two codes
LENGTH_STEPS, HEADER_COST = 16, 4
BOUND = 2 * BUCKETS
CHUNK = 1 << 20


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each text begins (one entry more than texts)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def histograms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Triplet counts (texts x buckets) and byte lengths."""
    data, begins = _bytes_of(texts)
    n = len(texts)
    counts = np.zeros(n * BUCKETS, np.int64)
    mult = [np.arange(256, dtype=np.uint32) * np.uint32(f) for f in FACTORS]
    for lo in range(0, len(data), CHUNK):
        part = data[lo:lo + CHUNK + WINDOW - 1]
        size = min(CHUNK, len(data) - lo)
        at = np.arange(lo, lo + size)
        doc = np.searchsorted(begins, at, "right") - 1
        room = begins[doc + 1] - at
        row = doc * BUCKETS
        first = mult[0][part[:size]]
        for kind, (b, c) in enumerate(TRIPLETS):
            inside = np.flatnonzero(room > c)
            h = first[inside] + mult[1][part[inside + b]] + mult[2][part[inside + c]] + np.uint32(kind * STEP % (1 << 32))
            low, high = (doc[0], doc[-1] + 1)
            counts[low * BUCKETS:high * BUCKETS] += np.bincount(
                row[inside] - low * BUCKETS + (h >> np.uint32(24)), minlength=(high - low) * BUCKETS)
    return counts.reshape(n, BUCKETS), np.diff(begins)


def digests(texts: pa.Array) -> np.ndarray:
    """One row of small numbers a text: length, two quartile ratios, and the codes of all buckets."""
    counts, length = histograms(texts)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, [BUCKETS * k // 4 - 1]] for k in (1, 2, 3))
    out = np.zeros((len(counts), 3 + BUCKETS), np.uint8)
    bits = np.array([int(x).bit_length() for x in length], np.int64)
    out[:, 0] = 8 * bits + np.where(bits > 3, length >> np.maximum(bits - 4, 0), length << np.maximum(4 - bits, 0)) % 8
    for i, q in ((1, q1), (2, q2)):
        out[:, i] = np.minimum(15, 16 * q // np.maximum(q3, 1))[:, 0]
    out[:, 3:] = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    return out


def to_text(rows: np.ndarray) -> list[str]:
    """Digests as hexadecimal text."""
    packed = np.empty((len(rows), 2 + BUCKETS // 4), np.uint8)
    packed[:, 0] = rows[:, 0]
    packed[:, 1] = rows[:, 1] * 16 + rows[:, 2]
    packed[:, 2:] = np.packbits(np.unpackbits(rows[:, 3:, None], axis=2)[:, :, 6:].reshape(len(rows), 2 * BUCKETS), axis=1)
    return [x.tobytes().hex() for x in packed]


def from_text(prints: list[str]) -> np.ndarray:
    """Digests from their hexadecimal text."""
    packed = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), 2 + BUCKETS // 4)
    codes = (packed[:, 2:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return np.concatenate([packed[:, :1], packed[:, 1:2] >> 4, packed[:, 1:2] & 15, codes.reshape(len(prints), BUCKETS)], axis=1)


def differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bounded difference of digests, row by row."""
    steps = np.abs(a.astype(np.int64) - b)
    header = np.minimum(steps[:, 0], LENGTH_STEPS) + steps[:, 1] + steps[:, 2]
    return np.minimum(BOUND, HEADER_COST * header + np.array(COST)[steps[:, 3:]].sum(axis=1))


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - differences(a, b) / BOUND


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of each text; a column named like ``out`` stays, the new name gets ``_`` then."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def printed(texts: pa.Array) -> pa.Array:
        return pa.array(to_text(digests(texts)), pa.string())

    return docs.withColumn(fresh(docs, out)[0], printed(col(text_col)))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two digests from 0 to 1; null if either is null."""

    @F.arrow_udf("double")
    def liked(x: pa.Array, y: pa.Array) -> pa.Array:
        whole = np.array([u.is_valid and v.is_valid for u, v in zip(x, y)], bool)
        out = np.zeros(len(whole))
        if whole.any():
            out[whole] = _likeness(*(from_text([t for t, ok in zip(z.to_pylist(), whole) if ok]) for z in (x, y)))
        return pa.array(out, pa.float64(), mask=~whole)

    return liked(a, b)


def cut_points(docs: DataFrame, id_col: str, ranges: int) -> list[int | None]:
    """At most ``ranges`` ids that occur, in order, the smallest first (null if there are null ids)."""
    shares = [i / ranges for i in range(1, ranges)]
    key = col(id_col).cast("long")
    found = docs.agg(F.percentile_approx(key, shares or [0.5], max(10_000, 20 * ranges)).alias("q"), F.min(key).alias("low"),
                     F.count_if(key.isNull()).alias("nulls")).first()
    ids = sorted({found["low"], *((found["q"] or []) if shares else [])} - {None})
    return [None] * (found["nulls"] > 0) + ids


def by_range(docs: DataFrame, id_col: str, text_col: str, ranges: int | None = None) -> DataFrame:
    """``(part, guest, id, text)``: rows by range of ids, sorted by falling id; each range begins with a guest,
    the first document of the next range (after the last: of the first)."""
    ranges = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = cut_points(docs, id_col, ranges)
    nulls, ids = cuts[:1] == [None], np.array([c for c in cuts if c is not None], np.int64)

    @F.arrow_udf("array<struct<part:int,guest:boolean>>")
    def places(keys: pa.Array) -> pa.Array:
        whole = keys.fill_null(0).to_numpy(zero_copy_only=False)
        known = keys.is_valid().to_numpy(zero_copy_only=False)
        part = np.where(known, np.searchsorted(ids, whole, "right") - 1 + nulls, 0)
        is_cut = np.where(known, np.isin(whole, ids), nulls)
        rows = [[{"part": p, "guest": False}] + ([{"part": (p - 1) % len(cuts), "guest": True}] if c else [])
                for p, c in zip(part.tolist(), is_cut.tolist())]
        return pa.array(rows, pa.list_(pa.struct([("part", pa.int32()), ("guest", pa.bool_())])))

    key = col(id_col).cast("long")
    placed = docs.select(key.alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"), places(key).alias("at"))
    placed = placed.select(F.inline("at"), "id", "text")
    return placed.repartition(max(1, len(cuts)), "part").sortWithinPartitions(
        "part", F.desc("guest"), F.col("id").desc_nulls_last(), "text")


def edit_audit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 4,
               ranges: int | None = None) -> DataFrame:
    """Each document against an edit of itself and against its successor.

    The edited text is the text without its last ``n // share`` code points, followed by as many (or all) of the
    successor's first. Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``."""
    small_batches(docs.sparkSession)
    schema = (f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = None, object()       # the last id read and the document that stands for it: (text, digest)
        after = None                    # the same for the id before that, which is the successor
        for batch in batches:
            parts, guests, ids, texts = (batch.column(i) for i in range(4))
            own = digests(texts)
            kept, edited, near, sums = [], [], [], []
            for i, (part, guest, one, text) in enumerate(zip(*(c.to_pylist() for c in (parts, guests, ids, texts)))):
                if (part, guest, one) != key:
                    after, now, key = now, (text, own[i]), (part, guest, one)
                if guest:
                    continue
                n = len(text) // share
                new = text[:len(text) - n] + after[0][:n]
                kept.append(i)
                edited.append(new)
                near.append(after[1])
                sums.append(hashlib.sha256(new.encode()).hexdigest())
            if not kept:
                continue
            mine, theirs = own[kept], digests(pa.array(edited, pa.large_string()))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(kept)), pa.array([len(texts[i].as_py()) for i in kept], pa.int64()), pa.array(sums),
                pa.array(to_text(mine)), pa.array(to_text(theirs)), pa.array(_likeness(mine, theirs)),
                pa.array(_likeness(mine, np.array(near)))],
                names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return by_range(docs, id_col, text_col, ranges).mapInArrow(audited, schema)
