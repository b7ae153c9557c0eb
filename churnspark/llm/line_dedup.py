"""Line dedup by content-defined chunks of lines, with DataFrame functions only.

A text is cut at ``\\n`` into lines; a line's hash is the first 60 bits of its
MD5. A rolling hash runs over the last ``window`` line hashes (each shifted by
its distance, joined by exclusive or); a chunk ends after a line whose rolling
hash is divisible by ``divisor``, and at the last line. Inserted or deleted
lines shift no boundary beyond the window, so shared passages give the same
chunks wherever they stand.

A chunk is removed where it holds two or more lines with text and the same
bytes occur earlier (smaller id, or the same document, earlier line). Digests
only choose candidates; candidates are grouped by the chunk's text itself.

Plan: chunk digests are counted (partial counts first, so a chunk of a third of
all documents is one row a task), chunk texts with a repeated digest are
grouped by text for their first place (again partial), and every later place is
found by a join, which adaptive execution splits where one chunk is hot. One
more join by document brings the places to the texts.

``remove_repeated`` (op8) removes these chunks only, so a passage goes where both
places cut it alike. ``without_repeats`` (the pipeline) removes the same chunks, and
then what a boundary has cut off: of two lines with text that follow each other
(with the blank lines between them) both go where the same bytes occur earlier in
the input. Such pairs overlap, so passages of any length go up to their ends, and the
first place of every line stays. A pair is known by its SHA-256, so no text is
shuffled for it; the plan is the same otherwise.

Edge cases: a null text stays null and has no lines; an empty one has none
removed. Null ids come after all ids. Rows with the same id and text are one
document in several copies and keep the same lines. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, cut_lineage, fresh, written

WINDOW, DIVISOR = 3, 3
FULL = r"[^\x20\x09-\x0D]"


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long")


def chunks(lines: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """``array<struct<start, size>>`` of the chunks of an array of lines (starts count from 0)."""
    def bounds(h: Column) -> Column:
        def rolling(i: Column) -> Column:
            value = F.element_at(h, i)
            for j in range(1, window):
                value = value.bitwiseXOR(F.when(i > j, F.shiftright(F.element_at(h, F.greatest(i - j, F.lit(1))), j)).otherwise(F.lit(0).cast("long")))
            return value
        return F.filter(F.sequence(F.lit(1), F.size(h)), lambda i: (i == F.size(h)) | (rolling(i) % divisor == 0))

    def cut(ends: Column) -> Column:
        def piece(e: Column, j: Column) -> Column:
            start = F.when(j == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(j, F.lit(1))))
            return F.struct(start.alias("start"), (e - start).alias("size"))
        return F.transform(ends, piece)

    hashes = F.transform(lines, line_hash)
    return F.element_at(F.transform(F.transform(F.array(hashes), bounds), cut), 1)


def _pieces(docs: DataFrame, window: int, divisor: int) -> DataFrame:
    """``(doc_id, th, start, size, body)`` of chunks with two or more lines of text."""
    cutting = docs.select("doc_id", "th", F.split("text", "\n", -1).alias("lines"))
    each = cutting.select("doc_id", "th", "lines", F.inline(chunks(F.col("lines"), window, divisor))).filter("size > 1")
    body = F.slice("lines", F.col("start") + 1, F.col("size"))
    each = each.filter(F.size(F.filter(body, lambda x: x.rlike(FULL))) > 1)
    return each.select("doc_id", "th", "start", "size", F.array_join(body, "\n").alias("body"))


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    divisor: int = DIVISOR) -> DataFrame:
    """``(doc_id, th, start, size)`` of every chunk that is to go; ``th`` is the text's XXH64."""
    own = docs.filter(col(text_col).isNotNull()).select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("th"), col(text_col).alias("text"))
    pieces = _pieces(own, window, divisor).withColumn("digest", F.md5(F.col("body").cast("binary")))
    # written first, so that the join has a plain shuffle on both sides and a hot digest can be split
    often = written(pieces.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"))
    met = cut_lineage(pieces.join(often.hint("merge"), "digest", "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "th", "start")
    first = met.groupBy(F.col("digest").alias("d"), F.col("body").alias("b")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").select("d", "b", "first")
    again = met.join(first, (F.col("digest") == F.col("d")) & (F.col("body") == F.col("b"))).filter(place > F.col("first"))
    return again.select("doc_id", "th", "start", "size")


def _pairs(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, start, size, digest)`` of every two lines with text that follow each other."""
    def let(value: Column, f) -> Column:
        return F.element_at(F.transform(F.array(value), f), 1)

    def full(lines: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.element_at(lines, i + 1).rlike(FULL))

    def pair(lines: Column, i: Column, size: Column) -> Column:
        body = F.array_join(F.slice(lines, i + 1, size), "\n")
        return F.struct(i.alias("start"), size.alias("size"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"))

    def pairs(lines: Column) -> Column:
        return let(full(lines), lambda at: F.transform(
            F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0))), lambda i, k: pair(lines, i, F.element_at(at, k + 2) - i + 1)))

    # the digests are made beside the lines, so that no row carries its document's lines
    return docs.select("doc_id", "th", F.inline(let(F.split("text", "\n", -1), pairs)))


def repeated_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, start, size)`` of every pair of lines that occurs earlier; pairs overlap."""
    own = docs.filter(col(text_col).isNotNull()).select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("th"), col(text_col).alias("text"))
    pairs = _pairs(own)
    often = written(pairs.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"))
    met = written(pairs.join(often.hint("merge"), "digest", "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "th", "start")
    first = written(met.groupBy(F.col("digest").alias("d")).agg(F.min(place).alias("first")))
    again = met.join(first.hint("merge"), F.col("digest") == F.col("d")).filter(place > F.col("first"))
    return again.select("doc_id", "th", "start", "size")


def _cut_out(docs: DataFrame, cuts: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """``docs`` with a struct ``out`` (see ``remove_repeated``) without the lines of ``cuts``, which may overlap."""
    doc, th, gone = fresh(docs, "dedup_doc", "dedup_th", "dedup_gone")
    cuts = cuts.distinct().groupBy(F.col("doc_id").alias(doc), F.col("th").alias(th)).agg(
        F.collect_list(F.struct("start", "size")).alias(gone))
    joined = docs.join(cuts, col(id_col).eqNullSafe(col(doc)) & (F.xxhash64(col(text_col)) == col(th)), "left")
    lines = F.split(col(text_col), "\n", -1)
    dropped = F.array_distinct(F.flatten(F.transform(col(gone), lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1))))
    # the kept lines are those whose place is in no cut
    places = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped))
    left = F.element_at(F.transform(F.array(lines), lambda ls: F.array_join(F.transform(places, lambda i: F.element_at(ls, i + 1)), "\n")), 1)
    number = F.when(col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long")
    result = F.struct(
        number.alias("n_lines"), F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size(col(gone)), F.lit(0)).cast("long").alias("n_chunks"),
        F.when(col(gone).isNull(), col(text_col)).otherwise(left).alias("text"))
    return joined.withColumn(out, F.when(col(gone).isNull(), F.struct(
        number.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_chunks"),
        col(text_col).alias("text"))).otherwise(result)).drop(doc, th, gone)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "dedup",
                    window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with a struct ``out``: ``n_lines``, ``n_removed`` (lines), ``n_chunks`` (removed) and ``text`` (the rest)."""
    return _cut_out(docs, repeated_chunks(docs, id_col, text_col, window, divisor), id_col, text_col, out)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` without repeated passages (and ``chars_col`` set to the new length); documents that lost all their text go."""
    (out,) = fresh(docs, "dedup")
    cuts = repeated_chunks(docs, id_col, text_col).unionByName(repeated_pairs(docs, id_col, text_col))
    done = _cut_out(docs, cuts, id_col, text_col, out)
    done = done.filter((col(out)["n_removed"] == 0) | col(out)["text"].rlike(FULL))
    text = col(out)["text"]
    changed = col(out)["n_removed"] > 0
    new = {text_col: text}
    if chars_col in docs.columns:
        new[chars_col] = F.when(changed, F.char_length(text).cast(docs.schema[chars_col].dataType)).otherwise(col(chars_col))
    return done.select(*[(new[c] if c in new else col(c)).alias(c) for c in docs.columns])
