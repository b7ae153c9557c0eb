"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased,
3-word shingles (repeats included; a shorter text is one shingle, a text
without words has fingerprint zero), XXH64 (seed 42) of each, and the 64-bit
majority. Fingerprints link at ``radius`` = 2 or fewer differing bits.

Covering family: every bit position gets a vector from {0,1}^(radius+1); the
table of a non-zero vector v keeps the bits whose vector has an odd product
with v. Up to ``radius`` differing bits give at most ``radius`` linear
conditions on v, so some non-zero v makes all products even: both fingerprints
agree on that table's bits and meet there. With radius 2 these are 7 tables,
each a mask of 32 to 40 bits; no pair within the radius is missed.

Links inside a table's bucket, without forming all pairs: only different
fingerprints enter (copies share one row). Members agree on the mask, so a
pair within radius 2 meets at a middle point: a value that each of them
reaches by flipping at most one bit outside the mask. All fingerprints that
reach a middle point lie within distance 2 of one another, so linking each to
the smallest of them loses no link. Small buckets (``pair_limit`` members or
fewer) compare their members directly; larger ones use middle points. Both are
exact.

Links only join different fingerprints; their components come from repeated
star contraction with a checkpoint each round.

Edge cases: null and blank texts have fingerprint zero and are linked as any
other. A null id is returned as it is and never is a component's smallest id;
a component without any id has a null component. Repeated rows give a row
each. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, cut_lineage, fresh, small_batches
from churnspark.llm.components import components

RADIUS, SHINGLE, SEED, BITS = 2, 3, 42, 64
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    last = ends[k - 1:].tolist()
    first = [0, *(ends[: len(words) - k] + 1).tolist()]
    votes = np.zeros(BITS, np.int64)
    xxh = xxhash.xxh64_intdigest
    for i in range(0, len(last), CHUNK):
        h = np.array([xxh(joined[a:b], seed) for a, b in zip(first[i:i + CHUNK], last[i:i + CHUNK])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(last)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column ``out``."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out, fp(col(text_col)))


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits. Positions take the non-zero vectors in turn."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _lit(x: int) -> Column:
    return F.lit(_signed(x)).cast("long")


def links(fps: DataFrame, radius: int = RADIUS, pair_limit: int = 32) -> DataFrame:
    """Edges ``(u, v)``, u > v, whose components are those of all pairs of distinct ``fps.fp`` within ``radius``.

    For radius 2 (the middle point argument); the masks themselves hold for any radius."""
    if radius != 2:
        raise ValueError("middle points are defined for radius 2")
    masks = covering_masks(radius)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_lit(m)).alias("key")) for t, m in enumerate(masks)])).alias("k"))
    keyed = keyed.select("fp", F.col("k.t").alias("t"), F.col("k.key").alias("key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = cut_lineage(keyed.join(sizes, ["t", "key"]))

    few = met.filter(F.col("n") <= pair_limit).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("m"))
    near = F.flatten(F.transform("m", lambda x: F.transform(
        F.filter("m", lambda y: (y < x) & (F.bit_count(x.bitwiseXOR(y)) <= radius)),
        lambda y: F.struct(x.alias("u"), y.alias("v")))))
    direct = few.select(F.inline(near))

    free = F.array(*[F.array(_lit(0), *[_lit(1 << i) for i in range(BITS) if not m >> i & 1]) for m in masks])
    points = met.filter(F.col("n") > pair_limit).select("t", "fp", F.explode(F.element_at(free, F.col("t") + 1)).alias("flip"))
    points = points.select("t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    least = points.groupBy("t", "middle").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    starred = points.join(least, ["t", "middle"]).filter("fp > v").select(F.col("fp").alias("u"), "v")
    return direct.union(starred).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per document."""
    own = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    marked = cut_lineage(fingerprints(own, "text", "fp", shingle).select("doc_id", "fp"))
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    parts = components(links(distinct.select("fp"), radius))
    roots = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component; among rows with one id, one. Rows without an id stay
    only where no row of their component has one, and then one of them."""
    found = cut_lineage(near_duplicates(docs, id_col, text_col))
    one, n, fp = fresh(docs, "one", "n", "fp")
    own = [col(c) for c in docs.columns]
    chosen = cut_lineage(found.filter("doc_id = component_id").groupBy(F.col("doc_id").alias(one)).agg(F.count(F.lit(1)).alias(n)))
    kept = docs.join(chosen.filter(col(n) == 1), col(id_col) == col(one), "left_semi").select(*own)
    # the texts are read again only where rows of these two rare kinds exist
    if not chosen.filter(col(n) > 1).isEmpty():
        repeated = docs.join(chosen.filter(col(n) > 1), col(id_col) == col(one), "left_semi")
        kept = kept.unionByName(repeated.dropDuplicates([id_col]).select(*own))
    lonely = found.filter("component_id is null").select(F.col("fp").alias(one)).distinct()
    if not lonely.isEmpty():
        nameless = fingerprints(docs.filter(col(id_col).isNull()), text_col, fp).join(lonely, col(fp) == col(one))
        kept = kept.unionByName(nameless.dropDuplicates([fp]).select(*own))
    return kept
