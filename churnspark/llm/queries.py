"""Registered queries of the text operators, one for each operator, over the whole ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.llm import (decontamination, divergence_audit, drift_kmeans, language_id, line_dedup, packing, pii, quality_rules,
                            quartile_digest, secret_scan, simhash, substring_dedup, suffix_tree_lm)
from churnspark.llm.common import crc32_of_id, digest, table
from churnspark.llm.oracle import ORACLE  # noqa: F401


def op1_pii(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = pii.personal_data(docs, pii.train(docs))
    return found.select("doc_id", "pii.n_email", "pii.n_ip", "pii.n_card", "pii.n_phone", digest(F.col("pii.base")).alias("base_sha256"),
                        "pii.spans", "pii.n_added")


def op2_decontamination(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, d, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest(F.array_join("items", ",")).alias("items_sha256"),
                        "contaminated")


def op3_simhash(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_suffix_tree_lm(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return suffix_tree_lm.score(docs, F.pmod(crc32_of_id(F.col("doc_id")), F.lit(10)) == 0)


def op5_substring_dedup(spark, d):
    done = substring_dedup.remove_substrings(table(spark, d, "documents"))
    return done.select("doc_id", "n_words", "n_removed", digest(F.col("kept")).alias("kept_sha256"))


def op6_secret_scan(spark, d):
    found = secret_scan.secret_spans(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind_no"] < 3)

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, digest(secret_scan.listing(base)).alias("base_sha256"),
                        secret_scan.listing(F.col("secrets")).alias("spans"))


def op7_quality_rules(spark, d):
    q = quality_rules.quality_rules(table(spark, d, "documents").select("doc_id", "text"))
    return q.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
        "n_removed_lines", "n_lost_words")])


def op8_line_dedup(spark, d):
    done = line_dedup.remove_repeated(table(spark, d, "documents").select("doc_id", "text"))
    return done.select("doc_id", "dedup.n_lines", "dedup.n_removed", "dedup.n_chunks",
                       F.char_length("dedup.text").cast("long").alias("kept_chars"),
                       digest(F.coalesce("dedup.text", F.lit(""))).alias("kept_sha256"))


def op9_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), packing.tokenizer_path())


def op10_language_id(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    held = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(4)) == 2
    training = language_id.training_text(docs, ~held)
    return language_id.identify(docs.select("doc_id", "text", held.alias("held_out")), training).select(
        "doc_id", "held_out", "language.lang_pred", "language.score")


def op11_quartile_digest(spark, d):
    return quartile_digest.edit_audit(table(spark, d, "documents").select("doc_id", "text"))


def op12_drift_kmeans(spark, d):
    done = drift_kmeans.cluster(table(spark, d, "embeddings").select("vec_id", "embedding"))
    if done is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    return drift_kmeans.report(done).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                                            "centroid_sha256")


def op13_source_divergence(spark, d):
    return divergence_audit.source_divergence(table(spark, d, "documents").select("lang", "source", "text"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_suffix_tree_lm": op4_suffix_tree_lm,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_packing": op9_packing,
    "op10_language_id": op10_language_id,
    "op11_quartile_digest": op11_quartile_digest,
    "op12_drift_kmeans": op12_drift_kmeans,
    "op13_source_divergence": op13_source_divergence,
}
