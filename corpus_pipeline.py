"""Training-corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that its
predecessor kept; its result is written as Parquet and read again by the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from churnspark.llm import decontamination, line_dedup, packing, quality_rules, simhash
from churnspark.llm.common import table
from churnspark.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.keep_clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that occur earlier; documents with no text left go."""
    return line_dedup.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows make up less than a twentieth."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 1024 tokens."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Tokenisation, XXH64 and the packing heuristic have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage results go to the shared checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{i}-{name}")
            docs = spark.read.parquet(f"{base}/{i}-{name}")
    return docs
