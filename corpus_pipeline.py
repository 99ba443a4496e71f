"""Training text from raw documents, stage by stage; each stage reads what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, language_id, minhash, toxicity
from tidemark.llm.registry import table
from tidemark.runtime import ensure_checkpoint_dir

VOCABULARY = "byte_bpe_50k.tiktoken"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents with a score from the threshold on go."""
    return toxicity.keep_civil(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on shingles of five words: one document of each group stays."""
    return minhash.keep_one(docs, words=5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a passage of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids of every text, with digests of ids and of the text decoded from them."""
    return bpe.encode(docs, bpe.Vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))


STAGES = [
    ("language_id", identified),
    ("toxicity", civil),
    ("minhash_near_dedup", deduplicated),
    ("benchmark_decontamination", decontaminated),
    ("byte_bpe", encoded),
]

#: The stages learn models and follow links, which SQL can't state; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written to the shared folder and read again."""
    import uuid

    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{home}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
