"""The corpus pipeline: stages over ``documents``, each calling one operator of ``egoline.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it
keeps; ``run`` writes every result as Parquet and reads it again as the next
stage's input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from egoline.llm import decontaminate, jaccard_join, pii, quality, sentencepiece_chunks
from egoline.llm.common import documents, written

PIECES = "piece_bpe_32k.model"


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier distance reject go."""
    return quality.judge(docs, keep=docs.columns).filter("kept").select(*docs.columns)


#: Near duplicates share 0.8 of their shingles of five words.
NEAR = jaccard_join.Rule(words=5, num=80, den=100)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents, the one with the smallest id stays."""
    return jaccard_join.representatives(docs, rule=NEAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return recounted(decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to marks."""
    return recounted(pii.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their SentencePiece ids, and the text that these decode to."""
    return sentencepiece_chunks.encode_decode(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", redact_pii),
    ("SentencePiece", encode),
]

#: SQL can express neither the concentration steps nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
