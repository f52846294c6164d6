"""From raw documents to token ids: five stages, each written and read again before the next.

1. language_id      rows without a letter in a known language go
2. near_dedup       one row of each group of near duplicates stays (five-word shingles, 0.8)
3. decontamination  rows that contain a benchmark item go
4. secrets          found secrets are masked in the text, and n_chars follows
5. sentencepiece    doc_id, n_tokens, ids and round_trip (whether decoding gives the text)

All stages but the last return the columns of ``documents``. Each handles nulls, empty and long
texts, repeated rows and empty tables as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontamination, language_id, near_dedup, secrets, sentencepiece_codec
from weftline.llm.registry import tokenizer
from weftline.llm.runtime import settle, table

#: Shingle similarity, in percent, from which two documents are one.
SIMILAR = 80


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs, language_id.learn(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs, SIMILAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(docs, tokenizer("piece_bpe_32k.model")).drop("decoded")


STAGES = [
    ("language_id", identify),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]

#: Sketches, learned models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
