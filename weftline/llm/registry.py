"""The thin queries over the test tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.runtime import table

SHARDS = 16
TOP = 5


def tokenizer(name: str) -> str:
    """Where the vocabulary files are: their folder is a parameter of the installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.secrets import digests

    return digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.toxicity import learn, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), 85)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.decontamination import check

    rows = check(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.transform("items", lambda x: x["item"].cast("string")), ",", "null")
    return rows.select("doc_id", "contaminated", F.size("items").cast("long").alias("n_items"), ids.alias("item_ids"), F.array_max(F.transform("items", lambda x: x["share"])).alias("best_share"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.sentencepiece_codec import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.language_id import identify, learn

    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).drop("spans")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.pii import digests, learn

    docs = table(spark, sf_dir, "documents")
    return digests(docs, learn(docs))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftline.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), TOP)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (SELECT DISTINCT vec_id AS query_id, e AS qe FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT query_id, vec_id, CAST(list_dot_product(qe, e) AS BIGINT) AS score
  FROM q JOIN v ON v.vec_id <> q.query_id AND len(v.e) = len(q.qe)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_shards, op3_secrets, op4_toxicity, op5_near_duplicates, op6_decontamination, op7_sentencepiece, op8_language, op9_personal_data, op10_top_k)}


def oracle_sql() -> dict[str, str]:
    return {"op10_top_k": OP10_SQL}
