import pytest
from pyspark.sql import functions as F

ODD = [
    (1, "plain words in a row here", "en", "s", 25),
    (1, "plain words in a row here", "en", "s", 25),
    (None, "plain words in a row here", None, None, None),
    (2, None, "en", None, None),
    (3, "", None, "s", 0),
    (4, " \t\n ", "en", "s", 4),
    (5, "word " * 30_000, "en", "s", 150_000),
    (6, "x" * 70_000, "en", "s", 70_000),
    (7, "12345 !!! ???", "en", "s", 13),
    (8, "Ünïcode 日本語 текст 😀 mixed \x00 text", "en", "s", 30),
    (1, "another text under the same id", "en", "s", 30),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns with clashing names."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit("clash") for c in ("score", "size", "shard", "found", "row", "key", "items", "spans", "n", "h1", "held_out", "contaminated", "kept", "n_tokens", "block", "id", "root", "part")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
