import pytest
from hard_words import thue_morse
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text, and columns that could clash."""
    long_text = " ".join(f"w{i % 997}x{i // 997}" for i in range(60_000))
    copy = " ".join(f"copied{i}" for i in range(40))
    rows = [
        (1, copy), (2, copy), (2, copy), (3, copy + " more words at the end"), (None, copy), (None, copy), (4, None), (None, None), (5, ""),
        (6, " \t\n\x0b\x0c\r "), (7, long_text), (8, "short"), (9, "é ß 日本語 \U0001f600 naïve"), (10, "short"), (11, copy.replace(" ", "\n\n")),
        *[(12 + i, " ".join([*(f"before{k}" for k in range(19)), word])) for i, word in enumerate(thue_morse(11))],
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = ["bucket", "block", "digest", "width", "copies", "set_id", "component", "root", "keys", "key", "_row", "_row_key", "spans", "kind", "word", "batch"]
    return df.withColumns({c: F.lit("mine") if c == "_row_key" else F.lit(None).cast("string") for c in clash})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
