import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

# Nulls, empty and blank texts, a very long one, ties, repeated rows and ids, a null id.
LONG = " ".join(f"word{n % 4999} Tail{n % 7}." for n in range(20_000))
ODD = [
    (5, "The quick brown fox jumps over the lazy dog, said password=abcdef1234567890.", "a"),
    (6, "THE QUICK BROWN FOX jumps over the lazy dog, said password=abcdef1234567890.", "a"),
    (7, "the quick brown fox jumps over the lazy dog, said password=abcdef1234567890.", None),
    (1, None, "b"),
    (2, "", "b"),
    (3, " \t\n ", None),
    (4, LONG, "b"),
    (8, "É élan", "c"),
    (9, "é élan", "c"),
    (10, "one", "c"),
    (10, "one", "c"),
    (11, "one two", "a"),
    (None, "mail joe@example.com or +1 (619) 555-0053 or 4111 1111 1111 1111 at 10.0.0.1", "a"),
    (None, "another row without an id", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with further columns named like those the operators make."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    names = "id key row n h part tail score ids position block slot bands digest root kind _bucket _id"
    return df.select("*", *(F.lit("x").alias(c) for c in names.split()))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
