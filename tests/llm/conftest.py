import pytest

from pyspark.sql import functions as F

#: Documents with every edge case: nulls, blanks, long texts, ties, repeated rows and ids, clashing columns.
CLASHING = ["row", "id", "key", "size", "shard", "text_crc32", "score", "fp", "part", "border", "first"]


@pytest.fixture(scope="session")
def odd_rows():
    long_text = "very long text " * 4000
    return [
        (1, "Alpha beta gamma delta epsilon."),
        (2, "ALPHA BETA gamma delta epsilon."),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, "no id here at all"),
        (6, long_text),
        (7, long_text),
        (8, "x" * 50_000),
        (9, "café ÀÉ ümlaut 😀 你好"),
        (9, "café ÀÉ ümlaut 😀 你好"),
        (9, "another text with the same id"),
        (10, "one"),
        (11, "a b c a b c"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(3)
    named = {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.char_length("text").cast("long")}
    return docs.withColumns(named | {c: F.lit(c + "!") for c in CLASHING} | {"a.b": F.lit(1)})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def plain(rows):
    """Rows in an order of their own."""
    return sorted([tuple(r) for r in rows], key=repr)
