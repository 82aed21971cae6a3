import pytest
from pyspark.sql import types as T

from cohortlens.llm.shipping import ship

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Columns of users may have any name, also one that an operator uses inside.
        *[T.StructField(c, T.StringType()) for c in ("h", "size", "node", "block", "th", "row", "score")],
    ]
)
_COMMON = "the quick brown fox jumps over the lazy dog and runs far away from here today"
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n", None, None),
    (4, "word", "de", "b"),
    (5, _COMMON, "en", "b"),
    (6, _COMMON, "en", "b"),
    (6, _COMMON, "en", "b"),
    (7, _COMMON.upper(), "en", None),
    (8, "lorem " * 30000 + "end", "la", "c"),
    (9, "x" * 200000, None, "c"),
    (10, "ß é 漢字 \U0001f600 token = \"abcdefghijkl0123456789ab\"", "de", "c"),
    (None, "some text without any number", "en", "a"),
    (11, "12345 67890 !!!", "en", "d"),
    (-3, _COMMON + " again", "en", "d"),
]


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    return llm.createDataFrame([(*r, *["x"] * 7) for r in ODD], DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def corpus(llm):
    return llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
