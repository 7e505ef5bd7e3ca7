import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOC = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("_row", StringType()),
        StructField("score", StringType()),
        StructField("toxic", LongType()),
        StructField("spans", StringType()),
    ]
)
LONG = "word " * 60_000


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names clash with those that operators make."""

    def make(rows):
        full = [(i, t, lang, "s", None if t is None else len(t), "r", "x", 7, "y") for i, t, lang in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Missing, empty, blank, very long and repeated texts, a missing id and language."""
    return make_docs(
        [
            (1, None, "en"),
            (2, "", "en"),
            (3, " \n\t ", None),
            (4, LONG, "en"),
            (5, "the same text here", "fr"),
            (5, "the same text here", "fr"),
            (None, "no id at all 12", "en"),
            (6, "12345 !!! ???", "de"),
        ]
    )
