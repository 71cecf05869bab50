import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """A documents table from texts, or from (doc_id, text[, source]) rows."""
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = (*r, "s")[:3] if isinstance(r, tuple) else (i, r, "s")
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    return [(None, None, None), (None, "no id here", "s"), (1, "", "s"), (2, " \t\n", None), (3, None, "s"),
            (4, "a b c d e f", "s"), (4, "a b c d e f", "s"), (5, "A b C d e F", "s"), (6, "a b c d e f", "t"),
            (7, "word " * 60_000, "s"), (8, "x" * 200_000, "s"), (9, "é ü 中 \U0001F600 ñ", "s")]
