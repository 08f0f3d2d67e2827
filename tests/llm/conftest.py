import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Columns that clash with names the operators use inside.
        T.StructField("key", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("label", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text), (doc_id, text, lang) or (doc_id, text, lang, source)."""
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4] if len(row) == 2 else (*row, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), "k", 0.5, None))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, very short and long texts, repeated rows, several scripts."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, "a"),
        (5, "a" * 3000),
        (6, "ab " * 700),
        (7, "Ünïcödé 漢字 🙂 x@y.de 1.2.3.4"),
        (7, "Ünïcödé 漢字 🙂 x@y.de 1.2.3.4"),
        (8, "the cat sat on the mat and then the cat sat on the mat again " * 4),
        (9, "The Cat sat on the mat and then the cat sat on the mat again " * 4),
        (None, "a row without an id"),
    ]
