import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Rows of documents: null text, null id, empty and blank texts, repeated rows and ids,
    and columns whose names clash with what operators add."""
    base = "the quick brown fox jumps over the lazy dog and runs away from every other animal it sees "
    long = " ".join(f"word{i} of{i % 7}" for i in range(3000))
    rows = [(1, base * 3, "en", "a", 5), (2, base * 3, "en", "a", 5), (2, base * 3, "en", "a", 5),
            (3, base * 3 + "today", None, "a", None), (4, None, "en", None, None), (5, "", "en", "a", 0),
            (6, " \n\t ", "en", "a", 0), (None, base * 3, "en", "a", 1), (None, None, None, None, None),
            (7, long, "fr", "b", 1), (8, long + " end", "fr", "b", 1), (9, "one", "en", "b", 3),
            (10, "ONE", "en", "b", 3), (11, "été\xa0日本 🙂 <|endoftext|> a  b", "fr", "b", 9)]
    clash = [(*r, "x", 1, 2.0, True) for r in rows]
    return spark.createDataFrame(clash, DOCS + ", ids string, n_words int, score double, kept boolean")


@pytest.fixture
def no_docs(spark, docs):
    return spark.createDataFrame([], T.StructType(docs.schema.fields))
