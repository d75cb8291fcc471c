import pytest

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
# column names that the operators use themselves
CLASHING = ("words", "key", "pos", "sid", "q", "row", "budget", "hit", "th", "c_id", "gone_id", "tokens")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids from 0) or (id, text, lang) rows, with clashing extra columns."""
    def make(rows, extra=True):
        full = [(i, r, "en", "src0") if not isinstance(r, tuple) else (*r, "src1") for i, r in enumerate(rows)]
        df = spark.createDataFrame([(a, t, l, s, len(t) if t else None) for a, t, l, s in full], DOCUMENTS)
        if extra:
            df = df.selectExpr("*", *(f"cast(doc_id as string) as {c}" for c in CLASHING))
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, blank and long texts, repeated rows."""
    return [(1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (None, "one two three four five", None),
            (5, "word " * 30_000, "en"), (6, "same text here for all", "de"), (6, "same text here for all", "de"),
            (7, "ÄÖÜ éè 日本語 🙂 ß", "fr"), (8, "x", "es")]


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
