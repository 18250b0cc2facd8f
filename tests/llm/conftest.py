import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids 0, 1, ...) or from (id, text, lang, source) rows."""

    def make(rows):
        full = [(i, r, "en", "src0") if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)

    return make


#: Rows every operator has to take: nulls in any column, empty and long texts, repeated rows.
AWKWARD = [(0, None, None, None), (None, "a text without an id", "en", "src1"), (2, "", "en", None),
           (3, " \n\t ", None, "src1"), (4, "word " * 40_000, "en", "src2"), (5, "twice the same row", "fr", "src0"),
           (5, "twice the same row", "fr", "src0"), (5, "the same id, another text", "de", "src0"),
           (6, "x" * 50_000, "es", "src3"), (7, "é▁ß 🙂 \u0000 ñ", "es", "src3")]


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The awkward rows with further columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ("score", "lang_pred", "kept", "n", "rid", "token", "value", "owner", "spans", "ids", "start", "h", "row", "distance")
    return awkward.select("*", *[F.lit(1).alias(n) for n in names])
