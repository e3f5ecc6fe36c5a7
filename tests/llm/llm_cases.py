import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def awkward_rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, equal texts."""
    body = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    long = " ".join(f"word{i % 977}x{i}" for i in range(20000))
    rows = [(1, body, "en", "s1", 3), (2, body, "en", "s2", 3), (3, body + " phi", "en", "s1", 3), (3, body + " phi", "en", "s1", 3),
            (4, None, None, None, None), (5, "", "en", "s2", 0), (6, "  \n\t ", "en", None, 5), (7, long, "en", "s3", 9),
            (None, body, "en", "s1", 3), (None, None, None, None, None), (8, "one", "en", "s3", 3), (9, "Üß 你好 мир 😀 é", "de", "s4", 1),
            (10, "header line of all\n" + body + " chi psi", "en", "s5", 2), (11, "header line of all\nother words here", "en", "s6", 2)]
    return rows


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    # columns whose names the operators use inside, or give back themselves
    from pyspark.sql import functions as F
    extra = {c: F.lit("clash") for c in ("_k", "_h", "_d", "_t", "size", "shard", "score", "n_lines", "label", "_bands", "b", "copy",
                                  "_gone", "_map", "_matches", "_rest", "_nth", "_copy", "_size", "_taken", "_crc")}
    return make_docs(awkward_rows()).withColumns(extra)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])
