import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("uid", StringType()),  # names that operators use inside
        StructField("row", StringType()),
        StructField("k", StringType()),
    ]
)


@pytest.fixture(scope="session")
def docs_frame(spark):
    """A documents table, with extra columns of clashing names, from ``(doc_id, text)`` pairs."""

    def build(pairs):
        rows = [(i, t, None, "src0", len(t or ""), "u", None, "k") for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return build
