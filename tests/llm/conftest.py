import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("lang", T.StringType()),
        # clashing names of columns that operators add
        T.StructField("size", T.StringType()),
        T.StructField("secrets", T.StringType()),
        T.StructField("_key", T.StringType()),
        T.StructField("id", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        """Rows of (doc_id, text[, source]); the other columns hold something of their own."""
        return spark.createDataFrame([(*r, *["s"] * (3 - len(r)), "en", "x", None, "k", "i") for r in rows], SCHEMA)

    return make
