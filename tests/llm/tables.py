import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session", autouse=True)
def shared_code(spark):
    import __spark_entry__

    __spark_entry__.share_code(spark)


DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents from (id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def sf_table(spark, tmp_path_factory):
    """A folder with the given tables as parquet, as the registered queries read them."""

    def make(**tables):
        d = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return make
