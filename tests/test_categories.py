"""Category table: the indices of an alphabetical StringIndexer, many categories, saved pipelines."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from farelane.ml import preprocess as P
from farelane.ml.categories import TableIndexer, category_table


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_indices_are_those_of_a_string_indexer(spark, partitions):
    df = spark.range(3000).select(
        F.concat(F.lit("v"), (F.col("id") * 7919 % 211).cast("string")).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("ä"), (F.col("id") % 40).cast("string"))).alias("b"), F.lit("one").alias("c")
    )
    got = {(r["column"], r["value"]): r["index"] for r in category_table(df, ["a", "b", "c"], partitions).collect()}
    for c in ("a", "b", "c"):
        labels = StringIndexer(inputCol=c, outputCol="i", stringOrderType="alphabetAsc").fit(df).labels
        assert {v: i for (col, v), i in got.items() if col == c} == {v: i for i, v in enumerate(labels)}


def test_same_features_as_with_labels_and_persists(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "x", "k"), (2.0, "y", None), (3.0, None, "k"), (4.0, "z", "l")], "n double, c string, d string")
    other = spark.createDataFrame([(2.0, "z", "l"), (2.0, None, "m"), (5.0, "new", None)], "n double, c string, d string")
    plain = P.build_preprocess(["n"], ["c", "d"]).fit(train)
    table = P.build_preprocess(["n"], ["c", "d"], category_path=str(tmp_path / "cats")).fit(train)
    again = PipelineModel.load(P.save_preprocess(table, str(tmp_path / "pre")))

    def vectors(model, df):
        return sorted((str(r["c"]), str(r["d"]), tuple(r["v"])) for r in model.transform(df).select("c", "d", vector_to_array("features").alias("v")).collect())

    for df in (train, other):
        assert vectors(plain, df) == vectors(table, df) == vectors(again, df)


def test_many_categories_stay_off_the_driver(spark, tmp_path):
    df = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("v"), F.col("id"))
    model = TableIndexer(inputCols=["v"], outputCols=["i"], path=str(tmp_path / "t")).fit(df)
    assert model.getOrDefault("sizes") == [60_000]
    out = model.transform(df)
    assert out.select("i").distinct().count() == 60_000
    assert out.agg(F.min("i"), F.max("i")).first()[:] == (0.0, 59_999.0)
    assert "vals" not in out.schema["i"].metadata["ml_attr"]
    pipe = P.build_preprocess([], ["v"], category_path=str(tmp_path / "u")).fit(df)
    row = pipe.transform(df.limit(1)).first()
    assert row["features"].size == 60_000 and row["features"].numNonzeros() == 1


def test_empty_column(spark, tmp_path):
    train = spark.createDataFrame([(None, "a")], "v string, w string")
    model = TableIndexer(inputCols=["v", "w"], outputCols=["i", "j"], path=str(tmp_path / "t")).fit(train)
    assert model.getOrDefault("sizes") == [0, 1]
    assert model.transform(train).select("i", "j").first()[:] == (0.0, 0.0)
