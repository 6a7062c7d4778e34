"""Category dictionary as a table (I4, I5): indices for columns of any number of categories.

``StringIndexer`` brings all labels to the driver and keeps them in the model
and in column metadata.  Here the labels stay in a table (column, value, index)
that is joined: categories are dealt by ranges of (column, value), numbered in
order within each range, and shifted by the number of categories of the column
in earlier ranges.  The driver holds one number per column.  Indices are those
of an alphabetical ``StringIndexer`` that keeps unseen values: these get the
index after the last category, which ``OneHotEncoder(dropLast=True)`` turns into
zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.sources import sinks

_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id count the rows of a partition


def category_table(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``column, value, index`` of every value of every text column; indices begin at 0 for each column, in the order of the text."""
    long = None
    for c in columns:
        part = df.select(F.lit(c).alias("column"), F.col(c).alias("value")).filter(F.col("value").isNotNull()).distinct()
        long = part if long is None else long.unionByName(part)
    dealt = long.repartitionByRange(partitions, "column", "value") if partitions else long.repartitionByRange("column", "value")
    ordered = dealt.sortWithinPartitions("column", "value").select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND(_IN_PARTITION).alias("_i"))
    ordered = sinks.materialize(ordered, "categories")
    # one row per column and range
    ranges = ordered.groupBy("column", "_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("column").orderBy("_p")) - F.col("_n")
    shifts = ranges.select("column", "_p", (before - F.col("_first")).alias("_shift"))
    return ordered.join(shifts, ["column", "_p"]).select("column", "value", (F.col("_i") + F.col("_shift")).alias("index"))


class _TableParams(HasInputCols, HasOutputCols):
    path = Param(Params._dummy(), "path", "folder of the category table", TypeConverters.toString)


class TableIndexer(Estimator, _TableParams, DefaultParamsReadable, DefaultParamsWritable):
    """Writes the category table of the input columns under ``path`` (a folder that outlives the session, for saved models)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, path=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> TableIndexerModel:
        spark, cols = df.sparkSession, self.getInputCols()
        path = self.getOrDefault("path") if self.isDefined("path") else sinks.shared_dir(spark, "category_table")
        category_table(df, cols).write.mode("overwrite").partitionBy("column").parquet(path)
        counts = {r[0]: r[1] for r in _read(spark, path).groupBy("column").count().collect()}  # one row per column
        return TableIndexerModel(inputCols=cols, outputCols=self.getOutputCols(), path=path, sizes=[counts.get(c, 0) for c in cols])


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, index long, column string").parquet(path)


class TableIndexerModel(Model, _TableParams, DefaultParamsReadable, DefaultParamsWritable):
    sizes = Param(Params._dummy(), "sizes", "number of categories of each column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, path=None, sizes=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        """A join per column; the planner broadcasts small dictionaries and shuffles large ones."""
        table = _read(df.sparkSession, self.getOrDefault("path"))
        out, columns = df, df.columns
        indices = []
        for i, (c, o, size) in enumerate(zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("sizes"), strict=True)):
            own = table.filter(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("index").alias(f"_i{i}"))
            out = out.join(own, out[c] == F.col(f"_v{i}"), "left")
            known = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
            indices.append(F.coalesce(F.col(f"_i{i}"), F.lit(size)).cast("double").alias(o, metadata=known))
        return out.select(*columns, *indices)
