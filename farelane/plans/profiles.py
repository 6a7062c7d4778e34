"""Column profiles that are stored per file and merged.

One pass over new files gives a row per file and column: rows, missing values,
smallest and largest value as text, and two sketches of fixed size, for the number
of distinct values and for quantiles of numbers.  The rows are kept; any set of
files is profiled by merging its rows, without reading the files again.  The
merged sketch for distinct values has the registers of one built over all files at
once; only the estimate of a sketch that was never merged also uses the order
of its input, so the two estimates agree within their error, not to the digit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.constants import FILE_MONTH
from farelane.functions.exprs import nan_as_null

#: log2 of the registers of a distinct-count sketch: 16 KB or less, about 0.8 % standard error
LG_K = 14


def profile_files(df: DataFrame, cols: Sequence[str] | None = None, file_month: str = FILE_MONTH) -> DataFrame:
    """``file_month, column, n_rows, n_null, min_text, max_text, distinct_sketch, quantile_sketch`` in one pass.

    NaN counts as missing.  The quantile sketch is NULL for columns that are no numbers.
    """
    cols = [c for c in (cols or df.columns) if c != file_month]
    types = {f.name: f.dataType for f in df.schema.fields}
    clean = nan_as_null(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        number = isinstance(types[c], T.NumericType)
        aggs += [
            F.count(x).alias(f"_n{i}"),
            F.min(x).cast("string").alias(f"_lo{i}"),
            F.max(x).cast("string").alias(f"_hi{i}"),
            F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x)), LG_K).alias(f"_d{i}"),
            (F.kll_sketch_agg_double(x.cast("double")) if number else F.lit(None).cast("binary")).alias(f"_q{i}"),
        ]
    wide = clean.groupBy(file_month).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.col("n_rows") - F.col(f"_n{i}")).alias("n_null"),
                F.col(f"_lo{i}").alias("min_text"),
                F.col(f"_hi{i}").alias("max_text"),
                F.col(f"_d{i}").alias("distinct_sketch"),
                F.col(f"_q{i}").alias("quantile_sketch"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(file_month, "n_rows", F.explode(rows).alias("r")).select(file_month, "r.column", "n_rows", "r.n_null", "r.min_text", "r.max_text", "r.distinct_sketch", "r.quantile_sketch")


def store_profiles(profiles: DataFrame, path: str, file_month: str = FILE_MONTH) -> str:
    """Add files to the stored profiles; files that are there already are replaced, others are not touched."""
    profiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(file_month).parquet(path)
    return path


def stored_profiles(spark: SparkSession, path: str, file_month: str = FILE_MONTH) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn(file_month, F.col(file_month).cast("string"))


def merged_profile(profiles: DataFrame, probs: Sequence[float] = ()) -> DataFrame:
    """Per column over all given files: ``n_files, n_rows, n_null, n_unique`` (estimated), and ``quantiles`` (estimated) if asked for."""
    out = profiles.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_unique"),
        *([F.kll_merge_agg_double("quantile_sketch").alias("_q")] if probs else []),
    )
    if probs:
        values = F.array(*[F.kll_sketch_get_quantile_double("_q", F.lit(float(p))) for p in probs])
        out = out.withColumn("quantiles", F.when(F.kll_sketch_get_n_double("_q") > 0, values)).drop("_q")
    return out
