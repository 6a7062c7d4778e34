"""Sinks (A5-A8) and the shared scratch location.

Jobs write to the folder the cluster names in ``spark.checkpoint.dir``; a
local default is only set when the session has none (tests, bench).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.constants import FILE_MONTH


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the session's shared checkpoint folder."""
    from farelane.session import context_checkpoint_dir

    base = spark.conf.get("spark.checkpoint.dir", None) or context_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; use farelane.session.get_spark() or set it")
    base = str(base).rstrip("/")
    return "/".join([base, *parts, uuid.uuid4().hex[:12]])


def write_months(df: DataFrame, out: str, compression: str = "zstd", files_per_month: int | None = None) -> str:
    """Parquet partitioned by ``file_month`` (A5); one directory per month.

    By default no shuffle is added: each task writes the months it holds.  With
    ``files_per_month`` rows are spread by (month, deterministic row hash) so a
    month is written by that many tasks, never by a single one; the hash keeps
    the layout identical when a lost task is recomputed.
    """
    if files_per_month:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_month))
        df = df.repartition(F.col(FILE_MONTH), salt)
    (
        df.write.mode("overwrite")
        .partitionBy(FILE_MONTH)
        .option("compression", compression)
        .parquet(out)
    )
    return out


def write_splits(df: DataFrame, out: str, split_col: str = "split") -> str:
    """Write the train / val / test rows partitioned by split (A6); absent splits write nothing."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(out)
    return out


def write_metrics(df: DataFrame, out: str) -> str:
    """Small result tables (leaderboard, trial log) as one CSV and one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(f"{out}/json")
    written = df.sparkSession.read.schema(df.schema).json(f"{out}/json")  # computed once, the second format comes from the first
    written.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/csv")
    return out


def write_json_text(spark: SparkSession, payload: dict, out: str) -> str:
    """A single JSON document (best params, final metrics) through the Hadoop file system."""
    text = F.lit(json.dumps(payload, sort_keys=True, default=str)).alias("value")
    spark.range(0, 1, 1, 1).select(text).write.mode("overwrite").text(out)
    return out


def read_json_text(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path).collect()
    return json.loads(rows[0][0])


def rewrite_stage(df: DataFrame, spark: SparkSession, stage: str) -> DataFrame:
    """Materialise a stage and return a reader over the new copy.

    Spark cannot overwrite the path it is reading, so the rewritten stage goes
    to a new location and the caller switches to it; lineage is cut there too.
    """
    out = shared_dir(spark, "stages", stage)
    df.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def write_stage(df: DataFrame, name: str = "stage") -> str:
    """Write ``df`` as parquet under the shared checkpoint folder; returns the path."""
    out = shared_dir(df.sparkSession, "materialized", name)
    df.write.mode("overwrite").parquet(out)
    return out


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of an expensive intermediate that several later scans
    need (a sampler reads its input once per level); the copy lives on the
    cluster's shared storage, so a lost executor does not lose it.
    """
    return df.sparkSession.read.parquet(write_stage(df, name))
