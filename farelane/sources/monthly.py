"""Monthly trip-file sources (A1-A4).

Trip data arrives as one parquet file per calendar month named
``yellow_tripdata_YYYY-MM.parquet``; the file's month is data.  Everything
here reads lazily: Catalyst prunes columns into the scan and pushes filters
into the parquet reader.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.constants import FILE_MONTH, MONTH_FILE_GLOB

#: a calendar month between other characters than digits, for Java's and Python's regular expressions alike
MONTH_TOKEN = r"(?<![0-9])[0-9]{4}-(?:0[1-9]|1[0-2])(?![0-9])"
NO_MONTH = "no calendar month (YYYY-MM) in file name "


def month_token(path: str) -> str:
    """The 'YYYY-MM' in the last part of a path; ValueError without one."""
    base = path.rstrip("/").rpartition("/")[2]
    found = re.findall(MONTH_TOKEN, base)
    if found:
        return found[0]
    raise ValueError(NO_MONTH + base)


def parse_year_month(name: str) -> tuple[int, int]:
    """(year, month) of a monthly file, from its name."""
    year, _, month = month_token(name).partition("-")
    return int(year), int(month)


def file_month_of(name: Column) -> Column:
    """'YYYY-MM' parsed from a file-name column; raises at run time when absent (A2)."""
    month = F.regexp_extract(name, MONTH_TOKEN, 0)
    return F.when(month == "", F.raise_error(F.concat(F.lit(NO_MONTH), name))).otherwise(month)


def scan_months(
    spark: SparkSession,
    src_dir: str,
    pattern: str = MONTH_FILE_GLOB,
    columns: list[str] | None = None,
) -> DataFrame:
    """All monthly files under ``src_dir`` as one DataFrame with ``file_month`` (A1 + A2 + A3).

    Two layouts are accepted: flat monthly files named by month (the month is
    parsed from ``_metadata.file_name``) and the hive layout written by
    :func:`farelane.sources.sinks.write_months` (``file_month=YYYY-MM``).
    A missing directory or an empty match raises ``AnalysisException``.
    """
    reader = spark.read
    partitioned = _is_partitioned(spark, src_dir)
    if not partitioned:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.parquet(src_dir)
    if partitioned:
        df = df.withColumn(FILE_MONTH, F.col(FILE_MONTH).cast("string"))
    else:
        df = df.withColumn(FILE_MONTH, file_month_of(F.col("_metadata.file_name")))
    if columns is not None:
        df = df.select(*columns, FILE_MONTH)
    return df


def _is_partitioned(spark: SparkSession, src_dir: str) -> bool:
    """True when ``src_dir`` holds ``file_month=...`` folders (hive layout)."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # noqa: BLE001 - no JVM access: detect from the read schema instead
        return FILE_MONTH in spark.read.parquet(src_dir).columns
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(src_dir)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return False
    return any(st.getPath().getName().startswith(f"{FILE_MONTH}=") for st in fs.listStatus(path))


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV (A4): header names trimmed, ``LocationID`` as int, ``N/A`` as null.

    A row order column ``_row`` is kept so that duplicate ids resolve to the
    last row, as a Python dict built from the file would.
    """
    df = spark.read.option("header", True).option("nullValue", "N/A").csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    return df.select(
        F.col("LocationID").cast("int").alias("LocationID"),
        *[F.col(c) for c in df.columns if c != "LocationID"],
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn(
        "LocationID",
        F.when(F.col("LocationID").isNotNull(), F.col("LocationID")).otherwise(
            F.raise_error(F.lit("zone lookup has a LocationID that is not an integer"))
        ),
    )


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by a key (A9): a top-k, planned as TakeOrderedAndProject."""
    return df.orderBy(*order_by).limit(n)
