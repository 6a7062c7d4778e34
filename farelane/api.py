"""Stage-level API with the familiar pipeline function names.

Each name maps onto the Spark operators: frames are DataFrames, paths are
read / written with Spark (monthly tables partitioned by ``file_month``), and
nothing is collected to the driver.  Where the original returned Python
dicts (lookup maps, split buckets of file names), the Spark form returns a
DataFrame or works on file-name metadata only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.constants import DEFAULT_SEED, IGNORE_SPLIT, MONTH_FILE_GLOB, SAMPLE_ROWS_PER_MONTH, SPLIT_RULES
from farelane.functions.calendar import calendar_flags, holiday_calendar
from farelane.functions.exprs import haversine_km
from farelane.ml import models, preprocess
from farelane.operators import clean, features, geometry, joins, sampling, schema
from farelane.plans import jobs
from farelane.sources import monthly, sinks

# ---------------------------------------------------------------- names and splits
parse_year_month = monthly.parse_year_month
ym_from_name = monthly.parse_year_month


def assign_split(name: str) -> str:
    """Split of a monthly file name (metadata only)."""
    y, m = parse_year_month(name)
    for split, year, lo, hi in SPLIT_RULES:
        if y == year and lo <= m <= hi:
            return split
    return IGNORE_SPLIT


def list_month_files(spark: SparkSession, src_dir: str, pattern: str = MONTH_FILE_GLOB) -> list[str]:
    return jobs.list_month_files(spark, src_dir, pattern)


def bucket_files_by_split(files: Iterable[str]) -> dict[str, list[str]]:
    """The files of each split of ``SPLIT_RULES``; other files are left out."""
    named = [(assign_split(f), f) for f in files]
    return {rule[0]: [f for split, f in named if split == rule[0]] for rule in SPLIT_RULES}


# ---------------------------------------------------------------- schema and cleaning stages
def check_schema(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return schema.schema_drift(schema.column_table(spark, files))


def column_normalize_and_save(spark: SparkSession, files: Sequence[str], save_path: str) -> str:
    _, df = jobs.read_raw_months(spark, files)
    return sinks.write_months(df, save_path)


def year_check_and_save(spark: SparkSession, src: str, dst: str) -> str:
    return sinks.write_months(clean.month_filter(monthly.scan_months(spark, src)), dst)


def drop_impute_missing(spark: SparkSession, src: str, dst: str) -> str:
    return sinks.write_months(clean.missing_policy(monthly.scan_months(spark, src)), dst)


def outlier_removal(spark: SparkSession, src: str, dst: str) -> str:
    return sinks.write_months(clean.range_filter(monthly.scan_months(spark, src)), dst)


# ---------------------------------------------------------------- zones and features
def load_zone_centroids(vertices: DataFrame) -> DataFrame:
    return geometry.zone_centroids(vertices).select("LocationID", "lon", "lat")


fix_location_ids = clean.fix_locations
add_zone_centroids = joins.join_centroids


def build_lookup_maps(spark: SparkSession, lookup_csv: str) -> DataFrame:
    """The zone lookup as a (deduplicated on use) DataFrame instead of two dicts."""
    return monthly.read_zone_lookup(spark, lookup_csv)


def haversine_distance(lon1, lat1, lon2, lat2) -> Column:
    return haversine_km(lon1, lat1, lon2, lat2)


def engineer_trip_features(df: DataFrame, lookup: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    hol = holiday_calendar(df.sparkSession) if holidays is None else holidays
    return features.engineer_features(df, calendar_flags(hol), lookup=lookup)


def build_and_save_features(
    spark: SparkSession,
    src: str,
    dst: str,
    lookup: DataFrame,
    zones: DataFrame | None = None,
    holidays: DataFrame | None = None,
) -> str:
    hol = holiday_calendar(spark) if holidays is None else holidays
    return sinks.write_months(features.build_features(monthly.scan_months(spark, src), hol, lookup, zones), dst)


# ---------------------------------------------------------------- sampling
def load_concat_fixed_n(
    df: DataFrame,
    split_key: str,
    sample_rows_per_month: Mapping[str, int] = SAMPLE_ROWS_PER_MONTH,
    seed: int = DEFAULT_SEED,
    key: str = "trip_id",
) -> DataFrame:
    n = sampling.rows_of_split(sample_rows_per_month, split_key)
    part = sampling.assign_split(df).where(F.col("split") == split_key).drop("split")
    return sampling.sample_fixed_n(part, n, key, seed)


def build_splits(
    df: DataFrame,
    sample_rows_per_month: Mapping[str, int] = SAMPLE_ROWS_PER_MONTH,
    seed: int = DEFAULT_SEED,
    key: str = "trip_id",
) -> DataFrame:
    return sampling.build_splits(df, sample_rows_per_month, key, seed)


def save_splits(df: DataFrame, out_dir: str) -> str:
    return sinks.write_splits(df, out_dir)


# ---------------------------------------------------------------- feature pipeline and training
build_preprocess = preprocess.build_preprocess
prepare_features = preprocess.prepare_features
split_xy = preprocess.split_xy
fit_preprocess = preprocess.fit_preprocess
transform = preprocess.transform
save_preprocess = preprocess.save_preprocess


def build_and_save_preprocess(spark: SparkSession, splits_path: str, artifacts_dir: str) -> str:
    train = spark.read.parquet(splits_path).where(F.col("split") == "train")
    model = preprocess.fit_preprocess(preprocess.build_preprocess(), train)
    return preprocess.save_preprocess(model, f"{artifacts_dir}/preprocess")


def build_transform_splits(spark: SparkSession, data_dir: str, artifact_dir: str) -> list[DataFrame]:
    model = PipelineModel.load(f"{artifact_dir}/preprocess")
    parts = preprocess.transform_splits(spark.read.parquet(data_dir), model)
    return [parts["train"], parts["val"], parts["test"]]


def optimize_lgbm(train: DataFrame, val: DataFrame, n_trials: int = 50, timeout: float | None = None,
                  seed: int = DEFAULT_SEED, **kwargs):
    """Seeded random search over the boosted-tree ranges; returns ``(best_rmse, best_params)``."""
    best, params, _ = models.param_search(train, val, n_trials, timeout, seed, **kwargs)
    return best, params


__all__ = [
    "load_zone_centroids", "fix_location_ids", "add_zone_centroids", "build_lookup_maps", "haversine_distance",
    "engineer_trip_features", "build_and_save_features", "build_preprocess", "prepare_features", "split_xy",
    "fit_preprocess", "transform", "save_preprocess", "build_and_save_preprocess", "ym_from_name", "assign_split",
    "list_month_files", "bucket_files_by_split", "load_concat_fixed_n", "build_splits", "save_splits", "check_schema",
    "column_normalize_and_save", "parse_year_month", "year_check_and_save", "drop_impute_missing", "outlier_removal",
    "build_transform_splits", "optimize_lgbm",
]
