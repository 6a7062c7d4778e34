"""Stage API over flat monthly files, with schema drift, against the operator chain."""

from pyspark.sql import functions as F

from farelane import api
from farelane.functions.calendar import holiday_calendar
from farelane.operators import clean, features
from farelane.plans import jobs
from farelane.sources import fixtures as fx
from farelane.sources import sinks


def _write_raw(spark):
    trips = fx.load_trips(spark, "/root/testdata/sf0.001")
    raw = sinks.shared_dir(spark, "api_raw")
    months = sorted(r.file_month for r in trips.select("file_month").distinct().collect())
    for m in months:
        part = trips.where(F.col("file_month") == m).drop("file_month")
        if m >= "2025-01":  # schema drift: a new fee column, one column missing
            part = part.drop("store_and_fwd_flag").withColumn("cbd_congestion_fee", F.lit(0.75))
        part.coalesce(1).write.parquet(f"{raw}/yellow_tripdata_{m}.parquet")
    return raw, trips


def test_stage_api_matches_operator_chain(spark):
    raw, trips = _write_raw(spark)
    files = api.list_month_files(spark, raw)
    drift = {r.file: r.status for r in api.check_schema(spark, files).collect()}
    assert drift["yellow_tripdata_2024-01.parquet"] == "reference"
    assert drift["yellow_tripdata_2025-03.parquet"] == "missing+extra"
    base = sinks.shared_dir(spark, "api_stages")
    s1 = api.column_normalize_and_save(spark, files, f"{base}/normalized")
    s2 = api.year_check_and_save(spark, s1, f"{base}/month_filtered")
    s3 = api.drop_impute_missing(spark, s2, f"{base}/missing")
    s4 = api.outlier_removal(spark, s3, f"{base}/outliers")
    s5 = api.build_and_save_features(spark, s4, f"{base}/features", fx.fixture_zone_lookup(spark), fx.fixture_zones(spark))
    got = spark.read.parquet(s5)

    expected_src = trips.withColumn(
        "store_and_fwd_flag", F.when(F.col("file_month") >= "2025-01", F.lit(None).cast("string")).otherwise(F.col("store_and_fwd_flag"))
    )
    exp = features.build_features(
        clean.range_filter(clean.missing_policy(clean.month_filter(expected_src))),
        holiday_calendar(spark), fx.fixture_zone_lookup(spark), fx.fixture_zones(spark),
    )
    cols = ["trip_id", "file_month", "passenger_count", "store_and_fwd_flag", "pickup_period", "pickup_borough"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, exp.select(*cols).collect()))

    splits = api.save_splits(api.build_splits(got, {"train": 40, "val": 20, "test": 40}), f"{base}/splits")
    pre = api.build_and_save_preprocess(spark, splits, f"{base}/artifacts")
    parts = api.build_transform_splits(spark, splits, f"{base}/artifacts")
    assert pre.endswith("preprocess") and parts[0].count() > 0 and "features" in parts[1].columns
    assert api.bucket_files_by_split(files)["test"] == [f for f in files if "2025-07" in f]


def test_preprocess_job_from_raw_files(spark):
    raw, _ = _write_raw(spark)
    out = sinks.shared_dir(spark, "api_job")
    paths = jobs.preprocess_job(spark, out, fx.fixture_zone_lookup(spark), fx.fixture_zones(spark), raw_dir=raw,
                                sample_rows={"train": 40, "val": 20, "test": 40})
    assert set(paths) == {"schema_drift", "features", "splits", "preprocess"}
    assert spark.read.parquet(paths["splits"]).select("split").distinct().count() == 3
