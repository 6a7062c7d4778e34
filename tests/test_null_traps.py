"""Null / NaN semantics of SURVEY §1.4 (pandas-compatible), one literal case each."""

from datetime import datetime

from pyspark.sql import functions as F

from farelane.functions.calendar import calendar_flags
from farelane.operators import clean, features, stats
from farelane.sources import fixtures as fx

TS = "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz"


def test_null_duration_is_kept(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 8), None), (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 8, 0, 30)),
         (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 8, 30))], TS)
    out = clean.duration_filter(df).collect()
    assert len(out) == 2 and any(r.trip_duration is None for r in out)


def test_range_filter_lets_null_pass(spark):
    df = spark.createDataFrame([(None, 1.0, 10.0), (0.0, 1.0, 10.0), (2.0, None, None)],
                               "passenger_count double, trip_distance double, total_amount double")
    assert clean.range_filter(df).count() == 2


def test_month_filter_drops_null_pickup(spark):
    df = spark.createDataFrame([(None, "2024-01"), (datetime(2024, 1, 31, 23, 59), "2024-01"), (datetime(2024, 2, 1), "2024-01")],
                               "tpep_pickup_datetime timestamp_ntz, file_month string")
    assert clean.month_filter(df).count() == 1


def test_flags_on_null_are_zero_and_period_other(spark):
    df = spark.createDataFrame([(None, None, None, 0, 0)],
                               "pickup_dayofweek int, pickup_hour int, pickup_minute int, is_holiday int, is_long_weekend int")
    r = features.pickup_period_and_flags(df).first()
    assert r.pickup_period == "other"
    assert (r.is_weekend, r.is_rush_hour, r.is_nightlife, r.is_friday_getaway) == (0, 0, 0, 0)


def test_sine_of_null_is_null(spark):
    df = spark.createDataFrame([(None, 3, 2, 1)], "pickup_hour int, dropoff_hour int, pickup_dayofweek int, pickup_month int")
    r = features.cyclic_time(df).first()
    assert r.pickup_hour_sin is None and r.dropoff_hour_sin is not None


def test_tvd_counts_null_as_category(spark):
    p = spark.createDataFrame([(1,), (None,)], "v int")
    q = spark.createDataFrame([(1,), (1,)], "v int")
    assert abs(stats.tvd(p, q, "v").first().tvd - 0.5) < 1e-12


def test_nan_is_missing_for_range_checks(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, 10.0)], "passenger_count double, trip_distance double, total_amount double")
    out = clean.range_filter(df).collect()
    assert len(out) == 1 and out[0].passenger_count is None


def test_lenient_casts_coerce(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "1.5"), ("garbage", "x")], "tpep_pickup_datetime string, trip_distance string")
    rows = clean.lenient_casts(df, numerics=("trip_distance",)).collect()
    assert rows[0].trip_distance == 1.5 and rows[1].trip_distance is None and rows[1].tpep_pickup_datetime is None


def test_naive_timestamps_have_no_dst_shift(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 32))], TS)
    assert abs(features.trip_duration(df).first().trip_duration - 122.0) < 1e-9


def test_long_weekend_uses_same_year_only(spark):
    hol = spark.createDataFrame([(datetime(2024, 1, 1).date(),)], "holiday_date date")
    flags = {r.cal_date: r for r in calendar_flags(hol).collect()}
    # Friday 2023-12-29 is three days before the holiday but in another year
    assert flags[datetime(2023, 12, 29).date()].holiday_in_3_days == 0
    assert flags[datetime(2024, 1, 4).date()].holiday_3_days_ago == 1


def test_fixture_counts_match_fixtures_md(spark):
    t = fx.load_trips(spark, "/root/testdata/sf0.001")
    r = t.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("passenger_count").isNull()).alias("trio"),
              F.count_if(F.col("tpep_dropoff_datetime").isNull()).alias("drop")).first()
    assert (r.n, r.trio, r.drop) == (1500, 116, 15)


def test_nan_in_files_of_other_writers_is_missing(spark, tmp_path):
    """A file whose statistics leave NaN out must not lose its NaN rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from farelane.operators import clean

    nan = float("nan")
    cols = {"passenger_count": [1.0, 2.0, nan], "trip_distance": [0.01, nan, 2.0], "total_amount": [10.0, 10.0, 10.0]}
    pq.write_table(pa.table(cols | {"RatecodeID": [1.0, 1.0, 1.0], "store_and_fwd_flag": ["N", "N", "N"], "file_month": ["2025-01"] * 3}), f"{tmp_path}/x.parquet")
    df = spark.read.parquet(f"{tmp_path}/x.parquet")
    kept = clean.range_filter(df).collect()
    assert len(kept) == 2 and sum(r.trip_distance is None for r in kept) == 1
    filled = clean.missing_policy(df).collect()
    assert sorted(r.passenger_count for r in filled) == [1.0, 1.0, 2.0]
    assert sorted(r.passenger_count for r in clean.impute_mode(df).collect()) == [1.0, 1.0, 2.0]
    dropped = clean.missing_policy(df, policy={2025: "drop"})
    assert dropped.count() == 2 and clean.missing_policy(df, policy={2024: "drop"}, other="impute").count() == 3
    assert clean.unlisted_months(df, {2024: "drop"}).first().n_rows == 3
