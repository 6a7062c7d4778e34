"""The reference's own unit cases, on DataFrames."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelane.ml import models as M
from farelane.ml import preprocess as P
from farelane.ml import scoring
from farelane.operators import clean, sampling
from farelane.plans import jobs
from farelane.functions.exprs import haversine_km
from farelane.sources.monthly import parse_year_month


def test_fix_locations_replaces_and_filters(spark):
    df = spark.createDataFrame([(57, 2), (1, 57), (264, 2)], "PULocationID int, DOLocationID int")
    out = clean.fix_locations(df).collect()
    assert 56 in [r.PULocationID for r in out]
    assert 56 in [r.DOLocationID for r in out]
    assert all(r.PULocationID != 264 for r in out)
    assert len(out) == 2


def test_haversine_zero_distance(spark):
    v = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("d")).first().d
    assert v == pytest.approx(0.0, abs=1e-6)


def test_prepare_features_and_split_xy(spark):
    df = spark.createDataFrame(
        [(1.0, 0.5, "Manhattan", datetime(2024, 1, 1).date(), 10.0), (2.0, 1.0, "Queens", datetime(2024, 1, 2).date(), 20.0)],
        "trip_distance double, haversine_distance double, pickup_borough string, pickup_date date, total_amount double",
    )
    x = P.prepare_features(df)
    assert "trip_distance" in x.columns and "pickup_date" not in x.columns
    xy = P.split_xy(df)
    assert xy.count() == 2 and "label" in xy.columns


def test_parse_year_month_and_assign_split(spark):
    assert parse_year_month("yellow_tripdata_2024-10.parquet") == (2024, 10)
    with pytest.raises(ValueError):
        parse_year_month("no_month_here.parquet")
    df = spark.createDataFrame([("2024-05",), ("2025-02",), ("2025-07",), ("2025-08",)], "file_month string")
    got = [r.split for r in sampling.assign_split(df).orderBy("file_month").collect()]
    assert got == ["train", "val", "test", "ignore"]


def test_training_job_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        jobs.training_job(spark, "unknown", "/nonexistent/splits", "/nonexistent/pre", "/nonexistent/art")


def test_mean_baseline_metrics(spark):
    train = spark.createDataFrame([(10.0,), (20.0,)], "label double")
    val = spark.createDataFrame([(15.0,), (25.0,)], "label double")
    m = M.metrics_dict(M.mean_baseline(train, val))
    assert m["MAE"] == pytest.approx(5.0)
    assert m["RMSE"] == pytest.approx(math.sqrt(50))
    assert m["R2"] == pytest.approx(-1.0)


def test_score_contract_parses_and_ignores_unknown(spark):
    payload = (
        '{"VendorID": 1, "tpep_pickup_datetime": "2024-01-01T00:00:00", "tpep_dropoff_datetime": "2024-01-01T00:10:00",'
        ' "passenger_count": 1, "trip_distance": 1.2, "RatecodeID": 1, "store_and_fwd_flag": "N", "PULocationID": 1,'
        ' "DOLocationID": 1, "payment_type": 1, "extra": "ignored"}'
    )
    r = scoring.parse_requests(spark.createDataFrame([(payload,)], "value string"), id_col=None).first()
    assert r.VendorID == 1 and r.is_valid
    bad = scoring.parse_requests(spark.createDataFrame([('{"VendorID": 1}',)], "value string"), id_col=None).first()
    assert not bad.is_valid
