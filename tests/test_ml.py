"""Feature pipeline, models and scoring invariants."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from farelane.functions.calendar import holiday_calendar
from farelane.ml import models as M
from farelane.ml import preprocess as P
from farelane.ml import scoring
from farelane.sources import fixtures as fx
from farelane.sources import sinks
from farelane.streaming.score_stream import score_stream


def test_robust_scaler_exact_quantiles_and_zero_iqr(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "a double, b double")
    m = P.ExactRobustScaler(inputCols=["a", "b"], outputCols=["sa", "sb"]).fit(df)
    assert m.getOrDefault("centers") == [2.5, 5.0]
    assert m.getOrDefault("scales")[0] == pytest.approx(np.percentile([1, 2, 3, 10], 75) - np.percentile([1, 2, 3, 10], 25))
    assert m.getOrDefault("scales")[1] == 1.0
    assert m.transform(df).where("a = 2.5 OR a = 1.0").first().sb == 0.0


def test_pipeline_unseen_category_is_zero_and_persists(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (3.0, None)], "n double, c string")
    val = spark.createDataFrame([(2.0, "z"), (2.0, None)], "n double, c string")
    model = P.build_preprocess(["n"], ["c"]).fit(train)
    rows = model.transform(val).select(vector_to_array("_ohe_c").alias("v")).collect()
    assert sum(rows[0].v) == 0.0  # unseen
    assert sum(rows[1].v) == 1.0  # NULL was seen in training: its own category
    path = P.save_preprocess(model, str(tmp_path / "pre"))
    again = P.load_preprocess(path)
    a = [r.f for r in model.transform(val).select(vector_to_array("features").alias("f")).collect()]
    b = [r.f for r in again.transform(val).select(vector_to_array("features").alias("f")).collect()]
    assert a == b


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.3, size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, label double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    m = M.ridge(df, alpha=5.0).fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-6)
    assert m.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-6)


def _xy(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(2 * a + 1 + rng.normal(scale=0.1))) for a in rng.uniform(0, 10, 300)]
    df = spark.createDataFrame(rows, "a double, label double")
    return VectorAssembler(inputCols=["a"], outputCol="features").transform(df)


def test_leaderboard_order_and_best_model(spark):
    df = _xy(spark)
    board = M.leaderboard(spark, [M.Contender("Ridge", M.ridge(df)), M.Contender("LinearRegression", M.linear_regression())], df, df)
    names = [r.Model for r in board.collect()]
    assert set(names) == {"MeanBaseline", "Ridge", "LinearRegression"} and names[-1] == "MeanBaseline"
    assert M.best_model(board).first().Model != "MeanBaseline"
    with pytest.raises(ValueError):
        M.Contender("bad")
    with pytest.raises(ValueError):
        M.leaderboard(spark, [M.Contender("a", M.linear_regression()), M.Contender("a", M.linear_regression())], df, df)


def test_boosted_trees_beat_baseline(spark):
    df = _xy(spark)
    gbt = M.boosted_trees("xgboost", max_iter=7).fit(df)
    assert M.metrics_dict(gbt.transform(df))["RMSE"] < M.metrics_dict(M.mean_baseline(df, df))["RMSE"]


SMALL_SPACE = M.SEARCH_SPACE | {"n_estimators": ("int", 2, 5, 1), "max_depth": ("int", 2, 3, 1)}


def test_stalled_rounds():
    assert M.stalled_at([5, 4, 3, 3, 3, 1], 3) == 6
    assert M.stalled_at([5, 4, 3, 3, 3, 1], 2) == 3
    assert M.stalled_at([1], 200) == 1


def test_early_stop_keeps_leading_trees(spark):
    df = _xy(spark)
    gbt = M.boosted_trees("lightgbm", max_iter=8, step_size=1.0)
    whole = gbt.fit(df)
    losses = whole.evaluateEachIteration(df, "squared")
    short = M.fit_with_validation(gbt, df, df, rounds=1)
    assert short.getNumTrees == M.stalled_at(losses, 1)
    assert short.evaluateEachIteration(df, "squared") == pytest.approx(losses[: short.getNumTrees])


def test_job_guards(spark):
    from farelane.plans import jobs

    with pytest.raises(ValueError, match="mode"):
        jobs.training_job(spark, "tune", "/nowhere", "/nowhere", "/nowhere")
    with pytest.raises(ValueError, match="lightgbm"):
        jobs.training_job(spark, "optimize", "/nowhere", "/nowhere", "/nowhere", opt_model="xgboost")
    with pytest.raises(ValueError, match="no such models"):
        jobs.evaluate(spark, _xy(spark), None, "/nowhere", ["ridge", "forest"], 42, None)


def test_scoring_answers_each_request_once(spark):
    zones = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 1.0), (1, 2.0, 2.0), (2, 2.0, 2.0)], "LocationID int, lon double, lat double")
    ok = (1, "2024-01-01 10:00:00", "2024-01-01 10:20:00", 1, 2.0, 1.0, "N", 1, 2, 1)
    rows = [(1, *ok), (2, *ok[:3], None, *ok[4:]), (3, *ok[:7], 264, 2, 1), (4, *ok[:7], 1, 9, 1)]
    names = "request_id long, VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count int, trip_distance double, RatecodeID double, store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type int"
    req = spark.createDataFrame(rows, names)
    req = req.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    got = {r["request_id"]: r["reject_reason"] for r in scoring.reject_reasons(req, zones).collect()}
    assert got == {1: None, 2: scoring.REASON_INVALID, 3: scoring.REASON_LOCATION, 4: scoring.REASON_HAVERSINE}
    assert scoring.judged_requests(req, zones).count() == len(rows)
    bare = {r["request_id"]: r["reject_reason"] for r in scoring.reject_reasons(req, None).collect()}
    assert bare == {1: scoring.REASON_NO_CENTROIDS, 2: scoring.REASON_INVALID, 3: scoring.REASON_LOCATION, 4: scoring.REASON_NO_CENTROIDS}


def test_param_search_and_trial_log(spark):
    df = _xy(spark)
    best, params, trials = M.param_search(df, df, n_trials=2, space=SMALL_SPACE)
    assert len(trials) == 2 and best == min(t.value for t in trials)
    assert set(params) == set(M.SEARCH_SPACE)
    assert M.trial_log(spark, trials).count() == 2


def test_stream_scoring_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    trips = fx.load_trips(spark, sf).where(F.col("file_month") < "2024-04")
    req = trips.select(F.col("trip_id").alias("request_id"), "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                       F.col("passenger_count").cast("int").alias("passenger_count"), "trip_distance", "RatecodeID",
                       "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type")
    zones, lookup, hol = fx.fixture_zones(spark), fx.fixture_zone_lookup(spark), holiday_calendar(spark, 2023, 2026)
    from farelane.operators import features

    train = features.build_features(trips, hol, lookup, zones).na.fill({"passenger_count": 1.0, "RatecodeID": 1.0, "store_and_fwd_flag": "N"})
    pre = P.build_preprocess().fit(train)
    model = M.linear_regression().fit(P.transform(pre, train))
    batch = scoring.score_batch(req, pre, model, zones, lookup, hol, "LinearRegressionModel")
    src = sinks.shared_dir(spark, "t_stream_src")
    req.write.parquet(src)
    sink, ckpt = sinks.shared_dir(spark, "t_stream_sink"), sinks.shared_dir(spark, "t_stream_ckpt")
    score_stream(spark, src, sink, ckpt, pre, model, zones, lookup, hol, "LinearRegressionModel").awaitTermination()
    streamed = spark.read.parquet(sink)
    key = ["request_id", "status", "reject_reason", "total_amount"]
    assert sorted(map(tuple, batch.select(*key).collect()), key=str) == sorted(map(tuple, streamed.select(*key).collect()), key=str)
    assert batch.where("status = 'rejected'").count() > 0


def test_final_compare_metrics_finite(spark):
    import math

    df = _xy(spark)
    _, params, _ = M.param_search(df, df, n_trials=1, space=SMALL_SPACE)
    result, model = M.final_compare(spark, params, df, df, df)
    rows = result.collect()
    assert {r.mode for r in rows} == {"train_only", "train_val"}
    assert all(math.isfinite(r.rmse) and math.isfinite(r.mae) and math.isfinite(r.r2) for r in rows)
    assert rows[0].better in ("TRAIN+VAL", "TRAIN only")


def test_stream_restart_scores_each_request_once(spark):
    from farelane.operators import features

    sf = "/root/testdata/sf0.001"
    trips = fx.load_trips(spark, sf).where(F.col("file_month") < "2024-07")
    req = trips.select(F.col("trip_id").alias("request_id"), "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                       F.col("passenger_count").cast("int").alias("passenger_count"), "trip_distance", "RatecodeID",
                       "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type")
    zones, lookup, hol = fx.fixture_zones(spark), fx.fixture_zone_lookup(spark), holiday_calendar(spark, 2023, 2026)
    train = features.build_features(trips, hol, lookup, zones).na.fill({"passenger_count": 1.0, "RatecodeID": 1.0, "store_and_fwd_flag": "N"})
    pre = P.build_preprocess().fit(train)
    model = M.linear_regression().fit(P.transform(pre, train))
    src = sinks.shared_dir(spark, "t_restart_src")
    sink, ckpt = sinks.shared_dir(spark, "t_restart_sink"), sinks.shared_dir(spark, "t_restart_ckpt")
    req.where("request_id % 2 = 0").write.mode("append").parquet(src)
    run = lambda: score_stream(spark, src, sink, ckpt, pre, model, zones, lookup, hol, "m").awaitTermination()
    # the source folder gains a second batch of files between two runs on the same checkpoint
    run()
    first = spark.read.parquet(sink).count()
    req.where("request_id % 2 = 1").write.mode("append").parquet(src)
    run()
    out = spark.read.parquet(sink)
    assert first == req.where("request_id % 2 = 0").count()
    assert out.count() == req.count() and out.select("request_id").distinct().count() == req.count()
