"""Stream scoring as transactions: restarts, malformed records, models that change between batches."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from farelane.functions.calendar import holiday_calendar
from farelane.ml import models as M
from farelane.ml import scoring
from farelane.sources import fixtures as fx
from farelane.streaming import exactly_once as X


@pytest.fixture(scope="module")
def dims(spark):
    return fx.fixture_zones(spark), fx.fixture_zone_lookup(spark), holiday_calendar(spark, 2023, 2026)


def model(spark, slope):
    rows = spark.createDataFrame([(float(x), slope * x + 1.0) for x in range(20)], "trip_distance double, label double")
    pre = Pipeline(stages=[VectorAssembler(inputCols=["trip_distance"], outputCol="features")]).fit(rows)
    return pre, M.linear_regression().fit(pre.transform(rows))


def request(i, **more):
    return {
        "request_id": i, "VendorID": 1, "tpep_pickup_datetime": "2024-01-01T10:00:00", "tpep_dropoff_datetime": "2024-01-01T10:20:00", "passenger_count": 1,
        "trip_distance": float(i), "RatecodeID": 1.0, "store_and_fwd_flag": "N", "PULocationID": 10, "DOLocationID": 20, "payment_type": 1, **more,
    }


def put(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def start(spark, tmp, dims, **kw):
    q = X.score_stream_exactly_once(spark, str(tmp / "in"), str(tmp / "sink"), str(tmp / "ckpt"), str(tmp / "models"), *dims, **kw)
    q.awaitTermination()


def answers(spark, tmp):
    return sorted((r["request_id"], r["status"], r["total_amount"], r["model_version"]) for r in X.read_committed(spark, str(tmp / "sink")).collect())


def test_stop_between_write_and_commit(spark, tmp_path, dims):
    X.publish_model(spark, str(tmp_path / "models"), *model(spark, 2.0), "m")
    for k in range(3):
        put(tmp_path / "in", f"{k}.json", [request(10 * k + i) for i in range(1, 6)])

    class Dies(X.BatchScorer):
        def commit(self, row):
            if row[0] == 1:
                raise RuntimeError("driver lost")
            super().commit(row)

    dying = Dies(spark, str(tmp_path / "sink"), str(tmp_path / "models"), *dims)
    with pytest.raises(Exception, match="driver lost"):
        start(spark, tmp_path, dims, max_files_per_trigger=1, scorer=dying)
    first = answers(spark, tmp_path)
    assert len(first) == 5  # the second batch was written, but nobody sees it
    start(spark, tmp_path, dims, max_files_per_trigger=1)
    got = answers(spark, tmp_path)
    assert [g[0] for g in got] == sorted(10 * k + i for k in range(3) for i in range(1, 6))
    assert all(g[1] == "ok" and g[2] == pytest.approx(2.0 * g[0] + 1) for g in got)
    # another start finds nothing to do, and a batch that is delivered again is skipped
    start(spark, tmp_path, dims)
    X.BatchScorer(spark, str(tmp_path / "sink"), str(tmp_path / "models"), *dims)(spark.createDataFrame([(json.dumps(request(99)),)], "value string"), 1)
    assert answers(spark, tmp_path) == got


def test_malformed_records_go_to_quarantine(spark, tmp_path, dims):
    X.publish_model(spark, str(tmp_path / "models"), *model(spark, 2.0), "m")
    lines = [request(1), "not json", '{"request_id": 2, "trip_distance": "far"}', "[1, 2]", request(3, trip_distance=None), {k: v for k, v in request(4).items() if k != "request_id"}, "", request(5, extra="x"), '{"request_id": 6']
    put(tmp_path / "in", "a.json", lines)
    start(spark, tmp_path, dims)
    got = {r["request_id"]: (r["status"], r["reject_reason"]) for r in X.read_committed(spark, str(tmp_path / "sink")).collect()}
    assert got == {1: ("ok", None), 3: ("rejected", scoring.REASON_INVALID), 5: ("ok", None)}
    held = {r["record"]: r["reason"] for r in X.read_committed(spark, str(tmp_path / "sink"), "quarantine").collect()}
    assert set(held) == {"not json", lines[2], "[1, 2]", json.dumps(lines[5]), "", lines[8]}
    assert held[json.dumps(lines[5])] == "no request_id" and held["not json"] == "malformed record"
    row = spark.read.schema(X._COMMITS).json(str(tmp_path / "sink/commits")).first()
    assert (row["n_scored"], row["n_rejected"], row["n_quarantined"]) == (2, 1, 6)


def test_model_is_chosen_per_batch(spark, tmp_path, dims):
    registry = str(tmp_path / "models")
    put(tmp_path / "in", "0.json", [request(1)])
    with pytest.raises(Exception, match="no model is published"):
        start(spark, tmp_path, dims)
    X.publish_model(spark, registry, *model(spark, 2.0), "m")
    start(spark, tmp_path, dims)
    assert X.publish_model(spark, registry, *model(spark, 5.0), "m") == 2
    put(tmp_path / "in", "1.json", [request(2)])
    start(spark, tmp_path, dims)
    got = answers(spark, tmp_path)
    assert [(g[0], g[3]) for g in got] == [(1, 1), (2, 2)]
    assert [g[2] for g in got] == [pytest.approx(3.0), pytest.approx(11.0)]


def test_nothing_committed(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        X.read_committed(spark, str(tmp_path / "sink"))


def test_null_record(spark):
    requests, held = X.split_records(spark.createDataFrame([(None,), ("{}",)], "value string"))
    assert requests.count() == 0 and sorted(r["reason"] for r in held.collect()) == ["no record", "no request_id"]
    assert set(requests.columns) == {f.name for f in scoring.score_schema().fields}
    assert held.filter(F.col("record") == "{}").count() == 1
