"""Batch scoring of trip requests (K1-K3).

The request-time endpoint of the reference becomes a DataFrame operator:
any number of requests go through the same cleaning and feature functions
used for training (no train/serve skew), rejected requests keep a reason
instead of raising, and the rest get a prediction from the fitted
``PipelineModel``.  Every step is row-wise or a broadcast join, so the same
function also runs on a stream (see ``farelane.streaming``).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.constants import BAD_LOCATION_IDS, DROPOFF, DURATION_BOUNDS, LOCATION_REPLACE, PICKUP
from farelane.functions.calendar import calendar_flags
from farelane.functions.exprs import minutes_between
from farelane.operators import features, joins

# --- fixed values: scoring contract and messages -------------------------------
SCORE_FIELDS = (
    ("VendorID", T.IntegerType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("RatecodeID", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("payment_type", T.IntegerType()),
)
REASON_LOCATION = "Input filtered by location ID rules"
REASON_NO_CENTROIDS = "Zone centroids unavailable; cannot compute haversine distance."
REASON_DURATION = "Input filtered by trip duration rules"
REASON_HAVERSINE = (
    "Cannot compute haversine distance for provided LocationIDs; verify PULocationID/DOLocationID are valid."
)
REASON_INVALID = "Invalid request: a required field is missing or malformed"
CURRENCY = "USD"


def score_schema(id_col: str | None = "request_id") -> T.StructType:
    fields = [T.StructField(n, t, True) for n, t in SCORE_FIELDS]
    if id_col:
        fields = [T.StructField(id_col, T.LongType(), True)] + fields
    return T.StructType(fields)


def parse_requests(raw: DataFrame, col: str = "value", id_col: str | None = "request_id") -> DataFrame:
    """JSON request text -> typed columns (K1); unknown fields are ignored.

    ``is_valid`` is false when a required field is missing or does not parse
    (such a request is rejected, like a validation error).
    """
    sch = score_schema(id_col)
    parsed = raw.select(F.from_json(F.col(col), sch, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    valid = F.lit(True)
    for n, _ in SCORE_FIELDS:
        valid = valid & F.col(n).isNotNull()
    return parsed.withColumn("is_valid", valid)


def _fixed(c: str) -> Column:
    e = F.col(c)
    for old, new in LOCATION_REPLACE.items():
        e = F.when(F.col(c) == old, F.lit(new)).otherwise(e)
    return e


def one_row_per_zone(zones: DataFrame) -> DataFrame:
    """Zone centroids with one row per id: the smallest (lon, lat) of a repeated id, whatever the file order."""
    return zones.groupBy("LocationID").agg(F.min(F.struct("lon", "lat")).alias("_z")).select("LocationID", "_z.lon", "_z.lat")


def is_valid(requests: DataFrame) -> Column:
    """The request contract (K1): the parsed flag where there is one, else all required fields are present."""
    if "is_valid" in requests.columns:
        return F.coalesce(F.col("is_valid"), F.lit(False))
    ok = F.lit(True)
    for n, _ in SCORE_FIELDS:
        ok = ok & F.col(n).isNotNull()
    return ok


def judged_requests(requests: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Requests with fixed location ids, the coordinates of both zones and ``reject_reason``; one row per request.

    The rules apply in order: contract, location ids, zone table present,
    duration, coordinates found.
    """
    ready = requests.withColumn("_valid", is_valid(requests)).withColumns({c: _fixed(c) for c in ("PULocationID", "DOLocationID")})
    bad = F.lit(False)
    for c in ("PULocationID", "DOLocationID"):
        bad = bad | F.coalesce(F.col(c).isin(list(BAD_LOCATION_IDS)), F.lit(False))
    if zones is None:
        ready = ready.withColumns({c: F.lit(None).cast("double") for c in ("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")})
        rest = F.lit(REASON_NO_CENTROIDS)
    else:
        ready = joins.join_centroids(ready, one_row_per_zone(zones))
        d = minutes_between(PICKUP, DROPOFF)
        lo, hi = DURATION_BOUNDS
        unknown = F.lit(False)
        for c in ("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat"):
            unknown = unknown | F.col(c).isNull()
        rest = F.when(F.coalesce((d < lo) | (d > hi), F.lit(False)), F.lit(REASON_DURATION)).when(unknown, F.lit(REASON_HAVERSINE))
    reason = F.when(~F.col("_valid"), F.lit(REASON_INVALID)).when(bad, F.lit(REASON_LOCATION)).otherwise(rest)
    return ready.withColumn("reject_reason", reason).drop("_valid")


def reject_reasons(requests: DataFrame, zones: DataFrame | None, id_col: str = "request_id") -> DataFrame:
    """``id_col`` and ``reject_reason`` (NULL when the request can be scored), one row per request (K3)."""
    return judged_requests(requests, zones).select(id_col, "reject_reason")


def score_batch(
    requests: DataFrame,
    preprocess: PipelineModel,
    model,
    zones: DataFrame | None,
    lookup: DataFrame,
    holidays: DataFrame,
    model_name: str,
    id_col: str = "request_id",
) -> DataFrame:
    """Predict ``total_amount`` for every valid request (K2).

    Output: ``id, status, reject_reason, total_amount (2 dp), currency, model``,
    one row per request; rejected requests have ``status = 'rejected'``.
    """
    checked = judged_requests(requests, zones)
    ok = checked.where(F.col("reject_reason").isNull()).drop("reject_reason", "is_valid")
    rejected = checked.where(F.col("reject_reason").isNotNull()).select(
        id_col,
        F.lit("rejected").alias("status"),
        "reject_reason",
        F.lit(None).cast("double").alias("total_amount"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(None).cast("string").alias("model"),
    )
    feats = features.engineer_features(ok, calendar_flags(holidays), lookup=lookup)
    pred = model.transform(preprocess.transform(feats))
    scored = pred.select(
        id_col,
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("reject_reason"),
        F.round(F.col("prediction"), 2).alias("total_amount"),
        F.lit(CURRENCY).alias("currency"),
        F.lit(model_name).alias("model"),
    )
    return scored.unionByName(rejected)
