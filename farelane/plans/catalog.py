"""Registered queries (one per operator of the inventory) and their DuckDB oracles.

Every query reads the driver's tables through the trip mapping of
``farelane.sources.fixtures`` (trips derived row-for-row from ``orders``), so
its work grows with the table.  Double columns are rounded to 6 decimals on
both sides (presentation only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.constants import FILE_MONTH
from farelane.functions.calendar import calendar_flags, holiday_calendar
from farelane.functions.exprs import nan_as_null
from farelane.operators import clean, features, joins, sampling, schema, stats
from farelane.operators.geometry import zone_centroids
from farelane.plans import audits, profiles
from farelane.plans import oracle_sql as O
from farelane.sources import fixtures as fx
from farelane.sources import footers, monthly, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RAW_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}  # same plans without output rounding
ORACLES: dict[str, str] = {}

TRIP_COLS = (
    "trip_id", "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "total_amount", "file_month",
)
TRIP_SELECT = ", ".join(
    f"round({c}, 6) AS {c}" if c in ("passenger_count", "trip_distance", "RatecodeID", "total_amount") else c
    for c in TRIP_COLS
)
# split sizes per month scaled to the small test tables (about 790 rows per month at sf0.01)
SPLIT_ROWS = {"train": 500, "val": 900, "test": 300}


def rounded(df: DataFrame, dp: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), dp).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        RAW_QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return deco


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load_trips(spark, sf)


def _raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The trips, dealt over all cores and written once: derived columns are otherwise spelt out and computed again at every use of a filter or join."""
    return sinks.materialize(fx.load_trips(spark, sf, spread=True), "raw_trips")


def _trips_with_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Trips whose passenger count and distance are NaN where ``trip_id % 29 = 0`` (missing values, as in pandas files)."""
    nan = F.col("trip_id") % 29 == 0
    t = _trips(spark, sf)
    return t.withColumns({c: F.when(nan, F.lit(float("nan"))).otherwise(F.col(c)) for c in ("passenger_count", "trip_distance")})


#: the same rows for the oracle, where they are simply missing
TRIPS_NAN = O.TRIPS.replace("trips AS (", "plain_trips AS (") + """,
trips AS (
  SELECT * REPLACE (CASE WHEN trip_id % 29 = 0 THEN NULL ELSE passenger_count END AS passenger_count,
                    CASE WHEN trip_id % 29 = 0 THEN NULL ELSE trip_distance END AS trip_distance)
  FROM plain_trips
)"""


def _sel_round(cols, dp=6) -> str:
    return ", ".join(f"round({c}, {dp}) AS {c}" for c in cols)


def _features(spark: SparkSession, sf: str, src: DataFrame | None = None, with_zones: bool = True) -> DataFrame:
    t = _trips(spark, sf) if src is None else src
    zones = fx.fixture_zones(spark) if with_zones else None
    return features.build_features(t, holiday_calendar(spark), fx.fixture_zone_lookup(spark), zones)


def _clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    """C1 -> C6 -> C7 on the fixture trips."""
    return clean.range_filter(clean.missing_policy(clean.month_filter(_raw_trips(spark, sf))))


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned trips, written: with the feature build in one stage its generated method is too long for the JVM to compile (8,000 bytes)."""
    return sinks.materialize(_clean_trips(spark, sf), "cleaned")


FEATURE_DOUBLES = (
    "passenger_count", "trip_distance", "RatecodeID", "total_amount", "pickup_lon", "pickup_lat", "dropoff_lon",
    "dropoff_lat", "trip_duration", "pickup_hour_sin", "pickup_hour_cos", "dropoff_hour_sin", "dropoff_hour_cos",
    "dow_sin", "dow_cos", "month_sin", "month_cos", "haversine_distance",
)
FEATURE_OTHER = (
    "trip_id", "VendorID", "store_and_fwd_flag", "payment_type", "file_month", "pickup_date", "is_holiday",
    "is_long_weekend", "pickup_period", "is_weekend", "is_rush_hour", "is_nightlife", "is_friday_getaway",
    "pickup_borough", "pickup_service_zone", "dropoff_borough", "dropoff_service_zone",
)
FEATURE_SELECT = ", ".join(FEATURE_OTHER) + ", " + _sel_round(FEATURE_DOUBLES)

# ============================================================ A: sources and sinks


@register("scan_projected", O.with_ctes(O.TRIPS, select="SELECT trip_id, file_month, round(total_amount, 6) AS total_amount FROM trips"))
def q_scan_projected(spark, sf):
    return _trips(spark, sf).select("trip_id", FILE_MONTH, "total_amount")


@register(
    "file_month",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT DISTINCT 'yellow_tripdata_' || file_month || '.parquet' AS file_name,
          CAST(substr(file_month, 1, 4) AS INTEGER) AS file_year, CAST(substr(file_month, 6, 2) AS INTEGER) AS file_mon
        FROM trips""",
    ),
)
def q_file_month(spark, sf):
    names = _trips(spark, sf).select(F.concat(F.lit("yellow_tripdata_"), F.col(FILE_MONTH), F.lit(".parquet")).alias("file_name")).distinct()
    fm = monthly.file_month_of(F.col("file_name"))
    return names.select(
        "file_name", F.substring(fm, 1, 4).cast("int").alias("file_year"), F.substring(fm, 6, 2).cast("int").alias("file_mon")
    )


@register(
    "sink_scan_months",
    O.with_ctes(O.TRIPS, select="SELECT file_month, count(*) AS n_rows, round(sum(total_amount), 4) AS total_amount FROM trips GROUP BY file_month"),
)
def q_sink_scan_months(spark, sf):
    out = sinks.shared_dir(spark, "sink_scan_months")
    sinks.write_months(_trips(spark, sf), out, files_per_month=2)
    back = monthly.scan_months(spark, out)
    return back.groupBy(FILE_MONTH).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("total_amount"), 4).alias("total_amount"))


@register(
    "preview",
    O.with_ctes(O.TRIPS, O.MONTH_FILTERED, select=f"SELECT {TRIP_SELECT} FROM mf ORDER BY trip_id LIMIT 5"),
)
def q_preview(spark, sf):
    return monthly.preview(clean.month_filter(_trips(spark, sf)), ["trip_id"], 5)


# ============================================================ B: schema


SCHEMA_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _drift_sql() -> str:
    names = ", ".join(f"'{t}'" for t in SCHEMA_TABLES)
    return f"""
WITH cols AS (
  SELECT table_name || '.parquet' AS file, ordinal_position AS pos, column_name AS col
  FROM information_schema.columns WHERE table_name IN ({names})
),
ref AS (SELECT min(file) AS ref_file FROM cols),
ref_cols AS (SELECT col FROM cols WHERE file = (SELECT ref_file FROM ref)),
files AS (SELECT DISTINCT file FROM cols),
miss AS (
  SELECT f.file, string_agg(r.col, ',' ORDER BY r.col) AS missing_cols, count(*) AS n_missing
  FROM files f, ref_cols r WHERE NOT EXISTS (SELECT 1 FROM cols c WHERE c.file = f.file AND c.col = r.col)
  GROUP BY f.file
),
extra AS (
  SELECT c.file, string_agg(c.col, ',' ORDER BY c.col) AS extra_cols, count(*) AS n_extra
  FROM cols c WHERE c.col NOT IN (SELECT col FROM ref_cols) GROUP BY c.file
),
ncol AS (SELECT file, count(*) AS n_columns FROM cols GROUP BY file)
SELECT n.file, CAST(n.n_columns AS BIGINT) AS n_columns, CAST(coalesce(m.n_missing, 0) AS BIGINT) AS n_missing,
  CAST(coalesce(e.n_extra, 0) AS BIGINT) AS n_extra, coalesce(m.missing_cols, '') AS missing_cols,
  coalesce(e.extra_cols, '') AS extra_cols,
  CASE WHEN n.file = (SELECT ref_file FROM ref) THEN 'reference'
       WHEN m.n_missing IS NULL AND e.n_extra IS NULL THEN 'matching'
       WHEN m.n_missing IS NOT NULL AND e.n_extra IS NOT NULL THEN 'missing+extra'
       WHEN m.n_missing IS NOT NULL THEN 'missing' ELSE 'extra' END AS status
FROM ncol n LEFT JOIN miss m ON n.file = m.file LEFT JOIN extra e ON n.file = e.file"""


@register("schema_drift", _drift_sql())
def q_schema_drift(spark, sf):
    files = [f"{sf.rstrip('/')}/{t}.parquet" for t in SCHEMA_TABLES]
    return schema.schema_drift(schema.column_table(spark, files))


@register(
    "schema_type_drift",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT DISTINCT 'trips_' || file_month || '.parquet' AS file, c AS column, t AS type, r AS reference_type, TRUE AS nullable, TRUE AS reference_nullable
        FROM trips, (VALUES ('passenger_count', 'bigint', 'double'), ('payment_type', 'string', 'int')) AS v(c, t, r) WHERE file_month >= '2025-01'""",
    ),
)
def q_schema_type_drift(spark, sf):
    """B1: monthly files of which the later ones have two columns in other types."""
    t = _trips(spark, sf).select(*TRIP_COLS)
    out = sinks.shared_dir(spark, "typed_months")
    late = F.col(FILE_MONTH) >= "2025-01"
    other = t.filter(late).withColumns({"passenger_count": F.col("passenger_count").cast("long"), "payment_type": F.col("payment_type").cast("string")})
    files = []
    for df in (t.filter(~late).withColumn("payment_type", F.col("payment_type").cast("int")), other):
        written = f"{out}/{len(files)}"
        df.withColumn("m", F.col(FILE_MONTH)).repartition("m").write.partitionBy("m").parquet(written)
        files += [(f"{written}/m={r[0]}", f"trips_{r[0]}.parquet") for r in df.select(FILE_MONTH).distinct().orderBy(FILE_MONTH).collect()]
    names = spark.createDataFrame([(f"m={n[6:-8]}", n) for _, n in files], "file string, name string")
    columns = schema.column_table(spark, [f for f, _ in files]).join(names, "file").drop("file").withColumnRenamed("name", "file")
    return footers.type_drift(columns)


def _drift_frames(spark, sf):
    t = _trips(spark, sf)
    early = t.where(F.col(FILE_MONTH) < "2025-01").select(
        *TRIP_COLS[:-1],
        (F.col("total_amount") * 0.8).alias("fare_amount"),
        (F.col("total_amount") * 0.1).alias("Airport_fee"),
        F.col(FILE_MONTH),
    )
    late = t.where(F.col(FILE_MONTH) >= "2025-01").select(
        *[c for c in TRIP_COLS if c not in ("store_and_fwd_flag", FILE_MONTH)],
        (F.col("total_amount") * 0.05).alias("cbd_congestion_fee"),
        F.col(FILE_MONTH),
    )
    return early, late


@register(
    "normalize_columns",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT {TRIP_SELECT} FROM trips WHERE file_month < '2025-01'
        UNION ALL
        SELECT {TRIP_SELECT.replace('store_and_fwd_flag', 'CAST(NULL AS VARCHAR) AS store_and_fwd_flag')}
        FROM trips WHERE file_month >= '2025-01'""",
    ),
)
def q_normalize_columns(spark, sf):
    early, late = _drift_frames(spark, sf)
    return schema.normalize_columns([early, late])


# ============================================================ C: filters and cleaning


@register("month_filter", O.with_ctes(O.TRIPS, O.MONTH_FILTERED, select=f"SELECT {TRIP_SELECT} FROM mf"))
def q_month_filter(spark, sf):
    return clean.month_filter(_trips(spark, sf))


@register(
    "month_filter_summary",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT *, n_total - n_kept AS n_dropped,
          round(CASE WHEN n_total > 0 THEN (n_total - n_kept) * 100.0 / n_total ELSE 0 END, 6) AS pct_dropped
        FROM (SELECT file_month, count(*) AS n_total,
          count(*) FILTER (WHERE tpep_pickup_datetime >= CAST(file_month || '-01' AS TIMESTAMP)
             AND tpep_pickup_datetime < CAST(file_month || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH) AS n_kept,
          count(*) FILTER (WHERE tpep_pickup_datetime IS NULL) AS n_null_pickup
        FROM trips GROUP BY file_month)""",
    ),
)
def q_month_filter_summary(spark, sf):
    return clean.month_filter_summary(_trips(spark, sf))


LENIENT_SQL = O.with_ctes(
    O.TRIPS,
    select="""SELECT trip_id,
      TRY_CAST(CASE WHEN trip_id % 23 = 0 THEN 'not-a-date' ELSE CAST(tpep_pickup_datetime AS VARCHAR) END AS TIMESTAMP) AS tpep_pickup_datetime,
      round(TRY_CAST(CASE WHEN trip_id % 19 = 0 THEN 'n/a' ELSE CAST(round(trip_distance, 3) AS VARCHAR) END AS DOUBLE), 6) AS trip_distance
    FROM trips""",
)


@register("lenient_casts", LENIENT_SQL)
def q_lenient_casts(spark, sf):
    t = _trips(spark, sf)
    raw = t.select(
        "trip_id",
        F.when(F.col("trip_id") % 23 == 0, F.lit("not-a-date")).otherwise(F.col("tpep_pickup_datetime").cast("string")).alias("tpep_pickup_datetime"),
        F.when(F.col("trip_id") % 19 == 0, F.lit("n/a")).otherwise(F.round("trip_distance", 3).cast("string")).alias("trip_distance"),
    )
    return clean.lenient_casts(raw, timestamps=("tpep_pickup_datetime",), numerics=("trip_distance",))


@register(
    "drop_null_trio",
    O.with_ctes(O.TRIPS, select=f"SELECT {TRIP_SELECT} FROM trips WHERE passenger_count IS NOT NULL AND RatecodeID IS NOT NULL AND store_and_fwd_flag IS NOT NULL"),
)
def q_drop_null_trio(spark, sf):
    return clean.drop_null_trio(_trips(spark, sf))


def _impute_all_sql() -> str:
    ctes = [
        TRIPS_NAN,
        O.mode_cte("m_pc", "trips", "passenger_count"),
        O.mode_cte("m_rc", "trips", "RatecodeID"),
        O.mode_cte("m_sf", "trips", "store_and_fwd_flag"),
    ]
    return O.with_ctes(
        *ctes,
        select="""SELECT t.trip_id, t.file_month,
          round(coalesce(t.passenger_count, m_pc.m, 1.0), 6) AS passenger_count,
          round(coalesce(t.RatecodeID, m_rc.m, 1.0), 6) AS RatecodeID,
          coalesce(t.store_and_fwd_flag, m_sf.m, 'N') AS store_and_fwd_flag
        FROM trips t LEFT JOIN m_pc USING (file_month) LEFT JOIN m_rc USING (file_month) LEFT JOIN m_sf USING (file_month)""",
    )


@register("impute_mode", _impute_all_sql())
def q_impute_mode(spark, sf):
    t = clean.impute_mode(_trips_with_nan(spark, sf))
    return t.select("trip_id", FILE_MONTH, "passenger_count", "RatecodeID", "store_and_fwd_flag")


@register(
    "missing_policy",
    O.with_ctes(TRIPS_NAN, O.MONTH_FILTERED, O.MISSING_HANDLED, select=f"SELECT {TRIP_SELECT} FROM mh"),
)
def q_missing_policy(spark, sf):
    out = clean.missing_policy(clean.month_filter(_trips_with_nan(spark, sf)))
    return nan_as_null(out, ["trip_distance"])


@register("range_filter", O.with_ctes(TRIPS_NAN, select=f"SELECT {TRIP_SELECT} FROM trips WHERE {O.RANGE_OK}"))
def q_range_filter(spark, sf):
    return clean.range_filter(_trips_with_nan(spark, sf))


@register(
    "outlier_summary",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT file_month, count(*) AS rows_raw, count(*) FILTER (WHERE {O.RANGE_OK}) AS rows_clean,
          count(*) - count(*) FILTER (WHERE {O.RANGE_OK}) AS rows_removed,
          count(*) FILTER (WHERE passenger_count < 1) AS passenger_count_below,
          count(*) FILTER (WHERE passenger_count > 9) AS passenger_count_above,
          count(*) FILTER (WHERE trip_distance < 0.1) AS trip_distance_below,
          count(*) FILTER (WHERE trip_distance > 50) AS trip_distance_above,
          count(*) FILTER (WHERE total_amount < 1) AS total_amount_below,
          count(*) FILTER (WHERE total_amount > 250) AS total_amount_above
        FROM trips GROUP BY file_month""",
    ),
)
def q_outlier_summary(spark, sf):
    return clean.outlier_summary(_trips(spark, sf))


@register(
    "fix_locations",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT {TRIP_SELECT.replace('PULocationID', 'CASE WHEN PULocationID = 57 THEN 56 ELSE PULocationID END AS PULocationID').replace('DOLocationID', 'CASE WHEN DOLocationID = 57 THEN 56 ELSE DOLocationID END AS DOLocationID')}
        FROM trips WHERE PULocationID NOT IN (264, 265) AND DOLocationID NOT IN (264, 265)""",
    ),
)
def q_fix_locations(spark, sf):
    return clean.fix_locations(_trips(spark, sf))


DUR = "date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 60000000.0::DOUBLE"


@register(
    "duration_filter",
    O.with_ctes(O.TRIPS, select=f"SELECT {TRIP_SELECT}, round({DUR}, 6) AS trip_duration FROM trips WHERE {DUR} IS NULL OR {DUR} BETWEEN 1 AND 180"),
)
def q_duration_filter(spark, sf):
    return clean.duration_filter(_trips(spark, sf))


@register(
    "drop_any_null",
    O.with_ctes(
        O.TRIPS,
        select=f"SELECT {TRIP_SELECT} FROM trips WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in TRIP_COLS),
    ),
)
def q_drop_any_null(spark, sf):
    return clean.drop_any_null(_trips(spark, sf))


# ============================================================ D: joins


@register(
    "join_centroids",
    O.with_ctes(
        O.TRIPS,
        O.ZONES,
        select="""SELECT t.trip_id, round(zp.lon, 6) AS pickup_lon, round(zp.lat, 6) AS pickup_lat,
          round(zd.lon, 6) AS dropoff_lon, round(zd.lat, 6) AS dropoff_lat
        FROM trips t LEFT JOIN zones zp ON t.PULocationID = zp.LocationID LEFT JOIN zones zd ON t.DOLocationID = zd.LocationID""",
    ),
)
def q_join_centroids(spark, sf):
    j = joins.join_centroids(_trips(spark, sf), fx.fixture_zones(spark))
    return j.select("trip_id", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")


@register(
    "lookup_borough",
    O.with_ctes(
        O.TRIPS,
        O.ZONES,
        select="""SELECT t.trip_id, coalesce(lp.Borough, 'Unknown') AS pickup_borough,
          coalesce(lp.service_zone, 'Unknown') AS pickup_service_zone,
          coalesce(ld.Borough, 'Unknown') AS dropoff_borough, coalesce(ld.service_zone, 'Unknown') AS dropoff_service_zone
        FROM trips t LEFT JOIN zone_lookup lp ON t.PULocationID = lp.LocationID
        LEFT JOIN zone_lookup ld ON t.DOLocationID = ld.LocationID""",
    ),
)
def q_lookup_borough(spark, sf):
    j = joins.lookup_borough(_trips(spark, sf), fx.fixture_zone_lookup(spark))
    return j.select("trip_id", "pickup_borough", "pickup_service_zone", "dropoff_borough", "dropoff_service_zone")


HOL_FLAGS_SQL = O.with_ctes(
    O.TRIPS,
    O.HOLIDAYS,
    select="""SELECT trip_id,
      CAST(CAST(tpep_pickup_datetime AS DATE) IN (SELECT holiday_date FROM holidays) AS INTEGER) AS is_holiday,
      CAST(coalesce(
        (isodow(tpep_pickup_datetime) = 5 AND CAST(tpep_pickup_datetime AS DATE) + 3 IN (SELECT holiday_date FROM holidays)
          AND year(CAST(tpep_pickup_datetime AS DATE) + 3) = year(tpep_pickup_datetime))
        OR (isodow(tpep_pickup_datetime) = 1 AND CAST(tpep_pickup_datetime AS DATE) - 3 IN (SELECT holiday_date FROM holidays)
          AND year(CAST(tpep_pickup_datetime AS DATE) - 3) = year(tpep_pickup_datetime)), FALSE) AS INTEGER) AS is_long_weekend
    FROM trips""",
)


@register(
    "is_holiday",
    O.with_ctes(
        O.TRIPS,
        O.HOLIDAYS,
        select="""SELECT trip_id,
          CAST(CAST(tpep_pickup_datetime AS DATE) IN (SELECT holiday_date FROM holidays) AS INTEGER) AS is_holiday
        FROM trips""",
    ),
)
def q_is_holiday(spark, sf):
    return joins.is_holiday(_trips(spark, sf), calendar_flags(holiday_calendar(spark))).select("trip_id", "is_holiday")


@register("is_long_weekend", HOL_FLAGS_SQL.replace(
    """CAST(CAST(tpep_pickup_datetime AS DATE) IN (SELECT holiday_date FROM holidays) AS INTEGER) AS is_holiday,
      """, ""))
def q_is_long_weekend(spark, sf):
    return joins.is_long_weekend(_trips(spark, sf), calendar_flags(holiday_calendar(spark))).select("trip_id", "is_long_weekend")


@register(
    "holiday_calendar",
    O.with_ctes(
        O.TRIPS,
        O.HOLIDAYS,
        select="SELECT holiday_date FROM holidays WHERE year(holiday_date) IN (SELECT DISTINCT year(tpep_pickup_datetime) FROM trips)",
    ),
)
def q_holiday_calendar(spark, sf):
    years = _trips(spark, sf).select(F.year("tpep_pickup_datetime").alias("y")).distinct()
    cal = holiday_calendar(spark).select("holiday_date").distinct()
    return cal.join(years, F.year("holiday_date") == F.col("y"), "left_semi")


@register(
    "align_outer",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT coalesce(p.v, q.v) AS hour, round(coalesce(p.share, 0), 6) AS p, round(coalesce(q.share, 0), 6) AS q
        FROM (SELECT hour(tpep_pickup_datetime) AS v, count(*) / sum(count(*)) OVER () AS share FROM trips GROUP BY 1) p
        FULL OUTER JOIN (SELECT hour(tpep_dropoff_datetime) AS v, count(*) / sum(count(*)) OVER () AS share FROM trips GROUP BY 1) q
        ON p.v IS NOT DISTINCT FROM q.v""",
    ),
)
def q_align_outer(spark, sf):
    """Pickup-hour vs dropoff-hour shares; the dropoff side has a NULL hour the pickup side lacks."""
    t = _trips(spark, sf)

    def shares(col):
        c = t.groupBy(F.hour(col).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
        tot = c.agg(F.sum("n").alias("tot")).select(F.lit(1).alias("_k"), "tot")  # one row
        return c.join(F.broadcast(tot), F.lit(1) == F.col("_k")).select("hour", (F.col("n") / F.col("tot")).alias("share"))

    return joins.align_outer(shares("tpep_pickup_datetime"), shares("tpep_dropoff_datetime"), ["hour"])


# ============================================================ E: features


@register("trip_duration", O.with_ctes(O.TRIPS, select=f"SELECT trip_id, round({DUR}, 6) AS trip_duration FROM trips"))
def q_trip_duration(spark, sf):
    return features.trip_duration(_trips(spark, sf)).select("trip_id", "trip_duration")


@register(
    "time_parts",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT trip_id, hour(tpep_pickup_datetime) AS pickup_hour, hour(tpep_dropoff_datetime) AS dropoff_hour,
          isodow(tpep_pickup_datetime) - 1 AS pickup_dayofweek, month(tpep_pickup_datetime) AS pickup_month,
          minute(tpep_pickup_datetime) AS pickup_minute, CAST(tpep_pickup_datetime AS DATE) AS pickup_date FROM trips""",
    ),
)
def q_time_parts(spark, sf):
    t = features.time_parts(_trips(spark, sf))
    return t.select(
        "trip_id",
        *[F.col(c).cast("long").alias(c) for c in ("pickup_hour", "dropoff_hour", "pickup_dayofweek", "pickup_month", "pickup_minute")],
        "pickup_date",
    )


@register(
    "cyclic_time",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT trip_id,
          round(sin(2 * pi() * hour(tpep_pickup_datetime) / 24), 6) AS pickup_hour_sin,
          round(cos(2 * pi() * hour(tpep_pickup_datetime) / 24), 6) AS pickup_hour_cos,
          round(sin(2 * pi() * hour(tpep_dropoff_datetime) / 24), 6) AS dropoff_hour_sin,
          round(cos(2 * pi() * hour(tpep_dropoff_datetime) / 24), 6) AS dropoff_hour_cos,
          round(sin(2 * pi() * (isodow(tpep_pickup_datetime) - 1) / 7), 6) AS dow_sin,
          round(cos(2 * pi() * (isodow(tpep_pickup_datetime) - 1) / 7), 6) AS dow_cos,
          round(sin(2 * pi() * (month(tpep_pickup_datetime) - 1) / 12), 6) AS month_sin,
          round(cos(2 * pi() * (month(tpep_pickup_datetime) - 1) / 12), 6) AS month_cos
        FROM trips""",
    ),
)
def q_cyclic_time(spark, sf):
    t = features.cyclic_time(features.time_parts(_trips(spark, sf)))
    return t.select("trip_id", *[f"{p}_{f}" for p in ("pickup_hour", "dropoff_hour", "dow", "month") for f in ("sin", "cos")])


@register(
    "pickup_period",
    O.with_ctes(O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips"),
                select="""SELECT trip_id, pickup_period, is_weekend, is_rush_hour, is_nightlife, is_friday_getaway,
                  is_holiday, is_long_weekend FROM feat"""),
)
def q_pickup_period(spark, sf):
    return _features(spark, sf).select(
        "trip_id", "pickup_period", "is_weekend", "is_rush_hour", "is_nightlife", "is_friday_getaway", "is_holiday", "is_long_weekend"
    )


@register(
    "haversine",
    O.with_ctes(O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips"),
                select="SELECT trip_id, round(haversine_distance, 6) AS haversine_distance FROM feat"),
)
def q_haversine(spark, sf):
    return _features(spark, sf).select("trip_id", "haversine_distance")


@register(
    "engineer_features",
    O.with_ctes(O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips"), select=f"SELECT {FEATURE_SELECT} FROM feat"),
)
def q_engineer_features(spark, sf):
    t = joins.join_centroids(clean.fix_locations(_trips(spark, sf)), fx.fixture_zones(spark))
    out = features.engineer_features(t, calendar_flags(holiday_calendar(spark)), lookup=fx.fixture_zone_lookup(spark))
    return out.select(*FEATURE_OTHER, *FEATURE_DOUBLES)


@register(
    "build_features",
    O.with_ctes(O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips"), select=f"SELECT {FEATURE_SELECT} FROM feat"),
)
def q_build_features(spark, sf):
    return _features(spark, sf).select(*FEATURE_OTHER, *FEATURE_DOUBLES)


NO_ZONE_DOUBLES = tuple(c for c in FEATURE_DOUBLES if not c.endswith(("_lon", "_lat")))


@register(
    "build_features_no_geometry",
    O.with_ctes(
        O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips", with_zones=False),
        select=f"SELECT {', '.join(FEATURE_OTHER)}, {_sel_round(NO_ZONE_DOUBLES)} FROM feat",
    ),
)
def q_build_features_no_geometry(spark, sf):
    return _features(spark, sf, with_zones=False).select(*FEATURE_OTHER, *NO_ZONE_DOUBLES)


@register(
    "preprocess_features",
    O.with_ctes(
        O.TRIPS, O.MONTH_FILTERED, O.MISSING_HANDLED, O.ZONES, O.HOLIDAYS,
        "\ncleaned AS (SELECT * FROM mh WHERE " + O.RANGE_OK + ")",
        O.features_sql("cleaned"),
        select=f"SELECT {FEATURE_SELECT} FROM feat",
    ),
)
def q_preprocess_features(spark, sf):
    return _features(spark, sf, src=_cleaned(spark, sf)).select(*FEATURE_OTHER, *FEATURE_DOUBLES)


# ============================================================ F: geometry


def _centroid_sql() -> str:
    from farelane.operators.geometry import lcc_inverse_sql

    lon, lat = lcc_inverse_sql("cx", "cy")
    return f"""
WITH v AS (
  SELECT CAST(o_custkey % 263 + 1 AS INTEGER) AS LocationID, o_orderkey AS ring, s.seq,
    913000.0::DOUBLE + CAST(o_custkey % 263 AS DOUBLE) * 600.0::DOUBLE + CAST(o_orderkey % 50 AS DOUBLE) * 40.0::DOUBLE
      + (100.0::DOUBLE + CAST(o_orderkey % 9 AS DOUBLE) * 25.0::DOUBLE) * s.dx AS x,
    121000.0::DOUBLE + CAST(o_custkey % 97 AS DOUBLE) * 1500.0::DOUBLE + CAST(o_orderkey % 30 AS DOUBLE) * 35.0::DOUBLE
      + (CASE WHEN o_orderkey % 5 = 4 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END)
        * (100.0::DOUBLE + CAST(o_orderkey % 9 AS DOUBLE) * 25.0::DOUBLE) * s.dy AS y
  FROM orders, (VALUES (0, -1.0::DOUBLE, -1.0::DOUBLE), (1, 1.0, -1.0), (2, 1.0, 1.0), (3, -1.0, 1.0)) AS s(seq, dx, dy)
),
e AS (
  SELECT a.LocationID, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1
  FROM v a JOIN v b ON a.LocationID = b.LocationID AND a.ring = b.ring AND b.seq = (a.seq + 1) % 4
),
s AS (
  SELECT LocationID, sum(x0 * y1 - x1 * y0) / 2 AS area,
    sum((x0 + x1) * (x0 * y1 - x1 * y0)) AS sx, sum((y0 + y1) * (x0 * y1 - x1 * y0)) AS sy
  FROM e GROUP BY LocationID
),
c AS (SELECT LocationID, area, sx / (6 * area) AS cx, sy / (6 * area) AS cy FROM s)
SELECT LocationID, round(area, 2) AS area, round(cx, 3) AS x, round(cy, 3) AS y,
  round({lon}, 6) AS lon, round({lat}, 6) AS lat
FROM c"""


@register("zone_centroids", _centroid_sql())
def q_zone_centroids(spark, sf):
    v = fx.zone_vertices_from_orders(fx.read_table(spark, sf, "orders"))
    c = zone_centroids(v)
    return c.select("LocationID", F.round("area", 2).alias("area"), F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "lon", "lat")


# ============================================================ G: splits and sampling

SPLIT_SQL_EXPR = """CASE WHEN substr(file_month, 1, 4) = '2024' THEN 'train'
       WHEN substr(file_month, 1, 4) = '2025' AND CAST(substr(file_month, 6, 2) AS INTEGER) BETWEEN 1 AND 6 THEN 'val'
       WHEN file_month = '2025-07' THEN 'test' ELSE 'ignore' END"""


@register("assign_split", O.with_ctes(O.TRIPS, select=f"SELECT trip_id, file_month, {SPLIT_SQL_EXPR} AS split FROM trips"))
def q_assign_split(spark, sf):
    return sampling.assign_split(_trips(spark, sf)).select("trip_id", FILE_MONTH, "split")


@register(
    "bucket_splits",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT split, array_to_string(list(file_month ORDER BY file_month), ',') AS months FROM (
          SELECT DISTINCT file_month, {SPLIT_SQL_EXPR} AS split FROM trips) WHERE split <> 'ignore' GROUP BY split""",
    ),
)
def q_bucket_splits(spark, sf):
    b = sampling.bucket_splits(_trips(spark, sf))
    return b.select("split", F.array_join("months", ",").alias("months"))


def _topn_sql(src: str, n_expr: str, seed: int = 42, part: str = "file_month", cols: str = "trip_id, file_month") -> str:
    return f"""SELECT {cols} FROM (
      SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY md5(CAST(trip_id AS VARCHAR) || ':{seed}'), trip_id) AS rn
      FROM {src}) WHERE rn <= {n_expr}"""


@register("sample_fixed_n", O.with_ctes(O.TRIPS, select=_topn_sql("trips", "40")))
def q_sample_fixed_n(spark, sf):
    return sampling.sample_fixed_n(_trips(spark, sf), 40).select("trip_id", FILE_MONTH)


SPLIT_N_SQL = f"CASE split WHEN 'train' THEN {SPLIT_ROWS['train']} WHEN 'val' THEN {SPLIT_ROWS['val']} WHEN 'test' THEN {SPLIT_ROWS['test']} END"


@register(
    "build_splits",
    O.with_ctes(
        O.TRIPS,
        f"\ntagged AS (SELECT *, {SPLIT_SQL_EXPR} AS split FROM trips)",
        select=_topn_sql("(SELECT * FROM tagged WHERE split <> 'ignore')", SPLIT_N_SQL, cols="trip_id, file_month, split"),
    ),
)
def q_build_splits(spark, sf):
    return sampling.build_splits(_trips(spark, sf), SPLIT_ROWS).select("trip_id", FILE_MONTH, "split")


@register("sample_capped", O.with_ctes(O.TRIPS, select=_topn_sql("trips", "250", seed=42)))
def q_sample_capped(spark, sf):
    return sampling.sample_capped(_trips(spark, sf), 250).select("trip_id", FILE_MONTH)


@register(
    "sample_fraction",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT trip_id, file_month FROM (
          SELECT *, row_number() OVER (ORDER BY md5(CAST(trip_id AS VARCHAR) || ':7'), trip_id) AS rn,
                 count(*) OVER () AS n FROM trips) WHERE rn <= round(n * 0.15)""",
    ),
)
def q_sample_fraction(spark, sf):
    return sampling.sample_fraction(_trips(spark, sf), 0.15, seed=7).select("trip_id", FILE_MONTH)


@register(
    "sample_fraction_bernoulli",
    O.with_ctes(
        O.TRIPS,
        select="""SELECT trip_id, file_month FROM trips
          WHERE CAST(('0x' || substr(md5(CAST(trip_id AS VARCHAR) || ':7'), 1, 8)) AS UBIGINT) / 4294967296.0 < 0.15""",
    ),
)
def q_sample_fraction_bernoulli(spark, sf):
    return sampling.sample_fraction(_trips(spark, sf), 0.15, seed=7, exact=False).select("trip_id", FILE_MONTH)


# ============================================================ H: audits


@register(
    "co_missing",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT file_month, count(*) AS n_rows,
          count(*) FILTER (WHERE nn > 0 AND nn < 3) AS n_partial, count(*) FILTER (WHERE nn > 0) AS rows_lost,
          round(count(*) FILTER (WHERE nn > 0) * 100.0 / count(*), 6) AS pct_lost,
          CASE WHEN count(*) FILTER (WHERE nn > 0 AND nn < 3) = 0 THEN '{audits.CO_MISSING_ALL}'
               ELSE '{audits.CO_MISSING_PARTIAL}' END AS status
        FROM (SELECT *, CAST(passenger_count IS NULL AS INTEGER) + CAST(RatecodeID IS NULL AS INTEGER)
                        + CAST(store_and_fwd_flag IS NULL AS INTEGER) AS nn FROM trips) GROUP BY file_month""",
    ),
)
def q_co_missing(spark, sf):
    return audits.co_missing(_trips(spark, sf))


def _null_profile_sql() -> str:
    cols = [c for c in TRIP_COLS if c != FILE_MONTH]
    parts = [
        f"SELECT file_month, '{c}' AS column, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 6) AS pct_null FROM trips GROUP BY file_month"
        for c in cols
    ]
    return O.with_ctes(O.TRIPS, select="\nUNION ALL\n".join(parts))


@register("null_profile", _null_profile_sql())
def q_null_profile(spark, sf):
    return audits.null_profile(_trips(spark, sf).select(*TRIP_COLS))


def _tvd_sql(src: str, col_expr: str, name: str) -> str:
    return f"""
tvd_{name} AS (
  SELECT file_month, 0.5 * sum(abs(c_p / n_p - CASE WHEN n_q > 0 THEN c_q / n_q ELSE 0 END)) AS tvd FROM (
    SELECT file_month, v, count(*) AS c_p, count(*) FILTER (WHERE kept) AS c_q,
           sum(count(*)) OVER (PARTITION BY file_month) AS n_p,
           sum(count(*) FILTER (WHERE kept)) OVER (PARTITION BY file_month) AS n_q
    FROM (SELECT file_month, {col_expr} AS v, kept FROM {src}) GROUP BY file_month, v
  ) GROUP BY file_month
)"""


def _drop_impact_sql() -> str:
    src = "(SELECT *, passenger_count IS NOT NULL AND RatecodeID IS NOT NULL AND store_and_fwd_flag IS NOT NULL AS kept FROM mf)"
    tv = [
        _tvd_sql(src, "PULocationID", "pu"),
        _tvd_sql(src, "DOLocationID", "do"),
        _tvd_sql(src, "hour(tpep_pickup_datetime)", "hour"),
        _tvd_sql(src, "payment_type", "pay"),
    ]
    return O.with_ctes(
        O.TRIPS,
        O.MONTH_FILTERED,
        *tv,
        f"\nbase AS (SELECT file_month, count(*) AS rows_total, count(*) FILTER (WHERE kept) AS rows_after_dropna,"
        f" avg(total_amount) AS ta_all, avg(total_amount) FILTER (WHERE kept) AS ta_clean,"
        f" avg(trip_distance) AS td_all, avg(trip_distance) FILTER (WHERE kept) AS td_clean FROM {src} GROUP BY file_month)",
        select="""SELECT b.file_month AS month, rows_total, rows_after_dropna,
          round(round((rows_total - rows_after_dropna) * 100.0 / rows_total, 2), 6) AS pct_dropped,
          round(ta_all, 2) AS total_amount_mean_all, round(ta_clean, 2) AS total_amount_mean_clean,
          round(td_all, 3) AS trip_dist_mean_all, round(td_clean, 3) AS trip_dist_mean_clean,
          round(tvd_pu.tvd, 3) AS TVD_PULocationID, round(tvd_do.tvd, 3) AS TVD_DOLocationID,
          round(tvd_hour.tvd, 3) AS TVD_hour, round(tvd_pay.tvd, 3) AS TVD_payment_type
        FROM base b JOIN tvd_pu USING (file_month) JOIN tvd_do USING (file_month)
          JOIN tvd_hour USING (file_month) JOIN tvd_pay USING (file_month)""",
    )


@register("drop_impact", _drop_impact_sql())
def q_drop_impact(spark, sf):
    return audits.drop_impact(clean.month_filter(_trips(spark, sf)))


@register(
    "tvd",
    O.with_ctes(
        O.TRIPS,
        O.MONTH_FILTERED,
        _tvd_sql("(SELECT *, passenger_count IS NOT NULL AS kept FROM mf)", "payment_type", "pay"),
        select="SELECT file_month, round(tvd, 6) AS tvd FROM tvd_pay",
    ),
)
def q_tvd(spark, sf):
    mf = clean.month_filter(_trips(spark, sf))
    return stats.tvd(mf, mf.where(F.col("passenger_count").isNotNull()), "payment_type", [FILE_MONTH])


@register(
    "ks_distance",
    O.with_ctes(
        O.TRIPS,
        O.MONTH_FILTERED,
        select="""SELECT file_month, round(max(abs(cx / nx - cy / ny)), 6) AS ks FROM (
          SELECT file_month, v,
            sum(c_x) OVER (PARTITION BY file_month ORDER BY v) AS cx, sum(c_y) OVER (PARTITION BY file_month ORDER BY v) AS cy,
            sum(c_x) OVER (PARTITION BY file_month) AS nx, sum(c_y) OVER (PARTITION BY file_month) AS ny
          FROM (SELECT file_month, trip_distance AS v, count(*) AS c_x,
                       count(*) FILTER (WHERE passenger_count IS NOT NULL AND total_amount < 150) AS c_y
                FROM mf WHERE isfinite(trip_distance) GROUP BY file_month, trip_distance)
        ) GROUP BY file_month""",
    ),
)
def q_ks_distance(spark, sf):
    mf = clean.month_filter(_trips(spark, sf))
    sub = F.col("passenger_count").isNotNull() & (F.col("total_amount") < 150)
    return stats.ks_subset(mf, "trip_distance", sub, [FILE_MONTH], buckets=8)


@register(
    "quantile_scan",
    O.with_ctes(
        O.TRIPS,
        O.MONTH_FILTERED,
        O.MISSING_HANDLED,
        select="\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column, round(min(q01), 2) AS q01_min, round(max(q99), 2) AS q99_max,
              round(min(mn), 2) AS global_min, round(max(mx), 2) AS global_max FROM (
              SELECT quantile_cont({c}, 0.01) AS q01, quantile_cont({c}, 0.99) AS q99, min({c}) AS mn, max({c}) AS mx
              FROM mh GROUP BY file_month)"""
            for c in ("passenger_count", "trip_distance", "total_amount")
        ),
    ),
)
def q_quantile_scan(spark, sf):
    return audits.quantile_scan(sinks.materialize(clean.missing_policy(clean.month_filter(_raw_trips(spark, sf))), "quantile_rows"))


@register(
    "outlier_share",
    O.with_ctes(
        O.TRIPS,
        O.MONTH_FILTERED,
        O.MISSING_HANDLED,
        select="\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS n_outside, count({c}) AS n_total,
              round(count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) * 100.0 / count({c}), 6) AS pct_outside FROM mh"""
            for c, (lo, hi) in (("passenger_count", (1, 9)), ("trip_distance", (0.1, 50)), ("total_amount", (1, 250)))
        ),
    ),
)
def q_outlier_share(spark, sf):
    return audits.outlier_share(clean.missing_policy(clean.month_filter(_trips(spark, sf))))


@register(
    "location_fix_summary",
    O.with_ctes(
        O.TRIPS,
        O.ZONES,
        """
fixed AS (SELECT * FROM trips WHERE PULocationID NOT IN (264, 265) AND DOLocationID NOT IN (264, 265)),
j AS (SELECT f.file_month, zp.lon AS plon, zd.lon AS dlon FROM fixed f
      LEFT JOIN zones zp ON (CASE WHEN f.PULocationID = 57 THEN 56 ELSE f.PULocationID END) = zp.LocationID
      LEFT JOIN zones zd ON (CASE WHEN f.DOLocationID = 57 THEN 56 ELSE f.DOLocationID END) = zd.LocationID)""",
        select="""SELECT i.file_month, i.rows_in, coalesce(o.rows_out, 0) AS rows_out,
          i.rows_in - coalesce(k.kept, 0) AS rows_dropped_invalidID,
          coalesce(o.mp, 0) AS missing_pickup_coords, coalesce(o.md, 0) AS missing_dropoff_coords
        FROM (SELECT file_month, count(*) AS rows_in FROM trips GROUP BY 1) i
        LEFT JOIN (SELECT file_month, count(*) AS kept FROM fixed GROUP BY 1) k USING (file_month)
        LEFT JOIN (SELECT file_month, count(*) AS rows_out, count(*) FILTER (WHERE plon IS NULL) AS mp,
                          count(*) FILTER (WHERE dlon IS NULL) AS md FROM j GROUP BY 1) o USING (file_month)""",
    ),
)
def q_location_fix_summary(spark, sf):
    return audits.location_fix_summary(_trips(spark, sf), fx.fixture_zones(spark))


@register(
    "duration_share",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE {DUR} < 1 OR {DUR} > 180) AS n_outside,
          round(count(*) FILTER (WHERE {DUR} < 1 OR {DUR} > 180) / count(*), 6) AS share_outside FROM trips""",
    ),
)
def q_duration_share(spark, sf):
    return audits.duration_share(_trips(spark, sf))


@register(
    "describe_duration",
    O.with_ctes(
        O.TRIPS,
        select=f"""SELECT file_month, count(d) AS count, round(round(avg(d), 2), 6) AS mean, round(round(stddev_samp(d), 2), 6) AS std,
          round(round(min(d), 2), 6) AS min, round(round(quantile_cont(d, 0.01), 2), 6) AS p01,
          round(round(quantile_cont(d, 0.5), 2), 6) AS p50, round(round(quantile_cont(d, 0.99), 2), 6) AS p99,
          round(round(max(d), 2), 6) AS max
        FROM (SELECT file_month, {DUR} AS d FROM trips) GROUP BY file_month""",
    ),
)
def q_describe_duration(spark, sf):
    return audits.describe_duration(_trips(spark, sf))


@register(
    "unmapped_boroughs",
    O.with_ctes(
        O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips"),
        select="""SELECT file_month, count(*) FILTER (WHERE pickup_borough = 'Unknown') AS unmapped_pickup,
          count(*) FILTER (WHERE dropoff_borough = 'Unknown') AS unmapped_dropoff FROM feat GROUP BY file_month""",
    ),
)
def q_unmapped_boroughs(spark, sf):
    return audits.unmapped_boroughs(_features(spark, sf))


@register(
    "nunique_profile",
    O.with_ctes(
        O.TRIPS,
        select="\nUNION ALL\n".join(f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_unique FROM trips" for c in TRIP_COLS),
    ),
)
def q_nunique_profile(spark, sf):
    return audits.nunique_profile(_trips(spark, sf).select(*TRIP_COLS))


@register(
    "profile_merge",
    O.with_ctes(
        O.TRIPS,
        select="\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, count(DISTINCT file_month) AS n_files, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_unique, TRUE AS near, TRUE AS near_whole FROM trips"
            for c in TRIP_COLS[:-1]
        ),
    ),
)
def q_profile_merge(spark, sf):
    """Profiles of two sets of months, stored one after the other and merged; beside them the exact counts."""
    t = _trips(spark, sf).select(*TRIP_COLS)
    path = sinks.shared_dir(spark, "profiles")
    late = F.col(FILE_MONTH) >= "2025-01"
    for part in (~late, late):
        profiles.store_profiles(profiles.profile_files(t.filter(part)), path)
    merged = profiles.merged_profile(profiles.stored_profiles(spark, path))
    whole = profiles.merged_profile(profiles.profile_files(t.withColumn(FILE_MONTH, F.lit("all")))).select("column", F.col("n_unique").alias("n_whole"))
    exact = audits.nunique_profile(t, TRIP_COLS[:-1]).select("column", F.col("n_unique").alias("n_exact"))
    both = merged.join(whole, "column").join(exact, "column")
    near = F.abs(F.col("n_unique") - F.col("n_exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("n_exact"))
    return both.select("column", "n_files", "n_rows", "n_null", F.col("n_exact").alias("n_unique"), near.alias("near"), (F.abs(F.col("n_unique") - F.col("n_whole")) <= F.greatest(F.lit(1.0), 0.03 * F.col("n_whole"))).alias("near_whole"))


def _bias_sql() -> str:
    """H6 over the split sample (build_splits) and its population, seeds 0, 1, 2, 3, 42."""
    pop = f"(SELECT *, {SPLIT_SQL_EXPR} AS split FROM feat) p0"
    return O.with_ctes(
        O.TRIPS, O.ZONES, O.HOLIDAYS, O.features_sql("trips"),
        f"\npop AS (SELECT * FROM {pop} WHERE split <> 'ignore')",
        "\nsplit_sample AS (" + _topn_sql("pop", SPLIT_N_SQL, cols="trip_id, split") + ")",
        "\nsizes AS (SELECT split, count(*) AS n FROM split_sample GROUP BY split)",
        "\nseeds AS (SELECT * FROM (VALUES (0), (1), (2), (3), (42)) t(seed))",
        """
drawn AS (
  SELECT * FROM (
    SELECT p.*, s.seed, z.n,
      row_number() OVER (PARTITION BY p.split, s.seed ORDER BY md5(CAST(p.trip_id AS VARCHAR) || ':' || CAST(s.seed AS VARCHAR)), p.trip_id) AS rn
    FROM pop p JOIN sizes z USING (split) CROSS JOIN seeds s) WHERE rn <= n
),
cat_long AS (
  SELECT split, 'payment_type' AS col, CAST(payment_type AS VARCHAR) AS v FROM pop
  UNION ALL SELECT split, 'pickup_borough', pickup_borough FROM pop
),
cat_s AS (
  SELECT split, seed, 'payment_type' AS col, CAST(payment_type AS VARCHAR) AS v FROM drawn
  UNION ALL SELECT split, seed, 'pickup_borough', pickup_borough FROM drawn
),
pc AS (SELECT split, col, v, count(*) AS c FROM cat_long GROUP BY ALL),
sc AS (SELECT split, seed, col, v, count(*) AS c FROM cat_s GROUP BY ALL),
pcs AS (SELECT pc.*, seeds.seed FROM pc CROSS JOIN seeds WHERE pc.split IN (SELECT split FROM sizes)),
tv AS (
  SELECT split, seed, col, 0.5 * sum(abs(p / np - q / nq)) AS tvd FROM (
    SELECT coalesce(a.split, b.split) AS split, coalesce(a.seed, b.seed) AS seed, coalesce(a.col, b.col) AS col,
      coalesce(a.c, 0) AS p, coalesce(b.c, 0) AS q,
      sum(coalesce(a.c, 0)) OVER (PARTITION BY coalesce(a.split, b.split), coalesce(a.seed, b.seed), coalesce(a.col, b.col)) AS np,
      sum(coalesce(b.c, 0)) OVER (PARTITION BY coalesce(a.split, b.split), coalesce(a.seed, b.seed), coalesce(a.col, b.col)) AS nq
    FROM pcs a FULL OUTER JOIN sc b ON a.split = b.split AND a.seed = b.seed AND a.col = b.col AND a.v IS NOT DISTINCT FROM b.v
  ) GROUP BY ALL
),
num_p AS (
  SELECT split, 'trip_distance' AS col, trip_distance AS v FROM pop WHERE isfinite(trip_distance)
  UNION ALL SELECT split, 'trip_duration', trip_duration FROM pop WHERE isfinite(trip_duration)
),
num_s AS (
  SELECT split, seed, 'trip_distance' AS col, trip_distance AS v FROM drawn WHERE isfinite(trip_distance)
  UNION ALL SELECT split, seed, 'trip_duration', trip_duration FROM drawn WHERE isfinite(trip_duration)
),
npc AS (SELECT split, col, v, count(*) AS c FROM num_p GROUP BY ALL),
nsc AS (SELECT split, seed, col, v, count(*) AS c FROM num_s GROUP BY ALL),
npcs AS (SELECT npc.*, seeds.seed FROM npc CROSS JOIN seeds WHERE npc.split IN (SELECT split FROM sizes)),
ks AS (
  SELECT split, seed, col, max(abs(cx / nx - cy / ny)) AS ks FROM (
    SELECT split, seed, col, v,
      sum(p) OVER (PARTITION BY split, seed, col ORDER BY v) AS cx, sum(q) OVER (PARTITION BY split, seed, col ORDER BY v) AS cy,
      sum(p) OVER (PARTITION BY split, seed, col) AS nx, sum(q) OVER (PARTITION BY split, seed, col) AS ny
    FROM (SELECT coalesce(a.split, b.split) AS split, coalesce(a.seed, b.seed) AS seed, coalesce(a.col, b.col) AS col,
            coalesce(a.v, b.v) AS v, coalesce(a.c, 0) AS p, coalesce(b.c, 0) AS q
          FROM npcs a FULL OUTER JOIN nsc b ON a.split = b.split AND a.seed = b.seed AND a.col = b.col AND a.v = b.v)
  ) GROUP BY ALL
),
per_seed AS (
  SELECT t.split, t.seed, t.tvd, k.ks FROM (SELECT split, seed, max(tvd) AS tvd FROM tv GROUP BY ALL) t
  JOIN (SELECT split, seed, max(ks) AS ks FROM ks GROUP BY ALL) k USING (split, seed)
)""",
        select="""SELECT split, round(min(tvd), 6) AS tvd_min, round(avg(tvd), 6) AS tvd_mean, round(max(tvd), 6) AS tvd_max,
          round(min(ks), 6) AS ks_min, round(avg(ks), 6) AS ks_mean, round(max(ks), 6) AS ks_max,
          max(tvd) <= 0.05 AS tvd_ok, max(ks) <= 0.10 AS ks_ok
        FROM per_seed GROUP BY split""",
    )


@register("sampling_bias", _bias_sql())
def q_sampling_bias(spark, sf):
    # the population is read by the split sampler and by the audit: write it once
    feat = sinks.materialize(sampling.assign_split(_features(spark, sf)).where(F.col("split") != "ignore"), "bias_population")
    sample = sampling.build_splits(feat.drop("split"), SPLIT_ROWS)
    return audits.sampling_bias(feat, sample)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from farelane.plans import ml_catalog  # noqa: F401  (registers model / scoring / job queries)

    return dict(QUERIES)


def all_raw_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from farelane.plans import ml_catalog  # noqa: F401

    return dict(RAW_QUERIES)


def all_oracles() -> dict[str, str]:
    from farelane.plans import ml_catalog  # noqa: F401

    return dict(ORACLES)



# ============================================================ A: remaining sources and sinks


@register(
    "scan_zone_lookup",
    """SELECT CAST(n_nationkey AS INTEGER) AS LocationID,
         CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE n_name END AS Borough, r_name AS service_zone
       FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def q_scan_zone_lookup(spark, sf):
    """A4: a lookup CSV (padded header names, ``N/A`` for missing) written from nation x region, read back."""
    nation, region = fx.read_table(spark, sf, "nation"), fx.read_table(spark, sf, "region")
    src = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias(" LocationID "),
        F.when(F.col("n_nationkey") % 7 == 3, F.lit("N/A")).otherwise(F.col("n_name")).alias("Borough "),
        F.col("r_name").alias(" service_zone"),
    )
    path = sinks.shared_dir(spark, "zone_lookup_csv")
    src.coalesce(1).write.option("header", True).csv(path)
    lk = monthly.read_zone_lookup(spark, path)
    return lk.select("LocationID", "Borough", "service_zone")


@register(
    "rewrite_stage",
    O.with_ctes(O.TRIPS, O.MONTH_FILTERED, select="SELECT file_month, count(*) AS n_rows FROM mf GROUP BY file_month"),
)
def q_rewrite_stage(spark, sf):
    """A stage rewritten to a new location and read back from there."""
    staged = sinks.rewrite_stage(clean.month_filter(_trips(spark, sf)), spark, "month_filtered")
    return staged.groupBy(FILE_MONTH).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "sink_splits",
    O.with_ctes(
        O.TRIPS,
        f"\ntagged AS (SELECT *, {SPLIT_SQL_EXPR} AS split FROM trips)",
        select=f"""SELECT split, count(*) AS n_rows FROM (
          {_topn_sql("(SELECT * FROM tagged WHERE split <> 'ignore')", SPLIT_N_SQL, cols="trip_id, split")}) GROUP BY split""",
    ),
)
def q_sink_splits(spark, sf):
    """The split sample written partitioned by split, read back."""
    out = sinks.write_splits(sampling.build_splits(_trips(spark, sf), SPLIT_ROWS), sinks.shared_dir(spark, "splits"))
    return spark.read.parquet(out).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "sink_metrics",
    O.with_ctes(O.TRIPS, select="""SELECT file_month, count(*) AS rows_raw FROM trips GROUP BY file_month"""),
)
def q_sink_metrics(spark, sf):
    """A small result table written as one CSV and one JSON file, read back from the CSV."""
    summary = clean.outlier_summary(_trips(spark, sf)).select(FILE_MONTH, "rows_raw")
    out = sinks.write_metrics(summary, sinks.shared_dir(spark, "metrics"))
    back = spark.read.option("header", True).schema("file_month string, rows_raw long").csv(f"{out}/csv")
    return back
