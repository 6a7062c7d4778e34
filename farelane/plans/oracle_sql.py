"""DuckDB SQL building blocks for the correctness oracle.

These CTEs restate, in plain SQL over the driver's views, the same trip
mapping and dimensions that ``farelane.sources.fixtures`` builds in Spark.
Doubles are rounded to 6 decimals on both sides of every comparison.
"""

from __future__ import annotations

# 2024-2025 rows of the rule-based calendar (US federal + New York State)
HOLIDAYS_2024_2025 = (
    "2024-01-01", "2024-01-15", "2024-02-12", "2024-02-15", "2024-02-19", "2024-05-27", "2024-06-19",
    "2024-07-04", "2024-09-02", "2024-10-14", "2024-11-05", "2024-11-11", "2024-11-28", "2024-12-25",
    "2025-01-01", "2025-01-20", "2025-02-12", "2025-02-15", "2025-02-17", "2025-05-26", "2025-06-19",
    "2025-07-04", "2025-09-01", "2025-10-13", "2025-11-04", "2025-11-11", "2025-11-27", "2025-12-25",
)

TRIPS = """
trip_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS tp,
         (o_orderkey * 7919 + o_custkey * 31) % 831000 AS pu_min,
         (o_custkey * 13 + o_orderkey * 7) % 200 AS dur_min
  FROM orders
),
trips AS (
  SELECT k AS trip_id,
    CAST(k % 2 + 1 AS INTEGER) AS VendorID,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(pu_min) AS tpep_pickup_datetime,
    CASE WHEN k % 101 = 0 THEN NULL
         ELSE TIMESTAMP '2024-01-01 00:00:00' + to_minutes(pu_min + dur_min) END AS tpep_dropoff_datetime,
    CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 11 AS DOUBLE) END AS passenger_count,
    tp / 9000.0::DOUBLE + CAST(k % 7 AS DOUBLE) * 0.5::DOUBLE - 0.4::DOUBLE AS trip_distance,
    CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 6 + 1 AS DOUBLE) END AS RatecodeID,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(c % 266 AS INTEGER) AS PULocationID,
    CAST((c * 7 + k) % 266 AS INTEGER) AS DOLocationID,
    CAST(c % 5 + 1 AS INTEGER) AS payment_type,
    tp / 1900.0::DOUBLE AS total_amount,
    strftime(TIMESTAMP '2024-01-01 00:00:00'
             + to_minutes(pu_min + CASE WHEN k % 97 = 0 THEN 45000 ELSE 0 END), '%Y-%m') AS file_month
  FROM trip_base
)"""

ZONES = """
zone_ids AS (SELECT CAST(range AS INTEGER) AS LocationID FROM range(1, 264) WHERE range % 41 <> 0),
zones AS (
  SELECT LocationID,
         -74.05::DOUBLE + CAST(LocationID % 20 AS DOUBLE) * 0.012::DOUBLE AS lon,
         40.60::DOUBLE + floor(LocationID / 20) * 0.018::DOUBLE AS lat
  FROM zone_ids
),
zone_lookup AS (
  SELECT LocationID,
         CASE LocationID % 5 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Queens' WHEN 2 THEN 'Brooklyn'
                             WHEN 3 THEN 'Bronx' ELSE 'Staten Island' END AS Borough,
         CASE LocationID % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone
  FROM zone_ids
)"""

HOLIDAYS = (
    "\nholidays AS (SELECT CAST(d AS DATE) AS holiday_date FROM (VALUES "
    + ", ".join(f"('{d}')" for d in HOLIDAYS_2024_2025)
    + ") AS t(d))"
)

# month-filtered trips
MONTH_FILTERED = """
mf AS (
  SELECT * FROM trips
  WHERE tpep_pickup_datetime >= CAST(file_month || '-01' AS TIMESTAMP)
    AND tpep_pickup_datetime < CAST(file_month || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH
)"""


def mode_cte(name: str, src: str, col: str, where: str = "TRUE") -> str:
    """Per-file mode of ``col`` with ties to the smallest value."""
    return f"""
{name} AS (
  SELECT file_month, {col} AS m FROM (
    SELECT file_month, {col},
           row_number() OVER (PARTITION BY file_month ORDER BY count(*) DESC, {col} ASC) AS rn
    FROM {src} WHERE {col} IS NOT NULL AND ({where})
    GROUP BY file_month, {col}
  ) WHERE rn = 1
)"""


# missing policy (C6) over ``mf``: 2024 drop, 2025 impute by per-file mode, others vanish
MISSING_HANDLED = (
    mode_cte("m_pc", "mf", "passenger_count", "substr(file_month, 1, 4) = '2025'")
    + ","
    + mode_cte("m_rc", "mf", "RatecodeID", "substr(file_month, 1, 4) = '2025'")
    + ","
    + mode_cte("m_sf", "mf", "store_and_fwd_flag", "substr(file_month, 1, 4) = '2025'")
    + """,
mh AS (
  SELECT mf.trip_id, mf.VendorID, mf.tpep_pickup_datetime, mf.tpep_dropoff_datetime,
    CASE WHEN substr(mf.file_month, 1, 4) = '2025' THEN coalesce(mf.passenger_count, m_pc.m, 1.0::DOUBLE)
         ELSE mf.passenger_count END AS passenger_count,
    mf.trip_distance,
    CASE WHEN substr(mf.file_month, 1, 4) = '2025' THEN coalesce(mf.RatecodeID, m_rc.m, 1.0::DOUBLE)
         ELSE mf.RatecodeID END AS RatecodeID,
    CASE WHEN substr(mf.file_month, 1, 4) = '2025' THEN coalesce(mf.store_and_fwd_flag, m_sf.m, 'N')
         ELSE mf.store_and_fwd_flag END AS store_and_fwd_flag,
    mf.PULocationID, mf.DOLocationID, mf.payment_type, mf.total_amount, mf.file_month
  FROM mf
  LEFT JOIN m_pc ON mf.file_month = m_pc.file_month
  LEFT JOIN m_rc ON mf.file_month = m_rc.file_month
  LEFT JOIN m_sf ON mf.file_month = m_sf.file_month
  WHERE substr(mf.file_month, 1, 4) IN ('2024', '2025')
    AND NOT (substr(mf.file_month, 1, 4) = '2024'
             AND (mf.passenger_count IS NULL OR mf.RatecodeID IS NULL OR mf.store_and_fwd_flag IS NULL))
)"""
)

RANGE_OK = """
  (passenger_count IS NULL OR passenger_count BETWEEN 1 AND 9)
  AND (trip_distance IS NULL OR trip_distance BETWEEN 0.1 AND 50)
  AND (total_amount IS NULL OR total_amount BETWEEN 1 AND 250)"""


def features_sql(src: str, with_zones: bool = True) -> str:
    """E10 over ``src`` (C9 -> D1 -> E9 -> E7) as CTEs ending in ``feat``."""
    coords = (
        """
    zp.lon AS pickup_lon, zp.lat AS pickup_lat, zd.lon AS dropoff_lon, zd.lat AS dropoff_lat,"""
        if with_zones
        else ""
    )
    joins = (
        """
  LEFT JOIN zones zp ON f.PULocationID = zp.LocationID
  LEFT JOIN zones zd ON f.DOLocationID = zd.LocationID"""
        if with_zones
        else ""
    )
    hav = (
        """
    2 * 6371.0 * asin(sqrt(least(
        pow(sin((radians(dropoff_lat) - radians(pickup_lat)) / 2), 2)
        + cos(radians(pickup_lat)) * cos(radians(dropoff_lat))
          * pow(sin((radians(dropoff_lon) - radians(pickup_lon)) / 2), 2), 1.0))) AS haversine_distance"""
        if with_zones
        else "\n    0.0::DOUBLE AS haversine_distance"
    )
    return f"""
fixed AS (
  SELECT * REPLACE (
      CASE WHEN PULocationID = 57 THEN 56 ELSE PULocationID END AS PULocationID,
      CASE WHEN DOLocationID = 57 THEN 56 ELSE DOLocationID END AS DOLocationID)
  FROM {src}
  WHERE NOT coalesce(PULocationID IN (264, 265), FALSE)
    AND NOT coalesce(DOLocationID IN (264, 265), FALSE)
),
with_dur AS (
  SELECT f.*,{coords}
    date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 60000000.0::DOUBLE AS trip_duration,
    hour(tpep_pickup_datetime) AS h, minute(tpep_pickup_datetime) AS mi,
    hour(tpep_dropoff_datetime) AS dh,
    isodow(tpep_pickup_datetime) - 1 AS dow, month(tpep_pickup_datetime) AS mo,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date
  FROM fixed f{joins}
),
dur_ok AS (
  SELECT *,
    CAST(pickup_date IN (SELECT holiday_date FROM holidays) AS INTEGER) AS is_holiday,
    CAST(coalesce((dow = 4 AND pickup_date + 3 IN (SELECT holiday_date FROM holidays)
                   AND year(pickup_date + 3) = year(pickup_date))
               OR (dow = 0 AND pickup_date - 3 IN (SELECT holiday_date FROM holidays)
                   AND year(pickup_date - 3) = year(pickup_date)), FALSE) AS INTEGER) AS is_long_weekend
  FROM with_dur
  WHERE trip_duration IS NULL OR trip_duration BETWEEN 1 AND 180
),
conds AS (
  SELECT *,
    coalesce(dow < 5 AND ((h = 6 AND mi >= 30) OR (h >= 7 AND h < 10)), FALSE) AS c_morning,
    coalesce(dow < 5 AND h >= 16 AND h < 20, FALSE) AS c_evening,
    coalesce(dow IN (3, 4, 5) AND (h >= 22 OR h < 2), FALSE) AS c_late,
    coalesce(dow = 4 AND h >= 12 AND h < 20 AND (is_holiday = 1 OR is_long_weekend = 1), FALSE) AS c_getaway
  FROM dur_ok
),
feat AS (
  SELECT trip_id, VendorID, passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, payment_type,
    total_amount, file_month,{" pickup_lon, pickup_lat, dropoff_lon, dropoff_lat," if with_zones else ""}
    trip_duration,
    sin(2 * pi() * h / 24) AS pickup_hour_sin, cos(2 * pi() * h / 24) AS pickup_hour_cos,
    sin(2 * pi() * dh / 24) AS dropoff_hour_sin, cos(2 * pi() * dh / 24) AS dropoff_hour_cos,
    sin(2 * pi() * dow / 7) AS dow_sin, cos(2 * pi() * dow / 7) AS dow_cos,
    sin(2 * pi() * (mo - 1) / 12) AS month_sin, cos(2 * pi() * (mo - 1) / 12) AS month_cos,
    pickup_date, is_holiday, is_long_weekend,
    CASE WHEN c_getaway THEN 'friday_getaway' WHEN c_morning THEN 'weekday_morning'
         WHEN c_evening THEN 'weekday_evening' WHEN c_late THEN 'late_night' ELSE 'other' END AS pickup_period,
    CAST(coalesce(dow IN (5, 6), FALSE) AS INTEGER) AS is_weekend,
    CAST(c_morning OR c_evening AS INTEGER) AS is_rush_hour,
    CAST(c_late AS INTEGER) AS is_nightlife,
    CAST(c_getaway AS INTEGER) AS is_friday_getaway,{hav},
    coalesce(lp.Borough, 'Unknown') AS pickup_borough, coalesce(lp.service_zone, 'Unknown') AS pickup_service_zone,
    coalesce(ld.Borough, 'Unknown') AS dropoff_borough, coalesce(ld.service_zone, 'Unknown') AS dropoff_service_zone
  FROM conds
  LEFT JOIN zone_lookup lp ON conds.PULocationID = lp.LocationID
  LEFT JOIN zone_lookup ld ON conds.DOLocationID = ld.LocationID
)"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select
