"""Trip-shaped inputs derived from the driver's TPC-H-like tables.

The driver's tables hold no trips, so trips are derived from ``orders`` with
integer arithmetic that DuckDB reproduces exactly (see FIXTURES.md §3).  The
derivation is a pure projection: one trip per order, so the trip volume grows
with the source table and every downstream operator scales with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# --- fixed values: trip mapping (FIXTURES.md §3) -------------------------------
T0 = "2024-01-01 00:00:00"
PICKUP_SPAN_MIN = 831000
DURATION_SPAN_MIN = 200
LATE_FILE_SHIFT_MIN = 45000
BOROUGHS = ("Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island")
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports")
# literal holiday list used by tests (US federal days for 2024 and 2025)
FIXTURE_HOLIDAYS = (
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
    "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
    "2025-01-01", "2025-01-20", "2025-02-17", "2025-05-26", "2025-06-19", "2025-07-04",
)


TRIP_COLUMNS = (
    "trip_id", "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "total_amount", "file_month",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _t0_plus_minutes(minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), F.lit(T0).cast("timestamp_ntz"))


def trips_from_orders(orders: DataFrame) -> DataFrame:
    """Normalised trip rows (FIXTURES.md §2.1) plus ``trip_id`` and ``file_month``."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pu_min = (k * 7919 + c * 31) % PICKUP_SPAN_MIN
    dur_min = (c * 13 + k * 7) % DURATION_SPAN_MIN
    trio_null = (k % 13) == 0
    pickup = _t0_plus_minutes(pu_min)
    file_ts = _t0_plus_minutes(pu_min + F.when(k % 97 == 0, LATE_FILE_SHIFT_MIN).otherwise(0))
    return orders.select(
        k.alias("trip_id"),
        (k % 2 + 1).cast("int").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        F.when(k % 101 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_t0_plus_minutes(pu_min + dur_min))
        .alias("tpep_dropoff_datetime"),
        F.when(trio_null, F.lit(None)).otherwise((k % 11).cast("double")).alias("passenger_count"),
        (F.col("o_totalprice") / F.lit(9000.0) + (k % 7) * F.lit(0.5) - F.lit(0.4)).alias("trip_distance"),
        F.when(trio_null, F.lit(None)).otherwise((k % 6 + 1).cast("double")).alias("RatecodeID"),
        F.when(trio_null, F.lit(None).cast("string"))
        .when(k % 17 == 0, F.lit("Y"))
        .otherwise(F.lit("N"))
        .alias("store_and_fwd_flag"),
        (c % 266).cast("int").alias("PULocationID"),
        ((c * 7 + k) % 266).cast("int").alias("DOLocationID"),
        (c % 5 + 1).cast("int").alias("payment_type"),
        (F.col("o_totalprice") / F.lit(1900.0)).alias("total_amount"),
        F.concat(F.year(file_ts).cast("string"), F.lit("-"), F.lpad(F.month(file_ts).cast("string"), 2, "0")).alias("file_month"),
    )


# raw trip tables already written for a scale directory (see ``use_trip_table``)
_TRIP_TABLES: dict[str, str] = {}


def use_trip_table(sf_dir: str, path: str | None) -> None:
    """Read the trips of ``sf_dir`` from a written monthly table instead of deriving them.

    The table is what :func:`farelane.sources.sinks.write_months` writes for
    :func:`trips_from_orders`, i.e. the raw monthly trip files the pipeline
    normally starts from; row for row the same data.
    """
    if path is None:
        _TRIP_TABLES.pop(sf_dir.rstrip("/"), None)
    else:
        _TRIP_TABLES[sf_dir.rstrip("/")] = path


def load_trips(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The trips of a scale directory.

    With ``spread`` the orders are first dealt over all cores by their values:
    a file of one row group is read by one task, and every written stage after
    it would keep that one task's layout.
    """
    table = _TRIP_TABLES.get(sf_dir.rstrip("/"))
    if table is not None:
        from farelane.sources.monthly import scan_months

        df = scan_months(spark, table)
        cols = [c for c in TRIP_COLUMNS if c in df.columns]
        return df.select(*cols)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    if spread:
        orders = orders.hint("rebalance", *orders.columns)
    return trips_from_orders(orders)


def _zone_ids(spark: SparkSession) -> DataFrame:
    # ids 1..263 without multiples of 41, so unmapped ids occur in the trips
    return spark.range(1, 264, numPartitions=1).where(F.col("id") % 41 != 0).select(
        F.col("id").cast("int").alias("LocationID")
    )


def fixture_zones(spark: SparkSession) -> DataFrame:
    """Zone centroids ``(LocationID, lon, lat)``: a 263-row dimension at most."""
    i = F.col("LocationID")
    return _zone_ids(spark).select(
        i,
        (F.lit(-74.05) + (i % 20) * F.lit(0.012)).alias("lon"),
        (F.lit(40.60) + F.floor(i / 20) * F.lit(0.018)).alias("lat"),
    )


def fixture_zone_lookup(spark: SparkSession) -> DataFrame:
    """Zone lookup ``(LocationID, Borough, service_zone)``: a 263-row dimension at most."""
    i = F.col("LocationID")
    borough = F.element_at(F.array(*[F.lit(b) for b in BOROUGHS]), (i % 5 + 1).cast("int"))
    zone = F.element_at(F.array(*[F.lit(z) for z in SERVICE_ZONES]), (i % 3 + 1).cast("int"))
    return _zone_ids(spark).select(i, borough.alias("Borough"), zone.alias("service_zone"))


def fixture_holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in FIXTURE_HOLIDAYS], "d string").select(
        F.to_date("d").alias("holiday_date")
    )


def zone_vertices_from_orders(orders: DataFrame) -> DataFrame:
    """Zone polygon vertices ``(LocationID, ring, seq, x, y)`` in planar feet.

    Every order contributes one square ring to the zone ``o_custkey % 263 + 1``
    (so zones are multi-part polygons whose size grows with the table); every
    fifth ring is wound clockwise and therefore counts as a hole.
    """
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    cx = F.lit(913000.0) + (c % 263) * F.lit(600.0) + (k % 50) * F.lit(40.0)
    cy = F.lit(121000.0) + (c % 97) * F.lit(1500.0) + (k % 30) * F.lit(35.0)
    half = F.lit(100.0) + (k % 9) * F.lit(25.0)
    hole = (k % 5) == 4
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1)]
    pts = F.array(
        *[
            F.struct(
                F.lit(i).alias("seq"),
                (cx + half * F.lit(float(dx))).alias("x"),
                (cy + F.when(hole, F.lit(-1.0)).otherwise(F.lit(1.0)) * half * F.lit(float(dy))).alias("y"),
            )
            for i, (dx, dy) in enumerate(corners)
        ]
    )
    return orders.select(
        (c % 263 + 1).cast("int").alias("LocationID"), k.alias("ring"), F.explode(pts).alias("p")
    ).select("LocationID", "ring", "p.seq", "p.x", "p.y")
