"""Calendar rules, zone geometry and schema operators."""

import math

import pytest
from pyspark.sql import functions as F

from farelane.functions.calendar import holiday_calendar
from farelane.operators import geometry, joins, schema
from farelane.plans.oracle_sql import HOLIDAYS_2024_2025


def test_calendar_2024_2025(spark):
    got = sorted(str(r.holiday_date) for r in holiday_calendar(spark, 2024, 2025).collect())
    assert got == sorted(HOLIDAYS_2024_2025)


def test_calendar_observed_shift(spark):
    got = {str(r.holiday_date) for r in holiday_calendar(spark, 2021, 2022, state=None).collect()}
    assert "2021-07-05" in got and "2021-12-24" in got and "2021-12-31" in got


def test_centroid_of_square_and_hole(spark):
    sq = [(1, 1, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2)])]
    hole = [(1, 2, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (0, 1), (1, 1), (1, 0)])]  # clockwise
    v = spark.createDataFrame(sq + hole, "LocationID int, ring long, seq int, x double, y double")
    r = geometry.zone_centroids(v, project=False).first()
    assert r.area == pytest.approx(3.0)
    # L-shape: (4*(1,1) - 1*(0.5,0.5)) / 3
    assert r.x == pytest.approx(3.5 / 3) and r.y == pytest.approx(3.5 / 3)


def test_lcc_inverse_origin(spark):
    # the projection's false origin maps back to (lon_0, lat_0)
    x0 = geometry.FALSE_EASTING_M / geometry.US_FOOT_M
    e, n, big_f, rho0 = geometry._lcc_constants()
    lon, lat = geometry.lcc_inverse(F.lit(x0), F.lit(0.0))
    r = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert r.lon == pytest.approx(-74.0, abs=1e-9)
    assert r.lat == pytest.approx(geometry.LAT_0, abs=1e-7)


def test_schema_drift_statuses(spark):
    rows = []
    for f, cols in {"a.parquet": ["x", "y", "z"], "b.parquet": ["x", "y", "z"], "c.parquet": ["z", "y", "x"],
                    "d.parquet": ["x", "y"], "e.parquet": ["x", "y", "z", "w"], "f.parquet": ["x", "y", "w"]}.items():
        rows += [(f, i, c) for i, c in enumerate(cols)]
    cols = spark.createDataFrame(rows, "file string, pos int, column string")
    got = {r.file: r.status for r in schema.schema_drift(cols).collect()}
    assert got == {"a.parquet": "reference", "b.parquet": "matching", "c.parquet": "reordered", "d.parquet": "missing",
                   "e.parquet": "extra", "f.parquet": "missing+extra"}


def test_normalize_columns_drops_fares_case_insensitive(spark):
    a = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "VendorID int, total_amount double, Airport_fee double, fare_amount double")
    b = spark.createDataFrame([(2, 5.0, 6.0)], "VendorID int, cbd_congestion_fee double, total_amount double")
    c = spark.createDataFrame([(7.0,)], "total_amount double")
    out = schema.normalize_columns([a, b, c])
    assert out.columns == ["VendorID", "total_amount"]
    assert sorted(out.collect(), key=lambda r: r.total_amount)[0].VendorID == 1
    assert [r.VendorID for r in out.collect() if r.total_amount == 7.0] == [None]


def test_lookup_last_row_wins_and_unknown(spark):
    lk = spark.createDataFrame([(1, "A", "z1", 0), (1, "B", "z2", 1), (2, "C", "z3", 2)],
                               "LocationID int, Borough string, service_zone string, _row long")
    trips = spark.createDataFrame([(1, 3), (2, None)], "PULocationID int, DOLocationID int")
    got = joins.lookup_borough(trips, lk).orderBy("PULocationID").collect()
    assert (got[0].pickup_borough, got[0].dropoff_borough) == ("B", "Unknown")
    assert got[1].dropoff_service_zone == "Unknown"


def test_join_centroids_fans_out_duplicates(spark):
    zones = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 1.0), (2, 2.0, 2.0)], "LocationID int, lon double, lat double")
    trips = spark.createDataFrame([(1, 2)], "PULocationID int, DOLocationID int")
    assert joins.join_centroids(trips, zones).count() == 2
    with pytest.raises(Exception):
        joins.assert_unique_zones(zones).collect()


def test_haversine_known_distance(spark):
    from farelane.functions.exprs import haversine_km

    d = spark.range(1).select(haversine_km(F.lit(-74.0), F.lit(40.0), F.lit(-73.0), F.lit(40.0)).alias("d")).first().d
    exp = 2 * 6371.0 * math.asin(math.sqrt(math.cos(math.radians(40)) ** 2 * math.sin(math.radians(0.5)) ** 2))
    assert d == pytest.approx(exp)


def test_location_fix_summary_counts_fan_out(spark):
    from farelane.operators import clean
    from farelane.plans import audits

    zones = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 1.0), (2, None, None), (56, 5.0, 5.0)],
                                  "LocationID int, lon double, lat double")
    trips = spark.createDataFrame([(1, 2, "m"), (57, 1, "m"), (264, 1, "m"), (3, 1, "m"), (None, 2, "m")],
                                  "PULocationID int, DOLocationID int, file_month string")
    r = audits.location_fix_summary(trips, zones).first()
    j = joins.join_centroids(clean.fix_locations(trips), zones)
    assert r.rows_in == 5 and r.rows_dropped_invalidID == 1
    assert r.rows_out == j.count()
    assert r.missing_pickup_coords == j.where("pickup_lon IS NULL").count()
    assert r.missing_dropoff_coords == j.where("dropoff_lon IS NULL").count()


def test_rings_of_one_id_are_one_zone(spark):
    from farelane.operators.geometry import zone_centroids

    corners = [(0, 0.0, 0.0), (1, 2.0, 0.0), (2, 2.0, 2.0), (3, 0.0, 2.0)]
    rows = [(1, ring, seq, x + shift, y) for ring, shift in ((1, 0.0), (2, 10.0)) for seq, x, y in corners]
    out = zone_centroids(spark.createDataFrame(rows, "LocationID int, ring int, seq int, x double, y double"), project=False).collect()
    assert len(out) == 1 and out[0]["x"] == pytest.approx(6.0) and out[0]["y"] == pytest.approx(1.0)


def test_lookup_without_file_order_does_not_depend_on_row_order(spark):
    rows = [(1, "A", "z"), (1, "B", "y"), (2, "C", "x")]
    one, two = (joins.dedupe_lookup(spark.createDataFrame(r, "LocationID int, Borough string, service_zone string")) for r in (rows, rows[::-1]))
    assert sorted(one.collect()) == sorted(two.collect())
