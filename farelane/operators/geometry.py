"""Zone centroids from polygon vertices (F1).

Input is a vertex table ``(LocationID, ring, seq, x, y)`` in a planar CRS
(New York Long Island state plane, US feet, as in the public zone file);
rings wound clockwise count as holes.  The area-weighted centroid is the
shoelace sum per zone: each vertex is paired with its successor by a window
over its own ring (a ring is bounded by the polygon's detail, not by the
data volume), and the per-zone sums are an ordinary partially-aggregated
group-by, so a zone with very many parts is still spread over many tasks.

The planar centroid is converted to lon / lat by the inverse Lambert
conformal conic projection (two standard parallels, GRS80), written as
column math with a fixed number of latitude iterations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: EPSG:2263 (NAD83 / New York Long Island, ftUS) --------------
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
LAT_1 = 41.0 + 2.0 / 60.0
LAT_2 = 40.0 + 40.0 / 60.0
LAT_0 = 40.0 + 10.0 / 60.0
LON_0 = -74.0
FALSE_EASTING_M = 300000.0
FALSE_NORTHING_M = 0.0
US_FOOT_M = 1200.0 / 3937.0
LAT_ITERATIONS = 6


def _lcc_constants():
    f = 1.0 / GRS80_INV_F
    e = math.sqrt(2 * f - f * f)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi):
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (LAT_1, LAT_2, LAT_0))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = GRS80_A * big_f * t(p0) ** n
    return e, n, big_f, rho0


def lcc_inverse(x_ft: Column, y_ft: Column) -> tuple[Column, Column]:
    """(lon, lat) in degrees from planar feet."""
    e, n, big_f, rho0 = _lcc_constants()
    dx = x_ft * F.lit(US_FOOT_M) - F.lit(FALSE_EASTING_M)
    dy = F.lit(rho0) - (y_ft * F.lit(US_FOOT_M) - F.lit(FALSE_NORTHING_M))
    rho = F.sqrt(dx * dx + dy * dy)
    t = F.pow(rho / F.lit(GRS80_A * big_f), F.lit(1.0 / n))
    theta = F.atan2(dx, dy)
    lon = F.degrees(theta / F.lit(n)) + F.lit(LON_0)
    phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
    for _ in range(LAT_ITERATIONS):
        es = F.lit(e) * F.sin(phi)
        phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2)))
    return lon, F.degrees(phi)


def lcc_inverse_sql(x_ft: str, y_ft: str) -> tuple[str, str]:
    """The same inverse projection as SQL text (for the DuckDB oracle)."""
    e, n, big_f, rho0 = _lcc_constants()
    dx = f"({x_ft} * {US_FOOT_M!r} - {FALSE_EASTING_M!r})"
    dy = f"({rho0!r} - ({y_ft} * {US_FOOT_M!r} - {FALSE_NORTHING_M!r}))"
    t = f"pow(sqrt({dx} * {dx} + {dy} * {dy}) / {GRS80_A * big_f!r}, {1.0 / n!r})"
    lon = f"(degrees(atan2({dx}, {dy}) / {n!r}) + {LON_0!r})"
    phi = f"({math.pi / 2!r} - 2.0 * atan({t}))"
    for _ in range(LAT_ITERATIONS):
        es = f"({e!r} * sin({phi}))"
        phi = f"({math.pi / 2!r} - 2.0 * atan({t} * pow((1.0 - {es}) / (1.0 + {es}), {e / 2!r})))"
    return lon, f"degrees({phi})"


def zone_centroids(vertices: DataFrame, project: bool = True) -> DataFrame:
    """``(LocationID, area, x, y, lon, lat)``: area-weighted planar centroid per zone.

    All rings of an id are one zone with one centroid, so a join against the
    result never multiplies trips; give rings ids of their own to keep them
    apart.
    """
    w = Window.partitionBy("LocationID", "ring").orderBy("seq")
    wr = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = vertices.select(
        "LocationID",
        F.col("x").alias("x0"),
        F.col("y").alias("y0"),
        F.coalesce(F.lead("x").over(w), F.first("x").over(wr)).alias("x1"),
        F.coalesce(F.lead("y").over(w), F.first("y").over(wr)).alias("y1"),
    )
    cross = F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")
    sums = edges.groupBy("LocationID").agg(
        (F.sum(cross) / 2).alias("area"),
        F.sum((F.col("x0") + F.col("x1")) * cross).alias("_sx"),
        F.sum((F.col("y0") + F.col("y1")) * cross).alias("_sy"),
    )
    out = sums.select(
        "LocationID",
        "area",
        F.try_divide(F.col("_sx"), F.col("area") * 6).alias("x"),
        F.try_divide(F.col("_sy"), F.col("area") * 6).alias("y"),
    )
    if not project:
        return out
    lon, lat = lcc_inverse(F.col("x"), F.col("y"))
    return out.select("*", lon.alias("lon"), lat.alias("lat"))
