"""Dimension joins and lookups.

No join is hinted: a dimension whose size the planner knows to be under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, so the trip side is not
shuffled, and a larger one gets a shuffle join that adaptive execution may
still turn into a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.constants import PICKUP, UNKNOWN

# ---------------------------------------------------------------- D1 centroids
def join_centroids(
    df: DataFrame,
    zones: DataFrame,
    pu: str = "PULocationID",
    do: str = "DOLocationID",
) -> DataFrame:
    """Left-join PU and DO centroids: adds ``pickup_lon/lat`` and ``dropoff_lon/lat``.

    Duplicate zone ids fan rows out, as a plain merge does; see
    :func:`assert_unique_zones` to forbid that.
    """
    z = zones.select("LocationID", "lon", "lat")
    zp = z.select(F.col("LocationID").alias("_pu_id"), F.col("lon").alias("pickup_lon"), F.col("lat").alias("pickup_lat"))
    zd = z.select(F.col("LocationID").alias("_do_id"), F.col("lon").alias("dropoff_lon"), F.col("lat").alias("dropoff_lat"))
    out = df.join(zp, F.col(pu) == F.col("_pu_id"), "left").drop("_pu_id")
    return out.join(zd, F.col(do) == F.col("_do_id"), "left").drop("_do_id")


def assert_unique_zones(zones: DataFrame) -> DataFrame:
    """Fail at run time when a zone id repeats (opt-in guard against fan-out)."""
    dup = zones.groupBy("LocationID").count().where(F.col("count") > 1)
    return zones.join(dup.select("LocationID", F.lit(True).alias("_dup")), "LocationID", "left").select(
        F.when(F.col("_dup").isNull(), F.col("LocationID"))
        .otherwise(F.raise_error(F.concat(F.lit("duplicate zone id "), F.col("LocationID").cast("string"))))
        .alias("LocationID"),
        *[c for c in zones.columns if c != "LocationID"],
    )


# ---------------------------------------------------------------- D2 borough lookup
def dedupe_lookup(lookup: DataFrame, order_col: str = "_row") -> DataFrame:
    """One row per ``LocationID``: the last in file order (``order_col``), like a dict.

    Without that column the row with the largest attributes is taken, so the
    result does not depend on the order of the rows.
    """
    attrs = [c for c in lookup.columns if c not in ("LocationID", order_col)]
    order = [order_col] if order_col in lookup.columns else []
    last = F.max(F.struct(*order, *attrs)).alias("_last")
    return lookup.groupBy("LocationID").agg(last).select("LocationID", *[F.col("_last")[c].alias(c) for c in attrs])


def lookup_borough(
    df: DataFrame,
    lookup: DataFrame,
    pu: str = "PULocationID",
    do: str = "DOLocationID",
) -> DataFrame:
    """Borough and service zone for PU and DO; unmatched -> "Unknown" (D2)."""
    lk = dedupe_lookup(lookup)
    out = df
    for side, key in (("pickup", pu), ("dropoff", do)):
        if key not in df.columns:
            out = out.withColumn(f"{side}_borough", F.lit(UNKNOWN)).withColumn(f"{side}_service_zone", F.lit(UNKNOWN))
            continue
        tag = f"_{side}_id"
        side_lk = lk.select(
            F.col("LocationID").alias(tag),
            F.col("Borough").alias(f"_{side}_b"),
            F.col("service_zone").alias(f"_{side}_z"),
        )
        out = (
            out.join(side_lk, F.col(key) == F.col(tag), "left")
            .withColumn(f"{side}_borough", F.coalesce(F.col(f"_{side}_b"), F.lit(UNKNOWN)))
            .withColumn(f"{side}_service_zone", F.coalesce(F.col(f"_{side}_z"), F.lit(UNKNOWN)))
            .drop(tag, f"_{side}_b", f"_{side}_z")
        )
    return out


def zone_dimension(zones: DataFrame | None, lookup: DataFrame) -> DataFrame:
    """Fused zone dimension: centroid rows (may repeat ids) x deduplicated lookup.

    Joining this once per trip side replaces two joins per side and keeps the
    fan-out of duplicate centroid ids.  Bounded by the zone table's size.
    """
    lk = dedupe_lookup(lookup)
    if zones is None:
        return lk.select("LocationID", F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"), "Borough", "service_zone")
    return zones.select("LocationID", "lon", "lat").join(lk, "LocationID", "full_outer")


def join_zone_dimension(
    df: DataFrame,
    zone_dim: DataFrame,
    with_coords: bool = True,
    pu: str = "PULocationID",
    do: str = "DOLocationID",
) -> DataFrame:
    """One join per side adding coordinates and borough / service zone."""
    out = df
    for side, key in (("pickup", pu), ("dropoff", do)):
        tag = f"_{side}_id"
        cols = [F.col("LocationID").alias(tag)]
        if with_coords:
            cols += [F.col("lon").alias(f"{side}_lon"), F.col("lat").alias(f"{side}_lat")]
        cols += [F.col("Borough").alias(f"_{side}_b"), F.col("service_zone").alias(f"_{side}_z")]
        out = (
            out.join(zone_dim.select(*cols), F.col(key) == F.col(tag), "left")
            .withColumn(f"{side}_borough", F.coalesce(F.col(f"_{side}_b"), F.lit(UNKNOWN)))
            .withColumn(f"{side}_service_zone", F.coalesce(F.col(f"_{side}_z"), F.lit(UNKNOWN)))
            .drop(tag, f"_{side}_b", f"_{side}_z")
        )
    return out


# ---------------------------------------------------------------- D3 / D4 calendar
def join_calendar(df: DataFrame, flags: DataFrame, date_col: str = "pickup_date") -> DataFrame:
    """Adds ``_hol``, ``_hol_in_3``, ``_hol_3_ago`` (0/1) from a date-keyed flag table.

    ``flags`` has one row per date (see ``calendar_flags``), so there is no fan-out.
    """
    f = flags.select(
        F.col("cal_date").alias("_cal_date"),
        F.col("is_holiday_date").alias("_hol"),
        F.col("holiday_in_3_days").alias("_hol_in_3"),
        F.col("holiday_3_days_ago").alias("_hol_3_ago"),
    )
    out = df.join(f, F.col(date_col) == F.col("_cal_date"), "left").drop("_cal_date")
    for c in ("_hol", "_hol_in_3", "_hol_3_ago"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


def is_holiday(df: DataFrame, flags: DataFrame, ts: str = PICKUP) -> DataFrame:
    """``is_holiday`` = pickup date in the holiday set (D3)."""
    out = join_calendar(df.withColumn("_d", F.to_date(F.col(ts))), flags, "_d")
    return out.withColumn("is_holiday", F.col("_hol").cast("int")).drop("_d", "_hol", "_hol_in_3", "_hol_3_ago")


def long_weekend_flag(dow: Column) -> Column:
    return (
        ((dow == 4) & (F.col("_hol_in_3") == 1)) | ((dow == 0) & (F.col("_hol_3_ago") == 1))
    )


def is_long_weekend(df: DataFrame, flags: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Friday before a holiday Monday or Monday after a holiday Friday."""
    out = join_calendar(df.withColumn("_d", F.to_date(F.col(ts))), flags, "_d")
    dow = F.weekday(F.col(ts))
    return out.withColumn("is_long_weekend", F.coalesce(long_weekend_flag(dow), F.lit(False)).cast("int")).drop(
        "_d", "_hol", "_hol_in_3", "_hol_3_ago"
    )


# ---------------------------------------------------------------- D6 outer alignment
def align_outer(p: DataFrame, q: DataFrame, keys: list[str], value: str = "share") -> DataFrame:
    """Full outer join of two distributions on ``keys`` (NULL keys match), 0-filled.

    Output: keys, ``p``, ``q``.
    """
    pa = p.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col(value).alias("p"))
    qa = q.select(*[F.col(k).alias(f"_q_{k}") for k in keys], F.col(value).alias("q"))
    cond = None
    for k in keys:
        c = F.col(f"_p_{k}").eqNullSafe(F.col(f"_q_{k}"))
        cond = c if cond is None else cond & c
    j = pa.join(qa, cond, "full_outer")
    return j.select(
        *[F.coalesce(F.col(f"_p_{k}"), F.col(f"_q_{k}")).alias(k) for k in keys],
        F.coalesce(F.col("p"), F.lit(0.0)).alias("p"),
        F.coalesce(F.col("q"), F.lit(0.0)).alias("q"),
    )
