"""Plan shape: pushdown into the parquet scan, no shuffle of trip rows in the feature build."""

from farelane.functions.calendar import holiday_calendar
from farelane.operators import clean, features
from farelane.sources import fixtures as fx
from farelane.sources import monthly, sinks


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _raw_trips(spark):
    path = sinks.write_months(fx.load_trips(spark, "/root/testdata/sf0.001"), sinks.shared_dir(spark, "plan_raw"))
    return monthly.scan_months(spark, path)


def test_range_filter_pushes_no_bounds_on_columns_with_nan(spark):
    """Statistics of such columns cannot be trusted, so rows could be lost (see test_null_traps)."""
    plan = _plan(clean.range_filter(_raw_trips(spark)).select("trip_id"))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: []" in scan
    assert "ReadSchema: struct<trip_id:bigint,passenger_count:double,trip_distance:double,total_amount:double>" in scan


def test_projection_is_pruned_into_the_scan(spark):
    plan = _plan(_raw_trips(spark).select("trip_id", "total_amount"))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<trip_id:bigint,total_amount:double>" in scan


def test_feature_build_shuffles_no_trip_rows(spark):
    trips = _raw_trips(spark)
    f = features.build_features(trips, holiday_calendar(spark), fx.fixture_zone_lookup(spark), fx.fixture_zones(spark))
    plan = _plan(f)
    assert plan.count("BroadcastHashJoin") >= 3
    # every exchange in the plan sits under a broadcast (dimension side); the trip scan feeds joins directly
    trip_side = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in trip_side


def test_drop_impact_reads_the_trips_once(spark):
    from farelane.plans import audits

    out = audits.drop_impact(_raw_trips(spark))
    out.collect()
    assert _plan(out).split("== Initial Plan ==")[0].count("FileScan parquet") == 1  # the plan that ran
