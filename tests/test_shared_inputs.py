"""Queries over derived trips: inputs are written once, and repeated rows stay what they are."""

import pytest
from pyspark.sql import functions as F

from farelane.functions.calendar import holiday_calendar
from farelane.plans import catalog, jobs, ml_catalog
from farelane.sources import fixtures as fx


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Orders of which some are there twice."""
    root = tmp_path_factory.mktemp("twice")
    k = F.col("id")
    orders = spark.range(1, 1500).select(k.alias("o_orderkey"), (k * 37 % 1000).alias("o_custkey"), (F.lit(9000.0) + k * 101 % 200000).alias("o_totalprice"))
    orders.unionByName(orders.filter("o_orderkey % 10 = 0")).write.parquet(f"{root}/orders.parquet")
    return str(root)


def test_cleaned_trips_do_not_derive_months_again(spark, sf):
    """Before, the month of the file was spelt out at every use in filters and joins."""
    plan = catalog._cleaned(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "lpad" not in plan and "timestampadd" not in plan


def test_persist_pipeline_joins_features_of_repeated_trips_alone(spark, sf):
    """Before, both transformed copies of all rows were shuffled and joined; rows that share an id are still compared each with each."""
    out = ml_catalog.q_persist_pipeline(spark, sf)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and plan.count("Join LeftSemi") == 2
    assert out.filter("not same_features").count() == 0
    n = ml_catalog._splits(spark, sf).groupBy("trip_id").count()
    assert n.filter("count = 2").count() > 0
    got = {r[0]: r[1] for r in out.groupBy("trip_id").count().collect()}
    assert got == {r[0]: r[1] ** 2 for r in n.collect()}


def test_features_are_built_from_written_rows(spark, sf):
    """Before, cleaning and features were one stage, whose generated method the JVM leaves uncompiled (over 8,000 bytes)."""
    built = jobs.clean_and_build(fx.load_trips(spark, sf), fx.fixture_zone_lookup(spark), fx.fixture_zones(spark), holiday_calendar(spark))
    query = catalog._features(spark, sf, src=catalog._cleaned(spark, sf))
    for df in (built, query):
        assert df.inputFiles() and all("/cleaned/" in f for f in df.inputFiles())
    assert sorted(map(str, built.collect())) == sorted(map(str, query.collect()))
