"""Stored profiles and their merges, distinct counts without copies of rows, footers read in tasks."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from farelane.operators import schema
from farelane.plans import audits
from farelane.plans import profiles as PR
from farelane.sources.footers import footer_columns, type_drift


def table(spark, n=6000):
    return spark.range(n).select(
        F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("file_month"),
        (F.col("id") % 1700).alias("a"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") * 0.5).alias("x"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("s"),
        F.lit(None).cast("double").alias("empty"),
    )


def test_profiles_merge_like_one_pass(spark, tmp_path):
    df = table(spark)
    path = str(tmp_path / "profiles")
    PR.store_profiles(PR.profile_files(df.filter("file_month < '2024-03'")), path)
    PR.store_profiles(PR.profile_files(df.filter("file_month = '2024-03'")), path)
    assert PR.stored_profiles(spark, path).count() == 12
    got = {r["column"]: r for r in PR.merged_profile(PR.stored_profiles(spark, path), [0.0, 0.5, 1.0]).collect()}
    assert {c: (r["n_files"], r["n_rows"], r["n_null"]) for c, r in got.items()} == {"a": (3, 6000, 0), "x": (3, 6000, 1200), "s": (3, 6000, 3000), "empty": (3, 6000, 6000)}
    for c, exact in (("a", 1700), ("x", 4800), ("s", 3000), ("empty", 0)):
        assert got[c]["n_unique"] == pytest.approx(exact, rel=0.04)
    assert got["s"]["quantiles"] is None and got["empty"]["quantiles"] is None
    low, mid, high = got["x"]["quantiles"]
    assert (low, high) == (0.5, 2999.5) and mid == pytest.approx(1500, rel=0.05)


def test_a_changed_file_replaces_its_profile_only(spark, tmp_path):
    df = table(spark)
    path = str(tmp_path / "profiles")
    PR.store_profiles(PR.profile_files(df), path)
    PR.store_profiles(PR.profile_files(df.filter("file_month = '2024-02' and id < 10" if "id" in df.columns else "file_month = '2024-02' and a < 10")), path)
    rows = {r["file_month"]: r["n_rows"] for r in PR.stored_profiles(spark, path).filter("column = 'a'").collect()}
    assert rows["2024-01"] == rows["2024-03"] == 2000 and rows["2024-02"] < 100


def test_distinct_counts_copy_no_rows(spark):
    df = table(spark)
    got = {r["column"]: r["n_unique"] for r in audits.nunique_profile(df).collect()}
    pdf = df.toPandas()
    assert got == {"file_month": 3, "a": 1700, "x": pdf["x"].nunique() + 1, "s": pdf["s"].nunique(), "empty": 0}  # NaN is a value here
    plan = audits.nunique_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_footers_of_many_files(spark, tmp_path):
    for i in range(150):
        cols = {"a": pa.array([1], pa.int64() if i != 77 else pa.int32()), "t": pa.array([0], pa.timestamp("us")), "d": pa.array([[1.5]], pa.list_(pa.float64()))}
        fields = [pa.field(n, c.type, nullable=not (i == 9 and n == "a")) for n, c in cols.items()]
        pq.write_table(pa.table(list(cols.values()), schema=pa.schema(fields)), tmp_path / f"f{i:03d}.parquet")
    files = [str(tmp_path / f"f{i:03d}.parquet") for i in range(150)]
    jobs = spark.sparkContext.statusTracker()
    columns = footer_columns(spark, files)
    assert columns.rdd.getNumPartitions() == 3 and jobs is not None
    first = [(r["pos"], r["column"], r["type"], r["nullable"]) for r in columns.filter("file = 'f000.parquet'").orderBy("pos").collect()]
    assert first == [(0, "a", "bigint", True), (1, "t", "timestamp_ntz", True), (2, "d", "array<double>", True)]
    drift = {(r["file"], r["column"]): tuple(r)[2:] for r in type_drift(columns).collect()}
    assert drift == {("f077.parquet", "a"): ("int", "bigint", True, True), ("f009.parquet", "a"): ("bigint", "bigint", False, True)}
    assert schema.schema_drift(columns).filter("status = 'matching'").count() == 149


def test_footer_types_are_sparks_own(spark, tmp_path):
    df = spark.sql("select 1 i, 2L l, 1.5D d, cast(1.25 as decimal(9,2)) c, 'x' s, true b, date'2024-01-01' dt, timestamp_ntz'2024-01-01 10:00:00' n, timestamp'2024-01-01 10:00:00' z, cast('q' as binary) y, named_struct('k', 1) st, map('a', 1) m")
    df.write.parquet(str(tmp_path / "t.parquet"))
    got = [r["type"] for r in footer_columns(spark, [str(tmp_path / "t.parquet")]).orderBy("pos").collect()]
    assert got == [t for _, t in spark.read.parquet(str(tmp_path / "t.parquet")).dtypes]


def test_months_of_other_types_are_cast(spark):
    a = spark.createDataFrame([(1.5, 3)], "x double, p int")
    b = spark.createDataFrame([("2.5", 4), ("many", 5)], "x string, p long")
    out = schema.normalize_columns([a, b])
    assert out.dtypes == [("x", "double"), ("p", "int")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1.5, 3), (2.5, 4), (None, 5)], key=str)
    assert np.isfinite(out.agg(F.sum("x")).first()[0])
