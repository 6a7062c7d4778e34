"""Sampler and distribution distances against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelane.operators import sampling, stats


def _brute(df, n, seed, groups):
    d = F.md5(F.concat_ws(":", F.col("trip_id").cast("string"), F.lit(str(seed))))
    w = Window.partitionBy(*groups).orderBy(d, "trip_id")
    return {r.trip_id for r in df.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n).collect()}


@pytest.mark.parametrize("n,levels", [(0, 1), (1, 1), (7, 1), (7, 2), (50, 2), (10_000, 1)])
def test_sample_top_n_matches_row_number(spark, n, levels):
    rows = [(i, f"g{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "trip_id long, file_month string")
    got = {r.trip_id for r in sampling.sample_top_n(df, n, "trip_id", 11, ["file_month"], levels=levels).collect()}
    assert got == _brute(df, n, 11, ["file_month"])


def test_sample_fraction_exact_size(spark):
    df = spark.range(0, 1234).withColumnRenamed("id", "trip_id")
    assert sampling.sample_fraction(df, 0.1, seed=3).count() == round(1234 * 0.1)
    assert sampling.sample_fraction(df, 2.0, seed=3).count() == 1234


def test_build_splits_rejects_bad_sizes(spark):
    df = spark.createDataFrame([(1, "2024-01")], "trip_id long, file_month string")
    with pytest.raises(ValueError):
        sampling.build_splits(df, {"train": 0, "val": 1, "test": 1})


def _ks_np(x, y):
    x, y = np.sort(np.asarray(x)), np.sort(np.asarray(y))
    vals = np.unique(np.concatenate([x, y]))
    return float(np.max(np.abs(np.searchsorted(x, vals, "right") / len(x) - np.searchsorted(y, vals, "right") / len(y))))


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_ks_matches_numpy(spark, buckets):
    rnd = random.Random(5)
    xs = [(g, round(rnd.gauss(0, 1), 2)) for g in ("a", "b") for _ in range(400)]
    ys = [(g, round(rnd.gauss(0.3, 1.2), 2)) for g in ("a", "b") for _ in range(300)] + [("b", float("inf"))]
    x = spark.createDataFrame(xs, "g string, v double")
    y = spark.createDataFrame(ys, "g string, v double")
    got = {r.g: r.ks for r in stats.ks_distance(x, y, "v", ["g"], buckets=max(buckets, 2)).collect()}
    for g in ("a", "b"):
        exp = _ks_np([v for k, v in xs if k == g], [v for k, v in ys if k == g and np.isfinite(v)])
        assert got[g] == pytest.approx(exp, abs=1e-12)


def test_tvd_matches_pandas(spark):
    import pandas as pd

    a = [1, 1, 2, 3, None, 3, 3]
    b = [1, 2, 2, 4]
    p = pd.Series(a, dtype="Int64").value_counts(normalize=True, dropna=False)
    q = pd.Series(b, dtype="Int64").value_counts(normalize=True, dropna=False)
    exp = 0.5 * p.subtract(q, fill_value=0).abs().sum()
    got = stats.tvd(spark.createDataFrame([(v,) for v in a], "v int"), spark.createDataFrame([(v,) for v in b], "v int"), "v").first().tvd
    assert got == pytest.approx(exp)


def test_sample_top_n_with_heavy_copies(spark):
    # a third of the rows are copies of one row; the multiset of the result must be exact
    rows = [(i, "g", float(i)) for i in range(600)] + [(7, "g", 7.0)] * 300
    df = spark.createDataFrame(rows, "trip_id long, file_month string, v double")
    for n in (0, 5, 200, 450, 2000):
        got = sorted(tuple(r) for r in sampling.sample_top_n(df, n, "trip_id", 3, ["file_month"]).collect())
        d = F.md5(F.concat_ws(":", F.col("trip_id").cast("string"), F.lit("3")))
        exp = sorted(
            tuple(r)
            for r in df.withColumn("rk", F.row_number().over(Window.partitionBy("file_month").orderBy(d, "trip_id")))
            .where(F.col("rk") <= n)
            .drop("rk")
            .collect()
        )
        assert got == exp


def test_sample_fixed_n_is_min_of_n_and_rows_per_month(spark):
    from farelane.sources import fixtures as fx

    t = fx.load_trips(spark, "/root/testdata/sf0.001")
    sizes = {r.file_month: r["count"] for r in t.groupBy("file_month").count().collect()}
    got = {r.file_month: r["count"] for r in sampling.sample_fixed_n(t, 70).groupBy("file_month").count().collect()}
    assert got == {m: min(70, n) for m, n in sizes.items()}


def test_quantile_scan_approx_close_to_exact(spark):
    from farelane.plans import audits
    from farelane.sources import fixtures as fx

    t = fx.load_trips(spark, "/root/testdata/sf0.001")
    exact = {r.column: r for r in audits.quantile_scan(t).collect()}
    approx = {r.column: r for r in audits.quantile_scan(t, approx_accuracy=10_000).collect()}
    for c, r in exact.items():
        assert approx[c].global_min == r.global_min and approx[c].global_max == r.global_max
        assert abs(approx[c].q99_max - r.q99_max) <= max(1.0, 0.05 * abs(r.q99_max))
