"""Radix selection against pandas, and its ordered keys against the bits themselves."""

import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farelane.operators.quantiles import exact_quantiles, ordered_key, with_ordered_key

PROBS = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]


def test_keys_keep_the_order_of_doubles(spark):
    rng = random.Random(5)
    xs = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    xs += [s * 2.0**e * f for e in (-1074, -1050, -1022, -1021, -1, 0, 1, 52, 53, 1022, 1023) for f in (1.0, 1 + 2**-52, 1.5, 2 - 2**-52) for s in (1, -1) if 2.0**e * f < 1.8e308]
    xs += [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7976931348623157e308, 0.1, 0.2, 0.30000000000000004, 2.2250738585072014e-308, 2.225073858507201e-308]
    xs = [x for x in xs if not math.isnan(x)]
    got = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", ordered_key(F.col("x"))).collect()}

    def bits(x):
        b = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        return -b if x < 0 else b

    assert {x: bits(x) for x in got} == got


def frame(seed, n):
    rng = np.random.default_rng(seed)
    g = rng.choice(["2024-01", "2024-02", "2024-03"], n, p=[0.7, 0.29, 0.01]).astype(object)
    g[rng.random(n) < 0.05] = None
    a = np.round(rng.gamma(2.0, 3.0, n), 2)
    b = rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n)
    c = rng.choice([1.0, 1.0, 2.0, -0.0, 0.0], n)
    a[rng.random(n) < 0.1] = np.nan
    d = np.full(n, np.nan)
    return pd.DataFrame({"g": g, "a": a, "b": b, "c": c, "d": d, "i": rng.integers(-5, 100, n)})


@pytest.mark.parametrize("bits,last_pass", [(13, 1_000_000), (13, 0), (4, 0), (7, 40)])
def test_equals_pandas(spark, bits, last_pass):
    pdf = frame(bits, 2500)
    df = spark.createDataFrame(pdf, "g string, a double, b double, c double, d double, i long").repartition(3)
    got = {(r["g"], r["column"]): r for r in exact_quantiles(df, ["a", "b", "c", "d", "i"], PROBS, ["g"], bits, last_pass).collect()}
    n = 0
    for g, part in pdf.groupby("g", dropna=False):
        g = None if pd.isna(g) else g
        for c in ["a", "b", "c", "d", "i"]:
            x = part[c].dropna()
            if x.empty:
                assert (g, c) not in got
                continue
            r = got[(g, c)]
            assert (r["count"], r["min"], r["max"]) == (len(x), x.min(), x.max())
            np.testing.assert_allclose(r["quantiles"], x.quantile(PROBS).to_numpy(), rtol=1e-12)
            n += 1
    assert n == len(got) == 16


def test_small_groups_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("b", 2.0), ("c", float("nan")), ("d", None), ("e", float("inf")), ("e", 1.0)], "g string, x double")
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], ["g"], last_pass=0).collect()}
    assert got == {"a": [3.0, 3.0, 3.0], "b": [1.0, 1.5, 2.0], "e": [1.0, math.inf, math.inf]}
    assert exact_quantiles(df.limit(0), ["x"], [0.5]).count() == 0
    assert [r["quantiles"] for r in exact_quantiles(df.filter("g < 'c'"), ["x"], [0.5]).collect()] == [[2.0]]
    with pytest.raises(ValueError):
        exact_quantiles(df, ["x"], [1.5])


def test_a_pass_holds_bins_not_values(spark, monkeypatch):
    """Every table written between passes is bounded by bins and ranks, not by distinct values."""
    from farelane.operators import quantiles as Q

    sizes = []
    real = Q.sinks.materialize
    monkeypatch.setattr(Q.sinks, "materialize", lambda df, name: (out := real(df, name), sizes.append((name, out.count())))[0])
    df = spark.range(200_000).select((F.col("id") * 0.37 + 5).alias("x"))
    row = exact_quantiles(df, ["x"], [0.01, 0.99], bits=8, last_pass=100).first()
    assert row["quantiles"] == pytest.approx([0.37 * 0.01 * 199_999 + 5, 0.37 * 0.99 * 199_999 + 5], rel=1e-12)
    assert max(n for name, n in sizes if name == "quantile_bins") <= 4 * 256
    assert max(n for name, n in sizes if name == "quantile_ranks") <= 4


def test_key_forms_its_logarithm_once(spark):
    """Before, the plan spelt the logarithm out some twenty times for every value."""
    xs = [0.0, -0.0, 1.0, -1.0, 0.1, 3.0, 2.0**-1074, -(2.0**-1022), 1.7e308, float("inf"), float("-inf"), 1 / 3, 8.0, -7.999999999999999]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(2)
    keyed = with_ordered_key(df, "x", "k")
    assert all(a == b for a, b in keyed.select("k", ordered_key(F.col("x"))).collect())
    plan = keyed.groupBy(F.shiftright("k", 20)).count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LOG2(") == 1 and plan.count("POWER(") == 1
