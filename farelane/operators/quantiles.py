"""Exact quantiles of many columns and groups by radix selection.

A double is turned into a 64-bit integer in the same order (its own bits), with
built-in functions only.  One pass counts the values of all columns and groups
by the leading bits of that integer; running sums over these bins tell which
bin holds each wanted rank, and the next pass counts the following bits inside
those bins alone.  A bin of one distinct value is an answer.  So the state of a
pass is bounded by bins x wanted ranks, however many distinct values there are,
and no value list is ever held in one task.  Once the wanted bins hold few
values altogether, the last pass counts them one by one.

Interpolation is linear, as in pandas.  NULL and NaN are left out; -0.0 equals
0.0; infinities are ordered at the ends; a group or column without values has a
count of 0 or no row, and no quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.sources import sinks

#: leading bits that one pass tells apart
BITS = 13
#: values in the wanted bins from which the last pass counts each value
LAST_PASS = 1_000_000


def _exponent(a: Column) -> Column:
    """The exponent of a positive double, or one beside it."""
    return F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1022))


def _key_of(x: Column, a: Column, guess: Column, part: Column) -> Column:
    exponent = F.when(part >= 2, guess + 1).when(part < 1, guess - 1).otherwise(guess)
    mantissa = F.when(part >= 2, part / 2).when(part < 1, part * 2).otherwise(part)
    one = F.lit(1 << 52)
    normal = (exponent + 1023).cast("long") * one + ((mantissa - 1) * F.lit(float(1 << 52))).cast("long")
    tiny = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    bits = F.when(a == 0, F.lit(0).cast("long")).when(a < F.lit(2.0**-1022), tiny).when(a == F.lit(float("inf")), F.lit(2047) * one).otherwise(normal)
    return F.when(x < 0, -bits).otherwise(bits)


def ordered_key(x: Column) -> Column:
    """A double as a long in the same order; equal only for equal values (-0.0 counts as 0.0)."""
    a = F.abs(x)
    guess = _exponent(a)
    return _key_of(x, a, guess, a / F.pow(F.lit(2.0), guess))  # powers of two are exact, and so is dividing by one


def with_ordered_key(df: DataFrame, x: str, key: str) -> DataFrame:
    """``df`` with the ordered key of ``x``; the logarithm and the power, which the key names many times, are columns of their own and formed once."""
    named = df.withColumn("_a", F.abs(x)).withColumn("_guess", _exponent(F.col("_a")))
    named = named.withColumn("_part", F.col("_a") / F.pow(F.lit(2.0), F.col("_guess")))
    return named.withColumn(key, _key_of(*map(F.col, (x, "_a", "_guess", "_part")))).drop("_a", "_guess", "_part")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop(*(f"_r_{k}" for k in keys))


def _values(df: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """One row per value: groups, ``_c`` (place of the column), ``_x`` and its key."""
    xs = F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns])
    long = df.select(*groups, F.posexplode(xs).alias("_c", "_x")).filter(F.col("_x").isNotNull())
    return with_ordered_key(long, "_x", "_key")


def _histogram(values: DataFrame, keys: Sequence[str], shift: int) -> DataFrame:
    return values.groupBy(*keys, F.shiftright("_key", shift).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))


def _placed(hist: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each wanted rank with the bin that holds it; ranks are then counted inside the bin."""
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin")) - F.col("_n")
    bins = null_safe_join(hist.withColumn("_before", before), wanted.groupBy(*keys).agg(F.collect_list(F.struct("_rank", "_asked")).alias("_ranks")), keys)
    inside = F.filter("_ranks", lambda r: (r["_rank"] >= F.col("_before")) & (r["_rank"] < F.col("_before") + F.col("_n")))
    out = bins.withColumn("_r", F.explode(inside))
    return out.withColumns({"_asked": F.col("_r._asked"), "_rank": F.col("_r._rank") - F.col("_before")})


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], groups: Sequence[str] = (), bits: int = BITS, last_pass: int = LAST_PASS
) -> DataFrame:
    """``groups``, ``column``, ``count``, ``min``, ``max``, ``quantiles`` (an array in the order of ``probs``).

    Reads ``df`` once per pass: two passes for small data, at most one per
    ``bits`` of 64 and usually three or four.
    """
    if any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    columns, groups = list(columns), list(groups)
    values = _values(df, columns, groups)
    keys = [*groups, "_c"]
    shift = 64 - bits
    hist = sinks.materialize(_histogram(values, keys, shift), "quantile_bins")
    totals = hist.groupBy(*keys).agg(F.sum("_n").alias("_total"), F.min("_lo").alias("_min"), F.max("_hi").alias("_max"))
    places = F.array(*[F.lit(float(p)) * (F.col("_total") - 1) for p in probs])
    asked = totals.withColumn("_asked", F.explode(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(F.floor(p), F.ceil(p)))))))
    wanted = asked.select(*keys, "_asked", F.col("_asked").alias("_rank"))
    found = []
    inner = list(keys)
    while True:
        placed = _placed(hist, wanted, inner).select(*keys, "_bin", "_asked", "_rank", "_n", "_lo", "_hi")
        if shift:
            placed = sinks.materialize(placed, "quantile_ranks")
        found.append(placed.filter("_lo = _hi").select(*keys, "_asked", F.col("_lo").alias("_value")))
        if not shift:  # every bin is one value
            break
        left = placed.filter("_lo < _hi")
        open_bins = left.select(*keys, "_bin", "_n").distinct()
        n_left = open_bins.agg(F.sum("_n")).first()[0]  # one number
        if not n_left:
            break
        narrower = 0 if n_left <= last_pass else max(0, shift - bits)
        inner = [*keys, "_outer"]
        at = values.withColumn("_outer", F.shiftright("_key", shift))
        hist = _histogram(null_safe_join(at, open_bins.select(*keys, F.col("_bin").alias("_outer")), inner), inner, narrower)
        if narrower:
            hist = sinks.materialize(hist, "quantile_bins")
        wanted = left.select(*keys, F.col("_bin").alias("_outer"), "_asked", "_rank")
        shift = narrower
    values_at = found[0]
    for more in found[1:]:
        values_at = values_at.unionByName(more)
    by_rank = values_at.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_asked", "_value"))).alias("_at"))

    def between(p: float) -> Column:
        place = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.element_at("_at", F.floor(place)), F.element_at("_at", F.ceil(place))
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))

    names = F.array(*[F.lit(c) for c in columns])
    done = null_safe_join(totals, by_rank, keys)
    return done.select(
        *groups,
        F.element_at(names, F.col("_c") + 1).alias("column"),
        F.col("_total").alias("count"),
        F.col("_min").alias("min"),
        F.col("_max").alias("max"),
        F.array(*[between(p) for p in probs]).alias("quantiles"),
    )
