"""Distribution distances: total variation (H4) and two-sample KS (H5).

Both work on pre-aggregated value counts, so the shuffle carries one row per
(group, value) after map-side partial aggregation, never the raw rows.

KS needs running sums over values in order.  A single ordered window per
group would put all distinct values of a group in one task, so the prefix
sums are computed in two passes: values are cut into ``buckets`` ranges
(boundaries from ``percentile_approx`` over the distinct values; any
boundaries give the exact result), bucket totals give per-bucket offsets
through a window of at most ``buckets`` rows, and the running sums inside a
bucket use a window partitioned by (group, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions.exprs import is_finite


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), as_string: bool = True) -> DataFrame:
    """Stack ``cols`` into ``(column, value)`` rows, keeping ``keep`` columns."""
    pairs = [
        F.struct(F.lit(c).alias("column"), (F.col(c).cast("string") if as_string else F.col(c).cast("double")).alias("value"))
        for c in cols
    ]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("_kv")).select(*keep, "_kv.column", "_kv.value")


def tvd_from_counts(counts: DataFrame, groups: Sequence[str], p_count: str = "c_p", q_count: str = "c_q") -> DataFrame:
    """``0.5 * sum |p - q|`` per group from per-value counts of both sides.

    ``counts`` has one row per (group, value) with both counts (0 where a side
    lacks the value), i.e. the outer alignment of the two value-count tables.
    An empty side contributes shares of 0.
    """
    groups = list(groups)
    # running totals over the value counts, so what they are made from is read once
    whole = Window.partitionBy(*groups)
    j = counts.withColumn("_np", F.sum(p_count).over(whole)).withColumn("_nq", F.sum(q_count).over(whole))
    share = lambda c, n: F.when(F.col(n) > 0, F.col(c) / F.col(n)).otherwise(F.lit(0.0))
    return j.groupBy(*groups).agg((F.lit(0.5) * F.sum(F.abs(share(p_count, "_np") - share(q_count, "_nq")))).alias("tvd"))


def tvd(p: DataFrame, q: DataFrame, col: str, groups: Sequence[str] = ()) -> DataFrame:
    """TVD of the value counts of ``col`` (NULL is a category) between two frames."""
    groups = list(groups)
    u = p.select(*groups, F.col(col).alias("value"), F.lit(1).alias("_side")).unionByName(
        q.select(*groups, F.col(col).alias("value"), F.lit(2).alias("_side"))
    )
    counts = u.groupBy(*groups, "value").agg(
        F.count_if(F.col("_side") == 1).alias("c_p"), F.count_if(F.col("_side") == 2).alias("c_q")
    )
    if not groups:
        counts = counts.withColumn("_g", F.lit(1))
        return tvd_from_counts(counts, ["_g"]).drop("_g")
    return tvd_from_counts(counts, groups)


def _count_below(bounds: Column, v: Column, n: int) -> Column:
    """Number of entries of the sorted array ``bounds`` (length ``n``) below ``v``.

    A binary search unrolled into nested CASE expressions (depth log2 n), so it
    compiles into the generated code instead of running a lambda per element.
    """

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.element_at(bounds, mid + 1) < v, build(mid + 1, hi)).otherwise(build(lo, mid))

    return build(0, n)


def ks_from_counts(
    counts: DataFrame,
    groups: Sequence[str],
    value: str = "value",
    x_count: str = "c_x",
    y_count: str = "c_y",
    buckets: int = 64,
) -> DataFrame:
    """Two-sample KS per group from per-value counts (``value`` finite, both counts >= 0).

    Returns ``groups + [ks]``; NaN when a side is empty.
    """
    gkey = list(groups)
    if not gkey:
        raise ValueError("ks_from_counts needs at least one group column")
    bounds = counts.groupBy(*gkey).agg(
        F.percentile_approx(value, [i / buckets for i in range(1, buckets)], 1000).alias("_bounds"),
        F.sum(x_count).alias("_nx"),
        F.sum(y_count).alias("_ny"),
    )
    # one row per group (bounded by the number of groups)
    c = counts.join(F.broadcast(bounds), gkey, "inner")
    c = c.withColumn("_b", _count_below(F.col("_bounds"), F.col(value), buckets - 1))
    btot = c.groupBy(*gkey, "_b").agg(F.sum(x_count).alias("_bx"), F.sum(y_count).alias("_by"))
    wb = Window.partitionBy(*gkey).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = btot.select(
        *gkey,
        "_b",
        F.coalesce(F.sum("_bx").over(wb), F.lit(0)).alias("_ox"),
        F.coalesce(F.sum("_by").over(wb), F.lit(0)).alias("_oy"),
    )
    wv = Window.partitionBy(*gkey, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = c.join(offs, [*gkey, "_b"], "inner").select(
        *gkey,
        "_nx",
        "_ny",
        (F.col("_ox") + F.sum(x_count).over(wv)).alias("_cx"),
        (F.col("_oy") + F.sum(y_count).over(wv)).alias("_cy"),
    )
    gap = F.abs(F.try_divide(F.col("_cx"), F.col("_nx")) - F.try_divide(F.col("_cy"), F.col("_ny")))
    out = run.groupBy(*gkey).agg(F.max(gap).alias("_ks"), F.max("_nx").alias("_nx"), F.max("_ny").alias("_ny"))
    return out.select(
        *gkey,
        F.when((F.col("_nx") > 0) & (F.col("_ny") > 0), F.col("_ks")).otherwise(F.lit(float("nan"))).alias("ks"),
    )


def ks_distance(x: DataFrame, y: DataFrame, col: str, groups: Sequence[str] = (), buckets: int = 64) -> DataFrame:
    """KS distance of the finite values of ``col`` between two frames, per group."""
    groups = list(groups)
    u = x.select(*groups, F.col(col).cast("double").alias("value"), F.lit(1).alias("_side")).unionByName(
        y.select(*groups, F.col(col).cast("double").alias("value"), F.lit(2).alias("_side"))
    )
    counts = (
        u.where(is_finite("value"))
        .groupBy(*groups, "value")
        .agg(F.count_if(F.col("_side") == 1).alias("c_x"), F.count_if(F.col("_side") == 2).alias("c_y"))
    )
    if not groups:
        counts = counts.withColumn("_g", F.lit(1))
        return ks_from_counts(counts, ["_g"], buckets=buckets).drop("_g")
    return ks_from_counts(counts, groups, buckets=buckets)



def ks_subset(df: DataFrame, col: str, subset: Column, groups: Sequence[str], buckets: int = 64) -> DataFrame:
    """KS between all rows and the rows where ``subset`` holds, from one scan.

    The common audit shape (a frame against a filtered copy of itself): one
    aggregation gives both counts per value, so the data is read once.
    """
    counts = (
        df.select(*groups, F.col(col).cast("double").alias("value"), F.coalesce(subset, F.lit(False)).alias("_in"))
        .where(is_finite("value"))
        .groupBy(*groups, "value")
        .agg(F.count(F.lit(1)).alias("c_x"), F.count_if("_in").alias("c_y"))
    )
    return ks_from_counts(counts, list(groups), buckets=buckets)
