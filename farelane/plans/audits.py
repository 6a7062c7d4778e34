"""Data-quality audits (H1-H13) as grouped aggregations.

Each audit returns a small result DataFrame.  They read the trip frame once
per aggregation; every group-by is partially aggregated map-side, so a hot
month costs one buffer per task, not one task per month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.constants import (
    BAD_LOCATION_IDS,
    BIAS_CATEGORICALS,
    BIAS_NUMERICS,
    BIAS_SEEDS,
    DROPOFF,
    DURATION_BOUNDS,
    FILE_MONTH,
    KS_OK,
    PICKUP,
    RANGE_BOUNDS,
    TRIO,
    TVD_OK,
    UNKNOWN,
)
from farelane.functions.exprs import is_finite, minutes_between, nan_as_null
from farelane.operators import clean, sampling, stats
from farelane.operators.quantiles import exact_quantiles, null_safe_join
from farelane.sources import sinks


# ---------------------------------------------------------------- H1
CO_MISSING_ALL = "all or nothing"
CO_MISSING_PARTIAL = "some rows miss only a part of the group"
CO_MISSING_COLUMNS = "columns of the group are absent; any missing value counts"


def co_missing(
    df: DataFrame,
    trio: Sequence[str] = TRIO,
    file_month: str = FILE_MONTH,
) -> DataFrame:
    """Per month over all rows: are the trio's missing values all-or-nothing, and what would a drop lose (one scan)."""
    s = nan_as_null(df, df.columns)
    present = [c for c in trio if c in df.columns]
    if len(present) == len(trio):
        n_null = sum((F.col(c).isNull().cast("int") for c in present), F.lit(0))
        partial = (n_null > 0) & (n_null < len(present))
        lost = n_null > 0
        out = s.groupBy(file_month).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(partial).alias("n_partial"), F.count_if(lost).alias("rows_lost")
        )
        status = F.when(F.col("n_partial") == 0, F.lit(CO_MISSING_ALL)).otherwise(
            F.lit(CO_MISSING_PARTIAL)
        )
    else:
        any_null = F.lit(False)
        for c in df.columns:
            any_null = any_null | F.col(c).isNull()
        out = s.groupBy(file_month).agg(
            F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("n_partial"), F.count_if(any_null).alias("rows_lost")
        )
        status = F.lit(CO_MISSING_COLUMNS)
    return out.select(
        file_month,
        "n_rows",
        "n_partial",
        "rows_lost",
        F.when(F.col("n_rows") > 0, F.col("rows_lost") * 100.0 / F.col("n_rows")).otherwise(0.0).alias("pct_lost"),
        status.alias("status"),
    )


# ---------------------------------------------------------------- H2
def null_profile(df: DataFrame, cols: Sequence[str] | None = None, file_month: str = FILE_MONTH) -> DataFrame:
    """Long form ``(file_month, column, n_rows, n_null, pct_null)``: one aggregation pass."""
    cols = [c for c in (cols or df.columns) if c != file_month]
    df = nan_as_null(df, cols)
    wide = df.groupBy(file_month).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n_{i}").alias("n_null")) for i, c in enumerate(cols)])
    return wide.select(file_month, "n_rows", F.explode(pairs).alias("_p")).select(
        file_month,
        "_p.column",
        "n_rows",
        "_p.n_null",
        (F.col("_p.n_null") * 100.0 / F.col("n_rows")).alias("pct_null"),
    )


# ---------------------------------------------------------------- H3
TVD_COLUMNS = {"PULocationID": "TVD_PULocationID", "DOLocationID": "TVD_DOLocationID", "_hour": "TVD_hour", "payment_type": "TVD_payment_type"}


def drop_impact(df: DataFrame, trio: Sequence[str] = TRIO, file_month: str = FILE_MONTH) -> DataFrame:
    """Per month: what dropping rows with a NULL in the trio does to size, means and mix (H3).

    One scan: rows are stacked per audited column, value counts (all / kept)
    are aggregated per (month, column, value), and the sums behind the monthly
    means ride along on the first column's rows.
    """
    present = [c for c in trio if c in df.columns]
    df = nan_as_null(df, present)
    kept = F.lit(True)
    for c in present:
        kept = kept & F.col(c).isNotNull()
    base = df.withColumn("_kept", kept).withColumn("_hour", F.hour(F.col(PICKUP).cast("timestamp_ntz")))
    cols = [c for c in TVD_COLUMNS if c in base.columns]
    first = cols[0]
    long = stats.long_values(base, cols, keep=[file_month, "_kept", "total_amount", "trip_distance"])
    on_first = F.col("column") == first
    k = F.col("_kept")

    def s(c, cond):
        return F.sum(F.when(on_first & cond, F.col(c)))

    def n(c, cond):
        return F.count(F.when(on_first & cond, F.col(c)))

    counts = long.groupBy(file_month, "column", "value").agg(
        F.count(F.lit(1)).alias("c_p"),
        F.count_if(k).alias("c_q"),
        s("total_amount", F.lit(True)).alias("_ta"),
        n("total_amount", F.lit(True)).alias("_nta"),
        s("total_amount", k).alias("_tak"),
        n("total_amount", k).alias("_ntak"),
        s("trip_distance", F.lit(True)).alias("_td"),
        n("trip_distance", F.lit(True)).alias("_ntd"),
        s("trip_distance", k).alias("_tdk"),
        n("trip_distance", k).alias("_ntdk"),
    )
    # one more grouping of the same rows gives the distances and the sums, so the trips are read once
    totals = Window.partitionBy(file_month, "column")
    share_all = F.col("c_p") / F.sum("c_p").over(totals)
    share_kept = F.coalesce(F.try_divide(F.col("c_q"), F.sum("c_q").over(totals)), F.lit(0.0))
    shares = counts.withColumn("_gap", F.abs(share_all - share_kept))
    sums = ("c_p", "c_q", "_ta", "_nta", "_tak", "_ntak", "_td", "_ntd", "_tdk", "_ntdk")
    per_column = shares.groupBy(file_month, "column").agg((0.5 * F.sum("_gap")).alias("tvd"), *[F.sum(c).alias(c) for c in sums])

    def of_first(c):
        return F.max(F.when(F.col("column") == first, F.col(c)))

    out = per_column.groupBy(file_month).agg(
        of_first("c_p").alias("rows_total"),
        of_first("c_q").alias("rows_after_dropna"),
        F.try_divide(of_first("_ta"), of_first("_nta")).alias("total_amount_mean_all"),
        F.try_divide(of_first("_tak"), of_first("_ntak")).alias("total_amount_mean_clean"),
        F.try_divide(of_first("_td"), of_first("_ntd")).alias("trip_dist_mean_all"),
        F.try_divide(of_first("_tdk"), of_first("_ntdk")).alias("trip_dist_mean_clean"),
        *[F.max(F.when(F.col("column") == c, F.col("tvd"))).alias(name) for c, name in TVD_COLUMNS.items() if c in cols],
    )
    return out.select(
        F.col(file_month).alias("month"),
        "rows_total",
        "rows_after_dropna",
        F.round(
            F.when(F.col("rows_total") > 0, (F.col("rows_total") - F.col("rows_after_dropna")) * 100.0 / F.col("rows_total")).otherwise(0.0),
            2,
        ).alias("pct_dropped"),
        F.round("total_amount_mean_all", 2).alias("total_amount_mean_all"),
        F.round("total_amount_mean_clean", 2).alias("total_amount_mean_clean"),
        F.round("trip_dist_mean_all", 3).alias("trip_dist_mean_all"),
        F.round("trip_dist_mean_clean", 3).alias("trip_dist_mean_clean"),
        *[F.round(name, 3).alias(name) for c, name in TVD_COLUMNS.items() if c in cols],
    ).orderBy("month")


# ---------------------------------------------------------------- H6
def sampling_bias(
    population: DataFrame,
    sample: DataFrame,
    cats: Sequence[str] = BIAS_CATEGORICALS,
    nums: Sequence[str] = BIAS_NUMERICS,
    seeds: Sequence[int] = BIAS_SEEDS,
    key: str = "trip_id",
    split_col: str = "split",
    materialize_draws: bool = True,
) -> DataFrame:
    """Per split: re-draw a sample of the same size from the population for each seed,
    score it by the largest TVD over ``cats`` and the largest KS over ``nums``,
    then report min / mean / max over the seeds and pass / fail flags.

    Both inputs carry ``split``; the sample size per split comes from ``sample``.
    The per-seed draws are one exploded pass (``len(seeds)`` rows per row), not
    a join; all distances are computed from value counts.
    """
    cats = [c for c in cats if c in population.columns]
    nums = [c for c in nums if c in population.columns]
    sizes = sample.groupBy(split_col).agg(F.count(F.lit(1)).alias("_size"))
    pop = population.join(F.broadcast(sizes), split_col, "inner")  # one row per split
    seeded = pop.select(*pop.columns, F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed"))
    drawn = sampling.sample_top_n(seeded, F.col("_size"), key, F.col("seed"), [split_col, "seed"])
    if materialize_draws:
        # the draws feed two aggregations; write them once instead of re-running the sampler
        drawn = sinks.materialize(drawn.select(split_col, "seed", *cats, *nums), "bias_draws")
    seed_tbl = sizes.select(split_col, F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed"))

    parts = []
    if cats:
        pc = stats.long_values(pop, cats, keep=[split_col]).groupBy(split_col, "column", "value").agg(F.count(F.lit(1)).alias("c_p"))
        sc = (
            stats.long_values(drawn, cats, keep=[split_col, "seed"])
            .groupBy(split_col, "seed", "column", "value")
            .agg(F.count(F.lit(1)).alias("c_q"))
        )
        # population counts repeated per seed: rows = splits x seeds x distinct values
        pcs = pc.join(F.broadcast(seed_tbl), split_col, "inner")
        # NULL is a category too, so the value key is matched null-safely
        counts = _null_safe_counts(pcs, sc, [split_col, "seed", "column"])
        t = stats.tvd_from_counts(counts, [split_col, "seed", "column"])
        parts.append(t.groupBy(split_col, "seed").agg(F.max("tvd").alias("tvd")))
    if nums:
        px = stats.long_values(pop, nums, keep=[split_col], as_string=False).where(is_finite("value"))
        sx = stats.long_values(drawn, nums, keep=[split_col, "seed"], as_string=False).where(is_finite("value"))
        pxc = px.groupBy(split_col, "column", "value").agg(F.count(F.lit(1)).alias("c_x"))
        sxc = sx.groupBy(split_col, "seed", "column", "value").agg(F.count(F.lit(1)).alias("c_y"))
        pxs = pxc.join(F.broadcast(seed_tbl), split_col, "inner")
        kc = pxs.join(sxc, [split_col, "seed", "column", "value"], "full_outer").na.fill(0, ["c_x", "c_y"])
        ks = stats.ks_from_counts(kc, [split_col, "seed", "column"])
        parts.append(ks.groupBy(split_col, "seed").agg(F.max(F.when(~F.isnan("ks"), F.col("ks"))).alias("ks")))
    per_seed = seed_tbl.select(split_col, "seed")
    for p in parts:
        per_seed = per_seed.join(p, [split_col, "seed"], "left")
    out = per_seed.groupBy(split_col).agg(
        *(
            [F.min("tvd").alias("tvd_min"), F.avg("tvd").alias("tvd_mean"), F.max("tvd").alias("tvd_max")]
            if cats
            else []
        ),
        *([F.min("ks").alias("ks_min"), F.avg("ks").alias("ks_mean"), F.max("ks").alias("ks_max")] if nums else []),
    )
    if cats:
        out = out.withColumn("tvd_ok", F.col("tvd_max") <= F.lit(TVD_OK))
    if nums:
        out = out.withColumn("ks_ok", F.col("ks_max") <= F.lit(KS_OK))
    return out.orderBy(split_col)


def _null_safe_counts(p: DataFrame, q: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys + ["value"]:
        c = p[k].eqNullSafe(q[k])
        cond = c if cond is None else cond & c
    j = p.alias("p").join(q.alias("q"), cond, "full_outer")
    return j.select(
        *[F.coalesce(F.col(f"p.{k}"), F.col(f"q.{k}")).alias(k) for k in keys],
        F.coalesce(F.col("p.value"), F.col("q.value")).alias("value"),
        F.coalesce(F.col("p.c_p"), F.lit(0)).alias("c_p"),
        F.coalesce(F.col("q.c_q"), F.lit(0)).alias("c_q"),
    )


# ---------------------------------------------------------------- H7
def quantile_scan(
    df: DataFrame,
    cols: Sequence[str] = tuple(RANGE_BOUNDS),
    file_month: str = FILE_MONTH,
    approx_accuracy: int | None = None,
) -> DataFrame:
    """Per-file 1% / 99% quantiles, min, max; then pooled (H7).

    Exact by default, by radix selection (``quantiles.exact_quantiles``): linear
    interpolation like pandas, state bounded whatever the number of distinct
    values.  ``approx_accuracy`` switches to ``percentile_approx``, a sketch of
    fixed size read in one pass (relative rank error ``1 / approx_accuracy``).
    A column without values has a row of NULLs.
    """
    cols = list(cols)
    if approx_accuracy:
        wide = df.groupBy(file_month).agg(
            *[
                F.struct(F.percentile_approx(F.col(c), [0.01, 0.99], approx_accuracy).alias("quantiles"), F.min(c).alias("min"), F.max(c).alias("max")).alias(f"_s_{i}")
                for i, c in enumerate(cols)
            ]
        )
        per_file = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s_{i}").alias("s")) for i, c in enumerate(cols)])).alias("r")).select("r.column", "r.s.*")
    else:
        per_file = exact_quantiles(df, cols, [0.01, 0.99], [file_month])
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(per_file, "column", "left").groupBy("column").agg(
        F.round(F.min(F.col("quantiles")[0]), 2).alias("q01_min"),
        F.round(F.max(F.col("quantiles")[1]), 2).alias("q99_max"),
        F.round(F.min("min"), 2).alias("global_min"),
        F.round(F.max("max"), 2).alias("global_max"),
    )


# ---------------------------------------------------------------- H8
def outlier_share(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = RANGE_BOUNDS) -> DataFrame:
    """Per column: values outside the band, non-NULL total, percent (H8)."""
    items = list(bounds.items())
    wide = df.agg(
        *[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"_o_{i}") for i, (c, (lo, hi)) in enumerate(items)],
        *[F.count(c).alias(f"_t_{i}") for i, (c, _) in enumerate(items)],
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_o_{i}").alias("n_outside"), F.col(f"_t_{i}").alias("n_total")) for i, (c, _) in enumerate(items)]
    )
    return wide.select(F.explode(pairs).alias("_p")).select(
        "_p.column",
        "_p.n_outside",
        "_p.n_total",
        F.when(F.col("_p.n_total") > 0, F.col("_p.n_outside") * 100.0 / F.col("_p.n_total")).alias("pct_outside"),
    )


# ---------------------------------------------------------------- H9
def location_fix_summary(df: DataFrame, zones: DataFrame, file_month: str = FILE_MONTH) -> DataFrame:
    """Per file: rows in / out of the id fix + centroid join, bad-id drops, missing coordinates (H9).

    One scan: instead of materialising the fan-out of the centroid join, each
    trip looks up (broadcast, one row per zone id) how many zone rows its PU
    and DO ids have and how many of those lack coordinates, and contributes
    the resulting output-row counts to a single aggregation.
    """
    zstats = zones.groupBy("LocationID").agg(
        F.count(F.lit(1)).alias("_m"),
        F.count_if(F.col("lon").isNull() | F.col("lat").isNull()).alias("_mnull"),
    )
    fixed = clean.fix_locations(df.withColumn("_in", F.lit(1)), bad_ids=())  # id replacement only
    bad = F.lit(False)
    for c in ("PULocationID", "DOLocationID"):
        bad = bad | F.coalesce(F.col(c).isin(*BAD_LOCATION_IDS), F.lit(False))
    j = fixed.withColumn("_bad", bad)
    for side, key in (("p", "PULocationID"), ("d", "DOLocationID")):
        zs = F.broadcast(zstats).select(  # bounded by the number of zone ids
            F.col("LocationID").alias(f"_{side}id"), F.col("_m").alias(f"_{side}m"), F.col("_mnull").alias(f"_{side}null")
        )
        j = j.join(zs, F.col(key) == F.col(f"_{side}id"), "left")
    # rows one trip becomes after the two left joins, and how many lack each side's coordinates
    pm = F.coalesce(F.col("_pm"), F.lit(1))
    dm = F.coalesce(F.col("_dm"), F.lit(1))
    p_missing = F.when(F.col("_pm").isNull(), F.lit(1)).otherwise(F.col("_pnull"))
    d_missing = F.when(F.col("_dm").isNull(), F.lit(1)).otherwise(F.col("_dnull"))
    ok = ~F.col("_bad")
    out = j.groupBy(file_month).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.sum(F.when(ok, pm * dm).otherwise(0)).cast("long").alias("rows_out"),
        F.count_if(F.col("_bad")).alias("rows_dropped_invalidID"),
        F.sum(F.when(ok, p_missing * dm).otherwise(0)).cast("long").alias("missing_pickup_coords"),
        F.sum(F.when(ok, d_missing * pm).otherwise(0)).cast("long").alias("missing_dropoff_coords"),
    )
    return out.orderBy(file_month)


# ---------------------------------------------------------------- H10 / H11
def _duration(df: DataFrame) -> DataFrame:
    if "trip_duration" in df.columns:
        return df
    return df.withColumn("trip_duration", minutes_between(PICKUP, DROPOFF))


def duration_share(df: DataFrame, bounds: tuple[float, float] = DURATION_BOUNDS) -> DataFrame:
    """Rows, durations outside the band (NULL not counted), share."""
    lo, hi = bounds
    d = F.col("trip_duration")
    return _duration(df).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if((d < lo) | (d > hi)).alias("n_outside")).select(
        "total_rows", "n_outside", F.when(F.col("total_rows") > 0, F.col("n_outside") / F.col("total_rows")).alias("share_outside")
    )


def describe_duration(df: DataFrame, file_month: str = FILE_MONTH) -> DataFrame:
    """count / mean / std / min / 1% / 50% / 99% / max of the duration per file, 2 dp."""
    d = F.col("trip_duration")
    timed = _duration(df).select(file_month, "trip_duration")
    moments = timed.groupBy(file_month).agg(F.count(d).alias("count"), F.avg(d).alias("mean"), F.stddev_samp(d).alias("std"), F.min(d).alias("min"), F.max(d).alias("max"))
    ranks = exact_quantiles(timed, ["trip_duration"], [0.01, 0.5, 0.99], [file_month]).select(file_month, "quantiles")
    out = null_safe_join(moments, ranks, [file_month], "left")
    return out.select(
        file_month,
        "count",
        *[F.round(c, 2).alias(c) for c in ("mean", "std", "min")],
        *[F.round(F.col("quantiles")[i], 2).alias(c) for i, c in enumerate(("p01", "p50", "p99"))],
        F.round("max", 2).alias("max"),
    ).orderBy(file_month)


# ---------------------------------------------------------------- H12 / H13
def unmapped_boroughs(features: DataFrame, file_month: str = FILE_MONTH) -> DataFrame:
    return features.groupBy(file_month).agg(
        F.count_if(F.col("pickup_borough") == UNKNOWN).alias("unmapped_pickup"),
        F.count_if(F.col("dropoff_borough") == UNKNOWN).alias("unmapped_dropoff"),
    ).orderBy(file_month)


def nunique_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column (H13); ``approx`` uses HyperLogLog++ in one pass.

    Exactly: one distinct count per column, each of which reads its own column
    alone, so a row is never copied once per column.
    """
    cols = list(cols or df.columns)
    if not approx:
        counts = [df.select(F.col(c).alias("v")).filter(F.col("v").isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_unique")).select(F.lit(c).alias("column"), "n_unique") for c in cols]
        out = counts[0]
        for more in counts[1:]:
            out = out.unionByName(more)
        return out
    wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"_u_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_u_{i}").cast("long").alias("n_unique")) for i, c in enumerate(cols)])
    return wide.select(F.explode(pairs).alias("_p")).select("_p.column", "_p.n_unique")
