"""Row filters and cleaning.

Every operator is ``DataFrame -> DataFrame`` with no action inside.  Filters
are plain predicates, so Catalyst pushes the range parts into the parquet
scan; per-month summaries are a single grouped aggregation with map-side
partial aggregation (one small buffer per month per task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.constants import (
    BAD_LOCATION_IDS,
    DROPOFF,
    DURATION_BOUNDS,
    FILE_MONTH,
    LOCATION_REPLACE,
    MISSING_POLICY,
    PICKUP,
    RANGE_BOUNDS,
    TRIO,
    TRIO_DEFAULTS,
)
from farelane.functions.exprs import (
    file_year,
    lenient_double,
    lenient_timestamp,
    minutes_between,
    month_start_ntz,
    nan_as_null,
    not_in,
    null_safe_between,
)


# ---------------------------------------------------------------- C3 casts
def lenient_casts(
    df: DataFrame,
    timestamps: Sequence[str] = (PICKUP, DROPOFF),
    numerics: Sequence[str] = tuple(RANGE_BOUNDS),
) -> DataFrame:
    """Bad timestamps / numbers become NULL instead of failing (``errors="coerce"``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for c in timestamps:
        if c in types:
            out = out.withColumn(c, lenient_timestamp(types[c], c))
    for c in numerics:
        if c in types:
            out = out.withColumn(c, lenient_double(c))
    return out


# ---------------------------------------------------------------- C1 / C2 month filter
def in_file_month(pickup: str | Column = PICKUP, file_month: str = FILE_MONTH) -> Column:
    start = month_start_ntz(file_month)
    p = F.col(pickup) if isinstance(pickup, str) else pickup
    return (p >= start) & (p < start + F.expr("INTERVAL 1 MONTH"))


def month_filter(df: DataFrame, pickup: str = PICKUP, file_month: str = FILE_MONTH) -> DataFrame:
    """Keep pickups inside the file's own month; NULL pickups are dropped."""
    df = lenient_casts(df, timestamps=(pickup,), numerics=())
    return df.where(in_file_month(pickup, file_month))


def month_filter_summary(df: DataFrame, pickup: str = PICKUP, file_month: str = FILE_MONTH) -> DataFrame:
    """Per file: total, kept, dropped, percent dropped, NULL pickups."""
    df = lenient_casts(df, timestamps=(pickup,), numerics=())
    keep = in_file_month(pickup, file_month)
    return (
        df.groupBy(file_month)
        .agg(F.count(F.lit(1)).alias("n_total"), F.count_if(keep).alias("n_kept"), F.count_if(F.col(pickup).isNull()).alias("n_null_pickup"))
        .withColumn("n_dropped", F.col("n_total") - F.col("n_kept"))
        .withColumn(
            "pct_dropped",
            F.when(F.col("n_total") > 0, F.col("n_dropped") * 100.0 / F.col("n_total")).otherwise(F.lit(0.0)),
        )
        .orderBy(file_month)
    )


# ---------------------------------------------------------------- C4-C6 missing values
def drop_null_trio(df: DataFrame, cols: Sequence[str] = TRIO) -> DataFrame:
    """Drop rows with a NULL in any of the trio columns that exist (C4)."""
    present = [c for c in cols if c in df.columns]
    return df.na.drop(how="any", subset=present) if present else df


def file_modes(df: DataFrame, cols: Sequence[str] = TRIO, file_month: str = FILE_MONTH) -> DataFrame:
    """Per-file mode of each column, ties to the smallest value.

    One row per file month, so the result is bounded by the number of input
    files, not by the row count.  ``mode`` keeps a value->count map per group
    in the partial aggregate: small for these low-cardinality columns.
    """
    present = [c for c in cols if c in df.columns]
    return df.groupBy(file_month).agg(*[F.mode(c, True).alias(f"_mode_{c}") for c in present])


def impute_mode(
    df: DataFrame,
    cols: Sequence[str] = TRIO,
    defaults: Mapping[str, object] = TRIO_DEFAULTS,
    file_month: str = FILE_MONTH,
    modes: DataFrame | None = None,
) -> DataFrame:
    """Fill missing values (NULL or NaN) of each column with its own per-file mode, else a default."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    df = nan_as_null(df, present)
    modes = file_modes(df, present, file_month) if modes is None else modes
    # bounded by the number of monthly files: a broadcast of a few hundred rows at most
    joined = df.join(F.broadcast(modes), file_month, "left")
    for c in present:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.col(f"_mode_{c}"), F.lit(defaults[c])))
    return joined.select(*df.columns)


def missing_policy(
    df: DataFrame,
    policy: Mapping[int, str] = MISSING_POLICY,
    cols: Sequence[str] = TRIO,
    defaults: Mapping[str, object] = TRIO_DEFAULTS,
    file_month: str = FILE_MONTH,
    other: str | None = None,
) -> DataFrame:
    """Year-aware handling (C6): ``drop`` or ``impute`` per file year; missing is NULL or NaN.

    Files of a year without an entry are left out, unless ``other`` names what
    to do with them.
    """
    present = [c for c in cols if c in df.columns]
    rules = {*policy.values(), *([other] if other else [])}
    if rules - {"drop", "impute"}:
        raise ValueError(f"unknown missing-value policy {sorted(rules - {'drop', 'impute'})}")
    year = file_year(file_month)
    named = F.coalesce(year.isin(list(policy)), F.lit(False))

    def under(rule: str) -> Column:
        chosen = F.coalesce(year.isin([y for y, p in policy.items() if p == rule]), F.lit(False))
        return chosen | ~named if other == rule else chosen

    kept = nan_as_null(df if other else df.where(named), present)
    if not present:
        return kept
    any_null = F.lit(False)
    for c in present:
        any_null = any_null | F.col(c).isNull()
    kept = kept.where(~(under("drop") & any_null))
    if "impute" not in rules:
        return kept
    is_imp = under("impute")
    modes = file_modes(kept.where(is_imp), present, file_month)
    joined = kept.join(F.broadcast(modes), file_month, "left")
    for c in present:
        joined = joined.withColumn(
            c, F.when(is_imp, F.coalesce(F.col(c), F.col(f"_mode_{c}"), F.lit(defaults[c]))).otherwise(F.col(c))
        )
    return joined.select(*df.columns)


# ---------------------------------------------------------------- C7 / C8 range filter
def unlisted_months(df: DataFrame, policy: Mapping[int, str] = MISSING_POLICY, file_month: str = FILE_MONTH) -> DataFrame:
    """``file_month``, ``n_rows`` of the files that the policy has no entry for and leaves out."""
    return df.where(~F.coalesce(file_year(file_month).isin(list(policy)), F.lit(False))).groupBy(file_month).agg(F.count(F.lit(1)).alias("n_rows"))


def range_mask(bounds: Mapping[str, tuple[float, float]] = RANGE_BOUNDS) -> Column:
    """Inclusive bands where NULL passes (columns already NaN-normalised)."""
    keep = F.lit(True)
    for c, (lo, hi) in bounds.items():
        keep = keep & null_safe_between(c, lo, hi)
    return keep


def _raw_range_mask(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """The same bands on raw numeric columns: NaN counts as missing and passes."""
    keep = F.lit(True)
    for c, (lo, hi) in bounds.items():
        keep = keep & (F.col(c).isNull() | F.isnan(c) | F.col(c).between(lo, hi))
    return keep


def range_filter(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = RANGE_BOUNDS) -> DataFrame:
    """Keep rows inside every inclusive band; NULL (and NaN) passes.

    Nothing but the column selection is pushed to the parquet reader: bounds on
    columns that may hold NaN cannot be, since writers differ in what they put
    into the statistics of such columns.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in bounds if c in types]
    if cols and all(isinstance(types[c], T.NumericType) for c in cols):
        kept = df.where(_raw_range_mask({c: bounds[c] for c in cols}))
        return lenient_casts(kept, timestamps=(), numerics=tuple(cols))
    df = lenient_casts(df, timestamps=(), numerics=tuple(bounds))
    return df.where(range_mask(bounds))


def outlier_summary(
    df: DataFrame,
    bounds: Mapping[str, tuple[float, float]] = RANGE_BOUNDS,
    file_month: str = FILE_MONTH,
) -> DataFrame:
    """Per file: raw, clean, removed and below/above counts per column."""
    df = lenient_casts(df, timestamps=(), numerics=tuple(bounds))
    aggs = [F.count(F.lit(1)).alias("rows_raw"), F.count_if(range_mask(bounds)).alias("rows_clean")]
    for c, (lo, hi) in bounds.items():
        aggs.append(F.count_if(F.col(c) < lo).alias(f"{c}_below"))
        aggs.append(F.count_if(F.col(c) > hi).alias(f"{c}_above"))
    out = df.groupBy(file_month).agg(*aggs)
    cols = [file_month, "rows_raw", "rows_clean", (F.col("rows_raw") - F.col("rows_clean")).alias("rows_removed")]
    cols += [f"{c}_{side}" for c in bounds for side in ("below", "above")]
    return out.select(*cols).orderBy(file_month)


# ---------------------------------------------------------------- C9 location ids
def fix_locations(
    df: DataFrame,
    replace: Mapping[int, int] = LOCATION_REPLACE,
    bad_ids: Sequence[int] = BAD_LOCATION_IDS,
    cols: Sequence[str] = ("PULocationID", "DOLocationID"),
) -> DataFrame:
    """Map replaced ids (57 -> 56) and drop rows whose PU or DO id is bad; NULL ids are kept."""
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        e = F.col(c)
        for old, new in replace.items():
            e = F.when(F.col(c) == old, F.lit(new).cast(df.schema[c].dataType)).otherwise(e)
        out = out.withColumn(c, e)
    keep = F.lit(True)
    for c in cols:
        if c in df.columns:
            keep = keep & not_in(c, bad_ids)
    return out.where(keep)


# ---------------------------------------------------------------- C10 duration
def duration_filter(
    df: DataFrame,
    bounds: tuple[float, float] = DURATION_BOUNDS,
    duration: str = "trip_duration",
) -> DataFrame:
    """Drop trips shorter / longer than the band; a NULL duration is kept."""
    if duration not in df.columns:
        df = df.withColumn(duration, minutes_between(PICKUP, DROPOFF))
    return df.where(null_safe_between(duration, *bounds))


# ---------------------------------------------------------------- C11
def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column (C11)."""
    return df.na.drop(how="any")
