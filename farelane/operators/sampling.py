"""Time-based splits and deterministic per-group sampling.

Sampling keeps, per group, the ``n`` rows with the smallest
``(md5(key:seed), key)``.  The order is a property of the row, not of its
partition, so the sample is identical across runs, cluster sizes and task
retries, and DuckDB reproduces it with ``row_number()``.

A plain ``row_number() OVER (PARTITION BY month ...)`` would sort a whole
month inside one task.  Instead the threshold is found from digest-prefix
histograms (map-side partially aggregated, one row per group x prefix), which
are reduced to one threshold row per group; only the rows sharing the final
boundary prefix (about ``rows / 16**(4 * levels)`` per group) are ranked by
a window, after identical copies have been collapsed to counts.  One level keeps the final window at about 1.5M rows for a group of
1e11 rows; ``levels=2`` is there for anything larger.  Every other row is decided by a broadcast join against the
per-group threshold table, whose size is the number of groups.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.constants import DEFAULT_SEED, FILE_MONTH, IGNORE_SPLIT, SAMPLE_ROWS_PER_MONTH, SPLIT_RULES
from farelane.functions.exprs import digest, digest_unit, file_mon, file_year

PREFIX_HEX = 4  # 65536 buckets per level


# ---------------------------------------------------------------- G1 / G2
def split_of(file_month: str | Column = FILE_MONTH, rules=SPLIT_RULES) -> Column:
    """Split name from the file's year and month (G1)."""
    y, m = file_year(file_month), file_mon(file_month)
    e = None
    for name, year, m_lo, m_hi in rules:
        cond = (y == year) & m.between(m_lo, m_hi)
        e = F.when(cond, name) if e is None else e.when(cond, name)
    return e.otherwise(IGNORE_SPLIT)


def assign_split(df: DataFrame, file_month: str = FILE_MONTH, out: str = "split") -> DataFrame:
    return df.withColumn(out, split_of(file_month))


def bucket_splits(df: DataFrame, file_month: str = FILE_MONTH) -> DataFrame:
    """Months per split with "ignore" dropped (G2): ``(split, months ARRAY<STRING>)``."""
    months = df.select(F.col(file_month)).distinct().withColumn("split", split_of(file_month))
    return (
        months.where(F.col("split") != IGNORE_SPLIT)
        .groupBy("split")
        .agg(F.array_sort(F.collect_list(file_month)).alias("months"))
    )


# ---------------------------------------------------------------- digest top-n
def _threshold(hist: DataFrame, groups: list[str], prefix: str, quota: Column) -> DataFrame:
    """First prefix whose running count reaches the quota, and what is left of the quota there.

    ``hist`` holds one row per (group, prefix); the window per group spans at
    most 16**PREFIX_HEX rows whatever the data size.
    """
    w = Window.partitionBy(*groups).orderBy(prefix).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.withColumn("_cum", F.sum("_n").over(w)).withColumn("_quota", quota)
    reached = F.col("_cum") >= F.col("_quota")
    entry = F.struct(F.col(prefix).alias("edge"), (F.col("_quota") - F.col("_cum") + F.col("_n")).alias("left"))
    # one row per group; NULL edge when the whole group fits in the quota
    return h.groupBy(*groups).agg(F.min(F.when(reached, entry)).alias("_t")).select(
        *groups, F.col("_t.edge").alias(f"{prefix}_edge"), F.col("_t.left").alias(f"{prefix}_left")
    )


def sample_top_n(
    df: DataFrame,
    quota: int | Column | Callable[[Column], Column],
    key: str,
    seed: int | Column = DEFAULT_SEED,
    groups: Sequence[str] = (FILE_MONTH,),
    levels: int = 1,
) -> DataFrame:
    """Per group, the ``quota`` rows with the smallest ``(digest(key, seed), key)``.

    ``quota`` is an int, a Column over the group columns, or a function of the
    group's row count (``Column -> Column``).  All rows are kept when the group
    has fewer.  ``key`` must be unique within a group.
    """
    groups = list(groups)
    d = digest(key, seed)
    base = df.withColumn("_d", d)
    prefixes = [F.substring("_d", 1 + i * PREFIX_HEX, PREFIX_HEX) for i in range(levels)]
    for i, p in enumerate(prefixes):
        base = base.withColumn(f"_p{i}", p)

    if callable(quota) and not isinstance(quota, Column):
        totals = base.groupBy(*groups).agg(F.count(F.lit(1)).alias("_total"))
        quota_tbl = totals.select(*groups, F.greatest(quota(F.col("_total")), F.lit(0)).cast("long").alias("_q0"))
        base = base.join(F.broadcast(quota_tbl), groups, "inner")
        quota_col = F.col("_q0")
    else:
        quota_col = (quota if isinstance(quota, Column) else F.lit(int(quota))).cast("long")
        base = base.withColumn("_q0", quota_col)
        quota_col = F.col("_q0")

    # level-by-level: rows strictly below the edge prefix are in, above are out
    cand = base
    keep_parts = []
    q = quota_col
    for i in range(levels):
        p = f"_p{i}"
        hist = cand.groupBy(*groups, p).agg(F.count(F.lit(1)).alias("_n"), F.max(q).alias("_qq"))
        t = _threshold(hist, groups, p, F.col("_qq"))
        # one row per group (NULL edge: the whole group is kept), so the
        # broadcast size is the number of groups
        j = cand.join(F.broadcast(t), groups, "inner")
        no_edge = F.col(f"{p}_edge").isNull()
        keep_parts.append(j.where(no_edge | (F.col(p) < F.col(f"{p}_edge"))).select(*base.columns))
        cand = j.where(F.col(p) == F.col(f"{p}_edge")).withColumn("_q0", F.col(f"{p}_left")).select(*base.columns)
        q = F.col("_q0")

    # Rows sharing the boundary prefix.  Identical copies of a row (same digest,
    # key and values) are collapsed to one row with a copy count first, so a
    # large group of copies is absorbed by map-side aggregation instead of
    # landing in one window task; the window then ranks distinct rows only
    # and the chosen number of copies is re-emitted.
    value_cols = [c for c in df.columns if c not in groups and c != key]
    distinct = cand.groupBy(*groups, "_d", key, *value_cols).agg(
        F.count(F.lit(1)).alias("_copies"), F.max("_q0").alias("_q0")
    )
    w = Window.partitionBy(*groups).orderBy("_d", key, F.xxhash64(*[F.col(c) for c in value_cols]) if value_cols else F.lit(0))
    before = F.coalesce(F.sum("_copies").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    take = F.least(F.col("_copies"), F.greatest(F.col("_q0") - before, F.lit(0)))
    ranked = (
        distinct.withColumn("_take", take)
        .where(F.col("_take") > 0)
        .select(*groups, key, *value_cols, F.explode(F.sequence(F.lit(1), F.col("_take").cast("int"))).alias("_copy"))
    )
    keep_parts = [k.select(*df.columns) for k in keep_parts]
    out = keep_parts[0]
    for part in keep_parts[1:] + [ranked.select(*df.columns)]:
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------- G3 / G4 / G5
ALL_ROWS = 1 << 60


def rows_of_split(sample_rows: Mapping[str, int | None], split: str) -> int | None:
    """Rows per month of a split, None for all rows; a split without a usable entry is an error."""
    n = sample_rows.get(split, 0)
    if n is None or n > 0:
        return n
    raise ValueError(f"rows per month of split {split!r} must be positive or None (all rows)")


def split_quota(sample_rows: Mapping[str, int | None], split_col: str = "split") -> Column:
    """Rows to keep per month of each row's split; splits without an entry keep none."""
    quota = F.lit(0).cast("long")
    for name in sample_rows:
        n = rows_of_split(sample_rows, name)
        quota = F.when(F.col(split_col) == name, F.lit(ALL_ROWS if n is None else int(n)).cast("long")).otherwise(quota)
    return quota


def sample_fixed_n(
    df: DataFrame,
    n: int,
    key: str = "trip_id",
    seed: int = DEFAULT_SEED,
    file_month: str = FILE_MONTH,
) -> DataFrame:
    """Exactly ``n`` rows per month (all rows if fewer), seeded, without replacement."""
    if not n or n <= 0:
        raise ValueError("n must be a positive integer")
    return sample_top_n(df, n, key, seed, (file_month,))


def build_splits(
    df: DataFrame,
    sample_rows: Mapping[str, int | None] = SAMPLE_ROWS_PER_MONTH,
    key: str = "trip_id",
    seed: int = DEFAULT_SEED,
    file_month: str = FILE_MONTH,
    levels: int = 1,
) -> DataFrame:
    """Union of the per-month samples of every split, with a ``split`` column (G4); None keeps all rows of a split."""
    for s in ("train", "val", "test"):
        rows_of_split(sample_rows, s)
    tagged = assign_split(df, file_month).where(F.col("split") != IGNORE_SPLIT)
    return sample_top_n(tagged, split_quota(sample_rows), key, seed, (file_month,), levels=levels)


def sample_capped(df: DataFrame, cap: int, key: str = "trip_id", seed: int = DEFAULT_SEED, file_month: str = FILE_MONTH) -> DataFrame:
    """At most ``cap`` rows per file for an audit."""
    return sample_fixed_n(df, cap, key, seed, file_month)


# ---------------------------------------------------------------- G6
def sample_fraction(
    df: DataFrame,
    frac: float,
    key: str = "trip_id",
    seed: int = DEFAULT_SEED,
    groups: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Fraction sample.

    ``exact``: ``round(frac * rows)`` rows per group, like ``DataFrame.sample(frac=)``
    in pandas.  Otherwise a digest-Bernoulli draw: each row independently with
    probability ``frac`` (no aggregation pass at all).
    """
    frac = min(float(frac), 1.0)
    if not exact:
        return df.where(digest_unit(key, seed) < F.lit(frac))
    groups = list(groups)
    if not groups:
        df = df.withColumn("_all", F.lit(1))
        out = sample_top_n(df, lambda total: F.round(total * F.lit(frac)), key, seed, ["_all"])
        return out.drop("_all")
    return sample_top_n(df, lambda total: F.round(total * F.lit(frac)), key, seed, groups)
