"""Column-expression helpers.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them triggers an action.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.constants import EARTH_RADIUS_KM


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_between(c: str | Column, lo, hi) -> Column:
    """``c IS NULL OR lo <= c <= hi``: pandas masks let missing values pass."""
    c = col_of(c)
    return c.isNull() | c.between(lo, hi)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int where a NULL condition counts as false (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def not_in(c: str | Column, values) -> Column:
    """``NOT c IN (...)`` where a NULL ``c`` is kept (pandas ``~isin``)."""
    return ~F.coalesce(col_of(c).isin(list(values)), F.lit(False))


def nan_to_null(c: str | Column) -> Column:
    """NaN created inside Spark sorts above every number; treat it as missing."""
    c = col_of(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def nan_as_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with NaN turned to NULL in those of ``cols`` that hold floating-point numbers."""
    return df.withColumns({f.name: nan_to_null(f.name).cast(f.dataType) for f in df.schema.fields if f.name in cols and isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def is_finite(c: str | Column) -> Column:
    c = col_of(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def lenient_double(c: str | Column) -> Column:
    """``errors="coerce"`` numeric cast: bad values become NULL, NaN becomes NULL."""
    return nan_to_null(col_of(c).try_cast("double"))


def lenient_timestamp(df_type: T.DataType, c: str | Column) -> Column:
    """``errors="coerce"`` timestamp cast; timestamps already typed pass unchanged."""
    c = col_of(c)
    if isinstance(df_type, T.TimestampNTZType):
        return c
    if isinstance(df_type, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return c.try_cast("timestamp_ntz")


def month_start_ntz(file_month: str | Column) -> Column:
    """First instant of a 'YYYY-MM' month as TIMESTAMP_NTZ."""
    fm = col_of(file_month)
    return F.make_timestamp_ntz(
        F.substring(fm, 1, 4).cast("int"),
        F.substring(fm, 6, 2).cast("int"),
        F.lit(1),
        F.lit(0),
        F.lit(0),
        F.lit(0),
    )


def file_year(file_month: str | Column = "file_month") -> Column:
    return F.substring(col_of(file_month), 1, 4).cast("int")


def file_mon(file_month: str | Column = "file_month") -> Column:
    return F.substring(col_of(file_month), 6, 2).cast("int")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in fractional minutes, keeping sub-second precision."""
    return F.timestamp_diff("MICROSECOND", col_of(start), col_of(end)) / F.lit(60_000_000.0)


def cyclic(c: str | Column, period: float, shift: float = 0.0) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*(c - shift)/period``."""
    angle = F.lit(2.0 * math.pi) * (col_of(c) - F.lit(shift)) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def haversine_km(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km; NULL if any coordinate is NULL."""
    rl1, rp1, rl2, rp2 = (F.radians(col_of(x)) for x in (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin((rp2 - rp1) / 2.0), 2) + F.cos(rp1) * F.cos(rp2) * F.pow(F.sin((rl2 - rl1) / 2.0), 2)
    # rounding can push ``a`` a hair above 1; asin would then return NaN
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def digest(key: str | Column, seed: int | Column) -> Column:
    """Deterministic, partition-independent hex digest of (key, seed)."""
    seed_c = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", col_of(key).cast("string"), seed_c.cast("string")))


def digest_unit(key: str | Column, seed: int | Column) -> Column:
    """Digest mapped to [0, 1) from its first 8 hex digits."""
    return F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
