"""Holiday calendar (US federal + New York State) as a Spark dimension.

The calendar is generated from rules with column expressions (one row per
year, exploded into one row per holiday), so nothing is computed on the
driver.  Users may pass their own ``holiday_date`` table instead.

``calendar_flags`` turns any holiday table into a date-keyed table with the
three flags the trip features need, so the trip side needs one equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: holiday rules ----------------------------------------------
# (name, kind, month, day-or-weekday, nth, observed, first_year)
# kind "fixed": day of month; "nth": nth weekday (Mon=0) of the month;
# "last": last given weekday of the month; "after_first_monday": the day after
# the month's first Monday.  ``observed`` adds Friday for a Saturday date and
# Monday for a Sunday date.
FEDERAL_RULES = (
    ("New Year's Day", "fixed", 1, 1, 0, True, 1871),
    ("Martin Luther King Jr. Day", "nth", 1, 0, 3, False, 1986),
    ("Washington's Birthday", "nth", 2, 0, 3, False, 1971),
    ("Memorial Day", "last", 5, 0, 0, False, 1971),
    ("Juneteenth National Independence Day", "fixed", 6, 19, 0, True, 2021),
    ("Independence Day", "fixed", 7, 4, 0, True, 1871),
    ("Labor Day", "nth", 9, 0, 1, False, 1894),
    ("Columbus Day", "nth", 10, 0, 2, False, 1971),
    ("Veterans Day", "fixed", 11, 11, 0, True, 1978),
    ("Thanksgiving", "nth", 11, 3, 4, False, 1942),
    ("Christmas Day", "fixed", 12, 25, 0, True, 1871),
)
NEW_YORK_RULES = (
    ("Lincoln's Birthday", "fixed", 2, 12, 0, True, 1971),
    ("Susan B. Anthony Day", "fixed", 2, 15, 0, False, 2004),
    ("Election Day", "after_first_monday", 11, 0, 0, False, 2015),
)
STATE_RULES = {"NY": NEW_YORK_RULES}


def _rule_date(y: Column, kind: str, month: int, arg: int, nth: int) -> Column:
    first = F.make_date(y, F.lit(month), F.lit(1))
    if kind == "fixed":
        return F.make_date(y, F.lit(month), F.lit(arg))
    if kind == "nth":
        offset = (F.lit(arg) - F.weekday(first) + 7) % 7 + 7 * (nth - 1)
        return F.date_add(first, offset.cast("int"))
    if kind == "last":
        last = F.last_day(first)
        return F.date_sub(last, ((F.weekday(last) - F.lit(arg) + 7) % 7).cast("int"))
    if kind == "after_first_monday":
        offset = (F.lit(0) - F.weekday(first) + 7) % 7 + 1
        return F.date_add(first, offset.cast("int"))
    raise ValueError(f"unknown holiday rule kind {kind!r}")


def holiday_calendar(
    spark: SparkSession,
    first_year: int = 1990,
    last_year: int = 2060,
    state: str | None = "NY",
) -> DataFrame:
    """Rule-based ``(holiday_date DATE, holiday_name STRING)`` for a year range.

    Size is bounded by ``(last_year - first_year + 1) * len(rules) * 2`` rows,
    independent of the trip volume, so it is always safe to broadcast.
    """
    rules = list(FEDERAL_RULES) + list(STATE_RULES.get(state, ()) if state else ())
    y = F.col("year").cast("int")
    entries = []
    for name, kind, month, arg, nth, observed, since in rules:
        d = _rule_date(y, kind, month, arg, nth)
        ok = y >= F.lit(since)
        entries.append(F.struct(F.when(ok, d).alias("holiday_date"), F.lit(name).alias("holiday_name")))
        if observed:
            shifted = F.when(F.weekday(d) == 5, F.date_sub(d, 1)).when(F.weekday(d) == 6, F.date_add(d, 1))
            entries.append(
                F.struct(F.when(ok, shifted).alias("holiday_date"), F.lit(f"{name} (observed)").alias("holiday_name"))
            )
    years = spark.range(first_year, last_year + 1, numPartitions=1).withColumnRenamed("id", "year")
    return (
        years.select(F.explode(F.array(*entries)).alias("h"))
        .select("h.holiday_date", "h.holiday_name")
        .where(F.col("holiday_date").isNotNull())
    )


def calendar_flags(holidays: DataFrame, date_col: str = "holiday_date") -> DataFrame:
    """Date-keyed flags: ``is_holiday_date``, ``holiday_in_3_days``, ``holiday_3_days_ago``.

    The reference builds its holiday set only for the years present in a
    monthly file, and after the month filter a file holds a single year; so a
    holiday three days away counts only when it falls in the same year.
    """
    h = holidays.select(F.col(date_col).cast("date").alias("h")).where(F.col("h").isNotNull()).distinct()
    before = F.date_sub(F.col("h"), 3)
    after = F.date_add(F.col("h"), 3)
    entries = F.array(
        F.struct(F.col("h").alias("cal_date"), F.lit(1).alias("hol"), F.lit(0).alias("fwd"), F.lit(0).alias("back")),
        F.struct(
            before.alias("cal_date"),
            F.lit(0).alias("hol"),
            F.when(F.year(before) == F.year("h"), 1).otherwise(0).alias("fwd"),
            F.lit(0).alias("back"),
        ),
        F.struct(
            after.alias("cal_date"),
            F.lit(0).alias("hol"),
            F.lit(0).alias("fwd"),
            F.when(F.year(after) == F.year("h"), 1).otherwise(0).alias("back"),
        ),
    )
    return (
        h.select(F.explode(entries).alias("e"))
        .groupBy(F.col("e.cal_date").alias("cal_date"))
        .agg(
            F.max("e.hol").alias("is_holiday_date"),
            F.max("e.fwd").alias("holiday_in_3_days"),
            F.max("e.back").alias("holiday_3_days_ago"),
        )
    )
