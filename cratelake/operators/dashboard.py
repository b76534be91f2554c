"""Dashboard cards and series. Days, years and flags are the caller's arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kpi_cards(df: DataFrame, flagged: Column, key: str = "crate_id") -> DataFrame:
    """Distinct crates, requests, and requests the predicate holds for, in one pass."""
    return df.agg(
        F.count_distinct(key).alias("total_crates"),
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(flagged).alias("total_flagged"),
    )


def _rows(weight: str | None, flag: Column | None = None) -> Column:
    """How many rows there are, or those ``flag`` holds for; ``weight`` is the column that counts them already."""
    if weight is None:
        return F.count(F.lit(1)) if flag is None else F.count_if(flag)
    counted = F.col(weight) if flag is None else F.when(flag, F.col(weight))
    return F.coalesce(F.sum(counted), F.lit(0))


def kpi_cards_of(counts: DataFrame, crates: DataFrame, flagged: Column, weight: str = "n") -> DataFrame:
    """``kpi_cards`` from counted rows, and the one row of distinct crates that a rollup keeps."""
    totals = counts.agg(_rows(weight).alias("total_requests"), _rows(weight, flagged).alias("total_flagged"))
    return totals.select(F.lit(crates.first()["total_crates"]).alias("total_crates"), "total_requests", "total_flagged")


def _days(df: DataFrame, end: dt.date, days: int) -> DataFrame:
    """One row per day of the report, none missing."""
    first = F.lit(end - dt.timedelta(days=days - 1))
    return df.sparkSession.range(1).select(F.explode(F.sequence(first, F.lit(end))).alias("day"))


def _between(day: Column, end: dt.date, days: int) -> Column:
    return day.between(F.lit(end - dt.timedelta(days=days - 1)), F.lit(end))


def daily_series(
    df: DataFrame, day: Column, end: dt.date, days: int, weight: str | None = None, **counts: Column | None
) -> DataFrame:
    """Counts per day for ``days`` days up to ``end``, zeros included.

    Each keyword names a series and gives its predicate; None counts every row. The report
    has ``days`` rows, so the broadcast of the aggregate is bounded by its length. Rows of a rollup
    are counted by its column ``weight``, here and in the series below.
    """
    series = {name: _rows(weight, flag) for name, flag in counts.items()}
    counted = (
        df.where(_between(day, end, days))
        .groupBy(day.alias("day"))
        .agg(*[agg.alias(name) for name, agg in series.items()])
    )
    return _days(df, end, days).join(F.broadcast(counted), "day", "left").select(
        "day", *[F.coalesce(name, F.lit(0)).alias(name) for name in series]
    )


def requests_per_day(
    df: DataFrame, day: Column, end: dt.date, days: int = 7, weight: str | None = None
) -> DataFrame:
    return daily_series(df, day, end, days, weight, n=None)


def requested_vs_flagged(
    df: DataFrame, day: Column, end: dt.date, flagged: Column, days: int = 7, weight: str | None = None
) -> DataFrame:
    return daily_series(df, day, end, days, weight, requested=None, flagged=flagged)


def fulfilled_by_month(
    df: DataFrame, day: Column, year: int, fulfilled: Column, weight: str | None = None
) -> DataFrame:
    """Fulfilled requests per month of ``year``; twelve rows."""
    in_year = day.between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))
    counted = (
        df.where(in_year & fulfilled)
        .groupBy(F.month(day).alias("month"))
        .agg(_rows(weight).alias("n"))
    )
    months = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    )
    return months.join(F.broadcast(counted), "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).alias("n")
    )


def series_max(series: DataFrame, value: str = "n") -> DataFrame:
    """Top of the chart axis."""
    return series.agg(F.max(value).alias("series_max"))


def category_share(df: DataFrame, category: str, weight: str | None = None) -> DataFrame:
    """Rows per category and their share of all rows."""
    counts = df.groupBy(category).agg(_rows(weight).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())
