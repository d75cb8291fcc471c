"""Refresh of the daily marts for the days that a delivery touches.

A delivery changes the counts of its own days. Rolling statistics and changes look
back over rows of a country, so they change on those days and on the rows whose frame
reaches back to one of them. Marts are partitioned by month; only months with such a
day are written again, and a month that has no rows any more loses its partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.operators import activity
from contrail.session import cut_lineage, discard
from contrail.sources import tables

# rows that add_changes looks back
CHANGE_ROWS = 7


def month_of(day: Column | str) -> Column:
    return F.trunc(day, "month")


def touched_days(delivered: DataFrame) -> list[dt.date]:
    """Flight dates of delivered raw rows: the days whose counts change."""
    days = delivered.select(F.timestamp_seconds("firstSeen").cast("date").alias("d")).where("d is not null").distinct()
    return sorted(r.d for r in days.toLocalIterator())


def raw_of_months(raw: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Raw flights of the months of ``days``, whenever they were delivered; bounds reach the scan."""
    if not days:
        return raw.limit(0)
    last = max(days)
    ends = min(days).replace(day=1), (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    start, end = (int(dt.datetime(d.year, d.month, 1, tzinfo=dt.timezone.utc).timestamp()) for d in ends)
    return (raw.where((F.col("firstSeen") >= start) & (F.col("firstSeen") < end))
            .where(month_of(F.timestamp_seconds("firstSeen")).isin(_months(days))))


def _months(days: Sequence[dt.date]) -> list[dt.date]:
    return sorted({d.replace(day=1) for d in days})


def rolling_mart(daily: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rolling statistics and changes per date and country."""
    return activity.add_changes(activity.add_rolling(daily, settings)).select(
        "country_code", "military_flight_count", "rolling_7d_avg", "rolling_30d_avg", "rolling_30d_std",
        "day_over_day_change", "week_over_week_change", "date_id")


def rolling_days(daily: DataFrame, days: Sequence[dt.date], settings: Settings = Settings()) -> list[dt.date]:
    """``days`` and the dates of rows whose frame reaches back to one of them."""
    back = max(settings.baseline_window_rows, settings.smoothing_window_rows, CHANGE_ROWS + 1) - 1
    first = F.lag("date_id", back).over(Window.partitionBy("country_code").orderBy("date_id"))
    reached = F.exists(_dates(days), lambda d: (d <= F.col("date_id")) & (F.col("_first").isNull() | (d >= F.col("_first"))))
    found = daily.select("date_id", first.alias("_first")).where(reached).select("date_id").distinct()
    return sorted({*days, *(r.date_id for r in found.toLocalIterator())})


def _dates(days: Sequence[dt.date]) -> Column:
    return F.array(*(F.lit(d) for d in days)) if days else F.array().cast("array<date>")


def build_marts(daily: DataFrame, daily_table: str, rolling_table: str, settings: Settings = Settings()) -> None:
    """Both marts from the counts of all days, one partition per month."""
    stored = _by_month(daily, daily_table)
    _by_month(rolling_mart(stored.drop("month_id"), settings), rolling_table)


def _by_month(rows: DataFrame, table: str) -> DataFrame:
    dated = rows.withColumn("month_id", month_of("date_id"))
    return tables.overwrite_table(dated.hint("rebalance", "month_id"), table, "month_id")


def refresh_marts(spark: SparkSession, fresh: DataFrame, days: Sequence[dt.date], daily_table: str, rolling_table: str,
                  settings: Settings = Settings()) -> list[dt.date]:
    """Bring both marts up to date; returns the months of the rolling mart written again.

    ``fresh`` are the counts of the months of ``days``, over all their flights.
    """
    _replace_months(fresh, daily_table, _months(days))
    daily = spark.table(daily_table).drop("month_id")
    months = _months(rolling_days(daily, days, settings))
    _replace_months(rolling_mart(daily, settings), rolling_table, months)
    return months


def _replace_months(rows: DataFrame, table: str, months: Sequence[dt.date]) -> None:
    """Write the partitions of ``months`` anew; those without rows are dropped."""
    spark = rows.sparkSession
    stored = spark.table(table)
    dated = rows.withColumn("month_id", month_of("date_id")).where(F.col("month_id").isin(list(months)))
    # written first: the rows may be read from the table itself
    ready = cut_lineage(dated.select(*stored.columns))
    held = {r.month_id for r in ready.select("month_id").distinct().toLocalIterator()}
    if held:
        tables.replace_partitions(ready, table, stored.schema, "month_id")
    for month in months:
        if month not in held:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (month_id = DATE '{month}')")
    spark.catalog.refreshTable(table)
    discard(ready)
