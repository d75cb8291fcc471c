"""Daily military activity per country, rolling statistics and anomaly flags.

The daily counts are the only step that sees flights. Everything after it works
on one row per country and day, so a window partition (a country) is bounded by
the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.functions import ladders, numeric, time

# Categories counted per day, in output order.
CATEGORIES = ("TRANSPORT", "FIGHTER", "TRAINING", "TANKER", "SURVEILLANCE", "UNKNOWN")


def daily_military_counts(military: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counts per date and country, thin days left out."""
    daily = (
        military.filter(F.col("military_country").isNotNull())
        .groupBy(F.col("flight_date").alias("date_id"),
                 F.col("military_country").alias("country_code"))
        .agg(
            F.count(F.lit(1)).alias("military_flight_count"),
            F.countDistinct("icao24").alias("unique_aircraft_count"),
            *[numeric.count_if(F.col("military_category") == c).alias(f"{c.lower()}_flights")
              for c in CATEGORIES],
            F.avg("distance_km").alias("avg_distance_km"),
            F.max("distance_km").alias("max_distance_km"),
            F.countDistinct("origin_airport_id").alias("unique_origins"),
            F.countDistinct("destination_airport_id").alias("unique_destinations"))
        .filter(F.col("military_flight_count") >= settings.min_flights_threshold))
    # the weekday follows from the date and need not be a grouping key
    return daily.select(
        "date_id", time.weekday("date_id").alias("day_of_week"), "country_code",
        *[c for c in daily.columns if c not in ("date_id", "country_code")])


def add_rolling(daily: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rolling mean and deviation over rows (days present), not calendar days."""
    flights = F.col("military_flight_count")
    ordered = Window.partitionBy("country_code").orderBy("date_id")
    short = ordered.rowsBetween(1 - settings.smoothing_window_rows, Window.currentRow)
    long = ordered.rowsBetween(1 - settings.baseline_window_rows, Window.currentRow)
    return daily.select(
        "*",
        F.avg(flights).over(short).alias("rolling_7d_avg"),
        F.avg(flights).over(long).alias("rolling_30d_avg"),
        F.stddev_samp(flights).over(long).alias("rolling_30d_std"))


def add_calendar_rolling(daily: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rolling mean and deviation over calendar days: days that are missing take their place.

    ``*_days`` counts the days present in each frame.
    """
    flights = F.col("military_flight_count")
    ordered = Window.partitionBy("country_code").orderBy(F.unix_date("date_id"))
    short = ordered.rangeBetween(1 - settings.smoothing_window_rows, Window.currentRow)
    long = ordered.rangeBetween(1 - settings.baseline_window_rows, Window.currentRow)
    return daily.select(
        "*",
        F.avg(flights).over(short).alias("calendar_7d_avg"),
        F.count(flights).over(short).alias("calendar_7d_days"),
        F.avg(flights).over(long).alias("calendar_30d_avg"),
        F.stddev_samp(flights).over(long).alias("calendar_30d_std"),
        F.count(flights).over(long).alias("calendar_30d_days"))


def add_changes(daily: DataFrame) -> DataFrame:
    """Difference to the previous row and to the row seven places back."""
    flights = F.col("military_flight_count")
    ordered = Window.partitionBy("country_code").orderBy("date_id")
    return daily.select(
        "*",
        (flights - F.lag(flights).over(ordered)).alias("day_over_day_change"),
        (flights - F.lag(flights, 7).over(ordered)).alias("week_over_week_change"))


def add_activity_rank(daily: DataFrame) -> DataFrame:
    """Busiest day first; equal days in date order."""
    busiest = Window.partitionBy("country_code").orderBy(
        F.col("military_flight_count").desc(), F.col("date_id"))
    return daily.select("*", F.row_number().over(busiest).cast("bigint")
                        .alias("activity_rank_desc"))


def military_activity(daily: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All statistics share one shuffle by country."""
    flights = F.col("military_flight_count")
    mean, std = F.col("rolling_30d_avg"), F.col("rolling_30d_std")
    stats = add_activity_rank(add_changes(add_rolling(daily, settings)))
    return stats.select(
        "date_id", "country_code", "day_of_week", "military_flight_count",
        "unique_aircraft_count", "transport_flights", "fighter_flights", "training_flights",
        "tanker_flights", "surveillance_flights",
        numeric.sql_round(F.col("rolling_7d_avg"), 1).alias("rolling_7d_avg"),
        numeric.sql_round(mean, 1).alias("rolling_30d_avg"),
        numeric.sql_round(std, 2).alias("rolling_30d_std"),
        numeric.sql_round(numeric.zscore(flights, mean, std), 2).alias("simple_z_score"),
        "day_over_day_change", "week_over_week_change",
        numeric.sql_round(numeric.ratio(flights - mean, mean) * 100, 1)
        .alias("pct_above_baseline"),
        "avg_distance_km", "max_distance_km", "unique_origins", "unique_destinations",
        "activity_rank_desc")


def anomaly_flags(activity: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Days from ELEVATED on, by the rounded rolling z-score (bounds included)."""
    z = F.col("simple_z_score")
    lowest = ladders.ANOMALY_STEPS[-1][0]
    return activity.filter(z >= lowest).select(
        "*",
        ladders.ladder(z, ladders.ANOMALY_STEPS, ladders.ANOMALY_LEVELS[0])
        .alias("anomaly_level"),
        (z >= settings.anomaly_zscore_threshold).alias("is_anomaly"),
        ladders.anomaly_context(F.col("fighter_flights"), F.col("transport_flights"),
                                F.col("surveillance_flights"), F.col("rolling_7d_avg"))
        .alias("anomaly_context"))
