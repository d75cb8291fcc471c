"""Anomaly scores against the history of the same country and weekday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions import ladders, numeric

BASELINE_KEYS = ("country_code", "day_of_week")


def baseline(daily: DataFrame, keys: tuple[str, ...] = BASELINE_KEYS,
             value: str = "military_flight_count") -> DataFrame:
    """Mean, sample deviation, exact median and size of each group."""
    return daily.groupBy(*keys).agg(
        F.avg(value).alias("baseline_mean"),
        F.stddev_samp(value).alias("baseline_std"),
        F.median(value).alias("baseline_median"),
        F.count(value).alias("sample_count"))


def with_baseline(daily: DataFrame, keys: tuple[str, ...] = BASELINE_KEYS,
                  value: str = "military_flight_count") -> DataFrame:
    """Group statistics next to every row, by a window instead of a join back."""
    group = Window.partitionBy(*keys)
    return daily.select(
        "*",
        F.avg(value).over(group).alias("baseline_mean"),
        F.stddev_samp(value).over(group).alias("baseline_std"),
        F.median(value).over(group).alias("baseline_median"),
        F.count(value).over(group).alias("sample_count"))


def average_rank_pct(value: Column | str, partition: str) -> Column:
    """Average rank of equal values, divided by the partition size.

    Neither ``percent_rank`` nor ``cume_dist`` computes this.
    """
    ordered = Window.partitionBy(partition).orderBy(value)
    peers = ordered.rangeBetween(Window.currentRow, Window.currentRow)
    everyone = Window.partitionBy(partition)
    average = F.rank().over(ordered) + (F.count(F.lit(1)).over(peers) - 1) / F.lit(2.0)
    return average / F.count(F.lit(1)).over(everyone)


def add_percentile_rank(daily: DataFrame) -> DataFrame:
    return daily.select("*", average_rank_pct("military_flight_count", "country_code")
                        .alias("percentile_rank"))


def anomaly_scores(daily: DataFrame) -> DataFrame:
    """Levels come from the unrounded score; its bins are closed on the right."""
    flights = F.col("military_flight_count")
    scored = add_percentile_rank(with_baseline(daily)).withColumn(
        "z_score", numeric.zscore(flights, F.col("baseline_mean"), F.col("baseline_std")))
    return scored.select(
        "date_id", "country_code", "day_of_week", "military_flight_count",
        "unique_aircraft_count",
        numeric.even_round(F.col("baseline_mean"), 2).alias("baseline_mean"),
        numeric.even_round(F.col("baseline_std"), 2).alias("baseline_std"),
        F.col("baseline_median").cast("double").alias("baseline_median"),
        "sample_count",
        numeric.even_round(F.col("z_score"), 4).alias("z_score"),
        ladders.right_closed_bins(F.col("z_score"), ladders.ANOMALY_EDGES,
                                  ladders.ANOMALY_LEVELS).alias("anomaly_level"),
        numeric.even_round(F.col("percentile_rank"), 4).alias("percentile_rank"))
