"""Flights with airports, distance, military range and date parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import geo, ladders, time
from contrail.operators import ranges as rng


def with_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Airport columns for both ends of a flight, null where an id is unknown.

    Plain equi joins without a hint: the airport table is broadcast as long as
    its size is below the session's threshold, else both sides are shuffled and
    adaptive execution splits a busy airport.
    """
    def role(prefix: str) -> DataFrame:
        return airports.select(
            F.col("airport_id").alias(f"_{prefix}_id"),
            F.col("airport_name").alias(f"{prefix}_airport_name"),
            F.col("city").alias(f"{prefix}_city"),
            F.col("country_code").alias(f"{prefix}_country"),
            F.col("latitude").alias(f"{prefix}_lat"),
            F.col("longitude").alias(f"{prefix}_lon"))

    out = flights
    for prefix in ("origin", "destination"):
        out = out.join(
            role(prefix), F.col(f"{prefix}_airport_id") == F.col(f"_{prefix}_id"), "left"
        ).drop(f"_{prefix}_id")
    return out


def flight_distance() -> Column:
    return geo.haversine(F.col("origin_lat"), F.col("origin_lon"),
                         F.col("destination_lat"), F.col("destination_lon"))


def classify_flights(flights: DataFrame, ranges: DataFrame) -> DataFrame:
    """Staged flights with their military range, duration and date parts: all that
    does not depend on the airports."""
    military = ranges.select("range_start", "range_end",
                             F.col("country_code").alias("military_country"),
                             "military_branch")
    seen = F.col("first_seen_at")
    return rng.range_classify(flights, military).withColumns({
        "flight_date": seen.cast("date"),
        "flight_duration_min": time.minutes_between("first_seen_at", "last_seen_at"),
        "is_military": F.col("military_country").isNotNull(),
        "flight_year": time.year_of(seen),
        "flight_month": time.month_of(seen),
        "day_of_week": time.weekday(seen),
        "is_weekend": time.is_weekend(seen)})


def enrich_flights(classified: DataFrame, airports: DataFrame) -> DataFrame:
    """Classified flights joined with staged airports."""
    return with_airports(classified, airports).select(
        "flight_id", "icao24", "callsign", "first_seen_at", "last_seen_at",
        "flight_date", "flight_duration_min",
        "origin_airport_id", "origin_airport_name", "origin_city", "origin_country",
        "origin_lat", "origin_lon",
        "destination_airport_id", "destination_airport_name", "destination_city",
        "destination_country", "destination_lat", "destination_lon",
        flight_distance().alias("distance_km"),
        "is_military", "military_country", "military_branch",
        "flight_year", "flight_month", "day_of_week", "is_weekend", "source_date")


def military_flights(enriched: DataFrame) -> DataFrame:
    """Military rows with a callsign and a distance class."""
    return enriched.filter(F.col("is_military")).select(
        "*",
        ladders.classify_prefix(F.col("callsign")).alias("military_category"),
        ladders.range_category(F.col("distance_km")).alias("range_category"))
