"""Route-level aggregates: connections (edges of the network) and performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.functions import ladders, numeric
from contrail.operators import enrich

ROUTE_KEYS = (
    "origin_airport_id", "destination_airport_id",
    "origin_airport_name", "destination_airport_name",
    "origin_country", "destination_country",
)


def route_rollup(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Every measure of a route in one pass over the flights.

    Flights are grouped by the two ids alone; airports, and the distance that
    follows from them, are joined to the routes. ``flights`` need no airport
    columns; airport ids have to be unique.

    Both route models are projections of this aggregate: the optimizer drops
    the measures a model does not use and moves filters on the route keys below
    the aggregation. A pipeline stores it once and derives both models from it.
    The distinct counts are expanded and combined before the shuffle, so a
    route with a large part of all flights does not land in one task.
    """
    routed = flights.filter(F.col("origin_airport_id").isNotNull()
                            & F.col("destination_airport_id").isNotNull())
    duration = F.col("flight_duration_min")
    measured = routed.groupBy("origin_airport_id", "destination_airport_id").agg(
        F.count(F.lit(1)).alias("flight_count"),
        F.countDistinct("flight_date").alias("active_days"),
        F.countDistinct("icao24").alias("unique_aircraft"),
        F.avg(duration).alias("avg_duration_min"),
        F.min(duration).alias("min_duration_min"),
        F.max(duration).alias("max_duration_min"),
        F.stddev_samp(duration).alias("stddev_duration_min"),
        numeric.share_pct(F.col("is_weekend")).alias("weekend_pct"),
        numeric.count_if(F.col("is_military")).alias("military_flights"),
        F.min("flight_date").alias("first_flight_date"),
        F.max("flight_date").alias("last_flight_date"))
    return enrich.with_airports(measured, airports).withColumn(
        "avg_distance_km", enrich.flight_distance())


def connections_from_rollup(rollup: DataFrame) -> DataFrame:
    """Edges of the network: routes between two different airports."""
    edges = rollup.filter(F.col("origin_airport_id") != F.col("destination_airport_id"))
    return edges.select(
        *ROUTE_KEYS, "flight_count", "active_days", "avg_duration_min", "avg_distance_km",
        "military_flights",
        (F.col("flight_count") - F.col("military_flights")).alias("civilian_flights"),
        "first_flight_date", "last_flight_date",
        ladders.route_type(F.col("origin_country"), F.col("destination_country"))
        .alias("route_type"),
        ladders.ladder(F.col("flight_count"), ladders.FREQUENCY_STEPS, "LOW_FREQUENCY")
        .alias("frequency_category"))


def performance_from_rollup(rollup: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Performance of routes with enough flights, self-routes included."""
    flights = F.col("flight_count")
    busy = rollup.filter(flights >= settings.min_route_flights)
    rounded = busy.select(
        *ROUTE_KEYS,
        flights.alias("total_flights"), "active_days", "unique_aircraft",
        *[numeric.sql_round(F.col(c), 1).alias(c) for c in (
            "avg_duration_min", "min_duration_min", "max_duration_min",
            "stddev_duration_min", "avg_distance_km", "weekend_pct")],
        numeric.sql_round(F.col("military_flights") * F.lit(100.0) / flights, 1)
        .alias("military_pct"),
        F.col("first_flight_date").alias("first_flight"),
        F.col("last_flight_date").alias("last_flight"))
    total = F.col("total_flights")
    return rounded.select(
        "*",
        numeric.sql_round(numeric.ratio(total, F.col("active_days")), 2)
        .alias("flights_per_day"),
        numeric.sql_round(numeric.ratio(F.col("avg_duration_min"), F.col("avg_distance_km")), 4)
        .alias("min_per_km"),
        ladders.route_type(F.col("origin_country"), F.col("destination_country"))
        .alias("route_type"),
        ladders.ladder(total, ladders.ROUTE_TIER_STEPS, "TIER_4_RARE").alias("route_tier"))


def airport_connections(flights: DataFrame, airports: DataFrame) -> DataFrame:
    return connections_from_rollup(route_rollup(flights, airports))


def flight_performance(flights: DataFrame, airports: DataFrame,
                       settings: Settings = Settings()) -> DataFrame:
    return performance_from_rollup(route_rollup(flights, airports), settings)
