"""Degrees, volumes and hub classes of airports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import ladders, numeric


def degree_metrics(connections: DataFrame) -> DataFrame:
    """Neighbours, flights and countries per airport in both directions.

    Each side is aggregated by airport and the two aggregates are joined on it;
    the join reuses the partitioning of the aggregates.
    """
    outbound = connections.groupBy(F.col("origin_airport_id").alias("airport_id")).agg(
        F.countDistinct("destination_airport_id").alias("out_degree"),
        F.sum("flight_count").alias("outbound_flights"),
        F.countDistinct("destination_country").alias("outbound_countries"))
    inbound = connections.groupBy(F.col("destination_airport_id").alias("airport_id")).agg(
        F.countDistinct("origin_airport_id").alias("in_degree"),
        F.sum("flight_count").alias("inbound_flights"),
        F.countDistinct("origin_country").alias("inbound_countries"))

    def filled(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    # the named-column join merges the two keys into one
    both = outbound.join(inbound, "airport_id", "full_outer")
    return both.select(
        "airport_id",
        filled("out_degree").alias("out_degree"),
        filled("in_degree").alias("in_degree"),
        (filled("out_degree") + filled("in_degree")).alias("total_degree"),
        filled("outbound_flights").alias("outbound_flights"),
        filled("inbound_flights").alias("inbound_flights"),
        (filled("outbound_flights") + filled("inbound_flights")).alias("total_flights"),
        filled("outbound_countries").alias("outbound_countries"),
        filled("inbound_countries").alias("inbound_countries"))


def airport_network(connections: DataFrame, airports: DataFrame) -> DataFrame:
    degrees = degree_metrics(connections)
    total = F.col("total_flights")
    place = airports.select("airport_id", "airport_name", "city", "country_code",
                            "latitude", "longitude")
    return degrees.join(place, "airport_id", "left").select(
        "airport_id", "airport_name", "city", "country_code", "latitude", "longitude",
        "out_degree", "in_degree", "total_degree",
        "outbound_flights", "inbound_flights", "total_flights",
        "outbound_countries", "inbound_countries",
        ladders.ladder(F.col("total_degree"), ladders.HUB_STEPS, "MINOR_AIRPORT")
        .alias("hub_category"),
        F.when(total > 0, numeric.sql_round(
            numeric.ratio(F.col("outbound_flights") - F.col("inbound_flights"), total), 3))
        .otherwise(F.lit(0.0)).alias("flow_asymmetry"))
