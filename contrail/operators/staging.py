"""Cleaned, typed and renamed inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import text, time


def stage_flights(raw: DataFrame) -> DataFrame:
    """Flights with all key fields and an arrival after the departure.

    The filter touches raw columns only, so it reaches the scan. The load stamp
    is passed on when the raw rows carry one.
    """
    usable = raw.filter(
        F.col("icao24").isNotNull() & F.col("firstSeen").isNotNull()
        & F.col("lastSeen").isNotNull() & (F.col("lastSeen") > F.col("firstSeen")))
    stamp = [F.col("loaded_at")] if "loaded_at" in raw.columns else []
    return usable.select(
        text.surrogate_key("icao24", "firstSeen", "estDepartureAirport").alias("flight_id"),
        text.clean_lower("icao24").alias("icao24"),
        time.from_epoch("firstSeen").alias("first_seen_at"),
        time.from_epoch("lastSeen").alias("last_seen_at"),
        text.clean_upper("estDepartureAirport").alias("origin_airport_id"),
        text.clean_upper("estArrivalAirport").alias("destination_airport_id"),
        text.clean_upper("callsign").alias("callsign"),
        F.col("estDepartureAirportHorizDistance").alias("departure_horiz_distance_m"),
        F.col("estDepartureAirportVertDistance").alias("departure_vert_distance_m"),
        F.col("estArrivalAirportHorizDistance").alias("arrival_horiz_distance_m"),
        F.col("estArrivalAirportVertDistance").alias("arrival_vert_distance_m"),
        F.col("departureAirportCandidatesCount").alias("departure_candidates_count"),
        F.col("arrivalAirportCandidatesCount").alias("arrival_candidates_count"),
        *stamp,
        F.col("source_date"))


def stage_airports(seed: DataFrame) -> DataFrame:
    return seed.filter(F.col("airport_id").isNotNull()).select(
        text.clean_upper("airport_id").alias("airport_id"),
        text.clean("airport_name").alias("airport_name"),
        text.clean("city").alias("city"),
        text.clean_upper("country_code").alias("country_code"),
        text.clean("country_name").alias("country_name"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        text.clean("timezone").alias("timezone"),
        text.clean("airport_type").alias("airport_type"))


def stage_ranges(seed: DataFrame) -> DataFrame:
    return seed.filter(F.col("range_start").isNotNull()).select(
        text.clean_lower("range_start").alias("range_start"),
        text.clean_lower("range_end").alias("range_end"),
        text.clean_upper("country_code").alias("country_code"),
        text.clean("country_name").alias("country_name"),
        text.clean("military_branch").alias("military_branch"),
        text.clean("notes").alias("notes"))
