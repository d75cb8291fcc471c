"""The daily refresh: layers in order, then checks, then the alert digest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from contrail.config import Settings
from contrail.operators import (activity, anomaly, enrich, graph, network, quality, routes,
                                serving, staging)
from contrail.session import cut_lineage
from contrail.sources import tables


@dataclass(frozen=True)
class Models:
    """Lazily composed models; nothing is computed until one of them is read."""

    stg_flights: DataFrame
    stg_airports: DataFrame
    stg_ranges: DataFrame
    flights_classified: DataFrame
    flights_enriched: DataFrame
    military_flights: DataFrame


@dataclass(frozen=True)
class RunResult:
    tables: dict[str, DataFrame]
    checks: DataFrame
    alerts: DataFrame


def flight_models(raw: DataFrame, airport_seed: DataFrame, range_seed: DataFrame,
                  watch: quality.Watch | None = None) -> Models:
    """The view layers from raw flights to military flights.

    With ``watch`` staged flights and airports are written once and checked while they are;
    all that follows reads them from there, airports with a known size.
    """
    flights = staging.stage_flights(raw)
    airports = staging.stage_airports(airport_seed)
    if watch:
        flights = cut_lineage(watch.add("stg_flights", flights))
        airports = cut_lineage(watch.add("stg_airports", airports))
    ranges = staging.stage_ranges(range_seed)
    classified = enrich.classify_flights(flights, ranges)
    enriched = enrich.enrich_flights(classified, airports)
    return Models(flights, airports, ranges, classified, enriched,
                  enrich.military_flights(enriched))


def build_tables(models: Models, settings: Settings = Settings(),
                 watch: quality.Watch | None = None) -> dict[str, DataFrame]:
    """All models by name.

    The route measures and the daily counts are small next to the flights and are written;
    every mart is derived from them. Enriched flights are not: either aggregate needs few
    of their columns, which are cheaper made from staged flights than written and read. Their
    checks are counted while the route measures are made.
    """
    enriched = models.flights_enriched
    without_places = (watch.add("flights_enriched", enriched) if watch else enriched).drop(
        *(f"{end}_{c}" for end in ("origin", "destination")
          for c in ("airport_name", "city", "country", "lat", "lon")))
    rollup = cut_lineage(routes.route_rollup(without_places, models.stg_airports))
    daily = cut_lineage(activity.daily_military_counts(models.military_flights, settings))
    connections = routes.connections_from_rollup(rollup)
    military_activity = activity.military_activity(daily, settings)
    return {
        "stg_flights": models.stg_flights,
        "stg_airports": models.stg_airports,
        "stg_ranges": models.stg_ranges,
        "flights_enriched": enriched,
        "military_flights": models.military_flights,
        "airport_connections": connections,
        "daily_military_counts": daily,
        "flight_performance": routes.performance_from_rollup(rollup, settings),
        "airport_network": network.airport_network(connections, models.stg_airports),
        "military_activity": military_activity,
        "anomaly_flags": activity.anomaly_flags(military_activity, settings),
        "anomaly_scores": anomaly.anomaly_scores(daily),
        "airport_graph": graph.airport_graph(connections, settings),
    }


VIEWS = ("stg_flights", "stg_airports", "stg_ranges", "flights_enriched", "military_flights",
         "airport_connections", "daily_military_counts")
MARTS = ("flight_performance", "airport_network", "military_activity", "anomaly_flags",
         "anomaly_scores", "airport_graph")


def run_pipeline(spark: SparkSession, raw: DataFrame, airport_seed: DataFrame,
                 range_seed: DataFrame, settings: Settings = Settings()) -> RunResult:
    """Publish the views, refresh the marts, check everything, collect the alerts."""
    watch = quality.Watch()
    built = build_tables(flight_models(raw, airport_seed, range_seed, watch), settings, watch)
    for name in VIEWS:
        tables.publish_view(built[name], name)
    tables.create_schema(spark, settings.marts_schema)
    for name in MARTS:
        built[name] = tables.overwrite_table(
            watch.add(name, built[name]), tables.table_name(settings.marts_schema, name))
    checks = cut_lineage(watch.report(built))
    return RunResult(built, checks, serving.alert_digest(built["anomaly_scores"]))
