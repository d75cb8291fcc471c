"""Ready-made result sets for maps, rankings, series and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import numeric, text

ALERT_LEVELS = ("CRITICAL", "HIGH")
EVENT_LEVELS = ("ELEVATED", "HIGH", "CRITICAL")
HUB_METRICS = ("pagerank_score", "total_degree", "betweenness_centrality")
ROUTE_METRICS = ("total_flights", "avg_distance_km", "avg_duration_min")


def top_k(df: DataFrame, metric: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the highest metric; equal values in the order of ``ties``."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(t) for t in ties]).limit(k)


def top_row(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    return top_k(df, metric, 1, *ties)


def ordered_network(network: DataFrame) -> DataFrame:
    return network.orderBy(F.col("total_flights").desc(), "airport_id")


def ordered_flags(flags: DataFrame) -> DataFrame:
    return flags.orderBy(F.col("date_id").desc(), F.col("simple_z_score").desc(),
                         "country_code")


def ordered_scores(scores: DataFrame) -> DataFrame:
    return scores.orderBy("date_id", F.col("z_score").desc(), "country_code")


# --- network map ---------------------------------------------------------

def located_airports(graph: DataFrame, airports: DataFrame) -> DataFrame:
    """Graph metrics with place names; airports without coordinates are left out.

    A table that has coordinates already keeps its own.
    """
    if {"latitude", "longitude"} <= set(graph.columns):
        return graph.dropna(subset=["latitude", "longitude"])
    place = airports.select("airport_id", "airport_name", "country_code", "latitude",
                            "longitude")
    return graph.join(place, "airport_id", "left").dropna(subset=["latitude", "longitude"])


def marker_size(metric: Column, low: Column, high: Column) -> Column:
    """50 to 850 by position between the extremes, 200 when all are equal."""
    return (F.when(high > low, (metric - low) / (high - low) * 800 + 50)
            .otherwise(F.lit(200.0)))


def network_map(graph: DataFrame, airports: DataFrame, countries: Sequence[str] | None = None,
                metric: str = "pagerank_score") -> DataFrame:
    """Map points with marker sizes, scaled over all airports before any country filter."""
    points = located_airports(graph, airports)
    low = points.agg(F.min(metric)).scalar()
    high = points.agg(F.max(metric)).scalar()
    sized = points.withColumn("marker_size", marker_size(F.col(metric), low, high))
    if countries:
        sized = sized.filter(F.col("country_code").isin(*countries))
    return sized.select("airport_id", "airport_name", "country_code", "latitude", "longitude",
                        "hub_rank", metric, "betweenness_centrality", "marker_size")


# Metrics that a marker's size can follow, and the columns of the ranking.
MARKER_METRICS = ("pagerank_score", "total_degree")
RANKING_COLUMNS = ("hub_rank", "airport_id", "airport_name", "country_code", "pagerank_score",
                   "total_degree", "betweenness_centrality")


def marker_metric(points: DataFrame) -> str | None:
    """The metric that a table of airports offers, if any."""
    return next((m for m in MARKER_METRICS if m in points.columns), None)


def airport_map(table: DataFrame, airports: DataFrame, countries: Sequence[str] | None = None) -> DataFrame:
    """Map points of whichever airport table is there: graph metrics, network mart or seed.

    The columns of the ranking that it has, coordinates and marker sizes; those are
    scaled over all airports before any country filter, and equal without a metric.
    """
    points = located_airports(table, airports)
    metric = marker_metric(points)
    size = F.lit(200.0)
    if metric:
        # one row of extremes meets all points
        low, high = points.agg(F.min(metric), F.max(metric)).first()
        size = marker_size(F.col(metric), F.lit(low), F.lit(high)) if low is not None else size
    shown = [c for c in RANKING_COLUMNS if c in points.columns]
    sized = points.select(*shown, "latitude", "longitude", size.alias("marker_size"))
    return sized.filter(F.col("country_code").isin(*countries)) if countries else sized


def map_ranking(points: DataFrame, k: int = 15) -> DataFrame:
    """The first ``k`` points by their metric, after any country filter; by id without one."""
    metric = marker_metric(points)
    shown = [c for c in RANKING_COLUMNS if c in points.columns]
    ordered = points.orderBy(F.col(metric).desc_nulls_last(), "airport_id") if metric else points.orderBy(
        F.col("airport_id").desc())
    return ordered.limit(k).select(*shown)


def network_kpis(graph: DataFrame, airports: DataFrame,
                 metric: str = "pagerank_score") -> DataFrame:
    """One row: airports on the map, countries, name of the top hub."""
    points = located_airports(graph, airports)
    # the smallest struct has the highest metric and, among equals, the first id
    best = F.min(F.struct((-F.col(metric)).alias("m"), F.col("airport_id"),
                          F.coalesce("airport_name", "airport_id").alias("name")))
    return points.agg(F.count(F.lit(1)).alias("total_airports"),
                      F.countDistinct("country_code").alias("countries"),
                      best.getField("name").alias("top_hub"))


def top_airports(points: DataFrame, metric: str = "pagerank_score", k: int = 15) -> DataFrame:
    return top_k(points, metric, k, "airport_id")


def country_choice(points: DataFrame) -> DataFrame:
    """Country codes of the points with their number, for a selector."""
    return (points.filter(F.col("country_code").isNotNull()).groupBy("country_code")
            .agg(F.count(F.lit(1)).alias("airports")).orderBy("country_code"))


def country_days(mart: DataFrame) -> DataFrame:
    """Country codes of a daily mart with the number of their days, for a selector."""
    return (mart.filter(F.col("country_code").isNotNull()).groupBy("country_code")
            .agg(F.count(F.lit(1)).alias("days")).orderBy("country_code"))


def hub_ranking(graph: DataFrame, metric: str = "pagerank_score", k: int = 20) -> DataFrame:
    if metric not in graph.columns:
        raise ValueError(f"no metric {metric}; present: {graph.columns}")
    return top_k(graph, metric, k, "airport_id")


# --- anomalies -----------------------------------------------------------

def anomaly_summary(scores: DataFrame) -> DataFrame:
    """One row: days per raised level and number of countries."""
    level = F.col("anomaly_level")
    return scores.agg(
        F.count(F.when(level == "CRITICAL", 1)).alias("critical"),
        F.count(F.when(level == "HIGH", 1)).alias("high"),
        F.count(F.when(level == "ELEVATED", 1)).alias("elevated"),
        F.countDistinct("country_code").alias("countries_monitored"))


def country_series(scores: DataFrame, country: str) -> DataFrame:
    return (scores.filter(F.col("country_code") == country)
            .select("date_id", "military_flight_count", "baseline_mean", "z_score")
            .orderBy("date_id"))


def anomaly_events(scores: DataFrame, country: str) -> DataFrame:
    return (scores.filter((F.col("country_code") == country)
                          & F.col("anomaly_level").isin(*EVENT_LEVELS))
            .select("date_id", "country_code", "military_flight_count", "baseline_mean",
                    "z_score", "anomaly_level")
            .orderBy(F.col("z_score").desc(), "date_id"))


def alert_digest(scores: DataFrame, k: int = 20) -> DataFrame:
    """The k strongest raised days with one line of text each."""
    z = F.col("z_score")
    raised = scores.filter(F.col("anomaly_level").isin(*ALERT_LEVELS)).select(
        "date_id", "country_code", "military_flight_count", "z_score", "anomaly_level")
    return top_k(raised, "z_score", k, "date_id", "country_code").withColumn(
        "alert_line",
        F.format_string("[%s] %s on %s: %d flights (z=%.2f)",
                        F.col("anomaly_level"), F.col("country_code"),
                        F.col("date_id").cast("string"), F.col("military_flight_count"),
                        numeric.text_round(z, 2)))


def alert_counts(scores: DataFrame) -> DataFrame:
    """One row: raised days per level, of all scored days."""
    level = F.col("anomaly_level")
    return scores.agg(*[F.count(F.when(level == name, 1)).alias(f"{name.lower()}_count")
                        for name in ALERT_LEVELS])


def alert_message(digest: DataFrame) -> str | None:
    """The digest as one text; it holds at most k rows. None without any alert."""
    rows = digest.collect()
    if not rows:
        return None
    levels = [r["anomaly_level"] for r in rows]
    head = [f"Military activity: {levels.count(name)} {name}" for name in ALERT_LEVELS]
    return "\n".join(head + [r["alert_line"] for r in rows])


# --- routes --------------------------------------------------------------

def route_label() -> Column:
    """Pair of names; pair of ids when a name is unknown."""
    return F.coalesce(text.pair_label("origin_airport_name", "destination_airport_name"),
                      text.pair_label("origin_airport_id", "destination_airport_id"))


def route_kpis(routes: DataFrame) -> DataFrame:
    return routes.agg(F.count(F.lit(1)).alias("total_routes"),
                      F.sum("total_flights").alias("total_flights"),
                      F.avg("avg_distance_km").alias("avg_distance_km"))


def top_routes(routes: DataFrame, sort_by: str = "total_flights", k: int = 20) -> DataFrame:
    if sort_by not in ROUTE_METRICS:
        raise ValueError(f"sort by one of {ROUTE_METRICS}")
    best = top_k(routes, sort_by, k, "origin_airport_id", "destination_airport_id")
    return best.select(
        "origin_airport_id", "destination_airport_id", "origin_airport_name",
        "destination_airport_name", "total_flights", "avg_duration_min", "avg_distance_km",
        route_label().alias("route"))


# --- loads ---------------------------------------------------------------

def load_summary(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.countDistinct("icao24").alias("unique_aircraft"))
