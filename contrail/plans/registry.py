"""Registered queries: every operator over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.functions import geo, numeric, time
from contrail.operators import (activity, anomaly, enrich, graph, intervals, network, quality,
                                ranges, routes, serving, staging)
from contrail.plans import fixtures, incremental, pipeline
from contrail.session import apply_settings, cut_lineage, scratch_path
from contrail.sources import ingest, schemas, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Digits of doubles that are not rounded by the model itself.
COMPARE_DIGITS = 6
LOAD_DATE = "1998-01-15"
# days whose deliveries come late
LATE_DAYS = ("1994-03-13", "1996-09-13", "1998-02-20")
SERIES_COUNTRY = "DE"
MAP_COUNTRIES = ("EU", "AS")


# of what queries write whose rows have many matches: repeated ids take nearly no space
REPEATS_CODEC = "zstd"


def query(function: Query) -> Query:
    """Register under the function's name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_settings(spark)
        return function(spark, folder)

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round doubles whose last bits depend on the order of summation."""
    return df.withColumns({c: numeric.sql_round(F.col(c), COMPARE_DIGITS) for c in columns})


# --- shared inputs -------------------------------------------------------

def models(spark: SparkSession, folder: str, watch: quality.Watch | None = None) -> pipeline.Models:
    return pipeline.flight_models(
        fixtures.raw_flights(spark, folder), fixtures.airport_metadata(spark, folder),
        fixtures.military_ranges(spark), watch)


def connections(spark, folder):
    m = models(spark, folder)
    return routes.airport_connections(m.flights_classified, m.stg_airports)


def performance(spark, folder):
    m = models(spark, folder)
    return routes.flight_performance(m.flights_classified, m.stg_airports)


def daily(spark, folder):
    return activity.daily_military_counts(models(spark, folder).military_flights)


def scores(spark, folder):
    return anomaly.anomaly_scores(daily(spark, folder))


def edges(spark, folder):
    return cut_lineage(graph.edges_from_connections(connections(spark, folder)))


# --- staging and enrichment ----------------------------------------------

@query
def stg_flights(spark, folder):
    return models(spark, folder).stg_flights


@query
def stg_airports(spark, folder):
    return staging.stage_airports(fixtures.airport_metadata(spark, folder))


@query
def stg_ranges(spark, folder):
    return staging.stage_ranges(fixtures.supplier_ranges(spark, folder))


@query
def flights_enriched(spark, folder):
    return rounded(models(spark, folder).flights_enriched, "flight_duration_min",
                   "distance_km")


@query
def haversine_distance(spark, folder):
    """Distance of every flight with both airports known."""
    m = models(spark, folder)
    placed = enrich.with_airports(m.stg_flights, m.stg_airports)
    distance = geo.haversine(F.col("origin_lat"), F.col("origin_lon"),
                             F.col("destination_lat"), F.col("destination_lon"))
    return rounded(placed.select("flight_id", "origin_airport_id", "destination_airport_id",
                                 distance.alias("distance_km")), "distance_km")


@query
def date_parts(spark, folder):
    seen = F.col("first_seen_at")
    return models(spark, folder).stg_flights.select(
        "flight_id", seen.cast("date").alias("flight_date"),
        time.year_of(seen).alias("flight_year"), time.month_of(seen).alias("flight_month"),
        time.weekday(seen).alias("day_of_week"), time.is_weekend(seen).alias("is_weekend"))


@query
def range_classify(spark, folder):
    """The fixture's few ranges."""
    m = models(spark, folder)
    return ranges.range_classify(
        m.stg_flights.select("flight_id", "icao24"),
        m.stg_ranges.select("range_start", "range_end", "country_code", "military_branch"))


@query
def range_classify_bucketed(spark, folder):
    """A range table that grows with the data."""
    _pack_repeats(spark)
    m = models(spark, folder)
    blocks = staging.stage_ranges(fixtures.supplier_ranges(spark, folder))
    return ranges.range_classify(
        m.stg_flights.select("flight_id", "icao24"),
        blocks.select("range_start", "range_end", "country_code", "military_branch"), by_keys=True)


def _pack_repeats(spark):
    spark.conf.set("spark.sql.parquet.compression.codec", REPEATS_CODEC)


def _addresses(spark, folder):
    return models(spark, folder).stg_flights.select("flight_id", "icao24")


def _blocks(df):
    return df.select("range_start", "range_end", "country_code", "military_branch")


@query
def interval_classify(spark, folder):
    """The growing range table by sampled cells instead of key prefixes."""
    _pack_repeats(spark)
    return intervals.interval_join(
        _addresses(spark, folder), _blocks(staging.stage_ranges(fixtures.supplier_ranges(spark, folder))))


def _flights_once(spark, folder):
    """Deliveries with one id are one flight; the id holds the address."""
    return _addresses(spark, folder).dropDuplicates(["flight_id"])


@query
def interval_narrowest(spark, folder):
    """The fixture's overlapping ranges, one per flight."""
    return intervals.interval_join(_flights_once(spark, folder), _blocks(models(spark, folder).stg_ranges),
                                   resolve="narrowest")


@query
def interval_narrowest_growing(spark, folder):
    return intervals.interval_join(
        _flights_once(spark, folder), _blocks(staging.stage_ranges(fixtures.supplier_ranges(spark, folder))),
        resolve="narrowest")


@query
def interval_text_keys(spark, folder):
    """Callsigns, which are any text, in blocks of callsigns."""
    _pack_repeats(spark)
    return intervals.interval_join(
        models(spark, folder).stg_flights.select("flight_id", "callsign"),
        fixtures.callsign_blocks(spark, folder), "callsign", "block_start", "block_end")


@query
def military_flights(spark, folder):
    return rounded(models(spark, folder).military_flights, "flight_duration_min",
                   "distance_km")


# --- routes and network --------------------------------------------------

@query
def airport_connections(spark, folder):
    return rounded(connections(spark, folder), "avg_duration_min", "avg_distance_km")


@query
def route_performance(spark, folder):
    return performance(spark, folder)


@query
def airport_network(spark, folder):
    m = models(spark, folder)
    return network.airport_network(connections(spark, folder),
                                   m.stg_airports)


@query
def degree_full_outer(spark, folder):
    return network.degree_metrics(connections(spark, folder))


# --- military activity ---------------------------------------------------

@query
def daily_counts(spark, folder):
    return rounded(daily(spark, folder), "avg_distance_km", "max_distance_km")


@query
def rolling_stats(spark, folder):
    return rounded(
        activity.add_rolling(daily(spark, folder)).select(
            "date_id", "country_code", "military_flight_count", "rolling_7d_avg",
            "rolling_30d_avg", "rolling_30d_std"),
        "rolling_7d_avg", "rolling_30d_avg", "rolling_30d_std")


@query
def rolling_calendar(spark, folder):
    """Frames of calendar days over series with gaps."""
    doubles = ("calendar_7d_avg", "calendar_30d_avg", "calendar_30d_std")
    return rounded(activity.add_calendar_rolling(daily(spark, folder)).select(
        "date_id", "country_code", "military_flight_count", "calendar_7d_days", "calendar_30d_days", *doubles), *doubles)


@query
def lag_changes(spark, folder):
    return activity.add_changes(daily(spark, folder)).select(
        "date_id", "country_code", "military_flight_count", "day_over_day_change",
        "week_over_week_change")


@query
def activity_rank(spark, folder):
    return activity.add_activity_rank(daily(spark, folder)).select(
        "date_id", "country_code", "military_flight_count", "activity_rank_desc")


@query
def military_activity(spark, folder):
    return rounded(activity.military_activity(daily(spark, folder)),
                   "avg_distance_km", "max_distance_km")


@query
def anomaly_flags(spark, folder):
    return rounded(activity.anomaly_flags(activity.military_activity(daily(spark, folder))),
                   "avg_distance_km", "max_distance_km")


@query
def baseline_stats(spark, folder):
    return rounded(anomaly.baseline(daily(spark, folder)), "baseline_mean", "baseline_std")


@query
def anomaly_scores(spark, folder):
    return scores(spark, folder)


@query
def percentile_rank(spark, folder):
    return rounded(anomaly.add_percentile_rank(daily(spark, folder)).select(
        "date_id", "country_code", "military_flight_count", "percentile_rank"),
        "percentile_rank")


# --- graph ---------------------------------------------------------------

@query
def weighted_degree(spark, folder):
    return graph.weighted_degree(edges(spark, folder))


@query
def pagerank(spark, folder):
    return rounded(graph.pagerank(edges(spark, folder)), "pagerank")


@query
def components(spark, folder):
    return graph.components(edges(spark, folder))


@query
def clustering(spark, folder):
    return rounded(graph.clustering(edges(spark, folder)), "clustering")


@query
def betweenness(spark, folder):
    return rounded(graph.betweenness(edges(spark, folder)), "betweenness")


def _graph_table(spark, folder):
    return graph.airport_graph(connections(spark, folder))


@query
def airport_graph(spark, folder):
    return _graph_table(spark, folder)


@query
def supply_graph(spark, folder):
    """All graph metrics over a graph that grows with the data."""
    return graph.airport_graph(fixtures.supply_links(spark, folder))


@query
def supply_betweenness(spark, folder):
    """Exact betweenness of the growing graph."""
    links = cut_lineage(graph.edges_from_connections(fixtures.supply_links(spark, folder)))
    return rounded(graph.betweenness(links), "betweenness")


# --- ingest --------------------------------------------------------------

@query
def dedup_pulls(spark, folder):
    raw = fixtures.raw_flights(spark, folder)
    return ingest.dedup_flights(raw, fixtures.arrival_pull(raw))


@query
def state_vectors(spark, folder):
    return ingest.unpack_states(fixtures.state_batches(spark, folder))


@query
def missing_slices(spark, folder):
    """Grid over the whole span of the raw table, less what it holds."""
    return ingest.missing_slices(*_grid_and_done(spark, folder))


@query
def pull_coverage(spark, folder):
    return rounded(ingest.coverage(*_grid_and_done(spark, folder)), "pct_done")


def _grid_and_done(spark, folder):
    # one pass over the raw table; everything else derives from the distinct slices
    done = cut_lineage(ingest.completed_pulls(fixtures.raw_flights(spark, folder)))
    airports = done.select("airport").distinct()
    grid = ingest.pull_grid(airports, done.agg(F.min("day")).scalar(),
                            done.agg(F.max("day")).scalar())
    return grid, done


@query
def daily_slice(spark, folder):
    day = ingest.day_before(LOAD_DATE)
    return ingest.daily_slice(fixtures.raw_flights(spark, folder, day), LOAD_DATE)


@query
def tag_source(spark, folder):
    raw = fixtures.raw_flights(spark, folder).drop(*ingest.TAG_COLUMNS)
    return ingest.tag_source(raw, "EDDF", "arrival")


@query
def load_flights(spark, folder):
    """Rows as the loader would append them, without the load time."""
    raw = fixtures.raw_flights(spark, folder).drop(*ingest.TAG_COLUMNS, "source_date")
    return ingest.complete_columns(ingest.stamp_flights(raw, LOAD_DATE)).drop("loaded_at")


@query
def stamped_flights(spark, folder):
    """With a load time, a day after the flight."""
    return _stamped(spark, folder)


def _stamped(spark, folder):
    raw = fixtures.raw_flights(spark, folder).drop(*ingest.TAG_COLUMNS)
    return ingest.complete_columns(ingest.stamp_flights(
        raw, LOAD_DATE, F.timestamp_seconds(F.col("firstSeen") + 86_400)))


@contextmanager
def _schema(spark):
    """A schema of this call alone; it is dropped with its tables."""
    name = f"call_{uuid.uuid4().hex}"
    tables.create_schema(spark, name)
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@query
def append_round_trip(spark, folder):
    """Two appends, the first without a column, read back from the catalog."""
    rows = _stamped(spark, folder)
    even = F.col("firstSeen") % 2 == 0
    with _schema(spark) as schema:
        name = tables.table_name(schema, "raw_flights")
        tables.append_table(rows.where(even).drop("callsign"), name, schemas.RAW_FLIGHTS, "source_date")
        tables.append_table(rows.where(~even), name, schemas.RAW_FLIGHTS, "source_date")
        return cut_lineage(ingest.complete_columns(tables.read_table(spark, name)))


@query
def seed_round_trip(spark, folder):
    """The airport seed as a CSV file with a header."""
    path = scratch_path(spark)
    fixtures.airport_metadata(spark, folder).write.option("header", True).csv(path)
    return staging.stage_airports(tables.read_seed(spark, path, schemas.AIRPORT_METADATA))


@query
def mart_round_trip(spark, folder):
    """A view and a mart over it; the mart is found by a list of preferences."""
    with _schema(spark) as schema:
        view = f"{schema}_routes"
        tables.publish_view(performance(spark, folder), view)
        name = tables.table_name(schema, "flight_performance")
        tables.overwrite_table(tables.read_table(spark, view).limit(0), name)
        empty = tables.first_available(spark, f"{schema}.absent", name)
        tables.overwrite_table(tables.read_table(spark, view), name)
        if empty is not None or not {"flight_performance", view} <= set(tables.list_tables(spark, schema)):
            raise RuntimeError("the catalog does not show what was written")
        found = cut_lineage(tables.first_available(spark, f"{schema}.absent", name))
        spark.catalog.dropTempView(view)
        return found


@query
def refresh_run(spark, folder):
    """The whole daily refresh; what its anomaly mart holds afterwards."""
    with _schema(spark) as schema:
        pipeline.run_pipeline(
            spark, fixtures.raw_flights(spark, folder), fixtures.airport_metadata(spark, folder),
            fixtures.military_ranges(spark), Settings(marts_schema=schema))
        return cut_lineage(tables.read_table(spark, tables.table_name(schema, "anomaly_scores")))


@query
def incremental_refresh(spark, folder):
    """Marts without a few days' deliveries, then with them: only touched months are written again."""
    raw = fixtures.raw_flights(spark, folder)
    late = F.col("source_date").isin([dt.date.fromisoformat(d) for d in LATE_DAYS])

    def counts(rows):
        return activity.daily_military_counts(pipeline.flight_models(
            rows, fixtures.airport_metadata(spark, folder), fixtures.military_ranges(spark)).military_flights)

    with _schema(spark) as schema:
        names = [tables.table_name(schema, n) for n in ("daily_counts", "rolling")]
        incremental.build_marts(counts(raw.where(~late)), *names)
        days = incremental.touched_days(raw.where(late))
        incremental.refresh_marts(spark, counts(incremental.raw_of_months(raw, days)), days, *names)
        return rounded(cut_lineage(tables.read_table(spark, names[1])).drop("month_id"),
                       "rolling_7d_avg", "rolling_30d_avg", "rolling_30d_std")


@query
def load_summary(spark, folder):
    return serving.load_summary(fixtures.raw_flights(spark, folder))


# --- marts in order ------------------------------------------------------

@query
def network_in_order(spark, folder):
    """The network mart with each row's place in its order."""
    return _in_order(models_network(spark, folder), F.col("total_flights").desc(), F.col("airport_id")).select(
        "position", "airport_id", "total_flights")


def models_network(spark, folder):
    return network.airport_network(connections(spark, folder), models(spark, folder).stg_airports)


@query
def flags_in_order(spark, folder):
    flags = activity.anomaly_flags(activity.military_activity(daily(spark, folder)))
    return _in_order(flags, F.col("date_id").desc(), F.col("simple_z_score").desc(), F.col("country_code")).select(
        "position", "date_id", "country_code", "simple_z_score")


@query
def scores_in_order(spark, folder):
    return _in_order(scores(spark, folder), F.col("date_id"), F.col("z_score").desc(), F.col("country_code")).select(
        "position", "date_id", "country_code", "z_score")


def _in_order(mart, *order):
    return graph.number_rows(mart, "position", *order)


# --- quality -------------------------------------------------------------

@query
def dq_suite(spark, folder):
    """Checks that are counted while the models are written."""
    watch = quality.Watch()
    built = pipeline.build_tables(models(spark, folder, watch), watch=watch)
    for name in pipeline.MARTS:
        built[name] = cut_lineage(watch.add(name, built[name]))
    return watch.report(built)


@query
def dq_negative_duration(spark, folder):
    """Run on all delivered rows, as staging already drops negative durations."""
    raw = fixtures.raw_flights(spark, folder)
    timed = raw.select("icao24", "firstSeen", "lastSeen",
                       time.minutes_between(time.from_epoch("firstSeen"),
                                            time.from_epoch("lastSeen"))
                       .alias("flight_duration_min"))
    return quality.no_negative(timed)


@query
def dq_max_24h(spark, folder):
    return rounded(quality.max_value(models(spark, folder).flights_enriched).select(
        "flight_id", "flight_duration_min", "origin_airport_id", "destination_airport_id"),
        "flight_duration_min")


@query
def dq_military_ratio(spark, folder):
    return rounded(quality.max_ratio(models(spark, folder).flights_enriched), "military_pct")


# --- serving -------------------------------------------------------------

@query
def network_map(spark, folder):
    m = models(spark, folder)
    table = cut_lineage(_graph_table(spark, folder))
    return rounded(serving.network_map(table, m.stg_airports), "marker_size")


@query
def network_kpis(spark, folder):
    return serving.network_kpis(_graph_table(spark, folder),
                                models(spark, folder).stg_airports)


@query
def network_top(spark, folder):
    """Top 15 of the map."""
    m = models(spark, folder)
    points = serving.located_airports(_graph_table(spark, folder), m.stg_airports)
    return serving.top_airports(points).select(
        "hub_rank", "airport_id", "airport_name", "country_code", "pagerank_score",
        "betweenness_centrality")


@query
def hub_ranking(spark, folder):
    """By connections, over the SQL network mart."""
    m = models(spark, folder)
    mart = network.airport_network(connections(spark, folder),
                                   m.stg_airports)
    return serving.hub_ranking(mart, "total_degree").select(
        "airport_id", "airport_name", "country_code", "total_degree")


def _hubs(spark, folder, metric):
    m = models(spark, folder)
    points = serving.located_airports(_graph_table(spark, folder), m.stg_airports)
    return serving.hub_ranking(points, metric).select(
        "airport_id", "airport_name", "country_code", metric)


@query
def hub_ranking_pagerank(spark, folder):
    return _hubs(spark, folder, "pagerank_score")


@query
def hub_ranking_betweenness(spark, folder):
    return _hubs(spark, folder, "betweenness_centrality")


@query
def map_of_network(spark, folder):
    """The map where there are no graph metrics: the network mart with its own places."""
    return rounded(serving.airport_map(models_network(spark, folder), models(spark, folder).stg_airports), "marker_size")


@query
def map_of_seed(spark, folder):
    """The map where there is the airport seed alone."""
    airports = models(spark, folder).stg_airports
    return serving.airport_map(airports, airports)


@query
def map_top_countries(spark, folder):
    """The 15 best connected airports of two countries."""
    points = serving.airport_map(models_network(spark, folder), models(spark, folder).stg_airports, MAP_COUNTRIES)
    return serving.map_ranking(points)


@query
def series_countries(spark, folder):
    """Countries of the activity mart, with their days."""
    return serving.country_days(activity.military_activity(daily(spark, folder)))


@query
def top_routes_distance(spark, folder):
    """The longest routes."""
    return serving.top_routes(performance(spark, folder), "avg_distance_km")


@query
def top_routes_duration(spark, folder):
    """The 15 routes of the longest average duration."""
    return serving.top_routes(performance(spark, folder), "avg_duration_min", 15)


@query
def network_map_countries(spark, folder):
    """The map of two countries; marker sizes are scaled over all airports."""
    m = models(spark, folder)
    table = cut_lineage(_graph_table(spark, folder))
    return rounded(serving.network_map(table, m.stg_airports, MAP_COUNTRIES), "marker_size")


@query
def map_countries(spark, folder):
    """Countries to choose from, with their airports on the map."""
    m = models(spark, folder)
    points = serving.located_airports(_graph_table(spark, folder), m.stg_airports)
    return serving.country_choice(points)


@query
def top_routes(spark, folder):
    return serving.top_routes(performance(spark, folder))


@query
def route_kpis(spark, folder):
    return rounded(serving.route_kpis(
        performance(spark, folder)), "avg_distance_km")


@query
def anomaly_summary(spark, folder):
    return serving.anomaly_summary(scores(spark, folder))


@query
def country_series(spark, folder):
    return serving.country_series(scores(spark, folder), SERIES_COUNTRY)


@query
def anomaly_events(spark, folder):
    return serving.anomaly_events(scores(spark, folder), SERIES_COUNTRY)


@query
def alert_digest(spark, folder):
    return serving.alert_digest(scores(spark, folder))


@query
def alert_counts(spark, folder):
    return serving.alert_counts(scores(spark, folder))
