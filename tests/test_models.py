import datetime as dt
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.operators import activity, anomaly, network, routes
from contrail.plans import pipeline

RAW = ("icao24 string, firstSeen bigint, estDepartureAirport string, lastSeen bigint, "
       "estArrivalAirport string, callsign string, estDepartureAirportHorizDistance int, "
       "estDepartureAirportVertDistance int, estArrivalAirportHorizDistance int, "
       "estArrivalAirportVertDistance int, departureAirportCandidatesCount int, "
       "arrivalAirportCandidatesCount int, source_date date")
DAY = 1700006400  # 2023-11-15 00:00 UTC, a Wednesday


def raw(spark, rows):
    filled = [(a, s, o, e, d, c, 1, 1, 1, 1, 1, 1, dt.date(2023, 11, 15))
              for a, s, o, e, d, c in rows]
    return spark.createDataFrame(filled, RAW)


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame(
        [(" aaaa", "Alpha ", "A", "de", "Germany", 50.0, 8.0, "UTC", "military"),
         ("BBBB", "Beta", "B", "DE", "Germany", 52.0, 13.0, "UTC", "international"),
         ("CCCC", "Gamma", "C", "FR", "France", None, 2.0, "UTC", "international"),
         (None, "Nowhere", "N", "XX", "X", 0.0, 0.0, "UTC", "international")],
        "airport_id string, airport_name string, city string, country_code string, "
        "country_name string, latitude double, longitude double, timezone string, "
        "airport_type string")


@pytest.fixture(scope="module")
def ranges(spark):
    return spark.createDataFrame(
        [(" 780000", "783FFF ", "no", "Norway", "N", None),
         ("780800", "780fff", "JP", "Japan", "J", None), (None, "x", "ZZ", "Z", "Z", None)],
        "range_start string, range_end string, country_code string, country_name string, "
        "military_branch string, notes string")


@pytest.fixture(scope="module")
def models(spark, airports, ranges):
    return pipeline.flight_models(raw(spark, [
        (" 780801 ", DAY, "aaaa", DAY + 3600, "BBBB ", "rch1"),
        ("ABCDEF", DAY, "AAAA", DAY + 3600, "AAAA", None),
        ("ABCDEF", DAY + 86400 * 3, "AAAA", DAY + 86400 * 3 + 60, "CCCC", "DLH"),
        ("ABCDEF", DAY, "DDDD", DAY + 60, None, "DLH"),
        ("ABCDEF", DAY, "AAAA", DAY, "BBBB", "equal times"),
        (None, DAY, "AAAA", DAY + 60, "BBBB", "no aircraft"),
        ("ABCDEF", None, "AAAA", DAY + 60, "BBBB", "no start")]), airports, ranges)


def test_staging_cleans_and_filters(models):
    rows = models.stg_flights.collect()
    assert len(rows) == 4
    assert {r["icao24"] for r in rows} == {"780801", "abcdef"}
    assert {r["origin_airport_id"] for r in rows} == {"AAAA", "DDDD"}
    assert models.stg_airports.count() == 3 and models.stg_ranges.count() == 2
    assert {r["country_code"] for r in models.stg_ranges.collect()} == {"NO", "JP"}


def test_overlapping_ranges_fan_out(models):
    rows = models.flights_enriched.filter("icao24 = '780801'").collect()
    assert sorted(r["military_country"] for r in rows) == ["JP", "NO"]
    assert {r["flight_id"] for r in rows} == {rows[0]["flight_id"]}
    assert all(r["is_military"] and r["flight_duration_min"] == 60.0 for r in rows)
    military = models.military_flights.collect()
    assert {r["military_category"] for r in military} == {"TRANSPORT"}
    assert {r["range_category"] for r in military} == {"SHORT_RANGE"}


def test_unmatched_and_incomplete_airports(models):
    rows = {r["destination_airport_id"]: r for r in models.flights_enriched.collect()}
    assert rows["CCCC"]["distance_km"] is None and rows["CCCC"]["destination_country"] == "FR"
    assert rows["CCCC"]["is_weekend"] and rows["CCCC"]["day_of_week"] == 6
    assert rows[None]["origin_airport_name"] is None and not rows[None]["is_military"]
    assert rows["AAAA"]["distance_km"] == 0.0


def test_connections_drop_self_routes_performance_keeps_them(models):
    pairs = {(r["origin_airport_id"], r["destination_airport_id"])
             for r in routes.airport_connections(models.flights_classified, models.stg_airports).collect()}
    assert pairs == {("AAAA", "BBBB"), ("AAAA", "CCCC")}
    every = routes.flight_performance(models.flights_classified, models.stg_airports,
                                      Settings(min_route_flights=1))
    rows = {(r["origin_airport_id"], r["destination_airport_id"]): r for r in every.collect()}
    assert set(rows) == pairs | {("AAAA", "AAAA")}
    assert rows["AAAA", "AAAA"]["stddev_duration_min"] is None
    assert rows["AAAA", "AAAA"]["min_per_km"] is None
    assert rows["AAAA", "BBBB"]["total_flights"] == 2
    assert rows["AAAA", "BBBB"]["unique_aircraft"] == 1
    assert rows["AAAA", "BBBB"]["military_pct"] == 100.0
    assert routes.flight_performance(models.flights_classified, models.stg_airports).count() == 0


def test_one_sided_airports_stay_in_the_network(models):
    rows = {r["airport_id"]: r for r in network.airport_network(
        routes.airport_connections(models.flights_classified, models.stg_airports), models.stg_airports).collect()}
    assert (rows["AAAA"]["out_degree"], rows["AAAA"]["in_degree"]) == (2, 0)
    assert rows["BBBB"]["flow_asymmetry"] == -1.0 and rows["AAAA"]["flow_asymmetry"] == 1.0


def test_military_filter_becomes_an_inner_join_with_pruned_columns(models):
    plan = activity.daily_military_counts(models.military_flights)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "Inner" in text
    assert "departure_horiz_distance_m" not in text


def daily(spark, rows):
    return spark.createDataFrame(
        [(dt.date(2024, 1, 1) + dt.timedelta(days=d), c, n) for d, c, n in rows],
        "date_id date, country_code string, military_flight_count bigint")


def test_windows_count_rows_not_days(spark):
    rows = [(d, "DE", d + 1) for d in range(0, 80, 2)]
    got = activity.add_changes(activity.add_rolling(daily(spark, rows))).orderBy("date_id")
    got = got.toPandas()
    counts = pd.Series([float(n) for _, _, n in rows])
    assert got["rolling_7d_avg"].tolist() == pytest.approx(
        counts.rolling(7, min_periods=1).mean().tolist())
    assert got["rolling_30d_std"].tolist()[1:] == pytest.approx(
        counts.rolling(30, min_periods=1).std().tolist()[1:])
    assert got["week_over_week_change"].tolist()[7:] == [14.0] * 33
    short = activity.add_rolling(daily(spark, rows), Settings(baseline_window_rows=3))
    assert short.orderBy("date_id").collect()[10]["rolling_30d_avg"] == 19.0


def test_rank_ties_follow_the_date(spark):
    rows = [(2, "DE", 5), (1, "DE", 5), (3, "DE", 9), (1, "US", 5)]
    got = activity.add_activity_rank(daily(spark, rows))
    assert {(r["country_code"], r["date_id"].day): r["activity_rank_desc"]
            for r in got.collect()} == {("DE", 4): 1, ("DE", 2): 2, ("DE", 3): 3, ("US", 2): 1}


def test_scores_follow_their_definitions(spark):
    rng = random.Random(3)
    rows = [(d, c, rng.choice([3, 4, 5, 6, 7, 60] if rng.random() < 0.05 else [3, 4, 5, 6, 7]))
            for d in range(400) for c in ("DE", "US") if rng.random() < 0.9]
    rows += [(0, "JP", 3)]
    df = daily(spark, rows).select(
        "*", (F.dayofweek("date_id") - 1).cast("bigint").alias("day_of_week"),
        F.lit(1).cast("bigint").alias("unique_aircraft_count"))
    flights = [(r["country_code"], r["day_of_week"], r["date_id"], r["military_flight_count"]) for r in df.collect()]
    got = {(r["country_code"], r["date_id"]): r for r in anomaly.anomaly_scores(df).collect()}
    assert len(got) == len(flights)
    levels = set()
    for country, weekday, day, n in flights:
        # a day is compared with the same weekdays of its country
        same = [f[3] for f in flights if f[:2] == (country, weekday)]
        deviation = statistics.stdev(same) if len(same) > 1 else 0
        z = (n - statistics.mean(same)) / deviation if deviation else 0.0
        name = "NORMAL" if z <= 1.5 else "ELEVATED" if z <= 2.5 else "HIGH" if z <= 3.5 else "CRITICAL"
        row = got[country, day]
        assert row["z_score"] == pytest.approx(z, abs=5.1e-5)
        assert (row["anomaly_level"], row["sample_count"]) == (name, len(same))
        assert row["baseline_median"] == statistics.median(same)
        # equal counts share the mean of the places that they take together
        own = [f[3] for f in flights if f[0] == country]
        below, equal = sum(x < n for x in own), own.count(n)
        assert row["percentile_rank"] == pytest.approx((below + (equal + 1) / 2) / len(own), abs=5.1e-5)
        levels.add(name)
    assert "CRITICAL" in levels
    # the grouped form carries the same numbers
    base = anomaly.baseline(df).filter("country_code = 'JP'").first()
    assert (base["baseline_mean"], base["baseline_std"], base["sample_count"]) == (3.0, None, 1)


def test_statistics_share_one_shuffle(spark):
    plan = activity.military_activity(daily(spark, [(0, "DE", 3)]).select(
        "*", *[F.lit(0).cast("bigint").alias(c) for c in (
            "day_of_week", "unique_aircraft_count", "transport_flights", "fighter_flights",
            "training_flights", "tanker_flights", "surveillance_flights", "unique_origins",
            "unique_destinations")],
        F.lit(0.0).alias("avg_distance_km"), F.lit(0.0).alias("max_distance_km")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_calendar_frames_count_missing_days(spark):
    first = dt.date(2026, 1, 1)
    days = {0: 6, 1: 8, 5: 10, 7: 3, 8: 9, 29: 20, 30: 2, 70: 5}
    df = spark.createDataFrame([(first + dt.timedelta(d), "DE", n) for d, n in days.items()],
                               "date_id date, country_code string, military_flight_count long")
    for row in activity.add_calendar_rolling(df).collect():
        day = (row["date_id"] - first).days
        for name, width in (("7d", 7), ("30d", 30)):
            held = [n for d, n in days.items() if day - width < d <= day]
            assert row[f"calendar_{name}_days"] == len(held)
            assert row[f"calendar_{name}_avg"] == pytest.approx(sum(held) / len(held))
        spread = statistics.stdev(held) if len(held) > 1 else None
        assert row["calendar_30d_std"] == (None if spread is None else pytest.approx(spread))
