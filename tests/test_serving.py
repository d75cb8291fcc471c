import datetime as dt

import pytest

from contrail.operators import serving


@pytest.fixture(scope="module")
def graph(spark):
    return spark.createDataFrame(
        [("AAAA", 0.5, 0.1, 1), ("BBBB", 0.3, 0.2, 2), ("CCCC", 0.1, 0.3, 3), ("DDDD", 0.1, 0.0, 4)],
        "airport_id string, pagerank_score double, betweenness_centrality double, hub_rank bigint")


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [("AAAA", "Alpha", "DE", 1.0, 2.0), ("BBBB", None, "DE", 1.0, 2.0),
         ("CCCC", "Gamma", "FR", 1.0, 2.0), ("DDDD", "Delta", "US", None, 2.0)],
        "airport_id string, airport_name string, country_code string, latitude double, "
        "longitude double")


@pytest.fixture(scope="module")
def scores(spark):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(day + dt.timedelta(days=i), c, n, 3.0, z, level) for i, (c, n, z, level) in enumerate([
            ("DE", 9, 4.005, "CRITICAL"), ("DE", 7, 2.125, "ELEVATED"), ("US", 8, 2.675, "HIGH"),
            ("US", 3, 0.1, "NORMAL"), ("DE", 8, 2.675, "HIGH")])],
        "date_id date, country_code string, military_flight_count bigint, baseline_mean double, "
        "z_score double, anomaly_level string")


def test_map_scales_before_the_country_filter(graph, places):
    every = {r["airport_id"]: r["marker_size"] for r in serving.network_map(graph, places).collect()}
    assert every == pytest.approx({"AAAA": 850.0, "BBBB": 450.0, "CCCC": 50.0})
    french = serving.network_map(graph, places, ["FR"]).collect()
    assert [(r["airport_id"], r["marker_size"]) for r in french] == [("CCCC", 50.0)]
    flat = serving.network_map(graph.filter("airport_id = 'AAAA'"), places).first()
    assert flat["marker_size"] == 200.0


def test_kpis_and_top(graph, places):
    row = serving.network_kpis(graph, places).first()
    assert (row["total_airports"], row["countries"], row["top_hub"]) == (3, 2, "Alpha")
    points = serving.located_airports(graph, places)
    assert [r["airport_id"] for r in serving.top_airports(points, k=2).collect()] == ["AAAA", "BBBB"]
    assert serving.top_row(graph, "betweenness_centrality").first()["airport_id"] == "CCCC"


def test_hub_ranking_breaks_ties_by_id(graph):
    got = serving.hub_ranking(graph, "pagerank_score", 4).collect()
    assert [r["airport_id"] for r in got] == ["AAAA", "BBBB", "CCCC", "DDDD"]
    with pytest.raises(ValueError):
        serving.hub_ranking(graph, "charm")


def test_anomaly_results(scores):
    assert serving.anomaly_summary(scores).first().asDict() == {
        "critical": 1, "high": 2, "elevated": 1, "countries_monitored": 2}
    assert [r["z_score"] for r in serving.anomaly_events(scores, "DE").collect()] == [
        4.005, 2.675, 2.125]
    series = serving.country_series(scores, "US").collect()
    assert [r["military_flight_count"] for r in series] == [8, 3]


def test_alert_digest(scores):
    digest = serving.alert_digest(scores)
    lines = [r["alert_line"] for r in digest.collect()]
    assert lines == [f"[{lv}] {c} on {d}: {n} flights (z={z:.2f})" for lv, c, d, n, z in [
        ("CRITICAL", "DE", "2024-01-01", 9, 4.005), ("HIGH", "US", "2024-01-03", 8, 2.675),
        ("HIGH", "DE", "2024-01-05", 8, 2.675)]]
    assert serving.alert_counts(scores).first().asDict() == {"critical_count": 1, "high_count": 2}
    message = serving.alert_message(digest)
    assert "1 CRITICAL" in message and message.endswith(lines[-1])
    assert serving.alert_message(digest.limit(0)) is None
    plan = digest._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_routes(spark):
    routes = spark.createDataFrame(
        [("A", "B", "Alpha", "Beta", 10, 1.0, 5.0), ("B", "A", "Beta", None, 20, 2.0, None)],
        "origin_airport_id string, destination_airport_id string, origin_airport_name string, "
        "destination_airport_name string, total_flights bigint, avg_duration_min double, "
        "avg_distance_km double")
    assert [r["route"] for r in serving.top_routes(routes).collect()] == ["B → A", "Alpha → Beta"]
    assert [r["route"] for r in serving.top_routes(routes, "avg_distance_km").collect()] == [
        "Alpha → Beta", "B → A"]
    with pytest.raises(ValueError):
        serving.top_routes(routes, "price")
    assert serving.route_kpis(routes).first().asDict() == {
        "total_routes": 2, "total_flights": 30, "avg_distance_km": 5.0}


def test_ordered_marts(spark, scores):
    dates = [r["date_id"].day for r in serving.ordered_scores(scores).collect()]
    assert dates == [1, 2, 3, 4, 5]
    flags = scores.withColumnRenamed("z_score", "simple_z_score")
    assert [r["date_id"].day for r in serving.ordered_flags(flags).collect()] == [5, 4, 3, 2, 1]
    network = spark.createDataFrame([("B", 1), ("A", 1), ("C", 2)],
                                    "airport_id string, total_flights bigint")
    assert [r["airport_id"] for r in serving.ordered_network(network).collect()] == ["C", "A", "B"]


def test_the_map_takes_whichever_table_is_there(spark):
    seed = spark.createDataFrame([("A", "Alpha", "DE", 1.0, 2.0), ("B", "Beta", "US", 3.0, 4.0), ("C", "Gamma", "US", None, 4.0)],
                                 "airport_id string, airport_name string, country_code string, latitude double, longitude double")
    mart = seed.selectExpr("*", "case airport_id when 'A' then 4 else 8 end as total_degree")
    scored = spark.createDataFrame([("A", 0.75, 1, 0.0), ("B", 0.25, 2, 0.0), ("X", 0.1, 3, 0.0)],
                                   "airport_id string, pagerank_score double, hub_rank int, betweenness_centrality double")
    sizes = {}
    for name, table in (("graph", scored), ("mart", mart), ("seed", seed)):
        points = serving.airport_map(table, seed)
        sizes[name] = {r["airport_id"]: r["marker_size"] for r in points.collect()}
        shown = serving.map_ranking(points).columns
        assert ("hub_rank" in shown, "total_degree" in shown) == (name == "graph", name == "mart")
    assert sizes == {"graph": {"A": 850.0, "B": 50.0}, "mart": {"A": 50.0, "B": 850.0}, "seed": {"A": 200.0, "B": 200.0}}
    assert [r["airport_id"] for r in serving.map_ranking(serving.airport_map(mart, seed, ["US"])).collect()] == ["B"]
    assert serving.airport_map(mart.limit(0), seed).isEmpty()
