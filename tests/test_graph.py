import heapq
import itertools
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.operators import graph
from contrail.session import cut_lineage


def random_edges(seed, size, links, span=6):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(size)]
    return {(a, b): rng.randint(1, span)
            for a, b in rng.sample(list(itertools.permutations(names, 2)), links)}


def frame(spark, edges):
    return spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()],
                                 "src string, dst string, weight bigint")


def members(edges):
    return sorted({n for pair in edges for n in pair})


def plain_pagerank(edges, alpha=0.85, tol=1e-6, max_iter=100):
    names = members(edges)
    out = defaultdict(float)
    for (a, _), w in edges.items():
        out[a] += w
    rank = {n: 1 / len(names) for n in names}
    for _ in range(max_iter):
        last, lost = rank, alpha * sum(rank[n] for n in names if n not in out)
        rank = {n: (lost + 1 - alpha) / len(names) for n in names}
        for (a, b), w in edges.items():
            rank[b] += alpha * last[a] * w / out[a]
        if tol and sum(abs(rank[n] - last[n]) for n in names) < len(names) * tol:
            break
    return rank


def plain_betweenness(edges, sources=None):
    names, near = members(edges), defaultdict(list)
    for (a, b), w in edges.items():
        near[a].append((b, w))
    score = dict.fromkeys(names, 0.0)
    for s in sources or names:
        dist, paths, before, order, heap = {}, defaultdict(float), defaultdict(list), [], [(0, s)]
        best = {s: 0}
        paths[s] = 1.0
        while heap:
            d, v = heapq.heappop(heap)
            if v in dist:
                continue
            dist[v] = d
            order.append(v)
            for u, w in near[v]:
                if u not in best or d + w < best[u]:
                    best[u], paths[u], before[u] = d + w, paths[v], [v]
                    heapq.heappush(heap, (d + w, u))
                elif u not in dist and d + w == best[u]:
                    paths[u] += paths[v]
                    before[u].append(v)
        share = defaultdict(float)
        for v in reversed(order):
            for u in before[v]:
                share[u] += paths[u] / paths[v] * (1 + share[v])
            if v != s:
                score[v] += share[v]
    n = len(names)
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1
    if sources and n > 2:
        scale *= n / len(sources)
    return {k: v * scale for k, v in score.items()}


def plain_clustering(edges):
    weight = {}
    for a, b in edges:
        low, high = sorted((a, b))
        weight[low, high] = edges.get((high, low), edges.get((low, high)))
    top, near = max(weight.values()), defaultdict(dict)
    for (a, b), w in weight.items():
        near[a][b] = near[b][a] = w / top
    out = {}
    for n, friends in near.items():
        total = sum((friends[x] * friends[y] * near[x][y]) ** (1 / 3)
                    for x, y in itertools.combinations(friends, 2) if y in near[x])
        d = len(friends)
        out[n] = 2 * total / (d * (d - 1)) if d > 1 else 0.0
    return out


def plain_components(edges):
    root = {n: n for n in members(edges)}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    tops = sorted({find(n) for n in root})
    return {n: tops.index(find(n)) for n in root}


def as_dict(df, value):
    return {r["id"]: r[value] for r in df.collect()}


@pytest.fixture(scope="module", params=[(1, 8, 14), (2, 12, 40), (3, 15, 17)])
def case(spark, request):
    edges = random_edges(*request.param)
    return edges, cut_lineage(frame(spark, edges))


def test_pagerank(case):
    edges, df = case
    assert as_dict(graph.pagerank(df), "pagerank") == pytest.approx(
        plain_pagerank(edges), abs=1e-12)
    assert as_dict(graph.pagerank(df, tol=None, max_iter=7), "pagerank") == pytest.approx(
        plain_pagerank(edges, tol=None, max_iter=7), abs=1e-12)


def test_pagerank_fails_without_convergence(case):
    with pytest.raises(RuntimeError):
        graph.pagerank(case[1], tol=1e-15, max_iter=3)


def test_betweenness(case):
    edges, df = case
    assert as_dict(graph.betweenness(df), "betweenness") == pytest.approx(
        plain_betweenness(edges), abs=1e-12)


def test_sampled_betweenness_is_scaled_and_repeatable(spark, case):
    edges, df = case
    sources = [r["source"] for r in graph.betweenness_sources(graph.nodes(df), 5, 1).collect()]
    assert len(sources) == 5
    assert as_dict(graph.betweenness(df, sources=5, seed=1), "betweenness") == pytest.approx(
        plain_betweenness(edges, sources), abs=1e-12)


@pytest.mark.parametrize("nodes,batches", [(30, 4), (150, 3)])
def test_betweenness_is_exact_in_batches(spark, nodes, batches):
    edges = random_edges(nodes, nodes, nodes * 3, span=9)
    count = len({n for pair in edges for n in pair})
    got = graph.betweenness(cut_lineage(frame(spark, edges)), state_rows=count * count // batches + 1)
    assert as_dict(got, "betweenness") == pytest.approx(plain_betweenness(edges), abs=1e-12)


def test_batches_leave_one_table_and_a_plan_of_constant_length(spark):
    folder = Path(graph.cut_lineage(spark.range(1)).contrail_path).parent
    edges = cut_lineage(frame(spark, random_edges(11, 12, 20)))
    before, plans, left = spark.conf.get("spark.sql.shuffle.partitions"), [], []
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for rows in (75, 25):
            held = set(folder.iterdir())
            result = graph.betweenness(edges, state_rows=rows)
            plans.append(len(result._jdf.queryExecution().analyzed().toString().split("\n")))
            left.append(len(set(folder.iterdir()) - held))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plans[0] == plans[1] and left == [1, 1]


def test_betweenness_rejects_weights_that_are_not_positive(spark):
    for weight in (0, -1):
        with pytest.raises(ValueError):
            graph.betweenness(frame(spark, {("a", "b"): weight, ("b", "a"): 3}))


def test_superseded_states_are_deleted(spark):
    import os

    base = spark.conf.get("spark.checkpoint.dir")

    def folders():
        return sum(len(d) for _, d, _ in os.walk(base))

    df = cut_lineage(frame(spark, random_edges(4, 20, 60)))
    before = folders()
    rows = graph.pagerank(df)
    # sums by source, moves, and the last state
    assert folders() - before <= 3 and rows.count() > 0


def test_clustering(case):
    edges, df = case
    assert as_dict(graph.clustering(df), "clustering") == pytest.approx(
        plain_clustering(edges), abs=1e-12)


def test_components(case):
    edges, df = case
    assert as_dict(graph.components(df), "community_id") == plain_components(edges)


def test_components_of_a_long_path_settle_quickly(spark, monkeypatch):
    rounds = []
    settled = graph._is_forest_of_stars
    monkeypatch.setattr(graph, "_is_forest_of_stars",
                        lambda df: rounds.append(1) or settled(df))
    names = [f"p{i:03d}" for i in range(120)]
    random.Random(5).shuffle(names)
    edges = {pair: 1 for pair in zip(names, names[1:])}
    edges["z1", "z2"] = 1
    got = as_dict(graph.components(frame(spark, edges)), "community_id")
    assert got == plain_components(edges)
    assert len(rounds) < 12


def test_degrees(case):
    edges, df = case
    for r in graph.weighted_degree(df).collect():
        assert r["in_degree_weighted"] == sum(w for (_, b), w in edges.items() if b == r["id"])
        assert r["out_degree_weighted"] == sum(w for (a, _), w in edges.items() if a == r["id"])
        assert r["total_degree_weighted"] == r["in_degree_weighted"] + r["out_degree_weighted"]


def test_numbers_are_consecutive_in_the_given_order(spark):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v // 3, v) for v in values], "score int, id int").repartition(7)
    rows = graph.number_rows(df, "n", F.col("score").desc(), F.col("id")).collect()
    expected = sorted(((v // 3, v) for v in values), key=lambda r: (-r[0], r[1]))
    assert [(r["score"], r["id"]) for r in sorted(rows, key=lambda r: r["n"])] == expected
    assert sorted(r["n"] for r in rows) == list(range(1, 1001))


def test_assembled_table(spark):
    edges = random_edges(9, 9, 20, span=50)
    connections = spark.createDataFrame(
        [(a, b, w) for (a, b), w in edges.items()],
        "origin_airport_id string, destination_airport_id string, flight_count bigint")
    rows = graph.airport_graph(connections, Settings()).collect()
    assert sorted(r["hub_rank"] for r in rows) == list(range(1, len(rows) + 1))
    ranks = plain_pagerank(edges)
    best = min(rows, key=lambda r: r["hub_rank"])
    assert ranks[best["airport_id"]] == pytest.approx(max(ranks.values()))
    assert {(r["graph_total_nodes"], r["graph_total_edges"]) for r in rows} == {
        (len(ranks), len(edges))}
    # an empty network has the same columns
    empty = graph.airport_graph(connections.limit(0))
    assert empty.schema.names == list(rows[0].asDict())
    assert empty.count() == 0


def test_only_waves_of_numbers_are_written(spark, monkeypatch):
    """Path sums write what moved, not all known rows again in every step."""
    chain = spark.createDataFrame([(0, i, i + 1) for i in range(7)], "source bigint, src bigint, dst bigint")
    start = spark.createDataFrame([(0, i, float(i == 0)) for i in range(8)], "source bigint, node bigint, value double")
    written = []

    def cut(df):
        written.append(cut_lineage(df))
        return written[-1]

    monkeypatch.setattr(graph, "cut_lineage", cut)
    monkeypatch.setattr(graph, "discard", lambda *tables: None)
    sums = {r["node"]: r["total"] for r in graph.path_sums(start, chain).collect()}
    assert sums == {0: 0.0, **dict.fromkeys(range(1, 8), 1.0)}
    assert all(df.count() <= 1 for df in written if "total" not in df.columns)


@pytest.mark.parametrize("cells,steps", [(1_000_000, 1_000_000), (70, 5), (1, 1)])
def test_betweenness_walks_blocks_of_sources(spark, monkeypatch, cells, steps):
    monkeypatch.setattr(graph, "BLOCK_CELLS", cells)
    monkeypatch.setattr(graph, "BLOCK_STEPS", steps)
    monkeypatch.setattr(graph, "TASK_STEPS", 200)
    for span in (1, 9, 4_000):
        edges = {**random_edges(12, 25, 90, span=span), ("x1", "x2"): 5, ("x2", "x3"): 1, ("x2", "x2"): 1}
        got = as_dict(graph.betweenness(cut_lineage(frame(spark, edges))), "betweenness")
        assert got == pytest.approx(plain_betweenness(edges), abs=1e-12)


def test_betweenness_does_not_write_every_step(spark, monkeypatch):
    """Tables do not follow the length of the paths."""
    written = []
    monkeypatch.setattr(graph, "cut_lineage", lambda df: written.append(1) or cut_lineage(df))
    names = [f"p{i:02d}" for i in range(30)]
    edges = {pair: 2 for pair in zip(names, names[1:])}
    got = as_dict(graph.betweenness(frame(spark, edges)), "betweenness")
    assert got == pytest.approx(plain_betweenness(edges), abs=1e-12)
    assert len(written) <= 6


def test_betweenness_of_a_graph_beyond_one_task(spark, monkeypatch):
    """The state is a table then, in batches."""
    monkeypatch.setattr(graph, "TASK_EDGES", 10)
    folder = Path(graph.cut_lineage(spark.range(1)).contrail_path).parent
    edges = random_edges(14, 12, 30)
    df, held = cut_lineage(frame(spark, edges)), set(folder.iterdir())
    got = graph.betweenness(df, state_rows=80)
    # the edges, and the result
    assert as_dict(got, "betweenness") == pytest.approx(plain_betweenness(edges), abs=1e-12)
    assert len(set(folder.iterdir()) - held) == 1


@pytest.mark.parametrize("most", [graph.TASK_EDGES, 0])
def test_edges_without_weight_lead_nowhere(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "TASK_EDGES", most)
    edges = {("a", "b"): 1, ("b", "c"): 1, ("c", "d"): None}
    got = as_dict(graph.betweenness(frame(spark, edges)), "betweenness")
    assert got == {"a": 0.0, "b": pytest.approx(1 / 6), "c": 0.0, "d": 0.0}
