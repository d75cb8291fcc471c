"""Metrics of the airport network as iterative DataFrame jobs.

Graphs are edge rows ``(src, dst, weight)``; node results are keyed by ``id``.
Iterations follow one pattern: a step is a single join and a single aggregation,
in which one "stay" row per node carries its own values along. A step refers to
its input once, so several steps are chained into one job before the state is
checkpointed, and the driver reads only a few scalars per job. Betweenness is the
exception: tasks walk the whole graph from their share of the sources, as long as its edges
fit into a task. Beyond that its state is a table, every step of which is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.config import Settings
from contrail.functions import numeric
from contrail.session import backed_by, cut_lineage, discard

# Steps chained per job: fewer jobs against longer plans.
STEPS_PER_JOB = 5
# Decimals at which two scores, scaled to a mean of 1, count as equal when ranked.
RANK_DIGITS = 9
# Edges of a graph that every task of betweenness may hold, 24 bytes each.
TASK_EDGES = 4_000_000
# Edges that one such task follows, about, if all nodes are in reach; tasks at most.
TASK_STEPS, MAX_TASKS = 5_000_000, 512
# (source, node) cells and edges that a task works on at a time, about.
BLOCK_CELLS, BLOCK_STEPS = 1_000_000, 1_000_000
# (source, node) rows that betweenness of larger graphs works on at a time, about.
STATE_ROWS = 20_000_000


# --- edges and nodes -----------------------------------------------------

def edges_from_connections(connections: DataFrame) -> DataFrame:
    """One weighted edge per airport pair; of several rows for a pair the largest counts."""
    return (connections
            .groupBy(F.col("origin_airport_id").alias("src"),
                     F.col("destination_airport_id").alias("dst"))
            .agg(F.max("flight_count").cast("bigint").alias("weight")))


def nodes(edges: DataFrame) -> DataFrame:
    return (edges.select(F.explode(F.array("src", "dst")).alias("id"))).distinct()


def graph_size(edges: DataFrame) -> tuple[int, int]:
    """Number of nodes and of edges."""
    return nodes(edges).count(), edges.count()


def weighted_degree(edges: DataFrame) -> DataFrame:
    """Sums of edge weights per node: an edge adds to the out side of its source
    and to the in side of its destination, so one aggregation serves both."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).cast("bigint").alias("incoming"),
                 F.col("weight").alias("outgoing")),
        F.struct(F.col("dst").alias("id"), F.col("weight").alias("incoming"),
                 F.lit(0).cast("bigint").alias("outgoing")))).alias("end")).select("end.*")
    return ends.groupBy("id").agg(
        F.sum("incoming").alias("in_degree_weighted"),
        F.sum("outgoing").alias("out_degree_weighted"),
        (F.sum("incoming") + F.sum("outgoing")).alias("total_degree_weighted"))


# --- global order --------------------------------------------------------

def number_rows(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Consecutive numbers from 1 in a total order, without one task seeing all rows.

    Rows are range partitioned, numbered inside their partition and shifted by
    the sizes of the partitions before; only those sizes (one row per partition)
    are summed up in sequence.
    """
    ranged = cut_lineage(df.repartitionByRange(*order)
                         .withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return backed_by(ranged.withColumn("_local", local)
                     .join(starts, "_part")
                     .withColumn(name, (F.col("_start") + F.col("_local")).cast("bigint"))
                     .drop("_part", "_local", "_start"), ranged)


# --- PageRank ------------------------------------------------------------

def pagerank(edges: DataFrame, alpha: float = 0.85, tol: float | None = 1e-6,
             max_iter: int = 100) -> DataFrame:
    """Weighted PageRank by power iteration from equal scores.

    Stops at the first iteration whose total change is below ``nodes * tol`` and
    fails after ``max_iter`` ones; without ``tol`` it makes exactly ``max_iter``
    iterations.

    An iteration moves scores along edges (T), gives every node an even part u
    of the constant share and spreads the score lost at nodes without outgoing
    edges evenly, too. Without such nodes the steps simply follow each other.
    With them the lost score would be needed before each step; as T is linear,
    the steps are made without it and the job's result is corrected by multiples
    of T^j u, whose factors follow from sums over the stored columns.
    """
    # written sums have a known size and let adaptive execution split a hub's edges
    out = cut_lineage(edges.groupBy("src").agg(F.sum("weight").alias("out_weight")))
    start = cut_lineage(
        nodes(edges).join(out, F.col("id") == F.col("src"), "left")
        .select("id", F.col("out_weight").isNull().cast("double").alias("dangling")))
    count, dangling = start.agg(F.count(F.lit(1)), F.sum("dangling")).first()
    if not count:
        return start.select("id", F.lit(0.0).alias("pagerank"))
    moves = edges.join(out, "src").select(
        "src", "dst", (F.lit(alpha) * F.col("weight") / F.col("out_weight")).alias("share"),
        F.lit(0.0).alias("stay"))
    stays = start.select(F.col("id").alias("src"), F.col("id").alias("dst"),
                         F.lit(0.0).alias("share"), F.lit(1.0).alias("stay"))
    moves = cut_lineage(moves.unionByName(stays))

    # columns: q0..qn the scores after 0..n steps, even0.. the vectors T^j u
    state = start.withColumn("q0", F.lit(1.0 / count))
    written = start
    carried = ["dangling"] if dangling else []
    done = 0
    while done < max_iter:
        steps = min(STEPS_PER_JOB, max_iter - done)
        for k in range(steps):
            kept = [*carried, *[f"q{j}" for j in range(k + 1)]]
            moved = F.sum(F.col("share") * F.col(f"q{k}")) + F.lit((1.0 - alpha) / count)
            state = (state.join(moves, F.col("id") == F.col("src"))
                     .groupBy(F.col("dst").alias("id"))
                     .agg(*[F.sum(F.col("stay") * F.col(c)).alias(c) for c in kept],
                          moved.alias(f"q{k + 1}")))
        before, state = written, cut_lineage(state)
        written = state
        discard(before)
        scores = [F.col(f"q{k}") for k in range(steps + 1)]
        if dangling:
            if done == 0:
                state, evens = _even_vectors(state, alpha, steps)
                carried = ["dangling", *evens]
            scores = _with_lost_scores(state, alpha, scores, carried[1:])
        changes = state.agg(*[F.sum(F.abs(after - before))
                              for before, after in zip(scores, scores[1:])]).first()
        done += steps
        if tol is not None:
            for score, change in zip(scores[1:], changes):
                if change < count * tol:
                    return state.select("id", score.alias("pagerank"))
        state = state.select("id", *carried, scores[-1].alias("q0"))
    if tol is not None:
        raise RuntimeError(f"PageRank did not settle within {max_iter} iterations")
    return state.select("id", F.col("q0").alias("pagerank"))


def _even_vectors(state: DataFrame, alpha: float, steps: int) -> tuple[DataFrame, list[str]]:
    """T^j u from the first job, which started at u and added u's part in each step:
    T^j u = q_j - (1 - alpha) * (q_(j-1) + alpha q_(j-2) + alpha^2 q_(j-3) + ...)."""
    vectors = []
    for j in range(steps):
        vector = F.col(f"q{j}")
        for i in range(1, j + 1):
            vector = vector - F.lit((1.0 - alpha) * alpha ** (i - 1)) * F.col(f"q{j - i}")
        vectors.append(vector.alias(f"even{j}"))
    return state.select("*", *vectors), [f"even{j}" for j in range(steps)]


def _with_lost_scores(state: DataFrame, alpha: float, scores: list[Column],
                      evens: list[str]) -> list[Column]:
    """Add what each step should have received from nodes without outgoing edges."""
    steps = len(scores) - 1
    lost_columns = [*[f"q{k}" for k in range(steps)], *evens]
    sums = state.agg(*[F.sum(F.col("dangling") * F.col(c)).alias(c)
                       for c in lost_columns]).first()
    factors: list[float] = []
    corrected = [scores[0]]
    for k in range(steps):
        lost = sums[f"q{k}"] + sum(factors[k - 1 - j] * sums[evens[j]] for j in range(k))
        factors.append(alpha * lost)
        score = scores[k + 1]
        for j in range(k + 1):
            score = score + F.lit(factors[k - j]) * F.col(evens[j])
        corrected.append(score)
    return corrected


# --- connected components ------------------------------------------------

def component_roots(edges: DataFrame) -> DataFrame:
    """Smallest member id of each node's weakly connected component.

    Alternating large-star and small-star steps (Kiveris et al., 2014), which
    settle in a number of rounds that grows with the logarithm of the graph, not
    with its diameter.
    """
    linked = cut_lineage(
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("high"), F.least("src", "dst").alias("low"))
        .distinct())
    if linked.isEmpty():
        discard(linked)
        return nodes(edges).select("id", F.col("id").alias("root"))
    while True:
        before, (wide, least) = linked, _large_star(linked)
        wide = cut_lineage(wide)
        linked, below = _small_star(wide)
        linked = cut_lineage(linked)
        discard(before, wide, least, below)
        if _is_forest_of_stars(linked):
            break
    rooted = (nodes(edges).join(linked, F.col("id") == F.col("high"), "left")
              .select("id", F.coalesce("low", "id").alias("root")))
    return backed_by(rooted, linked)


def _large_star(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Link every larger neighbour of a node to the smallest of its neighbourhood.

    Also returns the written table that the links are read with.
    """
    both = linked.select(F.explode(F.array(
        F.struct(F.col("high").alias("node"), F.col("low").alias("other")),
        F.struct(F.col("low").alias("node"), F.col("high").alias("other")))).alias("e")
    ).select("e.*")
    # written before it is joined back, so that a hub's rows can be split
    smallest = cut_lineage(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("target")))
    links = (both.filter(F.col("other") > F.col("node")).join(smallest, "node")
             .select(F.col("other").alias("high"), F.col("target").alias("low")).distinct())
    return links, smallest


def _small_star(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Link a node and its smaller neighbours to the smallest of them.

    Also returns the written table that the links are read with.
    """
    smallest = cut_lineage(linked.groupBy("high").agg(F.min("low").alias("target")))
    moved = (linked.join(smallest, "high").filter(F.col("low") != F.col("target"))
             .select(F.col("low").alias("high"), F.col("target").alias("low")))
    return moved.unionByName(smallest.withColumnRenamed("target", "low")).distinct(), smallest


def _is_forest_of_stars(linked: DataFrame) -> bool:
    """Every node has one parent and no parent has a parent itself."""
    parents = linked.select(F.col("low").alias("id"), F.lit(0).alias("as_child"),
                            F.lit(1).alias("as_parent"))
    children = linked.select(F.col("high").alias("id"), F.lit(1).alias("as_child"),
                             F.lit(0).alias("as_parent"))
    roles = parents.unionByName(children).groupBy("id").agg(
        F.sum("as_child").alias("as_child"), F.max("as_parent").alias("as_parent"))
    return roles.filter((F.col("as_child") > 1)
                        | ((F.col("as_child") > 0) & (F.col("as_parent") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Components numbered from 0 by their smallest member id."""
    rooted = cut_lineage(component_roots(edges))
    numbered = number_rows(rooted.select("root").distinct(), "_number", F.col("root"))
    return rooted.join(numbered, "root").select(
        "id", (F.col("_number") - 1).alias("community_id"))


# --- clustering ----------------------------------------------------------

def undirected(edges: DataFrame) -> DataFrame:
    """One row per linked pair; with edges both ways the one from the larger id counts."""
    backward = F.max(F.when(F.col("src") > F.col("dst"), F.col("weight")))
    return (edges.filter(F.col("src") != F.col("dst"))
            .groupBy(F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high"))
            .agg(F.coalesce(backward, F.max("weight")).alias("weight")))


def clustering(edges: DataFrame) -> DataFrame:
    """Weighted clustering coefficient (geometric mean of scaled triangle weights).

    Pairs are directed from the end with fewer neighbours to the one with more,
    which bounds the out-degree of every node, a hub included, by the square
    root of twice the number of pairs; triangles are found by extending a pair
    at its far end and looking up the closing pair.
    """
    pairs = cut_lineage(undirected(edges))
    heaviest = pairs.agg(F.max("weight")).first()[0]
    degree = cut_lineage(
        pairs.select(F.explode(F.array("low", "high")).alias("id"))
        .groupBy("id").agg(F.count(F.lit(1)).alias("degree")))
    low, high = (degree.select(F.col("id").alias(side), F.col("degree").alias(f"{side}_degree"))
                 for side in ("low", "high"))
    upward = F.struct("low_degree", "low") < F.struct("high_degree", "high")
    directed = cut_lineage(
        pairs.join(low, "low").join(high, "high").select(
            F.when(upward, F.col("low")).otherwise(F.col("high")).alias("tail"),
            F.when(upward, F.col("high")).otherwise(F.col("low")).alias("head"),
            (F.col("weight") / F.lit(float(heaviest or 1))).alias("scaled")))

    first = directed.select(F.col("tail").alias("a"), F.col("head").alias("b"),
                            F.col("scaled").alias("ab"))
    second = directed.select(F.col("tail").alias("b"), F.col("head").alias("c"),
                             F.col("scaled").alias("bc"))
    closing = directed.select(F.col("tail").alias("a"), F.col("head").alias("c"),
                              F.col("scaled").alias("ac"))
    triangles = first.join(second, "b").join(closing, ["a", "c"]).select(
        F.explode(F.array("a", "b", "c")).alias("id"),
        F.cbrt(F.col("ab") * F.col("bc") * F.col("ac")).alias("intensity"))
    sums = triangles.groupBy("id").agg(F.sum("intensity").alias("intensity"))
    possible = F.col("degree") * (F.col("degree") - 1)
    return degree.join(sums, "id", "left").select(
        "id", F.when(F.col("intensity").isNotNull(), F.lit(2.0) * F.col("intensity") / possible)
        .otherwise(F.lit(0.0)).alias("clustering"))


# --- betweenness ---------------------------------------------------------

def betweenness_sources(all_nodes: DataFrame, k: int, seed: int) -> DataFrame:
    """``k`` nodes in the order of a seeded hash, for an approximation."""
    return (all_nodes.orderBy(F.xxhash64(F.lit(seed), F.col("id")), F.col("id"))
            .limit(k).select(F.col("id").alias("source")))


def shortest_distances(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Length of the shortest path from each source to each node it reaches.

    Rows that the last step improved are the frontier: they alone go along edges, and
    what they reach is merged with the rows known so far. Distances are relaxed until
    the frontier is empty. Every step is written, so it costs one grouping of the state
    and its tasks follow the size that the state has by then.
    """
    hops = edges.select("src", "dst", F.col("weight").alias("cost"))
    state = sources.select("source", F.col("source").alias("node"),
                           F.lit(0).cast("bigint").alias("distance"), F.lit(True).alias("moving"))
    while True:
        before = state
        reached = state.filter("moving").join(hops, F.col("node") == F.col("src")).select(
            "source", F.col("dst").alias("node"), (F.col("distance") + F.col("cost")).alias("distance"),
            F.lit(None).cast("bigint").alias("known"))
        state = cut_lineage(
            state.select("source", "node", "distance", F.col("distance").alias("known"))
            .unionByName(reached).groupBy("source", "node")
            .agg(F.min("distance").alias("distance"), F.max("known").alias("known"))
            .select("source", "node", "distance",
                    (F.col("known").isNull() | (F.col("known") != F.col("distance"))).alias("moving")))
        discard(before)
        if state.filter("moving").isEmpty():
            return backed_by(state.select("source", "node", "distance"), state)


def path_sums(start: DataFrame, hops: DataFrame) -> DataFrame:
    """Sum of the start values over all paths of at least one hop that end in a node.

    ``start`` holds (source, node, value) for every node in reach and ``hops``
    the acyclic (source, src, dst) steps. Values move one hop per step, and only the
    wave is written: what arrived is added up every few steps. The wave dies out
    because paths are finite.
    """
    steps = hops.select(F.col("source").alias("of"), "src", "dst")
    total = start.select("source", "node", F.lit(0.0).alias("total"))
    wave = start.filter(F.col("value") > 0).select("source", "node", "value")
    counted, waves = wave, []
    while True:
        wave = cut_lineage(
            wave.join(steps, (F.col("source") == F.col("of")) & (F.col("node") == F.col("src")))
            .groupBy("source", F.col("dst").alias("node")).agg(F.sum("value").alias("value")))
        waves.append(wave)
        ended = wave.isEmpty()
        if ended or len(waves) == STEPS_PER_JOB:
            before, arrived = total, total
            for w in waves:
                arrived = arrived.unionByName(w.withColumnRenamed("value", "total"))
            total = cut_lineage(arrived.groupBy("source", "node").agg(F.sum("total").alias("total")))
            discard(before, counted, *(waves if ended else waves[:-1]))
            if ended:
                return total
            # the last wave still moves on
            counted, waves = wave, []


def betweenness(edges: DataFrame, sources: int | None = None, seed: int = 42,
                state_rows: int = STATE_ROWS) -> DataFrame:
    """Share of shortest paths through each node, weights taken as lengths.

    Exact at any size. Up to ``TASK_EDGES`` edges every task holds the graph and walks it
    from its share of the sources. Beyond that the state is a table of (source, node), so
    sources are worked in batches of about ``state_rows`` such rows. What a source can reach
    at most is its weakly connected component, which is what batches are sized by. Each batch
    is added to one table of running sums, then its tables are deleted.
    A number of ``sources`` asks for an approximation from so many nodes, scaled
    up by their share. Weights have to be positive; an edge without one leads nowhere.
    """
    if not edges.filter(~(F.col("weight") > 0)).isEmpty():
        raise ValueError("betweenness needs positive weights")
    # numbers instead of names: rows of the state are three numbers
    numbered = number_rows(nodes(edges), "number", F.col("id"))
    all_nodes = cut_lineage(numbered)
    discard(numbered)
    count = all_nodes.count()
    ends = [all_nodes.select(F.col("id").alias(e), F.col("number").alias(f"_{e}")) for e in ("src", "dst")]
    links = cut_lineage(edges.filter("weight is not null").join(ends[0], "src").join(ends[1], "dst").select(
        F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight"))
    chosen = (all_nodes if sources is None else all_nodes.join(
        betweenness_sources(all_nodes, sources, seed), F.col("id") == F.col("source"))
        ).select(F.col("number").alias("source"))
    used = count if sources is None else min(sources, count)
    size = links.count()
    if size <= TASK_EDGES:
        total = _totals_by_walks(links, chosen, count, min(MAX_TASKS, used, -(-used * size // TASK_STEPS)))
    else:
        total = _totals_by_joins(links, chosen, used, count, state_rows)
    scale = count / max(used, 1)
    if count > 2:
        scale /= (count - 1) * (count - 2)
    result = cut_lineage(all_nodes.join(total.withColumnRenamed("id", "number"), "number", "left").select(
        "id", F.coalesce(F.col("through") * F.lit(scale), F.lit(0.0)).alias("betweenness")))
    discard(all_nodes, links, total)
    return result


class Links(NamedTuple):
    """Edges by source: those of node i are numbers first[i] to first[i + 1] of the others."""

    first: np.ndarray
    dst: np.ndarray
    weight: np.ndarray


def _totals_by_walks(links: DataFrame, chosen: DataFrame, count: int, tasks: int) -> DataFrame:
    """Sums per node over all sources, which tasks share; each holds the edges."""
    context = links.sparkSession.sparkContext
    shared = context.broadcast(_sorted_links(links, count))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph, through = shared.value, np.zeros(count)
        width = max(1, BLOCK_CELLS // max(1, count))
        for batch in batches:
            sources = batch["source"].to_numpy() - 1
            for at in range(0, len(sources), width):
                through += dependencies(graph, sources[at:at + width])
        found = np.flatnonzero(through)
        yield pd.DataFrame({"id": found + 1, "through": through[found]})

    # a given number of partitions, as adaptive execution would make one of rows this small
    walked = chosen.repartition(max(1, tasks)).mapInPandas(run, "id bigint, through double")
    total = cut_lineage(walked.groupBy("id").agg(F.sum("through").alias("through")))
    shared.destroy()
    return total


def _sorted_links(links: DataFrame, count: int) -> Links:
    table = links.toArrow()
    src, dst, weight = (table.column(c).to_numpy() for c in ("src", "dst", "weight"))
    order = np.argsort(src, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(src - 1, minlength=count))]).astype(np.int64)
    return Links(first, (dst[order] - 1).astype(np.int64), weight[order])


def dependencies(graph: Links, sources: np.ndarray) -> np.ndarray:
    """Shares of the shortest paths from the sources that lead through each node, added up.

    Brandes' algorithm for all these sources at once; a cell is a node as seen from one of them.
    """
    count = len(graph.first) - 1
    origins = np.arange(len(sources)) * count + sources
    u, v = _tight_cells(graph, origins, _cell_distances(graph, origins))
    cells = len(sources) * count
    first = np.concatenate([[0], np.cumsum(np.bincount(u, minlength=cells))])
    waiting = np.bincount(v, minlength=cells)
    owner = np.empty(cells, dtype=np.int64)
    # a cell's paths are complete as soon as all tight edges into it were followed
    paths, levels, complete = np.zeros(cells), [], origins
    paths[origins] = 1.0
    while complete.size:
        at = _spans(first[complete], first[complete + 1])
        into = v[at]
        np.add.at(paths, into, paths[u[at]])
        np.subtract.at(waiting, into, 1)
        levels.append(at)
        complete = _distinct(into[waiting[into] == 0], owner)
    share = np.zeros(cells)
    for at in reversed(levels):
        np.add.at(share, u[at], paths[u[at]] / paths[v[at]] * (1.0 + share[v[at]]))
    share[origins] = 0.0
    return share.reshape(len(sources), count).sum(axis=0)


def _cell_distances(graph: Links, origins: np.ndarray) -> np.ndarray:
    """Length of the shortest path to each cell, the largest value where there is none.

    Cells wait until they are among the nearest, within a step that keeps rounds few; with
    steps of the smallest weight each would be followed once.
    """
    count = len(graph.first) - 1
    whole = np.issubdtype(graph.weight.dtype, np.integer)
    far = np.iinfo(np.int64).max if whole else np.inf
    distance = np.full(len(origins) * count, far, dtype=np.int64 if whole else float)
    distance[origins] = 0
    owner = np.empty(len(distance), dtype=np.int64)
    step = max(graph.weight.min(), graph.weight.mean() / 4) if graph.weight.size else 1
    pending = origins
    while pending.size:
        known = distance[pending]
        near = known < known.min() + step
        moved, pending = pending[near], [pending[~near]]
        for cells, edges in _followed(graph, moved):
            into = cells - cells % count + graph.dst[edges]
            length = distance[cells] + graph.weight[edges]
            better = length < distance[into]
            into = into[better]
            np.minimum.at(distance, into, length[better])
            pending.append(into)
        pending = _distinct(np.concatenate(pending), owner)
    return distance


def _tight_cells(graph: Links, origins: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the edges on shortest paths, in the order of the first."""
    count = len(graph.first) - 1
    far = np.iinfo(np.int64).max if distance.dtype == np.int64 else np.inf
    tails, heads = [origins[:0]], [origins[:0]]
    for cells, edges in _followed(graph, np.flatnonzero(distance < far)):
        into = cells - cells % count + graph.dst[edges]
        tight = distance[cells] + graph.weight[edges] == distance[into]
        tails.append(cells[tight])
        heads.append(into[tight])
    return np.concatenate(tails), np.concatenate(heads)


def _followed(graph: Links, cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells, once per edge that leaves their node, and these edges, about BLOCK_STEPS at a time."""
    node = cells % (len(graph.first) - 1)
    start, end = graph.first[node], graph.first[node + 1]
    total = np.cumsum(end - start)
    cuts = np.searchsorted(total, np.arange(BLOCK_STEPS, total[-1] if total.size else 0, BLOCK_STEPS))
    for low, high in zip([0, *cuts], [*cuts, len(cells)]):
        if low < high:
            yield (np.repeat(cells[low:high], (end - start)[low:high]), _spans(start[low:high], end[low:high]))


def _spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end, one span after the other."""
    width = end - start
    return np.arange(width.sum()) + np.repeat(start - np.cumsum(width) + width, width)


def _distinct(cells: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Each cell once; ``owner`` is scratch space for every cell."""
    place = np.arange(len(cells))
    owner[cells] = place
    return cells[owner[cells] == place]


def _totals_by_joins(links: DataFrame, chosen: DataFrame, used: int, count: int, state_rows: int) -> DataFrame:
    """Sums per node over all sources in batches of bounded state."""
    # one batch is enough if all nodes in reach of all sources are
    rows = used * count if used * count <= state_rows else _reach_rows(links, chosen)
    batches = max(1, -(-rows // state_rows))
    total = None
    for batch in range(batches):
        part = chosen.filter(F.pmod(F.xxhash64("source"), F.lit(batches)) == batch)
        through, scratch = _through_nodes(links, part)
        before = total
        if before is not None:
            through = before.unionByName(through)
        total = cut_lineage(through.groupBy("id").agg(F.sum("through").alias("through")))
        discard(*scratch, *([] if before is None else [before]))
    return total


def _reach_rows(edges: DataFrame, sources: DataFrame) -> int:
    """How many (source, node) pairs lie in one weakly connected component."""
    roots = component_roots(edges)
    rooted = cut_lineage(roots)
    discard(roots)
    sizes = rooted.groupBy("root").agg(F.count("*").alias("n"))
    chosen = (sources.join(rooted, F.col("source") == F.col("id"))
              .groupBy("root").agg(F.count("*").alias("sources")))
    rows = sizes.join(chosen, "root").agg(F.sum(F.col("n") * F.col("sources"))).first()[0] or 0
    discard(rooted)
    return rows


def _through_nodes(edges: DataFrame, sources: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Dependencies of the given sources on every node, and the tables they are read from."""
    reach = shortest_distances(edges, sources)
    near = reach.select("source", F.col("node").alias("src"), F.col("distance").alias("near"))
    far = reach.select("source", F.col("node").alias("dst"), F.col("distance").alias("far"))
    tight = cut_lineage(
        near.join(edges, "src")
        .withColumn("far", F.col("near") + F.col("weight"))
        .join(far, ["source", "dst", "far"])
        .select("source", "src", "dst"))

    origin = reach.select("source", "node", (F.col("node") == F.col("source")).cast("double")
                          .alias("value"))
    arrived = path_sums(origin, tight)
    paths = cut_lineage(
        origin.join(arrived, ["source", "node"])
        .select("source", "node", (F.col("value") + F.col("total")).alias("paths")))
    # dependency(u) / paths(u) is the sum of 1 / paths(v) over all paths u -> v
    backward = tight.select("source", F.col("dst").alias("src"), F.col("src").alias("dst"))
    inverse = paths.select("source", "node", (F.lit(1.0) / F.col("paths")).alias("value"))
    shares = path_sums(inverse, backward)
    through = (paths.join(shares, ["source", "node"])
               .filter(F.col("node") != F.col("source"))
               .groupBy(F.col("node").alias("id"))
               .agg(F.sum(F.col("paths") * F.col("total")).alias("through")))
    return through, [reach, tight, arrived, paths, shares]


# --- the assembled table -------------------------------------------------

def airport_graph(connections: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All graph metrics per airport with a rank by PageRank."""
    edges = cut_lineage(edges_from_connections(connections))
    node_count, edge_count = graph_size(edges)
    merged = (
        weighted_degree(edges)
        .join(pagerank(edges, settings.pagerank_alpha, settings.pagerank_tol,
                       settings.pagerank_max_iter), "id")
        .join(betweenness(edges, settings.betweenness_sources, settings.betweenness_seed), "id")
        .join(clustering(edges), "id", "left")
        .join(components(edges), "id"))
    ranked = number_rows(merged, "hub_rank",
                         numeric.sql_round(F.col("pagerank") * node_count, RANK_DIGITS).desc(), F.col("id"))
    return ranked.select(
        F.col("id").alias("airport_id"),
        numeric.even_round(F.col("pagerank"), 6).alias("pagerank_score"),
        "in_degree_weighted", "out_degree_weighted", "total_degree_weighted",
        numeric.even_round(F.col("betweenness"), 6).alias("betweenness_centrality"),
        numeric.even_round(F.coalesce("clustering", F.lit(0.0)), 6)
        .alias("clustering_coefficient"),
        "community_id", "hub_rank",
        F.lit(node_count).cast("bigint").alias("graph_total_nodes"),
        F.lit(edge_count).cast("bigint").alias("graph_total_edges"))
