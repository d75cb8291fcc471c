"""Connected components of link tables that do not fit into one task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import cut_lineage, discard

# edges a task contracts at a time
CHUNK = 500_000


class Forest:
    """Union-find in which the smaller member stands for both."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def join(self, a, b) -> bool:
        """Whether ``a`` and ``b`` were apart until now."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.parent[high] = low
        self.parent.setdefault(low, low)
        return True


def _contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of a task as stars: every member with the smallest one it is joined to here."""
    def stars(forest: Forest) -> pd.DataFrame:
        rows = [(x, forest.root(x)) for x in forest.parent]
        return pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["high", "low"])

    forest, held = Forest(), 0
    for batch in batches:
        for a, b in zip(batch["src"], batch["dst"]):
            if a != b:
                forest.join(a, b)
        held += len(batch)
        if held >= CHUNK:
            yield stars(forest)
            forest, held = Forest(), 0
    yield stars(forest)


def smallest_members(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges`` (src, dst): the smallest id it is connected with.

    Tasks contract their own edges to stars; large-star and small-star steps
    (Kiveris et al., 2014) join those until nothing changes. Ids with loops only
    are left out. Ids may be of any ordered type but not null.
    """
    kind = edges.schema["src"].dataType.simpleString()
    linked = cut_lineage(edges.select("src", "dst").mapInPandas(_contracted, f"high {kind}, low {kind}").distinct())
    state = _state(linked)
    while state[0]:
        before = linked
        both = before.select("high", "low").unionByName(
            before.select(F.col("low").alias("high"), F.col("high").alias("low")))
        # sums are written before they are joined back, so that the rows of a hub can be split
        least = cut_lineage(both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("m"))
                            .select("node", F.least("node", "m").alias("m")))
        wide = cut_lineage(before.join(least, F.col("low") == F.col("node")).select("high", F.col("m").alias("low"))
                           .unionByName(least.where("m < node").select(F.col("node").alias("high"), F.col("m").alias("low")))
                           .distinct())
        below = cut_lineage(wide.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("m")))
        linked = cut_lineage(
            wide.join(below, F.col("high") == F.col("node")).where("low > m")
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
            .unionByName(below.select(F.col("node").alias("high"), F.col("m").alias("low"))).distinct())
        discard(before, least, wide, below)
        state, last = _state(linked), state
        if state == last:
            break
    stars = linked.select(F.col("high").alias("id"), F.col("low").alias("root"))
    return stars.unionByName(linked.select(F.col("low").alias("id"), F.col("low").alias("root")).distinct())


def _state(linked: DataFrame) -> tuple:
    """Number and fingerprint of the edges."""
    return tuple(linked.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())
