"""Near duplicates among embeddings by spherical k-means cells and blocked cosine products.

1. Vectors are checked and brought to length 1; equal ones (same label, same numbers)
   are one from here on, with the number of rows that hold it.
2. Labels with more than ``CELL`` distinct vectors get spherical k-means centroids,
   fitted on a bounded sample, one per ``CELL`` vectors. Smaller labels are one cell.
3. Every vector lives in the cell of its closest centroid and visits each cell whose
   border is near. Two vectors at the threshold are at most the chord
   sqrt(2 - 2 * threshold) apart; if a border separates them, one of the two is within
   half a chord of it. So with the full margin no link is lost, whatever the centroids
   are. A smaller ``margin`` visits fewer cells and may lose links across borders.
4. A cell is dealt into blocks of bounded size; one task multiplies one block with a
   bounded part of the cell's other blocks and visitors. It reports link counts per
   vector and a spanning forest of the links, never pairs. A pair that meets in both
   vectors' cells counts in the lower one.
5. Connected components of the forests; the smallest id of each stands for it.

Sample and sizes decide how much work is done, never which links are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.components import smallest_members
from contrail.session import cut_lineage, discard

THRESHOLD = 0.93
# distinct vectors per cell that the number of centroids aims at
CELL = 2048
# centroids of one label, and the vectors per centroid that they are fitted on
MAX_CENTROIDS = 1024
SAMPLE_PER_CENTROID = 48
ROUNDS = 8
# vectors in one block; blocks that one task compares with one block
BLOCK = 2048
BLOCKS_PER_TASK = 8
# vectors of one label that are assigned to cells in one group
ASSIGNED = 65_536

_KEY = ["label", "dim"]


# --- 1. unit vectors -----------------------------------------------------

def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gids, dims, units = [], [], []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector")):
            x = None
            if label is not None and vector.is_valid and not vector.values.null_count:
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                # the largest component comes first, so that squares stay finite
                top = np.abs(x).max(initial=0.0)
                x = x / top if 0 < top < np.inf else None
            if x is None:
                gids.append(None), dims.append(None), units.append(None)
                continue
            data = (x / np.sqrt(x @ x)).tobytes()
            gids.append(hashlib.md5(f"{label}:".encode() + vector.values.to_numpy().tobytes()).digest())
            dims.append(len(x))
            units.append(data)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()),
             pa.array(gids, pa.binary()), pa.array(units, pa.binary())],
            names=["vec_id", "label", "dim", "gid", "unit"])


def _matrix(units, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(-1, dim)


# --- 2. and 3. cells -----------------------------------------------------

def spherical_kmeans(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """``k`` unit centroids of the unit rows of ``x``; k is at most their number."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = x @ c.T
        cell = near.argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, cell, x)
        norms = np.sqrt((sums * sums).sum(1))
        empty = norms < 1e-9
        # a cell without vectors restarts at one of the vectors farthest from their centroids
        far = np.argsort(near.max(1), kind="stable")[:int(empty.sum())]
        c = sums / np.where(empty, 1, norms)[:, None]
        c[empty] = x[far]
    return c


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("gid")
    x = _matrix(rows["unit"], rows["dim"].iat[0])
    k = min(int(rows["k"].iat[0]), len(x))
    return pd.DataFrame({"label": rows["label"].iloc[:1], "dim": rows["dim"].iloc[:1],
                         "centroids": [spherical_kmeans(x, k).tobytes()]})


def _assigned(margin: float):
    def run(vectors: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        out = vectors[["label", "dim", "gid", "mult", "unit"]].copy()
        if fitted.empty or vectors.empty:
            return out.assign(home=0, visits=[[] for _ in range(len(out))])
        dim = int(vectors["dim"].iat[0])
        c = np.frombuffer(fitted["centroids"].iat[0], np.float64).reshape(-1, dim)
        apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
        home, visits = [], []
        for at in range(0, len(out), 1024):
            near = _matrix(out["unit"].iloc[at:at + 1024], dim) @ c.T
            own = near.argmax(1)
            # distance to the border between two cells, times the distance of the centroids
            open_ = near.max(1)[:, None] - near <= margin * apart[own] + 1e-9
            open_[np.arange(len(own)), own] = False
            home += own.tolist()
            visits += [np.flatnonzero(v).tolist() for v in open_]
        return out.assign(home=home, visits=visits)
    return run


def assign_cells(distinct: DataFrame, threshold: float, margin: float | None) -> DataFrame:
    """``distinct`` (label, dim, gid, mult, unit) with its home cell and the cells it visits."""
    half_chord = float(np.sqrt((1 - threshold) / 2))
    sizes = cut_lineage(distinct.groupBy(*_KEY).agg(F.count("*").alias("n")).where(F.col("n") > CELL)
                        .withColumn("k", F.least(F.ceil(F.col("n") / CELL), F.lit(MAX_CENTROIDS)).cast("int"))
                        .withColumn("parts", F.ceil(F.col("n") / ASSIGNED).cast("int")))
    # the share of hashes that gives about SAMPLE_PER_CENTROID vectors a centroid
    taken = F.pmod(F.xxhash64("gid"), F.lit(1 << 20)) < F.col("k") * SAMPLE_PER_CENTROID * (1 << 20) / F.col("n")
    fitted = cut_lineage(
        distinct.join(sizes.select(*_KEY, "n", "k"), _KEY).where(taken).select(*_KEY, "gid", "unit", "k")
        .groupBy(*_KEY).applyInPandas(_fitted, distinct.select(*_KEY).schema.simpleString()[7:-1] + ", centroids binary"))
    placed = distinct.join(sizes.select(*_KEY, "parts"), _KEY, "left")
    small = placed.where("parts is null").select(
        *_KEY, "gid", "mult", "unit", F.lit(0).alias("home"), F.expr("cast(array() as array<int>)").alias("visits"))
    large = placed.where("parts is not null").withColumn("part", F.expr("pmod(xxhash64(gid, 1), parts)"))
    centres = fitted.join(sizes.select(*_KEY, "parts"), _KEY).select(
        *_KEY, "centroids", F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part"))
    schema = small.schema.simpleString()[7:-1]
    keys = [*_KEY, "part"]
    return cut_lineage(small.unionByName(
        large.groupBy(*keys).cogroup(centres.groupBy(*keys))
        .applyInPandas(_assigned(half_chord if margin is None else min(margin, half_chord)), schema)))


# --- 4. blocked products -------------------------------------------------

def _compared(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["role", "gid"], kind="stable")
        gid, mult, cell = rows["gid"].tolist(), rows["mult"].to_numpy(), int(rows["cell"].iat[0])
        first = not rows["grp"].iat[0]
        m = int((rows["role"] == 0).sum())
        x = _matrix(rows["unit"], int(rows["dim"].iat[0]))
        home, away = rows["home"].to_numpy(), rows["home"].to_numpy() != cell
        # members of the block that visit a lower home cell of one of the visitors
        visiting: dict[int, np.ndarray] = {int(h): np.zeros(m, bool) for h in np.unique(home[away]) if h < cell}
        for i, cells in enumerate(rows["visits"].iloc[:m]):
            for h in cells:
                if h in visiting:
                    visiting[h][i] = True
        links, edges = np.zeros(len(x), np.int64), []
        group = np.arange(len(x))
        for at in range(0 if first else m, len(x), 512):
            found = x[at:at + 512] @ x[:m].T >= threshold
            for i in range(len(found)):
                if at + i < m:
                    found[i, at + i:] = False
                elif away[at + i] and (seen := visiting.get(int(home[at + i]))) is not None:
                    found[i] &= ~seen
            links[at:at + len(found)] += found @ mult[:m]
            links[:m] += mult[at:at + len(found)] @ found
            for i in np.flatnonzero(found.any(1)).tolist():
                # one edge to each group of members that the row has not been joined with
                linked = np.flatnonzero(found[i])
                for g, k in zip(*np.unique(group[linked], return_index=True)):
                    if g != group[at + i]:
                        edges.append((gid[at + i], gid[linked[k]]))
                        group[group == g] = group[at + i]
        seen = np.flatnonzero(links)
        return pd.DataFrame({"src": [gid[i] for i in seen] + [a for a, _ in edges],
                             "dst": [None] * len(seen) + [b for _, b in edges],
                             "n": links[seen].tolist() + [0] * len(edges)})
    return run


def link_table(cells: DataFrame, threshold: float) -> DataFrame:
    """(src, dst, n): link counts n of src where dst is null, else edges of spanning forests."""
    cell_key = [*_KEY, "cell"]
    rows = cells.select(*_KEY, "gid", "mult", "unit", "home", "visits", F.explode(
        F.concat(F.array("home"), "visits")).alias("cell"))
    sizes = cut_lineage(rows.groupBy(*cell_key).agg(
        F.count(F.when(F.col("home") == F.col("cell"), 1)).alias("own"), F.count("*").alias("all"))
        .where("own > 0 and all > 1").select(
            *cell_key, F.expr(f"cast(ceil(own / {BLOCK}) as int)").alias("blocks"),
            F.expr(f"cast(ceil(all / {BLOCK * BLOCKS_PER_TASK}) as int)").alias("groups")))
    placed = (rows.join(sizes, cell_key)
              .withColumn("own", F.when(F.col("home") == F.col("cell"), F.expr("pmod(xxhash64(gid, 2), blocks)")))
              .withColumn("part", F.expr("pmod(xxhash64(gid, 3), groups)")))
    # a row is a member of its own block for all groups, and meets the lower blocks in its group
    as_member = F.expr("if(own is null, array(), transform(sequence(0, groups - 1), "
                       "g -> named_struct('block', own, 'grp', cast(g as bigint), 'role', 0)))")
    lower = F.coalesce(F.col("own"), F.col("blocks").cast("long"))
    as_other = F.when(lower > 0, F.transform(F.sequence(F.lit(0).cast("long"), lower - 1), lambda b: F.struct(
        b.alias("block"), F.col("part").alias("grp"), F.lit(1).alias("role")))).otherwise(F.array())
    dealt = placed.select(*cell_key, "gid", "mult", "unit", "home",
                          F.when(F.col("own").isNotNull(), F.col("visits")).alias("visits"),
                          F.inline(F.concat(as_member, as_other)))
    return dealt.groupBy(*cell_key, "block", "grp").applyInPandas(
        _compared(threshold), "src binary, dst binary, n long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD,
                    margin: float | None = None) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors (column ``embedding``) link when their labels are equal and not null and
    their cosine is ``threshold`` or more, in double precision. Vectors that are null,
    empty, zero or hold null or non-finite numbers link with nothing, nor do vectors
    of different lengths. ``n_links`` counts other rows, rows that repeat an id
    included. ``component_id`` is the smallest id reachable by links; a row without an
    id takes part under the ids it reaches and has a null component if there are none.
    ``kept`` marks the rows whose id is their component's. Other columns are ignored;
    an empty table gives an empty result. ``margin`` is the distance from a cell's
    border up to which vectors are compared across it; by default no link is lost.
    """
    rows = cut_lineage(embeddings.select(
        F.col("vec_id").cast("long"), "label", F.col("embedding").alias("vector"))
        .mapInArrow(_prepared, "vec_id long, label " + embeddings.schema["label"].dataType.simpleString()
                    + ", dim int, gid binary, unit binary"))
    distinct = cut_lineage(rows.where("gid is not null").groupBy(*_KEY, "gid").agg(
        F.count("*").alias("mult"), F.min("vec_id").alias("rep"), F.first("unit").alias("unit")))
    cells = assign_cells(distinct.select(*_KEY, "gid", "mult", "unit"), threshold, margin)
    found = cut_lineage(link_table(cells, threshold))
    discard(cells)
    counts = found.where("dst is null").groupBy(F.col("src").alias("gid")).agg(F.sum("n").alias("n"))
    roots = smallest_members(found.where("dst is not null").select("src", "dst"))
    named = cut_lineage(distinct.select("gid", "rep", "mult").join(roots, F.col("gid") == F.col("id"), "left")
                        .select("gid", "rep", "mult", F.coalesce("root", "gid").alias("root")))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    result = cut_lineage(named.join(cut_lineage(least), "root").join(counts, "gid", "left").select(
        F.col("gid").alias("g"), (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"))
    return (rows.select("vec_id", "gid").join(result, F.col("gid") == F.col("g"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(F.col("g").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
