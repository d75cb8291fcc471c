"""Prefix trie of conversations by range minima over sorted common-prefix lengths.

1. Conversations are rebuilt turn by turn from digests: a turn is the MD5 of its role
   and text, texts themselves are not carried along. A conversation is one key, the
   digests of its turns one after the other.
2. Keys are sorted over all tasks (ties by conversation id) and packed into blocks of
   bounded size. A block holds ids, lengths, the lengths of common prefixes (LCP) with
   the row before, and the bytes of the turns beyond it.
3. A node at depth d is an interval of sorted rows between which no LCP is below d. Its
   first row is the one whose LCP is below d. For every such candidate (row, depth) both
   ends are found by binary search over a sparse table of range minima, without a
   stack. Where the search leaves a block, it goes on in the sparse table of the blocks'
   minima and ends in the head or tail of another block, of which only the steps of
   the running minimum are kept: at most as many as there are different depths.
4. Counts, smallest ids, leaves and bytes of an interval are range minima and differences
   of running sums.
5. Ids that end at a node follow each other in the order of rows; those of nodes that
   cross blocks are handed over in pieces and hashed in order.

What every task gets are the steps of all blocks: a few numbers per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import cut_lineage, discard

GROUP = 5
HEADS = 9
# rows and turns of one block; a longer conversation is a block of its own
BLOCK_ROWS = 65_536
BLOCK_TURNS = 524_288
DIGEST = 16
# ids in one piece of a list that crosses blocks
PIECE = 4_096
_FAR = np.iinfo(np.int64).max


# --- 1. rebuilt conversations --------------------------------------------

def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, bytes): digests of the rebuilt turns, and the UTF-8 bytes of each."""
    text, role = (F.coalesce(c, F.lit("")) for c in ("text", "role"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    turns = cut_lineage(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long"), F.col("turn"), F.octet_length(text).cast("long").alias("n"),
            # the length keeps role and text apart
            F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"))
        .withColumn("pos", F.row_number().over(order)).drop("turn"))
    ids = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"))
    heads = turns.where(F.col("pos") < HEADS).where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), "pos", "digest", "n")
    own = turns.select("conv_id", "pos", "digest", "n").where(
        F.col("pos") > F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS)
    # conversations that lost all turns are there with an empty list
    taken = (ids.join(heads, "base", "left").where("pos is null or pos <= h or pos = 1")
             .withColumn("pos", F.when(F.col("pos") <= F.col("h"), F.col("pos")))
             .select("conv_id", "pos", "digest", "n"))
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "digest", "n"))
    listed = taken.unionByName(own).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return listed.select("conv_id", F.expr("unhex(array_join(transform(t, x -> hex(x.digest)), ''))").alias("key"),
                         F.expr("transform(t, x -> x.n)").alias("bytes"))


# --- 2. sorted blocks ----------------------------------------------------

def _common(a: bytes, b: bytes) -> int:
    """Digests that two keys have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // DIGEST


_BLOCK = "part long, number long, first_key binary, last_key binary, rows binary, sizes binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows (id, turns, LCP, bytes of the turns within the LCP).

    ``sizes`` has the bytes of the turns beyond the LCP, row by row. The first row of a
    block is there with all turns: its LCP with the block before is found later.
    """
    def block() -> pa.RecordBatch:
        values = [part, number, first_key, last_key, np.array(rows, np.int64).tobytes(),
                  np.array(sizes, np.int64).tobytes()]
        kinds = [pa.int64()] * 2 + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                          names=["part", "number", "first_key", "last_key", "rows", "sizes"])

    part, number = TaskContext.get().partitionId(), 0
    rows, sizes, first_key, last_key = [], [], b"", b""
    for batch in batches:
        for conv_id, key, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "bytes"))):
            if rows and (len(rows) >= BLOCK_ROWS or len(sizes) + len(n) > BLOCK_TURNS):
                yield block()
                number, rows, sizes = number + 1, [], []
            lcp = _common(last_key, key) if rows else 0
            if not rows:
                first_key = key
            rows.append((conv_id, len(n), lcp, sum(n[:lcp])))
            sizes += n[lcp:]
            last_key = key
    if rows:
        yield block()


def sorted_blocks(keys: DataFrame) -> DataFrame:
    """Blocks of all rows in one order, with their number ``at`` and the LCPs at both seams.

    The seam is -1 before the first and after the last block.
    """
    blocks = cut_lineage(
        keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
        .select("conv_id", "key", "bytes").mapInArrow(_blocks, _BLOCK))
    spark, start, starts = keys.sparkSession, 0, []
    for part, n in sorted(blocks.groupBy("part").agg(F.count("*")).toLocalIterator()):
        starts.append((part, start))
        start += n
    at = spark.createDataFrame(starts, "part long, start long")
    numbered = cut_lineage(blocks.join(at, "part").withColumn("at", F.col("start") + F.col("number"))
                           .drop("part", "number", "start"))
    discard(blocks)

    @F.pandas_udf("long")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_common(x, y) for x, y in zip(a, b)], dtype="int64")

    seams = cut_lineage(
        numbered.select("at", "first_key").join(numbered.select((F.col("at") + 1).alias("at"), "last_key"), "at")
        .select("at", common("last_key", "first_key").alias("seam")))
    return (numbered.drop("first_key", "last_key").join(seams, "at", "left")
            .join(seams.select((F.col("at") - 1).alias("at"), F.col("seam").alias("next_seam")), "at", "left")
            .fillna(-1, ["seam", "next_seam"]))


# --- 3. intervals --------------------------------------------------------

def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values."""
    table, width = [values], 1
    while 2 * width <= len(values):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


def _least(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minima of the values from ``low`` to ``high``, both included."""
    k = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), np.int64)
    for j in np.unique(k):
        own = k == j
        out[own] = np.minimum(table[j][low[own]], table[j][high[own] - (1 << int(j)) + 1])
    return out


def _right_end(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last position that ``at`` reaches over values of ``depth`` or more behind it."""
    end = at.copy()
    for k in range(len(table) - 1, -1, -1):
        run = table[k]
        fits = end + 1 < len(run)
        fits[fits] = run[end[fits] + 1] >= depth[fits]
        end[fits] += 1 << k
    return end


def _left_end(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first position that reaches ``at`` over values of ``depth`` or more up to ``at``."""
    end = at.copy()
    for k in range(len(table) - 1, -1, -1):
        run = table[k]
        fits = end - (1 << k) >= 0
        fits[fits] = run[end[fits] - (1 << k) + 1] >= depth[fits]
        end[fits] -= 1 << k
    return end


class _Block:
    """The arrays of one block; sums have a leading 0."""

    def __init__(self, rows: bytes, sizes: bytes, seam: int, next_seam: int) -> None:
        table = np.frombuffer(rows, np.int64).reshape(-1, 4)
        self.ids, self.lengths, self.lcps, self.before = (c.copy() for c in table.T)
        self.n, self.seam, self.next_seam = len(table), seam, next_seam
        self.sizes = np.frombuffer(sizes, np.int64)
        self.place = np.concatenate([[0], np.cumsum(self.lengths - self.lcps)])
        self.sized = np.concatenate([[0], np.cumsum(self.sizes)])
        total = self.before + self.sized[self.place[1:]] - self.sized[self.place[:-1]]
        # bytes of turns beyond the LCP; those of the first row start behind the seam
        new = total - self.before
        new[0] -= self.sized[max(0, seam)]
        self.lcps[0] = seam
        following = np.append(self.lcps[1:], next_seam)
        self.leaf = (following < self.lengths).astype(np.int64)
        self.totals, self.news, self.leaves = (np.concatenate([[0], np.cumsum(x)]) for x in (total, new, self.leaf))
        same = (self.lcps == self.lengths) & (np.append(-1, self.lengths[:-1]) == self.lengths)
        same[0] = seam == self.lengths[0]
        self.same = same

    def head(self) -> list[tuple]:
        """Steps (depth, rows, smallest id, bytes, new bytes, leaves, children) from the start.

        A node of up to that depth that is open at the seam holds so many rows.
        """
        if self.seam < 0:
            return []
        run = np.minimum.accumulate(self.lcps)
        low = np.minimum.accumulate(self.ids)
        born = (self.lcps == run) & (self.lengths > run)
        steps = []
        for depth in np.unique(run)[::-1].tolist():
            end = int(np.searchsorted(-run, -depth, "right"))
            if depth < 0:
                break
            steps.append((depth, end, int(low[end - 1]), int(self.totals[end]), int(self.news[end]),
                          int(self.leaves[end]), int(born[run == depth].sum())))
        return steps

    def tail(self) -> list[tuple]:
        """Steps (depth, smallest id) from the end: of nodes that are open at the next seam."""
        if self.next_seam < 0:
            return []
        run = np.minimum.accumulate(np.append(self.next_seam, self.lcps[:0:-1]))
        low = np.minimum.accumulate(self.ids[::-1])
        return [(depth, int(low[np.searchsorted(-run, -depth, "right") - 1])) for depth in np.unique(run)[::-1].tolist()]

    def summary(self, at: int) -> tuple:
        ends = int(np.argmin(np.append(self.same, False)))
        return (at, self.n, self.seam, int(self.lcps.min()), int(self.ids.min()), int(self.totals[-1]),
                int(self.news[-1]), int(self.leaves[-1]), ends, self.head(), self.tail())


_STEP = ("array<struct<depth: long, rows: long, id: long, total: long, new: long, leaves: long, children: long>>")
_SUMMARY = ("at long, n long, seam long, least long, id long, total long, new long, leaves long, ends long, "
            f"head {_STEP}, tail array<struct<depth: long, id: long>>")


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        names = ["at", "n", "seam", "least", "id", "total", "new", "leaves", "ends", "head", "tail"]
        step = ["depth", "rows", "id", "total", "new", "leaves", "children"]
        rows = [_Block(r.rows, r.sizes, r.seam, r.next_seam).summary(r.at) for r in batch.itertuples(index=False)]
        yield pd.DataFrame([(*r[:9], [dict(zip(step, s)) for s in r[9]],
                             [{"depth": d, "id": i} for d, i in r[10]]) for r in rows], columns=names)


class Spine:
    """What every task knows of all blocks, to follow an interval beyond its own block."""

    def __init__(self, rows: list) -> None:
        rows = sorted(rows, key=lambda r: r.at)
        self.seams = np.array([r.seam for r in rows], np.int64)
        self.table = _sparse(np.array([r.least for r in rows], np.int64))
        self.low = _sparse(np.array([r.id for r in rows], np.int64))
        self.sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(
            np.array([(r.n, r.total, r.new, r.leaves) for r in rows], np.int64).reshape(-1, 4), axis=0)])
        self.heads = [[tuple(s) for s in r.head] for r in rows]
        self.tails = [[tuple(s) for s in r.tail] for r in rows]
        # blocks by the depth of children that start in their heads, with running sums
        born: dict[int, list[tuple[int, int]]] = {}
        for at, head in enumerate(self.heads):
            for s in head:
                born.setdefault(s[0], []).append((at, s[6]))
        self.born = {d: (np.array([a for a, _ in x]), np.concatenate([[0], np.cumsum([c for _, c in x])]))
                     for d, x in born.items()}
        # the block in which the list of ends that goes on in a block's head began
        self.began: list[int] = []
        for at, r in enumerate(rows):
            through = at > 1 and rows[at - 1].ends == rows[at - 1].n
            self.began.append(self.began[at - 1] if through else at - 1)
        self.ends = [r.ends for r in rows]

    @staticmethod
    def _step(steps: list[tuple], depth: int) -> tuple | None:
        """The step of nodes of ``depth``: the last one that is not less deep."""
        found = None
        for s in steps:
            if s[0] < depth:
                break
            found = s
        return found

    def beyond(self, at: int, depth: int) -> tuple[int, int, int, int, int, int]:
        """Rows, smallest id, bytes, new bytes, leaves and children behind block ``at``.

        Of the node of ``depth`` that is open at its end.
        """
        one = np.array([at]), np.array([depth])
        last = int(_right_end(self.table, *one)[0])
        sums = (self.sums[last + 1] - self.sums[at + 1]).tolist()
        low = int(_least(self.low, one[0] + 1, np.array([last]))[0]) if last > at else _FAR
        edge = self._step(self.heads[last + 1], depth) if last + 1 < len(self.heads) else None
        if edge:
            sums = [a + b for a, b in zip(sums, (edge[1], *edge[3:6]))]
            low, last = min(low, edge[2]), last + 1
        blocks, counts = self.born.get(depth, (np.empty(0, np.int64), np.zeros(1, np.int64)))
        low_at, high_at = np.searchsorted(blocks, [at + 1, last + 1])
        return sums[0], low, sums[1], sums[2], sums[3], int(counts[high_at] - counts[low_at])

    def smallest(self, at: int, depth: int) -> int:
        """Smallest id of the node of ``depth`` that is open at the start of block ``at``."""
        one = np.array([at - 1]), np.array([depth])
        first = int(_left_end(self.table, *one)[0])
        low = min(self._step(self.tails[first], depth)[1], self.beyond(at - 1, depth)[1])
        if first < at - 1:
            low = min(low, int(_least(self.low, np.array([first + 1]), one[0])[0]))
        return low


# --- 4. nodes ------------------------------------------------------------

_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, run long")
_NONE = hashlib.sha256(b"").hexdigest()


def _decimal(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _nodes_of(b: _Block, at: int, spine: Spine) -> pd.DataFrame:
    """The nodes whose first row is in block ``at``."""
    lcp_table, id_table = _sparse(b.lcps), _sparse(b.ids)
    counts = b.lengths - b.lcps
    first = np.repeat(np.arange(b.n), counts)
    offset = np.concatenate([[0], np.cumsum(counts)])
    depth = np.arange(len(first)) - offset[first] + b.lcps[first] + 1
    end = _right_end(lcp_table, first, depth)
    # bytes of the turns before the node's own turn, and of all turns of its first row
    held = np.where(np.arange(b.n) == 0, 0, b.lcps)
    turn = b.place[first] + np.maximum(0, depth - 1 - held[first])
    above = b.before[first] + b.sized[turn] - b.sized[b.place[first]]
    whole = b.totals[first + 1] - b.totals[first]
    n = end - first + 1
    low = _least(id_table, first, end)
    total = b.totals[end + 1] - b.totals[first]
    new = b.news[end + 1] - b.news[first + 1]
    leaves = b.leaves[end + 1] - b.leaves[first]
    children = (depth < b.lengths[first]).astype(np.int64)
    # the node of the row before in which a row's first own node begins
    row = np.flatnonzero((counts > 0) & (b.lcps >= 0))
    up = b.lcps[row]
    left = _left_end(lcp_table, row, up)
    inside = (left > 0) | (b.lcps[left] < up)
    parent = np.where(inside, offset[left] + up - b.lcps[left] - 1, -1)
    children += np.bincount(parent[inside], minlength=len(first))
    for i in np.flatnonzero((end == b.n - 1) & (depth <= b.next_seam)).tolist():
        more = spine.beyond(at, int(depth[i]))
        n[i] += more[0]
        low[i] = min(low[i], more[1])
        for values, x in zip((total, new, leaves, children), more[2:]):
            values[i] += x
    saved = total - n * above - (whole - above) - new
    up_id = np.empty(len(first), np.int64)
    up_id[1:] = low[:-1]
    starts = offset[row]
    outer = {int(d): spine.smallest(at, int(d)) for d in np.unique(up[~inside])}
    up_id[starts] = [low[p] if p >= 0 else outer[int(d)] for p, d in zip(parent, up)]
    # ids that end at a node: rows equal to its first one
    sha, run = np.full(len(first), _NONE, object), np.full(len(first), -1)
    stop = np.append(np.flatnonzero(~b.same), b.n)
    own = offset[1:] - 1
    for i, j in zip(stop[:-1].tolist(), stop[1:].tolist()):
        if counts[i]:
            sha[own[i]] = hashlib.sha256(_decimal(b.ids[i:j])).hexdigest()
    if spine.ends[at + 1:at + 2] and spine.ends[at + 1] and not b.same.all() and counts[stop[-2]]:
        run[own[stop[-2]]] = at
    nodes = pd.DataFrame({"conv_id": low, "depth": depth, "parent_conv_id": pd.array(up_id, "Int64"), "n_convs": n,
                          "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
                          "ends_sha256": sha, "run": pd.array(np.maximum(run, 0), "Int64")})
    nodes.loc[depth == 0, "parent_conv_id"] = pd.NA
    nodes.loc[run < 0, "run"] = pd.NA
    return nodes


def _all_nodes(spine: Spine):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                yield _nodes_of(_Block(r.rows, r.sizes, r.seam, r.next_seam), r.at, spine)
    return run


# --- 5. ends across blocks -----------------------------------------------

def _pieces(spine: Spine):
    """(run, at, place, ids): lists of ends that cross blocks, in pieces."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                b, rows = _Block(r.rows, r.sizes, r.seam, r.next_seam), []
                ends = spine.ends[r.at]
                if ends:
                    rows += [(spine.began[r.at], r.at, i, _decimal(b.ids[i:min(i + PIECE, ends)]))
                             for i in range(0, ends, PIECE)]
                if spine.ends[r.at + 1:r.at + 2] and spine.ends[r.at + 1] and ends < b.n:
                    start = int(np.flatnonzero(~b.same)[-1])
                    rows += [(r.at, r.at, i, _decimal(b.ids[i:i + PIECE])) for i in range(start, b.n, PIECE)]
                yield pd.DataFrame(rows, columns=["run", "at", "place", "ids"])
    return run


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash per run of pieces; rows come sorted by (run, at, place)."""
    current, state = None, None
    for batch in batches:
        out = []
        for run, ids in zip(batch["run"], batch["ids"]):
            if run != current:
                if state:
                    out.append((current, state.hexdigest()))
                current, state = run, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        yield pd.DataFrame(out, columns=["r", "sha"])
    if state:
        yield pd.DataFrame([(current, state.hexdigest())], columns=["r", "sha"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, as in the contract of the query. Turns of a
    conversation are ordered by ``turn`` (null first), equal ones by role and text in a
    fixed order; repeated turns count as often as they are there. Null roles and texts are
    empty ones; rows without a conv_id belong to no conversation and are left out. c % 5
    has the sign of c. An empty table gives an empty result; other columns are ignored. A
    conversation is one item: its digests (16 bytes a turn) are held by one task.
    """
    blocks = cut_lineage(sorted_blocks(rebuilt(conversations)))
    spine = Spine(list(blocks.mapInPandas(_summaries, _SUMMARY).toLocalIterator()))
    nodes = cut_lineage(blocks.mapInPandas(_all_nodes(spine), _NODE))
    shas = (blocks.mapInPandas(_pieces(spine), "run long, at long, place long, ids binary")
            .repartition("run").sortWithinPartitions("run", "at", "place")
            .mapInPandas(_hashed, "r long, sha string"))
    crossing = (nodes.where("run is not null").join(shas, F.col("run") == F.col("r"))
                .withColumn("ends_sha256", F.col("sha")).select(nodes.columns))
    return nodes.where("run is null").unionByName(crossing).drop("run")
