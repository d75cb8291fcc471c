"""Top documents of each query item by summed impacts, over K2-treaps of terms and documents.

1. One pass counts documents, terms and, per term, the documents that hold it.
2. Index. Documents are packed into shards of bounded size, in the order of the task
   that reads them. The rows of a shard's grid are its terms, frequent ones first, its
   columns the documents by id. A cell that holds an occurrence has an impact, the part
   of a score that does not depend on the term's weight. The grid is a quadtree: a
   level lists its non-empty cells in Morton order with a four-bit map of their
   children and the largest impact below them, stored as the step down from the
   parent's. Ranks in the maps replace pointers. All documents are indexed.
3. Search. A document range is a column prefix together with the cells of all of an
   item's rows on that level; weighted maxima add up to its bound. Ranges are opened
   best first, a few at a time, until no bound reaches the item's last place any more.
   Equal bounds are opened only for smaller document ids.
4. A fixed share of the shards is searched first; the scores of their last places
   are where the other shards stop. Every shard reports the places it can contribute
   to, a window keeps each item's first ``top``.

Items are searched in blocks of bounded size; nothing else is sent to all tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import cut_lineage

TOP = 50
# occurrences and documents of one shard; a longer document is a shard of its own
SHARD_CELLS = 1_000_000
SHARD_DOCS = 16_384
# terms a task counts before it hands them on
COUNT_BUFFER = 500_000
# characters of the items that are searched at a time (and sent to all tasks)
ITEM_BLOCK = 4_000_000
# one shard in so many is searched first
FIRST_SHARDS = 16
# ranges opened at a time
OPENED = 48

# letters and digits stay, A-Z become a-z, other ASCII separates, bytes beyond ASCII stay
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                    for c in range(256))
# of a map of children and a child's number: whether it exists, and how many come before it
_HAS = np.array([[m >> c & 1 for c in range(4)] for m in range(16)], bool)
_BEFORE = np.array([[bin(m & (1 << c) - 1).count("1") for c in range(4)] for m in range(16)], np.int64)
_CHILDREN = np.array([bin(m).count("1") for m in range(16)], np.int64)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


# --- 1. counts -----------------------------------------------------------

def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(term, docs) in parts; the row without a term has the documents and terms of the task."""
    def part() -> pd.DataFrame:
        return pd.DataFrame({"term": list(held), "docs": list(held.values()), "terms": 0})

    held, docs, total = Counter(), 0, 0
    for batch in batches:
        for text in batch["text"]:
            terms = terms_of(text)
            held.update(set(terms))
            docs += bool(terms)
            total += len(terms)
            if len(held) >= COUNT_BUFFER:
                yield part()
                held.clear()
    yield part()
    yield pd.DataFrame({"term": [None], "docs": [docs], "terms": [total]})


def corpus_counts(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(term, docs) of all terms; documents with a term; terms with repeats."""
    parts = cut_lineage(docs.select("text").mapInPandas(_counted, "term binary, docs long, terms long"))
    n, total = parts.where("term is null").agg(F.sum("docs"), F.sum("terms")).first()
    return (parts.where("term is not null").groupBy("term").agg(F.sum("docs").alias("docs")),
            n or 0, total or 0)


# --- 2. index ------------------------------------------------------------

def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2**32, each moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """A quadtree over a grid of rows and columns with the largest value of every cell."""

    def __init__(self, height: int, maps: np.ndarray, peaks: np.ndarray) -> None:
        self.height, self.maps, self.peaks = height, maps, peaks
        # children follow in the order of their parents, the root is node 0
        self.start = np.concatenate([[1], 1 + np.cumsum(_CHILDREN[maps])])

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        """Of cells that are all different, with values above 0."""
        height = max(int(rows.max(initial=0)).bit_length(), int(columns.max(initial=0)).bit_length(), 1)
        code = _spread(rows) << np.uint64(1) | _spread(columns)
        order = np.argsort(code)
        code, peak = code[order], values[order]
        levels = [(np.zeros(len(code), np.uint8), peak)]
        for _ in range(height):
            child = (code & np.uint64(3)).astype(np.uint8)
            code = code >> np.uint64(2)
            starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            code, peak = code[starts], np.maximum.reduceat(peak, starts)
            levels.append((np.bitwise_or.reduceat(np.uint8(1) << child, starts), peak))
        # leaves need no maps
        maps = np.concatenate([m for m, _ in levels[:0:-1]])
        return cls(height, maps, np.concatenate([p for _, p in levels[::-1]]))

    def dump(self) -> bytes:
        """Maps in half bytes, then the steps down from the parents' values by byte planes."""
        maps = np.append(self.maps, np.uint8(0)) if len(self.maps) % 2 else self.maps
        parent = np.repeat(np.arange(len(self.maps)), _CHILDREN[self.maps])
        steps = self.peaks.copy()
        steps[1:] = self.peaks[parent] - self.peaks[1:]
        planes = steps.astype("<u4").view(np.uint8).reshape(-1, 4).T
        head = np.array([self.height, len(self.maps), len(self.peaks)], "<i8").tobytes()
        return zlib.compress(head + (maps[::2] | maps[1::2] << 4).tobytes()
                             + np.ascontiguousarray(planes).tobytes(), 1)

    @classmethod
    def load(cls, data: bytes) -> Treap:
        data = zlib.decompress(data)
        height, inner, nodes = np.frombuffer(data, "<i8", 3).tolist()
        half = -(-inner // 2)
        packed = np.frombuffer(data, np.uint8, half, 24)
        maps = np.stack([packed & 15, packed >> 4], 1).reshape(-1)[:inner]
        planes = np.frombuffer(data, np.uint8, 4 * nodes, 24 + half).reshape(4, nodes)
        steps = np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)
        treap = cls(height, maps, steps)
        # values come back level by level, parents first
        low, high = 0, 1
        while high < nodes:
            first, last = treap.start[low], treap.start[high]
            parent = np.repeat(np.arange(low, high), _CHILDREN[maps[low:high]])
            steps[first:last] = steps[parent] - steps[first:last]
            low, high = first, last
        return treap

    def top(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """The ``k`` columns (score, column) of the largest weighted sums over ``rows``.

        By falling score, then rising column; scores below ``least`` or 1 are left out.
        """
        least = max(1, least)
        capacity, used = 1024, 1
        nodes = np.zeros((capacity, len(rows)), np.int64)
        column, level = np.zeros(capacity, np.int64), np.zeros(capacity, np.int64)
        bound = np.zeros(capacity, np.int64)
        bound[0] = self.peaks[0] * weights.sum()
        waiting = np.array([0] if bound[0] >= least else [], np.int64)
        found: list[tuple[int, int]] = []
        while len(waiting):
            if len(waiting) > OPENED:
                cut = np.argpartition(-bound[waiting], OPENED)
                now, waiting = waiting[cut[:OPENED]], waiting[cut[OPENED:]]
            else:
                now, waiting = waiting, waiting[:0]
            # both halves of the ranges, with the cells of all rows in each
            depth = level[now]
            upper = (rows[None, :] >> (self.height - 1 - depth)[:, None] & 1) * 2
            at = nodes[now]
            alive = at >= 0
            at = np.where(alive, at, 0)
            maps, start = self.maps[at], self.start[at]
            for side in (0, 1):
                child = upper + side
                there = alive & _HAS[maps, child]
                kept = there.any(1)
                if not kept.any():
                    continue
                cells = np.where(there, start + _BEFORE[maps, child], -1)[kept]
                best = (np.where(there[kept], self.peaks[cells], 0) * weights).sum(1)
                columns, depths = column[now[kept]] * 2 + side, depth[kept] + 1
                leaf = depths == self.height
                if leaf.any():
                    found += zip(best[leaf].tolist(), columns[leaf].tolist())
                open_ = ~leaf & (best >= least)
                n = int(open_.sum())
                if not n:
                    continue
                if used + n > capacity:
                    capacity = 2 * (used + n)
                    nodes = np.concatenate([nodes, np.zeros((capacity - len(nodes), len(rows)), np.int64)])
                    column, level, bound = (np.concatenate([a, np.zeros(capacity - len(a), np.int64)])
                                            for a in (column, level, bound))
                new = np.arange(used, used + n)
                nodes[new], column[new], level[new], bound[new] = cells[open_], columns[open_], depths[open_], best[open_]
                used += n
                waiting = np.concatenate([waiting, new])
            if len(found) > k:
                found = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
            if len(found) == k:
                found.sort(key=lambda x: (-x[0], x[1]))
                last, last_column = found[-1]
                least = max(least, last)
                # an equal score counts for smaller columns only
                first_column = column[waiting] << (self.height - level[waiting])
                waiting = waiting[(bound[waiting] > least) | ((bound[waiting] == least) & (
                    (last < least) | (first_column < last_column)))]
        return sorted((x for x in found if x[0] >= least), key=lambda x: (-x[0], x[1]))[:k]


def _shards(n_docs: int, n_terms: int):
    """Rows (docs, terms, treap) of packed documents; see ``build_index``."""
    def packed(ids: list, counts: list[Counter]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        rank: Counter = Counter()
        for c in counts:
            rank.update(c.keys())
        terms = [t for t, _ in sorted(rank.items(), key=lambda x: (-x[1], x[0]))]
        row = dict(zip(terms, range(len(terms))))
        rows, columns, values = [], [], []
        for column, i in enumerate(order):
            c = counts[i]
            m = 50 + 50 * c.total() * n_docs // n_terms
            tf = np.fromiter(c.values(), np.int64, len(c))
            rows.append(np.fromiter(map(row.__getitem__, c), np.int64, len(c)))
            columns.append(np.full(len(c), column))
            values.append(1_000_000_000 * tf // (1000 * tf + 20 * m))
        treap = Treap.build(*(np.concatenate(x) for x in (rows, columns, values)))
        return pa.RecordBatch.from_arrays(
            [pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
             pa.array([zlib.compress(b" ".join(terms), 1)], pa.binary()), pa.array([treap.dump()], pa.binary())],
            names=["docs", "terms", "treap"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, cells = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                c = Counter(terms_of(text.as_py()))
                if not c:
                    continue
                if ids and (cells + len(c) > SHARD_CELLS or len(ids) >= SHARD_DOCS):
                    yield packed(ids, counts)
                    ids, counts, cells = [], [], 0
                ids.append(doc_id)
                counts.append(c)
                cells += len(c)
        if ids:
            yield packed(ids, counts)
    return run


def build_index(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """One row per shard: ids of its documents, terms of its rows, and the K2-treap.

    ``n_docs`` documents with ``n_terms`` terms make the average length that impacts
    are measured by. Documents without terms are in no shard.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _shards(n_docs, max(1, n_terms)), "docs array<long>, terms binary, treap binary")


# --- 3. search -----------------------------------------------------------

def _searched(items: list[tuple[int, dict[bytes, int]]], least: dict[int, int], k: int):
    """``items`` are (number, {term: weight}); ``least`` has scores below which nothing counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = dict(least)
        for batch in batches:
            for docs, terms, data in zip(*(batch.column(c).to_pylist() for c in ("docs", "terms", "treap"))):
                treap = Treap.load(data)
                row = {t: i for i, t in enumerate(zlib.decompress(terms).split(b" "))}
                out: list[tuple] = []
                for number, weights in items:
                    held = sorted((row[t], w) for t, w in weights.items() if w and t in row)
                    if not held:
                        continue
                    rows, w = np.array(held, np.int64).T
                    places = treap.top(rows, w, k, floor.get(number, 1))
                    if len(places) == k:
                        # a full list anywhere bounds what other shards have to find
                        floor[number] = max(floor.get(number, 1), places[-1][0])
                    out += [(number, docs[c], s) for s, c in places]
                numbers, ids, scores = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                    names=["number", "doc_id", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of every item: item_id, rank, doc_id, score.

    Terms, weights and scores are those of integer impacts: a term of an item, counted
    once, adds w * ((1000000000 * tf) div (1000 * tf + 20 * m)) with w the floor of
    1000 * ln((2 N + 2) / (2 df + 1)). Only scores above 0 are ranked, equal ones by
    doc_id, null last. Null and blank texts have no terms. A row of ``docs`` that is
    repeated is ranked as often; equal rows of ``items`` are one item, different texts
    under one item_id are ranked apart. Empty tables give an empty result; other
    columns are ignored.
    """
    frequency, n_docs, n_terms = corpus_counts(docs)
    index = cut_lineage(build_index(docs, n_docs, n_terms))
    numbered = cut_lineage(
        items.select("item_id", "text").distinct()
        .withColumn("number", F.monotonically_increasing_id()))
    each = numbered.select("number", F.explode(_distinct_terms("text")).alias("term"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("docs") + 1)))
    # terms are weighed once, however many items hold them
    known = cut_lineage(frequency.join(each.select("term").distinct(), "term", "left_semi")
                        .select("term", weight.alias("w")))
    weighed = cut_lineage(each.join(known, "term").groupBy("number").agg(
        F.collect_list(F.struct("term", "w")).alias("terms"), F.sum(F.octet_length("term")).alias("bytes")))
    n_blocks = 1 + (weighed.agg(F.sum("bytes")).first()[0] or 0) // ITEM_BLOCK
    first = F.pmod(F.xxhash64("treap"), F.lit(FIRST_SHARDS)) == 0
    results = None
    for block in range(n_blocks):
        own = [(r.number, {bytes(t.term): t.w for t in r.terms}) for r in
               weighed.where(F.pmod(F.xxhash64("number"), F.lit(n_blocks)) == block).toLocalIterator()]
        early = cut_lineage(_best(index.where(first).mapInArrow(
            _searched(own, {}, top), "number long, doc_id long, score long"), top).drop("rank"))
        least = {r.number: r.s for r in early.groupBy("number").agg(
            F.count("*").alias("c"), F.min("score").alias("s")).where(F.col("c") == top).toLocalIterator()}
        late = index.where(~first).mapInArrow(
            _searched(own, least, top), "number long, doc_id long, score long")
        part = cut_lineage(_best(early.unionByName(late), top))
        results = part if results is None else results.unionByName(part)
    return results.join(numbered, "number").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def _distinct_terms(text: str):
    @F.pandas_udf("array<binary>")
    def distinct(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([list(dict.fromkeys(terms_of(t))) for t in texts], dtype=object)
    return distinct(text)
