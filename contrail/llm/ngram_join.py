"""Exact Jaccard self-join of documents on word shingles with a token-group matrix.

1. Frequencies. Each task reduces its texts to sorted shingle hashes with counts
   and deals them out by hash range; merged ranges give the most frequent shingles.
   They go last in the order of shingles, everything else is ordered by hash.
2. Sets. Each text becomes (set id, size, bands, prefix); equal sets are one from
   here on. A pair at the threshold shares a shingle of the larger set's prefix and the
   smaller set's shorter prefix.
3. Groups. The space of hashes is cut into ``BANDS * ROWS`` bins; a band is the smallest
   shingles of ``ROWS`` of them (one-permutation minima). Similar sets agree in most
   bands, sets with only a passage in common in few. A set joins the band of its that most sets
   share, so the near copies of one text end up in one group, whatever shingle each
   of them has changed. Groups are dealt into parts of bounded size.
   The matrix has one entry per group and shingle of its members' prefixes: the part of
   the group's token union that the bound needs.
4. Bound. Entries of query groups are joined with entries of groups; a group is
   opened only if the shared entries can add up to the overlap that the smallest
   admissible sizes ask for.
5. Opened groups. Each group opens the one it shares most with, then those pairs are
   left out that are connected already. Only members' texts are read again. A group's
   members are laid out as one sorted token-to-member table; each query set's overlap
   with the union bounds, and its counts per member decide. A group reports a
   spanning forest of its links, not all pairs: ``near_duplicates`` gives components
   only. ``link_counts`` compares all opened pairs and counts every link.
6. Connected components of the links, by star contraction.

The result is exact for every choice of frequent shingles and groups; both only
decide how much work is done. No step holds a group of unbounded size: parts of
groups are bounded in shingles, and groups with many queries are split by query.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.components import smallest_members
from contrail.llm.shingles import U64, WordHashes, mixed, set_id, shingle_set
from contrail.session import cut_lineage, discard

SIZE = 4
# a link needs 100 * intersection >= THRESHOLD * union
THRESHOLD = 85
# shingles that are ordered last: at most so many, each in so many texts at least
FREQUENT = 500_000
FREQUENT_FROM = 3
# counts from this one on are told apart in steps of a sixteenth of a power of two
EXACT_LEVELS = 1_000
# hashes a task gathers before it deals out their counts
COUNT_BUFFER = 3_000_000
# bands of a set, and the minima that make one
BANDS, ROWS = 6, 4
# shingles in one part of a group; query groups that one task compares with it
GROUP_SHINGLES = 65_536
GROUP_QUERIES = 64
# places of one set that are listed in one row
ROLES = 1_000
# roles up to this number are broadcast (about 40 bytes each), beyond it shuffled
BROADCAST_ROLES = 100_000


def query_prefix(n: int, threshold: int) -> int:
    """Shingles of which a set shares one with any linked set that is not larger."""
    return n - -(-threshold * n // 100) + 1


def _least_overlap(a: str, b: str, threshold: int) -> str:
    """SQL of the smallest intersection of linked sets of sizes a and b."""
    return f"(({threshold} * ({a} + {b}) + {99 + threshold}) div {100 + threshold})"


# --- 1. frequent shingles ------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T).tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(kind), dtype=kind)


def _dealt_counts(size: int, ranges: int, bits: int):
    bounds = (np.arange(1, ranges, dtype=np.float64) * (2.0 ** bits / ranges)).astype(U64)

    def flush(parts: list[np.ndarray]) -> pd.DataFrame:
        values, counts = np.unique(np.concatenate(parts) >> U64(64 - bits), return_counts=True)
        cuts = [0, *np.searchsorted(values, bounds).tolist(), len(values)]
        rows = [(r, _pack(values[a:b]), zlib.compress(counts[a:b].astype(np.uint32).tobytes(), 1))
                for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pd.DataFrame(rows, columns=["part", "keys", "counts"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, parts, held = WordHashes(), [], 0
        for batch in batches:
            for text in batch["text"]:
                tokens = shingle_set(text, size, hashes)
                parts.append(tokens)
                held += len(tokens)
                if held >= COUNT_BUFFER:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)
    return run


def _merged_counts(rows: pd.DataFrame) -> pd.DataFrame:
    """Keys of one range by their count, large counts by steps of it."""
    keys = np.concatenate([_unpack(k, U64) for k in rows["keys"]])
    counts = np.concatenate([np.frombuffer(zlib.decompress(c), np.uint32) for c in rows["counts"]])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    totals = np.add.reduceat(counts[order].astype(np.int64), starts)
    steps = EXACT_LEVELS + np.floor(16 * np.log2(np.maximum(totals, EXACT_LEVELS) / EXACT_LEVELS)).astype(np.int64)
    totals = np.where(totals < EXACT_LEVELS, totals, steps)
    keys = keys[starts]
    return pd.DataFrame([(n, int((totals == n).sum()), keys[totals == n].tobytes())
                         for n in np.unique(totals[totals >= FREQUENT_FROM]).tolist()],
                        columns=["level", "n", "keys"])


def frequent_shingles(docs: DataFrame, size: int = SIZE) -> tuple[np.ndarray, int]:
    """The leading bits of the most frequent shingles, sorted, and how many bits.

    Shingles are told apart by so many bits that about one in 32 shares them with
    another one; that can only move a shingle in the order.
    """
    n_docs = docs.count()
    ranges = max(64, n_docs // 2048)
    bits = min(60, max(24, (512 * n_docs).bit_length() + 5))
    levels = cut_lineage(
        docs.select("text").mapInPandas(_dealt_counts(size, ranges, bits),
                                        "part long, keys binary, counts binary")
        .groupBy("part").applyInPandas(_merged_counts, "level long, n long, keys binary"))
    # whole levels from the highest count down, as many as fit; there are some 1,500 levels at most
    held, least = 0, None
    for level, n in sorted(levels.groupBy("level").agg(F.sum("n")).collect(), reverse=True):
        held += n
        if held > FREQUENT:
            break
        least = level
    if least is None:
        return np.empty(0, U64), bits
    rows = levels.where(F.col("level") >= least).select("keys").collect()
    discard(levels)
    return np.sort(np.concatenate([np.frombuffer(r.keys, U64) for r in rows])), bits


# --- 2. sets -------------------------------------------------------------

_EDGES = (np.arange(BANDS * ROWS, dtype=np.float64) * (2.0 ** 64 / (BANDS * ROWS))).astype(U64)


def bands_of(tokens: np.ndarray) -> np.ndarray:
    """Hashes of a sorted set's bands; a bin without shingles takes the next one's smallest."""
    least = tokens[np.searchsorted(tokens, _EDGES) % len(tokens)].reshape(BANDS, ROWS)
    factors = np.arange(3, 2 * ROWS + 3, 2, dtype=U64)
    return mixed((mixed(least) * factors).sum(axis=1) + np.arange(BANDS, dtype=U64)).view(np.int64)


def _prefixes(frequent: np.ndarray, bits: int, size: int, threshold: int):
    def is_frequent(tokens: np.ndarray) -> np.ndarray:
        if not len(frequent):
            return np.zeros(len(tokens), bool)
        keys = tokens >> U64(64 - bits)
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        return frequent[at] == keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(text, size, hashes)
                n = len(tokens)
                if not n:
                    rows.append((None, 0, None, None))
                    continue
                last = is_frequent(tokens)
                wanted = query_prefix(n, threshold)
                first = tokens[~last][:wanted]
                if len(first) < wanted:
                    first = np.concatenate([first, tokens[last][:wanted - len(first)]])
                prefix = first.view(np.int64)
                rows.append((set_id(tokens), n, bands_of(tokens), prefix))
            sid, n, bands, prefix = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sid, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "sid", "n", "bands", "prefix"])
    return run


# --- 5. opened groups ----------------------------------------------------

def _tokens(size: int, text: str) -> Column:
    @F.pandas_udf("binary")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in batches:
            yield pd.Series([shingle_set(t, size, hashes).tobytes() for t in texts], dtype=object)
    return tokens(text)


class _Group:
    """The opened members of one part of a group and the links found for them."""

    def __init__(self, threshold: int, every: bool = False) -> None:
        self.threshold = threshold
        self.every = every
        self.sids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.parent: dict[int, int] = {}
        self.table = None

    def add(self, sid: int, tokens: np.ndarray) -> None:
        self.sids.append(sid)
        self.sets.append(tokens)

    def root(self, x: int) -> int:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def links(self, sid: int, tokens: np.ndarray, upto: int | None = None) -> list[tuple[int, int]]:
        """Edges from ``sid`` to members (the first ``upto`` of them), new ones or every one."""
        if self.table is None:
            keys = np.concatenate(self.sets)
            member = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
            order = np.argsort(keys, kind="stable")
            self.table = keys[order], member[order], np.array([len(s) for s in self.sets])
        keys, member, sizes = self.table
        low, high = np.searchsorted(keys, tokens, "left"), np.searchsorted(keys, tokens, "right")
        found = high > low
        # no member can share more than the group's token union does
        if 100 * int(found.sum()) < self.threshold * len(tokens):
            return []
        low, high = low[found], high[found]
        width = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
        shared = np.bincount(member[at], minlength=len(sizes))
        linked = np.flatnonzero(100 * shared >= self.threshold * (sizes + len(tokens) - shared))
        edges = []
        for i in linked[:len(linked) if upto is None else np.searchsorted(linked, upto)].tolist():
            if self.every:
                edges.append((sid, self.sids[i]))
                continue
            a, b = self.root(sid), self.root(self.sids[i])
            if a != b:
                self.parent[a] = b
                edges.append((sid, self.sids[i]))
        return edges


def _opened(threshold: int, within: bool, every: bool = False):
    """Rows sorted by (gid, salt, query): first a part's members, then its queries."""
    def inside(key: tuple[int, int] | None, group: _Group | None) -> list[tuple[int, int]]:
        # links between members are found once, where the salt is 0
        if group is None or key[1] or not within:
            return []
        return [e for i in range(1, len(group.sids)) for e in group.links(group.sids[i], group.sets[i], i)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, group, last = None, None, None
        for batch in batches:
            edges: list[tuple[int, int]] = []
            for gid, salt, query, sid, data in zip(batch["gid"], batch["salt"], batch["query"],
                                                   batch["sid"], batch["tokens"]):
                if (gid, salt) != current:
                    edges += inside(current, group)
                    current, group = (gid, salt), _Group(threshold, every)
                tokens = np.frombuffer(data, U64)
                if every:
                    # repeated rows, and other texts under the id that stands for the set
                    if last == (gid, salt, query, sid) or set_id(tokens) != sid:
                        continue
                    last = gid, salt, query, sid
                if not query:
                    group.add(sid, tokens)
                elif group.sids:
                    edges += group.links(sid, tokens)
            yield pd.DataFrame(edges, columns=["src", "dst"], dtype="int64")
        yield pd.DataFrame(inside(current, group), columns=["src", "dst"], dtype="int64")
    return run


def link_edges(docs: DataFrame, narrow: DataFrame, sets: DataFrame, size: int = SIZE,
               threshold: int = THRESHOLD, every: bool = False) -> DataFrame:
    """Edges (src, dst) of set ids: a spanning forest per opened part of a group.

    With ``every`` all pairs of linked sets, each of them once.

    ``narrow`` has (doc_id, sid, prefix) of every document, ``sets`` has
    (sid, n, least, rep): distinct sets with the band that groups them and the id of one
    document that holds each.
    """
    def overlap(a: str, b: str) -> str:
        return _least_overlap(a, b, threshold)

    crowd = (sets.groupBy("least").agg(F.sum("n").alias("held"), F.count("*").alias("c"))
             .where("c > 1").select(F.col("least").alias("l"), F.least(
                 F.ceil(F.col("held") / GROUP_SHINGLES), F.col("c")).alias("parts")))
    # the last bit of a group's id is free to mark an entry of the matrix
    gid = F.xxhash64("least", F.pmod(F.xxhash64("sid"), F.coalesce("parts", F.lit(1)))).bitwiseAND(-2)
    grouped = cut_lineage(sets.join(crowd, F.col("least") == F.col("l"), "left")
                          .select("sid", "n", gid.alias("gid"), "rep",
                                  F.col("parts").isNotNull().alias("several")))
    ranges = cut_lineage(grouped.groupBy("gid").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("members")))

    # 3. entries (token, group) of the token unions; odd ones are in the shorter
    # prefix as well and make the matrix, all of them together are the queries
    short = F.expr(f"n - {overlap('n', 'n')} + 1")
    prefixes = grouped.join(narrow.select("doc_id", F.col("sid").alias("s"), "prefix"),
                            (F.col("rep") == F.col("doc_id")) & (F.col("sid") == F.col("s")))
    placed = prefixes.select("gid", "several", short.alias("short"), F.posexplode("prefix").alias("at", "token"))
    entry = F.col("gid").bitwiseOR((F.col("at") < F.col("short")).cast("long"))
    entries = placed.select("token", entry.alias("entry"), "several")
    entries = (entries.where("not several").drop("several")
               .unionByName(entries.where("several").drop("several").distinct()))
    # both sides are the same rows, so they are shuffled once; a condition on one
    # side alone would be moved below the shuffle
    shared = (entries.alias("m").join(entries.alias("q"), "token")
              .where("case when m.entry & 1 = 1 then m.entry | 1 <> q.entry | 1 else false end")
              .select(F.col("m.entry").bitwiseAND(-2).alias("gid"),
                      F.col("q.entry").bitwiseAND(-2).alias("qid"))
              .groupBy("gid", "qid").agg(F.count("*").alias("shared")))

    # 4. the bound, with the sizes m of the group and q of the query group: linked
    # sets share at least f(q, m) + 1 entries; f is 0 at m = q and at m = t * q and
    # least in a corner between them (less 1 for rounding)
    corners = [f"{overlap(q, m)} - greatest({overlap(m, m)}, (q_hi * {threshold} + 99) div 100)"
               for q in ("q_lo", "q_hi") for m in ("lo", "hi")]
    bound = F.expr(f"case when hi <= q_lo and 100 * lo >= {threshold} * q_hi "
                   f"then greatest(0, least({', '.join(corners)}) - 1) else 0 end")
    large = ranges.select(F.col("gid").alias("qid"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"))
    opened = cut_lineage(
        shared.join(ranges, "gid").join(large, "qid")
        .where("q_hi >= lo").where(100 * F.col("hi") >= threshold * F.col("q_lo"))
        .where(F.col("shared") > bound)
        .groupBy(F.least("gid", "qid").alias("gid"), F.greatest("gid", "qid").alias("qid"))
        .agg(F.sum("shared").alias("shared")))

    inner = ranges.where("members > 1").select("gid", F.lit(0).alias("salt"))
    members = grouped.select("gid", "sid", "rep")
    if every:
        return _compared(docs, members, inner, opened.select("gid", "qid"), size, threshold, every)

    # every group first opens the one it shares most with; then only pairs of
    # groups are left that are not known to be connected already
    partner = F.struct("shared", F.col("other").alias("to"))
    nearest = (opened.select("gid", F.col("qid").alias("other"), "shared")
               .unionByName(opened.select(F.col("qid").alias("gid"), F.col("gid").alias("other"), "shared"))
               .groupBy("gid").agg(F.max(partner).alias("best"))
               .select(F.least("gid", "best.to").alias("gid"), F.greatest("gid", "best.to").alias("qid"))
               .distinct())
    nearest = cut_lineage(nearest)
    first = cut_lineage(_compared(docs, members, inner, nearest, size, threshold))
    roots = smallest_members(first)
    known = (members.join(roots, F.col("sid") == F.col("id"), "left")
             .groupBy("gid").agg(F.min(F.coalesce("root", "sid")).alias("low"),
                                 F.max(F.coalesce("root", "sid")).alias("high")))
    known = cut_lineage(known)
    others = known.select(F.col("gid").alias("qid"), F.col("low").alias("q_low"), F.col("high").alias("q_high"))
    rest = cut_lineage(
        opened.select("gid", "qid").join(nearest, ["gid", "qid"], "left_anti")
        .join(known, "gid").join(others, "qid")
        .where("not (low = high and q_low = q_high and low = q_low)").select("gid", "qid"))
    second = _compared(docs, members, None, rest, size, threshold)
    return first.unionByName(second)


def _compared(docs: DataFrame, members: DataFrame, inner: DataFrame | None, opened: DataFrame,
              size: int, threshold: int, every: bool = False) -> DataFrame:
    """Edges between the opened pairs of groups, and with ``inner`` inside those groups."""
    salts = opened.groupBy("gid").agg(
        F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("salts"))
    pairs = cut_lineage(opened.join(salts, "gid").withColumn("salt", F.expr(
        "cast(pmod(xxhash64(qid), salts) as int)")).select("gid", "qid", "salt"))

    # 5. who is compared where: members with their own part, queries with others
    own = pairs.select("gid", "salt")
    own = (own if inner is None else own.union(inner)).distinct()
    roles = cut_lineage(
        own.join(members, "gid").select("gid", "salt", F.lit(0).alias("query"), "sid", "rep")
        .unionByName(pairs.join(members.withColumnRenamed("gid", "qid"), "qid")
                     .select("gid", "salt", F.lit(1).alias("query"), "sid", "rep")))
    # only texts with a role are read again, once for up to ROLES places
    per_set = Window.partitionBy("rep", "sid")
    wanted = (roles.withColumn("lists", F.ceil(F.count("*").over(per_set) / ROLES))
              .groupBy("rep", "sid", F.pmod(F.xxhash64("gid", "salt"), F.col("lists")).alias("part"))
              .agg(F.collect_list(F.struct("gid", "salt", "query")).alias("places")).drop("part"))
    if roles.count() <= BROADCAST_ROLES:
        wanted = F.broadcast(wanted)
    blocks = (docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("rep"))
              .select("sid", "places", _tokens(size, "text").alias("tokens"))
              .select("sid", "tokens", F.inline("places")))
    return (blocks.repartition("gid", "salt").sortWithinPartitions("gid", "salt", "query", "sid")
            .select("gid", "salt", "query", "sid", "tokens")
            .mapInPandas(_opened(threshold, inner is not None, every), "src long, dst long"))


def _sets(docs: DataFrame, size: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``narrow`` and ``sets`` as ``link_edges`` takes them."""
    frequent, bits = frequent_shingles(docs, size)
    narrow = cut_lineage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _prefixes(frequent, bits, size, threshold), "doc_id long, sid long, n long, bands array<long>, prefix array<long>"))
    sets = (narrow.where("sid is not null and doc_id is not null").groupBy("sid")
            .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("bands").alias("bands")))
    sets = cut_lineage(sets)
    # the band of each set that most sets share; a set that shares none is a group of its own
    bands = sets.select("sid", F.explode("bands").alias("band"))
    shared = cut_lineage(bands.groupBy("band").agg(F.count("*").alias("c")).where("c > 1"))
    best = cut_lineage(bands.join(shared, "band").groupBy("sid").agg(F.max(F.struct("c", "band")).alias("best"))
                       .select(F.col("sid").alias("s"), F.col("best.band").alias("band")))
    grouped = cut_lineage(sets.join(best, F.col("sid") == F.col("s"), "left").select(
        "sid", "rep", "n", F.coalesce("band", F.col("bands")[0]).alias("least")))
    discard(sets, shared, best)
    return narrow, grouped


def link_counts(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document id: doc_id, n_links, the number of other ids it is linked with.

    All candidate pairs of distinct sets are verified, so a group of n near copies
    costs up to n * n comparisons. Ids are counted once however often their rows
    are repeated; null ids neither count nor get a row.
    """
    narrow, sets = _sets(docs, size, threshold)
    edges = cut_lineage(link_edges(docs, narrow, sets, size, threshold, every=True))
    pairs = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    pairs = pairs.unionByName(sets.select(F.col("sid").alias("src"), F.col("sid").alias("dst")))
    held = cut_lineage(narrow.where("doc_id is not null").select("doc_id", "sid").distinct())
    # an id with several texts can meet another one by more than one pair of sets
    several = held.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    plain = held.join(several, "doc_id", "left_anti")
    copies = plain.where("sid is not null").groupBy(F.col("sid").alias("dst")).agg(F.count("*").alias("c"))
    by_set = pairs.join(copies, "dst").groupBy(F.col("src").alias("sid")).agg(F.sum("c").alias("c"))
    simple = (plain.join(by_set, "sid", "left")
              .select("doc_id", F.coalesce(F.col("c") - 1, F.lit(0)).alias("n")))
    # what has an end in an id with several texts is counted pair by pair
    odd = held.join(several, "doc_id")
    met = (odd.join(pairs, odd["sid"] == pairs["src"]).select(F.col("doc_id").alias("a"), "dst")
           .join(held.select(F.col("doc_id").alias("b"), "sid"), F.col("dst") == F.col("sid"))
           .where("a <> b").select("a", "b").distinct())
    back = met.join(several.select(F.col("doc_id").alias("b")), "b", "left_anti").select(
        F.col("b").alias("doc_id"), F.lit(1).alias("n"))
    ids = several.select("doc_id", F.lit(0).alias("n"))
    return (simple.unionByName(met.select(F.col("a").alias("doc_id"), F.lit(1).alias("n")))
            .unionByName(back).unionByName(ids)
            .groupBy("doc_id").agg(F.sum("n").cast("long").alias("n_links")))


def near_duplicates(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, sid.

    Documents link when 100 * intersection >= ``threshold`` * union of their sets of
    ``size``-word shingles.
    ``component_id`` is the smallest doc_id reachable by links, itself included;
    null and blank texts have no shingles and are linked with nothing. Repeated
    rows of one id each get their row. A document without an id takes part under
    the ids of its copies and gets its own null as component if it has none.
    An empty table gives an empty result; other columns are ignored. Links
    themselves are not listed or counted, see ``link_counts``.
    """
    narrow, sets = _sets(docs, size, threshold)
    edges = cut_lineage(link_edges(docs, narrow, sets, size, threshold))
    reps = sets.select("sid", "rep")
    by_rep = (edges.join(reps.select(F.col("sid").alias("src"), F.col("rep").alias("a")), "src")
              .join(reps.select(F.col("sid").alias("dst"), F.col("rep").alias("b")), "dst")
              .select(F.col("a").alias("src"), F.col("b").alias("dst")))
    roots = smallest_members(by_rep)
    component = (reps.join(roots, F.col("rep") == F.col("id"), "left")
                 .select("sid", F.coalesce("root", "rep").alias("root")))
    return (narrow.select("doc_id", "sid", F.col("n").alias("n_shingles"))
            .join(component, "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"), "sid"))


def keep_one(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates of a smaller id.

    Of each group of linked documents the one of its component_id stays. Rows
    without shingles stay, as do rows without an id, which cannot be told apart,
    and rows that repeat the id of one that stays.
    """
    gone = (near_duplicates(docs, size, threshold).where("doc_id <> component_id")
            .select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
