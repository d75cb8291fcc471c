"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one
window). A document contains a window only if it contains every shingle of it, so
one shingle is a necessary prefix: with shingles ordered by how often the corpus
has them, the rarest. Documents are probed with the distinct prefixes; the few
survivors carry the words around them and are verified word by word, after the
length and positional bounds (the window has to fit before and behind the place).

Documents are read twice: to count the items' shingles, and to probe. Only the
distinct prefixes (8 bytes each) are broadcast, in blocks of a fixed number, so a
large benchmark means more passes and never more memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.columns import alphanumeric_words, let
from contrail.session import cut_lineage

WINDOW = 10
SHINGLE = 3
# distinct prefixes in one broadcast: 16 MB of keys and a hash table of about 64 MB
BROADCAST_KEYS = 1_000_000


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, win, m): every window of every item as text and its number of words."""
    windows = let(alphanumeric_words(F.col(text)), lambda w: F.when(
        F.size(w) > WINDOW, F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                                        lambda i: F.slice(w, i, WINDOW)))
        .when(F.size(w) > 0, F.array(w)).otherwise(F.array().cast("array<array<string>>")))
    return (benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             F.explode(windows).alias("w"))
            .select("item", F.array_join("w", " ").alias("win"), F.size("w").alias("m"))
            .distinct())


def shingle_keys(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; the size is part of the hash."""
    return F.when(F.size(words) < size, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - size),
                    lambda i: F.xxhash64(F.lit(size), *(words[i + k] for k in range(size)))))


def window_shingles(windows: DataFrame) -> DataFrame:
    """(win, m, size, at, key) of every shingle; windows below SHINGLE words are one shingle."""
    words = F.split("win", " ")
    keys = F.coalesce(*(F.when(F.least(F.col("m"), F.lit(SHINGLE)) == s, shingle_keys(words, s))
                        for s in range(1, SHINGLE + 1)))
    return (windows.select("win", "m").distinct()
            .select("win", "m", F.least(F.col("m"), F.lit(SHINGLE)).alias("size"),
                    F.posexplode(keys).alias("at", "key")))


def _probes(docs: DataFrame, sizes: list[int], marker: bool) -> DataFrame:
    """One row (doc columns, words, pos, key) per place and shingle size.

    With ``marker`` every document has one more row at place -1 without a key.
    """
    def places(w: Column) -> Column:
        parts = [F.transform(shingle_keys(w, s), lambda k, i: F.struct(i.alias("pos"), k.alias("key")))
                 for s in sizes]
        if marker:
            own = F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("key"))
            parts.append(F.array(own))
        return F.concat(*parts)

    # hashes of rows that only count words need no text column afterwards
    return (docs.withColumn("words", alphanumeric_words(F.col("text")))
            .select(*(c for c in docs.columns if c != "text"), "words",
                    F.inline(places(F.col("words")))))


def matches(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, occurrences): (doc_id, th, n_words) of every row, and the distinct
    (doc_id, th, start, m, win) of windows found in them; ``th`` is a hash of the text."""
    shingles = cut_lineage(window_shingles(windows))
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())
    source = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    found = _blocks(shingles.select("key").distinct(), "key")
    # how often the corpus has each shingle of the items
    counts = None
    for block in found:
        part = (_probes(docs.select("text"), sizes, False).select("key")
                .join(block, "key", "left_semi").groupBy("key").agg(F.count("*").alias("n")))
        counts = part if counts is None else counts.union(part)
    order = Window.partitionBy("win").orderBy("n", "key", "at")
    prefix = shingles.select("win", "m", "at", "key")
    if counts is not None:
        prefix = (prefix.join(counts, "key", "left").fillna(0, ["n"])
                  .withColumn("r", F.row_number().over(order)).where("r = 1").drop("r", "n"))
    prefix = cut_lineage(prefix)
    survivors = None
    before = WINDOW - 1
    for number, block in enumerate(_blocks(prefix.select("key").distinct(), "key") or [None]):
        rows = _probes(source, sizes, number == 0)
        if block is None:
            rows = rows.withColumn("hit", F.lit(None).cast("boolean"))
        else:
            rows = rows.join(block.withColumn("hit", F.lit(True)), "key", "left")
        rows = rows.where("hit or pos = -1").select(
            "doc_id", "th", "pos", "key", F.size("words").alias("n_words"),
            # words around the place; the first is at place pos - before, or at 0
            F.when(F.col("pos") >= 0, F.slice("words", F.greatest(F.col("pos") - before, F.lit(0)) + 1,
                                              2 * WINDOW)).alias("near"))
        survivors = rows if survivors is None else survivors.unionByName(rows)
    survivors = cut_lineage(survivors)
    documents = survivors.where("pos = -1").select("doc_id", "th", F.col("n_words").cast("long"))
    start = F.col("pos") - F.col("at")
    occurrences = (survivors.where("pos >= 0").join(prefix, "key")
                   .withColumn("start", start)
                   .where((F.col("start") >= 0) & (F.col("start") + F.col("m") <= F.col("n_words")))
                   .withColumn("here", F.array_join(F.slice(
                       "near", F.col("start") - F.greatest(F.col("pos") - before, F.lit(0)) + 1,
                       F.col("m")), " "))
                   .where("here = win")
                   .select("doc_id", "th", "start", "m", "win").distinct())
    return documents, occurrences


def _blocks(keys: DataFrame, column: str) -> list[DataFrame]:
    """``keys`` in parts of about BROADCAST_KEYS rows, each marked for broadcast."""
    total = keys.count()
    parts = -(-total // BROADCAST_KEYS)
    if parts <= 1:
        return [F.broadcast(keys)] * parts
    return [F.broadcast(keys.where(F.pmod(F.hash(column), F.lit(parts)) == p)) for p in range(parts)]


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits. Repeated rows each get their
    row; rows that share an id but not the text are told apart by a hash of the
    text. Empty items are never found; a null item_id counts as the empty string.
    An empty benchmark leaves every document clean. Other columns are ignored.
    """
    windows = cut_lineage(item_windows(benchmark))
    documents, occurrences = matches(docs, windows)
    occurrences = cut_lineage(occurrences)
    reach = F.max(F.col("start") + F.col("m")).over(
        Window.partitionBy("doc_id", "th").orderBy("start", "m").rowsBetween(
            Window.unboundedPreceding, -1))
    spans = occurrences.select("doc_id", "th", "start", "m").distinct()
    hits = (spans.withColumn("from", F.greatest(F.col("start"), F.coalesce(reach, F.lit(0))))
            .groupBy("doc_id", "th")
            .agg(F.sum(F.greatest(F.col("start") + F.col("m") - F.col("from"), F.lit(0)))
                 .cast("long").alias("n_hit")))
    items = (occurrences.select("doc_id", "th", "win").distinct()
             .join(windows.select("win", "item"), "win")
             .select("doc_id", "th", "item").distinct()
             .groupBy("doc_id", "th")
             .agg(F.count("*").alias("n_items"),
                  F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256)
                  .alias("items_sha256")))
    found = hits.join(items, (hits.doc_id.eqNullSafe(items.doc_id)) & (hits.th == items.th)).select(
        hits.doc_id.alias("h_id"), hits.th.alias("h_th"), "n_hit", "n_items", "items_sha256")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return (documents.join(found, documents.doc_id.eqNullSafe(found.h_id) & (documents.th == found.h_th),
                           "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.coalesce("items_sha256", none).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def contaminated_ids(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Distinct (c_id, c_th) of texts that hold a window: the id and the text's hash."""
    _, occurrences = matches(docs, cut_lineage(item_windows(benchmark)))
    return occurrences.select(F.col("doc_id").alias("c_id"), F.col("th").alias("c_th")).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their own columns."""
    found = contaminated_ids(docs, benchmark)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["c_id"])
                     & (F.xxhash64(docs["text"]) == found["c_th"]), "left_anti")
