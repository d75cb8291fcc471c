"""Mixing sources to target weights by hierarchical budgets.

Budgets go down a tree (domain, language, source). Each node hands its budget to
its children in proportion to their weights, but no child gets more than its
subtree holds in the allowed number of epochs: what a child cannot use goes to its
siblings, and because a subtree's own budget is set the same way one level up, a
shortage leaves the family only when all siblings are full. The level is found in
closed form with window sums over the children (sorted by how soon they fill up),
in integers, so the budgets add up exactly.

A leaf takes whole epochs and a prefix of the next: documents in the order of a
seeded digest, the last one in part. The prefix is found over buckets of digest
values first, so only the bucket where the budget ends is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import cut_lineage

LEVELS = ("domain", "lang", "source")
MAX_EPOCHS = 2
# rows of a leaf that share one bucket of the seeded order, about
BUCKET_ROWS = 65_536


def count_words(text: Column) -> Column:
    """Tokens of a text for budgeting: runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x09-\x0D\x20]+")).cast("long")


def water_fill(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """``nodes`` (parents, name, cap, weight, budget of the parent) with their ``share``.

    ``budget`` is at most the sum of the caps of nodes with a weight; products of
    budget or cap and weight have to fit a long (else an overflow error).
    """
    family = Window.partitionBy(*parents)
    ordered = family.orderBy("ratio", name).rowsBetween(Window.unboundedPreceding, -1)
    by_name = family.orderBy("full", name)
    rem, left = F.expr("budget - cap_before"), F.expr("weight_all - weight_before")
    filled = (nodes.withColumn("ratio", F.expr("cast(cap as double) / nullif(weight, 0)"))
              .withColumn("ratio", F.coalesce("ratio", F.lit(float("inf"))))
              .withColumn("weight_all", F.sum("weight").over(family))
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(ordered), F.lit(0)))
              .withColumn("weight_before", F.coalesce(F.sum("weight").over(ordered), F.lit(0)))
              .withColumn("full", (F.col("weight") > 0) & (F.col("cap") * left <= rem * F.col("weight")))
              .withColumn("cap_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family),
                                                 F.lit(0)))
              .withColumn("weight_open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight")))
                                                    .over(family), F.lit(0)))
              .withColumn("part", F.expr("case when full then cap when weight = 0 then 0 else "
                                         "(budget - cap_full) * weight div weight_open end"))
              .withColumn("missing", F.col("budget") - F.sum("part").over(family))
              .withColumn("turn", F.sum(F.expr("cast(not full and weight > 0 as long)")).over(
                  by_name.rowsBetween(Window.unboundedPreceding, 0))))
    extra = F.expr("cast(not full and weight > 0 and turn <= missing as long)")
    return filled.withColumn("share", F.col("part") + extra).select(
        *parents, name, "cap", (F.col("part") + extra).alias("share"))


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], total: Column, *,
                 levels: Sequence[str] = LEVELS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (levels, tokens) with ``budget``, handed down from ``total``.

    ``weights`` has whole numbers by level and node name, 1 where none is given.
    Only nodes on a path without a weight of 0 count.
    """
    def weight_of(level: str) -> Column:
        known = weights.get(level, {})
        found = F.lit(None).cast("long")
        for node, w in known.items():
            found = F.when(F.col(level) == node, F.lit(w).cast("long")).otherwise(found)
        return F.coalesce(found, F.lit(1).cast("long"))

    usable = F.lit(True)
    for level in levels:
        usable = usable & (weight_of(level) > 0)
    tree = leaves.withColumn("cap", F.when(usable, F.col("tokens") * max_epochs).otherwise(0))
    shares = tree.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("c")).select(
        F.least(F.col("c"), total).alias("budget"))
    for depth, level in enumerate(levels):
        parents = list(levels[:depth])
        nodes = tree.groupBy(*parents, level).agg(F.sum("cap").alias("cap")).withColumn(
            "weight", weight_of(level))
        # the root's budget is one row
        nodes = nodes.join(shares, parents) if parents else nodes.join(F.broadcast(shares))
        shares = water_fill(nodes, parents, level).select(
            *parents, level, F.col("share").alias("budget"))
    return leaves.join(shares, list(levels))


def mixture(docs: DataFrame, weights: Mapping[str, Mapping[str, int]], *, seed: int,
            share: tuple[int, int] | None = None, total_tokens: int | None = None,
            levels: Sequence[str] = LEVELS, max_epochs: int = MAX_EPOCHS,
            tokens: Column | None = None) -> DataFrame:
    """Rows (doc_id, levels, epoch, n_tokens, n_taken) of the mixture.

    The total is ``total_tokens``, or ``share`` = (a, b) of all tokens. Texts
    without tokens are never taken. A null level is the node ''. Rows that repeat
    an id are documents of their own, in the same place of the order. An empty
    table gives an empty mixture; a total beyond all epochs takes everything.
    """
    count = tokens if tokens is not None else count_words(F.col("text"))
    narrow = cut_lineage(docs.select(
        "doc_id", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels),
        count.alias("n_tokens")).where("n_tokens > 0"))
    keys = list(levels)
    leaves = narrow.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    if share is None:
        total = F.lit(total_tokens).cast("long")
    else:
        held = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        total = F.lit(held * share[0] // share[1]).cast("long")
    plan = cut_lineage(leaf_budgets(leaves, weights, total, levels=levels, max_epochs=max_epochs)
                       .withColumn("rounds", F.expr("budget div tokens"))
                       .withColumn("rest", F.expr("budget % tokens"))
                       # hexadecimal digits that leave about BUCKET_ROWS rows in a bucket
                       .withColumn("digits", F.greatest(F.lit(0), F.ceil(
                           F.log(F.col("n_docs") / BUCKET_ROWS) / F.log(F.lit(16.0)))).cast("int")))
    placed = narrow.join(plan, keys)
    whole = placed.where("rounds > 0").select(
        "doc_id", *keys, F.explode(F.expr("sequence(1, cast(rounds as int))")).alias("epoch"),
        "n_tokens", F.col("n_tokens").alias("n_taken"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("rounds") + 1).cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                  .cast("binary"))
    last = (placed.where("rest > 0").withColumn("place", place)
            .withColumn("bucket", F.expr("left(place, digits)")))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (last.groupBy(*keys, "bucket").agg(F.sum("n_tokens").alias("held"))
               .withColumn("bucket_start", F.coalesce(F.sum("held").over(before), F.lit(0))))
    # buckets behind the end of the budget leave no row; those before it are taken whole
    reached = last.join(buckets, [*keys, "bucket"]).where("bucket_start < rest")
    inside = Window.partitionBy(*keys, "bucket").orderBy("place", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, -1)
    full = reached.where("bucket_start + held <= rest").withColumn("n_taken", F.col("n_tokens"))
    cut = (reached.where("bucket_start + held > rest")
           .withColumn("start", F.col("bucket_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
           .where("start < rest")
           .withColumn("n_taken", F.least(F.col("n_tokens"), F.col("rest") - F.col("start"))))
    columns = ["doc_id", *keys, (F.col("rounds") + 1).cast("int").alias("epoch"), "n_tokens", "n_taken"]
    return whole.unionByName(full.select(*columns)).unionByName(cut.select(*columns))
