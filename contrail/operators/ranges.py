"""Classification of text keys by inclusive, possibly overlapping ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.session import cut_lineage

# Addresses are six hex digits; three of them name a bucket.
BUCKET_DIGITS = 3
ANY_BUCKET = "*"
# A growing range table is listed by longer prefixes as long as a range touches so many on average.
PIECES, MAX_DIGITS = 16, 6
# matches of a key that one row lists at most, about
ROW_MATCHES = 100_000
# Matches whose lists may be broadcast, about 100 bytes each; files say little of their size.
BROADCAST_MATCHES = 2_000_000


def range_classify(df: DataFrame, ranges: DataFrame, key: str = "icao24",
                   by_keys: bool = False) -> DataFrame:
    """Left join on ``range_start <= key <= range_end``; overlaps multiply rows.

    An equi join on a key prefix plus the range condition.

    A key whose prefix is hex can only lie in a range whose start and end prefix
    enclose it, and for lower-case hex text order is number order, so a range is
    listed once per prefix it touches. A null key is in no bucket; any other key
    meets every range in one extra bucket, which keeps text comparison exact for arbitrary keys. Being an
    equi join, it is broadcast when the range table is small enough for the
    session's threshold and is otherwise shuffled, where adaptive execution
    splits a bucket that holds much of the data.

    ``by_keys`` is for range tables that grow with the data: prefixes are as long as the
    ranges allow, so that a bucket holds little more than what matches, and only distinct
    keys are compared; rows meet the lists of their keys' matches.
    """
    if by_keys:
        return _classify_by_keys(df, ranges, key)
    pieces = range_pieces(ranges)
    bucketed = df.withColumn("_bucket", key_bucket(F.col(key)))
    matched = bucketed.join(
        pieces,
        (bucketed["_bucket"] == pieces["_piece"])
        & (bucketed[key] >= pieces["range_start"])
        & (bucketed[key] <= pieces["range_end"]),
        "left")
    return matched.drop("_bucket", "_piece")


def _classify_by_keys(df: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    listed = cut_lineage(ranges.filter(F.col("range_start") <= F.col("range_end"))
                         .withColumn("_range", F.monotonically_increasing_id()))
    digits = range(BUCKET_DIGITS, MAX_DIGITS + 1)
    count, *touched = listed.agg(F.count(F.lit(1)), *[
        F.sum((high - low + 1).cast("bigint")) for low, high in map(_buckets_of, digits)]).first()
    fine = max((d for d, n in zip(digits, touched) if n and n <= PIECES * count), default=BUCKET_DIGITS)
    df = cut_lineage(df)  # read twice, for its keys and for its rows
    keys = df.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    pieces = range_pieces(listed, fine)
    found = keys.withColumn("_bucket", key_bucket(F.col("_key"), fine)).join(
        pieces, (F.col("_bucket") == F.col("_piece")) & (F.col("_key") >= F.col("range_start"))
        & (F.col("_key") <= F.col("range_end")))
    return with_matches(df, found, key, ranges.columns, count)


def with_matches(df: DataFrame, found: DataFrame, key: str, columns: list[str], count: int) -> DataFrame:
    """Rows with the columns of all matches of their key, null where there are none.

    ``found`` holds matches (_key, _range, columns) of ``count`` ranges. A key's matches are
    lists in a few rows, so that a row meets lists and what it computes is computed once, not
    for every match. Lists are in order, so that equal values follow each other where rows
    are written.
    """
    matches = F.collect_list(F.struct(*columns))
    types = [found.schema[c].dataType for c in columns]
    if all(isinstance(t, T.AtomicType) and not isinstance(t, T.VariantType) for t in types):
        matches = F.sort_array(matches)
    lists = cut_lineage(
        found.groupBy("_key", F.pmod("_range", F.lit(max(1, -(-count // ROW_MATCHES)))).alias("_list"))
        .agg(matches.alias("_matches")).drop("_list"))
    listed = lists.agg(F.sum(F.size("_matches"))).first()[0] or 0
    held = lists if listed <= BROADCAST_MATCHES else lists.hint("merge")
    return df.join(held, df[key] == held["_key"], "left").select(
        *(df[c] for c in df.columns), F.inline_outer("_matches"))


def key_bucket(key: Column, digits: int = BUCKET_DIGITS) -> Column:
    prefix = F.substring(key, 1, digits)
    return F.when(_is_hex(prefix, digits), prefix).when(key.isNotNull(), F.lit(ANY_BUCKET))


def _buckets_of(digits: int) -> tuple[Column, Column]:
    """Numbers of the first and the last bucket that a range touches."""
    first, last = F.substring("range_start", 1, digits), F.substring("range_end", 1, digits)
    regular = _is_hex(first, digits) & _is_hex(last, digits)
    return (F.when(regular, F.conv(first, 16, 10).cast("int")).otherwise(0),
            F.when(regular, F.conv(last, 16, 10).cast("int")).otherwise(16 ** digits - 1))


def range_pieces(ranges: DataFrame, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Each range once per bucket it touches and once in the extra bucket."""
    low, high = _buckets_of(digits)
    names = F.transform(
        F.sequence(low, high),
        lambda n: F.lower(F.lpad(F.hex(n.cast("bigint")), digits, "0")))
    ordered = ranges.filter(F.col("range_start") <= F.col("range_end"))
    return ordered.withColumn(
        "_piece", F.explode(F.concat(names, F.array(F.lit(ANY_BUCKET)))))


def _is_hex(prefix: Column, digits: int = BUCKET_DIGITS) -> Column:
    return prefix.rlike(f"^[0-9a-f]{{{digits}}}$")
