import random

import pytest

from pyspark.sql import functions as F

from contrail.operators import intervals, ranges
from contrail.plans import registry

SCHEMA = "range_start string, range_end string, country_code string"


def brute(keys, rows):
    out = []
    for i, key in keys:
        hits = [r for r in rows if key is not None and r[0] <= key <= r[1]]
        out += [(i, key, *r) for r in hits] or [(i, key, None, None, None)]
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.select(
        "id", "icao24", "range_start", "range_end", "country_code").collect()], key=repr)


def test_bucketed_join_equals_text_comparison_for_any_key(spark):
    rng = random.Random(7)
    rows = [("3b0000", "3bffff", "DE"), ("780000", "783fff", "NO"), ("780800", "780fff", "JP"),
            ("ffff00", "ffffff", "XX"), ("zz", "zzz", "ODD"), ("12", "34", "SHORT"),
            ("900000", "100000", "EMPTY"), ("3b:", "3c", "COLON")]
    keys = [None, "", "3b", "3b:abc", "3b0000", "3bffff", "3c0000", "780800", "780fff", "ffff80",
            "zzz", "ZZ0000", "é80000", "2", "999999999"]
    keys += ["%06x" % rng.randrange(16 ** 6) for _ in range(200)]
    keys += ["%06x" % rng.randrange(0x780000, 0x784000) for _ in range(100)]
    keys = list(enumerate(keys))
    df = spark.createDataFrame(keys, "id int, icao24 string")
    table = spark.createDataFrame(rows, SCHEMA)
    expected = brute(keys, rows)
    assert found(ranges.range_classify(df, table)) == expected


def test_bucketed_join_without_broadcast_and_with_a_hot_key(spark):
    rows = [("3b0000", "3bffff", "DE"), ("780000", "783fff", "NO"), ("780800", "780fff", "JP")]
    keys = list(enumerate(["780801"] * 400 + ["3b0001"] * 50 + [None] * 300 + ["000001"] * 50))
    df = spark.createDataFrame(keys, "id int, icao24 string")
    table = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(ranges.range_classify(df, table)) == brute(keys, rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pieces_cover_whole_ranges(spark):
    table = spark.createDataFrame([("3afff0", "3b1001", "A")], SCHEMA)
    pieces = {r["_piece"] for r in ranges.range_pieces(table).collect()}
    assert pieces == {"3af", "3b0", "3b1", "*"}


@pytest.mark.parametrize("row_matches", [100_000, 7])
def test_growing_tables_are_compared_by_distinct_keys(spark, monkeypatch, row_matches):
    """Fine prefixes, and one list of matches for a row instead of a joined row for each."""
    monkeypatch.setattr(ranges, "ROW_MATCHES", row_matches)
    rng = random.Random(9)
    rows = [("3b0000", "3bffff", "DE"), ("zz", "zzz", "ODD"), ("900000", "100000", "EMPTY"), ("3b:", "3c", "COLON")]
    blocks = [("%06x" % low, "%06x" % (low + 95), "B") for low in (0x780000 + 64 * (i % 30) for i in range(120))]
    keys = [None, "", "3b", "3b:abc", "3bffff", "3c0000", "zzz", "é80000"] + ["780801"] * 50
    keys += ["%06x" % rng.randrange(0x77f000, 0x781000) for _ in range(200)]
    keys = list(enumerate(keys))
    df = spark.createDataFrame(keys, "id int, icao24 string")
    pieces = []
    monkeypatch.setattr(ranges, "range_pieces", lambda t, d=3, real=ranges.range_pieces: pieces.append(d) or real(t, d))
    for table, digits in ((blocks, 5), (rows + blocks, 3), ([], 3)):
        joined = ranges.range_classify(df, spark.createDataFrame(table, SCHEMA), by_keys=True)
        assert found(joined) == brute(keys, table) and pieces.pop() == digits
        assert "inline" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join", [lambda df, t: ranges.range_classify(df, t, by_keys=True), intervals.interval_join])
def test_rows_are_computed_once_for_keys_and_matches(spark, join):
    table = spark.createDataFrame([("3b0000", "3bffff", "DE"), ("3a0000", "3bffff", "AA")], SCHEMA)
    df = spark.createDataFrame([(1, "3b0001"), (2, None)], "id int, icao24 string").withColumn("digest", F.md5("icao24"))
    joined = join(df, table)
    assert "md5" not in joined._jdf.queryExecution().optimizedPlan().toString()
    # matches in order, so that equal values follow each other where rows are written
    assert [r["range_start"] for r in joined.where("id = 1").collect()] == ["3a0000", "3b0000"]
    assert found(joined) == brute([(1, "3b0001"), (2, None)], [tuple(r) for r in table.collect()])


@pytest.mark.parametrize("most,operator", [(10, "BroadcastHashJoin"), (1, "SortMergeJoin")])
def test_lists_are_broadcast_by_their_matches(spark, monkeypatch, most, operator):
    monkeypatch.setattr(ranges, "BROADCAST_MATCHES", most)
    table = spark.createDataFrame([("3b0000", "3bffff", "DE"), ("3a0000", "3bffff", "AA")], SCHEMA)
    keys = [(1, "3b0001"), (2, "000000"), (3, None)]
    joined = ranges.range_classify(spark.createDataFrame(keys, "id int, icao24 string"), table, by_keys=True)
    assert operator in joined._jdf.queryExecution().executedPlan().toString()
    assert found(joined) == brute(keys, [tuple(r) for r in table.collect()])


@pytest.mark.parametrize("name", ["interval_text_keys", "range_classify_bucketed", "interval_classify"])
def test_repeated_ids_are_packed(spark, small, tmp_path, name):
    setting = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(setting)
    try:
        registry.queries()[name](spark, small).write.parquet(f"{tmp_path}/out")
    finally:
        spark.conf.set(setting, before)
    assert all(".zstd." in f.name for f in (tmp_path / "out").glob("*.parquet"))
