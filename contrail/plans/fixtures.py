"""Flight inputs derived from the star-schema tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: flights of the last nation use an airport id that no nation has.
LAST_NATION, UNKNOWN_AIRPORT = 24, 99
# Columns the fixtures read; a declared schema saves a file-sampling job per table.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double",
}

# Callsign prefixes by remainder of the part key.
CALLSIGNS = ("rch", "RRR", "gaf", "PLF", "CNV", "LAGR", "TITAN", "VIPER", "HAWK", "VENOM",
             "RAGE", "HOMER", "FORTE", "DLH")
# How far along its block a flight goes, by remainder of the customer
# key; null leads to the first nation of the block.
HOPS = (1, 1, 1, 1, 1, 1, 4, 4, None, 0, 1, 1, 1, 1, 1, 1, 4, 4, None, 2)

# Military address ranges of the fixture.
RANGES = (
    (" 3B0000", "3bffff ", "de", "Germany", "Branch A", "x"),
    ("ae0000", "aeffff", "US", "United States", "Branch B", "x"),
    ("780000", "783fff", "NO", "Norway", "Branch C", "x"),
    ("780800", "780fff", "JP", "Japan", "Branch D", "overlaps NO"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _array(values) -> str:
    return "array(" + ", ".join("null" if v is None else repr(v) for v in values) + ")"


def _airport(nation: str) -> str:
    return (f"concat('n', lpad(string(if({nation} = {LAST_NATION}, {UNKNOWN_AIRPORT}, {nation})), 3, '0'))")


def raw_flights(spark: SparkSession, folder: str, day: dt.date | None = None) -> DataFrame:
    """Deliveries from line items: supplier nation to a nation of the same block.

    What depends on the order or the supplier alone is computed before the join. Line items
    of the test files lie in few row groups, which no reader splits: they are dealt by order,
    so that the join with large orders needs no other shuffle of them.
    ``day`` limits the scan to the line items shipped then.
    """
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", f"get({_array(HOPS)}, int(o_custkey % 20)) as hop")
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_suppkey", "s_nationkey",
        "if(s_nationkey < 15, 0, 15) as block", "if(s_nationkey < 15, 15, 10) as size",
        f"{_airport('s_nationkey')} as origin",
        "get(array(3866624, 11403264, 7866368), int(s_suppkey % 10)) as fleet",
        "s_suppkey % 10 between 3 and 7 as bursts",
        "int(200 + s_suppkey % 4800) as arrival_horiz",
        "int(10 + s_suppkey % 190) as arrival_vert",
        "int(1 + s_suppkey % 4) as arrival_candidates")
    shipped = table(spark, folder, "lineitem")
    if day:
        shipped = shipped.filter(f"l_shipdate >= timestamp_ntz '{day}' "
                                 f"and l_shipdate < timestamp_ntz '{day + dt.timedelta(days=1)}'")
    lines = shipped.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "date(l_shipdate) as source_date",
        "unix_timestamp(timestamp(l_shipdate))"
        " + (l_orderkey * 37 + l_linenumber * 11) % 86400 as first_seen")
    joined = (lines.repartition("l_orderkey").join(orders, lines["l_orderkey"] == orders["o_orderkey"])
              .join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]))
    return joined.selectExpr(
        "concat(' ', lpad(hex(coalesce(fleet, if(bursts and day(source_date) = 13"
        " and month(source_date) in (3, 9), 3866624, 2097152)) + l_partkey % 2048), 6, '0'),"
        " ' ') as icao24",
        "first_seen as firstSeen",
        "origin as estDepartureAirport",
        "first_seen + case when l_partkey % 97 = 0 then -60 when l_partkey % 101 = 0 then 90000"
        " else 1800 + bigint(l_quantity * 600) end as lastSeen",
        "if(l_linenumber = 7, null, "
        f"{_airport('(block + if(hop is null, 0, (s_nationkey - block + hop) % size))')})"
        " as estArrivalAirport",
        f"if(l_partkey % 50 = 0, null, concat(get({_array(CALLSIGNS)}, int(l_partkey % 14)),"
        " string(l_partkey % 1000))) as callsign",
        "int(200 + l_partkey % 4800) as estDepartureAirportHorizDistance",
        "int(10 + l_partkey % 190) as estDepartureAirportVertDistance",
        "arrival_horiz as estArrivalAirportHorizDistance",
        "arrival_vert as estArrivalAirportVertDistance",
        "int(1 + l_partkey % 4) as departureAirportCandidatesCount",
        "arrival_candidates as arrivalAirportCandidatesCount",
        "origin as _source_airport",
        "'departure' as _source_direction",
        "source_date")


def arrival_pull(raw: DataFrame) -> DataFrame:
    """The overlapping second pull: flights delivered again as arrivals."""
    return (raw.filter(F.col("departureAirportCandidatesCount") == 2)
            .withColumn("_source_direction", F.lit("arrival")))


def airport_metadata(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).selectExpr(
        "concat(' n', lpad(string(n_nationkey), 3, '0')) as airport_id",
        "n_name as airport_name",
        "concat('City ', n_name) as city",
        "substr(r_name, 1, 2) as country_code",
        "r_name as country_name",
        "double(-60 + (n_nationkey * 37) % 120) + 0.25d as latitude",
        "double(-170 + (n_nationkey * 71) % 340) + 0.5d as longitude",
        "'UTC' as timezone",
        "if(n_nationkey % 8 = 0, 'military', 'international') as airport_type")


def military_ranges(spark: SparkSession) -> DataFrame:
    """The fixed ranges as inline values, whose size the optimizer knows."""
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in RANGES)
    return spark.sql(f"select * from values {rows} as t(range_start, range_end, country_code, "
                     "country_name, military_branch, notes)")


def supplier_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A range table that grows with the data: one address block per supplier.

    Blocks start every 64 addresses and are 96 long, so neighbours overlap; they
    lie in the three military areas and the civil one of the flight fixture.
    """
    return (
        table(spark, folder, "supplier")
        .selectExpr("*", "get(array(3866624, 11403264, 7866368, 2097152), int(s_suppkey % 4))"
                    " + (s_suppkey div 4 * 64) % 65536 as start")
        .selectExpr(
            "concat(' ', lpad(hex(start), 6, '0')) as range_start",
            "concat(lpad(lower(hex(start + 95)), 6, '0'), ' ') as range_end",
            "concat('c', string(s_nationkey)) as country_code",
            "concat(' ', s_name) as country_name",
            "concat('Branch ', string(s_suppkey % 5)) as military_branch",
            "if(s_suppkey % 3 != 0, concat('block ', string(s_suppkey)), null) as notes"))


# The callsign blocks' prefixes by remainder of the supplier key.
BLOCK_PREFIXES = ("RCH", "GAF", "CNV", "HAWK", "TITAN")


def callsign_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping blocks of callsigns in text order, some of them empty: one per supplier."""
    return (
        table(spark, folder, "supplier")
        .selectExpr("s_suppkey", f"get({_array(BLOCK_PREFIXES)}, int(s_suppkey % 5)) as prefix",
                    "s_suppkey * 13 % 1000 as low")
        .selectExpr("concat(prefix, string(low)) as block_start", "concat(prefix, string(low + 7)) as block_end",
                    "s_suppkey as block_owner"))


# Every so many parts go to the first supplier, the hub; suppliers with this
# last digit deliver to nobody.
HUB_EVERY, DANGLING_DIGIT = 10, 7


def supply_links(spark: SparkSession, folder: str) -> DataFrame:
    """A weighted graph of suppliers that grows with the data, as connections.

    A supplier links to the one of the next line of the same order where 50 pieces are
    delivered; there is a hub and there are nodes without outgoing edges.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    following = lines.selectExpr("l_orderkey as o", "l_linenumber - 1 as n", "l_suppkey as next_supplier")
    pairs = (lines.where(f"l_quantity = 50 and l_suppkey % 10 <> {DANGLING_DIGIT}")
             .join(following, (F.col("l_orderkey") == F.col("o")) & (F.col("l_linenumber") == F.col("n")))
             .selectExpr("concat('s', lpad(string(l_suppkey), 7, '0')) as origin_airport_id",
                         f"concat('s', lpad(string(if(l_partkey % {HUB_EVERY} = 0, 1, next_supplier)), 7, '0'))"
                         " as destination_airport_id", "1 + l_partkey % 5 as w"))
    return (pairs.where("origin_airport_id <> destination_airport_id")
            .groupBy("origin_airport_id", "destination_airport_id").agg(F.sum("w").alias("flight_count")))


def state_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Events as positional vectors of text, one per row."""
    seconds = "string(unix_timestamp(timestamp(ts)))"
    number = "string(value)"
    return table(spark, folder, "events").selectExpr("event_id", f"""array(
        lower(hex(user_id)), event_type, concat('C', string(user_id % 5)),
        {seconds}, {seconds}, {number}, {number}, {number}, 'false', {number}, {number},
        {number}, null, {number}, string(user_id % 8), 'true', string(user_id % 3)) as state""")
