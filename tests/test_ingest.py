import datetime as dt

from pyspark.sql import functions as F

from contrail.sources import ingest, schemas, tables

FLIGHT = "icao24 string, firstSeen bigint, estDepartureAirport string, lastSeen bigint, callsign string"


def flights(spark, rows):
    return spark.createDataFrame(rows, FLIGHT)


def test_departure_copy_wins_and_missing_keys_collapse(spark):
    dep = flights(spark, [("a", 1, "X", 9, "dep"), (None, None, "Y", 9, "none"),
                          ("b", 2, "X", 9, "dep")])
    arr = flights(spark, [("a", 1, "X", 9, "arr"), ("", 0, "Y", 9, "empty"),
                          ("c", 3, "X", 9, "arr")])
    got = ingest.dedup_flights(dep, arr)
    assert sorted((r["icao24"] or "", r["callsign"]) for r in got.collect()) == [
        ("", "none"), ("a", "dep"), ("b", "dep"), ("c", "arr")]
    assert got.columns == dep.columns


def test_dedup_limits_copies_before_the_shuffle(spark):
    dep = flights(spark, [("a", 1, "X", 9, str(i)) for i in range(500)])
    got = ingest.dedup_flights(dep, dep)
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    partial = plan.split("Partial")[0]
    assert "WindowGroupLimit" in plan and "Exchange" in partial


def test_stamp_adds_tags_drops_strangers_and_orders_columns(spark):
    df = flights(spark, [("a", 1, "X", 9, "c")]).withColumn("other", F.lit(1))
    got = ingest.stamp_flights(df, "2026-04-24")
    order = [f.name for f in schemas.RAW_FLIGHTS.fields if f.name in got.columns]
    assert got.columns == order and "other" not in got.columns
    row = got.first()
    assert row["_source_airport"] is None and row["source_date"] == dt.date(2026, 4, 24)
    assert row["loaded_at"] is not None


def test_load_appends_counts_and_reruns(spark):
    tables.create_schema(spark, "raw")
    name = tables.table_name("raw", "flights_load")
    day = flights(spark, [("a", 1, "X", 9, "c"), ("b", 2, "X", 9, "c")])
    assert ingest.load_flights(day.limit(0), "2026-04-24", name) == 0
    assert not tables.table_exists(spark, name)
    assert ingest.load_flights(day, "2026-04-24", name) == 2
    assert ingest.load_flights(day, "2026-04-24", name) == 2
    assert spark.table(name).count() == 4
    assert ingest.load_flights(day, "2026-04-25", name) == 2
    # replacing a day leaves the others alone
    assert ingest.load_flights(day, "2026-04-24", name, replace_day=True) == 2
    counts = {str(r["source_date"]): r["count"]
              for r in spark.table(name).groupBy("source_date").count().collect()}
    assert counts == {"2026-04-24": 2, "2026-04-25": 2}
    assert set(spark.table(name).columns) == {f.name for f in schemas.RAW_FLIGHTS.fields}
    pruned = spark.table(name).filter("source_date = '2026-04-25'")
    assert "PartitionFilters: [isnotnull(source_date" in (
        pruned._jdf.queryExecution().executedPlan().toString())


def test_additive_migration(spark):
    tables.create_schema(spark, "raw")
    name = "raw.old_flights"
    flights(spark, [("a", 1, "X", 9, "c")]).write.saveAsTable(name)
    added = tables.evolve_schema(spark, name, schemas.RAW_FLIGHTS)
    assert "_source_airport" in added and "icao24" not in added
    assert spark.table(name).first()["_source_direction"] is None
    assert tables.evolve_schema(spark, name, schemas.RAW_FLIGHTS) == []


def test_state_vectors(spark):
    vector = ["abc", "CALL", "DE", "5", "6", "1.5", "2.5", None, "true", "3", "4", "5", "x",
              "7.5", "1234", "false", "2"]
    df = spark.createDataFrame([([vector, vector],)], "states array<array<string>>")
    tables.create_schema(spark, "raw")
    assert ingest.load_states(df, "raw.states") == 2
    row = spark.table("raw.states").first()
    assert "sensors" not in row
    assert (row["time_position"], row["longitude"], row["baro_altitude"], row["on_ground"],
            row["geo_altitude"], row["spi"], row["position_source"]) == (
        5, 1.5, None, True, 7.5, False, 2)
    assert ingest.load_states(df.limit(0), "raw.states") == 0


def test_daily_slice_is_half_open_day_before(spark):
    start = 1777075200  # 2026-04-25 00:00 UTC
    df = flights(spark, [("a", start - 1, "X", 9, "before"), ("a", start, "X", 9, "first"),
                         ("a", start + 86399, "X", 9, "last"), ("a", start + 86400, "X", 9, "next")])
    df = df.withColumn("source_date", F.timestamp_seconds("firstSeen").cast("date"))
    got = ingest.daily_slice(df, "2026-04-26")
    assert [r["callsign"] for r in got.orderBy("firstSeen").collect()] == ["first", "last"]


def test_daily_slice_reads_one_partition(spark, tmp_path):
    df = flights(spark, [("a", 1777075200 + i * 86400, "X", 9, "c") for i in range(3)])
    df.withColumn("source_date", F.timestamp_seconds("firstSeen").cast("date")).write.partitionBy(
        "source_date").parquet(f"{tmp_path}/raw")
    got = ingest.daily_slice(spark.read.parquet(f"{tmp_path}/raw"), "2026-04-26")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_date" in plan and "= 2026-04-25" in plan
    assert got.count() == 1


def test_missing_slices_and_coverage(spark):
    airports = spark.createDataFrame([("A",), ("B",)], "airport string")
    grid = ingest.pull_grid(airports, F.lit("2026-01-01").cast("date"),
                            F.lit("2026-01-03").cast("date"))
    assert grid.count() == 12
    raw = ingest.tag_source(spark.createDataFrame(
        [(dt.date(2026, 1, 1),), (dt.date(2026, 1, 1),)], "source_date date"), "A", "arrival")
    done = ingest.completed_pulls(raw)
    missing = ingest.missing_slices(grid, done)
    assert missing.count() == 11
    assert missing.filter("airport = 'A' and day = '2026-01-01'").first()["direction"] == \
        "departure"
    row = ingest.coverage(grid, done).first()
    assert (row["total_slices"], row["done_slices"], row["remaining_slices"]) == (12, 1, 11)
    assert abs(row["pct_done"] - 100 / 12) < 1e-12


def test_catalog_lookups(spark):
    tables.create_schema(spark, "shop")
    assert not tables.any_tables(spark, "shop") and not tables.any_tables(spark, "nowhere")
    spark.range(0).write.saveAsTable("shop.empty")
    spark.range(3).write.saveAsTable("shop.full")
    assert tables.list_tables(spark, "shop") == ["empty", "full"]
    assert tables.first_available(spark, "shop.none", "shop.empty", "shop.full").count() == 3
    assert tables.first_available(spark, "shop.none", "shop.empty") is None
    tables.publish_view(spark.range(2), "two_rows")
    assert tables.table_exists(spark, "two_rows")


def test_overwrite_table_is_a_full_refresh(spark):
    tables.create_schema(spark, "shop")
    assert tables.overwrite_table(spark.range(5), "shop.refreshed").count() == 5
    assert tables.overwrite_table(spark.range(2), "shop.refreshed").count() == 2


def test_seed_scan_uses_the_declared_schema(spark, tmp_path):
    path = tmp_path / "ranges.csv"
    path.write_text("range_start,range_end,country_code,country_name,military_branch,notes\n"
                    "3b0000,3bffff,DE,Germany,Branch,\n")
    seed = tables.read_seed(spark, str(path), schemas.MILITARY_RANGES)
    assert seed.schema == schemas.MILITARY_RANGES
    assert seed.first()["range_start"] == "3b0000"
