"""Landing of delivered records: tags, stamps, de-duplication, coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.sources import schemas, tables

TAG_COLUMNS = ("_source_airport", "_source_direction")
DIRECTIONS = ("departure", "arrival")


def tag_source(df: DataFrame, airport: str, direction: str) -> DataFrame:
    """Write on every row which pull delivered it."""
    return (df.withColumn("_source_airport", F.lit(airport))
            .withColumn("_source_direction", F.lit(direction)))


def stamp_flights(df: DataFrame, source_date: str | dt.date,
                  loaded_at: Column | None = None) -> DataFrame:
    """Bring delivered rows into the raw layout.

    Missing tag columns become null, unknown columns are dropped, columns that
    were not delivered at all stay out (the sink adds them as null).
    """
    for tag in TAG_COLUMNS:
        if tag not in df.columns:
            df = df.withColumn(tag, F.lit(None).cast("string"))
    df = (df.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)
          .withColumn("source_date", F.lit(str(source_date)).cast("date")))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in schemas.RAW_FLIGHTS.fields if f.name in df.columns])


def complete_columns(df: DataFrame) -> DataFrame:
    """All raw columns in table order, null where nothing was delivered."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.RAW_FLIGHTS.fields])


def load_flights(df: DataFrame, source_date: str | dt.date, table: str,
                 replace_day: bool = False) -> int:
    """Append one delivery to the raw table and return its row count.

    ``replace_day`` makes a rerun of the same day harmless instead of additive.
    """
    if df.isEmpty():
        return 0
    rows = complete_columns(stamp_flights(df, source_date))
    if replace_day:
        return tables.replace_partitions(rows, table, schemas.RAW_FLIGHTS, "source_date")
    return tables.append_table(rows, table, schemas.RAW_FLIGHTS, "source_date")


def unpack_states(df: DataFrame, vector: str = "state") -> DataFrame:
    """Positional state vectors (one array per row) to named, typed columns."""
    return df.select(*[
        F.get(F.col(vector), position).cast(field.dataType).alias(field.name)
        for position, field in enumerate(schemas.STATE_VECTOR.fields)
        if field.name != "sensors"])


def load_states(df: DataFrame, table: str, batch: str = "states") -> int:
    """Explode deliveries (an array of vectors per row) and append them."""
    vectors = df.select(F.explode(batch).alias("state"))
    if vectors.isEmpty():
        return 0
    rows = unpack_states(vectors).withColumn("loaded_at", F.current_timestamp())
    return tables.append_table(rows, table, schemas.RAW_AIRCRAFT_STATES)


def dedup_flights(departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Union of overlapping pulls with one copy per (icao24, firstSeen).

    Departures win over arrivals; within a pull the remaining columns decide, so
    the result does not depend on the order of rows. Missing key parts count as
    '' and 0. ``row_number() = 1`` is applied before the shuffle as well, which
    leaves at most one row per key and map task of a heavily repeated key.
    """
    both = departures.withColumn("_rank", F.lit(0)).unionByName(
        arrivals.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in ("icao24", "firstSeen", "_rank")]
    first = Window.partitionBy(
        F.coalesce("icao24", F.lit("")), F.coalesce("firstSeen", F.lit(0))
    ).orderBy(F.col("_rank"), F.col("icao24").asc_nulls_first(),
              F.col("firstSeen").asc_nulls_first(),
              *[F.col(c).asc_nulls_first() for c in rest])
    return (both.withColumn("_copy", F.row_number().over(first))
            .filter(F.col("_copy") == 1)
            .drop("_copy", "_rank"))


def day_bounds(day: str | dt.date) -> tuple[int, int]:
    """Unix seconds of [midnight, next midnight) in UTC."""
    day = dt.date.fromisoformat(str(day))
    start = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp())
    return start, start + 86400


def daily_slice(df: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Rows of the day before the run.

    The partition column limits what is read, the exact bounds hold for the rows.
    """
    day = day_before(run_date)
    start, end = day_bounds(day)
    return df.filter((F.col("source_date") == F.lit(day)) & (F.col("firstSeen") >= start)
                     & (F.col("firstSeen") < end))


def day_before(run_date: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(str(run_date)) - dt.timedelta(days=1)


def pull_grid(airports: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every (day, airport, direction) a complete history holds."""
    return (airports.select(F.col("airport"))
            .withColumn("day", F.explode(F.sequence(start, end, F.expr("interval 1 day"))))
            .withColumn("direction", F.explode(F.array(*[F.lit(d) for d in DIRECTIONS]))))


def completed_pulls(raw: DataFrame) -> DataFrame:
    """The (day, airport, direction) slices a raw table already holds."""
    return (raw.select(F.col("source_date").alias("day"),
                       F.col("_source_airport").alias("airport"),
                       F.col("_source_direction").alias("direction"))
            .distinct())


def missing_slices(grid: DataFrame, done: DataFrame) -> DataFrame:
    """Slices of the grid still to be pulled."""
    return grid.join(done, ["day", "airport", "direction"], "left_anti").select(
        "day", "airport", "direction")


def coverage(grid: DataFrame, done: DataFrame) -> DataFrame:
    """One row: slices in total, done, remaining, percent done."""
    flagged = grid.join(done.withColumn("_done", F.lit(1)),
                        ["day", "airport", "direction"], "left")
    counts = flagged.agg(F.count(F.lit(1)).alias("total_slices"),
                         F.count("_done").alias("done_slices"))
    return counts.select(
        "total_slices", "done_slices",
        (F.col("total_slices") - F.col("done_slices")).alias("remaining_slices"),
        F.try_divide(F.col("done_slices") * F.lit(100.0),
                     F.col("total_slices")).alias("pct_done"))
