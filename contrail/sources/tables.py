"""Scans, catalog look-ups and sinks."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_name(schema: str | None, name: str) -> str:
    """The one place where a catalog name is put together."""
    return f"{schema}.{name}" if schema else name


# --- scans ---------------------------------------------------------------

def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV dimension with a header row and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- catalog -------------------------------------------------------------

def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    if schema and not spark.catalog.databaseExists(schema):
        return []
    return sorted(t.name for t in spark.catalog.listTables(schema))


def any_tables(spark: SparkSession, schema: str | None = None) -> bool:
    return bool(list_tables(spark, schema))


def first_available(spark: SparkSession, *names: str) -> DataFrame | None:
    """The first table of the preference list that exists and holds a row."""
    for name in names:
        if table_exists(spark, name):
            df = spark.table(name)
            if not df.isEmpty():
                return df
    return None


# --- sinks ---------------------------------------------------------------

def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Lazily composed layer under a name; nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df


@contextmanager
def _partition_overwrite(spark: SparkSession, mode: str):
    """The overwrite mode within a block; given as a writer's option it would stay with the table."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, mode)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def overwrite_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Full refresh of a table; returns the stored rows."""
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with _partition_overwrite(df.sparkSession, "static"):
        writer.saveAsTable(name)
    df.sparkSession.catalog.refreshTable(name)
    return df.sparkSession.table(name)


def evolve_schema(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` a table lacks; existing ones stay as they are."""
    present = {c.lower() for c in spark.table(name).columns}
    missing = [f for f in schema.fields if f.name.lower() not in present]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in missing]


def append_table(df: DataFrame, name: str, schema: T.StructType,
                 partition_by: str | None = None) -> int:
    """Append by column name and return the number of rows written.

    The rows are counted while they are written, so the input is read once.
    Rows are rebalanced on the partition column: few files per partition, and a
    partition holding most of the rows is still written by several tasks.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists:
        evolve_schema(spark, name, schema)
    written = Observation()
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = df.write.format("parquet").mode("append")
    if exists:
        order = spark.table(name).columns
        for column in order:
            if column not in df.columns:
                raise ValueError(f"column {column} of {name} is missing in the rows")
        df.select(*order).write.insertInto(name)
    else:
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.saveAsTable(name)
    return written.get["rows"]


def replace_partitions(df: DataFrame, name: str, schema: T.StructType,
                       partition_by: str) -> int:
    """Overwrite only the partitions present in ``df``, so a repeated load is harmless."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return append_table(df, name, schema, partition_by)
    evolve_schema(spark, name, schema)
    written = Observation()
    order = spark.table(name).columns
    out = df.hint("rebalance", F.col(partition_by)).observe(
        written, F.count(F.lit(1)).alias("rows")).select(*order)
    # insertInto takes the mode from the session only
    with _partition_overwrite(spark, "dynamic"):
        out.write.insertInto(name, overwrite=True)
    return written.get["rows"]
