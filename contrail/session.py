"""Session set-up and the shared folder for intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the models rely on that a running session can still take over.
RUNTIME_SETTINGS = {
    # dates derive from timestamps in the session zone
    "spark.sql.session.timeZone": "UTC",
    # the JVM leaves methods above 8000 bytes of bytecode to its interpreter;
    # wide expressions are faster in smaller generated pieces
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # rows that a Python worker gets at a time; whole texts can be long
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # capturing the Python call site of every expression slows down plan building
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "contrail", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``conf`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **SESSION_SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Bring a session made elsewhere in line with what the models rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where the setting is missing, a folder in the session's warehouse is used,
    which executors have to reach in any case. The rule is the same for every
    master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"


def scratch_path(spark: SparkSession) -> str:
    """A new path below the shared folder, in the application's own subfolder."""
    application = spark.sparkContext.applicationId
    return f"{checkpoint_folder(spark)}/contrail-{application}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written rows.

    The rows survive the loss of executors and plans of iterative jobs stay
    short. Unlike a checkpointed RDD a written table has a known size, so the
    optimizer broadcasts it only if it is below the session's threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.contrail_path = path
    return written


def backed_by(df: DataFrame, written: DataFrame) -> DataFrame:
    """``df``, which reads ``written`` alone; to discard it deletes that table."""
    df.contrail_path = getattr(written, "contrail_path", None)
    return df


def discard(*written: DataFrame) -> None:
    """Delete the files behind results of ``cut_lineage`` that nothing reads any more."""
    for df in written:
        path = getattr(df, "contrail_path", None)
        if path:
            jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)
