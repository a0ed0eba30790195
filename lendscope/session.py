"""Spark session helpers.

The library never hard-codes cluster sizing: on a real cluster the session
already carries `spark.sql.shuffle.partitions`, `spark.checkpoint.dir` and
friends, and we only read them. Local runs (tests, bench) get sane defaults.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package relies on. AQE turns sort-merge joins
# whose runtime-measured side is small into broadcast joins (the size check we
# want instead of blind broadcast hints), coalesces small shuffle partitions and
# splits skewed join partitions.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A builder that computes ~100 statistics in one aggregate carries a buffer of 2-3 fields
    # per statistic; above this many fields Spark runs the stage interpreted. Aggregate functions
    # are compiled into split methods, so a high limit makes no oversized ones.
    "spark.sql.codegen.maxFields": "250",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g",
                  app: str = "lendscope", checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster job builds its own.

    `checkpoint_dir` is used where the installation names no `spark.checkpoint.dir`."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SCALE_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def shared_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The shared folder for written intermediate tables: the argument, else the session's
    `spark.checkpoint.dir`, else the folder set by `SparkContext.setCheckpointDir`."""
    named = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        raise ValueError("this needs a folder that the driver and all executors share: "
                         "set spark.checkpoint.dir or pass the folder")
    return named.rstrip("/")


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where one derived table feeds many jobs (k-fold training); a lost
    executor then re-reads checkpoint files instead of recomputing the DAG.
    """
    spark = df.sparkSession
    path = shared_dir(spark, folder)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return df.checkpoint(eager=True)


def checkpoint_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    return f"{shared_dir(spark, folder)}/{name}"


def store(df: DataFrame, name: str, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write `df` as Parquet under the shared folder: (the table read back, its path). Unlike a
    checkpoint it keeps its columns apart, so later passes read only what they need."""
    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}", folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a table that `store` has written and nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
