"""Readers and sinks.

Scans are lazy: Catalyst prunes columns and pushes filters into the parquet
reader, so a builder that touches three columns reads three columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read one input table (`<base_dir>/<name>.parquet`)  (S-1, parquet form)."""
    return spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan with header (S-1). Pass an explicit schema in production;
    inference costs a full extra pass over the file."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def capped_by_key(df: DataFrame, key: str, fraction: float, seed: int = 47) -> DataFrame:
    """Debug-mode subset (S-2) that keeps joins consistent: a row is kept when a
    hash of its key falls under `fraction`, so every table capped with the same
    key keeps the same entities (unlike per-table row caps)."""
    from ..functions import hash01
    return df.filter(hash01(F.col(key), seed) < fraction)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_cols: list[str] | None = None) -> None:
    """Table / prediction sink (S-4, S-5). CSV gets a header and no index column."""
    w = df.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def append_metrics(rows: DataFrame, path: str) -> None:
    """Append-only metric log (S-6): the rows are appended as one table write."""
    rows.write.mode("append").parquet(path)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns) of a frame (S-7); one count job."""
    return df.count(), len(df.columns)
