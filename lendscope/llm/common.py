"""Shared helpers of the training-data operators.

Nothing outside `lendscope.llm` imports this subpackage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names in `spark.checkpoint.dir`. Only where
    it is unset (single-machine tests) a scratch folder is made."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return jsc.getCheckpointDir().get().rstrip("/")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` as Parquet under the shared folder and read it back: cuts the
    lineage, and a lost executor costs only a re-read of these files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame, rows: int, size: int = 1 << 17) -> int:
    """Tasks to write a table of `rows` narrow rows: about `size` rows each, the cores at
    least. With as many tasks as shuffle partitions, a small table becomes hundreds of files
    of a few rows, and Hadoop's local file system starts processes for each of them."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // size))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(c, UPPER, LOWER)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, so that further columns of the input cannot clash."""
    return df.select(*[df[n] for n in names])


def map_batches(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """`mapInArrow` with this package shipped to the executors' Python workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(task, schema)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules along with the job (once per application), as
    `--py-files` does, so that executors need no installed copy."""
    sc = spark.sparkContext
    if any(name.startswith("lendscope-llm") for name in sc._python_includes):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lendscope-"), "lendscope-llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.join("lendscope", os.path.relpath(full, top)))
    sc.addPyFile(path)
