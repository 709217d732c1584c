"""Where the operators read their tables and keep results between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch. Spark's own 10,000 rows are meant for rows of numbers; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

#: Workers give large arrays back to the system when they are freed, so that one that waits holds little of an executor's memory.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
}

_ROOT = str(Path(__file__).resolve().parents[2])


def prepared(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (a cluster ships it with --py-files), and
    hand them texts in batches that are small beside an executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    environment = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    path = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if _ROOT not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, path) if x)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, as in tests, a local one is set."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="tripmart-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once: written as Parquet to the shared folder and read from there.

    Cuts the lineage, so that a lost executor costs the tasks of one step.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same(a: str, b: str):
    """Equal, where null equals null."""
    return F.col(a).eqNullSafe(F.col(b))
