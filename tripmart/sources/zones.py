"""Parquet zones and mart tables, and the scratch folder for written intermediates.

A zone is partitioned by batch, the month of the archive, and within a batch by date.
An unpartitioned mart table is kept as versions: folders of which the highest that was
written to its end holds. A reader never sees a version that is being written.
A table kept by date has each date in a folder of the run that wrote it, and a small
table of versions, ``days``, says which folder holds a date. So a run that changes many
dates takes effect at once, when the next version of ``days`` is whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import periods, trip
from tripmart.schemas import DAY_FOLDERS


def with_compiled_steps(spark: SparkSession) -> SparkSession:
    """Let Spark generate the steps of a plan one by one where all of them would make a method of over 8000 bytes.

    The JVM never compiles such a method: every row is interpreted, which took three times as long for the raw trips.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def with_load_date(trips: DataFrame) -> DataFrame:
    return trips.withColumn("dt", trip.load_date("started_at"))


def read_zone(
    spark: SparkSession, path: str, schema: T.StructType, batch: str | None = None, with_batch: bool = False
) -> DataFrame:
    """Zone partitioned by batch and ``dt``; naming a batch prunes the others.

    A batch has all rows of its archive, those without a date too.
    """
    zone = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.StringType())])).parquet(path)
    zone = zone.filter(F.col("batch") == batch) if batch else zone
    return zone if with_batch else zone.drop("batch")


def batches(spark: SparkSession, path: str) -> list[str]:
    """The batches of a zone, by the names of its folders; no file is read."""
    root, files = _folder(spark, path)
    found = [status.getPath().getName() for status in files.listStatus(root)] if files.exists(root) else []
    return sorted(name.removeprefix("batch=") for name in found if name.startswith("batch="))


def month_slice(df: DataFrame, month: str, date_col: str = "dt") -> DataFrame:
    return df.filter(periods.in_month(F.col(date_col), month))


def _folder(spark: SparkSession, path: str):
    """A path and the file system that has it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Versions of a table, and whether each was written to its end."""
    root, files = _folder(spark, path)
    if not files.exists(root):
        return {}
    found = {}
    for status in files.listStatus(root):
        if name := re.fullmatch(r"v=(\d+)", status.getPath().getName()):
            done, _ = _folder(spark, f"{status.getPath()}/_SUCCESS")
            found[int(name[1])] = files.exists(done)
    return found


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        where, files = _folder(spark, path)
        files.delete(where, True)


def version_path(path: str, number: int) -> str:
    return f"{path}/v={number}"


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _folder(spark, path)
    return files.exists(where)


def newest(spark: SparkSession, path: str) -> str | None:
    """The folder of the highest whole version of a table, if it has any."""
    done = [number for number, whole in versions(spark, path).items() if whole]
    return version_path(path, max(done)) if done else None


def day_parts(spark: SparkSession, path: str) -> dict[date, Row]:
    """The dates of a table kept by date, and where each lies: one row a date, few enough for the driver."""
    folder = newest(spark, f"{path}/days")
    return {row.day: row for row in spark.read.schema(DAY_FOLDERS).parquet(folder).collect()} if folder else {}


#: Dates that are named one by one; of more, the runs' folders are listed and their other dates pruned.
FEW_DAYS = 31


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, parts: Iterable[Row], partition: str = "dt"
) -> DataFrame:
    """The dates of ``parts``; no file of other dates is read."""
    runs: dict[str, list[date]] = {}
    for part in parts:
        runs.setdefault(part.run, []).append(part.day)
    if not runs:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path}/data")
    if sum(map(len, runs.values())) <= FEW_DAYS:
        folders = [f"{path}/data/run={run}/{partition}={day}" for run, days in runs.items() for day in days]
        return reader.parquet(*folders).select(*schema.fieldNames())
    rows = reader.parquet(*(f"{path}/data/run={run}" for run in runs))
    wanted = F.lit(False)
    for run, days in runs.items():
        wanted = wanted | ((F.col("run") == run) & F.col(partition).isin(days))
    return rows.filter(wanted).select(*schema.fieldNames())


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, first_load: bool = False
) -> DataFrame:
    """Mart table. One that is not there is an error, unless this may be its first load."""
    if folder := newest(spark, path):
        return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
    if newest(spark, f"{path}/days"):
        return read_days(spark, path, schema, day_parts(spark, path).values())
    # folders of a first load that died are no table yet
    begun = exists(spark, f"{path}/data")
    if first_load and (begun or not exists(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/days" if begun else path).select(*schema.fieldNames())


def scratch_path(spark: SparkSession, name: str) -> str:
    """Folder below the shared ``spark.checkpoint.dir``, which must be set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "://" not in base and base.startswith("/"):
        base = f"file://{base}" if spark.sparkContext.master.startswith("local") else base
    return f"{base.rstrip('/')}/tripmart/{name}"
