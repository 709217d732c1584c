"""Where keys lie: a narrow table bucketed by key, kept beside a table that is kept by date.

Each load adds its keys and their dates as a partition of the narrow table. All of its
partitions are cut into the same buckets, so looking up the keys of a load shuffles those
keys only: the stored ones are read bucket by bucket, where they are joined. The table
it belongs to is not read.

A key may be listed with dates where it no longer is, as when a run died before it took
effect: those dates are then rewritten as they are. It is always listed with the date
where it is, as keys are added before rows.
"""

from __future__ import annotations

import re
from hashlib import md5
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.sources.zones import _folder, exists, remove_folders

#: Buckets of a new table; a table keeps the number it began with. Some 10 million keys to a bucket are still quick.
BUCKETS = 32
#: Loads after which partitions are merged into one.
MOST_LOADS = 24


def _root(spark: SparkSession, path: str, buckets: int) -> tuple[str, int]:
    """Folder and buckets of the table, which its name tells."""
    where, files = _folder(spark, path)
    if files.exists(where):
        for status in files.listStatus(where):
            if found := re.fullmatch(r"buckets-(\d+)", status.getPath().getName()):
                return f"{path}/buckets-{found[1]}", int(found[1])
    return f"{path}/buckets-{buckets}", buckets


def declared(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> str:
    """Name of the bucketed table at ``path`` (columns of ``schema``, by load), known to this session from its files."""
    root, buckets = _root(spark, path, buckets)
    name = f"tripmart_keys_{md5(root.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `load` STRING) USING parquet PARTITIONED BY (`load`) "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{root}'"
        )
    if exists(spark, root):
        spark.catalog.recoverPartitions(name)  # loads that other sessions have added
    return name


def buckets_of(spark: SparkSession, path: str, buckets: int = BUCKETS) -> int:
    return _root(spark, path, buckets)[1]


def loads(spark: SparkSession, path: str, buckets: int = BUCKETS) -> list[str]:
    """Loads that the table has."""
    root, _ = _root(spark, path, buckets)
    where, files = _folder(spark, root)
    found = [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []
    return sorted(name.removeprefix("load=") for name in found if name.startswith("load="))


def add_load(
    spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, key: str, load: str | None = None, buckets: int = BUCKETS
) -> str:
    """Add rows as a load of their own; returns its name."""
    load = load or f"l{uuid4().hex}"
    name = declared(spark, path, schema, key, buckets)
    n = buckets_of(spark, path, buckets)
    dealt = rows.select(*schema.fieldNames()).repartition(n, key)  # as the buckets are, so that a bucket is one file
    spark.sql(f"INSERT INTO {name} PARTITION (`load` = '{load}') SELECT * FROM {{dealt}}", dealt=dealt)
    return load


def drop_loads(spark: SparkSession, path: str, schema: T.StructType, key: str, names: list[str], buckets: int = BUCKETS) -> None:
    table = declared(spark, path, schema, key, buckets)
    root, _ = _root(spark, path, buckets)
    for load in names:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`load` = '{load}')")
    remove_folders(spark, [f"{root}/load={load}" for load in names])


def stored(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """All rows, with their load."""
    return spark.table(declared(spark, path, schema, key, buckets))


def dates_of(spark: SparkSession, keys: DataFrame, path: str, schema: T.StructType, key: str, partition: str, buckets: int = BUCKETS) -> DataFrame:
    """The dates where some of the ``keys`` may lie."""
    known = stored(spark, path, schema, key, buckets).select(key, partition)
    return known.join(keys.select(key), key, "left_semi").select(partition).distinct()


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, partition: str, days: list, buckets: int = BUCKETS) -> None:
    """Merge all loads into one, without dates that the table no longer has.

    Buckets are read and written one by one, without a shuffle of what is stored. If a
    run dies between, rows are there twice, which changes nothing.
    """
    before = loads(spark, path, buckets)
    known = stored(spark, path, schema, key, buckets).filter(F.col("load").isin(before) & F.col(partition).isin(days))
    add_load(spark, known.select(*schema.fieldNames()).distinct(), path, schema, key, buckets=buckets)
    drop_loads(spark, path, schema, key, before, buckets)
