"""Unpartitioned tables, changed by writing their next version."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmart.sinks.zone_writer import _written, observed, verify_contents
from tripmart.sources.zones import read_table, remove_folders, scratch_path, version_path, versions


def stage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The frame, written to a folder of its own."""
    path = scratch_path(spark, f"staging-{uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Write the next version of an unpartitioned table, also from a frame that reads it; returns its rows.

    The version before stays for readers that have it open, older ones and those that
    were never finished go. Two runs that write the same version: the later one fails.
    """
    known = versions(spark, path)
    number = max(known, default=0) + 1
    rows, seen = observed(df)
    rows.write.mode("error").parquet(version_path(path, number))
    contents = _written(seen)
    verify_contents(spark, version_path(path, number), df.schema, contents)
    last = max((k for k, whole in known.items() if whole), default=0)
    remove_folders(spark, [version_path(path, k) for k in known if k != last])
    return contents.n_rows


def append_rows(spark: SparkSession, df: DataFrame, path: str, schema: T.StructType) -> int:
    """The next version of an unpartitioned table has the frame's rows too; returns how many they are."""
    before = read_table(spark, path, schema, first_load=True)
    added = df.select(*schema.fieldNames())
    return replace_table(spark, before.unionByName(added), path) - before.count()
