"""Mart tables: merge, month delete, append, replace, statistics.

An unpartitioned table is changed by writing its next version, which counts from the
moment it is whole. One that is kept by date is changed by its dates, all at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import merge
from tripmart.operators.cleaning import first_per_key
from tripmart.schemas import MergeSpec
from tripmart.sinks import days as dated
from tripmart.sinks import keys
from tripmart.sinks.versions import append_rows, replace_table, stage
from tripmart.sources.zones import day_parts, newest, read_days, read_table

__all__ = [
    "append_rows",
    "clear_partitions",
    "delete_month",
    "delete_unreferenced_month",
    "key_schema",
    "merge_table",
    "refresh_day_statistics",
    "refresh_statistics",
    "replace_table",
]


def merge_table(
    spark: SparkSession, source: DataFrame, path: str, spec: MergeSpec, replacing: str | None = None
) -> set[date]:
    """Upsert into a mart table; repeating a merge changes nothing. Returns the dates that changed, if it is kept by date.

    The source is computed once. Values that do not convert to the table's types, and
    rows without a key, raise and change nothing. ``replacing`` is a ``yyyyMM`` month
    that a table kept by date loses at the same time, but for what the source has of it.
    """
    rows = stage(spark, first_per_key(merge.cast_to_spec(source, spec), spec.key))
    if not rows.filter(F.col(spec.key).isNull()).isEmpty():
        raise ValueError(f"{spec.table}: rows without {spec.key}")
    if spec.partition:
        return _merge_days(spark, rows, path, spec, replacing)
    replace_table(spark, merge.upsert(read_table(spark, path, spec.schema, first_load=True), rows, spec), path)
    return set()


def key_schema(spec: MergeSpec) -> T.StructType:
    """What is kept to tell where keys lie."""
    return T.StructType([spec.schema[spec.key], spec.schema[spec.partition]])


def _merge_days(
    spark: SparkSession, source: DataFrame, path: str, spec: MergeSpec, replacing: str | None
) -> set[date]:
    """Upsert that reads and writes only the dates it touches.

    These are the dates of the new rows and those where their keys lie now, since a row
    may move. The latter come from the keys kept beside the table (``sinks.keys``), so
    no other date is read. Keys are added first, then rows: if a run dies between, the
    next one looks at a date too many. All dates change at once.
    """
    part, where, kept = spec.partition, f"{path}/keys", key_schema(spec)
    there = day_parts(spark, path)
    if there and not keys.loads(spark, where):  # a table from before keys were kept
        keys.add_load(spark, read_table(spark, path, spec.schema), where, kept, spec.key)
    cleared = {day for day in there if replacing and f"{day:%Y%m}" == replacing}
    new_days = _days(source, part)
    held = _days(keys.dates_of(spark, source, where, kept, spec.key, part), part) if there else set()
    touched = (new_days | held) & (set(there) - cleared)
    keys.add_load(spark, source, where, kept, spec.key)
    merged = source
    if touched:
        target = read_days(spark, path, spec.schema, [there[day] for day in sorted(touched)], part)
        merged = merge.upsert(target, source, spec)
    added = dated.write_days(spark, merged, path, part)
    dated.commit(spark, path, added, cleared | touched)
    if len(keys.loads(spark, where)) > keys.MOST_LOADS:
        keys.compact(spark, where, kept, spec.key, part, sorted(day_parts(spark, path)))
    return new_days | touched | cleared


def _days(df: DataFrame, column: str) -> set[date]:
    days = df.select(column).distinct().filter(F.col(column).isNotNull())
    return {row[0] for row in days.collect()}


def clear_partitions(spark: SparkSession, path: str, days: Iterable[date]) -> int:
    """Drop whole dates of a table kept by date, without reading them; returns their rows."""
    return dated.drop_days(spark, path, days)


def delete_month(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_col: str,
    month: str,
    partitioned: bool = False,
) -> int:
    """Delete the rows of a ``yyyyMM`` month and return how many there were.

    A table kept by date loses whole dates, all at once and unread; any other is
    rewritten without the month.
    """
    if partitioned:
        return clear_partitions(spark, path, [day for day in day_parts(spark, path) if f"{day:%Y%m}" == month])
    table = read_table(spark, path, schema, first_load=True)
    deleted = merge.month_rows(table, date_col, month).count()
    if deleted:
        replace_table(spark, merge.without_month(table, date_col, month), path)
    return deleted


def delete_unreferenced_month(
    spark: SparkSession,
    path: str,
    spec: MergeSpec,
    month: str,
    facts: DataFrame,
    reference: str,
) -> int:
    """Delete the month's dimension rows that no fact refers to."""
    table = read_table(spark, path, spec.schema, first_load=True)
    doomed = merge.unreferenced(
        merge.month_rows(table, spec.key, month), spec.key, merge.month_rows(facts, reference, month), reference
    ).count()
    if doomed:
        replace_table(spark, merge.guarded_delete(table, spec.key, month, facts, reference), path)
    return doomed


def refresh_statistics(
    spark: SparkSession, tables: dict[str, str], columns: Sequence[str] | None = None
) -> None:
    """Register unpartitioned tables by name, at their present versions, and compute their statistics.

    A table that is registered at its present version is left alone: its statistics
    are those of the same rows. Column statistics cost a scan; naming columns limits it.
    """
    for name, path in tables.items():
        folder = newest(spark, path) or path
        if spark.catalog.tableExists(name) and _location(spark, name) == _plain(folder):
            continue
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
        spark.catalog.createTable(name, path=folder, source="parquet")
        which = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {which}")


def refresh_day_statistics(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition: str = "dt"
) -> list[date]:
    """Register a table kept by date, and compute statistics of the dates that changed since it last was.

    Each date is a partition of the registered table, in the folder that holds it now.
    Only dates whose folder is another one than before are scanned; the table's size is
    their sum. Returns the dates that were scanned.
    """
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}/data'")
    parts = {str(day): f"{path}/data/run={part.run}/{partition}={day}" for day, part in day_parts(spark, path).items()}
    known = {row.partition.partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    changed = []
    for day, folder in sorted(parts.items()):  # metadata only, as many statements as dates have changed
        spec = f"`{partition}` = DATE '{day}'"
        if day not in known:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION '{folder}'")
        elif _location(spark, name, f"PARTITION ({spec})") != _plain(folder):
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{folder}'")
        else:
            continue
        changed.append(day)
    for day in sorted(known - set(parts)):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (`{partition}` = DATE '{day}')")
    for day in changed:
        spark.sql(f"ANALYZE TABLE {name} PARTITION (`{partition}` = DATE '{day}') COMPUTE STATISTICS")
    if changed or known - set(parts):
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
        spark.catalog.refreshTable(name)
    return [date.fromisoformat(day) for day in changed]


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("///", "/")


def _location(spark: SparkSession, name: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {partition}").collect()
    return next((_plain(row.data_type) for row in rows if row.col_name == "Location"), "")
