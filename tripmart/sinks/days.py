"""Tables kept by date, where a run that changes many dates takes effect at once.

A run writes the dates it changes to a folder of its own, reads them back, and then
writes the next version of the small table ``days``, which says where each date lies.
Until that version is whole, readers see all dates as they were; from then on, as they
are now. Folders of dates that were replaced stay until no version that a reader may
have open names them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schemas import DAY_FOLDERS
from tripmart.sinks.versions import replace_table
from tripmart.sinks.zone_writer import Contents, WriteMismatch, contents_of, require_same, write_observed
from tripmart.sources.zones import day_parts, read_days, remove_folders, version_path, versions


def write_days(spark: SparkSession, df: DataFrame, path: str, partition: str) -> list[Row]:
    """Write the frame's dates to a folder of this run, verified; nobody reads them before ``commit``."""
    run = f"r{uuid4().hex}"
    folder = f"{path}/data/run={run}"
    expected = write_observed(df, folder, partition, "static")
    if not expected.n_rows:
        return []
    back = spark.read.schema(df.schema).parquet(folder)
    found = back.groupBy(F.col(partition).alias("day")).agg(*contents_of(df.schema)).collect()  # one row a date
    if any(row.day is None for row in found):
        raise ValueError(f"{path}: rows without {partition}")
    xor = 0
    for row in found:
        xor ^= row.row_xor
    require_same(folder, expected, Contents(sum(r.n_rows for r in found), int(sum(r.row_sum for r in found)), xor))
    return [Row(day=r.day, run=run, n_rows=r.n_rows, row_sum=r.row_sum, row_xor=r.row_xor) for r in found]


def commit(spark: SparkSession, path: str, added: Iterable[Row], dropped: Iterable[date] = ()) -> None:
    """From now on the table has the dates ``added``, and those ``dropped`` no more; all others stay.

    Folders that only the version before the last one named are removed.
    """
    before = day_parts(spark, path)
    after = {day: part for day, part in before.items() if day not in set(dropped)} | {part.day: part for part in added}
    if after == before:
        return
    manifest = f"{path}/days"
    done = sorted(number for number, whole in versions(spark, manifest).items() if whole)
    old = []
    for number in done[:-1]:  # one at most: older ones are gone
        old += spark.read.schema(DAY_FOLDERS).parquet(version_path(manifest, number)).collect()
    rows = [tuple(part[x] for x in DAY_FOLDERS.fieldNames()) for part in after.values()]
    replace_table(spark, spark.createDataFrame(rows, DAY_FOLDERS).coalesce(1), manifest)
    named = {(part.day, part.run) for version in (before, after) for part in version.values()}
    remove_folders(spark, [f"{path}/data/run={p.run}/dt={p.day}" for p in old if (p.day, p.run) not in named])


def drop_days(spark: SparkSession, path: str, days: Iterable[date]) -> int:
    """Drop whole dates, all at once; returns how many rows they had."""
    parts = day_parts(spark, path)
    doomed = [parts[day] for day in days if day in parts]
    if doomed:
        commit(spark, path, [], [part.day for part in doomed])
    return sum(part.n_rows for part in doomed)


def damaged_days(spark: SparkSession, path: str, schema: T.StructType, partition: str = "dt") -> list[date]:
    """Dates whose rows are no longer those that were written, from one pass over the table."""
    parts = day_parts(spark, path)
    rows = read_days(spark, path, schema, parts.values(), partition)
    found = {row.day: row for row in rows.groupBy(F.col(partition).alias("day")).agg(*contents_of(schema)).collect()}
    names = ("n_rows", "row_sum", "row_xor")
    return sorted(day for day, part in parts.items() if day not in found or any(found[day][x] != part[x] for x in names))


def require_sound(spark: SparkSession, path: str, schema: T.StructType, partition: str = "dt") -> None:
    """Raise if any date has changed since it was written."""
    if days := damaged_days(spark, path, schema, partition):
        raise WriteMismatch(f"{path} has other rows than were written on {', '.join(map(str, days))}")
