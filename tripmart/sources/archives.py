"""Monthly zip archives of trip CSV files."""

from __future__ import annotations

import csv
import zipfile
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.sources.zones import scratch_path, with_load_date


def read_archives(
    spark: SparkSession,
    paths: str | list[str],
    month: str,
    member_suffix: str = "tripdata.csv",
    folder: str | None = None,
) -> DataFrame:
    """Trips of the ``yyyyMM`` member of each archive, with the load date.

    Zip does not split, so a task for each archive copies its member to a plain file
    on shared storage, in pieces, whatever its size. Spark's CSV reader then splits
    and parses the files. Fails if an archive has no such member, or a member lacks
    a column. Text is typed by Spark; an empty field is null.
    """
    files = unpack(spark, paths, month, member_suffix, folder or scratch_path(spark, f"landing-{uuid4().hex}"))
    names = S.TRIP_COLUMNS.fieldNames()
    layouts: dict[tuple, list[str]] = {}
    for file in files.collect():  # a row for each archive
        missing = [n for n in names if n not in file["columns"]]
        if missing:
            raise ValueError(f"{file['archive']} has no column {', '.join(missing)}")
        layouts.setdefault((tuple(file["columns"]), file["lines_in_fields"]), []).append(file["path"])
    trips = None
    for (columns, lines_in_fields), members in layouts.items():
        reader = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in columns]))
        # a file with line breaks within fields cannot be split
        text = reader.options(header=True, escape='"', multiLine=lines_in_fields).csv(members)
        rows = text.select(*(F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in S.TRIP_COLUMNS.fields))
        trips = rows if trips is None else trips.unionByName(rows)
    return with_load_date(trips)


def unpack(spark: SparkSession, paths: str | list[str], month: str, member_suffix: str, folder: str) -> DataFrame:
    """Copy the members to ``folder``: archive, path, columns, lines_in_fields."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                source, source_path = _file_system(archive)
                with source.open_input_file(source_path) as stream, zipfile.ZipFile(stream) as members:
                    wanted = _member(members, month, member_suffix)
                    if wanted is None:
                        raise ValueError(f"no {month} {member_suffix} member in {archive}")
                    target, top = _file_system(folder)
                    target.create_dir(top, recursive=True)
                    name = f"{uuid4().hex}.csv"
                    columns, quotes, broken = None, 0, False
                    with members.open(wanted) as lines, target.open_output_stream(f"{top}/{name}") as out:
                        for line in lines:
                            if columns is None:
                                line = line.removeprefix(b"\xef\xbb\xbf")
                                columns = next(csv.reader([line.decode()]))
                            quotes += line.count(b'"')
                            broken = broken or quotes % 2 == 1
                            out.write(line)
                row = {"archive": archive, "path": f"{folder}/{name}", "columns": columns or [], "lines_in_fields": broken}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("archive", pa.string()), ("path", pa.string()), ("columns", pa.list_(pa.string())), ("lines_in_fields", pa.bool_())]
    )
    archives = spark.read.format("binaryFile").load(paths).select("path")
    return archives.mapInArrow(copy, "archive string, path string, columns array<string>, lines_in_fields boolean")


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _member(archive: zipfile.ZipFile, month: str, suffix: str) -> str | None:
    for name in archive.namelist():
        if name.endswith(suffix) and month in name and not name.startswith("__MACOSX/"):
            return name
    return None
