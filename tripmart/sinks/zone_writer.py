"""Zone writes and their verification.

Rows are counted and hashed while they are written, and again as they are read back.
The sum and the exclusive or of the rows' hashes do not depend on their order, so a
value that changed on the way, two that changed places, and a row that is there twice
instead of another all show.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class WriteMismatch(RuntimeError):
    """What was read back is not what was written."""


class Contents(NamedTuple):
    """How many rows there are, and the sum and exclusive or of their hashes."""

    n_rows: int
    row_sum: int
    row_xor: int


def contents_of(schema: T.StructType) -> list[Column]:
    """Aggregates of rows with the columns of ``schema``, by the names of ``Contents``.

    The hash leaves nulls out, so which columns are null is hashed too. Values of a
    type that has no hash, as maps, are hashed as text.
    """
    value = [
        F.to_json(F.col(f"`{x.name}`")) if isinstance(x.dataType, T.MapType) else F.col(f"`{x.name}`")
        for x in schema.fields
    ]
    row = F.xxhash64(*value, F.concat(*[F.when(F.col(f"`{x}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for x in schema.fieldNames()]))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("row_sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("row_xor"),
    ]


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and what its contents turn out to be while it is written."""
    seen = Observation()
    return df.observe(seen, *contents_of(df.schema)), seen


def _written(seen: Observation) -> Contents:
    found = seen.get
    return Contents(found["n_rows"], int(found["row_sum"]), found["row_xor"])


def write_observed(df: DataFrame, path: str, partition: str, mode: str) -> Contents:
    rows, seen = observed(df.hint("rebalance", F.col(partition)))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(path)
    )
    return _written(seen)


def write_batch(df: DataFrame, path: str, batch: str, partition: str = "dt") -> int:
    """Replace a batch of a zone, whatever dates it had; returns the rows written.

    Other batches stay, also where they share dates with this one. ``rebalance``
    gathers a date's rows into few files, splits a date that is too large for one
    task and merges small ones. The frame is computed once; its contents are summed
    up while writing, and read back; a difference raises.
    """
    where = f"{path}/batch={batch}"
    contents = write_observed(df, where, partition, "static")
    verify_contents(df.sparkSession, where, df.schema, contents)
    return contents.n_rows


def write_partitions(df: DataFrame, path: str, partition: str = "dt") -> int:
    """Replace the partitions of a table that the frame has; returns the rows written."""
    return write_observed(df, path, partition, "dynamic").n_rows


def verify_rows(spark: SparkSession, path: str, expected: int) -> None:
    """Count what lies at ``path``, from the files' footers, and raise if it is not as expected."""
    found = spark.read.parquet(path).count() if expected else 0
    if found != expected:
        raise WriteMismatch(f"{path} has {found} rows, {expected} were written")


def verify_contents(spark: SparkSession, path: str, schema: T.StructType, expected: Contents) -> None:
    """Read what lies at ``path`` and raise if it is not what was written."""
    if not expected.n_rows:
        return
    row = spark.read.schema(schema).parquet(path).agg(*contents_of(schema)).first()
    require_same(path, expected, Contents(row.n_rows, int(row.row_sum), row.row_xor))


def require_same(path: str, expected: Contents, found: Contents) -> None:
    if found.n_rows != expected.n_rows:
        raise WriteMismatch(f"{path} has {found.n_rows} rows, {expected.n_rows} were written")
    if found != expected:
        raise WriteMismatch(f"{path} has as many rows as were written, but not the same ones")


def partition_counts(df: DataFrame, partition: str = "dt") -> DataFrame:
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"))


def verify_zone(source: DataFrame, written: DataFrame, partition: str = "dt") -> DataFrame:
    """Expected and actual rows over the partitions the source holds.

    Other partitions of the zone do not count. ``ok`` needs every partition to
    agree, not just the totals.
    """
    expected = partition_counts(source, partition).alias("e")
    actual = partition_counts(written, partition).alias("a")
    same = F.col(f"e.{partition}").eqNullSafe(F.col(f"a.{partition}"))
    found = F.coalesce(F.col("a.rows"), F.lit(0))
    return (
        expected.join(actual, same, "left")
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.coalesce(F.sum("e.rows"), F.lit(0)).alias("expected_rows"),
            F.coalesce(F.sum(found), F.lit(0)).alias("actual_rows"),
            F.coalesce(F.bool_and(F.col("e.rows") == found), F.lit(True)).alias("ok"),
        )
    )


def first_partitions(written: DataFrame, partition: str = "dt", n: int = 10) -> DataFrame:
    """The first partition values in order."""
    return written.select(partition).distinct().orderBy(partition).limit(n)
