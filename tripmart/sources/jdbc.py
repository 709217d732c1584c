"""Relational database tables as sources and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.schemas import MergeSpec

BATCH_ROWS = 20_000
CONNECTIONS = 8


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_on: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """A database table; ``(column, low, high, n)`` reads it in n parallel ranges."""
    reader = spark.read.options(**(properties or {}))
    if partition_on:
        column, low, high, n = partition_on
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=n
        )
    return reader.format("jdbc").options(url=url, dbtable=table).load()


def write_options(connections: int = CONNECTIONS, batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    """Batched, parallel inserts without a transaction around them."""
    return {
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        "isolationLevel": "NONE",
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict[str, str] | None = None,
    **sizing: int,
) -> None:
    df.write.mode(mode).options(**write_options(**sizing)).jdbc(url, table, properties=properties)


def stage_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    **sizing: int,
) -> str:
    """Replace the rows of ``<table>_temp`` and return its name."""
    staged = f"{table}_temp"
    writer = df.write.mode("overwrite").option("truncate", "true")
    writer.options(**write_options(**sizing)).jdbc(url, staged, properties=properties)
    return staged


def merge_statement(spec: MergeSpec, table: str, staged: str) -> str:
    """Upsert from the staging table, for databases that have ``ON CONFLICT``.

    Spark's JDBC writer cannot merge, so the caller runs this on a connection of
    its own. Columns the spec preserves keep the target's value on conflict.
    """
    casts = {"date": "DATE", "timestamp": "TIMESTAMP"}
    selected = [
        f"CAST({f.name} AS {casts[f.dataType.typeName()]})"
        if f.dataType.typeName() in casts
        else f.name
        for f in spec.schema.fields
    ]
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in spec.updated)
    return (
        f"INSERT INTO {table} ({', '.join(spec.columns)}) "
        f"SELECT {', '.join(selected)} FROM {staged} "
        f"ON CONFLICT ({spec.key}) DO UPDATE SET {updates}"
    )
