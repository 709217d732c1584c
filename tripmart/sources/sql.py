"""Parametrised SQL over named DataFrames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(
    spark: SparkSession, sql: str, params: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run SQL with ``:name`` parameters; ``{frame}`` names a DataFrame passed in.

    Errors are raised, never turned into an empty result.
    """
    return spark.sql(sql, args=params or {}, **frames)
