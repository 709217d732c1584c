"""Pivots of small reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_counts(
    report: DataFrame,
    index: Sequence[str],
    columns: str,
    value: str,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One column per value of ``columns``, missing cells 0.

    Listing the names saves the extra job that looks them up.
    """
    keyed = report.withColumn("_cell", F.col(value))
    cells = keyed.groupBy(*index).pivot(columns, list(names) if names else None)
    wide = cells.agg(F.first("_cell"))
    return wide.fillna(0, subset=[c for c in wide.columns if c not in index])
