"""Exact percentiles that never gather a group in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentiles(
    df: DataFrame,
    group: str,
    value: str,
    probabilities: dict[str, float],
    bucket_width: float = 1,
    digits: int = 3,
) -> DataFrame:
    """Interpolated percentiles of a decimal column, one column per name.

    Rows shrink to counts per (group, value) before anything is ordered. Bucket
    totals say which bucket holds each wanted rank, and only the values of those
    buckets are ranked, per (group, bucket). So one group may hold any share of
    the rows: no task sees more than one bucket's distinct values.
    """
    g, v = F.col(group), F.col(value)
    counts = (
        df.filter(v.isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.floor(v / F.lit(bucket_width)))
    )

    buckets = counts.groupBy(group, "_bucket").agg(F.sum("_n").alias("_rows"))
    whole = Window.partitionBy(group)
    so_far = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = buckets.select(
        g,
        "_bucket",
        (F.sum("_rows").over(so_far) - F.col("_rows")).alias("_before"),
        F.col("_rows"),
        F.sum("_rows").over(whole).alias("_total"),
    )

    # A percentile lies between two neighbouring ranks; each is looked up in the
    # bucket that holds it.
    wanted = F.expr(f"array({', '.join(_neighbours(n, p) for n, p in probabilities.items())})")
    ranks = spans.select("*", F.inline(wanted)).filter(
        (F.col("_rank") >= F.col("_before"))
        & (F.col("_rank") < F.col("_before") + F.col("_rows"))
        & (F.col("_weight") > 0)
    )
    lookups = ranks.groupBy(group, "_bucket", "_before").agg(
        F.collect_list(F.struct("_name", "_rank", "_weight")).alias("_lookups")
    )

    # Null-safe on both keys: a plain equality would add a null filter to this use
    # of the counts only, and Spark could not share their shuffle.
    same_bucket = counts.alias("c").join(
        lookups.alias("l"),
        F.col(f"c.{group}").eqNullSafe(F.col(f"l.{group}"))
        & F.col("c._bucket").eqNullSafe(F.col("l._bucket")),
    )
    inner = Window.partitionBy(f"c.{group}", "c._bucket").orderBy(f"c.{value}")
    running = F.sum("c._n").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    placed = same_bucket.select(
        F.col(f"c.{group}").alias(group),
        F.col(f"c.{value}").alias("_value"),
        F.col("c._n").alias("_n"),
        (F.col("l._before") + running).alias("_end"),
        F.col("l._lookups").alias("_lookups"),
    )
    hits = placed.select("*", F.inline("_lookups")).filter(
        (F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n"))
    )
    part = F.col("_value") * F.col("_weight")
    return hits.groupBy(group).agg(
        *(
            F.round(F.sum(F.when(F.col("_name") == name, part)), digits)
            .cast(f"decimal(18,{digits})")
            .alias(name)
            for name in probabilities
        )
    )


def _neighbours(name: str, p: float) -> str:
    """The two ranks around position ``p * (rows - 1)``, with their weights."""
    position = f"{Decimal(str(p)):f}BD * CAST(_total - 1 AS DECIMAL(19, 0))"
    low = f"CAST(floor({position}) AS BIGINT)"
    above = f"CAST({position} - {low} AS DECIMAL(7, 6))"
    return (
        f"named_struct('_name', '{name}', '_rank', {low}, "
        f"'_weight', CAST(1 - {above} AS DECIMAL(7, 6))), "
        f"named_struct('_name', '{name}', '_rank', {low} + 1, '_weight', {above})"
    )
