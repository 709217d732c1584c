"""Connected components of links by alternating stars, each round a Spark job on the links that are left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie nodes to the least neighbour of a node they share: its larger neighbours, or its smaller ones and itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("centre"), F.least("m", "u").alias("m"))
        tied = both.join(least, F.col("u") == F.col("centre")).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        centres = least.select("u", F.col("m").alias("v"))
        rest = edges.join(least.withColumnRenamed("u", "centre"), F.col("u") == F.col("centre"))
        tied = rest.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(centres)
    return tied.filter(F.col("u") != F.col("v")).distinct()


def labels(links: DataFrame) -> DataFrame:
    """Nodes of ``links`` (a, b: long) but the least of each component, with it: node, label. Written.

    Sums on the map side shrink a node with many links before they meet, and joins on it can be split.
    """
    edges = written(
        links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == before or seen[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = seen
        edges = written(_stars(_stars(edges, True), False))
