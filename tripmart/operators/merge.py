"""Upsert, insert-if-absent, month deletes and referential checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import periods
from tripmart.operators.cleaning import first_per_key
from tripmart.schemas import MergeSpec


def cast_to_spec(source: DataFrame, spec: MergeSpec) -> DataFrame:
    """The target's columns and types; a value that does not convert raises."""

    def cast(field) -> Column:
        value = F.col(field.name)
        if source.schema[field.name].dataType == field.dataType:
            return value.alias(field.name)
        converted = value.try_cast(field.dataType)
        message = F.concat(F.lit(f"{spec.table}.{field.name} cannot hold "), value.cast("string"))
        return F.when(value.isNotNull() & converted.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(converted).alias(field.name)

    return source.select(*(cast(field) for field in spec.schema.fields))


def upsert(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Target after inserting new keys and updating known ones.

    Known keys take the source's values, except in the preserved columns. Both
    sides must be unique by key, so the full outer join has no heavy key.
    """
    t = target.select(*spec.columns).withColumn("_in_target", F.lit(True)).alias("t")
    s = cast_to_spec(source, spec).withColumn("_in_source", F.lit(True)).alias("s")
    joined = t.join(s, F.col(f"t.{spec.key}") == F.col(f"s.{spec.key}"), "full_outer")

    def merged(name: str) -> Column:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
        if name == spec.key:
            return F.coalesce(old, new)
        if name in spec.preserved:
            return F.when(F.col("t._in_target"), old).otherwise(new)
        return F.when(F.col("s._in_source"), new).otherwise(old)

    return joined.select(*(merged(c).alias(c) for c in spec.columns))


def absent_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose keys the target does not hold."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus one source row for each new key; known keys stay as they are."""
    return target.unionByName(first_per_key(absent_rows(source, target, keys), keys))


def not_in_pairs(
    df: DataFrame, existing: DataFrame, on: tuple[str, str], keys: tuple[str, str]
) -> DataFrame:
    """``(a, b) NOT IN (SELECT ka, kb)`` where ``a`` and ``ka`` are never null.

    A row also goes if its ``b``, or the ``kb`` of its ``a``, is null, since SQL
    cannot tell then that the pairs differ. Written as an anti join that hashes
    on the first column; SQL's own form plans as a nested loop.
    """
    (a, b), (ka, kb) = on, keys
    known = existing.select(F.col(ka).alias("_ka"), F.col(kb).alias("_kb")).distinct()
    may_be_equal = (F.col(b) == F.col("_kb")) | F.col(b).isNull() | F.col("_kb").isNull()
    return df.join(known, (F.col(a) == F.col("_ka")) & may_be_equal, "left_anti")


def month_rows(table: DataFrame, date_col: str, month: str) -> DataFrame:
    return table.filter(periods.in_month(F.col(date_col), month))


def without_month(table: DataFrame, date_col: str, month: str) -> DataFrame:
    """Rows a month delete leaves: all other months, and rows without a date."""
    inside = periods.in_month(F.col(date_col), month)
    return table.filter(~F.coalesce(inside, F.lit(False)))


def unreferenced(
    dimension: DataFrame, key: str, facts: DataFrame, reference: str
) -> DataFrame:
    """Dimension rows that no fact refers to."""
    used = facts.select(F.col(reference).alias(key)).distinct()
    return dimension.join(used, key, "left_anti")


def guarded_delete(
    dimension: DataFrame, key: str, month: str, facts: DataFrame, reference: str
) -> DataFrame:
    """Dimension after deleting the month's rows that no fact refers to."""
    in_scope = month_rows(dimension, key, month)
    doomed = unreferenced(in_scope, key, month_rows(facts, reference, month), reference)
    return dimension.join(doomed.select(key), key, "left_anti")


def orphans(
    facts: DataFrame, references: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Fact rows per foreign key whose dimension row is missing.

    All foreign keys are counted in one pass and joined as counts per key value,
    so a key that most facts share costs one row. Null references are allowed.
    """
    pairs = F.array(
        *(
            F.struct(
                F.lit(column).alias("reference"), F.col(column).cast("string").alias("key_value")
            )
            for column in references
        )
    )
    used = (
        facts.select(F.inline(pairs))
        .filter(F.col("key_value").isNotNull())
        .groupBy("reference", "key_value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = None
    for column, (dimension, key) in references.items():
        keys = dimension.select(
            F.lit(column).alias("reference"), F.col(key).cast("string").alias("key_value")
        )
        known = keys if known is None else known.unionByName(keys)
    missing = used.join(known, ["reference", "key_value"], "left_anti")
    return missing.groupBy("reference").agg(
        F.count(F.lit(1)).alias("missing_keys"), F.sum("rows").alias("orphan_rows")
    )
