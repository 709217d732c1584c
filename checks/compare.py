"""Compare registered queries with their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import registered


def local_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a total order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(ordered, key=repr)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> list[str]:
    df = registered()[name](spark, sf_dir)
    ours = table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLES[name])
    theirs = table([c[0] for c in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    found = [f"{a}\n      {b}" for a, b in zip(ours[1], theirs[1]) if repr(a) != repr(b)]
    if len(ours[1]) != len(theirs[1]):
        found.insert(0, f"rows {len(ours[1])} != {len(theirs[1])}")
    return found


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(sf_dir)
    failed = 0
    for name in args[1:] or ORACLES:
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok':5}{name} {time.time() - start:.1f}s", flush=True)
        for line in found[:3]:
            print("   ", line)
        if found:
            print("    ...", len(found), "in all")
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
