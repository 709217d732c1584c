"""Every registered query against its independent SQL on the smallest data."""

from __future__ import annotations

import pytest

from checks import queries as Q
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"raw_zone_scan", "raw_zone_reload", "write_verification", "merge_table_fact", "merge_table_time"}))
def test_plans_hold_no_nested_loops_or_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoop", "Cartesian", "Python", "Pandas", "MapInArrow"):
        assert operator not in plan


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 3
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def _reads_events(df) -> bool:
    return any("events.parquet" in file for file in df.inputFiles())


@pytest.mark.parametrize(
    ("name", "module", "step", "place"),
    [
        ("merge_table_fact", "tables", "merge_table", 1),
        ("merge_table_time", "tables", "merge_table", 1),
        ("daily_rollup_by_change", "tables", "merge_table", 1),
        ("station_totals_by_batch", "station_totals", "update_batch", 1),
        ("kpi_pivot", "reports", "kpi_pivot", 0),
    ],
)
def test_what_several_jobs_read_is_computed_once(spark, monkeypatch, name, module, step, place):
    """The frame that the step reads several times comes from written rows, not from the raw trips each time."""

    class Seen(Exception):
        pass

    def first_call(*given):
        raise Seen(_reads_events(given[place]))

    monkeypatch.setattr(getattr(Q, module), step, first_call)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, SMALL)
    assert seen.value.args == (False,)


def test_long_generated_methods_are_split(spark):
    """The JVM interprets methods of more than 8000 bytes, row by row."""
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    Q.raw_trips(spark, SMALL)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


@pytest.mark.parametrize("name", ["kpi_pivot", "member_distance_kpi", "member_insights", "member_vs_casual"])
def test_rides_of_the_kpi_report_are_computed_once(spark, monkeypatch, name):
    """Both passes of the report read written rides; neither cleans the raw trips again."""
    given, report = [], Q.reports.member_distance_kpi

    def noted(rides):
        given.append(_reads_events(rides))
        return report(rides)

    monkeypatch.setattr(Q.reports, "member_distance_kpi", noted)
    QUERIES[name](spark, SMALL)
    assert given == [False]
