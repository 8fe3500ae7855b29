"""Every registered query on the smallest tables, against its SQL counterpart where it has one."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from tripweave.plans.registry import TYPED

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck.sql(ORACLES[name])) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_has_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


@pytest.mark.parametrize(
    "name, column, kind",
    [
        ("tsv_scan", "time_received", "timestamp_ntz"),
        ("dataset_preview", "time_received", "timestamp_ntz"),
        ("ping_clean", "service_date", "date"),
        ("segments", "service_date", "date"),
        ("linked_schema", "service_date", "date"),
        ("parquet_by_day", "service_date", "date"),
        ("calendar_gaps", "day", "date"),
    ],
)
def test_times_keep_their_types(spark, sf_dir, name, column, kind):
    """The contract's queries give them as text; the engine does not."""
    assert dict(TYPED[name](spark, sf_dir).dtypes)[column] == kind


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
