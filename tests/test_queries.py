"""Every registered query against its SQL, on the tables as given and in another layout."""

import pytest
from compare import database, difference

from windrow.plans import ORACLES, QUERIES
from windrow.plans.inputs import TABLES
from windrow.session import scratch_dir


@pytest.fixture(scope="module")
def answers(small):
    return database(small)


@pytest.fixture(scope="module")
def other_layout(spark, small):
    """The same rows in seven files per table, in another order."""
    folder = scratch_dir(spark, "layout")
    for table in TABLES:
        spark.read.parquet(f"{small}/{table}.parquet").repartition(7).write.parquet(f"{folder}/{table}.parquet")
    return folder


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, answers, small, name):
    assert difference(spark, answers, name, small) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_layout_does_not_matter(spark, answers, other_layout, name):
    assert difference(spark, answers, name, other_layout) == ""


def test_queries_leave_the_session_as_it_was(spark, small):
    before = (spark.catalog.currentDatabase(), [t.name for t in spark.catalog.listTables()])
    databases = [d.name for d in spark.catalog.listDatabases()]
    for name in ("table_roundtrip", "list_tables", "ctas_location", "sql_group_count", "stream_sql_view"):
        QUERIES[name](spark, small)
    assert (spark.catalog.currentDatabase(), [t.name for t in spark.catalog.listTables()]) == before
    assert [d.name for d in spark.catalog.listDatabases()] == databases


def test_entry(spark):
    import __spark_entry__ as contract

    result = contract.entry(spark)
    assert result.count() == 20
    assert result.columns == ["origin", "term", "estimate", "std_error", "statistic", "p_value"]
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
