"""Every query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from eventweft.checks import ORACLES, QUERIES
from tests.compare import TABLES, compare, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    result = compare(spark, SF_DIR, name, QUERIES[name], ORACLES[name], con)
    assert result["ok"], result


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "orderkey" in frame.columns


@pytest.fixture(scope="module")
def hot(con, tmp_path_factory):
    """The tables with 400 more line items in one order."""
    folder = tmp_path_factory.mktemp("hot")
    for name in TABLES:
        if name != "lineitem":
            (folder / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
    more = "SELECT * REPLACE (1 AS l_orderkey, l_linenumber + 100 AS l_linenumber) FROM lineitem WHERE l_orderkey > 1 LIMIT 400"
    con.execute(f"COPY (SELECT * FROM lineitem UNION ALL ({more})) TO '{folder}/lineitem.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["extract_array", "path_nested", "reconcile_counts"])
def test_one_order_is_one_event_whatever_its_size(spark, hot, name):
    result = compare(spark, hot, name, QUERIES[name], ORACLES[name], database(hot))
    assert result["ok"], result
