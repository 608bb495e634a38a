"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from oracle import connect, differences
from tickloom import plans

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


def test_driver_registers_every_query():
    assert QUERIES.keys() <= driver.queries().keys() and SQL.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


@pytest.mark.parametrize("name, pushed", [
    ("vwap_range", ["EqualTo(symbol,BTCUSDT)", "GreaterThanOrEqual(window_start", "LessThan(window_start"]),
    ("latest_bar", ["GreaterThanOrEqual(window_start", "LessThan(window_start"]),
    ("trade_lookup", ["In(row_key"]),
    ("recent_trades", ["EqualTo(symbol,BTCUSDT)"]),
])
def test_serving_reads_filter_their_store(spark, name, pushed):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert all(filter_ in scan for filter_ in pushed) and "from_json" not in plan
