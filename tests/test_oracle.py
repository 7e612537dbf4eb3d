"""Every registered query against its SQL, and the counts known for the given tables."""

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from retail_stream import oracle, registry

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def databases():
    return {path: connect(path) for path in (SMALL, MEDIUM)}


def check(spark, databases, name, path):
    rows, different = differences(
        spark, databases[path], driver.queries()[name], driver.oracle_sql()[name], path
    )
    assert different is None, different
    return rows


def test_every_query_has_sql():
    """Queries of the optional package for training data have tests of their own."""
    assert set(registry.all_queries()) == set(oracle.all_sql())
    assert set(oracle.all_sql()) <= set(driver.oracle_sql()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(registry.all_queries()))
def test_small(spark, databases, name):
    check(spark, databases, name, SMALL)


# --- Fixed values: row counts computed independently of this package ---
@pytest.mark.parametrize(
    "name, rows",
    [
        ("dau_first_start", 1611),
        ("sale_interval_join", 30310),
        ("coupon_alert", 121),
        ("stream_dau", 1611),
        ("stream_coupon_alert", 121),
    ],
)
def test_known_counts(spark, databases, name, rows):
    assert check(spark, databases, name, MEDIUM) == rows


def test_cdc_routes_only_inserts_of_orders(spark):
    routed = driver.queries()["cdc_route"](spark, MEDIUM)
    assert routed.filter("topic = 'order_info'").count() == 8182


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["log_date", "log_hour", "ct"]
    assert sum(r.ct for r in frame.collect()) == 156
