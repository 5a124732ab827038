"""Every registered query against its SQL on the smallest tables, and the anchors of FIXTURES.md."""

import pytest
from comparison import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.shop_queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    rows, different, _ = compare(spark, con, QUERIES[name], ORACLES[name], FOLDER)
    assert rows > 0
    assert different == 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "net_revenue_eur"]


ANCHORS = {
    "stg_orders": 1500,
    "stg_order_lines": 4599,
    "stg_customers": 150,
    "stg_products": 200,
    "stg_shipments": 956,
    "stg_refunds": 196,
    "stg_fx_rates": 1721,
    "dq_lines_without_revenue": 365,
}


@pytest.mark.parametrize("name", sorted(ANCHORS))
def test_row_counts(spark, name):
    assert QUERIES[name](spark, FOLDER).count() == ANCHORS[name]


def test_revenue_anchor(spark):
    assert tuple(QUERIES["revenue_totals"](spark, FOLDER).first()) == (514666.33, 1473)


def test_results_do_not_depend_on_partitioning(spark):
    expected = QUERIES["city_revenue_at_order_time"](spark, FOLDER).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        got = QUERIES["city_revenue_at_order_time"](spark, FOLDER).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_ordered_metrics_come_in_order(spark):
    months = [r[0] for r in QUERIES["revenue_by_month"](spark, FOLDER).collect()]
    assert months == sorted(months)
    revenue = [r[1] for r in QUERIES["category_revenue"](spark, FOLDER).collect()]
    assert revenue == sorted(revenue, reverse=True)
