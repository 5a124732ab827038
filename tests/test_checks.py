import pytest
from frames import as_dict, raw_frame
from pyspark.sql import functions as F

from kontor.operators import checks
from kontor.plans import quality

LINE = "order_line_id string, order_id string, quantity bigint"


def test_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert as_dict(checks.duplicated(df, "k"), "k", "occurrences") == {"a": 2}
    assert checks.duplicated(df, "k", "n").isEmpty()


def test_not_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert checks.missing(df, "k").count() == 1


def test_orphans_are_counted_per_key(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert as_dict(checks.orphans(child, "k", parent, "k"), "key", "child_rows") == {"x": 2}


def test_range_spares_null(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (6.0,), (None,)], "v double")
    got = sorted(r[0] for r in checks.out_of_range(df, "v", 1, 5).collect())
    assert got == [0.0, 6.0]


def test_row_count(spark):
    df = spark.range(5)
    assert checks.row_count_outside(df, 1, 5).isEmpty()
    assert checks.row_count_outside(df, 6, 9).first()[0] == 5
    assert checks.row_count_outside(df.limit(0), 1, 9).first()[0] == 0


def test_business_rules(spark):
    lines = spark.createDataFrame([("l1", "o", 0), ("l2", "o", -1), ("l3", "o", 1)], LINE)
    assert quality.non_positive_quantities(lines).count() == 2
    orders = spark.sql("""
        select 'ok' order_id, timestamp_ntz'2024-01-01' placed_at,
               timestamp_ntz'2024-01-02' shipped_at, timestamp_ntz'2024-01-03' delivered_at
        union all select 'same', timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-02',
                         timestamp_ntz'2024-01-02'
        union all select 'early', timestamp_ntz'2024-01-05', null, timestamp_ntz'2024-01-02'
        union all select 'open', timestamp_ntz'2024-01-05', null, null""")
    assert [r[0] for r in quality.delivered_without_transit(orders).collect()] == ["same"]
    assert [r[0] for r in quality.delivered_before_order(orders).collect()] == ["early"]


def fact(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_id string, allocated_shipping_eur double, order_shipping_amount_eur double, "
        "allocated_discount_eur double, order_discount_amount_eur double, gross_amount_eur double",
    )


def test_allocation(spark):
    eighths = [("eight", 0.13, 1.0, 0.12, 1.0, 1.0)] * 8
    df = fact(spark, [*eighths, ("null", None, None, None, None, 5.0), ("ok", 1.0, 1.02, 2.0, 2.0, 5.0)])
    got = as_dict(quality.allocation_gaps(df, "shipping"), "order_id", "allocated_total", "order_total")
    assert got == {"eight": (1.04, 1.0)}
    assert [r[0] for r in quality.allocation_gaps(df, "discount").collect()] == ["eight"]
    assert quality.allocation_gaps(df, "shipping", tolerance=0.05).isEmpty()


def test_refunds(spark):
    df = fact(spark, [("o", 0.0, 0.0, 0.0, 0.0, 5.0), ("o", 0.0, 0.0, 0.0, 0.0, 5.0)])
    rows = [("r1", "o", 6.0), ("r2", "o", 4.01), ("r3", "elsewhere", 99.0)]
    refunds = spark.createDataFrame(rows, "refund_id string, order_id string, amount_eur double")
    assert quality.excess_refunds(df, refunds).isEmpty()
    more = refunds.union(spark.createDataFrame([("r4", "o", 0.01)], "a string, b string, c double"))
    assert tuple(quality.excess_refunds(df, more).first()) == ("o", 10.02, 10.0)


@pytest.fixture(scope="module")
def built(spark):
    from __spark_entry__ import _built_tables

    return _built_tables(spark, "/root/testdata/sf0.001")


def outcome(report):
    return {r["check_name"]: (r["violations"], r["passed"]) for r in report.collect()}


def test_report_has_57_checks_and_follows_the_bounds(built):
    got = outcome(quality.quality_report(built))
    assert len(got) == 57
    assert {k for k, v in got.items() if not v[1]} == {"row_count:fct_order_lines"}
    bounds = quality.Bounds(row_count=(1, 10_000), quantity=(1, 4), daily_revenue=(0, 1000))
    got = outcome(quality.quality_report(built, bounds))
    failing = {k for k, v in got.items() if not v[1]}
    assert failing == {
        "between:fct_order_lines.quantity",
        "between:agg_daily_revenue.net_revenue_eur",
    }


def test_report_finds_planted_violations(spark, built):
    refunds = built["stg_refunds"].limit(1)
    broken = {
        **built,
        "stg_products": built["stg_products"].where("product_id <> 'PROD-000001'"),
        "stg_customers": built["stg_customers"].union(built["stg_customers"].limit(1)),
        "stg_refunds": refunds.withColumn("amount_eur", F.lit(1e6)).unionByName(
            refunds.withColumn("refund_id", F.lit(None).cast("string"))
        ),
    }
    got = outcome(quality.quality_report(broken))
    lost = built["stg_order_lines"].where("product_id = 'PROD-000001'").count()
    assert got["relationship:stg_order_lines.product_id"] == (lost, False)
    assert got["unique:stg_customers.customer_id"] == (1, False)
    assert got["not_null:stg_refunds.refund_id"] == (1, False)
    assert got["refund_within_order_value"] == (1, False)


def test_duplicates_in_the_raw_layer(spark):
    raw = raw_frame(spark, "orders", [{"order_id": "a"}, {"order_id": "a"}, {"order_id": "b"}])
    assert as_dict(checks.duplicated(raw, "order_id"), "order_id", "occurrences") == {"a": 2}


def test_grouped_counts_agree_with_the_single_checks(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None), ("y", None), (None, 2)], "k string, n int")
    b = spark.createDataFrame([("x",), ("z",), ("z",)], "k string")
    uniques = {"a": (a, ["k"]), "pair": (a, ["k", "n"]), "b": (b, ["k"]), "none": (b.distinct(), ["k"])}
    expected = {n: checks.duplicated(df, *keys).count() for n, (df, keys) in uniques.items()}
    assert expected == {"a": 2, "pair": 1, "b": 1, "none": 0}
    counted = checks.count_duplicates(uniques)
    assert as_dict(counted, "check_name", "violations") == {"a": 2, "pair": 1, "b": 1}
    links = {"ab": (a, "k", b, "k"), "ba": (b, "k", a, "k"), "bb": (b, "k", b, "k")}
    orphaned = checks.count_orphans(links)
    assert as_dict(orphaned, "check_name", "violations") == {"ab": 2, "ba": 2}
    full = checks.report([*uniques, *links], [counted, orphaned])
    assert outcome(full) == {
        "a": (2, False), "pair": (1, False), "b": (1, False), "none": (0, True),
        "ab": (2, False), "ba": (2, False), "bb": (0, True),
    }
