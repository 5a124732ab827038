from datetime import datetime

import pytest
from frames import as_dict, line, order, shop
from pyspark.sql import functions as F

from kontor.plans.facts import agg_daily_revenue, fct_order_lines
from kontor.plans.incremental import build_order_fulfilment, build_order_lines
from kontor.plans.staging import stage
from kontor.schemas import FCT_ORDER_FULFILMENT, FCT_ORDER_LINES

NOON = "2024-03-04T12:00:00+00:00"


def amounts(fact, line_id):
    return tuple(
        fact.where(F.col("order_line_id") == line_id)
        .select(
            "gross_amount_eur",
            "allocated_shipping_eur",
            "allocated_discount_eur",
            "net_revenue_eur",
        )
        .first()
    )


def test_charges_are_split_by_gross_share(spark):
    raw = shop(
        spark,
        orders=[order("O", shipping_amount_local=4.0, discount_amount_local=10.0)],
        lines=[line("a", "O", 1, 30.0), line("b", "O", 2, 5.0)],
    )
    fact = build_order_lines(raw)
    assert amounts(fact, "a") == (30.0, 3.0, 7.5, 22.5)
    assert amounts(fact, "b") == (10.0, 1.0, 2.5, 7.5)
    assert as_dict(agg_daily_revenue(fact), "order_count", "net_revenue_eur") == {1: 30.0}


def test_odd_cents_stay_unreconciled(spark):
    raw = shop(
        spark,
        orders=[order("O", discount_amount_local=0.1)],
        lines=[line(str(n), "O", 1, 1.0) for n in range(4)],
    )
    got = build_order_lines(raw).agg(F.sum("allocated_discount_eur")).first()[0]
    assert got == pytest.approx(0.12)


@pytest.mark.parametrize(
    ("currency", "rates", "expected"),
    [
        ("EUR", [], (10.0, 4.0, 2.0, 8.0)),
        ("CHF", [("2024-03-04", 0.8)], (10.0, 5.0, 2.5, 7.5)),
        ("CHF", [("2024-03-03", 0.8)], (10.0, None, None, None)),
        (None, [("2024-03-04", 0.8)], (10.0, 5.0, 2.5, 7.5)),
    ],
)
def test_currency_of_the_order_day(spark, currency, rates, expected):
    raw = shop(
        spark,
        orders=[
            order("O", NOON, currency=currency, shipping_amount_local=4.0, discount_amount_local=2.0)
        ],
        lines=[line("a", "O", 1, 10.0)],
        rates=rates,
    )
    assert amounts(build_order_lines(raw), "a") == expected


def test_rate_of_the_utc_day(spark):
    raw = shop(
        spark,
        orders=[order("O", "2024-03-05T00:30:00+01:00", currency="CHF", shipping_amount_local=4.0)],
        lines=[line("a", "O")],
        rates=[("2024-03-04", 0.5), ("2024-03-05", 0.8)],
    )
    assert amounts(build_order_lines(raw), "a")[1] == 8.0


def test_worthless_order_has_no_shares(spark):
    raw = shop(
        spark, orders=[order("O", shipping_amount_local=4.0)], lines=[line("a", "O", 1, 0.0)]
    )
    assert amounts(build_order_lines(raw), "a") == (0.0, None, None, None)


def test_lines_without_order_and_orders_without_lines_drop_out(spark):
    raw = shop(spark, orders=[order("O"), order("empty")], lines=[line("a", "O"), line("b", "X")])
    assert as_dict(build_order_lines(raw), "order_line_id", "order_id") == {"a": "O"}


def test_fact_schemas(spark, folder):
    from kontor.sources.shop_tables import ShopTables, assert_raw_contract

    raw = ShopTables(spark, folder)
    assert_raw_contract(raw)
    for fact, schema in (
        (build_order_lines(raw), FCT_ORDER_LINES),
        (build_order_fulfilment(raw), FCT_ORDER_FULFILMENT),
    ):
        assert [(f.name, f.dataType) for f in fact.schema] == [
            (f.name, f.dataType) for f in schema
        ]


def skewed_shop(spark, rows):
    """A third of all lines belong to one order."""
    raw = shop(spark, orders=[], rates=[("2024-03-04", 0.8)])
    raw.order_lines = spark.range(rows).select(
        F.concat(F.lit("L"), F.col("id")).alias("order_line_id"),
        F.when(F.col("id") % 3 == 0, F.lit("O0"))
        .otherwise(F.concat(F.lit("O"), (F.col("id") / 4).cast("int")))
        .alias("order_id"),
        F.lit("P").alias("product_id"),
        (F.col("id") % 5 + 1).alias("quantity"),
        ((F.col("id") * 37 % 4950 + 500) / 100).alias("unit_price_eur"),
        F.lit("1").alias("load_id"),
        F.col("id").cast("string").alias("row_id"),
    )
    ids = raw.order_lines.select("order_id").distinct()
    raw.orders = ids.select(
        "order_id",
        F.lit("C").alias("customer_id"),
        F.lit(NOON).alias("order_date"),
        F.when(F.col("order_id") == "O0", "CHF").otherwise("EUR").alias("currency"),
        F.lit("placed").alias("status"),
        F.lit(4.99).alias("shipping_amount_local"),
        F.lit(7.5).alias("discount_amount_local"),
        F.lit("1").alias("load_id"),
        F.lit("1").alias("row_id"),
    )
    return raw


def test_hot_order_has_the_same_totals_as_any_other(spark):
    staged = stage(skewed_shop(spark, 3000))
    rows = fct_order_lines(staged.order_lines, staged.orders, staged.fx_rates)
    assert rows.count() == 3000


def event(shipment_id, status, occurred, recorded=None, order_id="O"):
    return {
        "shipment_id": shipment_id,
        "order_id": order_id,
        "status": status,
        "occurred_at": occurred,
        "recorded_at": recorded or occurred,
    }


def test_lifecycle(spark):
    raw = shop(
        spark,
        orders=[order("O", "2024-03-04T10:59:00+00:00"), order("bare", NOON), order("direct", NOON)],
        shipments=[
            event("s1", "shipped", "2024-03-05T11:01:00+00:00", "2024-03-09T00:00:00+00:00"),
            event("s2", "delivered", "2024-03-06T12:30:00+00:00"),
            event("s3", "lost", "2024-03-01T00:00:00+00:00", "2024-04-01T00:00:00+00:00"),
            event("s4", "delivered", "2024-03-07T00:00:00+00:00", order_id="direct"),
        ],
        refunds=[
            {"refund_id": "r1", "order_id": "O", "amount_eur": 1.0,
             "occurred_at": "2024-03-08T00:00:00+00:00", "recorded_at": "2024-03-08T00:00:00+00:00"},
            {"refund_id": "r2", "order_id": "O", "amount_eur": 1.0,
             "occurred_at": "2024-03-07T00:00:00+00:00", "recorded_at": "2024-03-20T00:00:00+00:00"},
        ],
    )
    rows = {r["order_id"]: r for r in build_order_fulfilment(raw).collect()}
    full, bare, direct = rows["O"], rows["bare"], rows["direct"]
    assert full["shipped_at"] == datetime(2024, 3, 5, 11, 1)
    assert full["delivered_at"] == datetime(2024, 3, 6, 12, 30)
    assert full["refunded_at"] == datetime(2024, 3, 7)
    assert full["last_recorded_at"] == datetime(2024, 3, 20)
    assert full["hours_placed_to_shipped"] == 25
    assert full["hours_shipped_to_delivered"] == 25
    assert full["hours_placed_to_delivered"] == 50
    assert full["is_refunded"] and not bare["is_refunded"]
    assert bare["last_recorded_at"] == bare["placed_at"]
    assert bare["shipped_at"] is None and bare["hours_placed_to_shipped"] is None
    assert direct["shipped_at"] == direct["delivered_at"] == datetime(2024, 3, 7)
    assert direct["hours_shipped_to_delivered"] == 0
