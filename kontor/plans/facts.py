"""The two facts and the daily roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.functions import hours_between, micro_units, money_sum, round_cents, to_eur


def _order_charges(orders: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Orders with their two charges in EUR, at the rate of the order's UTC date.

    A day without a rate leaves the charges of CHF orders NULL; no other day stands in for it.
    """
    order_date = F.col("order_date_utc").cast("date")
    rates = fx_rates.select(F.col("rate_date").alias("order_date"), "rate")
    return (
        orders.withColumn("order_date", order_date)
        .join(rates, "order_date", "left")
        .select(
            "order_id",
            "customer_id",
            "order_date",
            "order_date_utc",
            F.col("status").alias("order_status"),
            "currency",
            to_eur(F.col("shipping_amount_local"), F.col("currency"), F.col("rate")).alias(
                "shipping_eur"
            ),
            to_eur(F.col("discount_amount_local"), F.col("currency"), F.col("rate")).alias(
                "discount_eur"
            ),
        )
    )


def _allocated(values: DataFrame) -> DataFrame:
    """Split the order's charges by each line's share of the order's gross value."""
    order_gross = F.col("order_gross") / F.lit(1_000_000.0)
    share = F.col("gross") / F.nullif(order_gross, F.lit(0.0))
    discount = F.col("order_discount") * share
    return values.select(
        "order_line_id",
        "order_id",
        "product_id",
        "customer_id",
        "order_date",
        "order_date_utc",
        "order_status",
        "currency",
        "quantity",
        "unit_price_eur",
        round_cents(F.col("gross")).alias("gross_amount_eur"),
        round_cents(F.col("order_shipping")).alias("order_shipping_amount_eur"),
        round_cents(F.col("order_discount")).alias("order_discount_amount_eur"),
        round_cents(F.col("order_shipping") * share).alias("allocated_shipping_eur"),
        round_cents(discount).alias("allocated_discount_eur"),
        round_cents(F.col("gross") - discount).alias("net_revenue_eur"),
    )


def fct_order_lines(lines: DataFrame, orders: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """One row per order line with converted and proportionally allocated charges.

    Gross values are totalled per order where the lines are read. Totals and charges, one row per
    order, then meet the lines on the order and a hash of its id: both sides come to that join from
    an exchange of their own, so AQE can split an order that holds much of the table. The length of the
    id serves as that hash, because nothing has to be told apart by it and it costs the exchange next to
    nothing, where eight bytes that do not compress would.
    """
    gross = F.col("quantity") * F.col("unit_price_eur")
    totals = lines.groupBy("order_id").agg(F.sum(micro_units(gross)).alias("order_gross"))
    key_hash = F.length("order_id").alias("_hash")
    per_order = (
        _order_charges(orders, fx_rates)
        .join(totals, "order_id")
        .withColumnsRenamed({"shipping_eur": "order_shipping", "discount_eur": "order_discount"})
        .select("*", key_hash)
    )
    together = lines.select("*", key_hash).join(per_order, ["order_id", "_hash"])
    return _allocated(together.withColumn("gross", gross))


def fct_order_fulfilment(orders: DataFrame, shipments: DataFrame, refunds: DataFrame) -> DataFrame:
    """One row per order: when each stage happened, and when the last of it became known."""
    delivered = F.col("status") == "delivered"
    shipped = F.col("status").isin("shipped", "delivered")
    stages = (
        shipments.where(shipped)
        .groupBy("order_id")
        .agg(
            F.min("occurred_at_utc").alias("shipped_at"),
            F.max("recorded_at_utc").alias("shipped_recorded_at"),
            F.min(F.when(delivered, F.col("occurred_at_utc"))).alias("delivered_at"),
            F.max(F.when(delivered, F.col("recorded_at_utc"))).alias("delivered_recorded_at"),
        )
    )
    refunded = refunds.groupBy("order_id").agg(
        F.min("occurred_at_utc").alias("refunded_at"),
        F.max("recorded_at_utc").alias("refunded_recorded_at"),
    )
    placed = F.col("order_date_utc")
    known = [
        F.coalesce(c, placed)
        for c in ("shipped_recorded_at", "delivered_recorded_at", "refunded_recorded_at")
    ]
    return (
        orders.join(stages, "order_id", "left")
        .join(refunded, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            F.col("status").alias("order_status"),
            placed.alias("placed_at"),
            "shipped_at",
            "delivered_at",
            "refunded_at",
            F.greatest(placed, *known).alias("last_recorded_at"),
            F.col("refunded_at").isNotNull().alias("is_refunded"),
            hours_between(placed, F.col("shipped_at")).alias("hours_placed_to_shipped"),
            hours_between(F.col("shipped_at"), F.col("delivered_at")).alias(
                "hours_shipped_to_delivered"
            ),
            hours_between(placed, F.col("delivered_at")).alias("hours_placed_to_delivered"),
        )
    )


def agg_daily_revenue(order_lines: DataFrame) -> DataFrame:
    """One row per order date."""
    return order_lines.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("order_count"),
        money_sum(F.col("net_revenue_eur")).alias("net_revenue_eur"),
    )
