"""The business queries on the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor.functions import money_sum, month_start, timestamp_literal
from kontor.session import materialise

NET = "net_revenue_eur"


def revenue_totals(order_lines: DataFrame) -> DataFrame:
    return order_lines.agg(
        money_sum(F.col(NET)).alias("total_net_revenue_eur"),
        F.countDistinct("order_id").alias("total_orders"),
    )


def revenue_by_month(order_lines: DataFrame) -> DataFrame:
    return (
        order_lines.groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(money_sum(F.col(NET)).alias(NET))
        .orderBy(F.col("month").asc_nulls_last())
    )


def revenue_by_currency(order_lines: DataFrame) -> DataFrame:
    return (
        order_lines.groupBy("currency")
        .agg(money_sum(F.col(NET)).alias(NET), F.countDistinct("order_id").alias("orders"))
        .orderBy(F.col(NET).desc_nulls_last())
    )


def category_revenue(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    return (
        order_lines.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(money_sum(F.col(NET)).alias(NET), F.countDistinct("order_id").alias("orders"))
        .orderBy(F.col(NET).desc_nulls_last())
    )


def category_revenue_by_month(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per month and category.

    Lines are first added up per product and month where they are read, so what meets the product
    table is at most months x products rows, however popular one product is.
    """
    by_product = order_lines.groupBy(
        "product_id", month_start(F.col("order_date")).alias("month")
    ).agg(money_sum(F.col(NET)).alias(NET))
    return (
        by_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("month", "category")
        .agg(money_sum(F.col(NET)).alias(NET))
        .orderBy(F.col("month").asc_nulls_last(), F.col("category").asc_nulls_last())
    )


def fulfilment_summary(fulfilment: DataFrame) -> DataFrame:
    refunded = F.when(F.col("is_refunded"), F.lit(1.0)).otherwise(F.lit(0.0))
    return fulfilment.agg(
        F.avg("hours_placed_to_shipped").alias("avg_hours_placed_to_shipped"),
        F.avg("hours_shipped_to_delivered").alias("avg_hours_shipped_to_delivered"),
        F.avg(refunded).alias("refund_rate"),
    )


def fulfilment_by_month(fulfilment: DataFrame) -> DataFrame:
    return (
        fulfilment.where(F.col("hours_placed_to_delivered").isNotNull())
        .groupBy(month_start(F.col("placed_at")).alias("month"))
        .agg(F.avg("hours_placed_to_delivered").alias("avg_hours_placed_to_delivered"))
        .orderBy(F.col("month").asc_nulls_last())
    )


def fulfilment_by_status(fulfilment: DataFrame) -> DataFrame:
    return (
        fulfilment.groupBy("order_status")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.avg("hours_placed_to_shipped").alias("avg_hours_placed_to_shipped"),
            F.avg("hours_shipped_to_delivered").alias("avg_hours_shipped_to_delivered"),
        )
        .orderBy(F.col("orders").desc_nulls_last())
    )


def category_aov(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Category revenue with the average order value."""
    return category_revenue(order_lines, products).withColumn(
        "avg_order_value_eur", F.col(NET) / F.col("orders")
    )


def category_growth(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Monthly revenue per category beside that of the month before, and its growth.

    Every category has a row for each month from the first to the last month of all revenue: a month
    without sales is a month with nothing, so two months with a gap between them never count as
    neighbours. Growth is NULL in the first month and after a month of nothing.
    """
    monthly = materialise(
        category_revenue_by_month(order_lines, products).where("month is not null"), "monthly"
    )
    first, last = monthly.agg(F.min("month"), F.max("month")).first()
    ends = [timestamp_literal(end) if end else F.lit(None).cast("timestamp_ntz") for end in (first, last)]
    every = F.sequence(*ends, F.expr("interval 1 month"))
    listed = (
        monthly.unionByName(
            monthly.select("category").distinct()
            .select(F.explode(every).alias("month"), "category", F.lit(0.0).alias(NET))
        )
        .groupBy("category", "month").agg(money_sum(F.col(NET)).alias(NET))
    )
    previous = F.lag(NET).over(Window.partitionBy("category").orderBy("month"))
    base = F.nullif("previous_month_eur", F.lit(0.0))
    return (
        listed.withColumn("previous_month_eur", previous)
        .withColumn("growth", (F.col(NET) - F.col("previous_month_eur")) / base)
        .orderBy(F.col("category").asc_nulls_last(), "month")
    )


def active_customers(order_lines: DataFrame, days: int = 90) -> DataFrame:
    """Customers with an order in the last ``days`` days before the newest order, and all customers."""
    newest = order_lines.agg(F.max("order_date")).first()[0]
    last = order_lines.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    as_of = F.lit(newest).cast("date")
    return last.agg(
        as_of.alias("as_of"),
        F.count_if(F.col("last_order") > F.date_sub(as_of, days)).alias("active_customers"),
        F.count("customer_id").alias("customers"),
    )


def order_bitmaps(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Partial distinct counts of orders per month, currency and category, to be rolled up.

    The lines are read once, for what is counted and by what; orders are numbered once. A partial row holds the orders of one group whose numbers lie in one
    bucket, as a bitmap; partials of different days or groups merge without the orders themselves.
    """
    by_group = materialise(
        order_lines.join(products.select("product_id", "category"), "product_id", "left")
        .select("order_id", month_start(F.col("order_date")).alias("month"), "currency", "category"),
        "orders-by-group",
    )
    numbered = _numbered(by_group.select("order_id").where("order_id is not null").distinct())
    return (
        by_group.join(numbered, "order_id")
        .groupBy("month", "currency", "category", F.bitmap_bucket_number("n").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("orders"))
    )


def _numbered(orders: DataFrame) -> DataFrame:
    """Whole numbers from 1 on, dense within a task's rows; written, so that no number changes."""
    number = F.monotonically_increasing_id() + 1
    return materialise(orders.select("order_id", number.alias("n")), "order-numbers")


def distinct_orders(partials: DataFrame, *by: str) -> DataFrame:
    """The exact number of distinct orders per group, from partial bitmaps alone."""
    merged = partials.groupBy(*by, "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))
    counted = merged.groupBy(*by) if by else merged.groupBy()
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("orders")), F.lit(0)).alias("orders"))


def order_count_rollup(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders in total, by month, by currency and by category, all from the same partials."""
    partials = materialise(order_bitmaps(order_lines, products), "order-bitmaps")
    parts = []
    for name in ("total", "month", "currency", "category"):
        counted = distinct_orders(partials, *([] if name == "total" else [name]))
        value = F.lit("all") if name == "total" else F.col(name).cast("string")
        parts.append(counted.select(F.lit(name).alias("level"), value.alias("value"), "orders"))
    return reduce(DataFrame.unionByName, parts)


UNCATEGORISED = "uncategorised"


def category_month_pivot(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per month, one column per category of the product table, sorted by name.

    Products without a category share one column, whose name is that of no category. The names are
    read from the product table, which is cheaper than finding them in the revenue itself.
    """
    found = products.select("category").distinct().orderBy(F.col("category").asc_nulls_first())
    categories = [row[0] for row in found.collect()]
    without = UNCATEGORISED
    while without in categories:
        without += "_"
    categories = sorted(without if c is None else c for c in categories)
    category = F.coalesce("category", F.lit(without))
    return (
        category_revenue_by_month(order_lines, products)
        .withColumn("category", category)
        .groupBy("month")
        .pivot("category", categories)
        .agg(money_sum(F.col(NET)))
        .orderBy(F.col("month").asc_nulls_last())
    )
