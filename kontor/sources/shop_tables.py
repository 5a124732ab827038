"""The seven raw shop tables, derived from a TPC-H-like folder of Parquet files.

Every value is integer arithmetic on the keys of the given tables, so the rows grow with them and
another engine can derive the same ones. The mapping is described in FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.operators.dedupe import keep_latest
from kontor.schemas import RAW

_INPUTS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_size int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    ),
}

# Fixed values.
CATEGORIES = [
    "Kitchen",
    "Living Room",
    "Bedroom",
    "Bathroom",
    "Garden",
    "Lighting",
    "Storage",
    "Decor",
]
CARRIERS = ["DHL", "DPD", "Hermes", "GLS"]
REFUND_REASONS = ["damaged", "wrong_item", "changed_mind", "late_delivery"]
SHIPPING_FEES = [0.0, 3.99, 4.99, 6.99]
TIERS = ["basic", "plus", "premium"]
STATUS_OF_PRIORITY = {
    "1-URGENT": "placed",
    "2-HIGH": "shipped",
    "3-MEDIUM": "delivered",
    "4-NOT SPECIFIED": "cancelled",
    "5-LOW": "refunded",
}


TABLES = ["customers", "products", "orders", "order_lines", "shipments", "refunds", "fx_rates"]


class ShopTables:
    """The raw layer as lazy DataFrames, each one set up when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def _derive(self, mapping: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        return mapping(self._spark, self._folder)

    @cached_property
    def customers(self) -> DataFrame:
        return self._derive(raw_customers)

    @cached_property
    def products(self) -> DataFrame:
        return self._derive(raw_products)

    @cached_property
    def orders(self) -> DataFrame:
        return self._derive(raw_orders)

    @cached_property
    def order_lines(self) -> DataFrame:
        return self._derive(raw_order_lines)

    @cached_property
    def shipments(self) -> DataFrame:
        return self._derive(raw_shipments)

    @cached_property
    def refunds(self) -> DataFrame:
        return self._derive(raw_refunds)

    @cached_property
    def fx_rates(self) -> DataFrame:
        return self._derive(raw_fx_rates)


def _input(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_INPUTS[name]).parquet(f"{folder}/{name}.parquet")


def _pad(number: Column, width: int) -> Column:
    """Zero-padded text. Plain lpad would cut numbers longer than the width."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, moment)


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _price(partkey: Column) -> Column:
    return F.lit(5.0) + ((partkey * 37) % 49500) / F.lit(100.0)


def _year_start() -> Column:
    return F.lit("1994-01-01 00:00:00").cast("timestamp_ntz")


def raw_customers(spark: SparkSession, folder: str, extract: int = 1) -> DataFrame:
    """Customer extract. The second one has movers, tier changes and mere e-mail changes."""
    c = F.col("c_custkey")
    zip_text = _pad(c % 100000, 5)
    nation = F.col("c_nationkey")
    tier_no = F.when(c % 10 < 6, 0).when(c % 10 < 9, 1).otherwise(2)
    city_no, postal = nation, F.when(c % 5 >= 3, zip_text)
    email = F.concat(F.lit("c"), c.cast("string"), F.lit("@example.com"))
    if extract == 2:
        moved, retiered = (c % 33 == 0) & (c % 2 == 0), (c % 33 == 0) & (c % 2 == 1)
        city_no = F.when(moved, (nation + 1) % 25).otherwise(nation)
        postal = F.when(moved, _pad((c + 7) % 100000, 5)).otherwise(postal)
        tier_no = F.when(retiered, (tier_no + 1) % 3).otherwise(tier_no)
        email = F.when(c % 50 == 1, F.concat(F.lit("new-"), email)).otherwise(email)
    signup = F.date_add(F.lit("1994-01-01").cast("date"), (c % 365).cast("int"))
    return _input(spark, folder, "customer").select(
        F.concat(F.lit("CUST-"), _pad(c, 6)).alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        email.alias("email"),
        F.when(nation % 4 == 0, "CH").when(nation % 4 == 1, "AT").otherwise("DE").alias("country"),
        F.concat(F.lit("City "), city_no.cast("string")).alias("city"),
        F.concat(F.lit("Street "), (c % 100).cast("string")).alias("address_line"),
        F.when(c % 5 < 3, zip_text).alias("zip_code"),
        postal.alias("postal_code"),
        _pick(TIERS, tier_no).alias("tier"),
        signup.cast("string").alias("signup_date"),
        F.concat(_iso(signup.cast("timestamp_ntz")), F.lit("+01:00")).alias("created_at"),
        F.lit("1").alias("load_id"),
        _pad(c, 10).alias("row_id"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("p_partkey")
    created = _plus_seconds(_year_start(), (p * 3607) % 31536000)
    return _input(spark, folder, "part").select(
        F.concat(F.lit("PROD-"), _pad(p, 6)).alias("product_id"),
        F.col("p_name").alias("name"),
        _pick(CATEGORIES, p % 8).alias("category"),
        F.concat(F.lit("Supplier "), _pick(list("ABCDEFGH"), F.col("p_size") % 8)).alias(
            "supplier"
        ),
        _price(p).alias("price_eur"),
        F.concat(_iso(created), F.lit("+01:00")).alias("created_at"),
        F.lit("1").alias("load_id"),
        _pad(p, 10).alias("row_id"),
    )


def _order_id(key: Column) -> Column:
    return F.concat(F.lit("ORD-"), _pad(key, 7))


def _order_status() -> Column:
    status = F.lit(None).cast("string")
    for priority, name in STATUS_OF_PRIORITY.items():
        status = F.when(F.col("o_orderpriority") == priority, name).otherwise(status)
    return status


def _order_date(k: Column) -> Column:
    """Order time as ISO text, in one of three offsets."""
    local = _plus_seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    return F.concat(_iso(local), _pick(["+01:00", "+02:00", "+00:00"], k % 3))


def _order_date_utc(k: Column) -> Column:
    local = _plus_seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    return _plus_seconds(local, -_pick([3600, 7200, 0], k % 3))


def _recording_delay(k: Column) -> Column:
    return F.when(k % 7 == 0, (1 + k % 5) * 86400 + (k % 24) * 3600).otherwise(F.lit(0))


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, one in 200 of them delivered again by a second load with a corrected fee."""
    k = F.col("o_orderkey")
    nations = _input(spark, folder, "customer").select("c_custkey", "c_nationkey")
    loads = F.when(k % 200 == 0, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1")))
    return (
        _input(spark, folder, "orders")
        .join(nations, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("load_id", F.explode(loads))
        .select(
            _order_id(k).alias("order_id"),
            F.concat(F.lit("CUST-"), _pad(F.col("o_custkey"), 6)).alias("customer_id"),
            _order_date(k).alias("order_date"),
            F.when(F.col("c_nationkey") % 4 == 0, "CHF").otherwise("EUR").alias("currency"),
            _order_status().alias("status"),
            F.when(F.col("load_id") == "2", F.lit(6.99))
            .otherwise(_pick(SHIPPING_FEES, k % 4))
            .alias("shipping_amount_local"),
            F.when(k % 5 == 0, F.lit(5.0) + (k % 1500) / F.lit(100.0))
            .otherwise(F.lit(0.0))
            .alias("discount_amount_local"),
            "load_id",
            _pad(k, 10).alias("row_id"),
        )
    )


def _line_quantity() -> Column:
    return (F.col("l_quantity").cast("bigint") - 1) % 5 + 1


def raw_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_lines_of(_input(spark, folder, "lineitem"))


def _raw_lines_of(lineitem: DataFrame) -> DataFrame:
    part = F.col("l_partkey")
    return lineitem.select(
        F.concat(
            F.lit("LINE-"),
            _pad(F.col("l_orderkey"), 8),
            F.lit("-"),
            F.col("l_linenumber").cast("string"),
        ).alias("order_line_id"),
        _order_id(F.col("l_orderkey")).alias("order_id"),
        F.concat(F.lit("PROD-"), _pad(part, 6)).alias("product_id"),
        _line_quantity().alias("quantity"),
        _price(part).alias("unit_price_eur"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("load_id"),
        F.concat(
            _pad(part, 10),
            _pad(F.col("l_suppkey"), 10),
            _pad(F.col("l_quantity").cast("bigint"), 4),
            _pad(F.col("l_extendedprice").cast("bigint"), 10),
        ).alias("row_id"),
    )


def raw_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """A shipped event, and for delivered orders a delivered event, with late recording."""
    k = F.col("o_orderkey")
    shipped = _plus_seconds(_order_date_utc(k), (1 + k % 4) * 86400 + (k * 31) % 7200)
    delivered = _plus_seconds(F.col("t1"), (1 + k % 5) * 86400 + (k * 17) % 7200)
    event = lambda number, status, at: F.struct(
        F.lit(number).alias("e"), F.lit(status).alias("status"), at.alias("t")
    )
    first = event(1, "shipped", F.col("t1"))
    return (
        _input(spark, folder, "orders")
        .withColumn("order_status", _order_status())
        .where(F.col("order_status").isin("shipped", "delivered"))
        .withColumn("t1", shipped)
        .withColumn(
            "event",
            F.explode(
                F.when(
                    F.col("order_status") == "delivered",
                    F.array(first, event(2, "delivered", delivered)),
                ).otherwise(F.array(first))
            ),
        )
        .select(
            F.concat(F.lit("SHIP-"), _pad(k * 2 + F.col("event.e"), 8)).alias("shipment_id"),
            _order_id(k).alias("order_id"),
            _pick(CARRIERS, k % 4).alias("carrier"),
            F.col("event.status").alias("status"),
            F.concat(
                _iso(_plus_seconds(F.col("event.t"), F.lit(3600))), F.lit("+01:00")
            ).alias("occurred_at"),
            F.concat(
                _iso(_plus_seconds(F.col("event.t"), 3600 + _recording_delay(k))),
                F.lit("+01:00"),
            ).alias("recorded_at"),
            F.lit("1").alias("load_id"),
            _pad(k * 2 + F.col("event.e"), 10).alias("row_id"),
        )
    )


def raw_refunds(spark: SparkSession, folder: str) -> DataFrame:
    """Partial refunds of every third cancelled or refunded order that has lines."""
    k = F.col("o_orderkey")
    lineitem = _input(spark, folder, "lineitem")
    lines = keep_latest(
        _raw_lines_of(lineitem.where(F.col("l_orderkey") % 3 == 0)), ["order_line_id"]
    )
    value_cents = lines.groupBy("order_id").agg(
        F.sum(F.rint(F.col("quantity") * F.col("unit_price_eur") * 100).cast("bigint")).alias("vc")
    )
    occurred = _plus_seconds(_order_date_utc(k), (1 + k % 10) * 86400)
    orders = (
        _input(spark, folder, "orders")
        .where(_order_status().isin("cancelled", "refunded") & (k % 3 == 0))
        .select(k, _order_id(k).alias("order_id"), occurred.alias("t"))
    )
    return orders.join(value_cents, "order_id").select(
        F.concat(F.lit("REF-"), _pad(k, 8)).alias("refund_id"),
        "order_id",
        (F.expr("(vc * (50 + o_orderkey % 50)) div 100") / F.lit(100.0)).alias("amount_eur"),
        _pick(REFUND_REASONS, k % 4).alias("reason"),
        F.concat(_iso(F.col("t")), F.lit("+00:00")).alias("occurred_at"),
        F.concat(_iso(_plus_seconds(F.col("t"), _recording_delay(k))), F.lit("+00:00")).alias(
            "recorded_at"
        ),
        F.lit("1").alias("load_id"),
        _pad(k, 10).alias("row_id"),
    )


def raw_fx_rates(spark: SparkSession, folder: str) -> DataFrame:
    """EUR/CHF on the weekdays around the order dates; weekends have no rate, like a bank feed."""
    days = (
        _input(spark, folder, "orders")
        .agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
        .select(
            F.explode(
                F.sequence(
                    F.date_sub(F.col("first").cast("date"), 2),
                    F.date_add(F.col("last").cast("date"), 2),
                )
            ).alias("day")
        )
    )
    return days.where(F.weekday("day") < 5).select(
        F.col("day").cast("string").alias("rate_date"),
        F.lit("EUR").alias("base_currency"),
        F.lit("CHF").alias("quote_currency"),
        (F.lit(0.9) + (F.unix_date("day") % 200) / F.lit(1000.0)).alias("rate"),
        F.lit("1").alias("load_id"),
        F.col("day").cast("string").alias("row_id"),
    )


def assert_raw_contract(tables: ShopTables) -> None:
    """Check names and types of the raw layer without running a job."""
    for name, schema in RAW.items():
        actual = [(f.name, f.dataType) for f in getattr(tables, name).schema.fields]
        expected = [(f.name, f.dataType) for f in schema.fields]
        if actual != expected:
            raise TypeError(f"raw {name}: expected {expected}, got {actual}")
