"""One function per source: rename, cast, move times to UTC, keep the latest load. No joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.functions import utc_naive
from kontor.operators.dedupe import keep_latest

_META = ("load_id", "row_id")


@dataclass(frozen=True)
class Staging:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_lines: DataFrame
    shipments: DataFrame
    refunds: DataFrame
    fx_rates: DataFrame


def typed_customers(raw: DataFrame) -> DataFrame:
    """The renamed postal code wins over its old name."""
    return raw.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "country",
        "city",
        "address_line",
        F.coalesce("postal_code", "zip_code").alias("postal_code"),
        "tier",
        F.col("signup_date").cast("date").alias("signup_date"),
        utc_naive(F.col("created_at")).alias("created_at_utc"),
        *_META,
    )


def typed_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "name",
        "category",
        "supplier",
        "price_eur",
        utc_naive(F.col("created_at")).alias("created_at_utc"),
        *_META,
    )


def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        utc_naive(F.col("order_date")).alias("order_date_utc"),
        "currency",
        "status",
        "shipping_amount_local",
        "discount_amount_local",
        *_META,
    )


def typed_order_lines(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_line_id", "order_id", "product_id", "quantity", "unit_price_eur", *_META
    )


def typed_shipments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "shipment_id",
        "order_id",
        "carrier",
        "status",
        utc_naive(F.col("occurred_at")).alias("occurred_at_utc"),
        utc_naive(F.col("recorded_at")).alias("recorded_at_utc"),
        *_META,
    )


def typed_refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        "refund_id",
        "order_id",
        "amount_eur",
        "reason",
        utc_naive(F.col("occurred_at")).alias("occurred_at_utc"),
        utc_naive(F.col("recorded_at")).alias("recorded_at_utc"),
        *_META,
    )


def typed_fx_rates(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("rate_date").cast("date").alias("rate_date"),
        "base_currency",
        "quote_currency",
        "rate",
        *_META,
    )


def _published(df: DataFrame, keys: list[str]) -> DataFrame:
    return keep_latest(df, keys).drop(*_META)


def stg_customers(raw: DataFrame) -> DataFrame:
    return _published(typed_customers(raw), ["customer_id"])


def stg_products(raw: DataFrame) -> DataFrame:
    return _published(typed_products(raw), ["product_id"])


def stg_orders(raw: DataFrame) -> DataFrame:
    return _published(typed_orders(raw), ["order_id"])


def stg_order_lines(raw: DataFrame) -> DataFrame:
    return _published(typed_order_lines(raw), ["order_line_id"])


def stg_shipments(raw: DataFrame) -> DataFrame:
    return _published(typed_shipments(raw), ["shipment_id"])


def stg_refunds(raw: DataFrame) -> DataFrame:
    return _published(typed_refunds(raw), ["refund_id"])


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    return _published(typed_fx_rates(raw), ["rate_date", "base_currency", "quote_currency"])


def stage(raw) -> Staging:
    """All seven staging frames, lazily."""
    return Staging(
        customers=stg_customers(raw.customers),
        products=stg_products(raw.products),
        orders=stg_orders(raw.orders),
        order_lines=stg_order_lines(raw.order_lines),
        shipments=stg_shipments(raw.shipments),
        refunds=stg_refunds(raw.refunds),
        fx_rates=stg_fx_rates(raw.fx_rates),
    )
