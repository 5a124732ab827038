"""The warehouse's check suite: 51 column checks and 6 business rules."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.functions import money_sum
from kontor.operators.checks import (
    count_duplicates,
    count_flagged,
    count_orphans,
    outside,
    report,
)

# The bounds that the shop's own checks use.
ROW_COUNT = (10_000, 200_000)
QUANTITY = (1, 5)
LINE_NET_REVENUE = (-25, 3000)
DAILY_REVENUE = (0, 100_000)
ALLOCATION_TOLERANCE = 0.03
REFUND_TOLERANCE = 0.01

UNIQUE = {
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "stg_order_lines": "order_line_id",
    "stg_shipments": "shipment_id",
    "stg_refunds": "refund_id",
    "stg_fx_rates": "rate_date",
    "dim_date": "date_day",
    "dim_product": "product_id",
    "fct_order_lines": "order_line_id",
    "fct_order_fulfilment": "order_id",
    "agg_daily_revenue": "order_date",
}
NOT_NULL = {
    "stg_customers": ["customer_id"],
    "stg_products": ["product_id"],
    "stg_orders": ["order_id", "customer_id"],
    "stg_order_lines": ["order_line_id", "order_id", "product_id"],
    "stg_shipments": ["shipment_id", "order_id"],
    "stg_refunds": ["refund_id", "order_id"],
    "stg_fx_rates": ["rate_date"],
    "dim_date": ["date_day"],
    "dim_public_holiday_de": ["holiday_date", "holiday_name", "federal_state"],
    "dim_product": ["product_id"],
    "dim_customer": ["customer_id", "valid_from"],
    "fct_order_lines": ["order_line_id", "order_id", "product_id", "customer_id", "order_date"],
    "fct_order_fulfilment": ["order_id", "customer_id", "placed_at"],
    "agg_daily_revenue": ["order_date"],
}
# (child, key, parent); parent and child key share the name.
RELATIONSHIPS = [
    ("stg_orders", "customer_id", "stg_customers"),
    ("stg_order_lines", "order_id", "stg_orders"),
    ("stg_order_lines", "product_id", "stg_products"),
    ("stg_shipments", "order_id", "stg_orders"),
    ("stg_refunds", "order_id", "stg_orders"),
    ("fct_order_lines", "product_id", "dim_product"),
]


@dataclass(frozen=True)
class Bounds:
    """Limits that depend on the size of the shop."""

    row_count: tuple[int, int] = ROW_COUNT
    quantity: tuple[int, int] = QUANTITY
    line_net_revenue: tuple[float, float] = LINE_NET_REVENUE
    daily_revenue: tuple[float, float] = DAILY_REVENUE
    #: Allow an order's shares what rounding puts on them, however many lines it has; see ``_misallocated``.
    rounding_by_lines: bool = False


def non_positive_quantities(stg_order_lines: DataFrame) -> DataFrame:
    return stg_order_lines.where(F.col("quantity") <= 0).select(
        "order_line_id", "order_id", "quantity"
    )


def delivered_before_order(fulfilment: DataFrame) -> DataFrame:
    return fulfilment.where(F.col("delivered_at") < F.col("placed_at")).select(
        "order_id", "placed_at", "delivered_at"
    )


def delivered_without_transit(fulfilment: DataFrame) -> DataFrame:
    return fulfilment.where(F.col("delivered_at") <= F.col("shipped_at")).select(
        "order_id", "shipped_at", "delivered_at"
    )


def order_charges(order_lines: DataFrame) -> DataFrame:
    """Per order: the charges as billed and as the sum of the lines' shares, and the gross value."""
    return order_lines.groupBy("order_id").agg(
        money_sum(F.col("allocated_shipping_eur")).alias("allocated_shipping"),
        F.max("order_shipping_amount_eur").alias("billed_shipping"),
        money_sum(F.col("allocated_discount_eur")).alias("allocated_discount"),
        F.max("order_discount_amount_eur").alias("billed_discount"),
        money_sum(F.col("gross_amount_eur")).alias("order_gross_amount_eur"),
        F.count(F.lit(1)).alias("order_lines"),
    )


def refund_totals(stg_refunds: DataFrame) -> DataFrame:
    return stg_refunds.groupBy("order_id").agg(
        money_sum(F.col("amount_eur")).alias("total_refunded_eur")
    )


def _misallocated(charge: str, tolerance: float, by_lines: bool = False) -> Column:
    """Whether an order's shares miss its charge by more than the tolerance.

    Every share and the charge itself are rounded by up to half a cent, so an order of seven lines can
    miss by the three cents that the fixed tolerance stands for, and a longer one by more. ``by_lines``
    allows half a cent for each of them where that is more, and compares whole half cents.
    """
    gap = F.abs(F.col(f"allocated_{charge}") - F.col(f"billed_{charge}"))
    if not by_lines:
        return gap > tolerance
    half_cents = lambda amount: F.rint(amount * 200).cast("bigint")
    return half_cents(gap) > F.greatest(half_cents(F.lit(tolerance)), F.col("order_lines") + 1)


def _refunded_too_much(tolerance: float) -> Column:
    return F.col("total_refunded_eur") > F.col("order_gross_amount_eur") + tolerance


def allocation_gaps(
    order_lines: DataFrame, charge: str, tolerance: float = ALLOCATION_TOLERANCE
) -> DataFrame:
    """Orders whose allocated charge (``shipping`` or ``discount``) misses the order's charge."""
    return (
        order_charges(order_lines)
        .where(_misallocated(charge, tolerance))
        .select(
            "order_id",
            F.col(f"allocated_{charge}").alias("allocated_total"),
            F.col(f"billed_{charge}").alias("order_total"),
        )
    )


def excess_refunds(
    order_lines: DataFrame, stg_refunds: DataFrame, tolerance: float = REFUND_TOLERANCE
) -> DataFrame:
    """Orders refunded by more than their gross value. Both sides are totalled before they meet."""
    return (
        refund_totals(stg_refunds)
        .join(order_charges(order_lines), "order_id")
        .where(_refunded_too_much(tolerance))
        .select("order_id", "total_refunded_eur", "order_gross_amount_eur")
    )


def _row_flags(table: str, bounds: Bounds) -> dict:
    flags = {f"not_null:{table}.{c}": F.col(c).isNull() for c in NOT_NULL[table]}
    if table == "stg_order_lines":
        flags["positive_quantity"] = F.col("quantity") <= 0
    if table == "fct_order_lines":
        flags["between:fct_order_lines.quantity"] = outside(F.col("quantity"), *bounds.quantity)
        flags["between:fct_order_lines.net_revenue_eur"] = outside(
            F.col("net_revenue_eur"), *bounds.line_net_revenue
        )
    if table == "agg_daily_revenue":
        flags["between:agg_daily_revenue.net_revenue_eur"] = outside(
            F.col("net_revenue_eur"), *bounds.daily_revenue
        )
    if table == "fct_order_fulfilment":
        flags["delivery_after_order"] = F.col("delivered_at") < F.col("placed_at")
        flags["delivery_takes_time"] = F.col("delivered_at") <= F.col("shipped_at")
    return flags


def quality_report(
    tables: Mapping[str, DataFrame],
    bounds: Bounds = Bounds(),
    of: Collection[str] | None = None,
) -> DataFrame:
    """The checks on the given built tables: (check_name, violations, passed); 57 on all of them.

    ``of`` names the tables whose checks are wanted, by default all that are given; the others only
    serve as the parents of relationships and in the rule on refunds. A check whose tables are not
    all given is left out. Row-level checks of a table share one pass over it, the three checks on
    whole orders share another one, all uniqueness checks share one exchange, and so do all
    relationships. Only the columns that the checks name are read.
    """
    wanted = [name for name in NOT_NULL if name in tables and (of is None or name in of)]
    totals, per_order, parts = {}, {}, []
    uniques = {
        f"unique:{name}.{UNIQUE[name]}": (tables[name], [UNIQUE[name]])
        for name in UNIQUE
        if name in wanted
    }
    if "dim_customer" in wanted:
        version = ["customer_id", "valid_from"]
        uniques[f"unique:dim_customer.{','.join(version)}"] = (tables["dim_customer"], version)
    relationships = {
        f"relationship:{child}.{key}": (tables[child], key, tables[parent], key)
        for child, key, parent in RELATIONSHIPS
        if child in wanted and parent in tables
    }
    if "fct_order_lines" in wanted:
        count = outside(F.count(F.lit(1)), *bounds.row_count)
        totals["fct_order_lines"] = {"row_count:fct_order_lines": count}
        whole_orders = order_charges(tables["fct_order_lines"])
        per_order = {
            f"{charge}_allocation": _misallocated(
                charge, ALLOCATION_TOLERANCE, bounds.rounding_by_lines
            )
            for charge in ("shipping", "discount")
        }
        if "stg_refunds" in tables:
            refunds = refund_totals(tables["stg_refunds"])
            whole_orders = whole_orders.join(refunds, "order_id", "left")
            per_order["refund_within_order_value"] = _refunded_too_much(REFUND_TOLERANCE)
        parts.append(count_flagged(whole_orders, per_order))
    flags = {name: _row_flags(name, bounds) for name in wanted}
    names = [*uniques, *relationships, *per_order]
    names += [check for name in wanted for check in (*flags[name], *totals.get(name, {}))]
    parts += [count_flagged(tables[name], flags[name], totals.get(name)) for name in wanted]
    if uniques:
        parts.append(count_duplicates(uniques))
    if relationships:
        parts.append(count_orphans(relationships))
    return report(names, parts)


class AuditFailed(RuntimeError):
    """Checks found violations; ``failed`` has their number by check."""

    def __init__(self, failed: Mapping[str, int]):
        listed = ", ".join(f"{name} ({n})" for name, n in sorted(failed.items()))
        super().__init__(f"nothing was published, checks failed: {listed}")
        self.failed = dict(failed)


def audit(
    tables: Mapping[str, DataFrame], bounds: Bounds, of: Collection[str] | None = None
) -> None:
    """Raises ``AuditFailed`` if a check finds violations. One row per check reaches the driver."""
    rows = quality_report(tables, bounds, of).where("not passed").collect()
    if rows:
        raise AuditFailed({row["check_name"]: row["violations"] for row in rows})
