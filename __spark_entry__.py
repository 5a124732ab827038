"""Registered queries over the given tables, and the SQL that states their expected results."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from functools import partial
from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The package lies beside this file, wherever the caller was started.
sys.path[:0] = [str(Path(__file__).resolve().parent)]

import oracle_queries
from kontor.functions import money_sum, month_start, timestamp_literal, utc_naive
from kontor.operators.checks import (
    duplicated,
    missing,
    orphans,
    out_of_range,
    row_count_outside,
)
from kontor.operators.scd2 import as_of_join, first_snapshot, snapshot
from kontor.plans import calendar, metrics, quality, staging
from kontor.plans.dimensions import dim_customer, dim_product
from kontor.plans.facts import agg_daily_revenue, fct_order_fulfilment, fct_order_lines
from kontor.plans.incremental import (
    backfill_order_fulfilment,
    backfill_order_lines,
    build_order_fulfilment,
    build_order_lines,
    order_fulfilment_table,
    order_lines_table,
    refresh_order_fulfilment,
    refresh_order_lines,
)
from kontor.plans.warehouse import (
    CHECK_COLUMNS,
    Warehouse,
    customer_history_table,
    materialise_staging,
    refresh_customer_history,
    register_views,
)
from kontor.session import WRITTEN, configure, materialise, scratch_path, side_by_side
from kontor.sources.extracts import (
    load_extracts,
    load_raw,
    read_holiday_seed,
    read_raw,
    stored_raw,
    write_seed,
)
from kontor.sources.fx import fx_date_range, fx_payload, flatten_fx, read_fx_payload
from kontor.sources.shop_tables import TABLES, ShopTables, raw_customers

Query = Callable[[SparkSession, str], DataFrame]

FIRST_SNAPSHOT = datetime(1994, 6, 1)
SECOND_SNAPSHOT = datetime(1998, 6, 1)
# The first incremental run sees what was known before this moment, and no corrected orders.
CUTOFF = datetime(2001, 1, 1)
BACKFILL = ("1998-01-01", "1998-03-31")
BACKFILL_LOOKBACK_DAYS = 1500
WHOLE_TABLE_DAYS = 5000
#: The check suite with bounds for tables of any size.
ANY_SIZE = quality.Bounds(
    (0, 10**15), (1, 5), (-1e12, 1e12), (-1e15, 1e15), rounding_by_lines=True
)


def _raw(spark: SparkSession, folder: str) -> ShopTables:
    return ShopTables(configure(spark), folder)


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return build_order_lines(_raw(spark, folder))


def _order_fulfilment(spark: SparkSession, folder: str) -> DataFrame:
    return build_order_fulfilment(_raw(spark, folder))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return dim_product(staging.stg_products(_raw(spark, folder).products))


def _staged(name: str) -> Query:
    model = getattr(staging, f"stg_{name}")
    return lambda spark, folder: model(getattr(_raw(spark, folder), name))


def _on_lines(metric: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: metric(_order_lines(spark, folder))


def _on_lines_and_products(metric: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: metric(_order_lines(spark, folder), _products(spark, folder))


def _on_fulfilment(metric: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: metric(_order_fulfilment(spark, folder))


def _order_years(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar years in which orders were placed."""
    return calendar.years_of(staging.typed_orders(_raw(spark, folder).orders), "order_date_utc")


def _holidays(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.dim_public_holiday_de(calendar.holiday_seed(_order_years(spark, folder)))


def _dim_date(spark: SparkSession, folder: str) -> DataFrame:
    spine = calendar.date_spine(_order_years(spark, folder))
    return calendar.dim_date(spine, _holidays(spark, folder))


def _holidays_from_seed(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(configure(spark), "holiday-seed")
    write_seed(calendar.holiday_seed(_order_years(spark, folder)), path)
    return calendar.dim_public_holiday_de(read_holiday_seed(spark, path))


def _fx_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return fx_date_range(_raw(spark, folder).orders)


def _fx_from_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(configure(spark), "fx-payload")
    fx_payload(staging.stg_fx_rates(_raw(spark, folder).fx_rates)).write.json(path)
    return flatten_fx(read_fx_payload(spark, path))


def _reloaded_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Load the first extract, append the second one, and stage: the latest load wins."""
    configure(spark)
    raw_folder = scratch_path(spark, "raw")
    for extract, mode in ((1, "replace"), (2, "append")):
        rows = raw_customers(spark, folder, extract).drop("load_id", "row_id")
        load_raw(rows, raw_folder, "customers", str(extract), mode)
    return staging.stg_customers(read_raw(spark, raw_folder, "customers"))


def _loads_of_extracts(spark: SparkSession, folder: str):
    """The raw layer after two loads of extract folders: everything, and then corrected orders."""
    raw, raw_folder = _raw(spark, folder), scratch_path(spark, "raw")
    corrected = F.col("load_id") == "2"
    for number, correction in (("1", False), ("2", True)):
        inbox, writes = scratch_path(spark, f"extracts-{number}"), []
        for name in TABLES:
            rows = getattr(raw, name)
            if name == "orders":
                rows = rows.where(corrected if correction else ~corrected)
            elif correction:
                rows = rows.limit(0)
            extract = rows.drop("load_id", "row_id").write.options(**WRITTEN)
            writes.append(partial(extract.parquet, f"{inbox}/{name}.parquet"))
        side_by_side(*writes)
        load_extracts(spark, inbox, raw_folder, number)
    return stored_raw(spark, raw_folder)


def _order_fulfilment_from_extracts(spark: SparkSession, folder: str) -> DataFrame:
    return build_order_fulfilment(_loads_of_extracts(spark, folder))


def _loaded(spark: SparkSession, folder: str, *names: str) -> SimpleNamespace:
    """Some raw tables as written files, which is how repeated runs meet them."""
    raw = _raw(spark, folder)
    writes = [partial(materialise, getattr(raw, n), f"raw-{n}") for n in names]
    return SimpleNamespace(**dict(zip(names, side_by_side(*writes), strict=True)))


def _raw_at_cutoff(raw: SimpleNamespace) -> SimpleNamespace:
    """What the first run finds: events recorded by then, and no corrected orders."""
    known = lambda column: utc_naive(F.col(column)) < timestamp_literal(CUTOFF)
    seen = {"orders": raw.orders.where(known("order_date") & (F.col("load_id") == "1"))}
    for name in ("shipments", "refunds"):
        if hasattr(raw, name):
            seen[name] = getattr(raw, name).where(known("recorded_at"))
    return SimpleNamespace(**{**vars(raw), **seen})


def _lines_after_two_runs(spark: SparkSession, folder: str):
    raw = _loaded(spark, folder, "orders", "order_lines", "fx_rates")
    table = order_lines_table(spark, scratch_path(spark, "fct_order_lines"))
    refresh_order_lines(table, _raw_at_cutoff(raw))
    refresh_order_lines(table, raw)
    return table, raw


def _order_lines_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _lines_after_two_runs(spark, folder)[0].current()


def _order_lines_backfill(spark: SparkSession, folder: str) -> DataFrame:
    table, raw = _lines_after_two_runs(spark, folder)
    backfill_order_lines(table, raw, *BACKFILL, lookback_days=BACKFILL_LOOKBACK_DAYS)
    return table.current()


def _fulfilment_after_two_runs(spark: SparkSession, folder: str):
    raw = _loaded(spark, folder, "orders", "shipments", "refunds")
    table = order_fulfilment_table(spark, scratch_path(spark, "fct_order_fulfilment"))
    refresh_order_fulfilment(table, _raw_at_cutoff(raw))
    refresh_order_fulfilment(table, raw)
    return table, raw


def _order_fulfilment_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _fulfilment_after_two_runs(spark, folder)[0].current()


def _order_fulfilment_backfill(spark: SparkSession, folder: str) -> DataFrame:
    table, raw = _fulfilment_after_two_runs(spark, folder)
    backfill_order_fulfilment(table, raw, *BACKFILL, lookback_days=WHOLE_TABLE_DAYS)
    return table.current()


def _two_nights(spark: SparkSession, folder: str, spoil=None) -> Warehouse:
    """A warehouse after a night that saw what was known at the cutoff and one that saw everything.

    ``spoil`` changes what the second night finds; its audit may then fail.
    """
    raw = _loaded(spark, folder, *TABLES)
    first = _raw_at_cutoff(raw)
    first.order_lines = raw.order_lines.join(first.orders.select("order_id"), "order_id", "left_semi")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.run(first, FIRST_SNAPSHOT, bounds=ANY_SIZE)
    if spoil is None:
        warehouse.run(raw, SECOND_SNAPSHOT, bounds=ANY_SIZE)
    else:
        try:
            warehouse.run(spoil(raw), SECOND_SNAPSHOT, bounds=ANY_SIZE)
        except quality.AuditFailed:
            return warehouse
        raise ValueError("the audit let spoilt rows pass")
    return warehouse


def _daily_revenue_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The roll-up after two nights, of which the second touched the days it had to."""
    return _two_nights(spark, folder).marts()["agg_daily_revenue"]


def _negated(raw: SimpleNamespace) -> SimpleNamespace:
    """Lines of every seventh order with their quantity negated."""
    quantity = F.when(_spoilt(7), -F.col("quantity")).otherwise(F.col("quantity"))
    return SimpleNamespace(
        **{**vars(raw), "order_lines": raw.order_lines.withColumn("quantity", quantity)}
    )


def _daily_revenue_after_failed_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What the first night published: the second one's audit finds quantities below zero."""
    return _two_nights(spark, folder, _negated).marts()["agg_daily_revenue"]


def _line_count_out_of_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """The row count, because it breaks a bound that is far too low."""
    return row_count_outside(_order_lines(spark, folder), 1, 100)


def _customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    extracts = [
        staging.stg_customers(raw_customers(configure(spark), folder, extract))
        for extract in (1, 2)
    ]
    history = first_snapshot(extracts[0], FIRST_SNAPSHOT)
    return dim_customer(
        snapshot(history, extracts[1], "customer_id", CHECK_COLUMNS, SECOND_SNAPSHOT)
    )


def _stored_customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The history as a stored table after two snapshots of two extracts."""
    table = customer_history_table(spark, scratch_path(configure(spark), "customer-history"))
    for extract, run_time in ((1, FIRST_SNAPSHOT), (2, SECOND_SNAPSHOT)):
        customers = staging.stg_customers(raw_customers(spark, folder, extract))
        refresh_customer_history(table, customers, run_time)
    return dim_customer(table.current())


def _orders_customer_as_of(spark: SparkSession, folder: str) -> DataFrame:
    orders = staging.stg_orders(_raw(spark, folder).orders).select(
        "order_id", "customer_id", "order_date_utc"
    )
    versions = _customer_versions(spark, folder).select(
        "customer_id", "city", "postal_code", "tier", "valid_from", "valid_to"
    )
    return as_of_join(orders, versions, "customer_id", "order_date_utc")


def _city_revenue_at_order_time(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly revenue by the city in which the customer lived when ordering."""
    net = F.col("net_revenue_eur")
    sales = (
        _order_lines(spark, folder)
        .groupBy("customer_id", "order_date_utc")
        .agg(money_sum(net).alias("net_revenue_eur"))
    )
    versions = _customer_versions(spark, folder).select(
        "customer_id", "city", "valid_from", "valid_to"
    )
    return (
        as_of_join(sales, versions, "customer_id", "order_date_utc")
        .groupBy(month_start(F.col("order_date_utc")).alias("month"), "city")
        .agg(money_sum(net).alias("net_revenue_eur"))
    )


def _built_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Staging and marts as written tables, the way the checks see them."""
    raw = _raw(spark, folder)
    staged = materialise_staging(raw)
    lines = fct_order_lines(staged.order_lines, staged.orders, staged.fx_rates)
    fulfilment = fct_order_fulfilment(staged.orders, staged.shipments, staged.refunds)
    lines = materialise(lines, "fct-order-lines")
    tables = {f"stg_{name}": df for name, df in vars(staged).items()}
    tables |= {
        "dim_date": _dim_date(spark, folder),
        "dim_public_holiday_de": _holidays(spark, folder),
        "dim_product": dim_product(staged.products),
        "dim_customer": _customer_versions(spark, folder),
        "fct_order_lines": lines,
        "fct_order_fulfilment": materialise(fulfilment, "fct-order-fulfilment"),
        "agg_daily_revenue": agg_daily_revenue(lines),
    }
    return tables


def _quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_built_tables(spark, folder))


def _duplicate_orders(spark: SparkSession, folder: str) -> DataFrame:
    return duplicated(_raw(spark, folder).orders, "order_id")


def _duplicate_order_products(spark: SparkSession, folder: str) -> DataFrame:
    """(order, product) is no key of the lines: products are drawn with replacement."""
    lines = staging.stg_order_lines(_raw(spark, folder).order_lines)
    return duplicated(lines, "order_id", "product_id")


def _lines_without_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return missing(_order_lines(spark, folder), "net_revenue_eur").select(
        "order_line_id", "order_id", "order_date", "currency"
    )


def _orders_without_refund(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan check from orders to refunds, which most orders do not have."""
    raw = _raw(spark, folder)
    return orphans(
        staging.stg_orders(raw.orders), "order_id", staging.stg_refunds(raw.refunds), "order_id"
    )


def _net_revenue_out_of_range(spark: SparkSession, folder: str) -> DataFrame:
    lines = out_of_range(_order_lines(spark, folder), "net_revenue_eur", 0, 1500)
    return lines.select("order_line_id", "net_revenue_eur")


def _excess_refunds(spark: SparkSession, folder: str) -> DataFrame:
    """With a negative tolerance: refunds that come within 100 EUR of the order's value."""
    raw = _raw(spark, folder)
    return quality.excess_refunds(
        build_order_lines(raw), staging.stg_refunds(raw.refunds), tolerance=-100.0
    )


def _spoilt(every: int) -> Column:
    """Every so many-th order by its number, for planting violations by a fixed rule."""
    return F.substring("order_id", 5, 20).cast("long") % every == 0


def _negated_quantities(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every seventh order with their quantity negated break the rule, and no others."""
    lines = staging.stg_order_lines(_raw(spark, folder).order_lines)
    quantity = F.when(_spoilt(7), -F.col("quantity")).otherwise(F.col("quantity"))
    return quality.non_positive_quantities(lines.withColumn("quantity", quantity))


def _early_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Every eleventh order is delivered an hour before it was placed."""
    early = F.col("placed_at") - F.expr("interval 1 hour")
    delivered = F.when(_spoilt(11), early).otherwise(F.col("delivered_at"))
    fulfilment = _order_fulfilment(spark, folder).withColumn("delivered_at", delivered)
    return quality.delivered_before_order(fulfilment)


def _instant_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Every thirteenth order is delivered when it is shipped."""
    delivered = F.when(_spoilt(13), F.col("shipped_at")).otherwise(F.col("delivered_at"))
    fulfilment = _order_fulfilment(spark, folder).withColumn("delivered_at", delivered)
    return quality.delivered_without_transit(fulfilment)


def _allocation_gaps(charge: str) -> Query:
    """Each line of every seventeenth order is given one EUR too much of the charge."""
    column = f"allocated_{charge}_eur"

    def gaps(spark: SparkSession, folder: str) -> DataFrame:
        share = F.when(_spoilt(17), F.col(column) + 1.0).otherwise(F.col(column))
        return quality.allocation_gaps(
            _order_lines(spark, folder).withColumn(column, share), charge
        )

    return gaps


def _refunds_beyond_value(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth order is refunded three times over; the tolerance is the rule's own."""
    raw = _raw(spark, folder)
    amount = F.when(_spoilt(5), F.col("amount_eur") * 3).otherwise(F.col("amount_eur"))
    refunds = staging.stg_refunds(raw.refunds).withColumn("amount_eur", amount)
    return quality.excess_refunds(build_order_lines(raw), refunds)


def _sql_category_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Ad-hoc SQL text on the marts as views."""
    register_views(
        {
            "fct_order_lines": _order_lines(spark, folder),
            "dim_product": _products(spark, folder),
        }
    )
    return spark.sql("""
        select p.category, p.price_band,
               cast(sum(cast(f.net_revenue_eur as decimal(18, 2))) as double) as net_revenue_eur,
               count(distinct f.order_id) as orders
        from fct_order_lines f inner join dim_product p on f.product_id = p.product_id
        group by 1, 2
        order by 3 desc
    """)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly net revenue at the smallest scale."""
    return queries()["revenue_by_month"](spark, "/root/testdata/sf0.001")


def _pipeline_operators():
    """The registry of the training-data operators, or None where that subpackage is left out."""
    try:
        import kontor.llm
    except ModuleNotFoundError as error:
        # Only that subpackage may be missing; a library that it lacks is an error.
        if error.name != "kontor.llm":
            raise
        return None
    import corpus_pipeline
    from kontor.llm import registry

    return registry.with_pipeline(corpus_pipeline)


def queries() -> dict[str, Query]:
    """Every registered query: (spark, folder of Parquet tables) -> DataFrame."""
    operators = _pipeline_operators()
    return {**shop_queries(), **(operators.queries if operators else {})}


def shop_queries() -> dict[str, Query]:
    """The queries on the shop tables."""
    return {
        **{f"stg_{name}": _staged(name) for name in TABLES},
        "raw_customers_reloaded": _reloaded_customers,
        "fx_date_range": _fx_date_range,
        "fx_from_json": _fx_from_json,
        "dim_product": _products,
        "dim_public_holiday_de": _holidays,
        "dim_public_holiday_from_seed": _holidays_from_seed,
        "dim_date": _dim_date,
        "fct_order_lines": _order_lines,
        "fct_order_fulfilment": _order_fulfilment,
        "agg_daily_revenue": _on_lines(agg_daily_revenue),
        "revenue_totals": _on_lines(metrics.revenue_totals),
        "revenue_by_month": _on_lines(metrics.revenue_by_month),
        "revenue_by_currency": _on_lines(metrics.revenue_by_currency),
        "category_revenue": _on_lines_and_products(metrics.category_revenue),
        "category_revenue_by_month": _on_lines_and_products(metrics.category_revenue_by_month),
        "fulfilment_summary": _on_fulfilment(metrics.fulfilment_summary),
        "fulfilment_by_month": _on_fulfilment(metrics.fulfilment_by_month),
        "fulfilment_by_status": _on_fulfilment(metrics.fulfilment_by_status),
        "category_aov": _on_lines_and_products(metrics.category_aov),
        "category_month_pivot": _on_lines_and_products(metrics.category_month_pivot),
        "category_growth": _on_lines_and_products(metrics.category_growth),
        "active_customers": _on_lines(metrics.active_customers),
        "order_count_rollup": _on_lines_and_products(metrics.order_count_rollup),
        "sql_category_revenue": _sql_category_revenue,
        "fct_order_fulfilment_from_extracts": _order_fulfilment_from_extracts,
        "fct_order_lines_incremental": _order_lines_incremental,
        "fct_order_fulfilment_incremental": _order_fulfilment_incremental,
        "fct_order_lines_backfill": _order_lines_backfill,
        "fct_order_fulfilment_backfill": _order_fulfilment_backfill,
        "agg_daily_revenue_incremental": _daily_revenue_incremental,
        "agg_daily_revenue_after_failed_audit": _daily_revenue_after_failed_audit,
        "dim_customer_scd2": _customer_versions,
        "dim_customer_stored": _stored_customer_versions,
        "orders_customer_as_of": _orders_customer_as_of,
        "city_revenue_at_order_time": _city_revenue_at_order_time,
        "dq_report": _quality_report,
        "dq_duplicate_orders": _duplicate_orders,
        "dq_duplicate_order_products": _duplicate_order_products,
        "dq_lines_without_revenue": _lines_without_revenue,
        "dq_orders_without_refund": _orders_without_refund,
        "dq_net_revenue_out_of_range": _net_revenue_out_of_range,
        "dq_line_count_out_of_bounds": _line_count_out_of_bounds,
        "dq_excess_refunds": _excess_refunds,
        "dq_negated_quantities": _negated_quantities,
        "dq_early_deliveries": _early_deliveries,
        "dq_instant_deliveries": _instant_deliveries,
        "dq_shipping_gaps": _allocation_gaps("shipping"),
        "dq_discount_gaps": _allocation_gaps("discount"),
        "dq_refunds_beyond_value": _refunds_beyond_value,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per registered query that SQL can state."""
    operators = _pipeline_operators()
    return {**oracle_queries.all_queries(), **(operators.sql if operators else {})}
