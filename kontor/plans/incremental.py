"""Incremental runs of the two facts: lookback, late data, backfill."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.functions import iso_lower_bound, timestamp_literal, utc_naive
from kontor.operators.dedupe import keep_latest_among
from kontor.operators.upsert import LOOKBACK_DAYS, Change, Range, upserted, watermark
from kontor.plans.facts import fct_order_fulfilment, fct_order_lines
from kontor.plans.staging import (
    Staging,
    stg_fx_rates,
    stg_order_lines,
    stg_orders,
    stg_refunds,
    stg_shipments,
    typed_order_lines,
    typed_orders,
    typed_refunds,
    typed_shipments,
)
from kontor.schemas import FCT_ORDER_FULFILMENT, FCT_ORDER_LINES
from kontor.session import materialise
from kontor.sources.tables import Published, SlicedTable

#: Per slicing column, the columns whose windows lie in its own slices: itself and its date.
SLICED_ALIKE = {"order_date_utc": {"order_date_utc", "order_date"}, "placed_at": {"placed_at"}}
#: From more than this part of all orders on (a quarter), a batch does not list its keys first.
MANY_OF_ALL = 4


def order_lines_table(spark, path: str, grain: str = "month", **lists) -> SlicedTable:
    return SlicedTable(
        spark, path, FCT_ORDER_LINES, "order_date_utc", grain,
        key="order_line_id", tracked=("order_date_utc",), **lists,
    )


def order_fulfilment_table(spark, path: str, grain: str = "month", **lists) -> SlicedTable:
    return SlicedTable(
        spark, path, FCT_ORDER_FULFILMENT, "placed_at", grain,
        key="order_id", tracked=("last_recorded_at",), **lists,
    )


def _recorded_since(raw: DataFrame, text_column: str, since: datetime) -> DataFrame:
    """Raw rows of any load whose time lies after ``since``; the text bound reaches the scan."""
    text = F.col(text_column)
    return raw.where(
        iso_lower_bound(text, since) & (utc_naive(text) > timestamp_literal(since))
    )


def order_lines_batch(raw, since: datetime) -> DataFrame:
    """Fact rows of the orders placed after ``since``, with all lines of each such order.

    The same rows as building the whole fact and filtering it, without deduplicating the whole raw
    layer: a latest version can only qualify if some version of its key does, so all versions of
    just those keys are looked at. Where they are much of the layer, listing them costs more than it
    spares, and all keys are deduplicated.
    """
    after = F.col("order_date_utc") > timestamp_literal(since)
    recorded = _recorded_since(raw.orders, "order_date", since)
    if recorded.count() * MANY_OF_ALL > raw.orders.count():
        orders = materialise(stg_orders(raw.orders).where(after), "recent-orders")
        # The fact's join with the orders picks their lines.
        lines = stg_order_lines(raw.order_lines)
    else:
        recent = keep_latest_among(typed_orders(raw.orders), "order_id", recorded)
        orders = materialise(recent.where(after).drop("load_id", "row_id"), "recent-orders")
        of_recent = raw.order_lines.join(orders.select("order_id"), "order_id", "left_semi")
        lines = keep_latest_among(
            typed_order_lines(raw.order_lines), "order_line_id", of_recent
        ).drop("load_id", "row_id")
    lines = materialise(lines, "recent-lines")
    return fct_order_lines(lines, orders, stg_fx_rates(raw.fx_rates))


def order_fulfilment_batch(raw, since: datetime) -> DataFrame:
    """Fact rows of the orders for which anything was recorded after ``since``."""
    touched = (
        _recorded_since(raw.orders, "order_date", since)
        .select("order_id")
        .union(_recorded_since(raw.shipments, "recorded_at", since).select("order_id"))
        .union(_recorded_since(raw.refunds, "recorded_at", since).select("order_id"))
    )
    orders = materialise(
        keep_latest_among(typed_orders(raw.orders), "order_id", touched).drop("load_id", "row_id"),
        "touched-orders",
    )
    ids = orders.select("order_id")
    shipments = keep_latest_among(
        typed_shipments(raw.shipments),
        "shipment_id",
        raw.shipments.join(ids, "order_id", "left_semi"),
    )
    refunds = keep_latest_among(
        typed_refunds(raw.refunds), "refund_id", raw.refunds.join(ids, "order_id", "left_semi")
    )
    return fct_order_fulfilment(orders, shipments, refunds).where(
        F.col("last_recorded_at") > timestamp_literal(since)
    )


def build_order_lines(raw, staged: Staging | None = None) -> DataFrame:
    """The whole fact from the raw layer, or from what a run has ``staged`` of it.

    The fact reads its lines twice, for the orders' totals and for themselves. They are deduplicated
    once and written; both reads are scans of that.
    """
    if staged:
        return fct_order_lines(staged.order_lines, staged.orders, staged.fx_rates)
    lines = materialise(stg_order_lines(raw.order_lines), "staged-lines")
    return fct_order_lines(lines, stg_orders(raw.orders), stg_fx_rates(raw.fx_rates))


def build_order_fulfilment(raw, staged: Staging | None = None) -> DataFrame:
    if staged:
        return fct_order_fulfilment(staged.orders, staged.shipments, staged.refunds)
    return fct_order_fulfilment(
        stg_orders(raw.orders), stg_shipments(raw.shipments), stg_refunds(raw.refunds)
    )


def _prepared(
    table: SlicedTable,
    published: Published | None,
    since: datetime | None,
    build: Callable[[], DataFrame],
    batch: Callable[[datetime], DataFrame],
    watch: str | None,
) -> Change:
    """A full build when there is no table yet or a full refresh is asked, else lookback + upsert."""
    if since is None:
        state = table.rebuilt(build(), published)
        return Change(state, tuple(sorted(state.slices)), rebuilt=True)
    return upserted(table, batch(since), table.key, published, watch=watch)


def prepare_order_lines(
    table: SlicedTable,
    raw,
    lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
    published: Published | None = None,
    watch: str | None = None,
    staged: Staging | None = None,
) -> Change:
    """The next state of the lines, written and not published; see ``upserted`` for ``watch``.

    ``staged`` are the seven staging tables of this raw layer as written files, where the run has them: a
    full build takes them as they are.
    """
    published = published or table.published()
    since = None
    if published and not full_refresh:
        since = watermark(table, "order_date_utc", lookback_days, published)
    return _prepared(
        table, published, since, lambda: build_order_lines(raw, staged),
        lambda after: order_lines_batch(raw, after), watch,
    )


def prepare_order_fulfilment(
    table: SlicedTable,
    raw,
    lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
    published: Published | None = None,
    staged: Staging | None = None,
) -> Change:
    published = published or table.published()
    since = None
    if published and not full_refresh:
        since = watermark(table, "last_recorded_at", lookback_days, published)
    return _prepared(
        table, published, since, lambda: build_order_fulfilment(raw, staged),
        lambda after: order_fulfilment_batch(raw, after), None,
    )


def refresh_order_lines(
    table: SlicedTable, raw, lookback_days: int = LOOKBACK_DAYS, full_refresh: bool = False
) -> None:
    """``prepare_order_lines``, published."""
    table.publish(prepare_order_lines(table, raw, lookback_days, full_refresh).state)


def refresh_order_fulfilment(
    table: SlicedTable, raw, lookback_days: int = LOOKBACK_DAYS, full_refresh: bool = False
) -> None:
    table.publish(prepare_order_fulfilment(table, raw, lookback_days, full_refresh).state)


def _backfill(
    table: SlicedTable,
    window: tuple[str, str, str],
    lookback_days: int,
    newest: str,
    batch: Callable[[datetime], DataFrame],
) -> None:
    """Delete a date window and reprocess it; refused while the lookback does not reach its start.

    The window's rows go and the reprocessed ones come in one published step: readers see the window
    as it was or as it is then, and a run that fails in between leaves it as it was.
    """
    column, start, end = window
    published = table.published()
    since = watermark(table, newest, lookback_days, published)
    if since is None:
        raise ValueError("there is no table to backfill")
    if since >= datetime.fromisoformat(start):
        raise ValueError(
            f"a lookback of {lookback_days} days begins at {since} and does not reach {start}: "
            "the deleted window would stay empty"
        )
    gone = Range(column, start, end, column in SLICED_ALIKE.get(table.slice_by, ()))
    table.publish(upserted(table, batch(since), table.key, published, without=gone).state)


def backfill_order_lines(
    table: SlicedTable, raw, start: str, end: str, lookback_days: int, column: str = "order_date"
) -> None:
    """Reprocess the lines of a window of order dates."""
    _backfill(
        table, (column, start, end), lookback_days, "order_date_utc",
        lambda since: order_lines_batch(raw, since),
    )


def backfill_order_fulfilment(
    table: SlicedTable, raw, start: str, end: str, lookback_days: int, column: str = "placed_at"
) -> None:
    """Reprocess the orders placed in a window. What concerns them was recorded after its start.

    With another ``column``, such as ``refunded_at``, the window is looked for in all slices.
    """
    _backfill(
        table, (column, start, end), lookback_days, "last_recorded_at",
        lambda since: order_fulfilment_batch(raw, since),
    )
