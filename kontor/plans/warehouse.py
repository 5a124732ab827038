"""A whole run: raw to staging, history, dimensions, facts and roll-up."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.operators.scd2 import first_snapshot, later_than_open, snapshot
from kontor.operators.upsert import LOOKBACK_DAYS, Change, replaced_values
from kontor.plans.calendar import (
    calendar_years,
    date_spine,
    dim_date,
    dim_public_holiday_de,
    holiday_seed,
)
from kontor.plans.dimensions import dim_customer, dim_product
from kontor.plans.facts import agg_daily_revenue
from kontor.plans.incremental import (
    order_fulfilment_table,
    order_lines_table,
    prepare_order_fulfilment,
    prepare_order_lines,
)
from kontor.plans.quality import Bounds, audit
from kontor.plans.staging import Staging, stage, stg_customers, stg_products
from kontor.schemas import (
    AGG_DAILY_REVENUE,
    CUSTOMER_HISTORY,
    DIM_DATE,
    DIM_PRODUCT,
    DIM_PUBLIC_HOLIDAY_DE,
)
from kontor.session import materialise, side_by_side
from kontor.sources.lists import Listing, PublishedLists
from kontor.sources.tables import SLICE, UNDATED, Published, SlicedTable, sweep

CHECK_COLUMNS = ["address_line", "city", "postal_code", "tier"]
# Marts that every run builds anew.
REBUILT = {
    "dim_product": DIM_PRODUCT,
    "dim_public_holiday_de": DIM_PUBLIC_HOLIDAY_DE,
    "dim_date": DIM_DATE,
}


def customer_history_table(spark: SparkSession, path: str, **lists) -> SlicedTable:
    """Customer versions, sliced by the month they ended; open ones share one slice."""
    return SlicedTable(spark, path, CUSTOMER_HISTORY, "valid_to", **lists)


def prepare_customer_history(
    table: SlicedTable, customers: DataFrame, run_time: datetime, published: Published | None
) -> Published:
    """The history after one snapshot, unpublished.

    Versions that ended in earlier months are neither read nor rewritten.
    """
    if published is None:
        return table.rebuilt(first_snapshot(customers, run_time), None)
    affected = [UNDATED, run_time.strftime("%Y-%m")]
    history = table.read(affected, published).drop(SLICE)
    rows = snapshot(history, customers, "customer_id", CHECK_COLUMNS, run_time)
    if not later_than_open(history, run_time):
        # The same run again changes nothing and is let through.
        rows = materialise(rows, "history")
        if not rows.exceptAll(history).isEmpty():
            raise ValueError(f"the history already holds versions from {run_time} or later")
        return published
    return table.write(table.with_slice(rows), affected, published)


def refresh_customer_history(table: SlicedTable, customers: DataFrame, run_time: datetime) -> None:
    """Take one snapshot, and publish it if it is a new one."""
    published = table.published()
    after = prepare_customer_history(table, customers, run_time, published)
    if after is not published:
        table.publish(after)


def daily_revenue_table(spark: SparkSession, path: str, **lists) -> SlicedTable:
    """The daily roll-up, sliced by month."""
    return SlicedTable(spark, path, AGG_DAILY_REVENUE, "order_date", **lists)


def prepare_daily_revenue(
    table: SlicedTable, lines: SlicedTable, change: Change, published: Published | None
) -> Published:
    """The roll-up after a change of the lines, unpublished.

    Only the days on which a line came, went or changed are added up again, from the slices of the lines
    that the change rewrote; a day that lost all its lines goes. A table that was never built takes
    all days, and so does one whose lines were built anew.
    """
    if published is None or change.rebuilt:
        return table.rebuilt(agg_daily_revenue(lines.current(change.state)), published)
    days = [day for day in change.watched if day is not None]
    touched = lines.read(change.slices, change.state).drop(SLICE)
    on_days = F.coalesce(F.col("order_date").isin(days), F.lit(False))
    if None in change.watched:
        on_days = on_days | F.col("order_date").isNull()
    rows = agg_daily_revenue(touched.where(on_days))
    return replaced_values(table, rows, "order_date", change.watched, published)


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder, published together in one list."""

    spark: SparkSession
    root: str
    grain: str = "month"

    @property
    def lists(self) -> PublishedLists:
        return PublishedLists(self.spark, f"{self.root}/published")

    @property
    def customer_history(self) -> SlicedTable:
        path = f"{self.root}/snapshots/customer_history"
        return customer_history_table(self.spark, path, **self._listed("customer_history"))

    @property
    def order_lines(self) -> SlicedTable:
        path = f"{self.root}/marts/fct_order_lines"
        return order_lines_table(self.spark, path, self.grain, **self._listed("fct_order_lines"))

    @property
    def order_fulfilment(self) -> SlicedTable:
        path = f"{self.root}/marts/fct_order_fulfilment"
        return order_fulfilment_table(
            self.spark, path, self.grain, **self._listed("fct_order_fulfilment")
        )

    @property
    def daily_revenue(self) -> SlicedTable:
        return daily_revenue_table(
            self.spark, f"{self.root}/marts/agg_daily_revenue", **self._listed("agg_daily_revenue")
        )

    def run(
        self,
        raw,
        run_time: datetime,
        lookback_days: int = LOOKBACK_DAYS,
        full_refresh: bool = False,
        bounds: Bounds | None = Bounds(),
    ) -> None:
        """One nightly run over the raw layer. The history is never rebuilt, only added to.

        Write, audit, publish: staging is written and checked, full builds take those files, marts are
        written unlisted and checked, and then one list makes all of them visible. A check that finds
        violations raises ``AuditFailed`` with its name, and what was published before stays. Without
        ``bounds`` nothing is checked, and marts take what they need from the raw layer.
        """
        listing = self.lists.newest()
        staged = self._audited_staging(raw, bounds) if bounds else None
        states = self._written(raw, listing, run_time, lookback_days, full_refresh, staged)
        if bounds:
            marts = self._marts(Listing(listing.version, _slices(states)))
            refunds = {"stg_refunds": staged.refunds}
            audit(marts | refunds, bounds, of=set(marts))
        self.lists.publish(listing, _slices(states))

    def _audited_staging(self, raw, bounds: Bounds) -> Staging:
        staged = materialise_staging(raw)
        audit({f"stg_{name}": df for name, df in vars(staged).items()}, bounds)
        return staged

    def _written(
        self,
        raw,
        listing: Listing,
        run_time: datetime,
        lookback_days: int,
        full_refresh: bool,
        staged: Staging | None,
    ) -> dict[str, Published]:
        """The next state of every table, written and not published."""

        def known(table: SlicedTable) -> Published | None:
            return table.published(listing)

        def rebuilt(name: str, rows: DataFrame) -> dict[str, Published]:
            table = self._rebuilt(name)
            return {name: table.rebuilt(rows, known(table))}

        def calendar() -> dict[str, Published]:
            years = calendar_years(self.spark)
            holidays = dim_public_holiday_de(holiday_seed(years))
            days = dim_date(date_spine(years), holidays)
            return rebuilt("dim_public_holiday_de", holidays) | rebuilt("dim_date", days)

        def revenue() -> dict[str, Published]:
            lines, daily = self.order_lines, self.daily_revenue
            change = prepare_order_lines(
                lines, raw, lookback_days, full_refresh, known(lines), "order_date", staged
            )
            after = prepare_daily_revenue(daily, lines, change, known(daily))
            return {lines.name: change.state, daily.name: after}

        def fulfilment() -> dict[str, Published]:
            table = self.order_fulfilment
            change = prepare_order_fulfilment(
                table, raw, lookback_days, full_refresh, known(table), staged
            )
            return {table.name: change.state}

        def history() -> dict[str, Published]:
            table = self.customer_history
            customers = staged.customers if staged else stg_customers(raw.customers)
            after = prepare_customer_history(table, customers, run_time, known(table))
            return {table.name: after}

        def products() -> dict[str, Published]:
            rows = staged.products if staged else stg_products(raw.products)
            return rebuilt("dim_product", dim_product(rows))

        written = side_by_side(revenue, fulfilment, history, products, calendar)
        return {name: state for part in written for name, state in part.items()}

    def marts(self) -> dict[str, DataFrame]:
        """The tables by name, all of one published list, which they stay with."""
        return self._marts(self.lists.newest())

    def _marts(self, listing: Listing) -> dict[str, DataFrame]:
        facts = (self.order_lines, self.order_fulfilment, self.daily_revenue)
        tables = [*(self._rebuilt(name) for name in REBUILT), *facts]
        read = lambda t: t.current(t.published(listing) or Published(listing, {}))
        return {
            **{table.name: read(table) for table in tables},
            "dim_customer": dim_customer(read(self.customer_history)),
        }

    def register_views(self) -> None:
        """Make the marts known to ``spark.sql`` by name."""
        register_views(self.marts())

    def sweep(self, keep: int = 2, age: timedelta = timedelta(days=2)) -> list[str]:
        """Remove runs that none of the newest ``keep`` lists names, and older lists, of this age."""
        tables = [self._rebuilt(name) for name in REBUILT]
        tables += [self.order_lines, self.order_fulfilment, self.daily_revenue]
        return sweep(self.lists, [*tables, self.customer_history], keep, age)

    def _listed(self, name: str) -> dict:
        return {"shared": self.lists, "name": name}

    def _rebuilt(self, name: str) -> SlicedTable:
        path = f"{self.root}/marts/{name}"
        return SlicedTable(self.spark, path, REBUILT[name], **self._listed(name))


def _slices(states: dict[str, Published]) -> dict[str, dict]:
    return {name: state.slices for name, state in states.items()}


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def materialise_staging(raw) -> Staging:
    """Write the seven staging tables once, for runs in which many plans read them."""
    staged = stage(raw)
    names = [f.name for f in fields(Staging)]
    writes = [partial(materialise, getattr(staged, name), f"stg-{name}") for name in names]
    return Staging(**dict(zip(names, side_by_side(*writes), strict=True)))
