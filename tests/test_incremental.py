from datetime import datetime

import pytest
from frames import as_dict, line, order, shop
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kontor.operators.upsert import delete_between, upsert, watermark
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
from kontor.schemas import _schema
from kontor.sources.tables import SlicedTable

PLAIN = _schema("id string, at timestamp_ntz, v bigint")


@pytest.fixture(params=["month", "day"])
def table(request, spark, tmp_path):
    return SlicedTable(spark, str(tmp_path / "t"), PLAIN, "at", request.param)


def rows(spark, *values):
    parsed = [(i, datetime.fromisoformat(t) if t else None, v) for i, t, v in values]
    return spark.createDataFrame(parsed, PLAIN)


def content(table):
    return as_dict(table.current(), "id", "v")


def test_first_read_and_full_rebuild(spark, table):
    assert table.published() is None
    assert content(table) == {}
    assert watermark(table, "at") is None
    table.replace_all(rows(spark, ("a", "2024-01-05", 1), ("b", None, 2)))
    assert content(table) == {"a": 1, "b": 2}
    table.replace_all(rows(spark, ("c", "2024-02-05", 3)))
    assert content(table) == {"c": 3}


def test_upsert_replaces_inserts_and_keeps(spark, table):
    table.replace_all(
        rows(spark, ("old", "2023-01-01", 1), ("same", "2024-01-05", 1), ("gone", "2024-01-06", 1))
    )
    untouched = dict(table.published().runs)
    batch = rows(spark, ("same", "2024-01-05", 2), ("new", "2024-02-01", 2))
    for _ in range(2):
        upsert(table, batch, "id")
        assert content(table) == {"old": 1, "same": 2, "gone": 1, "new": 2}
    first = min(untouched)
    assert table.published().runs[first] == untouched[first]


def test_key_that_moves_to_another_slice(spark, table):
    table.replace_all(rows(spark, ("a", "2024-01-05", 1), ("b", None, 1)))
    upsert(table, rows(spark, ("a", "2024-03-05", 2), ("b", "2024-03-06", 2)), "id")
    assert content(table) == {"a": 2, "b": 2}
    assert all(s.startswith("2024-03") for s in table.published().runs)


def test_empty_batch_changes_nothing(spark, table):
    table.replace_all(rows(spark, ("a", "2024-01-05", 1)))
    upsert(table, rows(spark).limit(0), "id")
    assert content(table) == {"a": 1}


def test_delete_takes_the_end_as_midnight_and_spares_null(spark, table):
    table.replace_all(
        rows(
            spark,
            ("first", "2024-01-01", 1),
            ("noon", "2024-01-31T12:00", 1),
            ("undated", None, 1),
            ("before", "2023-12-31", 1),
        )
    )
    delete_between(table, "at", "2024-01-01", "2024-01-31")
    assert content(table) == {"noon": 1, "undated": 1, "before": 1}


def test_emptied_table_is_not_a_first_run(spark, table):
    table.replace_all(rows(spark, ("a", "2024-01-05", 1)))
    delete_between(table, "at", "2024-01-01", "2024-01-31")
    assert table.published().runs == {} and content(table) == {}
    assert watermark(table, "at", 7) == datetime(1899, 12, 25)
    upsert(table, rows(spark, ("b", "2024-01-05", 1)), "id")
    assert content(table) == {"b": 1}


def test_watermark(spark, table):
    table.replace_all(rows(spark, ("a", "2024-01-05T06:00", 1), ("b", "2023-01-01", 1)))
    assert watermark(table, "at", 7) == datetime(2023, 12, 29, 6)


def test_unpublished_files_are_invisible(spark, table):
    """A run that dies between its files and its list leaves the table as it was."""
    table.replace_all(rows(spark, ("a", "2024-01-05", 1)))
    half = table.with_slice(rows(spark, ("x", "2024-01-05", 9)))
    half.write.partitionBy("slice").parquet(f"{table.path}/data/run=2")
    assert content(table) == {"a": 1}
    upsert(table, rows(spark, ("b", "2024-01-06", 2)), "id")
    assert content(table) == {"a": 1, "b": 2}


def test_second_of_two_concurrent_writers_fails(spark, table):
    table.replace_all(rows(spark, ("a", "2024-01-05", 1)))
    start = table.published()
    late = table.with_slice(rows(spark, ("x", "2024-01-05", 9)))
    upsert(table, rows(spark, ("b", "2024-01-06", 2)), "id")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        table.replace(late, ["2024-01", "2024-01-05"], start)
    assert content(table) == {"a": 1, "b": 2}


def test_table_without_slices(spark, tmp_path):
    table = SlicedTable(spark, str(tmp_path / "t"), PLAIN)
    for value in (1, 2):
        table.replace_all(rows(spark, ("a", "2024-01-05", value), ("b", None, value)))
        assert content(table) == {"a": value, "b": value}
    assert list(table.published().runs) == ["all"]


BASE = [order("old", "2024-01-01T00:00:00+00:00"), order("new", "2024-03-01T00:00:00+00:00")]
LINES = [line("old-1", "old"), line("new-1", "new", price=10.0)]


@pytest.fixture
def lines_table(spark, tmp_path):
    return order_lines_table(spark, str(tmp_path / "lines"))


def test_late_lines_inside_and_outside_the_lookback(spark, lines_table):
    refresh_order_lines(lines_table, shop(spark, BASE, LINES))
    late = [*LINES, line("old-2", "old"), line("new-2", "new", price=30.0)]
    more = shop(
        spark,
        [{**o, "discount_amount_local": 4.0} for o in BASE]
        + [order("next", "2024-03-02T00:00:00+00:00")],
        [*late, line("next-1", "next")],
    )
    refresh_order_lines(lines_table, more)
    expected = {"old-1": 0.0, "new-1": 1.0, "new-2": 3.0, "next-1": 0.0}
    got = as_dict(lines_table.current(), "order_line_id", "allocated_discount_eur")
    assert got == expected
    backfill_order_lines(lines_table, more, "2024-01-01", "2024-01-31", lookback_days=100)
    got = as_dict(lines_table.current(), "order_line_id", "allocated_discount_eur")
    assert got == expected | {"old-1": 2.0, "old-2": 2.0}


def test_rows_that_vanish_upstream_stay(spark, lines_table):
    refresh_order_lines(lines_table, shop(spark, BASE, LINES))
    refresh_order_lines(lines_table, shop(spark, BASE[:1], LINES[:1]))
    assert lines_table.current().count() == 2


def test_latest_version_decides_although_an_older_one_is_recent(spark, lines_table):
    """A line that moved to an old order must not come back through its older version."""
    refresh_order_lines(lines_table, shop(spark, BASE, LINES))
    moved = shop(spark, BASE, [*LINES, line("new-1", "old", load_id="2", row_id="x")])
    refresh_order_lines(lines_table, moved)
    assert as_dict(lines_table.current(), "order_line_id", "order_id")["new-1"] == "new"
    refresh_order_lines(lines_table, moved, full_refresh=True)
    assert as_dict(lines_table.current(), "order_line_id", "order_id")["new-1"] == "old"


def test_full_refresh(spark, lines_table):
    refresh_order_lines(lines_table, shop(spark, BASE, LINES))
    refresh_order_lines(lines_table, shop(spark, BASE[:1], LINES[:1]), full_refresh=True)
    assert lines_table.current().count() == 1


def shipped(at, recorded):
    return {
        "shipment_id": f"s-{at}", "order_id": "old", "status": "shipped",
        "occurred_at": f"{at}T00:00:00+00:00", "recorded_at": f"{recorded}T00:00:00+00:00",
    }


def test_late_event_reopens_an_old_order(spark, tmp_path):
    table = order_fulfilment_table(spark, str(tmp_path / "f"))
    refresh_order_fulfilment(table, shop(spark, BASE))
    refresh_order_fulfilment(
        table, shop(spark, BASE, shipments=[shipped("2024-01-02", "2024-02-28")])
    )
    got = as_dict(table.current(), "order_id", "shipped_at")
    assert got == {"old": datetime(2024, 1, 2), "new": None}


def test_event_recorded_before_the_lookback_is_missed(spark, tmp_path):
    table = order_fulfilment_table(spark, str(tmp_path / "f"))
    refresh_order_fulfilment(table, shop(spark, BASE))
    late = shop(spark, BASE, shipments=[shipped("2024-01-02", "2024-02-01")])
    refresh_order_fulfilment(table, late)
    assert as_dict(table.current(), "order_id", "shipped_at")["old"] is None
    refresh_order_fulfilment(table, late, lookback_days=60)
    assert as_dict(table.current(), "order_id", "shipped_at")["old"] == datetime(2024, 1, 2)


def test_backfill_by_another_date_looks_at_all_slices(spark, tmp_path):
    """Shipped in February, sliced by January: gone upstream, so the window's row goes too."""
    table = order_fulfilment_table(spark, str(tmp_path / "f"))
    refresh_order_fulfilment(
        table, shop(spark, BASE, shipments=[shipped("2024-02-10", "2024-02-10")])
    )
    backfill_order_fulfilment(
        table, shop(spark, BASE[1:]), "2024-02-01", "2024-02-28", 100, column="shipped_at"
    )
    assert as_dict(table.current(), "order_id", "shipped_at") == {"new": None}


def test_incremental_equals_full_when_nothing_is_late(spark, tmp_path, folder):
    from __spark_entry__ import _loaded
    from kontor.functions import timestamp_literal, utc_naive

    raw = _loaded(spark, folder, "orders", "order_lines", "fx_rates", "shipments", "refunds")
    known = utc_naive(F.col("order_date")) < timestamp_literal("2001-01-01")
    before = shop(spark)
    before.__dict__.update({**vars(raw), "orders": raw.orders.where(known)})
    lines = order_lines_table(spark, str(tmp_path / "l"), grain="month")
    orders = order_fulfilment_table(spark, str(tmp_path / "o"), grain="month")
    for layer in (before, raw):
        refresh_order_lines(lines, layer)
        refresh_order_fulfilment(orders, layer)
    for table, full in ((lines, build_order_lines(raw)), (orders, build_order_fulfilment(raw))):
        assert table.current().exceptAll(full).isEmpty()
        assert table.current().count() == full.count()
