"""What a run opens, when readers see it, and what is cleared away."""

import os
import re
from datetime import date, datetime, timedelta

import pytest
from frames import as_dict, line, order, raw_frame, shop
from pyspark.sql import functions as F
from test_warehouse import PRODUCT, customer

from kontor import session
from kontor.operators.upsert import Range, replaced_values, upsert, upserted, watermark
from kontor.plans import incremental, quality
from kontor.plans.facts import agg_daily_revenue
from kontor.plans.incremental import backfill_order_lines, order_lines_table, refresh_order_lines
from kontor.plans.quality import AuditFailed, Bounds
from kontor.plans.staging import stage
from kontor.plans.warehouse import Warehouse
from kontor.schemas import EXTRACTS, _schema
from kontor.sources import tables
from kontor.sources.extracts import RawLayer, load_extracts, read_raw
from kontor.sources.tables import SlicedTable, sweep

KEYED = _schema("id string, at timestamp_ntz, v bigint")
ANY = Bounds(row_count=(0, 10**9))


def keyed(spark, path, **more):
    return SlicedTable(spark, str(path), KEYED, "at", "month", key="id", tracked=("at",), **more)


def numbered(spark, numbers, month="2024-01"):
    at = F.lit(f"{month}-15").cast("timestamp_ntz")
    return spark.createDataFrame([(n,) for n in numbers], "v bigint").select(
        F.format_string("K%05d", "v").alias("id"), at.alias("at"), "v"
    )


@pytest.fixture
def opened(monkeypatch):
    """The slices of every read of a table, in order, from the files that its plan names."""
    seen, read = [], SlicedTable.read

    def spied(self, slices=None, published=None):
        df = read(self, slices, published)
        seen.append(sorted({re.search(r"slice=([^/]+)", f).group(1) for f in df.inputFiles()}))
        return df

    monkeypatch.setattr(SlicedTable, "read", spied)
    return seen


def spread(spark, path, per_month=300):
    """Five months; every month has keys from the whole range, so that ranges tell nothing."""
    table = keyed(spark, path)
    rows = [numbered(spark, range(m, 5 * per_month, 5), f"2024-0{m + 1}") for m in range(5)]
    table.replace_all(rows[0].union(rows[1]).union(rows[2]).union(rows[3]).union(rows[4]))
    return table


def test_an_upsert_opens_only_slices_that_hold_an_old_key(spark, tmp_path, opened):
    table = spread(spark, tmp_path / "t")
    opened.clear()
    moved = numbered(spark, [7], "2024-06").union(numbered(spark, [99_999], "2024-06"))
    upsert(table, moved, "id")
    assert opened == [["2024-03"], ["2024-03"]]  # its keys, and then the slice to rewrite
    got = as_dict(table.current(), "id", "at")
    assert len(got) == 1501 and got["K00007"] == datetime(2024, 6, 15)


def test_keys_beyond_all_ranges_open_nothing_old(spark, tmp_path, opened):
    table = spread(spark, tmp_path / "t")
    opened.clear()
    upsert(table, numbered(spark, range(20_000, 20_050), "2024-06"), "id")
    assert opened == [[]]
    assert table.current().count() == 1550


def test_a_batch_in_all_ranges_reads_the_keys_at_once(spark, tmp_path, monkeypatch):
    table = spread(spark, tmp_path / "t")
    asked = []
    monkeypatch.setattr(SlicedTable, "_not_cleared", lambda *_: asked.append(1) or [])
    upsert(table, numbered(spark, range(0, 1500, 2), "2024-06"), "id")
    assert not asked and table.current().count() == 1500
    assert table.current().where("at = '2024-06-15'").count() == 750


def test_filters_never_clear_a_slice_that_holds_a_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PAGE_KEYS", 16)
    table = spread(spark, tmp_path / "t")
    state = table.published()
    for key in (0, 6, 777, 1499):
        keys = numbered(spark, [key]).select("id")
        near = table._not_cleared(keys, state.slices)
        assert f"2024-0{key % 5 + 1}" in near
        assert table.holding(keys, state.slices, 1) == [f"2024-0{key % 5 + 1}"]
    none = numbered(spark, [1, 2]).select("id").limit(0)
    assert table.holding(none, state.slices, 0) == []


def test_filters_of_a_run_that_was_partly_written_over(spark, tmp_path):
    table = spread(spark, tmp_path / "t", 50)
    upsert(table, numbered(spark, [0], "2024-02"), "id")  # rewrites January and February
    upsert(table, numbered(spark, [0], "2024-05"), "id")
    assert table.current().where("id = 'K00000'").select("at").first()[0] == datetime(2024, 5, 15)
    assert table.current().count() == 250


def test_null_keys_and_key_text(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    rows = spark.createDataFrame([(None, datetime(2024, 1, 1), 1), ("ä", datetime(2024, 2, 1), 2)], KEYED)
    table.replace_all(rows)
    upsert(table, rows.where("v = 2").withColumn("v", F.lit(3).cast("bigint")), "id")
    assert sorted(r["v"] for r in table.current().collect()) == [1, 3]


def test_the_watermark_of_a_tracked_column_reads_no_data(spark, tmp_path, opened):
    table = spread(spark, tmp_path / "t", 10)
    opened.clear()
    assert watermark(table, "at", 7) == datetime(2024, 5, 8)
    gone = Range("at", "2024-05-01", "2024-05-31", sliced_alike=True)
    table.publish(upserted(table, numbered(spark, []), "id", without=gone).state)
    opened.clear()
    assert watermark(table, "at", 7) == datetime(2024, 4, 8)
    assert opened == []


def test_watermark_keeps_fractions_of_a_second(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    moment = datetime(2024, 1, 5, 6, 7, 8, 123456)
    table.replace_all(spark.createDataFrame([("a", moment, 1)], KEYED))
    assert watermark(table, "at", 0) == moment


# Backfills


BASE = [order("old", "2024-01-01T00:00:00+00:00"), order("new", "2024-03-01T00:00:00+00:00")]
LINES = [line("old-1", "old"), line("new-1", "new", price=10.0)]


def test_a_backfill_that_fails_leaves_the_window(spark, tmp_path, monkeypatch):
    table = order_lines_table(spark, str(tmp_path / "lines"))
    refresh_order_lines(table, shop(spark, BASE, LINES))
    before = table.published().version
    later = shop(spark, BASE, [*LINES, line("old-2", "old")])

    def broken(*_):
        raise OSError("an executor was lost for good")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "order_lines_batch", broken)
        with pytest.raises(OSError):
            backfill_order_lines(table, later, "2024-01-01", "2024-01-31", 100)
    assert table.current().count() == 2 and table.published().version == before
    with monkeypatch.context() as patch:
        patch.setattr(SlicedTable, "write", broken)
        with pytest.raises(OSError):
            backfill_order_lines(table, later, "2024-01-01", "2024-01-31", 100)
    assert as_dict(table.current(), "order_line_id", "order_id") == {"old-1": "old", "new-1": "new"}
    backfill_order_lines(table, later, "2024-01-01", "2024-01-31", 100)
    assert table.current().count() == 3


def test_a_backfill_is_one_publication(spark, tmp_path):
    table = order_lines_table(spark, str(tmp_path / "lines"))
    refresh_order_lines(table, shop(spark, BASE, LINES))
    vanished = shop(spark, BASE[1:], LINES[1:])
    backfill_order_lines(table, vanished, "2024-01-01", "2024-01-31", 100)
    assert table.published().version == 2
    assert as_dict(table.current(), "order_line_id", "order_id") == {"new-1": "new"}


# Raw loads


def extract(spark, *orders):
    return raw_frame(spark, "orders", list(orders)).drop("load_id", "row_id")


def test_a_reader_finishes_on_the_load_it_began_with(spark, tmp_path):
    raw = RawLayer(spark, str(tmp_path))
    raw.load({"orders": extract(spark, order("a"), order("b"))}, "1", "replace")
    began = raw.read("orders")
    raw.load({"orders": extract(spark, order("c"))}, "2", "replace")
    assert sorted(r["order_id"] for r in began.collect()) == ["a", "b"]
    assert [r["order_id"] for r in raw.read("orders").collect()] == ["c"]


def test_a_load_that_fails_changes_nothing(spark, tmp_path):
    inbox, folder = str(tmp_path / "in"), str(tmp_path / "raw")
    for name, df in vars(shop(spark, [order("O1")])).items():
        df.select(*EXTRACTS[name].names).write.parquet(f"{inbox}/{name}.parquet")
    load_extracts(spark, inbox, folder, "1")
    other = dict.fromkeys(EXTRACTS, extract(spark, order("O2")))
    other["refunds"] = extract(spark, order("O2")).withColumn("order_id", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        RawLayer(spark, folder).load(other, "2", "replace")
    assert [r["order_id"] for r in read_raw(spark, folder, "orders").collect()] == ["O1"]
    assert RawLayer(spark, folder).lists.versions() == [1]


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    raw = RawLayer(spark, str(tmp_path))
    raw.load({"orders": extract(spark, order("a"))}, "1", "append")
    start = raw.lists.newest()
    raw.load({"orders": extract(spark, order("b"))}, "2", "append")
    monkeypatch.setattr(type(raw.lists), "newest", lambda _: start)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        raw.load({"orders": extract(spark, order("c"))}, "3", "append")
    monkeypatch.undo()
    assert sorted(r["order_id"] for r in raw.read("orders").collect()) == ["a", "b"]


def test_unlisted_files_are_not_mixed_with_loads(spark, tmp_path):
    raw_frame(spark, "orders", [order("a")]).write.parquet(str(tmp_path / "orders"))
    raw = RawLayer(spark, str(tmp_path))
    with pytest.raises(ValueError, match="unlisted"):
        raw.load({"orders": extract(spark, order("b"))}, "2", "append")
    raw.load({"orders": extract(spark, order("b"))}, "2", "replace")
    assert [r["order_id"] for r in raw.read("orders").collect()] == ["b"]


# Write, audit, publish


def night(spark, *orders, quantity=1, products=(PRODUCT,)):
    lines = [line(f"{o['order_id']}-1", o["order_id"], quantity) for o in orders]
    return shop(spark, list(orders), lines, customers=[customer("Aachen")], products=list(products))


def published(warehouse):
    return {name: sorted(map(str, df.collect())) for name, df in warehouse.marts().items()}


def test_a_violation_in_staging_keeps_yesterdays_marts(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.run(night(spark, order("O1")), datetime(2024, 3, 5), bounds=ANY)
    before = published(warehouse)
    written = os.listdir(tmp_path / "wh" / "marts" / "fct_order_lines" / "data")
    with pytest.raises(AuditFailed, match="positive_quantity") as failure:
        warehouse.run(night(spark, order("O1"), quantity=-1), datetime(2024, 3, 6), bounds=ANY)
    assert failure.value.failed == {"positive_quantity": 1}
    assert published(warehouse) == before and warehouse.lists.versions() == [1]
    # No mart was built on what staging had let down.
    assert os.listdir(tmp_path / "wh" / "marts" / "fct_order_lines" / "data") == written


def test_a_violation_in_the_marts_publishes_none_of_them(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.run(night(spark, order("O1")), datetime(2024, 3, 5), bounds=ANY)
    before = published(warehouse)
    later = order("O2", "2024-03-05T10:00:00+00:00")
    narrow = Bounds(row_count=(0, 1))
    with pytest.raises(AuditFailed, match="row_count:fct_order_lines") as failure:
        warehouse.run(night(spark, order("O1"), later), datetime(2024, 3, 6), bounds=narrow)
    assert failure.value.failed == {"row_count:fct_order_lines": 1}
    assert published(warehouse) == before
    warehouse.run(night(spark, order("O1"), later), datetime(2024, 3, 6), bounds=ANY)
    assert warehouse.marts()["fct_order_lines"].count() == 2


def test_all_marts_become_visible_in_one_list(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.run(night(spark, order("O1")), datetime(2024, 3, 5), bounds=ANY)
    assert warehouse.lists.versions() == [1]
    seen = warehouse.marts()
    warehouse.run(
        night(spark, order("O1"), order("O2", "2024-03-05T10:00:00+00:00")),
        datetime(2024, 3, 6), bounds=ANY,
    )
    assert warehouse.lists.versions() == [2, 1]
    assert seen["fct_order_lines"].count() == 1  # a reader stays with its list
    assert warehouse.marts()["agg_daily_revenue"].count() == 2


def test_the_parts_of_the_suite_make_the_whole(spark):
    raw = night(spark, order("O1"))
    staged = {f"stg_{n}": df for n, df in vars(stage(raw)).items()}
    checks = {r["check_name"] for r in quality.quality_report(staged, ANY).collect()}
    assert len(checks) == 7 + 12 + 5 + 1  # unique, not null, relationships, quantities
    assert not any("dim_" in c or "fct_" in c for c in checks)


# The roll-up


def test_only_touched_days_are_added_up_again(spark, tmp_path, monkeypatch):
    from kontor.plans import warehouse as module

    added = []
    plain = module.agg_daily_revenue
    monkeypatch.setattr(
        module, "agg_daily_revenue",
        lambda df: added.append(sorted(r[0] for r in df.select("order_date").distinct().collect()))
        or plain(df),
    )
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    first = [order("a", "2024-01-01T00:00:00+00:00"), order("b", "2024-03-01T00:00:00+00:00"),
             order("c", "2024-03-02T00:00:00+00:00")]
    warehouse.run(night(spark, *first), datetime(2024, 3, 5), bounds=None)
    # b moves to another day, so its old day empties; d is new.
    moved = [first[0], order("b", "2024-03-03T00:00:00+00:00"), first[2],
             order("d", "2024-03-03T01:00:00+00:00")]
    warehouse.run(night(spark, *moved), datetime(2024, 3, 6), bounds=None)
    assert added[1:] == [[date(2024, 3, 2), date(2024, 3, 3)]]
    marts = warehouse.marts()
    got = as_dict(marts["agg_daily_revenue"], "order_date", "order_count")
    assert got == {date(2024, 1, 1): 1, date(2024, 3, 2): 1, date(2024, 3, 3): 2}
    full = agg_daily_revenue(marts["fct_order_lines"])
    assert marts["agg_daily_revenue"].exceptAll(full).isEmpty()


def test_values_are_replaced_in_their_slices_only(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    rows = [("a", datetime(2024, 1, 5), 1), ("b", datetime(2024, 1, 6), 1), ("c", datetime(2024, 2, 5), 1),
            ("n", None, 1)]
    table.replace_all(spark.createDataFrame(rows, KEYED))
    before = table.published()
    new = spark.createDataFrame([("z", datetime(2024, 1, 5), 2)], KEYED)
    state = replaced_values(table, new, "at", [datetime(2024, 1, 5), None], before)
    assert as_dict(table.current(state), "id", "v") == {"b": 1, "c": 1, "z": 2}
    assert state.runs["2024-02"] == before.runs["2024-02"]
    nothing = replaced_values(table, new.limit(0), "at", [], before)
    assert as_dict(table.current(nothing), "id", "v") == {"a": 1, "b": 1, "c": 1, "n": 1}


# Clearing away


def age(folder, days=5):
    """Make everything directly below a folder look old."""
    then = (datetime.now() - timedelta(days=days)).timestamp()
    for name in os.listdir(folder):
        os.utime(folder / name, (then, then))


def test_sweeping_spares_readers_of_the_last_lists(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    for value in range(4):
        table.replace_all(numbered(spark, [value]))
    last = table.current()
    before = table.read(None, table.published(table.lists.read(3)))
    assert sweep(table.lists, [table]) == []  # all of it is young
    for part in ("data", "keys", "published"):
        age(tmp_path / "t" / part)
    gone = sweep(table.lists, [table], keep=2)
    assert len(gone) == 6 and table.lists.versions() == [4, 3]
    assert [r["v"] for r in last.collect()] == [3] and [r["v"] for r in before.collect()] == [2]
    upsert(table, numbered(spark, [9], "2024-02"), "id")
    assert as_dict(table.current(), "v", "id") == {3: "K00003", 9: "K00009"}
    with pytest.raises(ValueError):
        sweep(table.lists, [table], keep=0)


def test_an_unfinished_list_is_passed_over(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    table.replace_all(numbered(spark, [1]))
    (tmp_path / "t" / "published" / "version=2").mkdir()
    assert table.published().version == 1 and table.current().count() == 1


def test_warehouse_raw_and_scratch_are_swept(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for day in (5, 6, 7):
        warehouse.run(night(spark, order("O1")), datetime(2024, 3, day), bounds=None)
    assert warehouse.sweep() == []
    for folder in (tmp_path / "wh").glob("**/data"):
        age(folder)
    age(tmp_path / "wh" / "published")
    gone = warehouse.sweep(keep=1)
    assert gone and warehouse.lists.versions() == [3]
    assert {n: df.count() for n, df in warehouse.marts().items()}["fct_order_lines"] == 1
    raw = RawLayer(spark, str(tmp_path / "raw"))
    for load in ("1", "2", "3"):
        raw.load({"orders": extract(spark, order(load))}, load, "replace")
    age(tmp_path / "raw" / "loads")
    assert len(raw.sweep(keep=2)) == 1 and raw.read("orders").count() == 1
    kept = session.materialise(numbered(spark, [1]), "young")
    assert not any("young" in name for name in session.sweep_scratch(spark))
    assert kept.count() == 1
