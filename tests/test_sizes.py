"""What only larger tables show: orders of many lines, long lists of keys, work done twice."""

from threading import Barrier
from unittest.mock import Mock

import pytest
from frames import as_dict, line, order, shop
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kontor.operators import dedupe
from kontor.plans import metrics, quality
from kontor.plans.incremental import build_order_lines
from kontor.session import materialise
from kontor.sources.extracts import RawLayer


def outcome(report):
    return as_dict(report, "check_name", "violations")


@pytest.mark.parametrize("lines", [7, 40])
def test_rounding_of_many_lines_is_no_violation_at_any_size(spark, lines):
    # Seven equal lines share 5.01 as 0.72 each, which is 5.04; forty as 0.13, which is 5.20.
    charge = 5.01
    raw = shop(
        spark,
        [order("a", shipping_amount_local=charge), order("b", shipping_amount_local=charge)],
        [line(f"{o}{n}", o) for o in "ab" for n in range(lines)],
    )
    built = build_order_lines(raw)
    any_size = outcome(quality.quality_report({"fct_order_lines": built}, entry.ANY_SIZE))
    fixed = outcome(quality.quality_report({"fct_order_lines": built}))
    assert (any_size["shipping_allocation"], fixed["shipping_allocation"]) == (0, 2)
    share = F.when(F.col("order_line_id") == "a0", F.col("allocated_shipping_eur") + 1.0)
    off = built.withColumn(
        "allocated_shipping_eur", F.coalesce(share, F.col("allocated_shipping_eur"))
    )
    found = outcome(quality.quality_report({"fct_order_lines": off}, entry.ANY_SIZE))
    assert found["shipping_allocation"] == 1


def test_long_lists_of_keys_meet_deduplicated_rows(spark, monkeypatch):
    rows = [("a", "1", "x", 1), ("a", "2", "w", 2), ("b", "1", "x", 3), ("b", "1", None, 4), (None, "1", "x", 5)]
    df = spark.createDataFrame(rows, "k string, load_id string, row_id string, v int")
    monkeypatch.setattr(dedupe, "MANY_KEYS", 0)
    monkeypatch.setattr(dedupe, "keep_latest", seen := Mock(wraps=dedupe.keep_latest))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for listed, found in (([("a",), ("a",), ("z",)], [2]), ([("b",), (None,)], [3, 5])):
            keys = spark.createDataFrame(listed, "k string")
            got = dedupe.keep_latest_among(df, "k", keys)
            assert got.columns == df.columns
            assert sorted(r.v for r in got.collect()) == found
            # All rows are deduplicated as they are, unless the latest row without a key is asked for.
            assert (seen.call_args.args[0] is df) == (found == [2])
        plan = dedupe.keep_latest_among(df, "k", df.where("k = 'a'"))._jdf.queryExecution()
        # One exchange of the rows, below the group limit's second half, and one of the keys.
        assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_order_counts_read_the_lines_once(spark, folder, monkeypatch):
    written = []
    monkeypatch.setattr(
        metrics, "materialise", lambda df, name: written.append((name, df)) or materialise(df, name)
    )
    entry.queries()["order_count_rollup"](spark, folder)
    lines = {name: "staged-lines" in df._jdf.queryExecution().toString() for name, df in written}
    assert lines == {"orders-by-group": True, "order-numbers": False, "order-bitmaps": False}


def test_tables_of_a_load_are_written_side_by_side(spark, tmp_path, monkeypatch):
    together = Barrier(3, timeout=60)
    write = RawLayer._write
    monkeypatch.setattr(RawLayer, "_write", lambda *a: (together.wait(), write(*a)))
    raw = shop(spark, [order("a")], [line("a0", "a")])
    extracts = {
        n: getattr(raw, n).drop("load_id", "row_id") for n in ("orders", "order_lines", "fx_rates")
    }
    layer = RawLayer(spark, str(tmp_path))
    layer.load(extracts, "1", "replace")
    assert [layer.read(n).count() for n in extracts] == [1, 1, 0]
    assert all(".zstd." in f for f in layer.read("orders").inputFiles())
