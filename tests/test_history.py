from datetime import datetime

from pyspark.sql import functions as F

from kontor.operators.scd2 import as_of_join, first_snapshot, snapshot
from kontor.plans.dimensions import dim_customer
from kontor.plans.staging import stg_customers
from kontor.plans.warehouse import (
    CHECK_COLUMNS,
    customer_history_table,
    refresh_customer_history,
)
from kontor.schemas import CUSTOMER_HISTORY, _schema

SOURCE = _schema("k string, a string, b string, mail string")
DAYS = [datetime(2024, 1, d) for d in range(1, 6)]


def source(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCE)


def versions(history):
    rows = history.orderBy("k", "valid_from").collect()
    return [(r["k"], r["a"], r["b"], r["mail"], r["valid_from"], r["valid_to"]) for r in rows]


def test_versions(spark):
    history = first_snapshot(
        source(
            spark,
            ("same", "1", "1", "x"),
            ("mail", "1", "1", "x"),
            ("two", "1", "1", "x"),
            ("fill", None, "1", "x"),
            ("drop", "1", "1", "x"),
            ("left", "1", "1", "x"),
        ),
        DAYS[0],
    )
    second = source(
        spark,
        ("same", "1", "1", "x"),
        ("mail", "1", "1", "y"),
        ("two", "2", "2", "y"),
        ("fill", "1", "1", "x"),
        ("drop", None, "1", "x"),
        ("born", "1", "1", "x"),
    )
    got = versions(snapshot(history, second, "k", ["a", "b"], DAYS[1]))
    assert got == [
        ("born", "1", "1", "x", DAYS[1], None),
        ("drop", "1", "1", "x", DAYS[0], DAYS[1]),
        ("drop", None, "1", "x", DAYS[1], None),
        ("fill", None, "1", "x", DAYS[0], DAYS[1]),
        ("fill", "1", "1", "x", DAYS[1], None),
        ("left", "1", "1", "x", DAYS[0], None),
        ("mail", "1", "1", "x", DAYS[0], None),
        ("same", "1", "1", "x", DAYS[0], None),
        ("two", "1", "1", "x", DAYS[0], DAYS[1]),
        ("two", "2", "2", "y", DAYS[1], None),
    ]


def test_change_back_makes_a_third_version_and_a_rerun_none(spark):
    one, two = source(spark, ("k", "1", "1", "x")), source(spark, ("k", "2", "1", "x"))
    history = first_snapshot(one, DAYS[0])
    for day, rows in zip(DAYS[1:], (two, two, one), strict=False):
        history = snapshot(history, rows, "k", ["a", "b"], day)
    assert [(v[1], v[4], v[5]) for v in versions(history)] == [
        ("1", DAYS[0], DAYS[1]),
        ("2", DAYS[1], DAYS[3]),
        ("1", DAYS[3], None),
    ]


def test_as_of(spark):
    history = snapshot(
        first_snapshot(source(spark, ("k", "old", "1", "x")), DAYS[1]),
        source(spark, ("k", "new", "1", "x")),
        "k",
        ["a"],
        DAYS[3],
    )
    facts = spark.createDataFrame([("k", d) for d in DAYS], _schema("k string, at timestamp_ntz"))
    got = as_of_join(facts, history, "k", "at").orderBy("at").collect()
    assert [r["a"] for r in got] == [None, "old", "old", "new", "new"]
    assert as_of_join(facts, history, "k", "at", "inner").count() == 4


def test_as_of_with_a_hot_customer_keeps_every_fact(spark):
    minutes = F.make_dt_interval(mins=F.col("id").cast("int"))
    facts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + minutes).alias("at"),
    )
    history = first_snapshot(source(spark, ("hot", "1", "1", "x")), DAYS[0])
    history = snapshot(history, source(spark, ("hot", "2", "1", "x")), "k", ["a"], DAYS[2])
    got = as_of_join(facts, history, "k", "at")
    assert got.count() == 60_000
    assert got.where("a = '1'").count() == 2 * 24 * 60 / 3
    assert got.where("a is null").count() == 40_000


def customers(spark, *rows):
    columns = [f.name for f in CUSTOMER_HISTORY.fields if not f.name.startswith("valid")]
    filled = [tuple({"tier": "basic", **r}.get(c) for c in columns) for r in rows]
    kinds = [f for f in CUSTOMER_HISTORY.fields if f.name in columns]
    return spark.createDataFrame(filled, type(CUSTOMER_HISTORY)(kinds))


def test_history_table_rewrites_only_open_and_current_slices(spark, tmp_path):
    table = customer_history_table(spark, str(tmp_path / "history"))
    moves = ["Aachen", "Bonn", "Celle", "Celle"]
    for month, city in enumerate(moves, start=1):
        rows = customers(spark, {"customer_id": "C1", "city": city}, {"customer_id": "C2"})
        refresh_customer_history(table, rows, datetime(2024, month, 15))
    written_by = {name: int(run.split("-")[0]) for name, run in table.published().runs.items()}
    assert written_by == {"2024-02": 2, "2024-03": 3, "undated": 4}
    got = dim_customer(table.current()).where("customer_id = 'C1'").orderBy("valid_from").collect()
    assert [(r["city"], r["is_current"]) for r in got] == [
        ("Aachen", False),
        ("Bonn", False),
        ("Celle", True),
    ]
    assert table.current().count() == 4


def test_two_runs_in_one_month_keep_what_the_first_one_closed(spark, tmp_path):
    table = customer_history_table(spark, str(tmp_path / "history"))
    for day, city in ((1, "Aachen"), (10, "Bonn"), (20, "Celle")):
        rows = customers(spark, {"customer_id": "C1", "city": city})
        refresh_customer_history(table, rows, datetime(2024, 1, day))
    assert table.current().count() == 3
    assert set(table.published().runs) == {"2024-01", "undated"}


def test_check_columns_exist(spark, folder):
    from kontor.sources.shop_tables import raw_customers

    assert set(CHECK_COLUMNS) <= set(stg_customers(raw_customers(spark, folder)).columns)
