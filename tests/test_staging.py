from datetime import date, datetime

import pytest
from frames import as_dict, order, raw_frame
from pyspark.sql import functions as F

from kontor.operators.dedupe import keep_latest, keep_latest_among
from kontor.plans import staging


def test_later_load_wins_then_higher_row_then_null_loses(spark):
    rows = [
        ("a", "1", "x", 1), ("a", "2", "a", 2),
        ("b", "1", "x", 3), ("b", "1", "y", 4),
        ("c", None, "z", 5), ("c", "1", "a", 6),
    ]
    df = spark.createDataFrame(rows, "k string, load_id string, row_id string, v int")
    assert as_dict(keep_latest(df, ["k"]), "k", "v") == {"a": 2, "b": 4, "c": 6}


def test_dedupe_limits_groups_before_the_exchange(spark):
    df = spark.createDataFrame([("a", "1", "x")], "k string, load_id string, row_id string")
    plan = keep_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    assert final < plan.index("Exchange") < partial


def test_restricted_dedupe_sees_all_versions_of_the_candidates(spark):
    rows = [("a", "1", "x", 1), ("a", "2", "x", 9), ("b", "1", "x", 1)]
    df = spark.createDataFrame(rows, "k string, load_id string, row_id string, v int")
    got = keep_latest_among(df, "k", df.where("v = 1 and k = 'a'"))
    assert as_dict(got, "k", "v") == {"a": 9}


def test_renamed_postal_code(spark):
    base = {"signup_date": "2024-02-29", "created_at": "2024-02-29T00:30:00+01:00"}
    raw = raw_frame(
        spark,
        "customers",
        [
            {"customer_id": "zip", "zip_code": "1", **base},
            {"customer_id": "postal", "postal_code": "2", **base},
            {"customer_id": "both", "zip_code": "1", "postal_code": "2", **base},
            {"customer_id": "none", **base},
        ],
    )
    got = staging.stg_customers(raw)
    expected = {"zip": "1", "postal": "2", "both": "2", "none": None}
    assert as_dict(got, "customer_id", "postal_code") == expected
    row = got.first()
    assert row["signup_date"] == date(2024, 2, 29)
    assert row["created_at_utc"] == datetime(2024, 2, 28, 23, 30)


def test_bad_date_fails_the_run(spark):
    raw = raw_frame(spark, "fx_rates", [{"rate_date": "31.12.2024"}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_fx_rates(raw).collect()


def test_rates_are_unique_per_day_and_pair(spark):
    pair = {"base_currency": "EUR", "quote_currency": "CHF"}
    raw = raw_frame(
        spark,
        "fx_rates",
        [
            {"rate_date": "2024-01-02", "rate": 0.9, **pair},
            {"rate_date": "2024-01-02", "rate": 0.8, **pair, "load_id": "2"},
            {"rate_date": "2024-01-02", "rate": 1.1, **pair, "quote_currency": "USD"},
        ],
    )
    got = as_dict(staging.stg_fx_rates(raw), "quote_currency", "rate")
    assert got == {"CHF": 0.8, "USD": 1.1}


def test_hot_key_of_many_copies_keeps_one_row(spark):
    copies = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lpad(F.col("id").cast("string"), 9, "0").alias("load_id"),
        F.lit("r").alias("row_id"),
    )
    got = keep_latest(copies, ["k"])
    assert got.count() == 1 + copies.where("id % 3 != 0").count()
    assert got.where("k = 'hot'").first()["load_id"] == "000199998"


def test_staging_publishes_the_agreed_columns(spark):
    raw = raw_frame(spark, "orders", [order("O1")])
    assert staging.stg_orders(raw).columns == [
        "order_id", "customer_id", "order_date_utc", "currency", "status",
        "shipping_amount_local", "discount_amount_local",
    ]
