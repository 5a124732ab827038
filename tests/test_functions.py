import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kontor.functions import (
    day_name,
    hours_between,
    iso_day_of_week,
    iso_lower_bound,
    money_sum,
    month_start,
    price_band,
    round_cents,
    timestamp_literal,
    to_eur,
    utc_naive,
)


def evaluate(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


TIMES = {
    "2024-03-31T02:30:00+01:00": datetime(2024, 3, 31, 1, 30),
    "2024-03-31T03:30:00+02:00": datetime(2024, 3, 31, 1, 30),
    "2024-10-27T00:30:00Z": datetime(2024, 10, 27, 0, 30),
    "2024-10-27T01:30:00Z": datetime(2024, 10, 27, 1, 30),
    "2024-01-01T00:15:00.123456+02:00": datetime(2023, 12, 31, 22, 15, 0, 123456),
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_utc_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    assert evaluate(spark, list(TIMES), "string", utc_naive) == list(TIMES.values())


def test_bad_time_text_fails_the_run(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, ["soon"], "string", utc_naive)


def test_text_bound_keeps_every_later_row(spark):
    since = datetime(2024, 1, 10, 0, 30)
    texts = ["2024-01-09T14:00:00-11:00", "2024-01-10T13:00:00+12:00", "2024-01-01T00:00:00+00:00"]
    later = [t > since for t in evaluate(spark, texts, "string", utc_naive)]
    kept = evaluate(spark, texts, "string", lambda c: iso_lower_bound(c, since))
    assert later == [True, True, False]
    assert kept == [True, True, False]


def test_rounding_half_away_from_zero_on_the_double(spark):
    values = [1.005, 2.675, 0.285, -0.125, 1.115, 0.0, None, -0.001, 1e13 + 0.25]
    got = evaluate(spark, values, "double", round_cents)
    assert got == [1.0, 2.68, 0.28, -0.13, 1.12, 0.0, None, 0.0, 1e13 + 0.25]
    assert math.copysign(1, got[-2]) == 1


def test_rounding_equals_duckdb(spark):
    import duckdb

    values = [n / 1000 for n in range(-20000, 20000)]
    expected = [
        r[0]
        for r in duckdb.execute("select round(x, 2) + 0.0 from (select unnest(?) as x)", [values])
        .fetchall()
    ]
    assert evaluate(spark, values, "double", round_cents) == expected


def test_money_sum_is_exact_and_ignores_null(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(None,)], "x double")
    assert df.agg(money_sum(F.col("x"))).first()[0] == 100.0
    assert df.where("x is null").agg(money_sum(F.col("x"))).first()[0] is None


@pytest.mark.parametrize(
    ("start", "end", "hours"),
    [
        ("2024-01-01 10:59:00", "2024-01-01 11:01:00", 1),
        ("2024-01-01 10:01:00", "2024-01-01 11:59:00", 1),
        ("2024-01-01 11:01:00", "2024-01-01 10:59:00", -1),
        ("2024-03-31 00:00:00", "2024-04-01 00:00:00", 24),
        ("1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
        (None, "2024-01-01 10:59:00", None),
        ("2024-01-01 10:59:00", None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_hours_count_boundaries(spark, start, end, hours, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    moment = lambda t: F.lit(None).cast("timestamp_ntz") if t is None else timestamp_literal(t)
    assert spark.range(1).select(hours_between(moment(start), moment(end))).first()[0] == hours


def test_currency(spark):
    rows = [(10.0, "EUR", None), (10.0, "CHF", 0.8), (10.0, "CHF", None), (10.0, None, 0.5),
            (10.0, "CHF", 0.0)]
    df = spark.createDataFrame(rows, "a double, c string, r double")
    got = [r[0] for r in df.select(to_eur(F.col("a"), F.col("c"), F.col("r"))).collect()]
    assert got == [10.0, 12.5, None, 20.0, None]


def test_weekdays(spark):
    days = ["2024-01-01", "2024-01-06", "2024-01-07"]
    number = lambda c: iso_day_of_week(c.cast("date"))
    name = lambda c: day_name(c.cast("date"))
    assert evaluate(spark, days, "string", number) == [1, 6, 7]
    assert evaluate(spark, days, "string", name) == ["Monday", "Saturday", "Sunday"]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_month_start(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    assert evaluate(spark, [datetime(2024, 3, 31, 23, 59)], "timestamp_ntz", month_start) == [
        datetime(2024, 3, 1)
    ]


def test_price_bands(spark):
    assert evaluate(spark, [24.99, 25.0, 99.99, 100.0, None], "double", price_band) == [
        "budget", "mid", "mid", "premium", "premium",
    ]
