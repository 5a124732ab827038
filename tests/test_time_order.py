"""The as-of merge, growth over a complete month grid, and order counts that roll up."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from frames import line, order, shop
from pyspark.sql import functions as F

from kontor.operators import scd2
from kontor.operators.scd2 import as_of_join
from kontor.plans import metrics
from kontor.plans.incremental import build_order_lines
from kontor.schemas import FCT_ORDER_LINES, _schema
from kontor.session import materialise

FACTS = _schema("k string, at timestamp_ntz, n bigint")
VERSIONS = _schema("k string, a string, valid_from timestamp_ntz, valid_to timestamp_ntz")
START = datetime(2024, 1, 1)


def random_history(seed):
    random.seed(seed)
    versions = []
    for key in "abcdefgh":
        moment = START + timedelta(hours=random.randrange(2000))
        for number in range(random.randrange(6)):
            end = moment + timedelta(hours=random.choice([0, 1, 5, 700, 3000]))
            last = random.random() < 0.2
            versions.append((key, f"{key}{number}", moment, None if last else end))
            if last:
                break
            # Sometimes with a gap in which no version is valid.
            moment = end + timedelta(hours=random.choice([0, 0, 0, 50, 2000]))
    ends = [m for v in versions for m in v[2:] if m]
    facts = [
        (random.choice("abcdefghx"),
         random.choice([*ends, START + timedelta(minutes=random.randrange(700_000))]), n)
        for n in range(600)
    ]
    facts += [(None, START, 601), ("a", None, 602), (None, None, 603), facts[0], facts[0]]
    versions += [(None, "none", START, None)]
    return facts, versions


def matched(facts, versions, inner=False):
    out = []
    for key, at, n in facts:
        hits = [
            v for v in versions
            if key is not None and at is not None and v[0] == key
            and v[2] <= at and (v[3] is None or at < v[3])
        ]
        assert len(hits) <= 1
        if hits or not inner:
            out.append((key, at, n, *(hits[0][1:] if hits else (None, None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", ["month", "day", "year"])
@pytest.mark.parametrize("seed", range(3))
def test_the_merge_equals_every_pair_compared(spark, bucket, seed):
    facts, versions = random_history(seed)
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    for how in ("left", "inner"):
        got = as_of_join(left, right, "k", "at", how, bucket)
        assert got.columns == ["k", "at", "n", "a", "valid_from", "valid_to"]
        assert sorted(map(tuple, got.collect()), key=str) == matched(facts, versions, how == "inner")
    with pytest.raises(ValueError):
        as_of_join(left, right, "k", "at", "outer")


def test_empty_sides(spark):
    facts = spark.createDataFrame([("a", START, 1)], FACTS)
    versions = spark.createDataFrame([("a", "x", START, None)], VERSIONS)
    assert as_of_join(facts.limit(0), versions, "k", "at").isEmpty()
    assert as_of_join(facts, versions.limit(0), "k", "at").first().a is None
    assert as_of_join(facts, versions.limit(0), "k", "at", "inner").isEmpty()


def test_rows_compared_stay_near_facts_and_versions(spark, monkeypatch):
    """A customer with a third of the facts and of the versions: no join, and few carried rows."""
    hours = lambda n: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n)
    number = F.col("id").cast("int")
    who = F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (number % 1000).cast("string")))
    facts = spark.range(30_000).select(who.alias("k"), hours(number).alias("at"), F.col("id").alias("n"))
    # The hot customer changes every nine hours; the last version of everyone is open.
    begins = spark.range(9000).select(who.alias("k"), F.col("id").alias("a"), hours(number * 3).alias("valid_from"))
    next_one = F.lead("valid_from").over(scd2.Window.partitionBy("k").orderBy("valid_from"))
    versions = begins.withColumn("valid_to", next_one)
    carried, sizes = scd2._carried, []

    def counted(rows):
        out = carried(rows)
        sizes.append((rows.count(), out.count(), rows.select("_key", "_bucket").distinct().count()))
        return out

    monkeypatch.setattr(scd2, "_carried", counted)
    joined = as_of_join(facts, versions, "k", "at")
    assert joined.count() == 30_000
    (rows, carried_rows, groups), = sizes
    assert rows == 39_000 and carried_rows <= groups < 36_000
    assert "Join" not in joined._jdf.queryExecution().executedPlan().toString()
    hot = joined.where("k = 'hot'").where("a is null or valid_from > at or valid_to <= at")
    assert hot.isEmpty()


# Growth


PRODUCTS = _schema("product_id string, category string")


def sales(spark, *rows):
    names = FCT_ORDER_LINES.names
    filled = []
    for number, (order_id, day, product, net) in enumerate(rows):
        row = {"order_line_id": str(number), "order_id": order_id, "order_date": day,
               "product_id": product, "net_revenue_eur": net, "currency": "EUR",
               "customer_id": f"C{order_id}"}
        filled.append(tuple(row.get(n) for n in names))
    return spark.createDataFrame(filled, FCT_ORDER_LINES)


def products(spark):
    return spark.createDataFrame([("P1", "Decor"), ("P2", "Garden"), ("P3", None)], PRODUCTS)


def test_growth_never_takes_a_gap_for_a_neighbour(spark):
    lines = sales(
        spark,
        ("1", date(2024, 1, 5), "P1", 100.0), ("2", date(2024, 2, 5), "P1", 150.0),
        ("3", date(2024, 4, 5), "P1", 30.0), ("4", date(2024, 3, 1), "P2", 10.0),
        ("5", None, "P2", 10.0), ("6", date(2024, 2, 1), "P3", 1.0),
    )
    rows = metrics.category_growth(lines, products(spark)).collect()
    got = {(r.category, r.month.month): (r.net_revenue_eur, r.previous_month_eur, r.growth) for r in rows}
    assert len(rows) == 3 * 4
    assert [got["Decor", m] for m in range(1, 5)] == [
        (100.0, None, None), (150.0, 100.0, 0.5), (0.0, 150.0, -1.0), (30.0, 0.0, None),
    ]
    assert got["Garden", 3] == (10.0, 0.0, None) and got["Garden", 4] == (0.0, 10.0, -1.0)
    assert got[None, 2] == (1.0, 0.0, None)
    assert metrics.category_growth(lines.limit(0), products(spark)).isEmpty()


def test_active_customers(spark):
    lines = sales(
        spark,
        ("1", date(2024, 1, 1), "P1", 1.0), ("2", date(2024, 3, 31), "P1", 1.0),
        ("3", date(2024, 1, 2), "P1", 1.0), ("3", date(2023, 1, 2), "P1", 1.0),
    )
    assert tuple(metrics.active_customers(lines, 90).first()) == (date(2024, 3, 31), 2, 3)
    assert tuple(metrics.active_customers(lines.limit(0)).first()) == (None, 0, 0)


def test_partial_order_counts_roll_up_exactly(spark):
    random.seed(3)
    rows = [
        (str(random.randrange(400)), date(2024, random.randrange(1, 13), 1), f"P{random.randrange(1, 5)}", 1.0)
        for _ in range(3000)
    ]
    lines = sales(spark, *rows, (None, date(2024, 1, 1), "P1", 1.0)).repartition(5)
    partials = materialise(metrics.order_bitmaps(lines, products(spark)), "partials")
    joined = lines.join(products(spark), "product_id", "left").withColumn(
        "month", F.trunc("order_date", "month").cast("timestamp_ntz")
    )
    for by in ((), ("month",), ("category",), ("month", "category"), ("currency",)):
        got = metrics.distinct_orders(partials, *by)
        known = joined.where("order_id is not null")
        expected = known.groupBy(*by).agg(F.countDistinct("order_id").alias("orders"))
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
        assert "order_id" not in got._jdf.queryExecution().optimizedPlan().toString()
    # Partials of two halves merge to those of the whole.
    halves = partials.where("month < '2024-07-01'").unionByName(partials.where("month >= '2024-07-01'"))
    assert metrics.distinct_orders(halves).first() == metrics.distinct_orders(partials).first()
    assert metrics.distinct_orders(partials.limit(0)).first()[0] == 0


def test_the_pivot_keeps_a_category_called_uncategorised(spark):
    named = spark.createDataFrame([("P1", "uncategorised"), ("P3", None)], PRODUCTS)
    lines = sales(spark, ("1", date(2024, 1, 5), "P1", 2.0), ("2", date(2024, 1, 5), "P3", 3.0))
    row = metrics.category_month_pivot(lines, named).first().asDict()
    assert (row["uncategorised"], row["uncategorised_"]) == (2.0, 3.0)


def test_lines_are_deduplicated_once(spark):
    raw = shop(spark, [order("O1")], [line("a", "O1"), line("b", "O1")])
    plan = build_order_lines(raw)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"row_number\(\) windowspecdefinition\(order_line_id", plan)) == 0
    assert len(re.findall(r"row_number\(\) windowspecdefinition\(order_id", plan)) == 1
