"""The physical plans: what is pushed down, pruned, shuffled and broadcast."""

import re
from datetime import datetime

import pytest
from frames import shop
from pyspark.sql import functions as F

from kontor.functions import timestamp_literal
from kontor.plans import metrics
from kontor.plans.facts import fct_order_lines
from kontor.plans.incremental import _recorded_since, order_lines_table
from kontor.plans.staging import stage
from kontor.schemas import FCT_ORDER_LINES, RAW
from kontor.sources.extracts import stored_raw


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    for name, df in vars(shop(spark)).items():
        df.write.parquet(f"{folder}/{name}")
    return stored_raw(spark, folder)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookback_bound_reaches_the_raw_scan(stored):
    text = plan(_recorded_since(stored.orders, "order_date", datetime(2024, 3, 8)))
    assert "GreaterThanOrEqual(order_date,2024-03-07)" in text


def test_lines_meet_their_totals_in_one_exchange(stored, no_broadcast):
    staged = stage(stored)
    text = plan(fct_order_lines(staged.order_lines, staged.orders, staged.fx_rates))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # The lines themselves are exchanged for their order once; the totals come pre-aggregated.
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, _hash", text)) == 2
    assert text.count("partial_sum") == 1


def test_nothing_is_broadcast_without_a_size_check(stored, no_broadcast):
    staged = stage(stored)
    lines = fct_order_lines(staged.order_lines, staged.orders, staged.fx_rates)
    assert "Broadcast" not in plan(lines)


def mart(spark, tmp_path):
    table = order_lines_table(spark, str(tmp_path / "lines"))
    rows = spark.range(3).select(
        *[
            (F.add_months(F.lit("2024-01-31").cast("date"), F.col("id").cast("int")))
            .cast(f.dataType)
            .alias(f.name)
            if f.name in ("order_date", "order_date_utc")
            else F.lit("1").cast(f.dataType).alias(f.name)
            for f in FCT_ORDER_LINES
        ]
    )
    table.replace_all(rows)
    return table


def test_metric_reads_two_columns_of_the_mart(spark, tmp_path):
    text = plan(metrics.revenue_by_month(mart(spark, tmp_path).current()))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert schema == "struct<order_date:date,net_revenue_eur:double>"


def test_slices_prune_and_literals_push_down(spark, tmp_path):
    table = mart(spark, tmp_path)
    since = F.col("order_date_utc") > timestamp_literal("2024-03-01")
    text = plan(table.read(["2024-03"]).where(since))
    assert "GreaterThan(order_date_utc" in text
    assert len(table.read(["2024-03"]).inputFiles()) == 1
    assert len(table.current().inputFiles()) == 3


def test_product_join_meets_totals_not_lines(spark, tmp_path, no_broadcast):
    lines = mart(spark, tmp_path).current()
    products = spark.createDataFrame([("1", "Decor")], "product_id string, category string")
    text = plan(metrics.category_revenue_by_month(lines, products))
    # Read bottom up: the partial aggregate comes before the exchange that feeds the join.
    assert text.index("SortMergeJoin") < text.index("partial_sum", text.index("SortMergeJoin"))


def test_raw_columns_are_pruned(stored):
    text = plan(stage(stored).orders.select("order_id"))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"order_id", "load_id", "row_id"}
    assert len(RAW["orders"]) == 9


def test_hot_customer_is_split_over_tasks(spark, monkeypatch):
    """A third of all facts has one customer and one moment, so no bucket of time divides them."""
    from kontor.operators import scd2

    monkeypatch.setattr(scd2, "HOT_FACTS", 20_000)
    facts = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("C0"))
        .otherwise(F.concat(F.lit("C"), F.col("id") % 5000))
        .alias("k"),
        F.md5(F.col("id").cast("string")).alias("payload"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("at"),
    )
    customers = spark.range(5000).select(F.concat(F.lit("C"), F.col("id")).alias("k"))
    in_parts, sizes = scd2._in_parts, []

    def counted(rows):
        out = in_parts(rows)
        group = out.where("_fact is not null").groupBy("_key", "_bucket", "_part").count()
        sizes.append(group.agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(scd2, "_in_parts", counted)
    joined = scd2.as_of_join(facts, scd2.first_snapshot(customers, "2024-01-01"), "k", "at")
    assert joined.agg(F.count("valid_from"), F.countDistinct("payload")).first()[:] == (400_000, 400_000)
    assert sizes[0] < 25_000


def test_hot_versions_behind_a_join_are_limited_before_the_exchange(spark, no_broadcast):
    """A shuffled semi join must not leave all versions of one key to one task."""
    from kontor.operators.dedupe import keep_latest_among

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    versions = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("K0"))
        .otherwise(F.concat(F.lit("K"), F.col("id")))
        .alias("k"),
        F.lpad(F.col("id").cast("string"), 9, "0").alias("load_id"),
        F.md5(F.col("id").cast("string")).alias("row_id"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        latest = keep_latest_among(versions, "k", versions.where("k < 'K2'"))
        rows = {r["k"]: r["load_id"] for r in latest.collect()}
        text = plan(latest).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert rows["K0"] == "000299997"
    assert len(rows) == versions.where("k < 'K2'").select("k").distinct().count()
    assert "SortMergeJoin(skew=true)" in text
    partial = text.index("Partial")
    assert text.index("Final", text.index("WindowGroupLimit")) < text.index("Exchange") < partial


def test_an_order_with_a_third_of_the_lines_is_split(spark, tmp_path, no_broadcast):
    """On the bare order id the totals would reach the join without an exchange, and no split."""
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    order_id = F.when(F.col("id") % 3 == 0, "O0").otherwise(F.concat(F.lit("O"), "id"))
    lines = spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("L"), "id").alias("order_line_id"),
        order_id.alias("order_id"),
        F.concat(F.lit("P"), F.xxhash64("id")).alias("product_id"),
        F.lit(2).cast("long").alias("quantity"),
        F.lit(10.0).alias("unit_price_eur"),
    )
    orders = lines.select("order_id").distinct().select(
        "order_id",
        F.lit("C").alias("customer_id"),
        F.lit("placed").alias("status"),
        F.lit("EUR").alias("currency"),
        timestamp_literal("2024-03-01").alias("order_date_utc"),
        F.lit(4.99).alias("shipping_amount_local"),
        F.lit(0.0).alias("discount_amount_local"),
    )
    rates = spark.createDataFrame([], "rate_date date, rate double")
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        lines.write.parquet(str(tmp_path / "lines"))
        orders.write.parquet(str(tmp_path / "orders"))
        read = spark.read.parquet
        df = fct_order_lines(read(str(tmp_path / "lines")), read(str(tmp_path / "orders")), rates)
        assert len(df.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)
