from datetime import datetime

import pytest
from frames import line, order, shop

from kontor.plans.quality import Bounds, quality_report
from kontor.plans.staging import stage
from kontor.plans.warehouse import Warehouse
from kontor.sources.extracts import stored_raw
from kontor.streaming.micro_batch import follow_extracts


def customer(city):
    return {
        "customer_id": "C1", "city": city, "tier": "basic", "signup_date": "2024-01-01",
        "created_at": "2024-01-01T00:00:00+01:00",
    }


PRODUCT = {
    "product_id": "P1", "category": "Decor", "price_eur": 10.0,
    "created_at": "2024-01-01T00:00:00+01:00",
}


@pytest.mark.parametrize("grain", ["month", "day"])
def test_two_nightly_runs(spark, tmp_path, grain):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), grain)
    first = shop(
        spark, [order("O1")], [line("a", "O1")], customers=[customer("Aachen")], products=[PRODUCT]
    )
    warehouse.run(first, datetime(2024, 3, 5), bounds=Bounds(row_count=(1, 10)))
    second = shop(
        spark,
        [order("O1"), order("O2", "2024-03-05T10:00:00+00:00")],
        [line("a", "O1"), line("b", "O2", 2)],
        customers=[customer("Bonn")],
        products=[PRODUCT],
    )
    warehouse.run(second, datetime(2024, 3, 6), bounds=Bounds(row_count=(1, 10)))
    marts = warehouse.marts()
    counts = {name: df.count() for name, df in marts.items()}
    assert counts == {
        "dim_product": 1,
        "dim_public_holiday_de": 2941,
        "dim_date": 6209,
        "agg_daily_revenue": 2,
        "dim_customer": 2,
        "fct_order_lines": 2,
        "fct_order_fulfilment": 2,
    }
    warehouse.register_views()
    got = spark.sql("select sum(net_revenue_eur), count(distinct order_id) from fct_order_lines")
    assert tuple(got.first()) == (30.0, 2)
    tables = marts | {f"stg_{name}": df for name, df in vars(stage(second)).items()}
    report = quality_report(tables, Bounds(row_count=(1, 10)))
    assert report.where("not passed").isEmpty()


def test_extracts_that_arrive_later_are_appended_and_refresh(spark, tmp_path):
    raw_folder, inbox = str(tmp_path / "raw"), str(tmp_path / "inbox")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for name, df in vars(shop(spark, lines=[line("a", "O1"), line("b", "O2")])).items():
        if name != "orders":
            df.write.parquet(f"{raw_folder}/{name}")

    def refresh():
        from kontor.plans.incremental import refresh_order_lines

        refresh_order_lines(warehouse.order_lines, stored_raw(spark, raw_folder))

    seen = []
    for orders in ([order("O1", shipping_amount_local=1.0)],
                   [order("O1", shipping_amount_local=2.0), order("O2")]):
        shop(spark, orders).orders.drop("load_id", "row_id").write.mode("append").parquet(inbox)
        query = follow_extracts(
            spark, "orders", inbox, raw_folder, str(tmp_path / "progress"), refresh
        )
        assert query.awaitTermination(120)
        rows = warehouse.order_lines.current().collect()
        seen.append({r["order_line_id"]: r["order_shipping_amount_eur"] for r in rows})
    assert seen == [{"a": 1.0}, {"a": 2.0, "b": 0.0}]
    loads = {r["load_id"] for r in stored_raw(spark, raw_folder).orders.collect()}
    assert len(loads) == 2 and min(loads) > "2024-03-05"
