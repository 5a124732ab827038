import json
from datetime import date, datetime

import pytest
from frames import order, raw_frame, shop

from kontor import session
from kontor.plans import staging
from kontor.schemas import EXTRACTS, RAW
from kontor.sources.extracts import (
    load_extracts,
    load_raw,
    read_extract,
    read_raw,
    stored_raw,
    with_load_metadata,
)
from kontor.sources.fx import flatten_fx, fx_date_range, fx_payload, read_fx_payload
from kontor.sources.shop_tables import ShopTables


def extract(spark, fee):
    rows = raw_frame(spark, "orders", [order("O1", shipping_amount_local=fee), order("O2")])
    return rows.drop("load_id", "row_id")


def test_replace_then_append(spark, tmp_path):
    folder = str(tmp_path)
    load_raw(extract(spark, 1.0), folder, "orders", "1", "append")
    load_raw(extract(spark, 2.0), folder, "orders", "2", "replace")
    assert read_raw(spark, folder, "orders").count() == 2
    load_raw(extract(spark, 3.0), folder, "orders", "3", "append")
    assert read_raw(spark, folder, "orders").count() == 4
    fees = {r["order_id"]: r["shipping_amount_local"]
            for r in staging.stg_orders(read_raw(spark, folder, "orders")).collect()}
    assert fees == {"O1": 3.0, "O2": 0.0}
    with pytest.raises(ValueError, match="merge"):
        load_raw(extract(spark, 3.0), folder, "orders", "4", "merge")


def test_row_id_depends_on_content_only(spark):
    ids = [
        {r["order_id"]: r["row_id"] for r in with_load_metadata(rows, load).collect()}
        for rows, load in (
            (extract(spark, 1.0), "1"),
            (extract(spark, 1.0).repartition(3), "2"),
            (extract(spark, 2.0), "1"),
        )
    ]
    assert ids[0] == ids[1]
    assert ids[0]["O1"] != ids[2]["O1"] and ids[0]["O2"] == ids[2]["O2"]


def test_extract_scan(spark, tmp_path):
    extract(spark, 1.0).write.parquet(str(tmp_path / "orders.parquet"))
    got = read_extract(spark, str(tmp_path), "orders")
    assert got.schema == EXTRACTS["orders"] and got.count() == 2


def test_all_extracts_share_one_increasing_load_id(spark, tmp_path):
    inbox, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    for name, df in vars(shop(spark, orders=[order("O1")])).items():
        df.select(*EXTRACTS[name].names).write.parquet(f"{inbox}/{name}.parquet")
    for load_id in ("2024-03-05", "2024-03-05", "2024-03-06"):
        load_extracts(spark, inbox, raw, load_id)
    with pytest.raises(ValueError, match="later than '2024-03-04'"):
        load_extracts(spark, inbox, raw, "2024-03-04")
    loads = [r["load_id"] for r in read_raw(spark, raw, "orders").collect()]
    assert sorted(loads) == ["2024-03-05", "2024-03-05", "2024-03-06"]
    assert staging.stg_orders(stored_raw(spark, raw).orders).count() == 1


def test_stored_raw(spark, tmp_path):
    for name, df in vars(shop(spark, orders=[order("O1")])).items():
        df.write.parquet(str(tmp_path / name))
    raw = stored_raw(spark, str(tmp_path))
    assert set(vars(raw)) == set(RAW)
    assert raw.orders.count() == 1


def test_fx_payload(spark, tmp_path):
    path = tmp_path / "feed.json"
    rates = {"2024-01-02": {"CHF": 0.93}, "2024-01-03": {"CHF": 0.94}}
    path.write_text(json.dumps({"amount": 1.0, "base": "EUR", "rates": rates}))
    got = flatten_fx(read_fx_payload(spark, str(path)))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("2024-01-02", "EUR", "CHF", 0.93),
        ("2024-01-03", "EUR", "CHF", 0.94),
    ]
    assert got.columns == EXTRACTS["fx_rates"].names


def test_fx_payload_round_trip(spark, tmp_path, folder):
    rates = staging.stg_fx_rates(ShopTables(spark, folder).fx_rates)
    fx_payload(rates).write.json(str(tmp_path / "feed"))
    back = flatten_fx(read_fx_payload(spark, str(tmp_path / "feed")))
    expected = rates.selectExpr("string(rate_date)", "base_currency", "quote_currency", "rate")
    assert back.exceptAll(expected).isEmpty() and back.count() == rates.count()


def test_fx_date_range_is_in_utc(spark):
    orders = [order("a", "2024-01-01T00:30:00+01:00"), order("b", "2024-03-01T23:30:00-02:00")]
    got = fx_date_range(raw_frame(spark, "orders", orders)).first()
    assert tuple(got) == (date(2023, 12, 31), date(2024, 3, 2))


def test_scratch_is_the_shared_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_materialised_rows_keep_schema_and_values(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1)], "t timestamp_ntz, n bigint")
    back = session.materialise(df, "test")
    assert back.schema == df.schema and back.collect() == df.collect()


@pytest.mark.parametrize("number", [7, 12_345_678])
def test_long_keys_are_not_cut(spark, number):
    from kontor.sources.shop_tables import _order_id
    from pyspark.sql import functions as F

    got = spark.range(1).select(_order_id(F.lit(number).cast("bigint"))).first()[0]
    assert got == f"ORD-{number:07d}"
