"""Exchange-rate feed: the date range to ask for, and the payload flattened to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.functions import utc_naive
from kontor.schemas import FX_PAYLOAD


def fx_date_range(raw_orders: DataFrame) -> DataFrame:
    """First and last UTC date among the raw orders."""
    day = utc_naive(F.col("order_date")).cast("date")
    return raw_orders.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))


def read_fx_payload(spark: SparkSession, path: str) -> DataFrame:
    """Feed responses, one JSON document per line."""
    return spark.read.schema(FX_PAYLOAD).json(path)


def flatten_fx(payload: DataFrame) -> DataFrame:
    """``{rates: {date: {CHF: rate}}}`` to one row per date of the EUR/CHF pair."""
    return payload.select(F.explode("rates").alias("rate_date", "quotes")).select(
        "rate_date",
        F.lit("EUR").alias("base_currency"),
        F.lit("CHF").alias("quote_currency"),
        F.col("quotes")["CHF"].alias("rate"),
    )


def fx_payload(rates: DataFrame) -> DataFrame:
    """Rate rows as feed responses, one document per year of rates."""
    quote = F.create_map(F.col("quote_currency"), F.col("rate"))
    entry = F.struct(F.col("rate_date").cast("string"), quote)
    return rates.groupBy(
        F.col("base_currency").alias("base"), F.year("rate_date").alias("year")
    ).agg(F.map_from_entries(F.collect_list(entry)).alias("rates")).select("base", "rates")
