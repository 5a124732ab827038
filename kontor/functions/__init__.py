"""Column expressions used across the package."""

from kontor.functions.columns import (
    day_name,
    hours_between,
    iso_day_of_week,
    iso_lower_bound,
    micro_units,
    money_sum,
    month_start,
    price_band,
    round_cents,
    timestamp_literal,
    to_eur,
    utc_naive,
)

__all__ = [
    "day_name",
    "hours_between",
    "iso_day_of_week",
    "iso_lower_bound",
    "micro_units",
    "money_sum",
    "month_start",
    "price_band",
    "round_cents",
    "timestamp_literal",
    "to_eur",
    "utc_naive",
]
