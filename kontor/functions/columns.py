"""Column -> Column helpers. All are built from JVM functions, so they stay inside codegen."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_literal(moment: datetime | str) -> Column:
    """A zone-less timestamp literal, independent of the session time zone."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def utc_naive(iso_text: Column) -> Column:
    """Offset-carrying ISO-8601 text to the UTC wall clock.

    Goes through the epoch instead of a timestamp -> timestamp_ntz cast, because that cast would
    render the instant in the session's time zone.
    """
    micros = F.unix_micros(iso_text.cast("timestamp"))
    return F.timestamp_add("MICROSECOND", micros, timestamp_literal("1970-01-01 00:00:00"))


def iso_lower_bound(iso_text: Column, since: datetime) -> Column:
    """Necessary condition for ``utc_naive(iso_text) > since`` that Parquet can evaluate.

    ISO text sorts like its local wall clock and offsets stay within a day of UTC, so comparing the
    text with the previous day never loses a row, and it prunes row groups by string statistics.
    """
    return iso_text >= F.lit((since - timedelta(days=1)).strftime("%Y-%m-%d"))


def to_eur(amount: Column, currency: Column, eur_chf_rate: Column) -> Column:
    """EUR passes through; every other currency, also a missing one, is divided by the rate."""
    return F.when(currency == "EUR", amount).otherwise(F.try_divide(amount, eur_chf_rate))


def round_cents(amount: Column) -> Column:
    """Two decimals, half away from zero, on the double itself (not on its decimal text)."""
    scaled = F.abs(amount * 100)
    whole = F.floor(scaled)
    cents = whole + F.when(scaled - whole >= 0.5, 1).otherwise(0)
    return F.when(amount < 0, -cents).otherwise(cents) / F.lit(100.0)


def money_sum(amount: Column) -> Column:
    """Sum of two-decimal amounts. Adds whole cents, so any order of rows gives the same double."""
    return F.sum(F.rint(amount * 100).cast("bigint")) / F.lit(100.0)


def micro_units(amount: Column) -> Column:
    """Millionths as a long, for exact sums of amounts that are not rounded to cents yet."""
    return F.rint(amount * 1_000_000).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed from start to end, signed; NULL if either side is NULL."""
    anchor = timestamp_literal("0001-01-01 00:00:00")
    return F.timestamp_diff("HOUR", anchor, end) - F.timestamp_diff("HOUR", anchor, start)


def iso_day_of_week(day: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(day) + 1


def day_name(day: Column) -> Column:
    """English weekday name, whatever the JVM locale."""
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), iso_day_of_week(day))


def month_start(moment: Column) -> Column:
    """First instant of the month as a zone-less timestamp."""
    return F.trunc(moment.cast("date"), "month").cast("timestamp_ntz")


def price_band(price_eur: Column) -> Column:
    """Coarse price tier; a missing price counts as premium."""
    return (
        F.when(price_eur < 25, F.lit("budget"))
        .when(price_eur < 100, F.lit("mid"))
        .otherwise(F.lit("premium"))
    )
