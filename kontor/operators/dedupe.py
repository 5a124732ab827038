"""Keep-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor.session import materialise

LATEST_FIRST = ("load_id", "row_id")
#: Listed keys from which on deduplicating everything first moves fewer bytes; below, Spark can broadcast.
MANY_KEYS = 500_000


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = LATEST_FIRST
) -> DataFrame:
    """One row per key: the one with the highest ``order`` columns; a NULL there loses.

    Spark turns ``row_number() = 1`` into a group limit before and after the exchange. Each map task
    sends at most one row per key, so a key that holds a third of all rows costs no more than any
    other one.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        df.withColumn("_place", F.row_number().over(newest))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def keep_latest_among(
    df: DataFrame,
    key: str,
    candidates: DataFrame,
    order: Sequence[str] = LATEST_FIRST,
) -> DataFrame:
    """``keep_latest`` for the listed keys only, over all their versions.

    ``candidates`` holds the keys for which *any* version qualified. It is written once; while its
    files are small Spark broadcasts it, so the big table is filtered where it is read and only the
    versions in question are shuffled. Larger lists turn into a shuffled semi join, and lists of more than
    ``MANY_KEYS`` meet the latest rows of all keys instead: those come to the join from ``keep_latest`` as
    they are distributed, so that the big table is shuffled once and not twice.
    """
    wanted = materialise(candidates.select(key).distinct(), f"keys-{key}")
    number, unkeyed = wanted.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    if number > MANY_KEYS and not unkeyed:
        # Every key is listed once, so this is a semi join; but Spark would move a semi join to
        # before the group limit, where a hot key comes with all its versions.
        return keep_latest(df, [key], order).join(wanted, key).select(*df.columns)
    # Joining on the key and its length keeps a shuffled join's partitioning apart from the one that
    # keep_latest asks for. Were they the same, Spark would leave out the exchange between them, and
    # with it the group limit before it: one task would sort all versions of a hot key. This way AQE
    # can split that key in the join, and each part passes on one row of it.
    size = F.coalesce(F.length(F.col(key).cast("string")), F.lit(-1)).alias("_size")
    # Null-safe, because keep_latest keeps the latest row without a key as well.
    rows, listed = df.select("*", size), wanted.select(F.col(key).alias("_wanted"), size)
    same = F.col(key).eqNullSafe(F.col("_wanted")) & (rows["_size"] == listed["_size"])
    versions = rows.join(listed, same, "left_semi")
    return keep_latest(versions.drop("_size"), [key], order)
