"""Searching a stated query set against all rows: bounded shards of rows, and streams of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType


def usable(vector: str) -> Column:
    """Vectors that take part: neither NULL nor zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & some


def gathered(rows: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """Distinct values of ``by`` with the ``most`` smallest keys of each.

    Among rows that agree in everything that is searched, ties go to the smaller key, so no further
    key can be an answer. The window is a group limit: each task sends ``most`` rows per value.
    """
    first = Window.partitionBy(by).orderBy(key)
    return (
        rows.withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= most)
        .groupBy(by)
        .agg(F.sort_array(F.collect_list(key)).alias("ids"))
    )


def pieces(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def search(
    data: DataFrame, queries: DataFrame, shards: int, build: Callable, ask: Callable, schema: str
) -> DataFrame:
    """``ask(build(rows of a shard), some queries)`` for the queries that come to each shard.

    Both sides have a ``shard``. They share one exchange, after which a shard's rows come first and its
    queries follow in batches. So rows are moved once, a task holds one shard and one batch of
    queries, and there may be any number of queries.
    """
    columns = {f.name: f.dataType for side in (data, queries) for f in side.schema}

    def absent(kind: DataType) -> Column:
        # A NULL among whole numbers would make floats of them in pandas.
        return F.lit(0 if isinstance(kind, NumericType) else None).cast(kind)

    def side(df: DataFrame, of_query: bool) -> DataFrame:
        own = [
            F.col(c) if c in df.columns else absent(kind).alias(c) for c, kind in columns.items()
        ]
        return df.select(*own, F.lit(of_query).alias("_asked"))

    names = (list(data.columns), list(queries.columns))
    return (
        side(data, False)
        .unionByName(side(queries, True))
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "_asked")
        .mapInPandas(_streamed(names, build, ask), schema)
    )


def _streamed(names: tuple[list[str], list[str]], build: Callable, ask: Callable):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, state = None, [], None
        for frame in frames:
            for shard, rows in frame.groupby("shard", sort=False):
                if shard != now:
                    now, held, state = shard, [], None
                asked = rows["_asked"].to_numpy(bool)
                if not asked.all():
                    held.append(rows.loc[~asked, names[0]])
                if asked.any() and held:
                    if state is None:
                        state = build(pd.concat(held, ignore_index=True))
                    yield ask(state, rows.loc[asked, names[1]].reset_index(drop=True))

    return run


def nearest(found: DataFrame, k: int, measure: str) -> DataFrame:
    """The ``k`` best of each query over all shards, ranked, ties to the smaller ``vec_id``."""
    order = Window.partitionBy("query_id").orderBy(measure, "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
