"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.session import configure

#: Arrow batches are kept small, because a single text may be very long.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def row_key(id_column: str, text_column: str) -> list[Column]:
    """Two longs, never NULL, that identify a row by its id and its text.

    Rows that agree in both are the same row repeated, and interchangeable for every operator here.
    The key depends on nothing but the row, so a task that runs again finds the same one.
    """
    return [
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("k1"),
        F.xxhash64(F.col(text_column), F.col(id_column).isNull()).alias("k2"),
    ]


KEY = ["k1", "k2"]


def fresh(taken: list[str], name: str) -> str:
    """A column name like ``name`` that none of the taken ones has, whatever its case."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def built_once(shared: Broadcast, build: Callable):
    """What a worker process builds from a broadcast value, once for all the tasks that it runs.

    It lives as long as the process holds the broadcast, and may only save work.
    """
    if not hasattr(shared, "built"):
        shared.built = build(shared.value)
    return shared.built



def hand_back() -> None:
    """Hands freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(task: Callable) -> Callable:
    """A function over batches that hands freed memory back when its task ends.

    Worker processes outlive tasks, and what their allocators keep adds up over a long run.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            hand_back()

    return run


#: A written table of at most so many narrow rows is broadcast; beyond that joins shuffle.
BROADCAST_ROWS = 1_000_000


def sized(written: DataFrame, entries: Column | None = None) -> DataFrame:
    """A written table, marked for broadcast only after its rows were counted.

    Where rows hold lists, ``entries`` gives a row's number of list entries, and those count.
    """
    weight = F.lit(1) if entries is None else F.lit(1) + entries
    total = written.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(written) if total <= BROADCAST_ROWS else written
