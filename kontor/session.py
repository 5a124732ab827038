"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Joins carry no broadcast hints: Spark broadcasts a side only while its
# size stays below spark.sql.autoBroadcastJoinThreshold, and AQE splits skewed partitions of the
# sort-merge joins that remain.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

#: How tables and intermediate results are written: zstd takes about two thirds of the default's bytes.
#: Dictionaries are tried for every column and given up for ids and amounts, which is most of them; zstd
#: finds repeated values as well. Without them, and at zstd's first level, writing takes half the time.
WRITTEN = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.enable.dictionary": "false",
}

T = TypeVar("T")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that the caller created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="kontor-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/kontor/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    Cuts the lineage at files that outlive any executor, and gives the planner the real size of the
    rows, so that its broadcast decision further on is a checked one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**WRITTEN).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs from a few driver threads, so that small ones fill the gaps.

    All of them are finished, or have failed, before the first error is raised.
    """
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = [pool.submit(job) for job in jobs]
    return [job.result() for job in running]


def sweep_scratch(spark: SparkSession, age: timedelta = timedelta(days=2)) -> list[str]:
    """Remove intermediate tables older than ``age``, which must outlast any frame that reads them."""
    from kontor.sources.files import remove_older

    folder = f"{scratch_root(spark)}/kontor"
    return [f"{folder}/{name}" for name in remove_older(spark, folder, age)]
