"""Following extract folders: every micro-batch is one load, then one refresh of the facts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kontor.schemas import EXTRACTS
from kontor.sources.extracts import load_raw


def follow_extracts(
    spark: SparkSession,
    name: str,
    extract_folder: str,
    raw_folder: str,
    checkpoint: str,
    refresh: Callable[[], None],
) -> StreamingQuery:
    """Append the extract files that arrived since the last call to the raw table, then refresh.

    The load id is the UTC time of the load in ISO form, so it stands above every dated load before it,
    whatever the checkpoint counts. A micro-batch that is replayed after a failure appends the same
    rows under a later id, which keep-latest folds, and the upsert behind ``refresh`` gives the same
    table again.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        now = datetime.now(UTC).isoformat(timespec="microseconds")
        load_raw(batch, raw_folder, name, now, "append")
        refresh()

    return (
        spark.readStream.schema(EXTRACTS[name])
        .parquet(extract_folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
