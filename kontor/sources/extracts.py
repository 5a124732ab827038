"""Reading extracts and seeds, and loading them into the raw layer.

The raw layer keeps every load in files of its own and a published list that says which loads make up
each table. A load of many tables becomes visible in one step; whoever began to read an earlier list
finishes on it, and a load that fails changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta
from functools import partial
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.schemas import EXTRACTS, HOLIDAY_SEED, RAW
from kontor.session import WRITTEN, side_by_side
from kontor.sources.files import exists, remove_older
from kontor.sources.lists import Listing, PublishedLists, Slice

MODES = ("replace", "append")


def read_extract(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One producer extract, all columns, by its declared schema."""
    return spark.read.schema(EXTRACTS[name]).parquet(f"{folder}/{name}.parquet")


def with_load_metadata(extract: DataFrame, load_id: str) -> DataFrame:
    """Add the load id and a row id that is the same whenever the same row is loaded again."""
    row = F.to_json(F.struct(*[F.col(c) for c in extract.columns]))
    return extract.select("*", F.lit(load_id).alias("load_id"), F.sha2(row, 256).alias("row_id"))


@dataclass(frozen=True)
class RawLayer:
    """The raw tables below one folder.

    Loads lie in ``loads/run=<id>/<table>``, lists in ``published``. A table that no list names is read
    from ``<folder>/<table>`` as it lies there, so files written by other means can stand in for it.
    """

    spark: SparkSession
    folder: str

    @property
    def lists(self) -> PublishedLists:
        return PublishedLists(self.spark, f"{self.folder}/published")

    def load(self, extracts: Mapping[str, DataFrame], load_id: str, mode: str) -> None:
        """Load extracts untouched under one load id, all of them or none.

        ``replace`` keeps only this load of the given tables, ``append`` adds it. The latest load wins
        per key, so appending below an id that one of the tables already holds is refused. The ids are
        those of the list that this load follows; if another load is published in the meantime, this
        one fails at its own list.
        """
        if mode not in MODES:
            raise ValueError(f"unknown load mode {mode!r}")
        base = self.lists.newest()
        if mode == "append":
            for name in extracts:
                held = [d.maxima["load_id"] for d in base.tables.get(name, {}).values()]
                if max(held, default="") > load_id:
                    raise ValueError(f"{name} already holds a load later than {load_id!r}")
                if not held and exists(self.spark, f"{self.folder}/{name}"):
                    raise ValueError(f"{name} lies there unlisted; replace it")
        run = f"{base.version + 1:09d}-{uuid.uuid4().hex[:8]}"
        side_by_side(
            *[partial(self._write, rows, load_id, run, name) for name, rows in extracts.items()]
        )
        added = {run: Slice(run, maxima={"load_id": load_id})}
        self.lists.publish(
            base,
            {
                name: {**(base.tables.get(name, {}) if mode == "append" else {}), **added}
                for name in extracts
            },
        )

    def _write(self, rows: DataFrame, load_id: str, run: str, name: str) -> None:
        loaded = with_load_metadata(rows, load_id)
        loaded.write.options(**WRITTEN).parquet(self._at(run, name))

    def read(self, name: str, listing: Listing | None = None) -> DataFrame:
        """A raw table with its load metadata, as of the newest list or a given one."""
        loads = (listing or self.lists.newest()).tables.get(name)
        paths = [f"{self.folder}/{name}"]
        if loads:
            paths = [self._at(d.run, name) for d in loads.values()]
        return self.spark.read.schema(RAW[name]).parquet(*paths)

    def tables(self) -> SimpleNamespace:
        """All raw tables by name, all of one list, which they stay with."""
        listing = self.lists.newest()
        return SimpleNamespace(**{name: self.read(name, listing) for name in RAW})

    def sweep(self, keep: int = 2, age: timedelta = timedelta(days=2)) -> list[str]:
        """Remove loads that none of the newest ``keep`` lists names, and older lists, of this age."""
        if keep < 1:
            raise ValueError("the newest list must be kept")
        versions = self.lists.versions()
        if not versions:
            return []
        named = [self.lists.read(v).tables.values() for v in versions[:keep]]
        runs = {f"run={d.run}" for state in named for loads in state for d in loads.values()}
        newest = {f"version={v}" for v in versions[:keep]}
        folders = ((f"{self.folder}/loads", runs), (self.lists.path, newest))
        return [
            f"{folder}/{name}"
            for folder, kept in folders
            for name in remove_older(self.spark, folder, age, kept)
        ]

    def _at(self, run: str, name: str) -> str:
        return f"{self.folder}/loads/run={run}/{name}"


def load_raw(extract: DataFrame, raw_folder: str, name: str, load_id: str, mode: str) -> None:
    """Load one extract, see ``RawLayer.load``."""
    RawLayer(extract.sparkSession, raw_folder).load({name: extract}, load_id, mode)


def load_extracts(
    spark: SparkSession, folder: str, raw_folder: str, load_id: str, mode: str = "append"
) -> None:
    """Load all extracts of a folder under one load id, an ISO date or time, in one step.

    The same id again is a repeated load, which keep-latest folds.
    """
    extracts = {name: read_extract(spark, folder, name) for name in EXTRACTS}
    RawLayer(spark, raw_folder).load(extracts, load_id, mode)


def read_raw(spark: SparkSession, raw_folder: str, name: str) -> DataFrame:
    """A raw table with its load metadata."""
    return RawLayer(spark, raw_folder).read(name)


def stored_raw(spark: SparkSession, raw_folder: str) -> SimpleNamespace:
    """All raw tables below a folder, by name, as of the newest list."""
    return RawLayer(spark, raw_folder).tables()


def write_seed(rows: DataFrame, path: str) -> None:
    """Write a seed as CSV with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_holiday_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOLIDAY_SEED).option("header", True).csv(path)
