"""Quality classifier: a factorisation machine over hashed words and structure statistics.

No metadata is a feature. Language, source and id may not be, and what is left, the number of
characters, says no more than the length of the text, which is among the statistics.

The score is a logistic function of a linear part and all pairwise interactions of the features, each
pair weighted by the product of two short vectors. The sum over pairs is half of the difference
between the square of the sum and the sum of squares, so it costs as much as the linear part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.llm.language import held_out
from kontor.llm.rows import table

WORDS = 1 << 14
RANK = 8
#: At most so many labelled rows are learned from: those with the smallest hash of their id.
SAMPLE = 6000
EPOCHS = 6
THRESHOLD = 0.3
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r\n",
    "line": b"\n",
    "symbol": b"#$%&*+<=>@[]^_`{|}~\\/",
    "mark": b"!?|",
    "stop": b".,;:",
}
_TABLE = np.stack([np.isin(np.arange(256), list(chars)) for chars in _CLASSES.values()], axis=1)
STATISTICS = len(_CLASSES) + 9


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure statistics of a text, all of about the size of one."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size, number = max(1, int(raw.sum())), max(1, len(words))
    shares = (raw @ _TABLE) / size
    lines = text.split("\n")
    top = counts.most_common(1)[0][1] if counts else 0
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    follows = sum([a == b for a, b in zip(words, words[1:], strict=False)])
    return [
        *(shares * 4).tolist(),
        len(counts) / number,
        top / number * 2,
        follows / number * 2,
        float(lengths.mean()) / 8,
        float(lengths.std()) / 8,
        np.log1p(size) / 10,
        np.log1p(number) / 8,
        len(set(lines)) / len(lines),
        1.0,
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): structure statistics first, then hashed words of the whole text."""
    text = text or ""
    words = [w for w in _SPACE.split(text) if w]
    counts = Counter(words)
    values = statistics(text, words, counts)
    places = np.fromiter(
        (zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in counts), np.int64, len(counts)
    )
    share = np.fromiter(counts.values(), np.float64, len(counts))
    weight = np.bincount(places, share, WORDS) if len(counts) else np.zeros(0)
    used = np.flatnonzero(weight)
    weight = np.sqrt(weight[used])
    norm = np.sqrt((weight**2).sum()) or 1.0
    return (
        np.concatenate([np.arange(STATISTICS), used + STATISTICS]),
        np.concatenate([values, weight / norm]),
    )


class Machine:
    """Weights of the machine, and its scores in time linear in the features of a text."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def margin(self, places: np.ndarray, values: np.ndarray) -> float:
        weighted = self.factors[places] * values[:, None]
        total = weighted.sum(axis=0)
        pairs = 0.5 * float((total**2).sum() - (weighted**2).sum())
        return self.bias + float(self.linear[places] @ values) + pairs

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*features(text)), -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Adaptive gradient steps in a fixed order; without rows of both labels a constant machine."""
    size = STATISTICS + WORDS
    share = float(labels.mean()) if len(labels) else 0.5
    share = min(max(share, 0.01), 0.99)
    random = np.random.default_rng(7)
    linear, factors = np.zeros(size), random.normal(0, 0.02, (size, RANK))
    machine = Machine(float(np.log(share / (1 - share))), linear, factors)
    if len(set(labels.tolist())) < 2:
        machine.factors = np.zeros_like(factors)
        return machine
    past_linear, past_factors, past_bias = np.full(size, 1e-4), np.full((size, RANK), 1e-4), 1e-4
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            places, values = rows[i]
            weighted = factors[places] * values[:, None]
            total = weighted.sum(axis=0)
            pairs = 0.5 * float((total**2).sum() - (weighted**2).sum())
            margin = machine.bias + float(linear[places] @ values) + pairs
            slope = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[i]
            step = slope * values + 1e-5 * linear[places]
            past_linear[places] += step**2
            linear[places] -= 0.1 * step / np.sqrt(past_linear[places])
            step = slope * values[:, None] * (total - weighted) + 1e-5 * factors[places]
            past_factors[places] += step**2
            factors[places] -= 0.03 * step / np.sqrt(past_factors[places])
            past_bias += slope**2
            machine.bias -= 0.05 * slope / np.sqrt(past_bias)
    return machine


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("quality"),
             pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
             pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
            ["doc_id", "quality", "places", "values"],
        )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine from at most ``sample`` labelled rows outside the held-out fold.

    The rows are those with the smallest hashes of their ids, the same ones on every run. Their number
    bounds what is broadcast, and their features, not their texts, come to the driver. Of rows that
    share an id the one with the smallest text is learned from, so an id with very many rows still
    counts once.
    """
    usable = labels.selectExpr("cast(doc_id as long) doc_id", "cast(quality as int) quality").where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("doc_id")
    )
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    first = Window.partitionBy("doc_id").orderBy("text")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .withColumn("nth", F.row_number().over(first))
        .where("nth = 1")
        .select("doc_id", "quality", "text")
    )
    schema = "doc_id long, quality int, places array<int>, values array<float>"
    found = rows.mapInArrow(_featured, schema).toArrow().sort_by("doc_id")
    pairs = [
        (np.asarray(p, np.int64), np.asarray(v, np.float64))
        for p, v in zip(found["places"].to_numpy(), found["values"].to_numpy(), strict=True)
    ]
    return train(pairs, found["quality"].to_numpy().astype(np.float64))


_SCORED = "doc_id long, held_out boolean, score double, predicted int"


def _score(shared, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*shared.value)
        for batch in batches:
            found = np.array([machine.score(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()),
                 pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Every whole text is scored, a NULL or empty one by its structure statistics. Only ``text`` is read
    for a score. Without labels of both kinds all scores are equal. The weights, whose number is
    fixed, are broadcast.
    """
    machine = learn(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.linear, machine.factors)
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text"
    )
    return rows.mapInArrow(_score(shared, threshold), _SCORED)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(
        table(spark, folder, "documents").select("doc_id", "text"),
        table(spark, folder, "labels").select("doc_id", "quality"),
    )
