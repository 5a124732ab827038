"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three letters, words padded with a mark) in order.
A document's distance to a language is the sum, over the document's own profile, of how far out of
place each n-gram stands in the language's profile; an n-gram missing there counts as far as possible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.llm.rows import table, tidied

PROFILE = 300
UNKNOWN = "und"
FOLDS = 5
#: How far a text may lie below the lowest labelled one of its language, if its profile is full.
MARGIN = 0.05
#: Labelled texts so far below the next one do not speak for their language if they are outliers.
GAP = 0.08
#: Steps of scores in which labelled rows are counted.
_STEPS = 1000
#: Distinct n-grams that a task gathers before it passes their counts on.
_GATHERED = 1 << 20
_MARK = 1


def held_out(key: str, folds: int = FOLDS) -> Column:
    """True for the fold that nothing is learned from; a NULL id counts as empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % folds == 0


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str, letters: np.ndarray) -> np.ndarray:
    """All n-grams of a text, each as one integer: 21 bits per character."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[points]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    # Words keep one mark between them and one at either end.
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    points = np.where(is_letter, points, _MARK)[keep].astype(np.int64)
    mark = np.array([_MARK])
    head = [] if points[0] == _MARK else [mark]
    tail = [] if points[-1] == _MARK else [mark]
    points = np.concatenate([*head, points, *tail])
    two = points[:-1] << 21 | points[1:]
    three = (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[points[1:-1] != _MARK]
    return np.concatenate([points[points != _MARK], two, three])


def _count(letters_of):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letters_of()
        gathered: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush():
            for lang, parts in gathered.items():
                found, counts = _summed(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts)],
                    ["lang", "gram", "n"],
                )
            gathered.clear()

        held = 0
        for batch in batches:
            texts = zip(
                batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
            )
            of_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in texts:
                of_lang.setdefault(lang, []).append(grams(text, letters))
            for lang, parts in of_lang.items():
                pair = np.unique(np.concatenate(parts), return_counts=True)
                merged = _summed([*gathered.get(lang, []), pair])
                gathered[lang] = [merged]
            held = sum(len(p[0][0]) for p in gathered.values())
            if held > _GATHERED:
                yield from flush()
        yield from flush()

    return count


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    found, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(found), np.int64)
    np.add.at(counts, where, np.concatenate([p[1] for p in parts]))
    return found, counts


def learn_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE
) -> dict[str, list[int]]:
    """Each language's most frequent n-grams, most frequent first, ties to the smaller code.

    Counts cover every row with a text and a language. What reaches the driver is ``size`` n-grams for
    each language, however many documents there are.
    """
    rows = docs.selectExpr(f"`{lang}` lang", f"`{text}` text").where(
        "lang is not null and text is not null"
    )
    counted = rows.mapInArrow(tidied(_count(_letters)), "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("place", F.row_number().over(best)).where(F.col("place") <= size)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Classifier:
    """Out-of-place distances of one document to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(profiles), size
        self.known = np.unique(np.concatenate([[0], *profiles.values()]).astype(np.int64))
        self.ranks = np.full((len(self.langs), len(self.known)), -1, np.int64)
        for row, lang in enumerate(self.langs):
            places = np.searchsorted(self.known, profiles[lang])
            self.ranks[row, places] = np.arange(len(places))
        self.letters = _letters()

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, 1 - distance / largest possible distance)."""
        return self.judged(text)[:2]

    def judged(self, text: str | None) -> tuple[str, float, int]:
        """(language, score, number of distinct n-grams that the score rests on)."""
        codes = grams(text, self.letters) if text else ()
        if len(codes) == 0 or not self.langs:
            return UNKNOWN, 0.0, 0
        found, counts = np.unique(codes, return_counts=True)
        own = found[np.lexsort((found, -counts))[: self.size]]
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        ranks = np.where(self.known[at] == own, self.ranks[:, at], -1)
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))))
        total = apart.sum(axis=1)
        best = int(total.argmin())
        return self.langs[best], float(1 - total[best] / (self.size * len(own))), len(own)


_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def _predict(profiles: dict[str, list[int]], size: int):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(profiles, size)
        for batch in batches:
            found = [classifier.predict(t) for t in batch.column("text").to_pylist()]
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                [*rest.schema.names, "lang_pred", "score"],
            )

    return predict


def identify(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    size: int = PROFILE,
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred`` and ``score`` from 0 to 1.

    Learns from rows that are not held out and have a text and a language. ``und`` with score 0 where
    the text is NULL or has no letter, or where nothing could be learned. Repeated rows get equal
    results; other columns are not read.
    """
    profiles = learn_profiles(docs.where(~held_out(key)), text, lang, size)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        held_out(key).alias("held_out"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(tidied(_predict(profiles, size)), _PREDICTED)


def verdict(
    profiles: dict[str, list[int]], text: Column, size: int = PROFILE
) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``n_grams`` for a text; the row itself stays in the JVM.

    ``n_grams`` counts the distinct n-grams that the score rests on, ``size`` at most.
    """

    @tidied
    def judged(texts):
        classifier = Classifier(profiles, size)
        for batch in texts:
            found = [classifier.judged(t) for t in batch.to_pylist()]
            columns = zip(*found, strict=True) if found else [[]] * 3
            kinds = [pa.string(), pa.float64(), pa.int64()]
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["lang_pred", "score", "n_grams"],
            )

    @F.arrow_udf("struct<lang_pred:string,score:double,n_grams:long>")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return judged(texts)

    return judge(text)


def evened(judged: str, size: int = PROFILE) -> Column:
    """The score of a ``verdict``, raised the more the fewer n-grams it rests on; 1 at most.

    A text of ``size`` n-grams keeps its score. With half of them it gets one ``MARGIN``, with a tenth
    nine: chance moves the scores of short texts, and too little of them is seen to call them foreign.
    """
    score, seen = F.col(f"{judged}.score"), F.col(f"{judged}.n_grams")
    return F.least(score + MARGIN * (size / F.greatest(seen, F.lit(1)) - 1), F.lit(1.0))


def _stepped(labelled: DataFrame, judged: str, size: int) -> DataFrame:
    """How many rows have each predicted language and step of their evened score.

    Nothing is filtered here, not even ``UNKNOWN``: Spark moves a filter below the verdict's own
    projection, and then asks Python twice for each text, in two worker processes per task.
    """
    step = F.floor(evened(judged, size) * _STEPS).cast("long").alias("step")
    lang = F.col(f"{judged}.lang_pred").alias("lang_pred")
    return labelled.select(lang, step).groupBy("lang_pred", "step").count()


def least_scores(labelled: DataFrame, judged: str, size: int = PROFILE) -> dict[str, float]:
    """Per predicted language, the evened score from which on a text counts as one in it.

    That is ``MARGIN`` below the lowest of the ``labelled`` rows, by their ``verdict``. Some texts
    with a wrong label must not open a language to foreign ones: outliers (1.5 interquartile ranges
    below the lower quartile) that stand more than ``GAP`` below the next row do not count, nor
    does what is below them. Rows are counted by steps of their scores, rounded down: a fixed number
    of counts for each language reaches the driver.
    """
    steps: dict[str, list[tuple[int, int]]] = {}
    for row in _stepped(labelled, judged, size).orderBy("lang_pred", "step").collect():
        if row["lang_pred"] != UNKNOWN:
            steps.setdefault(row["lang_pred"], []).append((row["step"], row["count"]))
    least = {}
    for lang, pairs in steps.items():
        at, number = np.array(pairs).T
        upto = np.cumsum(number)
        low, high = at[np.searchsorted(upto, upto[-1] * np.array([0.25, 0.75]))]
        alone = (np.diff(at) > GAP * _STEPS) & (at[:-1] < low - 1.5 * (high - low))
        lowest = at[np.flatnonzero(alone)[-1] + 1] if alone.any() else at[0]
        least[lang] = float(lowest / _STEPS - MARGIN)
    return least


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
