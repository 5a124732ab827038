"""Phrase collocations by Misra-Gries summaries of hash partitions and an exact second pass.

First pass. Every phrase of up to ``LONGEST`` words is hashed, with its language, and its hash lies in
one partition of the hash range. Tasks count what they read and pass on, for each partition, one packed
row of sorted hashes and counts. A partition's rows are merged into one Misra-Gries summary: beyond its
capacity, the smallest counts are taken off all of them. What was taken off in sum is the error, and a
summary never lets it pass half of the threshold, so every phrase that occurs ``LEAST`` times is still
there. Its capacity follows from the mass of the partition divided by that error.

Second pass. What survives sets bits of a filter of bounded size, phrases that hit it are counted
exactly by their text, and what falls short of the threshold goes. Hash collisions and a crowded filter
can only let more phrases through to the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.llm.rows import table, tidied
from kontor.session import materialise

LONGEST = 4
LEAST = 30
#: A phrase is no collocation if a longer one makes up this share of it, in hundredths.
COVERED = 80
SCALE = 2_000_000
TOP = 2_000
UNKNOWN = "und"
#: Phrase occurrences of one summary, at most and about: bytes of text stand for the words in them.
PARTITION_MASS = 24 << 20
#: Hashes that a task gathers before it passes them on, and words it hashes at once.
_GATHERED = 3 << 20
_TOKENS = 1 << 18
#: Bytes of a text that are cut into words at once.
_BLOCK = 1 << 20
#: Bits of the filter of the second pass, as powers of two: for each survivor, and at most (16 MB).
_SPARSE, _LEAST_BITS, _MOST_BITS = 5, 18, 27
#: Words that a task remembers, and the bytes of such a word at most: 50 MB.
_REMEMBERED, _SHORT = 200_000, 64

_STOP = b"."
_PIECES = b".,;:!?\n\x0b\x0c\r"
_NORMAL = bytes(range(256)).lower().translate(
    bytes.maketrans(_PIECES + b"\t", _STOP * len(_PIECES) + b" ")
)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class _Hashes(dict):
    """The 64-bit hash of a word; that of the mark between pieces is 0, and no other's is."""

    def __missing__(self, word: bytes) -> int:
        value = (xxhash.xxh3_64_intdigest(word) or 1) if word != _STOP else 0
        if len(word) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = value
        return value


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Lists of words, with the mark in place of each delimiter; no word is cut."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _BLOCK)
        end = len(raw) if end < 0 else end
        yield raw[at:end].replace(_STOP, b" . ").split()
        at = end


class Block:
    """Some words of a stream of texts, and all phrases that end in them."""

    def __init__(self, words: list[bytes], langs: list[str], lang_of: np.ndarray, new: int, hashes):
        self.words, self.langs, self.lang_of, self.new = words, langs, lang_of, new
        self.of_word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        named = np.array([xxhash.xxh3_64_intdigest(f"lang {x}") for x in langs], np.uint64)
        self.salt = named[lang_of]

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first words, hashes) of all phrases within pieces."""
        inside = self.of_word != 0
        total = _mixed(self.of_word ^ self.salt)
        for size in range(1, longest + 1):
            if size > 1:
                inside = inside[:-1] & (self.of_word[size - 1 :] != 0)
                total = _mixed(total[:-1] * _FACTORS[0] + self.of_word[size - 1 :])
            at = np.flatnonzero(inside)
            at = at[at >= len(self.words) - self.new - size + 1]
            yield size, at, total[at]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _FACTORS[1]
    return values ^ (values >> np.uint64(29))


def blocks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[Block]:
    """The words of all rows as one stream in blocks; each begins with the last words of the one before."""
    hashes = _Hashes()
    words: list[bytes] = []
    langs: list[str] = []
    sizes: list[int] = []
    carried = 0

    def block() -> Block:
        lang_of = np.repeat(np.arange(len(langs)), sizes)
        return Block(words, langs, lang_of, len(words) - carried, hashes)

    for batch in batches:
        rows = zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
        for lang, text in rows:
            for part in words_of(text):
                langs.append(lang)
                sizes.append(len(part))
                words += part
                if len(words) >= _TOKENS:
                    yield block()
                    carried = min(longest - 1, len(words))
                    words, langs, sizes = words[len(words) - carried :], [lang], [carried]
            langs.append(lang)
            sizes.append(1)
            words.append(_STOP)
    if len(words) > carried:
        yield block()


def packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes as differences, and their counts, by places of bytes; most places are all zero."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    planes = [v.astype("<u8").view(np.uint8).reshape(-1, 8).T for v in (gaps, counts)]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    gaps, counts = (
        np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes.reshape(2, 8, -1)
    )
    return np.cumsum(gaps, dtype=np.uint64), counts.astype(np.int64)


class Summary:
    """A mergeable Misra-Gries summary: counts of hashes, each too small by at most ``error``."""

    def __init__(self, capacity: int, most_error: int):
        self.capacity, self.most_error, self.error = capacity, most_error, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((hashes, counts))
        self._held += len(hashes)
        if self._held > self.capacity:
            self.merge()

    def merge(self) -> None:
        """Counts what waits, and brings the counters back to the capacity as far as the error allows."""
        parts = [(self.hashes, self.counts), *self._waiting]
        self._waiting, self._held = [], 0
        hashes, counts = (np.concatenate([p[i] for p in parts]) for i in range(2))
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
        self.hashes = hashes[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts
        spare = len(self.hashes) - self.capacity
        if spare > 0:
            # The largest count that does not fit is taken off all of them.
            off = int(np.partition(self.counts, spare - 1)[spare - 1])
            off = min(off, self.most_error - self.error)
            left = self.counts > off
            self.hashes, self.counts = self.hashes[left], self.counts[left] - off
            self.error += off

    def survivors(self, least: int) -> np.ndarray:
        """Hashes of whatever can have occurred ``least`` times."""
        self.merge()
        return self.hashes[self.counts + self.error >= least]


def _gather(partitions: int, bits: int, longest: int):
    """Counts of a task's phrases, one packed row for each partition of the range of hashes."""
    width = -(-(1 << bits) // partitions)

    def rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(held)
        held.clear()
        hashes >>= np.uint64(64 - bits)
        hashes.sort()
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        counts, hashes = np.diff(first, append=len(hashes)), hashes[first]
        del first
        edges = np.arange(1, partitions, dtype=np.uint64) * np.uint64(width)
        bounds = [0, *np.searchsorted(hashes, edges).tolist(), len(hashes)]
        for number, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if end > start:
                raw = packed(hashes[start:end], counts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([raw], pa.binary())],
                    ["part", "summary"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in blocks(batches, longest):
            for _, _, hashes in block.phrases(longest):
                held.append(hashes)
                size += len(hashes)
            if size >= _GATHERED:
                yield from rows(held)
                size = 0
        if size:
            yield from rows(held)

    return gather


def _merge(capacity: int, least: int):
    """Survivors of each partition; its rows follow one another."""

    def of(summary: Summary) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(summary.survivors(least).view(np.int64))], ["h"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, summary = None, None
        for batch in batches:
            parts = zip(batch.column("part").to_pylist(), batch.column("summary"), strict=True)
            for part, raw in parts:
                if part != now:
                    if summary:
                        yield of(summary)
                    now, summary = part, Summary(capacity, least // 2)
                summary.add(*unpacked(raw.as_py()))
        if summary:
            yield of(summary)

    return merge


def survivors(rows: DataFrame, longest: int, least: int) -> tuple[DataFrame, int]:
    """Hashes ``h`` (of so many bits) of phrases that may occur ``least`` times, and of all that do."""
    # A word and its blank take two bytes at least, and as many phrases as ``longest`` end in it.
    mass = (rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0) * longest // 2 + 1
    partitions = max(1, -(-mass // PARTITION_MASS))
    bits = min(62, max(32, mass.bit_length() + 10))
    # The summary's error stays below least / 2 as long as this many counters share the mass.
    capacity = 2 * -(-mass // (partitions * least)) + 1
    packed_rows = rows.mapInArrow(tidied(_gather(partitions, bits, longest)), "part int, summary binary")
    merged = (
        packed_rows.repartition(partitions, "part")
        .sortWithinPartitions("part")
        .mapInArrow(tidied(_merge(capacity, least)), "h long")
    )
    return materialise(merged, "surviving-phrases"), bits


def filter_of(found: DataFrame) -> tuple[np.ndarray, int]:
    """A filter with a bit for each hash, of at most 16 MB whatever their number; and its bits."""
    count = found.count()
    bits = min(_MOST_BITS, max(_LEAST_BITS, count.bit_length() + _SPARSE))
    place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    pages = (
        found.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    )
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for row in pages.toLocalIterator():
        page = np.frombuffer(row["bitmap"], np.uint8)
        start = (row["page"] - 1) * len(page)
        whole[start : start + len(page)] = page[: len(whole) - start]
    return whole, bits


def _count(shared, longest: int):
    """Exact counts, per block, of the phrases that hit the filter, and of all words (size 0)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits, hash_bits = shared.value
        for block in blocks(batches, longest):
            langs, phrases, sizes, counts = [], [], [], []
            fresh = np.arange(len(block.words)) >= len(block.words) - block.new
            of_lang = np.bincount(block.lang_of[fresh & (block.of_word != 0)], minlength=len(block.langs))
            for lang in set(block.langs):
                total = sum(n for n, x in zip(of_lang.tolist(), block.langs, strict=True) if x == lang)
                langs, phrases, sizes = [*langs, lang], [*phrases, b""], [*sizes, 0]
                counts.append(total)
            for size, at, hashes in block.phrases(longest):
                place = (hashes >> np.uint64(64 - hash_bits)) & np.uint64((1 << bits) - 1)
                kept = bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
                at, hashes = at[kept == 1], hashes[kept == 1]
                _, first, number = np.unique(hashes, return_index=True, return_counts=True)
                starts = at[first].tolist()
                langs += [block.langs[i] for i in block.lang_of[at[first]].tolist()]
                phrases += [b" ".join(block.words[i : i + size]) for i in starts]
                sizes += [size] * len(starts)
                counts += number.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                 pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())],
                ["lang", "phrase", "size", "f"],
            )

    return count


def phrase_counts(rows: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``size`` and ``f`` of all phrases that occur ``least`` times, exactly.

    ``rows`` have lang and text, neither of them NULL. Rows of size 0 hold the number of all words.
    """
    found, hash_bits = survivors(rows, longest, least)
    bitmap, bits = filter_of(found)
    shared = rows.sparkSession.sparkContext.broadcast((bitmap, bits, hash_bits))
    counted = rows.mapInArrow(
        tidied(_count(shared, longest)), "lang string, phrase string, size int, f long"
    )
    totals = counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return materialise(
        totals.where((F.col("f") >= least) | (F.col("size") == 0)), "frequent-phrases"
    )


def _cuts(candidates: DataFrame) -> DataFrame:
    """Each candidate cut after its first ``k`` words, for every ``k``."""
    return candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Phrases lie within pieces of one row's text. A NULL text is empty, a NULL language ``und``; texts
    without words count nothing. Repeated rows count as often as they are there. Other columns are not
    read. Ties in score and count go to the phrase that is smaller by its UTF-8 bytes.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return ranked(phrase_counts(rows, longest, least), covered, top)


def ranked(frequent: DataFrame, covered: int, top: int) -> DataFrame:
    """The collocations among counted phrases, each language's best ones in order."""
    candidates = frequent.where("size > 1")
    names = F.split("phrase", " ")
    # Every phrase inside a longer candidate, with the count of the most frequent such one.
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), "
        "i -> array_join(slice(names, i, s), ' '))))"
    )
    longer = (
        candidates.where("size > 2").withColumn("names", names)
        .select("lang", F.explode(inner).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    kept = (
        candidates.join(longer, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("f")))
    )
    part = frequent.where("size > 0")
    left = part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr(
        f"cast(cast(a as decimal(20, 0)) * {SCALE} div (cast(l as decimal(20, 0)) + r) as long)"
    )
    scored = (
        _cuts(kept).join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    placed = scored.withColumn("rank", F.row_number().over(best).cast("long"))
    total = frequent.where("size = 0").select("lang", F.col("f").alias("n"))
    return placed.where(F.col("rank") <= top).join(total, "lang").select(
        "lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents").select("text", "lang"))


OP13_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from worded group by lang),
grams as (
    select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
          from worded, range(1, 5) s(size) where len(w) >= size)
),
freq as (
    select lang, phrase, size, count(*) as f from grams group by all having count(*) >= 30
),
cand as (select *, string_split(phrase, ' ') as w from freq where size > 1),
inner_phrases as (
    select lang, f, array_to_string(w[i:i + s - 1], ' ') as phrase
    from (select *, unnest(range(1, size - s + 2)) as i from cand, range(2, 4) t(s) where s < size)
),
longer as (select lang, phrase, max(f) as longest from inner_phrases group by all),
kept as (
    select c.* from cand c left join longer o on c.lang = o.lang and c.phrase = o.phrase
    where o.longest is null or 100 * o.longest < 80 * c.f
),
cuts as (
    select c.lang, c.phrase, c.f as a, k, l.f as l, r.f as r,
           cast((2000000::hugeint * c.f) // (l.f + r.f) as bigint) as score
    from (select *, unnest(range(1, size)) as k from kept) c
    join freq l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.k], ' ')
    join freq r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')
),
weakest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from weakest
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
