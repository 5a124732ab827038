"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Normalised: ASCII letters in lower case, and every other ASCII character that is no digit a blank. That
maps a text's UTF-8 bytes one to one, so a word has the same offsets before and after. Items are cut
into windows of ``WINDOW`` words, fewer words being one window. The automaton's keys are windows, its
letters are words: one character for each word that occurs in an item, and one for all other words.
A text is scanned once, in blocks over which the automaton keeps its state.

The items of a scan are a shard of bounded size; larger benchmarks are scanned for shard by shard, so a
task never holds more than one automaton. Documents that hit nothing are never shuffled. Which items a
set of windows stands for is looked up once per distinct set, and equal lists of items are one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import KEY, row_key, sized, table, tidied
from kontor.session import materialise

WINDOW = 10
#: Words of an item's segment; longer items are cut, with the overlap that their windows need.
SEGMENT = 4_096
#: Words of the segments that one automaton holds, about; a word costs about 1 KB in a task.
SHARD_WORDS = 200_000
#: Bytes of a text that are scanned at once.
_BLOCK = 1 << 20
_OTHER = "\0"
_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_NORMAL = bytes(c if c in _WORD_BYTES else 0x20 for c in bytes(range(256)).lower())

_SCANNED = (
    "doc_id long, k1 long, k2 long, n_words long, "
    "hits array<struct<word:long,start:long,end:long>>, windows array<binary>"
)
_SPANS = "array<struct<start:long,end:long>>"
_SCANNED_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.list_(pa.struct([("word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])),
    pa.list_(pa.binary()),
]


def normalised(text: str | None) -> bytes:
    """As many bytes as the text has in UTF-8; words are what blanks part."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL)


def windows(words: list[bytes], size: int) -> Iterator[tuple[int, bytes]]:
    """(first word, name) of each window; a name is a 128-bit hash of its words."""
    if words:
        for at in range(max(1, len(words) - size + 1)):
            yield at, xxhash.xxh3_128_digest(b" ".join(words[at : at + size]))


def _segments(size: int):
    step = SEGMENT - size + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2)]
            out = []
            for item, text in zip(*columns, strict=True):
                words = normalised(text).split()
                for at in range(0, max(len(words) - size, 0) + 1, step) if words else ():
                    part = words[at : at + SEGMENT]
                    out.append((item, b" ".join(part), len(part)))
            columns = zip(*out, strict=True) if out else [[]] * 3
            kinds = [pa.string(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["item", "segment", "words"],
            )

    return cut


def _named(size: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, names = [], []
            columns = [batch.column(i).to_pylist() for i in range(2)]
            for item, segment in zip(*columns, strict=True):
                found = {name for _, name in windows(segment.split(), size)}
                items += [item] * len(found)
                names += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(names, pa.binary())], ["item", "window"]
            )

    return name


class Automaton:
    """The windows of some normalised items, ready to be looked for in a text."""

    def __init__(self, segments: list[bytes], size: int = WINDOW):
        import ahocorasick

        self.letters: dict[bytes, str] = {}
        self.keys = ahocorasick.Automaton()
        for segment in segments:
            words = segment.split()
            letters = "".join([self._letter(w) for w in words])
            for at, name in windows(words, size):
                key = letters[at : at + size]
                self.keys.add_word(key, (len(key), name))
        self.keys.make_automaton()

    def _letter(self, word: bytes) -> str:
        number = len(self.letters) + 1
        # Surrogates are no characters; the automaton's alphabet ends where Unicode does.
        return self.letters.setdefault(word, chr(number + 0x800 * (number >= 0xD800)))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, int]], list[bytes]]:
        """(number of words, hit words with their code points in the text, names of the windows)."""
        raw = normalised(text)
        count, found = 0, []
        state = self.keys.iter("") if self.letters else None
        for block in _blocks(raw):
            words = block.split()
            count += len(words)
            if state is not None:
                state.set("".join(map(self.letters.get, words, repeat(_OTHER))))
                found += state
        if not found:
            return count, [], []
        change = np.zeros(count + 1, np.int64)
        ends, values = zip(*found, strict=True)
        ends = np.array(ends) + 1
        np.add.at(change, ends - [size for size, _ in values], 1)
        np.add.at(change, ends, -1)
        hit = np.flatnonzero(np.cumsum(change)[:-1])
        starts, stops = _places(text, raw)
        triples = zip(hit.tolist(), starts[hit].tolist(), stops[hit].tolist(), strict=True)
        return count, list(triples), sorted({name for _, name in values})


def _blocks(raw: bytes) -> Iterator[bytes]:
    """The text in blocks that end between words."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _BLOCK)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def _places(text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last code point (exclusive) of each word of the original text."""
    inside = np.frombuffer(b" " + raw + b" ", np.uint8) != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not text.isascii():
        leads = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) & 0xC0 != 0x80
        edges = np.concatenate([[0], np.cumsum(leads)])[edges]
    return edges[::2], edges[1::2]


def _scan(shared, size: int, all_rows: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(shared.value, size)
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("doc_id", *KEY, "text")]
            for *names, text in zip(*columns, strict=True):
                count, hits, found = automaton.scan(text)
                if all_rows or hits:
                    out.append((*names, count, hits, found))
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, _SCANNED_TYPES, strict=True)],
                ["doc_id", *KEY, "n_words", "hits", "windows"],
            )

    return scan


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit``, ``spans``, ``items`` and the row key.

    A word is hit if it lies in an occurrence of a window. ``spans`` are maximal runs of hit words as
    (start, end) in code points of the original text; ``items`` are the ids of all items of which a
    window occurs, as sorted strings. NULL, empty and wordless texts have no words and hit nothing, on
    either side. Items that repeat, in id or in text, count once per id; the words of an item with a
    NULL id are hit, but it is not listed. Repeated rows get equal results. Other columns are not read.

    A list of items is as long as the result demands: only items that share a window share a row.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), *row_key(key, text), F.col(text).alias("text")
    )
    tests = benchmark.select(
        F.col(item_key).cast("string").alias("item"), F.col(item_text).alias("text")
    )
    segments = materialise(
        tests.mapInArrow(_segments(size), "item string, segment binary, words long"), "segments"
    )
    owners = materialise(
        segments.select("item", "segment")
        .mapInArrow(_named(size), "item string, window binary")
        .groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("ids"))
        .withColumn("list", F.sha2(F.array_join("ids", ","), 256)),
        "window-owners",
    )
    scanned = _scanned(rows, segments, size)
    found = _found(scanned)
    items = _items(found, owners)
    return (
        scanned.where("shard = 0").select("doc_id", *KEY, "n_words")
        .join(found.select(*KEY, "n_hit", "spans", "set"), KEY, "left")
        .join(sized(items, F.size("items")), "set", "left")
        .select(
            "doc_id",
            *KEY,
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _scanned(rows: DataFrame, segments: DataFrame, size: int) -> DataFrame:
    """Every row with its hits in the first shard of items, and the rows that hit another one."""
    distinct = segments.groupBy("segment").agg(F.first("words").alias("words"))
    total = distinct.agg(F.sum("words")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("segment"), F.lit(shards))
    scans = []
    for number in range(shards):
        held = distinct.where(shard == number).select("segment").orderBy("segment").collect()
        shared = rows.sparkSession.sparkContext.broadcast([bytes(r.segment) for r in held])
        scan = rows.mapInArrow(tidied(_scan(shared, size, number == 0)), _SCANNED)
        scans.append(scan.withColumn("shard", F.lit(number)))
    return materialise(reduce(DataFrame.unionByName, scans), "scanned")


def _found(scanned: DataFrame) -> DataFrame:
    """One row for each row key with hits: their number and spans, its windows and their name."""
    gathered = lambda name: F.array_sort(F.array_distinct(F.flatten(F.collect_list(name))))
    return materialise(
        scanned.where(F.size("hits") > 0)
        .dropDuplicates([*KEY, "shard"])
        .groupBy(*KEY)
        .agg(gathered("hits").alias("hits"), gathered("windows").alias("windows"))
        .select(
            *KEY,
            F.size("hits").cast("long").alias("n_hit"),
            _spans().alias("spans"),
            "windows",
            F.sha2(F.array_join(F.transform("windows", F.hex), ","), 256).alias("set"),
        ),
        "found",
    )


def _items(found: DataFrame, owners: DataFrame) -> DataFrame:
    """``set`` and ``items``: the sorted ids of the items that a set of windows stands for."""
    sets = found.groupBy("set").agg(F.first("windows").alias("windows"))
    lists = owners.groupBy("list").agg(F.first("ids").alias("ids"))
    named = (
        sets.select("set", F.explode("windows").alias("window"))
        .join(sized(owners.select("window", "list")), "window")
        .select("set", "list").distinct()
    )
    return materialise(
        named.join(lists, "list")
        .groupBy("set")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items")),
        "items-of-sets",
    )


def _spans() -> Column:
    """Runs of hit words that follow one another."""
    word = lambda at: F.get("hits", at)["word"]
    first = F.filter("hits", lambda h, i: (i == 0) | (word(i - 1) < h["word"] - 1))
    last = F.filter("hits", lambda h, i: (i == F.size("hits") - 1) | (word(i + 1) > h["word"] + 1))
    return F.zip_with(
        first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end"))
    )


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP12_SQL = r"""
with words as (
    select doc_id, row_number() over () as r,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
),
items as (
    select item_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
),
item_windows as (
    select distinct item_id, least(len(w), 10) as size,
           array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
    from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
),
sizes as (select distinct size from item_windows),
doc_windows as (
    select r, i, size, array_to_string(w[i:i + size - 1], ' ') as win
    from (select *, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size)
),
hits as (
    select d.r, d.i, d.size, t.item_id from doc_windows d join item_windows t
    on d.size = t.size and d.win = t.win
),
hit_words as (
    select r, count(distinct word) as n_hit
    from (select r, unnest(range(i, i + size)) as word from (select distinct r, i, size from hits))
    group by r
),
hit_items as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as ids
    from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null)
    group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from words left join hit_words using (r) left join hit_items using (r)
"""
