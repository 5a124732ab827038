"""Suffix-array dedup: remove every byte that lies in a long string which also starts elsewhere.

Plan
1. Each text is cut at content-defined anchors: of the half-length strings inside a window of
   ``min_bytes``, the one with the smallest hash. Windows with the same anchor form a run. Equal
   windows have equal anchors, so a run whose anchor occurs once in the corpus holds no repeat; that
   settles most of the corpus with one narrow, map-side combined count.
2. Runs that occur identically more than once are repeated as a whole. This too is a count, so a
   passage that a third of all documents share is never gathered.
3. The remaining runs share an anchor and differ somewhere. Their distinct texts go to shards by
   anchor; each shard builds its suffix array by induced sorting, and permuted common prefixes tell
   which windows agree in ``min_bytes`` bytes. An anchor with more than ``SPLIT`` different runs is
   spread over several shards, and the windows of those are counted across shards by a 128-bit hash.
4. The removed ranges go back to their documents.

Nothing is compared in pairs, and no group is gathered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import KEY, hand_back, row_key, table, tidied
from kontor.llm.suffix_arrays import common_prefixes, suffix_array
from kontor.session import materialise

MIN_BYTES = 400
#: Bytes of text per suffix array.
SHARD_BYTES = 1 << 19
#: Different runs of one anchor per shard, and windows per run.
SPLIT = 2048
LONGEST_RUN = 2048
#: Bytes whose anchors are looked for at once, and bytes of text that leave a task in one batch; a
#: longer text is taken alone.
_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_RUNS = "k1 long, k2 long, start long, wins long, a long, g long, multi boolean"


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


class _Anchors:
    """Runs of windows by anchor, for many texts at once."""

    def __init__(self, min_bytes: int):
        self.window = min_bytes
        self.gram = max(1, min_bytes // 2)
        self._grow(_BLOCK)

    def _grow(self, count: int) -> None:
        self.up = _powers(_BASE, count)
        self.down = _powers(pow(_BASE, -1, 2**64), count)

    def runs(self, data: np.ndarray, offsets: np.ndarray):
        """(text, start in the text, windows, anchor hash, anchor occurs again) per run."""
        size, gram = len(data), self.gram
        grams = size - gram + 1
        windows = size - self.window + 1
        if windows < 1:
            return None
        if size > len(self.up):
            self._grow(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:size], out=sums[1:])
        hashes = (sums[gram:] - sums[:-gram]) * self.down[:grams]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        # The low bits carry the place, so of equal hashes the leftmost is taken.
        bits = np.uint64(max(1, (grams - 1).bit_length()))
        marked = ((hashes >> bits) << bits) | np.arange(grams, dtype=np.uint64)
        span = grams - windows + 1
        padded = np.full(-(-grams // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:grams] = marked
        grid = padded.reshape(-1, span)
        onward = np.minimum.accumulate(grid, axis=1).ravel()
        backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        smallest = np.minimum(backward[:windows], onward[span - 1 : span - 1 + windows])
        place = (smallest & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)

        begins, ends = offsets[:-1], offsets[1:] - self.window + 1
        change = np.ones(windows, bool)
        change[1:] = place[1:] != place[:-1]
        edges = np.concatenate([begins, np.maximum(ends, begins)])
        change[edges[edges < windows]] = True
        start = np.flatnonzero(change)
        stop = np.append(start[1:], windows)
        text = np.searchsorted(offsets, start, "right") - 1
        inside = start < ends[text]
        start, stop, text = start[inside], stop[inside], text[inside]
        if len(start) == 0:
            return None
        anchor = hashes[place[start]]
        fresh = np.ones(len(start), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(start)) - 1
        start, stop, text, anchor = start[first], stop[last], text[first], anchor[first]
        multi = last > first
        parts = -(-(stop - start) // LONGEST_RUN)
        if parts.max() > 1:
            whole = np.repeat(np.arange(len(start)), parts)
            nth = np.arange(len(whole)) - np.repeat(np.cumsum(parts) - parts, parts)
            begin = start[whole] + nth * LONGEST_RUN
            stop = np.minimum(stop[whole], begin + LONGEST_RUN)
            start, text, anchor, multi = begin, text[whole], anchor[whole], multi[whole]
        return text, start, stop - start, anchor.view(np.int64), multi


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[first] + _BLOCK, "right")) - 1
        end = max(end, first + 1)
        yield first, end
        first = end


def _find_runs(min_bytes: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(min_bytes)
        for batch in batches:
            data, offsets = _bytes_of(batch.column(2))
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            for first, end in _blocks(offsets):
                part = data[offsets[first] : offsets[end]]
                found = anchors.runs(part, offsets[first : end + 1] - offsets[first])
                if found is None:
                    continue
                text, start, wins, anchor, multi = found
                raw = part.tobytes()
                stops = start + (wins + (min_bytes - 1))
                digest = xxhash.xxh3_64_intdigest
                content = [
                    digest(raw[a:b]) for a, b in zip(start.tolist(), stops.tolist(), strict=True)
                ]
                columns = [
                    keys[0][first + text],
                    keys[1][first + text],
                    start - (offsets[first + text] - offsets[first]),
                    wins,
                    anchor,
                    np.array(content, np.uint64).view(np.int64),
                    multi,
                ]
                names = ["k1", "k2", "start", "wins", "a", "g", "multi"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return find


def _listed(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Where each row's entries begin and end, and the entries of all rows, of a list of structs."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def _cut(min_bytes: int):
    """The text of the runs listed with each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges, runs = _listed(batch.column("runs"))
            starts, wins = (runs.field(n).to_numpy() for n in ("start", "wins"))
            stops = starts + wins + (min_bytes - 1)
            owner = np.repeat(np.arange(len(batch)), np.diff(edges))
            # Runs overlap, so together they are several times as long as their texts.
            upto = np.cumsum(stops - starts)
            first, raw, held = 0, b"", -1
            while first < len(owner):
                done = upto[first - 1] if first else 0
                end = max(int(np.searchsorted(upto, done + _BLOCK, "right")), first + 1)
                part, texts = slice(first, end), []
                for i in range(first, end):
                    if owner[i] != held:
                        held = owner[i]
                        raw = (batch.column("text")[held].as_py() or "").encode()
                    texts.append(raw[starts[i] : stops[i]])
                keys = [batch.column(k).take(pa.array(owner[part])) for k in KEY]
                rest = [runs.field(n)[part] for n in ("start", "shard", "split")]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *rest, pa.array(texts, pa.binary())], schema=_CUT
                )
                first = end

    return cut


_CUT = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("shard", pa.int64()),
     ("split", pa.bool_()), ("run", pa.binary())]
)
_RANGES = "k1 long, k2 long, start long, wins long, w1 long, w2 long"


def _repeats_in_shard(min_bytes: int):
    """Ranges of windows that repeat inside a shard; of split anchors, also each window by hash."""

    def repeats(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            return found_in(rows)
        finally:
            hand_back()

    def found_in(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["k1", "k2", "start"], ignore_index=True)
        lengths = rows["run"].str.len().to_numpy()
        # A separator above all bytes ends each run.
        text = np.full(int(lengths.sum()) + len(rows), 256, np.uint16)
        begins = np.cumsum(lengths + 1) - lengths - 1
        for begin, run in zip(begins, rows["run"], strict=True):
            text[begin : begin + len(run)] = np.frombuffer(run, np.uint8)
        wins = lengths - (min_bytes - 1)
        owner = np.full(len(text), -1, np.int64)
        for i, (begin, count) in enumerate(zip(begins, wins, strict=True)):
            owner[begin : begin + count] = i
        array = suffix_array(text)
        shared = common_prefixes(text, array)
        # Classes of equal windows are stretches of the array with common prefixes that long.
        stretch = np.cumsum(shared < min_bytes)
        window = owner[array] >= 0
        at, stretch = array[window], stretch[window]
        _, kind, count = np.unique(stretch, return_inverse=True, return_counts=True)
        repeated = np.zeros(len(text), bool)
        repeated[at[count[kind] > 1]] = True

        edge = np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        run = owner[first]
        found = {
            "k1": rows["k1"].to_numpy()[run],
            "k2": rows["k2"].to_numpy()[run],
            "start": rows["start"].to_numpy()[run] + first - begins[run],
            "wins": last - first,
        }
        result = pd.DataFrame(found).assign(w1=pd.NA, w2=pd.NA)
        split = rows["split"].to_numpy()
        if split.any():
            _, lead = np.unique(stretch, return_index=True)
            lead = at[lead]
            lead = lead[split[owner[lead]]]
            run = owner[lead]
            texts, inside = rows["run"].to_numpy(), lead - begins[run]
            hashes = [
                hashlib.blake2b(texts[r][i : i + min_bytes], digest_size=16).digest()
                for r, i in zip(run, inside, strict=True)
            ]
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            single = {
                "k1": rows["k1"].to_numpy()[run],
                "k2": rows["k2"].to_numpy()[run],
                "start": rows["start"].to_numpy()[run] + inside,
                "wins": 1,
                "w1": halves[:, 0],
                "w2": halves[:, 1],
            }
            result = pd.concat([result, pd.DataFrame(single)])
        return result.astype({"w1": "Int64", "w2": "Int64"})

    return repeats


_KEPT = {
    "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
    "kept": pa.binary(), "kept_text": pa.string(),
}


def _spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches that some ranges cover; ranges that touch are one."""
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(stop[by])
    apart = np.flatnonzero(start[1:] > reach[:-1])
    return start[np.append(0, apart + 1)], reach[np.append(apart, len(reach) - 1)]


def _remove(min_bytes: int, names: list[str]):
    """The columns ``names`` of ``_KEPT`` for each document with ranges to remove."""
    schema = pa.schema([(k, pa.int64()) for k in KEY] + [(n, _KEPT[n]) for n in names])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges, ranges = _listed(batch.column("ranges"))
            starts, wins = (ranges.field(n).to_numpy() for n in ("start", "wins"))
            stops = starts + wins + (min_bytes - 1)
            first, held = 0, 0
            out: dict[str, list] = {n: [] for n in names}
            for i in range(len(batch)):
                own = slice(edges[i], edges[i + 1])
                raw = (batch.column("text")[i].as_py() or "").encode()
                begins, ends = _spans(starts[own], stops[own])
                stay = zip([0, *ends.tolist()], [*begins.tolist(), len(raw)], strict=True)
                kept = b"".join([raw[a:b] for a, b in stay])
                if "n_removed" in out:
                    out["n_removed"].append(len(raw) - len(kept))
                if "n_spans" in out:
                    out["n_spans"].append(len(begins))
                if "kept_sha256" in out:
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if "kept" in out:
                    out["kept"].append(kept)
                if "kept_text" in out:
                    out["kept_text"].append(kept.decode(errors="ignore"))
                held += len(kept)
                if held >= _BLOCK or i == len(batch) - 1:
                    keys = [batch.column(k)[first : i + 1] for k in KEY]
                    found = [pa.array(out[n], _KEPT[n]) for n in names]
                    yield pa.RecordBatch.from_arrays([*keys, *found], schema=schema)
                    first, held, out = i + 1, 0, {n: [] for n in names}

    return remove


def _ranges(docs: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(ranges of repeated windows per document, the documents with any repeated anchor)."""
    found = docs.select(*KEY, "text").where(F.octet_length("text") >= min_bytes)
    runs = materialise(found.mapInArrow(tidied(_find_runs(min_bytes)), _RUNS), "dedup-runs")
    anchors = (
        runs.groupBy("a")
        .agg(F.count(F.lit(1)).alias("n"), F.max("multi").alias("m"))
        .where((F.col("n") > 1) | F.col("m"))
        .select("a", F.xxhash64("a").alias("h"))
    )
    # Joined on the anchor and its hash: the exchange below the join is then the join's own, and AQE
    # can split an anchor that holds much of the corpus.
    shared = materialise(
        runs.withColumn("h", F.xxhash64("a")).join(anchors, ["a", "h"], "left_semi").drop("h"),
        "dedup-shared",
    )
    place = F.struct("k1", "k2", "start")
    distinct = materialise(
        shared.groupBy("a", "g", "wins").agg(
            F.count(F.lit(1)).alias("n"), F.min(place).alias("p"), F.max("multi").alias("multi")
        ),
        "dedup-distinct",
    )
    twice = distinct.where("n > 1").select("a", "g", "wins", F.xxhash64("a", "g").alias("h"))
    whole = (
        shared.withColumn("h", F.xxhash64("a", "g"))
        .join(twice, ["a", "g", "wins", "h"], "left_semi")
        .select(*KEY, "start", "wins")
    )
    kinds = (
        distinct.groupBy("a")
        .agg(F.count(F.lit(1)).alias("kinds"), F.max("multi").alias("m"))
        .where((F.col("kinds") > 1) | F.col("m"))
        .withColumn("h", F.xxhash64("a"))
    )
    open_runs = materialise(
        distinct.drop("multi")
        .withColumn("h", F.xxhash64("a"))
        .join(kinds, ["a", "h"])
        .select("a", "g", "wins", "p.*", "kinds"),
        "dedup-open",
    )
    size = open_runs.agg(F.sum(F.col("wins") + min_bytes)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    salts = F.ceil(F.col("kinds") / SPLIT)
    shard = F.pmod(F.xxhash64("a", F.pmod(F.col("g"), salts)), F.lit(shards))
    listed = open_runs.withColumns({"shard": shard, "split": salts > 1})

    touched = shared.select(*KEY).distinct()
    texts = materialise(
        docs.select(*KEY, "text").join(touched, KEY, "left_semi").dropDuplicates(KEY), "dedup-texts"
    )
    cut = (
        texts.join(
            listed.groupBy(*KEY).agg(
                F.collect_list(F.struct("start", "wins", "shard", "split")).alias("runs")
            ),
            KEY,
        )
        .mapInArrow(tidied(_cut(min_bytes)), "k1 long, k2 long, start long, shard long, split boolean, "
                    "run binary")
    )
    sorted_out = materialise(
        cut.repartition(shards, "shard").groupBy("shard").applyInPandas(
            _repeats_in_shard(min_bytes), _RANGES
        ),
        "dedup-ranges",
    )
    single = sorted_out.where("w1 is not null")
    across = (
        single.groupBy("w1", "w2").count().where("count > 1")
        .select("w1", "w2", F.xxhash64("w1", "w2").alias("h"))
    )
    matched = (
        single.withColumn("h", F.xxhash64("w1", "w2"))
        .join(across, ["w1", "w2", "h"], "left_semi")
        .select(*KEY, "start", "wins")
    )
    inside = sorted_out.where("w1 is null").select(*KEY, "start", "wins")
    # A row that is repeated in the input brings its ranges each time; they are the same ones.
    return whole.unionByName(inside).unionByName(matched).distinct(), texts


NEW = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"]


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_bytes: int = MIN_BYTES,
    into: str | None = None,
    new: Sequence[str] = NEW,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and what is kept.

    A byte goes if some string of ``min_bytes`` bytes over it also starts anywhere else, in the same
    text or another one; overlaps count and strings are judged on the input. A NULL text is empty.
    Every input row yields one row, repeated rows too (they are copies of each other). Columns of the
    input that have one of the new names are replaced, unless a column ``into`` is named, which then
    holds the new ones as a struct. ``kept`` holds the bytes, which may cut a character in two;
    ``kept_text`` is the text without such halves, NULL where the text was. Of the new columns only
    those named in ``new`` are made, written and moved.
    """
    stay = [c for c in docs.columns if into or c not in new]
    renamed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in stay]).alias("row"),
        *row_key(key, text),
        F.col(text).alias("text"),
    )
    ranges, texts = _ranges(renamed, min_bytes)
    made = [n for n in _KEPT if n in new]
    types = {"n_removed": "long", "n_spans": "long", "kept": "binary"}
    removed = texts.join(
        ranges.groupBy(*KEY).agg(F.collect_list(F.struct("start", "wins")).alias("ranges")), KEY
    ).mapInArrow(
        tidied(_remove(min_bytes, made)),
        ", ".join(["k1 long", "k2 long", *[f"{n} {types.get(n, 'string')}" for n in made]]),
    )
    # What has no repeat at all never leaves its row; only digests meet the removed ranges.
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    own = {"n_bytes": F.octet_length(whole).cast("long"), "sha": F.sha2(whole, 256)}
    none = F.lit(0).cast("long")
    otherwise = {
        "n_removed": none, "n_spans": none, "kept_sha256": F.col("sha"), "kept": whole,
        "kept_text": F.col("text"),
    }
    found = (
        renamed.withColumns(own)
        .join(materialise(removed, "dedup-removed"), KEY, "left")
        .select(
            "row",
            *[n if n in own else F.coalesce(n, otherwise[n]).alias(n) for n in new],
        )
    )
    return found.select("row.*", *([F.struct(*new).alias(into)] if into else new))


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
