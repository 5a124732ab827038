"""Byte-level BPE: encoding by ranks and decoding.

Texts fall into pieces by the vocabulary's pattern. Pieces of equal length in bytes are the rows of one
matrix; each round, every row merges its leftmost pair of the smallest rank and closes the gap, so
all rows stay equally wide, and rows without a pair leave. The rank of a pair of ids is looked up in
an open-addressing hash table held in two arrays.

Words recur, so each worker process remembers what it has encoded, up to ``REMEMBERED`` bytes and nothing
that is long; the memory only saves work and never changes a result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from kontor.llm.rows import built_once, table, tidied

#: Bytes that the memory of a process may take, about, and the characters of a chunk worth keeping.
REMEMBERED = 96 << 20
WORTH = 256
#: What an entry of the memory takes besides its strings.
_ENTRY = 300
#: Longer pieces are merged one by one with a heap: a matrix round costs as much as the row is long.
LONGEST_ROW = 256
#: Characters of text whose words are looked up at once.
_CHARACTERS = 1 << 20
_NONE = np.iinfo(np.int32).max
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Ranks of pairs of ids, by hashing; missing pairs have the rank ``_NONE``."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        keys = np.array(keys, np.uint64)
        bits = max(4, int(len(keys) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        values = np.array(values, np.int32)
        while len(left):
            free = self.keys[slot] == np.iinfo(np.uint64).max
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]] = keys[left[put]]
            self.values[slot[put]] = values[left[put]]
            left, slot = left[~put], (slot[~put] + 1) & self.mask

    @classmethod
    def of(cls, state: dict) -> PairTable:
        """A table from the state of another one, as broadcast."""
        pairs = cls.__new__(cls)
        vars(pairs).update(state)
        return pairs

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(keys.shape, _NONE, np.int32).ravel()
        keys = keys.ravel()
        slot, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            there = self.keys[slot]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (there != np.iinfo(np.uint64).max)
            open_, slot = open_[on], (slot[on] + 1) & self.mask
        return out.reshape(left.shape)


class Encoder:
    """``words`` maps a text chunk to (number of ids, ids as text, the bytes decoded from the ids)."""

    def __init__(self, ranks: dict[bytes, int], pairs: PairTable, pattern: str):
        self.ranks, self.pairs = ranks, pairs
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.words: dict[str, tuple[int, str, bytes]] = {}
        self.held = 0
        self._passing: list[str] = []

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece."""
        out: list[list[int]] = [[]] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            if length > LONGEST_ROW:
                for row in rows.tolist():
                    out[row] = self._long(pieces[row])
                continue
            text = b"".join([pieces[row] for row in rows.tolist()])
            ids = self.single[np.frombuffer(text, np.uint8)].reshape(len(rows), length)
            for done, found in self._rounds(rows, ids):
                for row, merged in zip(done.tolist(), found.tolist(), strict=True):
                    out[row] = merged
        return out

    def _rounds(self, rows: np.ndarray, ids: np.ndarray):
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ids.shape[1] == 1:
                yield rows, ids
                return
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == _NONE
            if done.any():
                yield rows[done], ids[done]
                rows, ids, ranks = rows[~done], ids[~done], ranks[~done]
                at, best = at[~done], best[~done]
                if not len(rows):
                    return
            row, width = np.arange(len(rows)), ids.shape[1]
            ids[row, at] = best
            columns = np.arange(width)
            ids = ids[columns != at[:, None] + 1].reshape(len(rows), width - 1)
            ranks = ranks[columns[:-1] != at[:, None]].reshape(len(rows), width - 2)
            before, after = at > 0, at < width - 2
            r, c = row[before], at[before]
            ranks[r, c - 1] = self.pairs.ranks(ids[r, c - 1], ids[r, c])
            r, c = row[after], at[after]
            ranks[r, c] = self.pairs.ranks(ids[r, c], ids[r, c + 1])

    def _long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        token = [piece[i : i + 1] for i in range(len(piece))]
        following = list(range(1, len(piece) + 1))
        previous = list(range(-1, len(piece) - 1))
        alive = [True] * len(piece)
        end, heap = len(piece), []

        def offer(at: int) -> None:
            if at >= 0 and following[at] < end:
                rank = self.ranks.get(token[at] + token[following[at]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, len(token[at]), len(token[following[at]])))

        for i in range(end - 1):
            offer(i)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            then = following[at]
            if not alive[at] or then >= end or (len(token[at]), len(token[then])) != (left, right):
                continue
            token[at] += token[then]
            alive[then] = False
            following[at] = following[then]
            if following[at] < end:
                previous[following[at]] = at
            offer(previous[at])
            offer(at)
        return [self.ranks[t] for t, here in zip(token, alive, strict=True) if here]

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not remembered yet; long ones are forgotten at the next call."""
        for chunk in self._passing:
            del self.words[chunk]
        if self.held > REMEMBERED:
            self.words.clear()
            self.held = 0
        new = [c for c in chunks if c not in self.words]
        self._passing = [c for c in new if len(c) > WORTH]
        split = [[p.encode() for p in self.pattern.findall(c)] for c in new]
        distinct = list(set(chain.from_iterable(split)))
        ids = dict(zip(distinct, self.pieces(distinct), strict=True))
        for chunk, parts in zip(new, split, strict=True):
            found = list(chain.from_iterable([ids[p] for p in parts]))
            decoded = b"".join([self.bytes_of[i] for i in found])
            known = (len(found), " ".join(map(str, found)), decoded)
            self.words[chunk] = known
            if len(chunk) <= WORTH:
                self.held += _ENTRY + len(chunk) + len(known[1]) + len(decoded)


#: A blank before something that is not white space begins a chunk: no match of the pattern spans it.
_CUT = re.compile(r"(?= \S)")
#: A blank before white space or the end. Where there is none, every blank begins a chunk.
_LOOSE = re.compile(r" [^\S]| \Z")


def chunks_of(text: str) -> list[str]:
    """The text in chunks that the pattern and the merges treat independently."""
    if "\0" not in text and not _LOOSE.search(text):
        chunks = text.replace(" ", "\0 ").split("\0")
    else:
        chunks = _CUT.split(text)
    return chunks if chunks[0] else chunks[1:]


def in_blocks(
    texts: list[str | None],
    characters: int = _CHARACTERS,
    cut: Callable[[str], list[str]] = chunks_of,
) -> Iterator[list[list[str]]]:
    """Chunk lists of successive texts, some megabytes at a time; NULL is empty."""
    block: list[list[str]] = []
    size = 0
    for text in texts:
        block.append(cut(text or ""))
        size += len(text or "")
        if size >= characters:
            yield block
            block, size = [], 0
    if block:
        yield block


def _encode(shared, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = built_once(shared, lambda v: Encoder(v[0], PairTable.of(v[1]), pattern))
        for batch in batches:
            sizes, digests, decoded = [], [], []
            for block in in_blocks(batch.column("text").to_pylist()):
                encoder.learn(set(chain.from_iterable(block)))
                words = encoder.words
                for chunks in block:
                    found = [words[c] for c in chunks]
                    sizes.append(sum([f[0] for f in found]))
                    ids = " ".join([f[1] for f in found])
                    digests.append(hashlib.sha256(ids.encode()).hexdigest())
                    raw = b"".join([f[2] for f in found])
                    decoded.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encode


def token_digests(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: its key as ``doc_id``, number of ids, and digests of the ids and of the decoded bytes.

    NULL and empty texts have no ids. Each row is encoded for itself; other columns are not read.
    The ranks and the pair table, whose size is the vocabulary's, are broadcast.
    """
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((ranks, vars(PairTable(ranks))))
    rows = docs.selectExpr(f"cast(`{key}` as long) doc_id", f"`{text}` text")
    return rows.mapInArrow(
        tidied(_encode(shared, pattern)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
