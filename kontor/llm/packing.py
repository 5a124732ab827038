"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest as fit,
then the binary digits of the rest. Each piece is a sequence of its own, equal lengths form a bucket,
and a batch is drawn from one bucket. So there is no padding at all and no sequence crosses documents.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import built_once, table, tidied

LONGEST = 2048
END = 1
#: Bytes that the memory of a worker process may take, about, and the bytes of a chunk worth keeping;
#: forgetting only costs time.
REMEMBERED = 128 << 20
WORTH = 256
#: What an entry of the memory takes besides its strings.
_ENTRY = 230
#: Bytes of text whose chunks are looked up at once; a longer text is taken alone.
_CHARACTERS = 4 << 20
#: New words that the tokenizer gets at once.
_WORDS = 1 << 14
_PATTERN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _bytes_in(*kinds: Iterable[int]) -> np.ndarray:
    known = np.zeros(256, bool)
    for kind in kinds:
        known[list(kind)] = True
    return known


_BLANK = 0x20
_SPACE = _bytes_in(b" \t\n\v\f\r")
#: All of ASCII that is no letter or digit but the apostrophe, with which some pieces begin.
_MARK = _bytes_in(b'!"#$%&', range(0x28, 0x30), b":;<=>?@", b"[\\]^_`", b"{|}~")
_DIGIT = _bytes_in(b"0123456789")
_ASCII_LETTER = _bytes_in(range(0x41, 0x5B), range(0x61, 0x7B))
_ALPHANUMERIC = _ASCII_LETTER | _DIGIT
#: First bytes of two that make a letter, but for the signs of multiplication and division.
_LEADS = _bytes_in(range(0xC3, 0xC9))
_LETTER = _ASCII_LETTER | _LEADS | _bytes_in(range(0x80, 0xC0))
#: First bytes of characters none of which is white space in any version of Unicode.
_SURE = _bytes_in(range(0x21, 0x7F), range(0xC3, 0xE1), range(0xE4, 0xEF), range(0xF0, 0xF5))
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def pieces(count: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` ids; ``longest`` is a power of two."""
    out = [(start, longest) for start in range(0, count - longest + 1, longest)]
    start = len(out) * longest
    rest = count - start
    while rest:
        length = 1 << (rest.bit_length() - 1)
        out.append((start, length))
        start, rest = start + length, rest - length
    return out


def _visible(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Whether the characters that begin with these bytes are surely no white space."""
    return (
        _SURE[one]
        | ((one == 0xC2) & (two > 0xA0))
        | ((one == 0xE1) & (two > 0xA0))
        | ((one == 0xE2) & ((two > 0x81) | ((two == 0x80) & (three >= 0x90) & (three < 0xA8))))
        | ((one == 0xE3) & (two > 0x80))
    )


def _beginnings(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a text may be cut before each byte without a change of its ids; and at its bounds.

    The pattern's pieces end before white space, and between a mark and a letter or digit. Of white
    space before something visible, the last character is a piece of its own or, a blank, begins one.
    Where a character's kind is in doubt there is no cut.
    """
    begins = np.zeros(len(data) + 1, bool)
    begins[bounds] = True
    at = np.flatnonzero(_SPACE[data] | _MARK[data])
    framed = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)])
    here, before, behind = framed[at + 3], framed[at + 2], framed[at + 4]
    space = _SPACE[here]
    after = ~begins[at + 1] & _visible(behind, framed[at + 5], framed[at + 6])
    visible, letter = _SURE[before], _ALPHANUMERIC[before]
    # The characters before that take several bytes.
    many = np.flatnonzero(before >= 0x80)
    one, two, three = before[many], framed[at[many] + 1], framed[at[many]]
    visible[many] = np.where(
        two >= 0xC0,
        _visible(two, one, one),
        (three < 0xC0) | _visible(three, two, one),
    )
    letter[many] = _LEADS[two] & ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7)))
    begins[at[np.where(space, visible | after, letter)]] = True
    begins[at[np.where(space, after & (here != _BLANK), _ALPHANUMERIC[behind])] + 1] = True
    return begins


def _seen() -> np.ndarray:
    """The characters that stand for the bytes in a byte-level vocabulary; a line's end becomes a blank."""
    plain = _bytes_in(range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))
    seen = np.arange(256, dtype="<u4")
    seen[~plain] = 256 + np.arange(256 - plain.sum())
    seen[0x0A] = _BLANK
    return seen


class _Words:
    """Ids of text chunks as little-endian bytes, remembered per worker process.

    Texts are cut where the pattern cuts them whatever stands around (``_beginnings``). A chunk of
    letters or of digits, with or without a blank before, is one piece of the pattern: new ones go to
    the tokenizer's model side by side, and the bytes of the tokens tell where each ends. Other chunks
    go through the whole tokenizer. The vocabulary's special tokens, where they count, are chunks of
    their own, and texts are cut at them first, as the library does.
    """

    def __init__(self, tokenizer: str, marks_are_text: bool, remembered: int):
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.special: dict[bytes, bytes] = {}
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.lstrip or token.rstrip or token.single_word or not token.special:
                raise ValueError(f"the added token {token.content!r} is no plain special token")
            if not marks_are_text:
                self.special[token.content.encode()] = np.array([number], "<u4").tobytes()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile(b"|".join(map(re.escape, longest_first)))
        # What is left of a text holds no mark, and marks that are text are encoded as such.
        self.tokenizer.encode_special_tokens = True
        told = json.loads(tokenizer)
        if told["normalizer"] or not _PATTERN.items() <= (told["pre_tokenizer"] or {}).items():
            raise ValueError("the vocabulary is not byte-level, or its pattern joins words")
        self.model = Tokenizer.from_str(
            json.dumps(told | {"pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []})
        )
        self.seen = _seen()
        vocabulary = self.tokenizer.get_vocab()
        # In a byte-level vocabulary each character of a token stands for one byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.ids = dict(self.special)
        self.held = 0
        self._passing: list[bytes] = []

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the chunks of texts begin, and the end; ``offsets`` are those of the texts."""
        raw = data.tobytes() if self.special else b""
        if not any(mark in raw for mark in self.special):
            return np.flatnonzero(_beginnings(data, offsets))
        spans = [
            mark.span()
            for first, end in pairwise(offsets.tolist())
            for mark in self.marks.finditer(raw, first, end)
        ]
        edges = np.array(spans, np.int64).reshape(-1, 2)
        begins = _beginnings(data, np.concatenate([offsets, edges.ravel()]))
        for first, end in spans:
            begins[first + 1 : end] = False
        return np.flatnonzero(begins)

    def chunks(self, text: str) -> list[bytes]:
        raw = text.encode()
        places = self.cut(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return [raw[first:end] for first, end in pairwise(places.tolist())]

    def learn(self, chunks: Iterable[bytes]) -> list[bytes]:
        """The ids of the chunks; what is not remembered is encoded, long ones until the next call."""
        known = self.ids
        for part in self._passing:
            known.pop(part, None)
        self._passing = []
        if self.held > self.remembered:
            known.clear()
            known.update(self.special)
            self.held = 0
        chunks = list(chunks)
        found = list(map(known.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            self._add([chunks[i] for i in missing])
            for i in missing:
                found[i] = known[chunks[i]]
        return found

    def _add(self, new: list[bytes]) -> None:
        known = self.ids
        self._passing = [chunk for chunk in new if len(chunk) > WORTH]
        self.held += sum(map(len, new)) + _ENTRY * len(new)
        single = _single(new)
        words = [new[i] for i in np.flatnonzero(single).tolist()]
        for first in range(0, len(words), _WORDS):
            some = words[first : first + _WORDS]
            known.update(zip(some, self._side_by_side(some), strict=True))
        rest = [new[i] for i in np.flatnonzero(~single).tolist()]
        for first in range(0, len(rest), _WORDS):
            some = rest[first : first + _WORDS]
            texts = [chunk.decode() for chunk in some]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for chunk, encoded in zip(some, found, strict=True):
                known[chunk] = np.array(encoded.ids, "<u4").tobytes()

    def _side_by_side(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of words that are one piece each."""
        raw = np.frombuffer(b"\n".join(words), np.uint8)
        text = self.seen[raw].tobytes().decode("utf-32-le")
        encoded = self.model.encode_batch_fast([text], add_special_tokens=False)[0]
        numbers = np.array(encoded.ids, "<u4")
        ends = np.cumsum(self.sizes[numbers])
        sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        stops = np.searchsorted(ends, sizes)
        if ends[-1] != sizes[-1] or not np.array_equal(ends[stops], sizes):
            raise ValueError("the vocabulary is not byte-level, or its pattern joins words")
        stops = ((stops + 1) * 4).tolist()
        return map(numbers.tobytes().__getitem__, map(slice, [0, *stops[:-1]], stops))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """The ids of each text."""
        places = self.cut(data, offsets)
        buffers = [None, pa.py_buffer(places), pa.py_buffer(data)]
        chunks = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers)
        chunks = chunks.dictionary_encode()
        found = self.learn(chunks.dictionary.to_numpy(zero_copy_only=False))
        which = chunks.indices.to_numpy()
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        firsts, each = np.cumsum(counts) - counts, counts[which]
        upto = np.append(0, np.cumsum(each))
        ids = np.arange(upto[-1]) + np.repeat(firsts[which] - upto[:-1], each)
        ids = np.frombuffer(b"".join(found), "<u4")[ids]
        for first, end in pairwise(upto[np.searchsorted(places, offsets)].tolist()):
            yield ids[first:end].tobytes()


def _single(chunks: list[bytes]) -> np.ndarray:
    """Whether each chunk is letters or digits only, but for a blank before them."""
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
    firsts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join(chunks), np.uint8)
    led = firsts[(raw[firsts] == _BLANK) & (lengths > 1)]
    letters, digits = _LETTER[raw], _DIGIT[raw]
    sign = (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
    letters[:-1] &= ~sign
    letters[led] = digits[led] = True
    return np.logical_and.reduceat(letters, firsts) | np.logical_and.reduceat(digits, firsts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Keys, UTF-8 bytes and their offsets of successive texts, some megabytes at a time; NULL is empty."""
    keys: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        column = batch.column("text").cast(pa.large_binary())
        for key, text in zip(batch.column("doc_id").to_pylist(), column.to_pylist(), strict=True):
            keys.append(key)
            texts.append(text or b"")
            size += len(texts[-1])
            if size >= _CHARACTERS:
                yield _block(keys, texts)
                keys, texts, size = [], [], 0
    if keys:
        yield _block(keys, texts)


def _block(keys: list, texts: list[bytes]) -> tuple[list, np.ndarray, np.ndarray]:
    offsets = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return keys, np.frombuffer(b"".join(texts), np.uint8), np.append(0, offsets)


def _cut(shared, longest: int, end: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = built_once(shared, lambda value: _Words(*value))
        closing = np.array([end], "<u4").tobytes()
        for keys, data, offsets in _blocks(batches):
            out: list[tuple] = []
            for key, ids in zip(keys, words.encode(data, offsets), strict=True):
                ids += closing
                count = len(ids) // 4
                for start, length in pieces(count, longest):
                    part = ids[start * 4 : (start + length) * 4]
                    crc = zlib.crc32(part)
                    out.append((key, start, length, crc, count, part if with_ids else None))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return cut


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int = LONGEST,
    end: int = END,
    text: str = "text",
    key: str = "doc_id",
    with_ids: bool = True,
    marks_are_text: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: its document, place and length there, sequence and offset in it, and ids.

    ``ids`` holds little-endian unsigned 32-bit ids (NULL unless ``with_ids``). A NULL or empty text
    has only the closing id. Repeated rows are packed repeatedly; other columns are not read. Sequence
    ids are unique; a sequence's length is its bucket. The vocabulary, whose size is fixed, is
    broadcast. A special token's string in a text becomes its id, as the library has it by default;
    with ``marks_are_text``, which is safer for texts of unknown origin, it is text like any other.
    ``remembered`` bounds the bytes of encoded words that a worker process keeps.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast((file.read(), marks_are_text, remembered))
    rows = docs.selectExpr(f"cast(`{key}` as long) doc_id", f"`{text}` text")
    return (
        rows.mapInArrow(tidied(_cut(shared, longest, end, with_ids)), _SCHEMA)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        with_ids=False,
    ).drop("ids")
