"""WARC archives with a two-level capture index.

Writing: each record is a gzip member of its own, so it can be read alone. Equal payloads are stored
once, as the response of the smallest page; the others are revisits that refer to it.

Index: captures are sorted by their key, the host reversed and then the path, and the page. Each shard
of the sorted captures is cut into compressed blocks of lines; a sparse directory holds the first key
of every block, and the first key of every shard is the upper level. A lookup searches the shards,
then the directory by bisection, reads the block's range, and then the record's range.

Archives and blocks are files below a folder that all machines share, opened through its URI. The
listing of captures and the directory are Parquet, written by Spark's committer: files that a lost or
repeated task has left behind are in no listing and are never read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import table
from kontor.session import materialise, scratch_path

#: Payloads of fewer bytes are always stored in full.
MIN_BYTES = 0
#: Lines of the capture index per compressed block, captures per shard, and bytes per archive.
BLOCK_LINES = 512
SHARD_LINES = 16_384
ARCHIVE_BYTES = 256 << 20
_LINES = "key string, page_id long, file string, offset long, size long"
_DIRECTORY = "shard string, first string, place long, offset long, size long"
_CAPTURE = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def surt(url: str | None) -> str:
    """The key of a URL: host reversed, then path and query, lower case, without port and fragment."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host = parts.hostname or ""
    except ValueError:
        parts, host = None, ""
    if not host:
        return "-"
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}){quote(parts.path or '/', safe='/%:@!$&()*+,;=~')}{quote(query, safe='?/%:@!$&()*+,;=~')}"


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{surt(url)} {page_id if page_id is not None else -1:020d}"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member. A revisit names the payload's digest and size, and its page."""
    target = quote(url or "", safe="/%:@!$&'()*+,;=?#[]~")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    body = payload
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Payload-Length: {len(payload)}"]
        body = b""
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}"]).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page, payload bytes, digest, type, page referred to) of one record, its payload verified."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line[:-1], "") for line in lines)
    length = int(fields["Content-Length"])
    payload = rest[:length]
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    page_id = int(page) if page else None
    if fields["WARC-Type"] == "revisit":
        refers = int(fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">"))
        return page_id, int(fields["X-Payload-Length"]), digest, "revisit", refers
    if digest_of(payload) != digest:
        raise ValueError(f"payload of page {page_id} does not match its digest")
    return page_id, length, digest, "response", None


class _Files:
    """Range reads from files that stay open within a task."""

    def __init__(self, root: str):
        self.store, self.root = fs.FileSystem.from_uri(root)
        self.open: dict[str, object] = {}

    def read(self, name: str, offset: int, size: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.popitem()[1].close()
            self.open[name] = self.store.open_input_file(f"{self.root}/{name}")
        return self.open[name].read_at(size, offset)


class _Writer:
    """Appends to files with fresh names, a new one whenever the last is large enough."""

    def __init__(self, root: str, suffix: str, most: int):
        self.store, self.root = fs.FileSystem.from_uri(root)
        self.store.create_dir(self.root, recursive=True)
        self.suffix, self.most, self.file, self.offset = suffix, most, None, 0

    def append(self, data: bytes) -> tuple[str, int]:
        if self.file is None or self.offset >= self.most:
            self.close()
            self.name = f"{uuid.uuid4().hex}.{self.suffix}"
            path = f"{self.root}/{self.name}"
            # The data is compressed already, record by record.
            self.file, self.offset = self.store.open_output_stream(path, compression=None), 0
        self.file.write(data)
        self.offset += len(data)
        return self.name, self.offset - len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _write_records(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(root, "warc.gz", ARCHIVE_BYTES)
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode()
                data = record(row["page_id"], row["url"], payload, row["refers_to"])
                name, offset = writer.append(data)
                key = capture_key(row["url"], row["page_id"])
                out.append((key, row["page_id"], name, offset, len(data)))
            yield _batch(out, _LINES_SCHEMA)
        writer.close()

    return write


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_LINES_SCHEMA = pa.schema(
    [("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()),
     ("size", pa.int64())]
)
_DIRECTORY_SCHEMA = pa.schema(
    [("shard", pa.string()), ("first", pa.string()), ("place", pa.int64()), ("offset", pa.int64()),
     ("size", pa.int64())]
)


def _write_blocks(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(root, "cdx.gz", 1 << 62)
        lines: list[tuple[str, str]] = []
        place = 0

        def block() -> pa.RecordBatch:
            nonlocal place
            data = "\n".join(line for _, line in lines).encode()
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress(data) + packer.flush()
            name, offset = writer.append(data)
            place += 1
            return _batch([(name, lines[0][0], place, offset, len(data))], _DIRECTORY_SCHEMA)

        for batch in batches:
            for row in batch.to_pylist():
                line = f"{row['key']}\t{row['file']}\t{row['offset']}\t{row['size']}"
                lines.append((row["key"], line))
                if len(lines) >= BLOCK_LINES:
                    yield block()
                    lines.clear()
        if lines:
            yield block()
        writer.close()

    return write


@dataclass(frozen=True)
class Archive:
    """Written archives: their folder, and the directory of the index blocks."""

    root: str
    directory: DataFrame

    def shards(self) -> list[tuple[str, str]]:
        """(first key, shard), sorted: one row per ``SHARD_LINES`` captures."""
        heads = self.directory.groupBy("shard").agg(F.min("first").alias("first"))
        return sorted((row["first"], row["shard"]) for row in heads.toLocalIterator())


def write_archive(pages: DataFrame, root: str, min_bytes: int = MIN_BYTES) -> Archive:
    """Write a record per row of ``pages`` (page_id, url, html) below ``root``, and the index.

    NULL html is an empty payload; a NULL or broken URL has the key ``-``. Rows that share both the
    smallest page_id of a payload and the payload are all responses. Other columns are not read.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("n"))
    # Only digests and ids are grouped. Payloads that occur once never leave their task unless the
    # list of repeated ones is larger than Spark broadcasts.
    repeated = materialise(
        rows.where(F.col("n") >= min_bytes).groupBy("sha1", "n")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1").select("sha1", "n", "first"),
        "repeated-payloads",
    )
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    marked = rows.join(repeated, ["sha1", "n"], "left").select(
        "page_id", "url", "html", revisit.alias("refers_to")
    )
    lines = materialise(
        marked.mapInArrow(_write_records(f"{root}/warc"), _LINES), "captures"
    )
    shards = max(1, -(-lines.count() // SHARD_LINES))
    ordered = lines.repartitionByRange(shards, "key").sortWithinPartitions("key")
    directory = materialise(
        ordered.mapInArrow(_write_blocks(f"{root}/cdx"), _DIRECTORY), "cdx-directory"
    )
    return Archive(root, directory)


def _find(root: str):
    def find(directory: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if directory.empty or wanted.empty:
            return _captures([])
        directory = directory.sort_values("place")
        first = directory["first"].tolist()
        blocks = list(
            directory[["shard", "offset", "size"]].itertuples(index=False, name=None)
        )
        index, records = _Files(f"{root}/cdx"), _Files(f"{root}/warc")
        held: tuple[int, list[list[str]]] = (-1, [])
        hits = []
        for key in sorted(set(wanted["key"])):
            # Equal keys may begin in the block before the first one that starts with the key.
            at = max(bisect.bisect_left(first, key) - 1, 0)
            while at < len(first) and first[at] <= key:
                if held[0] != at:
                    text = zlib.decompress(index.read(*blocks[at]), 31).decode()
                    held = (at, [line.split("\t") for line in text.split("\n")])
                lines = held[1]
                row = bisect.bisect_left(lines, key, key=lambda line: line[0])
                while row < len(lines) and lines[row][0] == key:
                    hits.append((lines[row][1], int(lines[row][2]), int(lines[row][3])))
                    row += 1
                at += 1
        return _captures([parsed(records.read(*hit)) for hit in sorted(hits)])

    return find


def _captures(rows: list[tuple]) -> pd.DataFrame:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """The captures with the given ``key`` values, read from the archives.

    The list of shards is the upper level; each shard's directory meets the keys that fall into it.
    """
    heads = archive.shards()
    firsts = [first for first, _ in heads]
    names = [name for _, name in heads]
    distinct = keys.select("key").where("key is not null").distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                names[max(bisect.bisect_right(firsts, key) - 1, 0)] if names else ""
                for key in batch.column("key").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found, pa.string())], ["key", "shard"]
            )

    placed = distinct.mapInArrow(place, "key string, shard string")
    return (
        archive.directory.groupBy("shard")
        .cogroup(placed.groupBy("shard"))
        .applyInPandas(_find(archive.root), _CAPTURE)
    )


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(
            batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([capture_key(u, p) for u, p in pairs], pa.string())], ["key"]
        )


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    root = scratch_path(spark, "archive")
    root = root if "://" in root else f"file://{root}"
    archive = write_archive(pages, root)
    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    return lookup(archive, asked.mapInArrow(_keys, "key string"))


