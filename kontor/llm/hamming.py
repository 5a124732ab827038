"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits, and each shard indexes its codes by the value of every segment.
A search looks up all values within radius 0 of the query's segments, then 1, and so on. After radius
r every code nearer than segments * (r + 1) has been met, for it must agree with the query up to r
bits in some segment; so a query ends when its k-th verified distance is below that.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import table
from kontor.llm.shards import gathered, nearest, pieces, search, usable
from kontor.session import materialise

SEGMENT = 16
K = 10
#: Distinct codes per shard.
SHARD_CODES = 1 << 16
_AT_ONCE = 32


def flips(radius: int) -> np.ndarray:
    """All masks of one segment with ``radius`` bits set."""
    masks = [sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), radius)]
    return np.array(masks, np.uint16)


class Index:
    """Codes as rows of 16-bit segments, with one sorted list of rows per segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.orders = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.starts = [
            np.concatenate([[0], np.cumsum(np.bincount(codes[:, s], minlength=1 << SEGMENT))])
            for s in range(codes.shape[1])
        ]

    def within(self, queries: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) pairs whose codes are met in some segment by one of the masks."""
        all_q, all_c = [], []
        for s in range(self.codes.shape[1]):
            values = (queries[:, s, None] ^ masks[None, :]).ravel()
            begin = self.starts[s][values]
            count = self.starts[s][values.astype(np.int64) + 1] - begin
            where = np.repeat(np.arange(len(values)), count)
            nth = np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count)
            all_q.append(where // len(masks))
            all_c.append(self.orders[s][begin[where] + nth])
        pairs = np.unique(np.concatenate(all_q) * len(self.codes) + np.concatenate(all_c))
        return pairs // len(self.codes), pairs % len(self.codes)

    def top(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (distances, rows): every code up to the k-th distance, ties included."""
        segments = self.codes.shape[1]
        want = min(k, len(self.codes))
        found_q = np.zeros(0, np.int64)
        found_c = np.zeros(0, np.int64)
        found_d = np.zeros(0, np.int64)
        kth = np.full(len(queries), segments * SEGMENT + 1)
        open_ = np.arange(len(queries))
        for radius in range(SEGMENT + 1):
            q, c = self.within(queries[open_], flips(radius))
            q = open_[q]
            d = np.bitwise_count(queries[q] ^ self.codes[c]).sum(axis=1).astype(np.int64)
            found_q, found_c, found_d = (
                np.concatenate(x) for x in ((found_q, q), (found_c, c), (found_d, d))
            )
            _, one = np.unique(found_q * len(self.codes) + found_c, return_index=True)
            found_q, found_c, found_d = found_q[one], found_c[one], found_d[one]
            order = np.lexsort((found_d, found_q))
            found_q, found_c, found_d = found_q[order], found_c[order], found_d[order]
            begin = np.searchsorted(found_q, np.arange(len(queries)))
            size = np.searchsorted(found_q, np.arange(len(queries)), "right") - begin
            full = size >= want
            kth[full] = found_d[begin[full] + want - 1]
            keep = found_d <= kth[found_q]
            found_q, found_c, found_d = found_q[keep], found_c[keep], found_d[keep]
            open_ = open_[kth[open_] >= segments * (radius + 1)]
            if not len(open_):
                break
        edges = np.searchsorted(found_q, np.arange(len(queries) + 1))
        return [
            (found_d[a:b], found_c[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]


def _segments(codes: pd.Series) -> np.ndarray:
    width = len(codes.iloc[0])
    return np.frombuffer(b"".join(codes), np.uint16).reshape(len(codes), width // 2)


def _indexed(data: pd.DataFrame) -> dict[int, tuple[Index, np.ndarray]]:
    """An index and the ids of its rows per length of codes: different lengths are never compared."""
    return {
        int(width): (Index(_segments(rows["code"])), rows["ids"].to_numpy())
        for width, rows in data.groupby(data["code"].str.len())
    }


def _ask(k: int):
    def ask(indexes: dict[int, tuple[Index, np.ndarray]], queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        for width, alike in queries.groupby(queries["code"].str.len()):
            if width not in indexes:
                continue
            index, ids = indexes[width]
            for first in range(0, len(alike), _AT_ONCE):
                part = alike.iloc[first : first + _AT_ONCE]
                # One more than k, for the query's own code; ties are kept whole.
                found = index.top(_segments(part["code"]), k + 1)
                for query, (distances, at) in zip(part["query_id"], found, strict=True):
                    rows_of = [
                        (int(d), int(i))
                        for d, c in zip(distances, at, strict=True)
                        for i in ids[c]
                        if i != query
                    ]
                    out.extend((int(query), i, d) for d, i in sorted(rows_of)[:k])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "distance"])

    return ask


def sign_codes(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``code``: one bit per component, set where it is positive, in whole segments."""
    width = F.ceil(F.size(vector) / SEGMENT).cast("int") * SEGMENT
    signs = F.transform(vector, lambda x: F.when(x > 0, F.lit("1")).otherwise(F.lit("0")))
    bits = F.rpad(F.array_join(signs, ""), width, "0")
    # Four bits are one hexadecimal digit.
    digits = F.transform(
        F.sequence(F.lit(0), (width / 4).cast("int") - 1),
        lambda i: F.conv(F.substring(bits, i * 4 + 1, F.lit(4)), 2, 16),
    )
    return vectors.where(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.unhex(F.array_join(digits, "")).alias("code")
    )


def top_k(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``distance``: the ``k`` nearest other rows, ties to the
    smaller id, exactly.

    Repeated ids are one row. Equal codes are searched once, each with its smallest ids. With fewer
    rows than ``k`` all of them come; without queries nothing does.
    """
    distinct = materialise(
        gathered(codes.select("vec_id", "code").distinct(), "code", "vec_id", k + 1), "codes"
    )
    shards = pieces(distinct.count(), SHARD_CODES)
    asked = queries.select(F.col("vec_id").alias("query_id"), "code").distinct()
    data = distinct.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    found = search(
        data,
        asked.withColumn("shard", F.explode(every)),
        shards,
        _indexed,
        _ask(k),
        "query_id long, vec_id long, distance long",
    )
    return nearest(found, k, "distance").select("query_id", "rank", "vec_id", "distance")


def op7_hamming(spark: SparkSession, folder: str) -> DataFrame:
    codes = materialise(sign_codes(table(spark, folder, "embeddings")), "sign-codes")
    return top_k(codes, codes.where(F.col("vec_id") % 100 == 0))


OP7_SQL = """
with codes as (
    select distinct vec_id, list_transform(embedding, lambda x: x > 0) as bits
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), distances as (
    select q.vec_id as query_id, c.vec_id,
           len(list_filter(range(1, len(c.bits) + 1), lambda i: q.bits[i] <> c.bits[i])) as distance
    from codes q join codes c on q.vec_id <> c.vec_id and len(q.bits) = len(c.bits)
    where q.vec_id % 100 = 0
)
select query_id, cast(place as int) as rank, vec_id, cast(distance as bigint) as distance
from (select *, row_number() over (partition by query_id order by distance, vec_id) as place
      from distances)
where place <= 10
"""
