"""Approximate nearest neighbours on robust-pruned directed graphs, one graph per shard.

Sharding: a bounded sample gives the middles of some cells, every vector goes to the cell of its nearest
middle, and a cell that holds more than a shard is dealt out by hash. A query first visits the shards of
the ``PROBED`` cells nearest to it. Then it visits every other cell that may hold a nearer vector than
the last one it has found: a cell is left out only where the plane half-way between its middle and
another one shows that all of it lies farther away. Vectors are never copied for queries.

Building: greedy searches from a few far-apart starts propose neighbours for each vector. Pruning
takes the nearest proposal, drops every other one that is nearer to it than to the vector (relaxed by
``RELAXED`` in the second pass), and goes on, so edges point in different directions. Edges are added
in reverse as well, and lists that grow too long are pruned again. Searching: beam search on every
shard; what it finds is measured exactly and the shards' answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import sized, table
from kontor.llm.shards import gathered, nearest, pieces, search, usable
from kontor.session import materialise

K = 10
DEGREE = 24
#: Rows that a search keeps while a graph is built, and while queries are answered.
BEAM = 64
QUERY_BEAM = 128
#: Where searches start: rows far from each other, the first one in the middle of the shard. A single
#: start may lie in a dense cluster whose rows have all their edges inside it.
STARTS = 32
RELAXED = 1.2
#: Distinct vectors per shard, about.
SHARD_VECTORS = 4096
#: Cells at most, sampled vectors for each, cells that a query visits first, and rounds of moving middles.
MOST_CELLS = 512
CELL_SAMPLE = 64
PROBED = 24
_ROUNDS = 8
_AT_ONCE = 256
#: Numbers of a batch that is pruned at once: 16 MB.
_PAIRS = 1 << 21
_EXPANDED = 4


def _apart(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``one`` (n, d) to their own ``many`` (n, m, d)."""
    return ((many - one[:, None, :]) ** 2).sum(axis=2)


def _diverse(rows: np.ndarray, away: np.ndarray, relaxed: float) -> np.ndarray:
    """Of each line of rows, nearest first, those that no row chosen before is nearer to; -1 is none.

    ``away`` holds the rows as seen from their node. That keeps the numbers as small as the distances
    between them, so these come from one product of matrices.
    """
    each = np.arange(len(rows))
    out = np.full((len(rows), DEGREE), -1, np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        size = (away**2).sum(axis=2)
        between = away @ away.transpose(0, 2, 1)
        between *= -2.0
        between += size[:, :, None]
        between += size[:, None, :]
        apart = np.where(rows >= 0, size, np.inf)
        nearer = relaxed**2 * between <= apart[:, None, :]
    left = apart.copy()
    for place in range(DEGREE):
        pick = left.argmin(axis=1)
        there = np.isfinite(left[each, pick])
        if not there.any():
            break
        out[there, place] = rows[each, pick][there]
        left[nearer[each, pick] & there[:, None]] = np.inf
        left[each, pick] = np.inf
    return out


class Graph:
    """Vectors and the out-edges of each; -1 fills short lists."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None):
        self.vectors = vectors
        self.starts = self._starts()
        if edges is not None:
            self.edges = edges
            return
        size = len(vectors)
        random = np.random.default_rng(size)
        self.edges = np.full((size, DEGREE), -1, np.int64)
        if size > 1:
            start = random.integers(0, size, (size, min(DEGREE, size - 1)))
            start[start == np.arange(size)[:, None]] = -1
            self.edges[:, : start.shape[1]] = start
        for relaxed in (1.0, RELAXED):
            for chosen in np.array_split(random.permutation(size), -(-size // _AT_ONCE)):
                self._insert(chosen, relaxed)

    def _starts(self) -> np.ndarray:
        """Up to ``STARTS`` rows, each as far as possible from those before it."""
        middle = self.vectors.mean(axis=0)
        starts = [int(((self.vectors - middle) ** 2).sum(axis=1).argmin())]
        apart = np.full(len(self.vectors), np.inf)
        while len(starts) < min(STARTS, len(self.vectors)):
            last = self.vectors[starts[-1]]
            apart = np.minimum(apart, ((self.vectors - last) ** 2).sum(axis=1))
            starts.append(int(apart.argmax()))
        return np.unique(starts)

    def beam(self, asked: np.ndarray, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(rows, squared distances) of the best found per query, nearest first; -1 fills."""
        number, size = len(asked), len(self.vectors)
        each = np.arange(number)
        rows = np.full((number, width), -1, np.int64)
        begun = len(self.starts)
        rows[:, :begun] = self.starts
        apart = np.full((number, width), np.inf)
        first = np.broadcast_to(self.vectors[self.starts], (number, *self.vectors[self.starts].shape))
        apart[:, :begun] = _apart(asked, first)
        done = np.zeros((number, width), bool)
        seen = np.zeros((number, size), bool)
        seen[:, self.starts] = True
        while True:
            waiting = np.where(done | (rows < 0), np.inf, apart)
            best = np.argsort(waiting, axis=1)[:, :_EXPANDED]
            live = np.isfinite(np.take_along_axis(waiting, best, axis=1))
            active = live.any(axis=1)
            if not active.any():
                return rows, apart
            here = each[active]
            best, live = best[active], live[active]
            mark = done[here]
            np.put_along_axis(mark, best, np.take_along_axis(mark, best, axis=1) | live, axis=1)
            done[here] = mark
            source = np.where(live, np.take_along_axis(rows[here], best, axis=1), -1)
            new = np.where(source[:, :, None] >= 0, self.edges[source], -1).reshape(len(here), -1)
            # Each row once: sorted, equal neighbours dropped, and none that was seen.
            new.sort(axis=1)
            fresh = new >= 0
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            fresh &= ~seen[here[:, None], np.maximum(new, 0)]
            at, place = np.nonzero(fresh)
            seen[here[at], new[at, place]] = True
            distance = np.full(new.shape, np.inf)
            distance[at, place] = (
                (self.vectors[new[at, place]] - asked[here[at]]) ** 2
            ).sum(axis=1)
            new = np.where(fresh, new, -1)
            all_rows = np.concatenate([rows[here], new], axis=1)
            all_apart = np.concatenate([apart[here], distance], axis=1)
            all_done = np.concatenate([done[here], np.zeros(new.shape, bool)], axis=1)
            order = np.argsort(all_apart, axis=1, kind="stable")[:, :width]
            rows[here] = np.take_along_axis(all_rows, order, axis=1)
            apart[here] = np.take_along_axis(all_apart, order, axis=1)
            done[here] = np.take_along_axis(all_done, order, axis=1)

    def _pruned(self, nodes: np.ndarray, proposed: np.ndarray, relaxed: float) -> np.ndarray:
        """Diverse neighbours of the nodes among their proposals (-1 where there is none)."""
        proposed = np.where(proposed == nodes[:, None], -1, proposed)
        proposed = np.sort(proposed, axis=1)
        proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
        # What is empty comes first, and what is empty everywhere is cut off.
        proposed = np.sort(proposed, axis=1)
        proposed = proposed[:, int((proposed < 0).sum(axis=1).min(initial=proposed.shape[1] - 1)) :]
        out = np.full((len(nodes), DEGREE), -1, np.int64)
        width = proposed.shape[1]
        step = max(1, _PAIRS // (width * max(width, self.vectors.shape[1])))
        for first in range(0, len(nodes), step):
            some = slice(first, first + step)
            away = self.vectors[np.maximum(proposed[some], 0)]
            away -= self.vectors[nodes[some], None, :]
            out[some] = _diverse(proposed[some], away, relaxed)
        return out

    def _insert(self, nodes: np.ndarray, relaxed: float) -> None:
        rows, _ = self.beam(self.vectors[nodes])
        self.edges[nodes] = self._pruned(
            nodes, np.concatenate([rows, self.edges[nodes]], axis=1), relaxed
        )
        source = np.repeat(nodes, DEGREE)
        target = self.edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hit, begin, count = np.unique(target, return_index=True, return_counts=True)
        for first in range(0, len(hit), _AT_ONCE):
            some = slice(first, first + _AT_ONCE)
            widest = int(count[some].max())
            nth = np.arange(widest)
            at = np.minimum(begin[some, None] + nth, len(source) - 1)
            back = np.where(nth < count[some, None], source[at], -1)
            together = np.concatenate([self.edges[hit[some]], back], axis=1)
            self.edges[hit[some]] = self._pruned(hit[some], together, relaxed)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def middles(points: np.ndarray, cells: int) -> np.ndarray:
    """The middles of ``cells`` groups of points, by moving them to their points' mean."""
    random = np.random.default_rng(cells)
    found = points[random.choice(len(points), min(cells, len(points)), replace=False)]
    for _ in range(_ROUNDS):
        at = nearest_of(points, found, 1)[:, 0]
        total = np.zeros_like(found)
        np.add.at(total, at, points)
        count = np.bincount(at, minlength=len(found))
        found = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], found)
    return found


def nearest_of(points: np.ndarray, found: np.ndarray, number: int) -> np.ndarray:
    """Per point the ``number`` nearest middles, nearest first."""
    size, out = (found**2).sum(axis=1), []
    for first in range(0, len(points), 4096):
        apart = size - 2 * points[first : first + 4096] @ found.T
        out.append(np.argsort(apart, axis=1, kind="stable")[:, :number])
    return np.concatenate(out) if out else np.zeros((0, number), np.int64)


def _cells(distinct: DataFrame, shards: int) -> dict[int, np.ndarray]:
    """Middles of cells per length of vectors, from the sample with the smallest hashes."""
    cells = min(shards, MOST_CELLS)
    sample = distinct.orderBy(F.xxhash64("embedding")).limit(CELL_SAMPLE * cells)
    points: dict[int, list] = {}
    for row in sample.select("embedding").collect():
        points.setdefault(len(row["embedding"]), []).append(row["embedding"])
    return {
        width: middles(np.array(some, np.float64), max(1, len(some) // CELL_SAMPLE))
        for width, some in points.items()
    }


def _visits(shared, number: int):
    """The cells nearest to a vector; vectors of a length that the sample lacked have one cell."""

    @F.arrow_udf("array<int>")
    def visits(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in vectors:
            rows = batch.to_pylist()
            widths = np.fromiter(map(len, rows), np.int64, len(rows))
            out: list[list[int]] = [[0]] * len(rows)
            for width in np.unique(widths).tolist():
                if width in shared.value:
                    at = np.flatnonzero(widths == width)
                    points = np.array([rows[i] for i in at.tolist()], np.float64)
                    cells = nearest_of(points, shared.value[width], number)
                    for i, some in zip(at.tolist(), cells.tolist(), strict=True):
                        out[i] = some
            yield pa.array(out, pa.list_(pa.int32()))

    return visits("embedding")


def within_reach(point: np.ndarray, reach: float, found: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Whether the cell of each middle may hold a vector within ``reach`` of the point.

    A vector of a cell is no nearer to another middle than to its own, so it lies beyond the plane
    half-way between the two. ``apart`` holds the distances between middles. The slack is more than
    the rounding of the distances by which vectors were given to cells.
    """
    size, long = np.sqrt((point**2).sum()), np.sqrt((found**2).sum(axis=1)).max()
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1e-9 * (size + long) * (size + long + (reach if np.isfinite(reach) else 0.0))
        squared = ((found - point) ** 2).sum(axis=1)
        beyond = squared[:, None] - squared[None, :] - slack > 2 * apart * reach
    return ~(beyond & (apart > 0)).any(axis=1)


def _rest(shared, number: int):
    """The cells that were not among the first ``number`` and may hold a vector within ``reach``."""

    @F.arrow_udf("array<int>")
    def rest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        apart: dict[int, np.ndarray] = {}
        for vectors, reaches in batches:
            out: list[list[int]] = []
            for row, reach in zip(vectors.to_pylist(), reaches.to_pylist(), strict=True):
                found = shared.value.get(len(row))
                if found is None or len(found) <= number:
                    out.append([])
                    continue
                if len(row) not in apart:
                    apart[len(row)] = np.stack([np.sqrt(((found - m) ** 2).sum(axis=1)) for m in found])
                point = np.array(row, np.float64)
                near = within_reach(point, reach, found, apart[len(row)])
                near[nearest_of(point[None, :], found, number)[0]] = False
                out.append(np.flatnonzero(near).tolist())
            yield pa.array(out, pa.list_(pa.int32()))

    return rest("embedding", "reach")


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """The graph of one shard, whose vectors have one length."""
    graph = Graph(_matrix(rows["embedding"]))
    out = rows.assign(edges=list(graph.edges), node=np.arange(len(rows)))
    return out[["shard", "node", "embedding", "ids", "edges"]]


def _opened(rows: pd.DataFrame) -> tuple[Graph, np.ndarray]:
    rows = rows.sort_values("node")
    graph = Graph(_matrix(rows["embedding"]), np.stack(rows["edges"].to_numpy()))
    return graph, rows["ids"].to_numpy()


def _ask(k: int):
    def ask(opened: tuple[Graph, np.ndarray], queries: pd.DataFrame) -> pd.DataFrame:
        graph, ids = opened
        out: list[tuple[int, int, float]] = []
        for first in range(0, len(queries), _AT_ONCE):
            part = queries.iloc[first : first + _AT_ONCE]
            found, apart = graph.beam(_matrix(part["embedding"]), QUERY_BEAM)
            for query, at, squared in zip(part["query_id"], found, apart, strict=True):
                near = [
                    (float(np.sqrt(d)), int(i))
                    for c, d in zip(at[: k + 1], squared[: k + 1], strict=True)
                    if c >= 0
                    for i in ids[c]
                    if i != query
                ]
                out.extend((int(query), i, d) for d, i in sorted(near)[:k])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return ask


def _shard() -> Column:
    """A shard's name: the length of its vectors, their cell, and a part of it."""
    return F.concat_ws("-", "width", "cell", "part").alias("shard")


def build_index(
    vectors: DataFrame, k: int = K
) -> tuple[DataFrame, DataFrame, Broadcast]:
    """(index, cells, middles): every usable distinct vector with its smallest ids and its edges,
    written; the number of parts of each cell; and the broadcast middles."""
    spark, kind = vectors.sparkSession, vectors.schema["embedding"].dataType.simpleString()
    distinct = materialise(
        gathered(vectors.select("vec_id", "embedding").distinct(), "embedding", "vec_id", k + 1),
        "vectors",
    )
    shards = pieces(distinct.count(), SHARD_VECTORS)
    shared = spark.sparkContext.broadcast(_cells(distinct, shards))
    placed = materialise(
        distinct.withColumns(
            {"width": F.size("embedding"), "cell": F.element_at(_visits(shared, 1), 1)}
        ),
        "placed-vectors",
    )
    parts = F.ceil(F.count(F.lit(1)) / SHARD_VECTORS).cast("int")
    cells = materialise(placed.groupBy("width", "cell").agg(parts.alias("parts")), "cells")
    part = F.pmod(F.xxhash64("embedding"), F.col("parts")).cast("int")
    dealt = placed.join(sized(cells), ["width", "cell"]).withColumn("part", part)
    # As many partitions as shards: building costs much more than a group's bytes tell.
    # Dealt by range: hashes of so few names would put several shards into some tasks, none into others.
    index = dealt.select(_shard(), "embedding", "ids").repartitionByRange(2 * shards, "shard")
    built = index.groupBy("shard").applyInPandas(
        _build, f"shard string, node long, embedding {kind}, ids array<long>, edges array<long>"
    )
    return materialise(built, "graph-index"), cells, shared


def search_graph(
    vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest other rows that were found.

    ``score`` is the Euclidean distance in double precision, ties go to the smaller id. Vectors that
    are NULL, zero, or hold NULL or non-finite components take no part, nor do rows without an id.
    Equal vectors are one node with its smallest ids, so copies cannot crowd a graph. Vectors stay
    floats where both sides have floats, and are doubles otherwise; nothing is rounded.
    """
    kinds = {df.schema[vector].dataType.simpleString() for df in (vectors, queries)}
    kind = "array<float>" if kinds == {"array<float>"} else "array<double>"
    clean = lambda df: df.where(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(vector).cast(kind).alias("embedding"),
    )
    index, cells, shared = build_index(clean(vectors), k)
    shards = cells.agg(F.sum("parts")).first()[0] or 1
    asking = clean(queries).withColumnRenamed("vec_id", "query_id").distinct()
    result = "query_id long, vec_id long, score double"

    def asked(of: DataFrame, visits: Column) -> DataFrame:
        part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        return (
            of.select(
                "query_id", "embedding", F.size("embedding").alias("width"), F.explode(visits).alias("cell")
            )
            .join(sized(cells), ["width", "cell"])
            .withColumn("part", part)
            .select("query_id", "embedding", _shard())
        )

    found = search(index, asked(asking, _visits(shared, PROBED)), 2 * shards, _opened, _ask(k), result)
    if max(map(len, shared.value.values()), default=0) > PROBED:
        first = materialise(nearest(found, k, "score").select("query_id", "vec_id", "score"), "first-found")
        reach = first.groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("reach")
        )
        # Fewer than ``k`` found: whatever there is may be an answer.
        reached = asking.join(reach, "query_id", "left").withColumn(
            "reach", F.coalesce("reach", F.lit(float("inf")))
        )
        more = materialise(asked(reached, _rest(shared, PROBED)), "more-asked")
        left = index.join(sized(more.select("shard").distinct()), "shard", "left_semi")
        found = first.unionByName(search(left, more, 2 * shards, _opened, _ask(k), result))
    return nearest(found, k, "score").select("query_id", "rank", "vec_id", "score")


def op10_graph(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return search_graph(vectors, vectors.where(F.col("vec_id") % 100 == 0))
