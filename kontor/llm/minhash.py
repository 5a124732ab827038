"""Near-duplicate detection with HyperMinHash registers.

Sketch: the hashes of a document's shingles are dealt to buckets by their leading part; each bucket
keeps the smallest rest as a count of leading zeros and a few mantissa bits. An empty bucket borrows
from a filled one in an order of its own. Registers are banded: ``BANDS`` keys of ``ROWS`` registers.
A pair at the threshold misses all bands with probability 9e-8.

Candidates
1. Documents with equal sets are one class, and its smallest id stands for it.
2. Each bucket of a band is a star: its members are paired with its smallest one. Of its hubs a
   member first meets those it shares most bands with. Pairs are estimated from the registers,
   corrected for chance collisions, and confirmed on full sets.
3. Only pairs in a common bucket that the links so far do not connect are still open. In buckets of up
   to ``SMALL`` members they are listed. Larger buckets chain up to clusters, in which whatever is not
   in the main component meets all members, block by block; nothing is listed there but links.
4. Components of all links.

So all pairs within a bucket are either connected, or compared on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.llm.components import components
from kontor.llm.rows import KEY, row_key, sized, table, tidied
from kontor.session import materialise

WORDS = 5
#: Similarity in hundredths from which two documents are linked.
SIMILAR = 75
BANDS, ROWS = 60, 5
MANTISSA = 10
REGISTERS = BANDS * ROWS
#: Members of a bucket whose open pairs are listed one by one.
SMALL = 64
#: Hubs that a member meets first.
HUBS = 3
_BLOCK, _AGAINST = 512, 2048

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_BOUNDS = (np.arange(REGISTERS, dtype=np.uint64)) * np.uint64(2**64 // REGISTERS)
_BORROW = np.argsort(_random.random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)
_digest = xxhash.xxh3_64_intdigest


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words make one shingle, none make none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_digest, words), np.uint64, len(words))
    count = min(WORDS, len(words))
    size = len(words) - count + 1
    total = np.full(size, count, np.uint64)
    for i in range(count):
        total = total + hashes[i : i + size] * _FACTORS[i]
        total = total ^ (total >> np.uint64(29))
    return np.unique(_mixed(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """One number per bucket: its leading zeros and mantissa, with the bucket that it came from."""
    edges = np.append(np.searchsorted(hashes, _BOUNDS), len(hashes))
    filled = edges[1:] > edges[:-1]
    own = np.flatnonzero(filled)
    rest = (hashes[edges[own]] - _BOUNDS[own]) * np.uint64(REGISTERS)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    mantissa = (np.maximum(fraction * 2 - 1, 0) * (1 << MANTISSA)).astype(np.int64)
    values = np.zeros(REGISTERS, np.int64)
    values[own] = ((64 - exponent).astype(np.int64) << MANTISSA | mantissa) * REGISTERS + own
    empty = np.flatnonzero(~filled)
    if len(empty):
        values[empty] = values[own[_BORROW[empty][:, own].argmin(axis=1)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    grid = values.astype(np.uint64).reshape(BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        total = _mixed(total + grid[:, i] * _FACTORS[8 + i])
    return total.view(np.int64)


def estimate(one: np.ndarray, two: np.ndarray) -> float:
    """Jaccard similarity from registers: the share that agrees, less what agrees by chance.

    Two unrelated registers agree in their leading zeros with probability 1/3 and then in the mantissa
    with 2 ** -MANTISSA.
    """
    chance = 1 / (3 << MANTISSA)
    return (float((one == two).mean()) - chance) / (1 - chance)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, first, second, bands = [], [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text)
            name = xxhash.xxh3_128_digest(found.tobytes())
            a, b = np.frombuffer(name, np.int64).tolist()
            sizes.append(len(found))
            first.append(a)
            second.append(b)
            bands.append(band_keys(registers(found)) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("k1"), batch.column("k2"),
             pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
             pa.array(second, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", *KEY, "n", "s1", "s2", "bands"],
        )


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"),
             pa.array([registers(s).astype(np.int32).tobytes() for s in sets], pa.binary()),
             pa.array([s.tobytes() for s in sets], pa.binary())],
            ["rep", "sketch", "hashes"],
        )


def _linked(shared: np.ndarray | int, one, two) -> np.ndarray | bool:
    return 100 * shared >= SIMILAR * (one + two - shared)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        a, b = [], []
        for x, y, sketch_x, set_x, sketch_y, set_y in zip(*columns, strict=True):
            one, two = np.frombuffer(set_x, np.uint64), np.frombuffer(set_y, np.uint64)
            # Six standard deviations below the threshold; small sets are always compared.
            margin = 6 * np.sqrt(0.1875 / min(REGISTERS, len(one), len(two)))
            near = estimate(np.frombuffer(sketch_x, np.int32), np.frombuffer(sketch_y, np.int32))
            if near < SIMILAR / 100 - margin:
                continue
            at = np.minimum(np.searchsorted(one, two), len(one) - 1)
            if _linked(int((one[at] == two).sum()), len(one), len(two)):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _confirmed(pairs: DataFrame, full: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets, written."""
    one = full.select(F.col("rep").alias("a"), F.col("sketch").alias("x"), F.col("hashes").alias("xs"))
    two = full.select(F.col("rep").alias("b"), F.col("sketch").alias("y"), F.col("hashes").alias("ys"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "xs", "y", "ys")
    return materialise(both.mapInArrow(tidied(_confirm), "a long, b long"), name)


def _across(asked: pd.DataFrame, against: pd.DataFrame) -> pd.DataFrame:
    """Links between asked documents and others of another component, one per component of theirs."""
    out: list[tuple[int, int]] = []
    if asked.empty or against.empty:
        return pd.DataFrame(out, columns=["a", "b"])
    sets = [np.frombuffer(s, np.uint64) for s in against["hashes"]]
    sizes = np.array([len(s) for s in sets])
    universe, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    ids, component = against["rep"].to_numpy(), against["root"].to_numpy()
    has = np.zeros(len(universe), bool)
    for rep, root, raw in zip(asked["rep"], asked["root"], asked["hashes"], strict=True):
        own = np.frombuffer(raw, np.uint64)
        at = np.minimum(np.searchsorted(universe, own), len(universe) - 1)
        at = at[universe[at] == own]
        has[at] = True
        shared = np.add.reduceat(has[numbers], begins, dtype=np.int64)
        has[at] = False
        hit = np.flatnonzero(_linked(shared, len(own), sizes) & (component != root))
        _, one = np.unique(component[hit], return_index=True)
        out.extend((int(rep), int(ids[i])) for i in hit[one])
    return pd.DataFrame(out, columns=["a", "b"])


def _in_clusters(big: DataFrame, roots: DataFrame, full: DataFrame) -> DataFrame:
    """Links that are still missing inside the clusters of large buckets.

    ``big``: key, rep, lo. Per cluster, documents outside the main component are compared with all
    members in blocks, so the cost is that of comparing every unconnected pair once.
    """
    clusters = components(big.select(F.col("lo").alias("a"), F.col("rep").alias("b")))
    members = materialise(
        clusters.select(F.col("node").alias("rep"), F.col("root").alias("cluster"))
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep")),
        "clusters",
    )
    counts = members.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("cluster").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("all"),
        F.max("n").alias("most"),
    )
    # A cluster's number of blocks on either side, and each row's block by its hash.
    sizes = materialise(
        main.where(F.col("all") > F.col("most")).select(
            "cluster", "main",
            F.ceil((F.col("all") - F.col("most")) / _BLOCK).cast("int").alias("rows"),
            F.ceil(F.col("all") / _AGAINST).cast("int").alias("columns"),
        ),
        "cluster-sizes",
    )
    of = members.join(sized(sizes), "cluster").join(full.select("rep", "hashes"), "rep")
    placed = of.withColumns(
        {
            "row": F.pmod(F.xxhash64("rep"), F.col("rows")).cast("int"),
            "column": F.pmod(F.xxhash64("rep"), F.col("columns")).cast("int"),
        }
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = placed.where(F.col("root") != F.col("main")).withColumn("column", every("columns"))
    against = placed.withColumn("row", every("rows")).toDF(*placed.columns)
    block = ["cluster", "row", "column"]
    return asked.groupBy(*block).cogroup(against.groupBy(*block)).applyInPandas(
        _across, "a long, b long"
    )


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and the row key.

    A NULL, empty or blank text has no shingles, links with nothing and is its own component. Rows with
    a NULL id are classed with their copies and otherwise link with nothing; alone, their component
    is NULL and they are kept. Repeated rows share a component. Other columns are not read.
    """
    source = docs.select(
        F.col(key).cast("long").alias("doc_id"), *row_key(key, text), F.col(text).alias("text")
    )
    schema = "doc_id long, k1 long, k2 long, n long, s1 long, s2 long, bands array<long>"
    sketches = materialise(source.mapInArrow(tidied(_sketch), schema), "sketches")
    classes = sized(
        materialise(
            sketches.where("n > 0").groupBy("s1", "s2")
            .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
            .where("copies > 1").select("s1", "s2", "rep"),
            "classes",
        )
    )
    rep = F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id"))
    named = sketches.join(classes, ["s1", "s2"], "left").withColumn("rep", rep)
    banded = named.where("n > 0 and doc_id is not null and doc_id = rep").select(
        "rep", F.explode("bands").alias("key")
    )
    buckets = materialise(
        banded.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("lo"), F.max("rep").alias("hi"))
        .where("n > 1 and lo != hi"),
        "buckets",
    )
    wide = sized(materialise(buckets.where("n > 2").select("key", "n", "lo"), "wide-buckets"))
    members = materialise(banded.join(wide, "key"), "bucket-members")
    twos = buckets.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))

    stars = materialise(
        members.where("rep != lo").select(F.col("lo").alias("a"), F.col("rep").alias("b"))
        .unionByName(twos).groupBy("a", "b").agg(F.count(F.lit(1)).alias("bands")),
        "star-pairs",
    )
    best = Window.partitionBy("b").orderBy(F.desc("bands"), "a")
    first = materialise(
        stars.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= HUBS)
        .select("a", "b"),
        "first-pairs",
    )

    candidates = materialise(
        stars.select(F.col("a").alias("doc_id")).union(stars.select("b")).distinct(), "candidates"
    )
    wanted = source.select("doc_id", *KEY, "text").join(sized(candidates), "doc_id", "left_semi")
    # One set for each row key: rows repeated m and n times would link m * n times. Only texts of
    # repeated rows are shuffled.
    again = sized(
        materialise(
            sketches.where("n > 0 and doc_id is not null")
            .groupBy(*KEY).count().where("count > 1").select(*KEY),
            "repeated-rows",
        )
    )
    once = wanted.join(again, KEY, "left_anti").unionByName(
        wanted.join(again, KEY, "left_semi").dropDuplicates(KEY)
    )
    full = materialise(
        once.select("doc_id", "text").mapInArrow(tidied(_full), "rep long, sketch binary, hashes binary"),
        "full-sets",
    )
    links = _confirmed(first, full, "links")
    roots = materialise(components(links), "roots")

    labelled = members.join(
        roots.select(F.col("node").alias("rep"), "root"), "rep", "left"
    ).withColumn("root", F.coalesce("root", "rep"))
    labelled = materialise(labelled, "labelled-members")
    mixed = sized(
        materialise(
            labelled.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"))
            .where("r != s").select("key"),
            "mixed-buckets",
        )
    )
    still = labelled.join(mixed, "key", "left_semi")
    left = still.where(F.col("n") < SMALL).select("key", F.col("rep").alias("a"), F.col("root").alias("p"))
    right = still.where(F.col("n") < SMALL).select("key", F.col("rep").alias("b"), F.col("root").alias("q"))
    listed = left.join(right, "key").where("a < b and p != q").select("a", "b")
    rest = listed.unionByName(twos).distinct().join(first, ["a", "b"], "left_anti")
    more = _confirmed(rest, full, "more-links")
    clustered = _in_clusters(still.where(F.col("n") >= SMALL), roots, full)
    edges = (
        roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
        .unionByName(more)
        .unionByName(clustered)
    )
    final = materialise(components(edges), "final-roots")
    return (
        named.select("doc_id", "n", "rep", *KEY)
        .join(sized(final.where("node != root")), F.col("rep") == F.col("node"), "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("root", "rep").alias("component_id"),
            *KEY,
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def one_per_group(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id.

    Rows that repeat in id and text count as one document. Only row keys are shuffled, save for rows
    that are repeated.
    """
    found = materialise(near_duplicates(docs, text, key).select(*KEY, "kept"), "near-duplicates")
    dropped = sized(materialise(found.where("not kept").select(*KEY).distinct(), "dropped"))
    again = sized(
        materialise(
            found.where("kept").groupBy(*KEY).count().where("count > 1").select(*KEY), "repeated"
        )
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(row, *row_key(key, text)).join(dropped, KEY, "left_anti")
    once = kept.join(again, KEY, "left_anti")
    collapsed = kept.join(again, KEY, "left_semi").dropDuplicates(KEY)
    return once.unionByName(collapsed).select("row.*")


def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
