"""Secret scan with corpus-wide ownership, in DataFrame operations only.

Where a match lies: splitting a text by a pattern gives the stretches between its matches, and
extracting gives the matches, so a running sum over both lengths gives every start. Only texts that
hold a match are unfolded, and only numbers and matched values are shuffled, never texts.

Ownership: each candidate value is hashed and counted over the corpus by distinct repositories and by
distinct owners. A value that ``EXAMPLE_OWNERS`` owners have is a widely copied example; a value that
fewer keep looks live, whatever its kind. Hot values are aggregated where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.llm.rows import KEY, row_key, sized, table
from kontor.session import materialise

# Fixed patterns: assignments, access keys, hexadecimal strings, in the order of their kinds. The last
# two demand their length in the pattern; a shorter match can hide no longer one there. A short
# assignment can, so it is matched first and dropped afterwards.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
ASSIGN_LENGTH = 6
# Other long strings are candidates of the ownership rule alone: letters and digits mixed.
OWNED = r"[A-Za-z0-9+/_-]{20,}"
KINDS = [*BASE, "owned"]
#: A value with this many owners is a widely copied example.
EXAMPLE_OWNERS = 3


def _matches(docs: DataFrame, kind: str, pattern: str) -> DataFrame:
    """One row per match: key, repository, kind, start, end, value. Code points, end exclusive."""
    group = 2 if kind == "assign" else 0
    text = F.col("text")
    found = docs.where(text.rlike(pattern)).select(
        *KEY,
        "repository",
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    steps = F.arrays_zip(
        F.slice("between", F.lit(1), F.size("whole")).alias("between"), "whole", "value"
    )
    unfolded = found.select(*KEY, "repository", F.posexplode(steps).alias("n", "m")).select(
        *KEY,
        "repository",
        "n",
        F.length("m.between").alias("gap"),
        F.length("m.whole").alias("size"),
        F.col("m.value").alias("value"),
    ).dropDuplicates([*KEY, "repository", "n"])  # rows that are repeated in the input
    so_far = Window.partitionBy(*KEY, "repository").orderBy("n")
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return unfolded.select(
        *KEY,
        "repository",
        F.lit(kind).alias("kind"),
        F.lit(KINDS.index(kind)).alias("place"),
        (end - F.col("size")).alias("start"),
        end.alias("end"),
        "value",
    )


def _kept(kind: str) -> Column:
    if kind == "assign":
        return F.length("value") >= ASSIGN_LENGTH
    if kind == "owned":
        return F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    return F.lit(True)


def owner_of(repository: Column) -> Column:
    """The owner's part of a repository name: what stands before the first slash."""
    return F.split_part(repository, F.lit("/"), F.lit(1))


def scan(
    docs: DataFrame, text: str = "text", key: str = "doc_id", repository: str = "source"
) -> DataFrame:
    """The candidate spans of all texts: row key, kind, start, end, value, owners, live.

    ``live`` is true where fewer than ``EXAMPLE_OWNERS`` owners have the value. The kind ``owned`` is
    added by the ownership rule: long mixed strings outside every base span whose value is live in the
    same sense, so that a mirror of a repository hides nothing. A NULL repository counts as one of its own, without an owner. NULL and empty texts have
    no spans; repeated rows have the same spans, listed once per row key.
    """
    name = F.coalesce(F.col(repository).cast("string"), F.lit(""))
    keyed = docs.select(
        *row_key(key, text), name.alias("repository"), F.col(text).alias("text")
    ).where(F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}|{OWNED}"))
    # Only texts that hold a candidate are read again, once per kind.
    parts = [_matches(keyed, k, p).where(_kept(k)) for k, p in {**BASE, "owned": OWNED}.items()]
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    spans = materialise(
        spans.withColumns({"v1": F.xxhash64("value"), "v2": F.hash("value")}),
        "secret-spans",
    )
    owners = (
        spans.groupBy("v1", "v2", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("v1", "v2")
        .agg(
            F.count(F.lit(1)).alias("repositories"),
            F.countDistinct(owner_of(F.col("repository"))).alias("owners"),
        )
        .withColumn("h", F.xxhash64("v1", "v2"))
    )
    known = spans.withColumn("h", F.xxhash64("v1", "v2")).join(owners, ["v1", "v2", "h"])
    live = F.col("owners") < EXAMPLE_OWNERS
    return known.where((F.col("kind") != "owned") | live).select(
        *KEY, "kind", "place", "start", "end", "value", "repositories", "owners", live.alias("live")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def span_summary(spans: DataFrame) -> DataFrame:
    """Per row key: counts, the joined base spans and all spans, and how many look live."""
    listed = spans.groupBy(*KEY).agg(
        F.array_sort(
            F.collect_set(F.struct("start", "place", "end", "kind", "live"))
        ).alias("s")
    )
    # An added span that touches a base span says nothing new.
    base = F.filter("s", lambda x: x["place"] < len(BASE))
    listed = listed.withColumn("base", base)
    added = F.filter(
        "s",
        lambda x: (x["place"] == len(BASE))
        & ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    every = F.array_sort(F.concat("base", added))
    counts = {f"n_{kind}": _count("base", kind) for kind in BASE}
    return listed.withColumn("every", every).select(
        *KEY,
        *[c.alias(n) for n, c in counts.items()],
        _joined(F.col("base")).alias("base_spans"),
        _joined(F.col("every")).alias("spans"),
        F.size(F.filter("every", lambda x: x["live"])).cast("long").alias("n_live"),
        F.transform("every", lambda x: F.struct(x["start"], x["end"], x["live"])).alias("places"),
    )


def redacted(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    repository: str = "source",
    marker: str = "<secret>",
) -> DataFrame:
    """``docs`` with ``marker`` in place of every live-looking secret; overlapping spans give one.

    Widely copied examples stay. Rows without a live secret are returned as they are.
    """
    found = span_summary(scan(docs, text, key, repository)).where("n_live > 0")
    live = F.filter("places", lambda p: p["live"])
    places = sized(
        materialise(found.select(*KEY, live.alias("places")), "secret-places"), F.size("places")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = F.col(f"row.`{text}`")

    def step(done: Column, place: Column) -> Column:
        apart = place["start"] >= done["at"]
        between = F.substring(
            whole, (done["at"] + 1).cast("int"), (place["start"] - done["at"]).cast("int")
        )
        return F.struct(
            F.when(apart, F.concat(done["out"], between, F.lit(marker)))
            .otherwise(done["out"])
            .alias("out"),
            F.greatest(done["at"], place["end"]).cast("long").alias("at"),
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rest = lambda done: F.concat(
        done["out"], F.substring(whole, (done["at"] + 1).cast("int"), F.length(whole))
    )
    clean = F.when(F.col("places").isNull(), whole).otherwise(
        F.aggregate("places", begin, step, rest)
    )
    return (
        docs.select(row, *row_key(key, text))
        .join(places, KEY, "left")
        .select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
    )


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    summary = materialise(span_summary(scan(docs)), "secret-summary")
    none = F.lit(0).cast("long")
    base = F.coalesce("base_spans", F.lit(""))
    return (
        docs.select("doc_id", *row_key("doc_id", "text"))
        .join(summary, KEY, "left")
        .select(
            "doc_id",
            *[F.coalesce(f"n_{kind}", none).alias(f"n_{kind}") for kind in BASE],
            F.sha2(base.cast("binary"), 256).alias("base_sha256"),
            F.coalesce("spans", F.lit("")).alias("spans"),
            F.coalesce("n_live", none).alias("n_live"),
        )
    )
