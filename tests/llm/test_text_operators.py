"""Fill-in-the-middle, decontamination and collocations against plain versions and their SQL."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, ODD, clashing, rows_of, sample

from kontor.llm import collocations, decontamination, fill_in_middle
from kontor.llm.registry import QUERIES, SQL
from kontor.llm.rows import prepared

FOLDER = "/root/testdata/sf0.001"
BENCH = "item_id long, text string"


@pytest.fixture(autouse=True)
def _small_batches(spark):
    prepared(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_sql(name, **tables):
    con = duckdb.connect()
    for table, rows in tables.items():
        con.register(f"{table}_frame", rows)
        con.execute(f"create view {table} as select * from {table}_frame")
    return sorted(con.execute(SQL[name]).fetchall(), key=str)


def given(folder, *names):
    con = duckdb.connect()
    for name in names:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


@pytest.mark.parametrize(
    "name", ["op11_fill_in_middle", "op12_decontamination", "op13_collocations"]
)
def test_registered_queries_match_their_sql(spark, name):
    folder = "/root/testdata/sf0.01" if name.startswith("op13") else FOLDER
    got = QUERIES[name](spark, folder)
    result = given(folder, "documents", "benchmark").execute(SQL[name])
    assert got.columns == [d[0] for d in result.description]
    expected = sorted(result.fetchall(), key=str)
    assert len(expected) > 100
    assert rows_of(got, *got.columns) == expected


# Fill-in-the-middle


def rearranged(text, key, recipe=fill_in_middle.Recipe()):
    """The rule line by line, without the library's match."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"{recipe.seed}:{'' if key is None else key}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in recipe.markers) or h[2] % 100 >= recipe.rate:
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    before, middle, after = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    p, s, m = recipe.markers
    if h[3] % 100 < recipe.suffix_first:
        out = f"{s}{after}{p}{before}{m}{middle}", "spm"
    else:
        out = f"{p}{before}{s}{after}{m}{middle}", "psm"
    return len(lines), out[1], len(before), len(middle), out[0]


def lined():
    random.seed(11)
    bits = ["a", "é", "\n", "\n", "\r", "<", "<P", ">", "S>", "😀", " ", " ", "\x0b", "\x00"]
    rows = [(i, "".join(random.choice(bits) for _ in range(random.randint(0, 40)))) for i in range(300)]
    rows += [(400, "\n"), (401, "\n\n\n"), (402, "x"), (403, "x\n"), (404, "a<S>b\nc")]
    rows += [(405, "<P>"), (406, "line\n" * 50_000), (407, "w" * 300_000), rows[3], rows[3]]
    return [*rows, *ODD, (-5, "negative\nid\n")]


RECIPES = [
    fill_in_middle.Recipe(),
    fill_in_middle.Recipe(seed=1, rate=40, suffix_first=100, prefix="[pre]", suffix="[suf]",
                          middle="[mid]"),
]


@pytest.mark.parametrize("recipe", RECIPES)
def test_middles_move_to_the_end(spark, recipe):
    rows = lined()
    got = fill_in_middle.fill_in_middle(clashing(spark.createDataFrame(rows, DOCS)), recipe)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    expected = [(key, *rearranged(text, key, recipe)) for key, text in rows]
    assert rows_of(got, *got.columns) == sorted(expected, key=str)
    assert {form for _, _, form, *_ in expected} >= {"plain", "spm"}


@pytest.mark.parametrize("recipe", RECIPES)
def test_texts_are_rebuilt_from_output_and_form(spark, recipe):
    rows = lined()
    got = fill_in_middle.fill_in_middle(spark.createDataFrame(rows, DOCS), recipe)
    back = got.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form"), recipe))
    assert rows_of(back, *back.columns) == sorted([(k, t or "") for k, t in rows], key=str)


def test_the_query_of_odd_texts_matches_its_sql(spark, tmp_path):
    df = spark.createDataFrame([r for r in lined() if "\0" not in (r[1] or "")], DOCS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_fill_in_middle"](spark, str(tmp_path))
    expected = by_sql("op11_fill_in_middle", documents=df.toPandas().astype({"doc_id": "Int64"}))
    assert rows_of(got, *got.columns) == expected


def test_other_units_and_markers(spark):
    words = fill_in_middle.Recipe(unit=r"\S+\s*|\s+")
    df = spark.createDataFrame([(i, "one two  three four ") for i in range(20)], DOCS)
    rows = fill_in_middle.fill_in_middle(df, words).collect()
    assert {r.n for r in rows} == {4} and len({r.output for r in rows}) > 5
    digits = fill_in_middle.Recipe(unit="[0-9]")
    assert fill_in_middle.fill_in_middle(df, digits).where("form != 'plain' or n > 0").isEmpty()
    for markers in (("<P>", "<P>x", "<M>"), ("", "a", "b"), ("aba", "c", "d"), ("<P", "P>", "M")):
        with pytest.raises(ValueError):
            fill_in_middle.Recipe(prefix=markers[0], suffix=markers[1], middle=markers[2])


# Decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def hit_words(rows, items, size):
    """Per row: id, words, hit words, items, spans, by comparing every place with every window."""
    owners = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            owners.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in owners}
    out = []
    for key, text in rows:
        found = list(WORD.finditer(lowered(text)))
        words = [m.group() for m in found]
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in owners:
                    hit |= set(range(i, i + n))
                    names |= owners[tuple(words[i : i + n])]
        spans = [(found[i].start(), found[i].end()) for i in sorted(hit)]
        runs = []
        for i, (start, end) in zip(sorted(hit), spans, strict=True):
            if i - 1 in hit:
                runs[-1] = (runs[-1][0], end)
            else:
                runs.append((start, end))
        listed = sorted(str(x) for x in names if x is not None)
        out.append((key, len(words), len(hit), runs, listed))
    return sorted(out, key=str)


def leaking():
    random.seed(21)
    vocabulary = ["a", "b", "É", "é", "c1", "日本", "x" * 300]
    gaps = [" ", ", ", "\n\n", "-", "😀 ", "\t", "_"]
    text = lambda n: "".join(random.choice(vocabulary) + random.choice(gaps) for _ in range(n))
    items = [(i, text(random.randint(1, 9))) for i in range(25)]
    items += [(30, "B a"), (31, "b A b"), (9, "a a a a a a a"), (10, "a a a a a a a"), (None, "c1 c1")]
    items += [(32, None), (33, ""), (34, " ,.-"), items[0], (35, items[1][1]), (100, items[1][1])]
    rows = [(i, text(random.randint(0, 60))) for i in range(120)]
    rows += [(200, items[2][1] + "!"), (201, "ab " + items[30][1] if items[30][1] else "ab"), rows[5]]
    return [*rows, *ODD, rows[5], (300, "b a " * 30_000)], items


@pytest.mark.parametrize(("size", "shard", "segment"), [(3, 200_000, 4_096), (4, 9, 6), (10, 40, 12)])
def test_words_in_windows_of_items(spark, monkeypatch, size, shard, segment):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontamination, "SEGMENT", segment)
    monkeypatch.setattr(decontamination, "_BLOCK", 50)
    rows, items = leaking()
    got = decontamination.contamination(
        clashing(spark.createDataFrame(rows, DOCS)), clashing(spark.createDataFrame(items, BENCH)), size
    )
    mine = [
        (r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"]) for r in got.collect()
    ]
    assert sorted(mine, key=str) == hit_words(rows, items, size)


def test_contamination_of_the_given_tables(spark):
    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    got = QUERIES["op12_decontamination"](spark, FOLDER)
    expected = [
        (key, n, hit, len(ids), sha(",".join(ids)), hit > 0)
        for key, n, hit, _, ids in hit_words(sample(), items, 10)
    ]
    assert any(row[5] for row in expected)
    assert rows_of(got, *got.columns) == sorted(expected, key=str)


def test_decontamination_without_rows_or_items(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, None)], DOCS), spark.createDataFrame([], BENCH)
    clean = decontamination.contamination(docs, items)
    assert rows_of(clean, "doc_id", "n_words", "n_hit") == [(1, 2, 0), (2, 0, 0)]
    some = spark.createDataFrame([(1, "a b")], BENCH)
    assert decontamination.contamination(docs.limit(0), some).isEmpty()


# Collocations


def counted(rows, longest, least, covered, top):
    """The contract by dictionaries; rows are (lang, text)."""
    freq, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    freq[lang, tuple(words[i : i + size])] += 1
    cand = {k: f for k, f in freq.items() if len(k[1]) > 1 and f >= least}
    dropped = set()
    for (lang, words), f in cand.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                if 100 * f >= covered * cand[part]:
                    dropped.add(part)
    out = {}
    for (lang, words), a in cand.items():
        if (lang, words) not in dropped:
            cuts = []
            for k in range(1, len(words)):
                left, right = freq[lang, words[:k]], freq[lang, words[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            phrase = " ".join(words)
            out.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    final = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            final.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(final, key=str)


def spoken():
    random.seed(31)
    vocabulary = ["the", "The", "of", "é", "É", "日本", "x\x1cy", "\x00", "new", "york", "w" * 200]
    gaps = [" ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", ": ", "　", "\x85"]
    rows = []
    for _ in range(200):
        words = "".join(random.choice(vocabulary) + random.choice(gaps) for _ in range(80))
        rows.append((random.choice(["en", "en", "de", None, "und"]), words))
    rows += [("fr", None), ("fr", ""), ("it", "..."), ("it", " , "), rows[0], rows[0], (None, None)]
    return [*rows, ("en", "new york city " * 4000), ("es", "uno dos tres cuatro cinco. " * 40)]


SPOKEN = "lang string, text string"


def collocated(spark, rows, *parameters):
    df = clashing(spark.createDataFrame(rows, SPOKEN).repartition(5))
    return collocations.collocations(df, *parameters)


@pytest.mark.parametrize("tokens", [1 << 18, 50])
@pytest.mark.parametrize(("longest", "least", "covered", "top"), [(4, 30, 80, 2000), (3, 5, 40, 20)])
def test_collocations(spark, monkeypatch, tokens, longest, least, covered, top):
    monkeypatch.setattr(collocations, "_TOKENS", tokens)
    monkeypatch.setattr(collocations, "_BLOCK", tokens)
    monkeypatch.setattr(collocations, "_GATHERED", 40 * tokens)
    monkeypatch.setattr(collocations, "PARTITION_MASS", 30_000)
    got = collocated(spark, spoken(), longest, least, covered, top)
    expected = counted(spoken(), longest, least, covered, top)
    assert {row[0] for row in expected} >= {"en", "es", "und"}
    assert rows_of(got, *got.columns) == expected


def test_a_crowded_filter_lets_through_but_changes_nothing(spark, monkeypatch):
    expected = rows_of(df := collocated(spark, spoken()), *df.columns)
    monkeypatch.setattr(collocations, "_LEAST_BITS", 10)
    monkeypatch.setattr(collocations, "_MOST_BITS", 10)
    assert rows_of(df := collocated(spark, spoken()), *df.columns) == expected


def test_summaries_keep_every_frequent_hash():
    rng = np.random.default_rng(4)
    for _ in range(40):
        stream = np.concatenate([rng.integers(0, 4000, 20_000), rng.zipf(1.3, 10_000) % 4000])
        rng.shuffle(stream)
        least = int(rng.integers(10, 60))
        truth = Counter(stream.tolist())
        mass = len(stream)
        summaries = []
        for part in np.array_split(stream, 30):
            found, counts = np.unique(part.astype(np.uint64), return_counts=True)
            assert all((a == b).all() for a, b in zip(
                collocations.unpacked(collocations.packed(found, counts)), (found, counts), strict=True
            ))
            summaries.append((found, counts))
        summary = collocations.Summary(2 * -(-mass // least) + 1, least // 2)
        for found, counts in summaries:
            summary.add(found, counts)
        kept = set(summary.survivors(least).tolist())
        assert {h for h, n in truth.items() if n >= least} <= kept
        assert summary.error <= least // 2
        assert len(summary.hashes) <= summary.capacity
        exact = dict(zip(summary.hashes.tolist(), summary.counts.tolist(), strict=True))
        assert all(n - summary.error <= exact.get(h, 0) <= n for h, n in truth.items())


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    rows = [("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "", 0, 3 * big)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    got = collocations.ranked(frequent, 80, 10).collect()
    assert [tuple(r) for r in got] == [
        ("en", 1, "a b", big, big, big + 1, 3 * big, 2_000_000 * big // (2 * big + 1))
    ]


def test_no_texts_have_no_collocations(spark):
    none = spark.createDataFrame([], SPOKEN)
    assert collocations.collocations(none).isEmpty()
    assert collocations.collocations(spark.createDataFrame([("en", None)], SPOKEN)).isEmpty()
