"""The stages on a small corpus, each against a plain version on its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_operators import grouped, without_repeats

from kontor.llm.rows import prepared
from kontor.session import materialise

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    prepared(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = docs.limit(1).withColumns({"doc_id": F.lit(-1).cast("long"), "text": F.lit("12 34")})
    docs = materialise(docs.unionByName(extra), "with-junk")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = materialise(stage(spark, docs, FOLDER), name)
        if name != "packing":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in docs.collect()}
        if name == "language":
            assert set(after) == {key for key, _ in before} - {-1}
        elif name == "near_dedup":
            assert set(after) == {key for key, _, _, kept in grouped(before) if kept}
        elif name == "suffix_dedup":
            removed = {key: gone for key, _, gone, _, _ in without_repeats(before, 400)}
            for key, text in before:
                assert abs(len(text.encode()) - removed[key] - len(after[key].encode())) <= 6
        elif name == "secrets":
            assert set(after) == {key for key, _ in before}
        else:
            assert docs.where("length > 2048 or offset != 0").isEmpty()
            assert docs.groupBy("doc_id").agg(
                F.sum("length").alias("n"), F.max("doc_tokens").alias("m")
            ).where("n != m").isEmpty()


FOREIGN = [
    "La mattina dopo il sindaco annunciò che la strada principale sarebbe rimasta chiusa per tutta "
    "la settimana a causa dei lavori.",
    "De volgende ochtend kondigde de burgemeester aan dat de hoofdstraat de hele week gesloten zou "
    "blijven vanwege werkzaamheden.",
    "Następnego ranka burmistrz ogłosił, że główna ulica będzie zamknięta przez cały tydzień z powodu "
    "robót drogowych.",
    "Seuraavana aamuna pormestari ilmoitti, että pääkatu olisi suljettuna koko viikon tietöiden "
    "vuoksi.",
    "Ertesi sabah belediye başkanı ana caddenin yol çalışmaları nedeniyle bütün hafta kapalı "
    "kalacağını duyurdu.",
    "A doua zi dimineața primarul a anunțat că strada principală va fi închisă toată săptămâna din "
    "cauza lucrărilor.",
    "Доброе утро, главная улица сегодня закрыта.",
]
SHORT = ["Good morning.", "Das Haus ist alt.", "Buenos días.", "La maison est vieille.", "Yes",
         "Bonjour.", "No tengo tiempo.", "Thank you very much for your help."]


@pytest.mark.parametrize("label", [None, "en"])
def test_language_rejects_foreign_texts_and_keeps_short_ones(spark, label):
    """Foreign texts go, also where a few carry the label of a learned language."""
    prepared(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = dict(enumerate(FOREIGN + SHORT, start=-100))
    lang = F.lit(label).cast("string")
    extra = spark.createDataFrame(list(texts.items()), "doc_id long, text string").select(
        "doc_id", "text", lang.alias("lang"), F.lit("x/y").alias("source"),
        F.length("text").cast("long").alias("n_chars"),
    )
    kept = corpus_pipeline.language(spark, docs.unionByName(extra), "")
    assert kept.columns == docs.columns
    assert {r.text for r in kept.where("doc_id < 0").collect()} == set(SHORT)
    letters = docs.where(r"text rlike '\\p{L}'")
    assert kept.where("doc_id >= 0").count() == letters.count()


NAMES = ["score", "lang_pred", "n_grams", "verdict", "Kept", "n_bytes", "n_removed", "kept_text", "k1",
         "row", "a b", "places", "component_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} goes on" for i in range(40_000))
#: NULLs in every column, empty and long texts, ties, and rows that are there several times.
EDGES = [
    (1, "the first of two", "en", "a/b", 16), (1, "the first of two", "en", "a/b", 16),
    (2, None, "en", "a/b", None), (3, "", None, None, 0), (4, "   ", "en", "a/b", 3),
    (5, LONG, "en", "a/b", len(LONG)), (6, LONG + " end", "en", "c/d", None),
    (7, "token=abcdefabcdef is a secret of this one", "en", "c/d", 1),
    (8, "the first of two of two", None, None, None), (9, "12 34", "en", "x/y", 5),
    (5, LONG, "en", "a/b", len(LONG)),
]


def edges(spark):
    extra = {name: F.concat(F.lit(f"mine {name} "), F.coalesce("doc_id", F.lit(0))) for name in NAMES}
    return spark.createDataFrame(EDGES, SCHEMA).withColumns(extra)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_every_column_of_odd_rows(spark, name):
    prepared(spark)
    docs = materialise(edges(spark), "odd")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    for row in rows:
        assert all(row[column] == f"mine {column} {row.doc_id}" for column in NAMES)
    got = sorted((r.doc_id, r.text) for r in rows if r.text is not None)
    if name == "language":
        assert [key for key, _ in got] == [1, 1, 5, 5, 6, 7, 8]
    elif name == "near_dedup":
        assert [key for key, _ in got] == [1, 3, 4, 5, 7, 8, 9]
        assert [r.doc_id for r in rows if r.text is None] == [2]
    elif name == "suffix_dedup":
        removed = {key: kept for key, kept in got}
        assert len(got) == 10 and removed[1] == "the first of two" and len(removed[5]) < 400
        assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    else:
        assert dict(got)[7] == "<secret> is a secret of this one" and len(got) == 10
        assert dict(got)[5] == LONG


def test_packing_of_odd_rows(spark):
    prepared(spark)
    packed = corpus_pipeline.packing(spark, materialise(edges(spark), "odd"), "")
    total = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id for r in total} == set(range(1, 10))
    assert {r.doc_id: r.n for r in total}[3] == 1


def test_stages_on_an_empty_table(spark):
    prepared(spark)
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").isEmpty()


def test_texts_are_judged_once_a_row(spark):
    """The verdict is one Python call per row, and rows do not pass through Python."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = corpus_pipeline.language(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
