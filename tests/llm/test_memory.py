"""What tasks and their Python workers hold at once: batches, worker processes, columns moved."""

import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from kontor.llm import language, suffix_dedup
from kontor.llm.rows import prepared

DOCS = "doc_id long, text string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark):
    rows = [
        (i, f"the house of number {i} is old and the street is long", "en", "a/b", 1)
        for i in range(20)
    ]
    return spark.createDataFrame(rows, DOCS + ", lang string, source string, n_chars long")


def test_learning_asks_python_once_a_text(spark):
    """Two Python steps in one task are two worker processes, which stay with the executor."""
    prepared(spark)
    texts = corpus(spark)
    judged = texts.select(language.verdict({"en": [1, 2, 3]}, texts["text"]).alias("v"))
    counted = language._stepped(judged, "v", 300)
    assert plan_of(counted).count("ArrowEvalPython") == 1


def test_unknown_texts_set_no_score(spark):
    """Texts without letters are counted, but open no language."""
    rows = [(language.UNKNOWN, 0.0, 0)] * 3 + [("en", 0.9, 300)] * 5
    judged = spark.createDataFrame(
        [(r,) for r in rows], "v struct<lang_pred:string,score:double,n_grams:long>"
    )
    assert set(language.least_scores(judged, "v")) == {"en"}


def test_suffix_dedup_of_the_pipeline_makes_the_text_only(spark):
    prepared(spark)
    plan = plan_of(corpus_pipeline.suffix_dedup(spark, corpus(spark), ""))
    assert "struct<k1:bigint,k2:bigint,kept_text:string>" in plan and "sha2(" not in plan


@pytest.mark.parametrize("new", [["n_spans"], ["kept_text", "n_bytes"], ["kept", "n_removed"]])
def test_some_of_the_new_columns(spark, new):
    rows = [(1, "abcdefghé" * 20), (2, None), (3, "x" + "abcdefghé" * 20 + "é"), (4, "short"), (3, "")]
    df = spark.createDataFrame(rows, DOCS)
    full = suffix_dedup.remove_repeats(df, min_bytes=30)
    some = suffix_dedup.remove_repeats(df, min_bytes=30, new=new)
    assert some.columns == ["doc_id", "text", *new]
    assert sorted(some.collect(), key=str) == sorted(full.select(some.columns).collect(), key=str)


def test_texts_of_runs_leave_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 5000)
    random.seed(2)
    texts = ["".join(random.choice("abé") for _ in range(random.randint(450, 900))) for _ in range(30)]
    listed = [
        [{"start": s, "wins": 9, "shard": s % 3, "split": s % 2 == 0} for s in range(0, 40, 1 + i % 5)]
        for i in range(30)
    ]
    rows = [
        {"k1": i, "k2": -i, "text": t, "runs": r} for i, (t, r) in enumerate(zip(texts, listed, strict=True))
    ]
    batch = pa.RecordBatch.from_pylist(rows)
    batches = list(suffix_dedup._cut(400)([batch.slice(0, 11), batch.slice(11)]))
    assert max(sum(len(r) for r in b.column("run").to_pylist()) for b in batches) <= 5000
    got = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    assert got == [
        (i, -i, r["start"], r["shard"], r["split"], texts[i].encode()[r["start"] : r["start"] + 408])
        for i in range(30)
        for r in listed[i]
    ]


def test_kept_texts_leave_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 3000)
    texts = [chr(97 + i % 26) * 1000 for i in range(20)]
    rows = [{"k1": i, "k2": i, "text": t, "ranges": [{"start": i, "wins": 1}]} for i, t in enumerate(texts)]
    batches = list(suffix_dedup._remove(10, ["kept_text"])([pa.RecordBatch.from_pylist(rows)]))
    assert [len(b) for b in batches] == [4] * 5 and batches[0].schema.names == ["k1", "k2", "kept_text"]
    assert {len(r["kept_text"]) for b in batches for r in b.to_pylist()} == {990}


def test_spans_are_those_of_marked_bytes():
    rng = np.random.default_rng(4)
    for _ in range(300):
        start = rng.integers(0, 60, rng.integers(1, 12))
        stop = start + rng.integers(1, 15, len(start))
        marks = np.zeros(90, np.int8)
        for a, b in zip(start, stop, strict=True):
            marks[a:b] = 1
        edges = np.diff(np.concatenate([[0], marks, [0]]))
        begins, ends = suffix_dedup._spans(start, stop)
        assert begins.tolist() == np.flatnonzero(edges == 1).tolist()
        assert ends.tolist() == np.flatnonzero(edges == -1).tolist()
