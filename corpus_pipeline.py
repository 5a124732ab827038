"""From raw documents to training sequences, one stage after another.

Each stage works on everything its predecessor kept, and all but the last return the columns of
``documents``. SQL cannot state the stages; tests hold them against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.language import (
    UNKNOWN,
    evened,
    held_out,
    learn_profiles,
    least_scores,
    verdict,
)
from kontor.llm.minhash import one_per_group
from kontor.llm.packing import pack
from kontor.llm.rows import fresh, prepared, table
from kontor.llm.secrets import redacted
from kontor.llm.suffix_dedup import remove_repeats
from kontor.session import materialise

#: No text below this is in a learned language, however short it is: other scripts, keyboard noise.
#: The cut that tells languages apart is learned, one for each of them.
LEAST_SCORE = 0.2
#: Bytes of encoded words that a process keeps: little, because earlier stages have left their marks.
REMEMBERED = 8 << 20


def _columns(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of ``docs``, whatever their names; with a new text, and its length in ``n_chars``."""
    new = {}
    if text is not None:
        new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return [new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters and foreign ones go.

    A text is foreign if it scores below the labelled texts of its nearest language (``least_scores``).
    A few foreign words score like a short clean text and stay.
    """
    prepared(spark)
    learning = docs.where(~held_out("doc_id") & F.col("lang").isNotNull())
    profiles = learn_profiles(learning)
    name = fresh(docs.columns, "verdict")
    judged = verdict(profiles, F.col("text")).alias(name)
    least = F.lit(0.0)
    for lang, score in least_scores(learning.select(judged), name).items():
        least = F.when(F.col(f"{name}.lang_pred") == lang, score).otherwise(least)
    known = F.col(f"{name}.lang_pred") != UNKNOWN
    sure = (F.col(f"{name}.score") >= LEAST_SCORE) & (evened(name) >= least)
    # Judged anew instead of stored: that costs less than writing every text once more.
    return docs.select("*", judged).where(known & sure).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    prepared(spark)
    return one_per_group(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 400 bytes and more that occur more than once."""
    prepared(spark)
    name = fresh(docs.columns, "kept")
    found = remove_repeats(docs, into=name, new=["kept_text"])
    return found.select(*_columns(docs, F.col(f"{name}.kept_text")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets replaced by a marker."""
    prepared(spark)
    return redacted(docs).select(*_columns(docs, F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the documents, with their ids."""
    prepared(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(docs, path, marks_are_text=True, remembered=REMEMBERED)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("secrets", secret_scan),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
