"""Documents to a training mix: language, lines, near copies, benchmark passages, source weights.

Each stage takes the documents that the one before kept. All but the last give the columns of
``documents``; the last one gives the words that the mix takes of each document.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variloom.llm import decontam, langid, linededup, minhash, mixing
from variloom.llm.tables import settle, table

#: Least cosine with a language's prototype; unrelated text lies within about 1 / sqrt(dimensions) of 0.
LEAST_COSINE = 0.03


#: Columns of ``documents``; a stage carries any others through as one struct, so no name of theirs meets an operator's.
COLUMNS, REST = ("doc_id", "text", "lang", "source", "n_chars"), "rest_of_row"


def carried(stage):
    """The stage on the columns of ``documents``, further columns unchanged beside them."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = [c for c in docs.columns if c not in COLUMNS]
        own = [c for c in docs.columns if c in COLUMNS]
        if not more:
            return stage(spark, docs, sf_dir)
        out = stage(spark, docs.select(*own, F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(more)]).alias(REST)), sf_dir)
        return out.select(*[F.col(c) if c in own else F.col(f"{REST}.c{more.index(c)}").alias(c) for c in docs.columns])

    return run_stage


@carried
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing label is filled in. Others, and those without a letter, go."""
    found = langid.predict(docs, *langid.learn(docs)).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_COSINE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


@carried
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that lost all their words go."""
    cut = linededup.drop_repeated_lines(docs)
    kept = cut.where((F.col("n_removed") == 0) | F.col("text").rlike("[0-9A-Za-z\\x80-\\x{10FFFF}]"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@carried
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return minhash.distinct_documents(docs)


@carried
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` of every document left."""
    return mixing.mix_sources(mixing.word_counts(docs))


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, "stage")
    return docs
