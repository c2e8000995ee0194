"""Corpus pipeline over ``documents``: language ID, line dedup, n-gram Jaccard
join, mixing to target weights, best-fit packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``.  Nulls, empty tables and extra columns pass
through as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, line_windows, mixing, packing, shingle_join
from tidemark.llm.common import free_name, read_table, written

#: A document goes if its language cannot be told: no letter, or a calibrated
#: confidence below this.
LEAST_CONFIDENCE = 0.5
#: A repeated passage of over this many words goes, on however few lines.
LONG_WORDS = 50
#: Near copies: five-word shingles, Jaccard 0.8 or more.
SHINGLE_WORDS, NUM, DEN = 5, 80, 100
#: Nine tenths of the tokens, each document at most once.
MIX = mixing.MixPlan(0.9, 1, "pipeline-mix-1", {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1})


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a null ``lang`` is filled in.
    Trained on the ``lang`` values of the stage's own input."""
    model = langid.train(docs)
    name, score = free_name(docs.columns, "_stage_lang"), free_name(docs.columns, "_stage_score")
    told = langid.predict(docs, model, docs.columns, out=(name, score))
    kept = told.filter((F.col(name) != langid.UND) & (F.col(score) >= LEAST_CONFIDENCE))
    return kept.withColumn("lang", F.coalesce("lang", name)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text without the later occurrences of repeated three-line windows and
    of repeated passages of over 50 words on one or two lines; a document of which no line is left goes.  ``n_chars`` follows the text."""
    total, gone = free_name(docs.columns, "_stage_lines"), free_name(docs.columns, "_stage_removed")
    out = line_windows.dedup_lines(docs, counts=(total, gone), long_words=LONG_WORDS).filter((F.col(total) > F.col(gone)) | (F.col(total) == 0))
    return out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id.  Documents
    without an id or without words are in no group."""
    groups = shingle_join.join_components(docs, SHINGLE_WORDS, NUM, DEN)
    gone = groups.filter("component_id != doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the token budgets of domains, languages and sources
    take, those without an id as well; an id that stands in several leaves is
    taken leaf by leaf."""
    taken = mixing.mix(docs, MIX).select(F.col("doc_id").alias("_stage_id"), F.col("language").alias("_stage_lang"),
                                         F.col("source").alias("_stage_source")).distinct()
    same = (docs["doc_id"].eqNullSafe(taken["_stage_id"]) & (F.coalesce(docs["lang"], F.lit("und")) == taken["_stage_lang"])
            & (F.coalesce(docs["source"], F.lit("unknown")) == taken["_stage_source"]))
    return docs.join(taken, same, "left_semi").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(docs))


#: (name, function(spark, docs, sf_dir) -> DataFrame), in order.
STAGES = [("language_id", language), ("line_dedup", lines), ("ngram_join", near_copies), ("mix", mix), ("pack", pack)]

#: Trained models and tokenizers: SQL cannot express the whole; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
