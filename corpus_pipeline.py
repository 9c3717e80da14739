"""From documents to packed training sequences.

Quality classifier, language identification, near duplicates and packing, one after another.  Each stage works on all
rows that the one before kept, and what it decides takes effect: rejected documents go, one document of each group of
near duplicates stays, and what is left is packed.

A stage is called with the session, the documents and the folder of the input tables.  Between stages the documents are
a stored table, so a stage may read them more than once, and lost executors cost a task and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import common, jaccard_join, language_id, packing, quality_model

SCORE = "_quality_score"
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score by a model of the labelled ones is at least 0.3."""
    model = quality_model.learned(docs, common.read(spark, sf_dir, "labels"))
    return quality_model.score_quality(docs, model, into=SCORE).filter(F.col(SCORE) >= quality_model.NEEDED).drop(SCORE)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like a language of the labelled ones."""
    found = language_id.identify(docs.withColumn("_whole", F.struct("*")), language_id.learned(docs))
    return found.filter("plausible").select("_whole.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: four fifths of the sets of five words alike."""
    return jaccard_join.representatives(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences."""
    return packing.pack_documents(docs, added=True)


STAGES = [("quality_classifier", quality), ("language_id", language), ("jaccard_join", distinct), ("packing", sequences)]

# Learned models decide the first two stages, so SQL cannot give the rows; the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
