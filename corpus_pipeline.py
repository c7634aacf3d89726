"""Corpus pipeline: documents -> quality filter -> exact dedup -> near dedup -> PII masking -> packing.

Every stage works on all that the stage before it kept. Stages 1 to 4 return the columns of documents; the last one
returns a row per packed piece. ``run`` writes each stage's result to the shared checkpoint folder and reads it
again for the next one, so a lost executor costs no more than its own stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edustar.llm import exact_dedup as exact
from edustar.llm import ngram_join, packing, pii_crf, quality_fm
from edustar.llm.common import ship, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects go."""
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"), quality_fm.learning_fold())
    return quality_fm.accepted(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest doc_id stays."""
    return exact.keep_rows(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (0.8 of the shingles of five words) the document with the smallest doc_id stays."""
    return ngram_join.keep_rows(docs, ngram_join.WORDS5)


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii_crf.masked(docs, pii_crf.learn(docs))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of training sequences."""
    return packing.public_pack(docs)


def _stage(fn):
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, docs, sf_dir)
    stage.__doc__ = fn.__doc__
    return stage


STAGES = [(f.__name__, _stage(f)) for f in (quality_classifier, exact_dedup, ngram_jaccard_join, pii_masking, sequence_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # the classifier, the random field and the packing are beyond SQL; tests/llm checks them by brute force
