"""Corpus cleaning pipeline: five stages over ``documents``, each one operator of pagewright.llm.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that ``run`` writes as Parquet
and rereads as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import decontam, linededup, minhash, packing, toxicity
from pagewright.llm.queries import read
from pagewright.session import apply_query_conf, materialize


def _configured(stage):
    """Every stage brings the session to the settings the operators assume (small Arrow batches)."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_query_conf(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@_configured
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.clean(docs, toxicity.trained(docs, read(spark, sf_dir, "labels")))


@_configured
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later runs of three lines, or of fewer with 50 words, are deleted; a document with no line left goes."""
    out = linededup.clean(docs, words=linededup.LONG_WORDS)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_configured
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id) of each group of near duplicates stays."""
    return minhash.one_of_each(docs)


@_configured
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


@_configured
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: The first stage scores with a trained model, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
