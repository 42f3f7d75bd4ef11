"""Corpus pipeline: documents to token ids, in stages that are written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontamination, language, quality, simhash
from ledgerline.llm.queries import BPE_RANKS, table
from ledgerline.sinks.files import Stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents themselves teach."""
    return language.with_language(docs, language.train(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs, Stage(spark))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts: ``doc_id``, ``n_tokens``, ``ids``."""
    coded = bpe.encode(docs.select("doc_id", "text"), BPE_RANKS, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]
#: Learned models and the tokenizer are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs, stage = table(spark, sf_dir, "documents"), Stage(spark)
    for name, step in STAGES:
        docs = stage.save(step(spark, docs, sf_dir), name)
    return docs
