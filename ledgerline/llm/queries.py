"""Registered queries of the operators: each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    ann, bpe, chat, decontamination, divergence, language, lexical, licenses, quality, simhash, token_files, url_filters, warc,
)
from ledgerline.sinks.files import Stage

URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge(pages, url_filters.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"), Stage(spark), chunk_turns=None)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = ann.nearest(rows, F.col("id") % 20 == 0, Stage(spark))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = warc.serialized(warc.derive(warc.responses(table(spark, sf_dir, "pages"))))
    return derived.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type", "content_length",
        "source_digest", "block_digest", F.sha2("record", 256).alias("record_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, BPE_RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _held_out():
    return F.coalesce(language.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", _held_out(), "lang_pred", "score")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), trees).select("doc_id", _held_out(), "score", "predicted")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Stage(spark))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.export(docs, WORD_TOKENIZER)[1]


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark"), Stage(spark))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.summary(licenses.places(docs))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"), Stage(spark))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_chat_formatting, op3_decontamination, op4_nearest_neighbours, op5_warc_derivatives,
        op6_byte_bpe, op7_language_id, op8_quality_classifier, op9_simhash_dedup, op10_token_files, op11_lexical_search, op12_license_scans, op13_source_divergence,
    )
}
