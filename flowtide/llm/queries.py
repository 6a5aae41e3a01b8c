"""Queries of the training-text operators over whole tables, and SQL for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from flowtide.llm import (chat, decontaminate, divergence, filter_audit, html_main, language, ngram_join, packing,
                          pitman_yor, quality, secret_scan, substring, token_files)
from flowtide.llm.quality_sql import QUALITY_SQL


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return html_main.extract(pages, html_main.fit(pages))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.classes_of(_table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(spark, _table(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"))


def op7_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score_all(_table(spark, folder, "documents"))


def op8_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), ids=False)


def op9_preference_chat(spark: SparkSession, folder: str) -> DataFrame:
    pairs = chat.formatted(chat.answer_pairs(_table(spark, folder, "conversations")))
    return pairs.withColumns({c: chat.spans_text(pairs[c]) for c in ("chosen_mask", "rejected_mask")})


def op10_difference_cover(spark: SparkSession, folder: str) -> DataFrame:
    return substring.digest(_table(spark, folder, "documents"))


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.find(_table(spark, folder, "documents"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.interactions(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(_table(spark, folder, "documents"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_html_main_text, op3_ngram_jaccard, op4_language_id, op5_token_files, op6_quality_rules,
    op7_pitman_yor, op8_bin_slack, op9_preference_chat, op10_difference_cover, op11_secret_scan,
    op12_filter_audit, op13_source_divergence)} | {"pipeline": corpus_pipeline.run}

LLM_ORACLES = {
    "op3_ngram_jaccard": ngram_join.JACCARD_SQL, "op6_quality_rules": QUALITY_SQL,
    "op9_preference_chat": chat.CHAT_SQL, "op10_difference_cover": substring.SUBSTRING_SQL,
    "op12_filter_audit": filter_audit.AUDIT_SQL, "op13_source_divergence": divergence.DIVERGENCE_SQL}
