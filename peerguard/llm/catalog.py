"""Registered queries of the operators; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, histogram_sort, html_text, language, line_dedup, ngram_join, packing, phrase_dedup, quality, simplex_clusters, toxicity,
               warc, whitening)
from .common import table
from .oracle import ORACLE


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op10_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.phrase_dedup(table(spark, sf_dir, "documents"))


def op11_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clusters.simplex_clusters(table(spark, sf_dir, "embeddings"))[0].drop("compared")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))[0]


def op13_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_sort.histogram_sort(table(spark, sf_dir, "documents")).drop("text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality_rules": op7_quality_rules,
    "op8_html_text": op8_html_text,
    "op9_language_id": op9_language_id,
    "op10_phrase_dedup": op10_phrase_dedup,
    "op11_simplex_clusters": op11_simplex_clusters,
    "op12_whitening": op12_whitening,
    "op13_histogram_sort": op13_histogram_sort,
}

__all__ = ["QUERIES", "ORACLE"]
