"""The queries opN_<name> over the whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiscope.llm import (
    chat,
    decontaminate,
    divergence,
    licenses,
    line_dedup,
    media,
    merkle,
    near_dup,
    packing,
    pieces,
    quality,
    token_ids,
    toxicity,
)
from lexiscope.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.digest(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.digest(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_media_columns, op3_license_scan, op4_line_dedup, op5_sentencepiece, op6_toxicity,
        op7_decontaminate, op8_token_ids, op9_quality, op10_near_dup, op11_source_divergence, op12_packing, op13_merkle_manifest,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": chat.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op11_source_divergence": divergence.SQL,
}
