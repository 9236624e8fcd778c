"""The registered queries of these operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import (
    byte_bpe, chosen_path, fertility, hilbert, html_text, kd_search, length_histogram, mixing, simple8b, token_alignment, toxicity, whitening, wu_manber,
)
from tidewatch.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


ORACLES["op2_mixing"] = mixing.PLAN_SQL


@query
def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.report(table(spark, sf_dir, "documents"))


@query
def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.plan(table(spark, sf_dir, "documents"))


@query
def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.histogram(length_histogram.lengths(table(spark, sf_dir, "documents")))


@query
def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.report(table(spark, sf_dir, "documents"))


ORACLES["op6_chosen_path"] = chosen_path.REPORT_SQL


@query
def op7_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.write_and_read(table(spark, sf_dir, "documents"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op9_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.every_nth(table(spark, sf_dir, "embeddings"))


ORACLES["op9_kd_search"] = kd_search.EVERY_NTH_SQL


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(table(spark, sf_dir, "documents"))


@query
def op13_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_wu_manber"] = wu_manber.REPORT_SQL
