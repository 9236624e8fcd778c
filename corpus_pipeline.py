"""The corpus pipeline: from raw documents to token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import byte_bpe, chosen_path, fertility, mixing, toxicity
from tidewatch.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on the labels of these documents, scores 0.5 or more."""
    return toxicity.filtered(docs, table(spark, sf_dir, "labels"))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or their language's fertility bands."""
    return fertility.filtered(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least doc_id of each class of near duplicates."""
    return chosen_path.filtered(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources come to their target weights."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and digests of the ids and of what they decode to."""
    encoded = byte_bpe.encode(docs)
    return byte_bpe.decode(encoded).withColumn("same", byte_bpe.equal_text("decoded", "text")).drop("decoded", "text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic), ("quality", good_quality), ("near duplicates", one_of_each), ("mixing", mixed), ("tokens", tokens),
]
#: The classifier and the tokenizers cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
