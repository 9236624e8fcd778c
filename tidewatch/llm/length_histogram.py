"""Exact histogram of encoded lengths, and what every context limit keeps.

Documents are counted by encoded length with partial sums. Suffix sums over the lengths, first over spans of 1024 lengths,
then within each, tell for every limit how many documents are longer, and how many tokens stay when each is cut there.
Cases: a null text has length 0; repeated rows count each; an empty table gives an empty histogram; only the text column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import prepare, stored, text_of
from tidewatch.llm.vocab import json_bpe, loaded, read_file, vocabulary_path

SPAN = 1024


def lengths(frame: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """One column ``length``: ids of each whole text by the vocabulary, without special tokens."""
    spark = prepare(frame.sparkSession)
    shared = spark.sparkContext.broadcast(read_file(path or vocabulary_path("byte_bpe_50k.json")))

    @F.arrow_udf("bigint")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(loaded(json_bpe, shared.value).encode(batch.to_pylist())[1], pa.int64())

    return frame.select(count(text_of(text)).alias("length"))


def histogram(lengths_: DataFrame) -> DataFrame:
    """Per distinct ``length``: ``docs``, ``tokens``, and as if it were the context limit ``docs_longer``, ``tokens_longer``
    (whole tokens of longer documents), ``tokens_kept`` (total when every document is cut at it), ``tokens_cut``; ``quantile``
    is the share of documents up to this length.
    """
    counted = stored(lengths_.groupBy("length").agg(F.count(F.lit(1)).alias("docs")), "lengths").select(
        "length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), F.floor(F.col("length") / SPAN).alias("span")
    )
    spans = counted.groupBy("span").agg(F.sum("docs").alias("span_docs"), F.sum("tokens").alias("span_tokens"))
    # One row per 1024 lengths: at most the longest text's length / 1024 rows.
    later = Window.orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = spans.select(
        "span", F.coalesce(F.sum("span_docs").over(later), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("span_tokens").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("span_docs").over(whole).alias("all_docs"), F.sum("span_tokens").over(whole).alias("all_tokens"),
    )
    within = Window.partitionBy("span").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = counted.join(after, "span").select(
        "length", "docs", "tokens", "all_docs", "all_tokens",
        (F.col("docs_after") + F.coalesce(F.sum("docs").over(within), F.lit(0))).alias("docs_longer"),
        (F.col("tokens_after") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("tokens_longer"),
    )
    return summed.select(
        "length", "docs", "tokens", "docs_longer", "tokens_longer",
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("tokens_kept"),
        (F.col("tokens_longer") - F.col("length") * F.col("docs_longer")).alias("tokens_cut"),
        (1 - F.col("docs_longer") / F.col("all_docs")).alias("quantile"),
    )


def at_limits(histogram_: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit``, ``docs_longer``, ``tokens_kept`` for any limits: sums over the histogram, one pass for all."""
    wanted = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("context_limit")
    longer = F.col("length") > F.col("context_limit")
    return histogram_.select("length", "docs", wanted).groupBy("context_limit").agg(
        F.sum(F.when(longer, F.col("docs")).otherwise(0)).alias("docs_longer"),
        F.sum(F.least("length", "context_limit") * F.col("docs")).alias("tokens_kept"),
    )


def quantiles(histogram_: DataFrame, shares: list[float]) -> DataFrame:
    """``share`` and ``length``: the smallest length that at least this share of documents does not exceed."""
    wanted = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    return histogram_.select("length", "quantile", wanted).where("quantile >= share").groupBy("share").agg(F.min("length").alias("length"))
