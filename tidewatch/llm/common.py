"""Helpers shared by the operators: session settings, stored tables, ranks over a global order."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.session import ensure_checkpoint_dir

#: Arrow batches stay small even where documents are very long.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
#: Java and DuckDB pattern of a word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in ARROW.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def runs(texts: Iterable[str], size: int = 1 << 21) -> Iterator[list[str]]:
    """The texts in lists of about ``size`` characters, to bound what one step of a task holds."""
    held, chars = [], 0
    for text in texts:
        if held and chars + len(text) > size:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` stored in a global order, with ``__part`` (range partition) and ``__place`` (row within it, from 0).

    The order needs a full tie-break. Partitions come from sampled ranges, so a value that many rows
    share is split as long as the later order columns differ.
    """
    row = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_rows.select("*", F.shiftright(row, 33).cast("int").alias("__part"), row.bitwiseAND((1 << 33) - 1).alias("__place")), "ordered")


def before_parts(parts: DataFrame, part: str, *sums: str) -> DataFrame:
    """Per ``part``, each sum over all earlier parts as ``__before_<sum>``; one row per partition, so one task is enough."""
    window = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(part, *[F.coalesce(F.sum(s).over(window), F.lit(0)).cast("long").alias(f"__before_{s}") for s in sums])
