"""Shards cut from the Hilbert curve over several metadata columns.

Each column is quantised to cells of about equal row counts, the rows are sorted by their cell's place on the curve, and
equal runs of them become shards, so that a file covers a small box of every column and filters on any of them prune files.

Cases: a null in a dimension is below all values; rows that tie on the curve follow doc_id and the text's checksum, and equal rows lie
side by side; a null text has no bytes; with fewer rows than shards some shards stay empty; an empty table gives an empty one.
Extra columns pass through ``shards``; a column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import before_parts, in_order, prepare, text_of

BITS = 6


def curve_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits in each dimension, by Skilling's transpose (2004)."""
    x = [np.array(c, np.int64) for c in cells]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the larger cubes
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    turn, q = np.zeros_like(x[0]), top
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x = [c ^ turn for c in x]
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            place = (place << 1) | ((c >> b) & 1)
    return place


def text_key(frame: DataFrame, column: str) -> Column:
    """A number that follows the byte order of a text column: six bytes after the prefix that all its values share."""
    low, high = frame.agg(F.min(column), F.max(column)).first()
    low, high = (low or "").encode(), (high or "").encode()
    shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    digits = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), shared + 1, 6)), 12, "0")
    return F.conv(digits, 16, 10).cast("long")


def curve(frame: DataFrame, dimensions: dict[str, Column], bits: int = BITS) -> Column:
    """The curve index of each row. Cells are cut at approximate quantiles of all rows, at most 2**bits - 1 cuts per dimension."""
    spark = prepare(frame.sparkSession)
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = frame.agg(*[F.percentile_approx(c.cast("double"), shares, 10_000).alias(name) for name, c in dimensions.items()]).first()
    shared = spark.sparkContext.broadcast([np.array(c or [], np.float64) for c in cuts])

    @F.arrow_udf("bigint")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [np.asarray(field.to_numpy(zero_copy_only=False), np.float64) for field in batch.flatten()]
            cells = [np.where(np.isnan(v), 0, np.searchsorted(c, v, side="right")) for c, v in zip(shared.value, values)]
            yield pa.array(curve_index(cells, bits), pa.int64())

    return place(F.struct(*[c.cast("double").alias(name) for name, c in dimensions.items()]))


def shards(frame: DataFrame, n_shards: int, index: str, *ties: str) -> DataFrame:
    """``frame`` with ``shard`` and ``slot``: runs of the order by ``index`` and ``ties``, whose counts are at most one apart."""
    rest = [c for c in frame.columns if c not in ("shard", "slot")]
    ordered = in_order(frame.select(*rest), *[F.col(c).asc_nulls_first() for c in (index, *ties)])
    counts = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).first()[0] or 1
    # One row per range partition.
    rank = ordered.join(F.broadcast(before_parts(counts, "__part", "rows")), "__part").withColumn("__rank", F.col("__before_rows") + F.col("__place"))
    shard = F.expr(f"CAST(__rank * {n_shards} DIV {total} AS INT)")
    first = F.expr(f"(shard * CAST({total} AS BIGINT) + {n_shards - 1}) DIV {n_shards}")
    return rank.withColumn("shard", shard).withColumn("slot", F.col("__rank") - first).select(*rest, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Rows that carry ``shard`` and ``slot``, with all their columns, as one folder of files per shard, each file a run of slots.

    Files follow the curve, so their least and greatest values of every dimension are close and readers leave most files out.
    """
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def write_documents(frame: DataFrame, path: str, n_shards: int = 16) -> None:
    """Whole documents in the shards of ``plan``: every row once, null, repeated and equal ones too; own columns ``shard`` and ``slot`` are replaced."""
    size = F.octet_length(text_of()).cast("long") + 1
    index = curve(frame, {"source": text_key(frame, "source"), "size": size, "doc_id": F.col("doc_id")})
    rows = frame.withColumns({"__curve": index, "__crc": F.crc32(text_of().cast("binary"))})
    write_shards(shards(rows, n_shards, "__curve", "doc_id", "__crc").drop("__curve", "__crc"), path)


def plan(frame: DataFrame, n_shards: int = 16) -> DataFrame:
    """Shards of documents over source, size and doc_id, law ``rows``."""
    size = F.octet_length(text_of()).cast("long") + 1
    rows = frame.select("doc_id", "source", size.alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"))
    source = text_key(frame, "source")
    index = curve(rows, {"source": source, "size": F.col("size"), "doc_id": F.col("doc_id")})
    placed = shards(rows.withColumn("__curve", index), n_shards, "__curve", "doc_id", "text_crc32")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("__curve").alias("curve_index"))
