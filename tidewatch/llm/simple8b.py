"""Token ids in files of Simple-8b words, written in document order and read back.

A 64-bit word holds a selector (top 4 bits) and as many ids as fit into the other 60 bits, from 60 of 1 bit to one of 60
bits. An id of more than 60 bits is an escape: selector 14 and its number in a list of whole values at the end. Ids fall
into blocks of 1024 whose word offsets stand in front, so that a reader unpacks any block, and all of them at once.

A segment (one row of the Parquet files, at most about 262,144 ids unless a document alone has more) is
``b"S8B1" | block size u4 | ids u8 | blocks u4 | words u4 | escapes u4 | word offset of each block u4 | words u8 | escapes u8``,
little-endian, with the ids' documents beside it. Parquet carries the segments, so that the
commit protocol of Spark's writer and any file system that Spark reaches serve them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import before_parts, prepare, stored, text_of
from tidewatch.llm.vocab import loaded, read_file, vocabulary_path, word_bpe

#: Fixed values of the code: how many ids a word holds, and of how many bits, by selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 14
BLOCK = 1024
HEAD = struct.Struct("<4sIQIII")


def pack(values: np.ndarray, block: int = BLOCK) -> bytes:
    """One segment of unsigned 64-bit values."""
    v = np.ascontiguousarray(values, np.uint64)
    n = len(v)
    blocks = -(-n // block)
    fits = np.searchsorted(np.array([(1 << b) - 1 for b in BITS], np.uint64), v).astype(np.uint8)  # 14: an escape
    left = np.minimum(block - np.arange(n) % block, n - np.arange(n))
    choice = np.where(fits == ESCAPE, ESCAPE, len(COUNTS) - 1).astype(np.uint8)
    spans = {0: fits}  # spans[j][i]: the widest of the 2**j ids from i on
    for j in range(1, 6):
        last, shift = spans[j - 1], 1 << (j - 1)
        spans[j] = np.maximum(last[:len(last) - shift], last[shift:]) if len(last) > shift else last[:0]
    for selector in range(len(COUNTS) - 2, -1, -1):  # from few wide ids to many narrow ones
        count = COUNTS[selector]
        j = count.bit_length() - 1
        if len(spans[j]) == 0 or n < count or spans[j].min() > selector:
            continue
        m = n - count + 1
        widest = np.maximum(spans[j][:m], spans[j][count - (1 << j):count - (1 << j) + m])
        choice[:m][(widest <= selector) & (left[:m] >= count)] = selector
    step = np.array([*COUNTS, 1], np.int64)[choice]
    at, end, starts = np.arange(blocks) * block, np.minimum(np.arange(1, blocks + 1) * block, n), []
    while len(at):  # all blocks move on by a word at a time
        starts.append(at)
        at = at + step[at]
        open_ = at < end
        at, end = at[open_], end[open_]
    starts = np.sort(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        own = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            words[own] |= np.arange(len(own), dtype=np.uint64)
            continue
        shifts = (np.arange(COUNTS[selector]) * BITS[selector]).astype(np.uint64)
        words[own] |= np.bitwise_or.reduce(v[starts[own][:, None] + np.arange(COUNTS[selector])] << shifts, axis=1)
    escapes = v[starts[chosen == ESCAPE]]
    offsets = np.searchsorted(starts, np.arange(blocks) * block)
    head = HEAD.pack(b"S8B1", block, n, blocks, len(words), len(escapes))
    return b"".join([head, offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def _parts(data: bytes):
    magic, block, n, blocks, n_words, n_escapes = HEAD.unpack_from(data)
    if magic != b"S8B1":
        raise ValueError("not a segment of Simple-8b words")
    offsets = np.frombuffer(data, "<u4", blocks, HEAD.size)
    words = np.frombuffer(data, "<u8", n_words, HEAD.size + 4 * blocks)
    return block, n, offsets, words, np.frombuffer(data, "<u8", n_escapes, HEAD.size + 4 * blocks + 8 * n_words)


def _unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    selectors = (words >> np.uint64(60)).astype(np.int64)
    sizes = np.array([*COUNTS, 1], np.int64)[selectors]
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        if selector == ESCAPE:
            out[ends[own] - 1] = escapes[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        count, bits = COUNTS[selector], BITS[selector]
        values = (words[own][:, None] >> (np.arange(count) * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)
        out[(ends[own] - count)[:, None] + np.arange(count)] = values
    return out


def unpack(data: bytes) -> np.ndarray:
    _, n, _, words, escapes = _parts(data)
    out = _unpack(words, escapes)
    if len(out) != n:
        raise ValueError("a segment that does not hold its ids")
    return out


def unpack_block(data: bytes, number: int) -> np.ndarray:
    """The ids of one block, found by its offset."""
    _, _, offsets, words, escapes = _parts(data)
    return _unpack(words[offsets[number]:offsets[number + 1] if number + 1 < len(offsets) else None], escapes)


SEGMENTS = "part int, seq int, before bigint, doc_ids array<bigint>, sizes array<bigint>, payload binary"


def segments(frame: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = 2, size: int = 1 << 18) -> DataFrame:
    """The documents' ids, each document's followed by ``end_id``, as segments in ascending order of ``doc_id``.

    ``part`` and ``seq`` order the segments; ``before`` counts the ids before a segment in its part. Null doc_ids come
    first; equal ones follow the order of their text's hash, and equal rows are all written. A null text is empty.
    """
    spark = prepare(frame.sparkSession)
    shared = spark.sparkContext.broadcast(read_file(path or vocabulary_path("byte_bpe_50k.json")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, bpe = TaskContext.get().partitionId(), loaded(word_bpe, shared.value)
        docs, sizes, ids, held, seq, before = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            row = {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "before": pa.array([before], pa.int64()),
                   "doc_ids": pa.array([docs], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                   "payload": pa.array([pack(np.concatenate(ids))], pa.binary())}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            flat, counts = bpe.encode(batch.column(1).to_pylist())
            at = 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                docs.append(doc)
                sizes.append(n + 1)
                ids += [flat[at:at + n], np.array([end_id], np.uint32)]
                held, at = held + n + 1, at + n
                if held >= size:
                    yield flush()
                    docs, sizes, ids, held, seq, before = [], [], [], 0, seq + 1, before + held
        if docs:
            yield flush()

    rows = frame.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return ordered.mapInArrow(write, SEGMENTS)


def read_segments(files: DataFrame) -> DataFrame:
    """From the segments, per document ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` (ids as little-endian unsigned 32-bit integers)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"]).astype("<u4")
                ends = np.cumsum(np.array(row["sizes"], np.int64))
                crcs = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, row["sizes"])]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * len(ends), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "first": pa.array(row["before"] + ends - np.array(row["sizes"], np.int64), pa.int64()),
                    "n_tokens": pa.array(row["sizes"], pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    sums = files.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids"))
    docs = files.select("part", "before", "doc_ids", "sizes", "payload").mapInArrow(read, "part int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    # One row per written partition, whatever the number of documents.
    return docs.join(F.broadcast(before_parts(sums, "part", "ids")), "part").select("doc_id", (F.col("first") + F.col("__before_ids")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(frame: DataFrame, **options) -> DataFrame:
    return read_segments(stored(segments(frame, **options), "segments"))
