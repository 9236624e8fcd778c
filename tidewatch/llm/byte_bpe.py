"""Byte-level BPE encoding and decoding of whole texts.

Encoding runs the tokenizers library over Arrow batches. Decoding looks each id up in the table of token bytes, which
reverses the byte-to-character alphabet; a character split over tokens comes together as bytes are joined first.
Cases: a null text counts as empty and gives no ids; repeated rows give repeated results; an empty table gives an
empty one; other columns, whatever their names, pass through unless they bear the name of a result, which replaces them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import prepare, text_of
from tidewatch.llm.vocab import ByteBpe, loaded, ranks_bpe, read_file, read_ranks, vocabulary_path

MULTI = "byte_bpe_multi_50k.tiktoken"


def byte_table(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens one after another, where each token's start and how many there are."""
    ranks = read_ranks(data)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode_ids(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The bytes of the ids."""
    flat, starts, all_sizes = table
    sizes = all_sizes[ids]
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def offsets_of(ids: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of each token; the parts of a split character all span it."""
    sizes = table[2][ids]
    ends = np.cumsum(sizes)
    nth = np.cumsum((decode_ids(ids, table) & 0xC0) != 0x80)  # characters begun up to and with each byte
    return nth[ends - sizes] - 1, nth[ends - 1]


def _per_text(frame: DataFrame, text: str, results: dict[str, str], work, *files: bytes) -> DataFrame:
    """``frame`` with the ``results`` that ``work(texts, *files)`` gives for its texts."""
    spark = prepare(frame.sparkSession)
    shared = spark.sparkContext.broadcast(files)
    kind = ", ".join(f"{name} {type_}" for name, type_ in results.items())

    @F.arrow_udf(f"struct<{kind.replace(' ', ':')}>".replace(",:", ","))
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            columns = work(batch.to_pylist(), *shared.value)
            yield pa.StructArray.from_arrays(columns, list(results))

    rest = [F.col(f"`{c}`") for c in frame.columns if c not in results]
    done = frame.select(*rest, run(text_of(text)).alias("__done"))
    return done.select(*rest, *[F.col(f"__done.{name}").alias(name) for name in results])


def _encoded(texts: list[str], data: bytes) -> tuple[np.ndarray, np.ndarray, ByteBpe]:
    return loaded(ranks_bpe, data).encode(texts)


def _lists(values: np.ndarray, counts: np.ndarray, type_: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, type_))


def encode(frame: DataFrame, text: str = "text", path: str | None = None, offsets: bool = False) -> DataFrame:
    """Adds ``ids`` (array of int), and ``begins`` and ``ends`` (characters of each token) if ``offsets``."""
    def work(texts, data):
        flat, counts = _encoded(texts, data)
        lists = [flat]
        if offsets:
            table, at = loaded(byte_table, data), np.cumsum(counts)
            spans = [offsets_of(flat[e - c:e], table) if c else (flat[:0], flat[:0]) for e, c in zip(at, counts)]
            lists += [np.concatenate([s[i] for s in spans]) if spans else flat[:0] for i in (0, 1)]
        return [_lists(x.astype(np.int32), counts, pa.int32()) for x in lists]

    results = dict.fromkeys(["ids", "begins", "ends"] if offsets else ["ids"], "array<int>")
    return _per_text(frame, text, results, work, read_file(path or vocabulary_path(MULTI)))


def decode(frame: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Adds ``decoded`` (binary), the bytes that the ids stand for; a null list gives none."""
    spark = prepare(frame.sparkSession)
    shared = spark.sparkContext.broadcast(read_file(path or vocabulary_path(MULTI)))

    @F.arrow_udf("binary")
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = loaded(byte_table, shared.value)
        for batch in lists:
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # without the lists that are null
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False))
            text, sizes = decode_ids(flat, table), np.concatenate([[0], np.cumsum(table[2][flat])])
            edges = sizes[np.concatenate([[0], ends]).astype(np.int64)]
            yield pa.array([text[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())

    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c != "decoded"], run(F.col(ids)).alias("decoded"))


def equal_text(decoded: str = "decoded", text: str = "text") -> Column:
    """Whether decoded bytes are those of the text."""
    return F.col(decoded) == text_of(text).cast("binary")


def digests(frame: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` (little-endian unsigned 32-bit) and ``decoded_sha256``, from encoding and decoding each text."""
    def work(texts, data):
        flat, counts = _encoded(texts, data)
        table, ids, back = loaded(byte_table, data), [], []
        at = 0
        for n in counts:
            own = flat[at:at + n]
            ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            back.append(hashlib.sha256(decode_ids(own, table).tobytes()).hexdigest())
            at += n
        return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]

    results = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return _per_text(frame, text, results, work, read_file(path or vocabulary_path(MULTI)))
