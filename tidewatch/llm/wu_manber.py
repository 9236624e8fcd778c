"""Benchmark decontamination: windows of benchmark words found in documents by Wu-Manber search over words.

Patterns are the windows of ``WINDOW`` consecutive words of each item; an item of fewer words, but not none, is one shorter pattern. Windows
of one length share tables: the shift of a hashed block of words says how far a search may move on without passing a pattern's end, a
shift of zero leads to the bucket of patterns that end on that block, ordered by a hash of their other words, and the words of those are
compared one by one. A word that no item holds moves the search on by a whole window. A text is searched from many places at
once, each up to the next place's first window, so the steps are array operations.

The benchmark is taken in blocks of about ``BLOCK_WORDS`` words: one block's tables are broadcast (bounded whatever the benchmark's size) and
every document is searched for it; the next block's search adds to what the earlier ones found. Documents are never shuffled.

Cases: a null text has no words; an empty one neither; very long texts are cut into words by steps of a few MB and searched whole; repeated
documents give repeated rows, and null doc_ids are kept; equal windows of several items count for each; repeated items count once; an item
with a null id marks words but is neither counted nor listed; empty tables give no rows or no hits. Extra columns of the frames are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import prepare, stored

WINDOW = 10
BLOCK_WORDS = 500_000
#: Words of an item that travel in one row, so that a very long item is many rows.
PIECE = 10_000
#: Fixed value: a word, once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of words: digits, letters in lower case and all bytes of other characters; the rest separates.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
END, END_CODE, UNKNOWN = b".", -1, 0  # the end of a document is a word that no text can hold
PLACE = 256
SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def split_words(text: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """Words of a text whose bytes are mapped, some MB at a time."""
    start = 0
    while len(text) - start > size:
        cut = text.find(b" ", start + size)
        if cut < 0:
            break
        yield text[start:cut].split()
        start = cut
    yield text[start:].split()


def hashed(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of word codes."""
    key = np.zeros(len(words), np.uint64)
    for j in range(words.shape[1]):
        key = (key ^ words[:, j].astype(np.uint64)) * SPREAD[0]
        key ^= key >> np.uint64(29)
    return key


class Patterns:
    """Shift and bucket tables of distinct patterns of one length."""

    def __init__(self, words: np.ndarray):
        self.size = words.shape[1]
        self.block = min(2, self.size)
        self.bits = np.uint64(64 - min(24, max(10, (words.size * 4).bit_length())))
        self.shift = np.full(1 << (64 - int(self.bits)), self.size - self.block + 1, np.int64)
        for end in range(self.block, self.size + 1):  # the smallest shift comes last and stays
            self.shift[self._slot([words[:, end - self.block + j] for j in range(self.block)])] = self.size - end
        suffix, prefix = self._bucket(words)
        self.order = np.lexsort((prefix, suffix))
        self.words = words[self.order]
        self.keys = (suffix ^ prefix)[self.order]
        by_key = np.argsort(self.keys, kind="stable")
        self.keys, self.words, self.order = self.keys[by_key], self.words[by_key], self.order[by_key]

    def _slot(self, block: list[np.ndarray]) -> np.ndarray:
        key = np.zeros(len(block[0]), np.uint64)
        for j, word in enumerate(block):
            key += word.astype(np.uint64) * SPREAD[j]
        return ((key ^ (key >> np.uint64(31))) * SPREAD[0] >> self.bits).astype(np.int64)

    def _bucket(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the last block and of what stands before it."""
        return hashed(words[:, -self.block:]) * SPREAD[1], hashed(words[:, :-self.block])

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where a pattern ends, and the number of that pattern."""
        at = np.arange(self.size - 1, len(codes), PLACE)
        limit = np.minimum(at + PLACE, len(codes))
        ends = [np.zeros(0, np.int64)]
        while len(at):
            last = codes[at]
            step = self.shift[self._slot([codes[at - self.block + 1 + j] for j in range(self.block)])]
            step[last <= UNKNOWN] = self.size
            ends.append(at[step == 0])
            at = at + np.maximum(step, 1)
            inside = at < limit
            at, limit = at[inside], limit[inside]
        return self._confirm(codes, np.concatenate(ends))

    def _confirm(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        windows = codes[ends[:, None] + np.arange(1 - self.size, 1)]
        suffix, prefix = self._bucket(windows)
        key = suffix ^ prefix
        first, after = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        counts = after - first
        candidate = np.repeat(np.arange(len(ends)), counts)
        entry = np.arange(len(candidate)) - np.repeat(np.cumsum(counts) - counts - first, counts)
        same = (windows[candidate] == self.words[entry]).all(axis=1)
        return ends[candidate[same]], self.order[entry[same]]


class Block:
    """One block of the benchmark: its vocabulary, the patterns of each length and the items that hold them."""

    def __init__(self, data: bytes):
        vocabulary, by_length = pickle.loads(data)
        self.codes = {word: code for code, word in enumerate(vocabulary, 1)}
        self.codes[END] = END_CODE
        self.patterns = [(Patterns(words), starts, items) for words, starts, items in by_length]

    @staticmethod
    def pack(rows: list[tuple[str | None, list[str]]], window: int = WINDOW) -> bytes:
        """From (item id, words of a piece); runs on the driver over one block."""
        vocabulary: dict[bytes, int] = {}
        windows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        names: list[str | None] = []
        for name, words in rows:
            codes = np.array([vocabulary.setdefault(w.encode(), len(vocabulary) + 1) for w in words], np.int32)
            length = min(window, len(codes))
            own = np.lib.stride_tricks.sliding_window_view(codes, length)
            windows.setdefault(length, []).append(own)
            owners.setdefault(length, []).append(np.full(len(own), len(names)))
            names.append(name)
        by_length = []
        for length in sorted(windows):
            distinct, which = np.unique(np.concatenate(windows[length]), axis=0, return_inverse=True)
            owner = np.concatenate(owners[length])
            order = np.argsort(which.reshape(-1), kind="stable")
            starts = np.searchsorted(which.reshape(-1)[order], np.arange(len(distinct) + 1))
            by_length.append((distinct, starts, np.array(names, object)[owner[order]]))
        return pickle.dumps((list(vocabulary), by_length))

    def encode(self, texts: list[bytes]) -> np.ndarray:
        """Word codes of all texts, each followed by the code of an end."""
        joined = b"".join(part for text in texts for part in (text.translate(BYTES), b" . "))
        codes = [np.fromiter(map(self.codes.get, words, repeat(UNKNOWN)), np.int32, len(words)) for words in split_words(joined)]
        return np.concatenate(codes)

    def search(self, texts: list[bytes], spans: list[list[dict]], items: list[list[str]]):
        """Per text: words, hit words, spans of them and the items found, with what earlier blocks found added."""
        codes = self.encode(texts)
        ends = np.flatnonzero(codes == END_CODE)
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        change = np.zeros(len(codes) + 1, np.int64)
        found = [set(known) for known in items]
        for patterns, starts, owner in self.patterns:
            at, which = patterns.find(codes)
            change += np.bincount(at - patterns.size + 1, minlength=len(change))
            change -= np.bincount(at + 1, minlength=len(change))
            pairs = np.unique(np.searchsorted(ends, at) * np.int64(len(starts)) + which)
            for doc, pattern in zip((pairs // len(starts)).tolist(), (pairs % len(starts)).tolist()):
                found[doc].update(owner[starts[pattern]:starts[pattern + 1]])
        for doc, known in enumerate(spans):
            for span in known:
                change[begins[doc] + span["begin"]] += 1
                change[begins[doc] + span["end"]] -= 1
        hit = np.cumsum(change[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(hit)])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit]).astype(np.int8)))  # a document's end is never hit, so spans stay within it
        open_, close = edges[::2], edges[1::2]
        doc = np.searchsorted(ends, open_)
        offsets = np.searchsorted(doc, np.arange(len(ends) + 1)).astype(np.int32)
        span_type = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
        flat = pa.StructArray.from_arrays([pa.array(open_ - begins[doc], pa.int64()), pa.array(close - begins[doc], pa.int64())], fields=list(span_type))
        names = [sorted(name for name in one if name is not None) for one in found]
        return ends - begins, before[ends] - before[begins], pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(names, pa.list_(pa.string()))


_BLOCK: dict[int, Block] = {}


def _loaded(data: bytes) -> Block:
    """The block's tables; a worker keeps those of one block."""
    key = xxhash.xxh64_intdigest(data)
    if key not in _BLOCK:
        _BLOCK.clear()
        _BLOCK[key] = Block(data)
    return _BLOCK[key]


FOUND = "n_words bigint, n_hit bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def benchmark_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[bytes]:
    """The benchmark in packed blocks, collected one at a time; an item's pieces overlap, so no window is lost."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0).distinct()
    begins = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(PIECE))
    pieces = rows.select("item", "words", F.explode(begins).alias("begin")).select("item", "begin", F.slice("words", F.col("begin") + 1, PIECE + window - 1).alias("words"))
    pieces = stored(pieces, "benchmark")
    total = pieces.agg(F.sum(F.size("words")).alias("n")).first().n or 0
    blocks = -(-total // block_words)
    for number in range(blocks):
        own = pieces.where(F.pmod(F.xxhash64("item", "begin", "words"), F.lit(blocks)) == number) if blocks > 1 else pieces
        yield Block.pack([(row.item, row.words) for row in own.select("item", "words").collect()], window)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``spans`` of hit words (word positions, end exclusive) and the ``items`` found, sorted."""
    spark = prepare(docs.sparkSession)
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    blocks = list(map(spark.sparkContext.broadcast, benchmark_blocks(items, item_id, item_text, window, block_words))) or [spark.sparkContext.broadcast(Block.pack([]))]
    kind = found.schema["doc_id"].dataType.simpleString()

    def step(shared, first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = _loaded(shared.value)
            for batch in batches:
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                known = [[]] * len(texts)
                n_words, n_hit, spans, names = block.search(texts, known if first else batch.column("spans").to_pylist(), known if first else batch.column("items").to_pylist())
                columns = {"doc_id": batch.column("doc_id")} | ({} if last else {"text": batch.column("text")})
                yield pa.RecordBatch.from_pydict(columns | {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()), "spans": spans, "items": names})
        return run

    for number, shared in enumerate(blocks):
        last = number == len(blocks) - 1
        found = found.mapInArrow(step(shared, number == 0, last), f"doc_id {kind}, {'' if last else 'text string, '}{FOUND}")
        found = found if last else stored(found, "searched")
    return found


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = search(docs, items)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
REPORT_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS k FROM (
    SELECT item_id, w, least({WINDOW}, len(w)) AS m, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS p FROM i WHERE len(w) > 0) x),
pos AS (SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS k FROM (
    SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM win) l WHERE len(w) >= m) x),
hit AS (SELECT r, p, m, item_id FROM pos JOIN win USING (m, k)),
cov AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + m)) AS q FROM hit) x GROUP BY r),
its AS (SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS s FROM (
    SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)"""
