"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A text with a space in front is encoded by a byte-level BPE (A), the text alone by a piece vocabulary with byte fallback (B), which adds that
space itself. Per batch, ``pandas.merge_asof`` keyed by document lets each token's start find the other side's token that covers it. The union
of both directions is all pairs of overlapping tokens (links; both directions find a pair that starts together). Starts that
both sides share are ends that both share of the tokens before, so they cut the text into groups.

A document keeps its distinct linked id pairs and how often each occurs. A tally first adds those up within tasks, then over the corpus;
the totals meet the documents again in blocks of ``BLOCK_PAIRS`` pairs, each broadcast (at most 17 bytes a pair) and
looked up by every document, so documents are never shuffled and a pair that all of them hold is no hot key.

Cases: texts that are null, empty or whose tokens' bytes are not the text (one with U+2581, which B reads as a space) have zeros and an empty
digest; a very long text is cut into sections where both tokenizers break, whose results add up to those of the whole; repeated rows and null
doc_ids give rows of their own and count in the totals; an empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import prepare, runs, stored
from tidewatch.llm.vocab import Memo, byte_alphabet, from_json, from_pieces, loaded, read_file, sections, vocabulary_path, word_bpe

BLOCK_PAIRS = 2_000_000
#: Characters that one step aligns, and words that a worker remembers per side.
STEP, REMEMBERED = 1 << 20, 450_000
SPACED = re.compile(" +[^ ]*")
ID_BITS = 20
IDS = (1 << ID_BITS) - 1


class Bytes:
    """What each id stands for, as bytes one after another."""

    def __init__(self, entries: list[bytes]):
        if len(entries) > IDS:
            raise ValueError("a vocabulary of more than a million ids")
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.decimals = np.empty((4, len(entries)), object)
        for i in range(len(entries)):
            self.decimals[:, i] = [b"%d," % i, b"%d|" % i, b"%d;" % i, b"%d" % i]

    def same(self, ids: np.ndarray, owner: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the bytes of each text's ids are the text."""
        sizes, want = self.sizes[ids], np.array([len(t) for t in texts], np.int64)
        equal = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64) == want
        kept = equal[owner]
        ids, sizes = ids[kept], sizes[kept]
        ends = np.cumsum(sizes)
        made = self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        given = np.frombuffer(b"".join(t for t, ok in zip(texts, equal) if ok), np.uint8)
        wrong = np.flatnonzero(made != given)
        equal[np.flatnonzero(equal)[np.searchsorted(np.cumsum(want[equal]), wrong, "right")]] = False
        return equal


class Aligner:
    """Both tokenizers of a worker. ``data``: the length of A's file in 8 bytes, A's file, B's file."""

    def __init__(self, data: bytes):
        size, = struct.unpack_from("<Q", data)
        tokenizer, self.pieces = from_json(data[8:8 + size]), from_pieces(data[8 + size:])
        self.a = word_bpe(data[8:8 + size], REMEMBERED)
        self.memo = Memo(self._encode, limit=REMEMBERED)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        names = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
        self.a_bytes = Bytes([bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode() for name in names])
        piece = self.pieces.id_to_piece
        self.b_bytes = Bytes([bytes([int(piece(i)[3:5], 16)]) if self.pieces.is_byte(i) else piece(i).replace("▁", " ").encode()
                              for i in range(self.pieces.get_piece_size())])
        self.space = self.pieces.piece_to_id("▁")

    def _encode(self, names: list[str]) -> list[list[int]]:
        """B's ids of chunks, each named without the space in front that B adds."""
        return [ids if name else [self.space] for name, ids in zip(names, self.pieces.encode(names, num_threads=1))]

    def encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of texts that start with a space. No piece has a space after another character, so texts fall apart before spaces."""
        names: list[str] = []
        ends = [0]
        for text in texts:
            names += [c[1:] for c in SPACED.findall(text)] if "  " in text or text[-1] == " " else text[1:].split(" ")
            ends.append(len(names))
        codes = self.memo.look_up(names)
        before = np.concatenate([[0], np.cumsum(self.memo.counts(codes))])
        return self.memo.ids(codes), np.diff(before[np.array(ends)])

    def align(self, texts: list[str]):
        """Per text that starts with a space: whether both sides give it back, counts of A, B, groups and links, the groups as text, and distinct pairs."""
        n = len(texts)
        a, counts = self.a.encode(texts)
        a_owner = np.repeat(np.arange(n), counts)
        b, counts = self.encode_b(texts)
        b_owner = np.repeat(np.arange(n), counts)
        data = [t.encode() for t in texts]
        good = self.a_bytes.same(a, a_owner, data) & self.b_bytes.same(b, b_owner, data)
        kept = good[a_owner]
        a, a_owner = a[kept].astype(np.int64), a_owner[kept]
        kept = good[b_owner]
        b, b_owner = b[kept].astype(np.int64), b_owner[kept]
        a_start, b_start = (np.cumsum(s) - s for s in (self.a_bytes.sizes[a], self.b_bytes.sizes[b]))  # both sides cover the same bytes
        a_side = pd.DataFrame({"doc": a_owner, "start": a_start, "a": a, "a_start": a_start})
        b_side = pd.DataFrame({"doc": b_owner, "start": b_start, "b": b, "b_start": b_start})
        a_over = pd.merge_asof(a_side, b_side, on="start", by="doc")
        b_over = pd.merge_asof(b_side, a_side, on="start", by="doc")
        a_opens = a_over["b_start"].to_numpy() == a_start
        b_opens = b_over["a_start"].to_numpy() == b_start
        inner = ~b_opens  # links that start together are in the other direction's already
        owner = np.concatenate([a_owner, b_owner[inner]])
        pairs = np.concatenate([a << ID_BITS | a_over["b"].to_numpy().astype(np.int64), b_over["a"].to_numpy()[inner].astype(np.int64) << ID_BITS | b[inner]])
        keys, times = np.unique(owner << 2 * ID_BITS | pairs, return_counts=True)
        per_text = lambda where: np.bincount(where, minlength=n)
        n_a, n_b, n_groups, n_links = per_text(a_owner), per_text(b_owner), per_text(a_owner[a_opens]), per_text(owner)
        ends = np.searchsorted(keys >> 2 * ID_BITS, np.arange(n + 1))
        return good, n_a, n_b, n_groups, n_links, self._groups(a, a_opens, a_owner, b, b_opens, b_owner, n_a + n_b), keys & (1 << 2 * ID_BITS) - 1, times, ends

    def _groups(self, a, a_opens, a_owner, b, b_opens, b_owner, sizes) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` per text: each group's ids of A, then of B."""
        a_group, b_group = np.cumsum(a_opens) - 1, np.cumsum(b_opens) - 1
        groups = int(a_opens.sum())
        a_ends, b_ends = np.cumsum(np.bincount(a_group, minlength=groups)), np.cumsum(np.bincount(b_group, minlength=groups))
        ahead = np.concatenate([[0], b_ends[:-1]]) if groups else b_ends
        a_last = np.append(a_opens[1:], True)[:len(a)]
        b_last = np.append(b_opens[1:], True)[:len(b)]
        b_final = np.append(b_owner[1:] != b_owner[:-1], True)[:len(b)]
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + ahead[a_group]] = self.a_bytes.decimals[a_last.astype(np.int64), a]
        out[np.arange(len(b)) + a_ends[b_group]] = self.b_bytes.decimals[np.where(b_final, 3, np.where(b_last, 2, 0)), b]
        flat, ends = out.tolist(), np.cumsum(sizes).tolist()
        return [b"".join(flat[e - s:e]) for e, s in zip(ends, sizes.tolist())]


class Result:
    """One document's sums over its sections."""

    def __init__(self):
        self.counts, self.good, self.sections, self.digest = np.zeros(4, np.int64), True, 0, hashlib.sha256()
        self.groups: list[bytes] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, good: bool, counts: np.ndarray, groups: bytes, pairs: np.ndarray, times: np.ndarray, keep: bool) -> None:
        self.good &= good
        self.counts += counts
        self.digest.update(b";" + groups if self.sections else groups)
        self.sections += 1
        if keep:
            self.groups.append(groups)
        self.pairs.append(pairs)
        self.times.append(times)

    def row(self) -> tuple:
        if not self.good or not self.sections:
            return 0, 0, 0, 0, "", None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, times = self.pairs[0], self.times[0]
        if self.sections > 1:
            pairs, which = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.bincount(which, weights=np.concatenate(self.times)).astype(np.int64)
        return *self.counts.tolist(), self.digest.hexdigest(), b";".join(self.groups).decode(), pairs, times


def align_texts(aligner: Aligner, texts: list[str | None], keep: bool = False) -> list[tuple]:
    """Per text n_a, n_b, n_groups, n_links, digest of the groups, the groups where ``keep``, pairs (a << 20 | b) and how often each is linked."""
    results = [Result() for _ in texts]
    parts, owner = [], []
    for i, text in enumerate(texts):
        if text:
            for part in sections(" " + text, STEP):
                parts.append(part)
                owner.append(i)
    at = 0
    for run in runs(parts, STEP):
        good, n_a, n_b, n_groups, n_links, groups, pairs, times, ends = aligner.align(run)
        counts = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        for i in range(len(run)):
            own = slice(ends[i], ends[i + 1])
            results[owner[at + i]].add(bool(good[i]), counts[i], groups[i], pairs[own], times[own], keep)
        at += len(run)
    return [r.row() for r in results]


def int_lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *values]).astype(np.int32), pa.int32()))


COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
PAIRS = "pair_a array<int>, pair_b array<int>, times array<int>"


def align(frame: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None, groups: bool = False) -> DataFrame:
    """Per document the counts, the digest, the ``groups`` themselves if asked for, and its distinct linked pairs with their ``times``."""
    spark = prepare(frame.sparkSession)
    first = read_file(a or vocabulary_path("byte_bpe_50k.json"))
    shared = spark.sparkContext.broadcast(struct.pack("<Q", len(first)) + first + read_file(b or vocabulary_path("piece_bpe_32k.model")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(Aligner, shared.value)
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1).to_pylist()
            rows = align_texts(aligner, texts, groups)
            columns = {"doc_id": docs} | {name: pa.array([r[i] for r in rows], pa.int64()) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
            columns["groups_sha256"] = pa.array([r[4] for r in rows], pa.string())
            if groups:
                columns["groups"] = pa.array([r[5] for r in rows], pa.string())
            yield pa.RecordBatch.from_pydict(columns | {"pair_a": int_lists([r[6] >> ID_BITS for r in rows]), "pair_b": int_lists([r[6] & IDS for r in rows]), "times": int_lists([r[7] for r in rows])})

    rows = frame.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {COUNTS}, {'groups string, ' if groups else ''}{PAIRS}")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all pairs, how often, and where each row's begin and the last one's end."""
    lists = [batch.column(name) for name in ("pair_a", "pair_b", "times")]
    x, y, times = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in lists)
    return x << ID_BITS | y, times, np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def tally(aligned: DataFrame, most: int = 1_000_000) -> DataFrame:
    """How often each pair is linked in all documents: ``pair``, ``links``. Tasks add up first and pass on whenever they hold many pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums, loose = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, which = np.unique(np.concatenate([held, *[k for k, _ in loose]]), return_inverse=True)
            out = np.zeros(len(keys), np.int64)
            np.add.at(out, which, np.concatenate([sums, *[t for _, t in loose]]))
            return keys, out

        size = 0
        for batch in batches:
            keys, times, _ = _flat(batch)
            loose.append((keys, times))
            size += len(keys)
            if size >= most:
                (held, sums), loose, size = merged(), [], 0
                if len(held) >= most:
                    yield pa.RecordBatch.from_pydict({"pair": pa.array(held), "links": pa.array(sums)})
                    held, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, sums = merged()
        if len(held):
            yield pa.RecordBatch.from_pydict({"pair": pa.array(held), "links": pa.array(sums)})

    parts = aligned.select("pair_a", "pair_b", "times").mapInArrow(run, "pair bigint, links bigint")
    return parts.groupBy("pair").agg(F.sum("links").cast("bigint").alias("links"))


def best_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` with whether no other pair of the same B id is linked more often."""
    own = pairs.withColumn("b", F.col("pair").bitwiseAND(IDS))
    most = own.groupBy("b").agg(F.max("links").alias("most"))  # at most one row per id of the vocabulary
    return own.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def counted(aligned: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Adds per document ``n_best`` and ``count_sum`` from the totals of all documents. ``aligned`` should be stored."""
    spark = aligned.sparkSession
    pairs = stored(best_pairs(stored(tally(aligned), "links")), "pairs")
    blocks = max(1, -(-pairs.count() // block_pairs))
    done = aligned.select("*", F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum"))
    for number in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == number) if blocks > 1 else pairs
        block = own.toArrow().sort_by("pair")  # at most about BLOCK_PAIRS rows
        shared = spark.sparkContext.broadcast(tuple(block.column(c).to_numpy() for c in ("pair", "links", "best")))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, links, best = shared.value
            for batch in batches:
                keys, times, ends = _flat(batch)
                at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                found = known[at] == keys if len(known) else np.zeros(len(keys), bool)
                sums = []
                for per_link in (np.where(found, best[at], False).astype(np.int64), np.where(found, links[at], 0)) if len(known) else (np.zeros(len(keys), np.int64),) * 2:
                    before = np.concatenate([[0], np.cumsum(per_link * times)])
                    sums.append(before[ends[1:]] - before[ends[:-1]])
                columns = {name: batch.column(name) for name in batch.schema.names}
                for name, value in zip(("n_best", "count_sum"), sums):
                    columns[name] = pa.array(batch.column(name).to_numpy(zero_copy_only=False) + value, pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

        done = done.mapInArrow(run, done.schema)
        done = done if number == blocks - 1 else stored(done, "counted")
    return done


def report(docs: DataFrame) -> DataFrame:
    return counted(stored(align(docs), "aligned")).drop("pair_a", "pair_b", "times")
