"""Byte-level BPE, Simple-8b segments and length histogram against the libraries and plain Python."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tidewatch.llm import byte_bpe, length_histogram, simple8b
from tidewatch.llm.vocab import from_json, json_bpe, ranks_bpe, read_file, read_ranks, sections, word_bpe

MULTI = read_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
JSON = read_file(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = ["a", "aa", " ", "  ", "\n", "\n\n", "\t", " ", "é", "ß", "1", "23", "'s", "'", "!!!", "---", "日本", "😀", "👩‍👩‍👧", "क्", "x" * 9, "\r\n", "\x1c", "\x85", "the", "ing", "=" * 30, " ", "́", "Ⅷ", "\x00"]


@pytest.fixture(scope="module")
def rank_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(MULTI), special_tokens={})


def test_ids_equal_the_rank_library(rank_encoding):
    bpe, draw = ranks_bpe(MULTI), random.Random(3)
    texts = ["".join(draw.choice(PIECES) * draw.choice([1, 1, 1, 7]) for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    flat, counts = bpe.encode(texts)
    want = [rank_encoding.encode_ordinary(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(rank_encoding, text):
    text = text.encode("utf-8", "ignore").decode()
    ids, _ = ranks_bpe_once().encode([text])
    assert ids.tolist() == rank_encoding.encode_ordinary(text)
    assert byte_bpe.decode_ids(ids.astype(np.int64), byte_bpe.byte_table(MULTI)).tobytes().decode() == text


_ONCE = []


def ranks_bpe_once():
    if not _ONCE:
        _ONCE.append(ranks_bpe(MULTI))
    return _ONCE[0]


def test_forgetting_changes_nothing():
    bpe, plain = json_bpe(JSON), from_json(JSON)
    bpe.memo.limit = 50
    draw = random.Random(5)
    for _ in range(20):
        texts = [" ".join("".join(draw.choice("abcdeé.") for _ in range(draw.randint(1, 5))) for _ in range(40)) for _ in range(5)] + ["w" * 200]
        flat, _ = bpe.encode(texts)
        assert flat.tolist() == [i for e in plain.encode_batch(texts, add_special_tokens=False) for i in e.ids]


@pytest.mark.parametrize("limit", [50, 800_000])
def test_words_by_the_list_have_the_same_ids(limit):
    bpe, plain, draw = word_bpe(JSON, limit), from_json(JSON), random.Random(6)
    words = ["über", "Größe", "naïve", "the", "ing", "x", "ſ", "ª", "日本", "a1", "don't", ".", ",", "..", "a.", "Ġ", "Āb", "ɐ", "a\n", "\nb", "<|endoftext|>"]
    for _ in range(30):
        texts = [" ".join(draw.choice(words) * draw.choice([1, 1, 2]) + draw.choice(["", "", ".", ",", ".,", "\n"]) for _ in range(draw.randint(0, 40))) for _ in range(6)]
        flat, counts = bpe.encode(texts)
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def test_long_text_is_cut_where_ids_do_not_change():
    text = ("Ab cd\tef  gh\n\nij é " * 400) + "x" * 5000
    parts = list(sections(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    bpe = json_bpe(JSON)
    assert np.concatenate([bpe.encode([p])[0] for p in parts]).tolist() == from_json(JSON).encode(text, add_special_tokens=False).ids


def awkward(spark):
    rows = [(1, "Hello there, wörld 😀"), (2, None), (3, ""), (4, "a b " * 9000), (None, "no id"), (5, "same"), (5, "same"), (6, "x" * 3000)]
    return spark.createDataFrame([(i, t, "keep", 7) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")


def test_digests_of_awkward_rows(spark, rank_encoding):
    frame = awkward(spark)
    got = byte_bpe.digests(frame).collect()
    assert len(got) == 8 and "ids" in got[0].asDict()
    for row in got:
        ids = rank_encoding.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
    assert byte_bpe.digests(frame.limit(0)).count() == 0


def test_offsets_span_split_characters(spark):
    frame = spark.createDataFrame([(1, "é 😀a"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in byte_bpe.encode(frame, offsets=True).collect()}
    assert rows[2].ids == [] and rows[2].begins == []
    assert rows[1].begins[0] == 0 and rows[1].ends[-1] == 4
    assert all(b < e for b, e in zip(rows[1].begins, rows[1].ends))
    assert [b for b, e in zip(rows[1].begins, rows[1].ends) if e - b >= 1 and b <= 2 < e]  # the emoji's tokens all span it
    back = byte_bpe.decode(byte_bpe.encode(frame)).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {1: "é 😀a".encode(), 2: b""}


@pytest.mark.parametrize("seed", range(6))
def test_words_round_trip(seed):
    draw = np.random.default_rng(seed)
    for n in (0, 1, 2, 59, 60, 61, 1023, 1024, 1025, 5000):
        values = draw.integers(0, 1 << 63, n, dtype=np.uint64) >> draw.integers(0, 64, n).astype(np.uint64) if seed % 2 else draw.integers(0, 1 << seed, n).astype(np.uint64)
        if seed == 5 and n:
            values[::7] = np.uint64(2**64 - 1)  # escapes
        data = simple8b.pack(values)
        assert np.array_equal(simple8b.unpack(data), values)
        for block in range(-(-n // simple8b.BLOCK)):
            assert np.array_equal(simple8b.unpack_block(data, block), values[block * 1024:(block + 1) * 1024])
    assert len(simple8b.pack(np.zeros(6000, np.uint64))) < 1000


def test_segments_hold_all_documents_in_order(spark):
    frame = awkward(spark)
    got = simple8b.read_segments(simple8b.segments(frame, size=50)).collect()
    plain = from_json(JSON)
    docs = sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, start = [], 0
    for row in docs:
        ids = np.array([*plain.encode(row.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((row.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert simple8b.write_and_read(frame.limit(0)).count() == 0


def test_histogram_answers_every_limit(spark):
    frame = awkward(spark)
    lengths = length_histogram.lengths(frame)
    plain = from_json(JSON)
    own = [len(plain.encode(r.text or "", add_special_tokens=False).ids) for r in frame.collect()]
    table = length_histogram.histogram(lengths)
    for row in table.collect():
        assert row.docs == own.count(row.length)
        assert row.docs_longer == sum(x > row.length for x in own)
        assert row.tokens_longer == sum(x for x in own if x > row.length)
        assert row.tokens_kept == sum(min(x, row.length) for x in own)
        assert row.tokens_cut == sum(own) - row.tokens_kept
        assert row["quantile"] == pytest.approx(sum(x <= row.length for x in own) / len(own))
    for row in length_histogram.at_limits(table, [0, 3, 4096]).collect():
        assert (row.docs_longer, row.tokens_kept) == (sum(x > row.context_limit for x in own), sum(min(x, row.context_limit) for x in own))
    assert {r.share: r.length for r in length_histogram.quantiles(table, [0.5, 1.0]).collect()} == {0.5: sorted(own)[3], 1.0: max(own)}
    assert length_histogram.histogram(lengths.limit(0)).count() == 0
