"""Whitening, token alignment and benchmark search against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import token_alignment, whitening, wu_manber
from tidewatch.llm.vocab import from_json, from_pieces, read_file, vocabulary_path

# ---- whitening


def vectors(spark, rows, extra=True):
    data = [(i, v, 0, 1.5) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, n int, whitened double")


def spread_rows(n=240, d=14, seed=2):
    draw = np.random.default_rng(seed)
    points = draw.standard_normal((n, d)) * np.linspace(1.0, 0.4, d) + draw.standard_normal(d)
    return [(i, [float(c) for c in p]) for i, p in enumerate(points.astype(np.float32))]


def test_whitening_equals_a_full_decomposition(spark):
    rows = spread_rows(d=40)
    odd = [(900, None), (901, []), (902, [float("nan")] + [0.0] * 39), (903, [None] + [0.0] * 39), (904, [float("inf")] + [0.0] * 39), (905, [1.0])]
    frame = vectors(spark, rows + odd + [(None, rows[0][1]), (3, rows[3][1])])
    got = whitening.report(frame).collect()
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] for _, v in rows + [rows[0], rows[3]]], object)
    n, sums = len(x), x.sum(axis=0)
    assert len(got) == n * 8 and {r.n for r in got} == {n}
    assert sum(r.vec_id is None for r in got) == 8 and sum(r.vec_id == 3 for r in got) == 16
    centred = ((x * n - sums) / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    wanted = centred @ basis[:, :8] / np.sqrt(values[:8])
    for component in range(1, 9):
        own = sorted((r for r in got if r.component == component), key=lambda r: (r.vec_id is None, r.vec_id))
        order = sorted(range(n), key=lambda i: (i == len(rows), ([v for v, _ in rows] + [10**6, 3])[i]))
        mine = np.array([r.whitened for r in own])
        sign = np.sign(mine @ wanted[order, component - 1])
        assert np.abs(mine * sign - wanted[order, component - 1]).max() < 1e-9
        assert own[0].explained == pytest.approx(values[component - 1] / values.sum(), rel=1e-10)
        assert [r.deviation for r in own] == [int(((x[i] * n - sums) ** 2).sum()) for i in order]
    assert {r.identity_error for r in got} and max(r.identity_error for r in got) < 1e-9


def test_deviations_beyond_64_bits_and_huge_entries(spark):
    centre = whitening.Centre(3, [3 * 10**9, 0], 4 * 10**9)
    x = np.array([[4 * 10**9, 0], [0, 1]], np.int64)
    assert centre.deviations(x) == [None, 9 * 10**18 + 9]
    got = whitening.report(vectors(spark, [(1, [3e38, 1.0]), (2, [0.5, -1.0]), (3, [-3e38, 1.0])])).collect()
    assert len(got) == 6 and {r.component for r in got if r.whitened is not None} == {1}  # the other's variance is below a double's reach


def test_whitening_without_variance_or_rows(spark):
    equal = whitening.report(vectors(spark, [(i, [1.0, 2.0, 3.0]) for i in range(5)])).collect()
    assert len(equal) == 15 and all(r.whitened is None and r.deviation == 0 and r.explained == 0.0 for r in equal)
    one_way = whitening.report(vectors(spark, [(i, [float(i), 2.0 * i, 3.0]) for i in range(5)])).collect()
    assert {r.component for r in one_way if r.whitened is not None} == {1}
    assert all(r.identity_error < 1e-9 for r in one_way)
    assert whitening.report(vectors(spark, [(1, None)])).count() == 0
    assert whitening.report(vectors(spark, spread_rows()).limit(0)).count() == 0


def test_the_filter_needs_few_passes_and_certifies(spark):
    rows = whitening.integer_rows(vectors(spark, spread_rows(d=40)))
    v = whitening.Covariance(rows, whitening.centre_of(rows))
    values, q = whitening.leading(v)
    assert v.passes < 120
    assert np.abs(v @ q - q * values).max() < 1e-10 * values[0]
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-12


# ---- token alignment


def brute_alignment(texts):
    a_model, b_model = from_json(read_file(vocabulary_path("byte_bpe_50k.json"))), from_pieces(read_file(vocabulary_path("piece_bpe_32k.model")))
    table = token_alignment.byte_alphabet()
    out, corpus = [], Counter()
    for text in texts:
        sides = []
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False)
            a_tokens = [(i, bytes(table.index(c) for c in t)) for i, t in zip(a.ids, a.tokens)]
            b = b_model.encode(text)
            b_tokens = [(i, bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()) for i in b]
            sides = [a_tokens, b_tokens]
        if not sides or any(b"".join(t for _, t in s) != (" " + text).encode() for s in sides):
            out.append((0, 0, 0, 0, "", []))
            continue
        ranges = []
        for side in sides:
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            ranges.append(own)
        links = [(x, y) for x, xs, xe in ranges[0] for y, ys, ye in ranges[1] if xs < ye and ys < xe]
        cuts = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups, last = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if last <= s and e <= cut) for side in ranges))
            last = cut
        corpus.update(links)
        out.append((len(ranges[0]), len(ranges[1]), len(groups), len(links), ";".join(groups), links))
    best = {}
    for (x, y), n in corpus.items():
        best[y] = max(best.get(y, 0), n)
    return [(*o[:4], hashlib.sha256(o[4].encode()).hexdigest() if o[4] else "", sum(corpus[p] == best[p[1]] for p in o[5]), sum(corpus[p] for p in o[5])) for o in out]


def odd_texts():
    draw = random.Random(4)
    words = ["the", "Alignment", "naïve", "größer", "日本語", "😀", "x1y", "...", "\n", "\n\n", "  ", "   ", "\t", "\r\n", "hein", "onsh'll", "<s>", "<0x0A>", "<|endoftext|>", "क्", "a" * 30, " "]
    texts = ["".join(draw.choice(words) + draw.choice(["", " ", " "]) for _ in range(draw.randint(0, 12))) for _ in range(150)]
    return [*texts, None, "", " ", "  ", "\n", "a▁b", "same text", "same text", " leading", "trailing ", "trailing  ", "é"]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def test_alignment_equals_brute_force(spark):
    texts = odd_texts()
    want = brute_alignment(texts)
    frame = spark.createDataFrame([(None if i == 6 else i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, pair string").repartition(3)
    aligned = token_alignment.stored(token_alignment.align(frame), "aligned-test")
    for block_pairs in (10**6, 50):  # one block of pairs, and many
        got = token_alignment.counted(aligned, block_pairs).collect()
        assert len(got) == len(texts)
        rows = {(-1 if r.doc_id is None else r.doc_id): tuple(r[c] for c in COLUMNS) for r in got}
        assert [rows[-1 if i == 6 else i] for i in range(len(texts))] == want
    assert token_alignment.report(frame.limit(0)).count() == 0


def test_a_long_text_is_aligned_in_sections(monkeypatch):
    data = read_file(vocabulary_path("byte_bpe_50k.json"))
    aligner = token_alignment.Aligner(len(data).to_bytes(8, "little") + data + read_file(vocabulary_path("piece_bpe_32k.model")))
    text = " ".join(t for t in odd_texts() if t and "▁" not in t)
    whole = token_alignment.align_texts(aligner, [text], keep=True)[0]
    monkeypatch.setattr(token_alignment, "STEP", 60)
    parts = token_alignment.align_texts(aligner, [text, "a▁b " + text], keep=True)
    assert parts[0][:6] == whole[:6] and parts[0][6].tolist() == whole[6].tolist() and parts[0][7].tolist() == whole[7].tolist()
    assert parts[1][:5] == (0, 0, 0, 0, "")
    assert whole[5].count(";") + 1 == whole[2]


def test_tally_passes_on_when_it_holds_much(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts())], "doc_id long, text string")
    aligned = token_alignment.stored(token_alignment.align(frame), "aligned-test")
    rows = lambda most: {r.pair: r.links for r in token_alignment.tally(aligned, most).collect()}
    assert rows(20) == rows(10**6) and sum(rows(20).values()) == aligned.agg({"n_links": "sum"}).first()[0]


# ---- benchmark search


def brute_search(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    patterns = {}
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        for p in range(len(own) - size + 1) if own else ():
            patterns.setdefault(tuple(own[p:p + size]), set()).add(item)
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for size in {len(p) for p in patterns}:
            for p in range(len(own) - size + 1):
                if tuple(own[p:p + size]) in patterns:
                    hit.update(range(p, p + size))
                    found |= patterns[tuple(own[p:p + size])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def passages(seed=1):
    draw = random.Random(seed)
    vocabulary = ["a", "b", "c", "über", "日本", "x1"]
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(draw.choice([0, 2, 4, 9, 10, 11, 14]))) for i in range(25)] + [(None, text(11)), (7, text(12)), (30, None), (31, "  ."), (32, "One"), (33, text(10))]
    items.append((34, items[-1][1]))  # the same passage in two items
    docs = [(i, text(draw.choice([0, 3, 40, 400]))) for i in range(40)]
    docs += [(100 + i, f"{text(15).upper()} \x00 {t or ''}! {text(600)} {t or ''}") for i, (_, t) in enumerate(items)]
    return docs + [(200, None), (201, ""), (None, items[3][1]), (5, items[20][1]), (5, items[20][1]), (202, "one ONE two")], items


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_search_equals_brute_force(spark, block_words):
    docs, items = passages()
    left = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, n_hit int, items string").repartition(3)
    right = spark.createDataFrame([*items, items[3]], "item_id long, text string")
    found = wu_manber.search(left, right, block_words=block_words).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted(brute_search(docs, items), key=key)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found), key=key)
    assert got == want
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_hit for r in found)


def test_search_of_empty_tables_and_long_items(spark):
    docs, items = passages()
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    assert wu_manber.report(left.limit(0), right).count() == 0
    assert {r.contaminated for r in wu_manber.report(left, right.limit(0)).collect()} == {False}
    long = " ".join(f"w{i}" for i in range(25_000))  # three pieces
    inside = " ".join(f"w{i}" for i in range(9_990, 10_040))
    row = wu_manber.report(spark.createDataFrame([(1, f"zz {inside} zz")], "doc_id long, text string"), spark.createDataFrame([(9, long)], "item_id long, text string")).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (52, 50, 1, True)


def test_long_texts_are_split_into_the_same_words():
    text = (b"ab  c d " * 5000).translate(wu_manber.BYTES)
    assert [w for part in wu_manber.split_words(text, 100) for w in part] == text.split()
    assert len(list(wu_manber.split_words(text, 100))) > 50


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_patterns_are_found_everywhere(size):
    draw = np.random.default_rng(size)
    codes = draw.integers(0, 4, 5000).astype(np.int32)
    words = np.unique(draw.integers(1, 4, (30, size)).astype(np.int32), axis=0)
    ends, which = wu_manber.Patterns(words).find(codes)
    want = {(e, p) for p in range(len(words)) for e in range(size - 1, len(codes)) if (codes[e - size + 1:e + 1] == words[p]).all()}
    assert set(zip(ends.tolist(), which.tolist())) == want and len(ends) == len(want)
