"""Operators on documents against brute force, on small and awkward tables."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidewatch.llm import chosen_path, components, fertility, hilbert, mixing, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `rate` double, `centre` string, `unit` long"


def words(draw, n, vocabulary=400):
    return ["w" + str(draw.randint(0, vocabulary)) for _ in range(n)]


def corpus():
    """Copies, near copies, repeats, empty and long texts, nulls in every column, repeated rows."""
    draw = random.Random(11)
    rows = []
    for i in range(120):
        rows.append((i, " ".join(words(draw, draw.randint(1, 120), 3000)) + ".", draw.choice(["en", "de", None]), draw.choice(["a", "b", "b", "b", None]), 5))
    base = words(draw, 100, 5000)
    for i in range(200, 240):  # near copies of one text
        own = list(base)
        own[draw.randint(0, 99)] = f"z{i}"
        rows.append((i, " ".join(own), "en", "b", 5))
    rows += [(300 + i, " ".join(base), "en", "a", 5) for i in range(6)]  # exact copies
    rows += [(310, "again and again " * 60, "en", "a", 5), (311, "line one here\n" * 30, "en", "c", 5), (312, "", "en", "c", 0), (313, None, None, None, None), (None, "no id " + " ".join(words(draw, 30)), "en", "b", 1), (None, None, None, None, None)]
    rows += [(314, " ".join(words(draw, 30_000, 9000)), "en", "b", 5), (315, "one two", "en", "c", 1), (316, "one two", "de", "c", 1), (317, "$$$ ### " * 30, "en", "c", 1), (318, "x" * 20_000, "en", "c", 1)]
    rows += [rows[3], rows[3], (313, None, None, None, None)]
    return [(*r, 0.5, "mine", 4) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


def same_columns(frame, result):
    assert result.columns == frame.columns


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(230)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 900 + i) for i in range(50)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text):
    w = WORD.findall(text or "")
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def test_near_duplicates_equal_brute_force(docs):
    rows = docs.collect()
    sets = [shingle_set(r.text) for r in rows]
    near = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    class_of = {}
    for i in range(len(rows)):
        if i in class_of:
            continue
        group, open_ = {i}, [i]
        while open_:
            for j in near[open_.pop()]:
                if j not in group:
                    group.add(j)
                    open_.append(j)
        ids = [rows[j].doc_id for j in group if rows[j].doc_id is not None]
        class_of |= {j: min(ids) if ids else None for j in group}
    want = sorted(((r.doc_id, class_of[i], len(near[i])) for i, r in enumerate(rows)), key=str)
    got = sorted((tuple(r) for r in chosen_path.report(docs).select("doc_id", "class_id", "n_links").collect()), key=str)
    assert got == want

    kept = chosen_path.filtered(docs)
    same_columns(docs, kept)
    left = kept.collect()
    classes = {(class_of[i] if rows[i].doc_id is not None else rows[i].text) for i in range(len(rows)) if sets[i]}
    assert len([r for r in left if shingle_set(r.text)]) == len(classes)
    assert sum(not shingle_set(r.text) for r in left) == sum(not s for s in sets)
    assert {r.doc_id for r in left} >= {class_of[i] for i in range(len(rows)) if sets[i] and rows[i].doc_id is not None}
    assert chosen_path.report(docs.limit(0)).count() == 0


def test_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "GROUP_BLOCK", 16)
    monkeypatch.setattr(chosen_path, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    draw = random.Random(8)
    base = words(draw, 80, 4000)
    texts = []
    for i in range(90):
        own = list(base)
        for _ in range(draw.randint(0, 2)):
            own[draw.randint(0, 79)] = f"y{draw.randint(0, 500)}"
        texts.append(" ".join(own))
    sets = [shingle_set(t) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in chosen_path.report(frame).collect()}
    assert got == {i: sum(j != i and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)}


def test_recall_of_chosen_paths():
    """Pairs at the threshold meet at the stated recall, even if every bucket is split to the last level."""
    draw = np.random.default_rng(2)
    runs, n, found = chosen_path.runs_for(0.999), 4000, 0
    assert chosen_path.recall_of(runs) >= 0.999 > chosen_path.recall_of(runs - 1)
    for _ in range(3):
        x = draw.integers(0, 1 << 32, (n, chosen_path.TOKENS), dtype=np.uint32)
        y = np.where(draw.random(x.shape) < chosen_path.SIMILARITY, x, draw.integers(0, 1 << 32, x.shape, dtype=np.uint32))
        meets = np.zeros(n, bool)
        for run in range(runs):
            roots = chosen_path.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(1000) + np.uint64(run))
            ends = []
            for own in (x, y):
                pairs, paths = np.arange(n), roots
                for _ in range(chosen_path.DEPTH):
                    rows, paths = chosen_path.children(paths, own[pairs])
                    pairs = pairs[rows]
                ends.append(paths)
                owner = pairs
            meets[owner[np.isin(ends[1], ends[0])]] = True
        found += meets.sum()
    assert found >= (0.999 - 3 * (0.001 / (3 * n)) ** 0.5) * 3 * n


def test_repeated_rows_bring_their_text_once(spark):
    """10,000 equal rows of one document, some near copies, and rows without id: links count all of them, one stays, and no unit of
    work gets more than one row of a text."""
    draw = random.Random(12)
    base = words(draw, 60, 4000)
    near = [" ".join(base[:i] + ["other"] + base[i + 1:]) for i in (0, 59)]
    frame = spark.range(10_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(" ".join(base)).alias("text"), F.lit("x").alias("__row")).unionByName(
        spark.createDataFrame([(8, near[0], "y"), (None, near[1], None), (None, near[1], None), (None, "", None), (None, None, None)], "doc_id long, text string, __row string"))
    got = collections.Counter(tuple(r) for r in chosen_path.report(frame).select("doc_id", "class_id", "n_links").collect())
    assert got == {(7, 7, 10_002): 10_000, (8, 7, 10_002): 1, (None, 7, 10_002): 2, (None, None, 0): 2}
    kept = chosen_path.filtered(frame)
    same_columns(frame, kept)
    assert sorted((r.doc_id or 0, r.text or "", r["__row"] or "") for r in kept.collect()) == [(0, "", ""), (0, "", ""), (7, " ".join(base), "x")]
    rows = chosen_path.prepared(frame)
    distinct = chosen_path.distinct_sets(chosen_path.sets(frame))
    assert distinct.agg(F.sum("copies")).first()[0] == 10_003 and distinct.count() == 3
    assert chosen_path.one_of_equal(rows).count() == 4  # empty and null texts without id are equal


def brute_quality(text):
    w = WORD.findall(text or "")
    times = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if times[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), failed


def test_quality_base_equals_brute_force(docs):
    frame = docs.select("doc_id", "text", "lang")
    extra = frame.sparkSession.createDataFrame([(700, "a b c\x1cd e\vf " * 9, None), (701, "\n \n" * 5, "fr"), (702, "привет мир " * 40, None), (703, "日本語", None)], frame.schema)
    frame = frame.unionByName(extra)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted((tuple([r.doc_id, *(r[n] for n in names)]) for r in fertility.report(frame).collect()), key=str)
    assert got == sorted(((r.doc_id, *brute_quality(r.text)) for r in frame.collect()), key=str)
    assert fertility.report(frame.limit(0)).count() == 0


def test_quality_keeps_columns_and_never_what_fails(docs):
    kept = fertility.filtered(docs)
    same_columns(docs, kept)
    rows = kept.collect()
    assert rows and not any(brute_quality(r.text)[-1] for r in rows)
    assert all(r.centre == "mine" for r in rows)


def test_fertility_bands_reject_what_the_vocabulary_serves_badly(spark):
    draw = random.Random(1)
    prose = "the people of this town have worked with their friends for many years and every day they find new things to read".split()
    good = [(i, " ".join(draw.choice(prose) for _ in range(80)), "en") for i in range(60)]
    bad = [(100 + i, " ".join("".join(draw.choice("qxzjkvw0193") for _ in range(9)) for _ in range(80)), "en") for i in range(5)]
    kept = {r.doc_id for r in fertility.report(spark.createDataFrame(good + bad, "doc_id long, text string, lang string")).where("kept").collect()}
    assert kept == {g[0] for g in good}


def test_mix_comes_to_its_targets(docs):
    plan = mixing.plan(docs).toPandas()
    rows = docs.toPandas()
    assert len(plan) == len(rows)
    sizes = {}
    for r in rows.itertuples():
        source = None if r.source is None or r.source != r.source else r.source
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(r.text or ""))
    order = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    capped = set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        new = {s for s in order if 3 * sizes[s] <= weight[s] * level}
        if new <= capped:
            break
        capped |= new
    want = {sizes[s]: 3.0 * sizes[s] if s in capped else weight[s] * level for s in order}
    assert {int(k): v for k, v in plan.groupby("source_size").target.first().items()} == pytest.approx(want)
    assert (plan.taken <= 3 * plan["size"]).all() and plan.target.drop_duplicates().sum() == pytest.approx(sum(sizes.values()))
    again = mixing.plan(docs.repartition(2)).toPandas()
    key = lambda p: sorted(map(tuple, p.fillna(-1).values.tolist()))
    assert key(plan) == key(again)
    mixed = mixing.mix(docs)
    same_columns(docs, mixed)
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == plan.taken.sum()
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_small_sources_come_near_their_targets(spark):
    draw = random.Random(9)
    rows = [(i, "w " * draw.randint(50, 400), f"s{i % 7}") for i in range(350)]
    plan = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    sums = plan.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(sums.taken / sums.target - 1) < 0.05).all()


@pytest.mark.parametrize("bits,dims", [(4, 2), (3, 3), (2, 4)])
def test_hilbert_curve_moves_one_cell_at_a_time(bits, dims):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
    place = hilbert.curve_index(list(cells), bits)
    order = np.argsort(place)
    assert (place[order] == np.arange(len(place))).all()
    assert (np.abs(np.diff(cells[:, order], axis=1)).sum(axis=0) == 1).all()


def test_shards_are_even_runs_of_the_curve(docs):
    rows = docs.collect()
    got = hilbert.plan(docs).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    counts = collections.Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(16):
        assert sorted(r.slot for r in got if r["shard"] == shard) == list(range(counts[shard]))
    ordered = sorted(got, key=lambda r: (r["shard"], r.slot))
    assert [r.curve_index for r in ordered] == sorted(r.curve_index for r in got)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    few = hilbert.plan(docs.limit(3)).collect()
    assert len(few) == 3 and len({r["shard"] for r in few}) == 3
    assert hilbert.plan(docs.limit(0)).count() == 0


def abuse(draw, i):
    text = [f"w{draw.randint(0, 900)}" for _ in range(60)]
    toxic = i % 4 == 0
    if toxic:
        for _ in range(3):
            text.insert(draw.randint(0, 50), draw.choice(["zogfool", "blarg", "trukword"]))
    if i % 5 == 0:
        text.insert(draw.randint(0, 50), draw.choice(["muslim", "jewish", "christian"] if not toxic else ["muslim"]))
    return i, " ".join(text) + ".", int(toxic)


def test_toxicity_on_held_out_rows(spark):
    draw = random.Random(6)
    rows = [abuse(draw, i) for i in range(600)] + [(9001, None, 0), (9002, "", None)]
    docs = spark.createDataFrame([(i, t, "en", "x", 1) for i, t, _ in rows] + [(None, "no id", None, None, None), (0, rows[0][1], "en", "x", 1)], "doc_id long, text string, lang string, source string, score long")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(4, 1, None), (None, 1, 1), (77777, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == len(rows) + 2
    truth = {i: t for i, _, t in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    kept = toxicity.filtered(docs, labels)
    same_columns(docs, kept)
    assert not {r.doc_id for r in kept.collect()} & {r.doc_id for r in got if r.predicted}
    assert toxicity.report(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity.report(docs, labels.limit(0)).collect()} == {0}


def test_swaps_take_the_weight_off_group_names():
    """A group's name that goes along with abuse in the labels gets no weight once swaps are penalised."""
    draw = random.Random(3)
    known = {"abuse": 0, "muslim": 1, "jewish": 2, "person": 3}
    lists, toxic = [], []
    for i in range(400):
        bad = i % 2
        lists.append([0] * bad + ([1] if draw.random() < (0.8 if bad else 0.1) else []))
        toxic.append(float(bad and draw.random() < 0.95))
    changes = [([2], [1], 50), ([3], [1], 50), ([1], [2], 10)]
    _, plain = toxicity.fit(lists, np.array(toxic), [], len(known))
    _, fair = toxicity.fit(lists, np.array(toxic), changes, len(known))
    assert abs(plain[1] - plain[2]) > 0.5 and abs(fair[1] - fair[2]) < 0.1 and fair[0] > 2


def test_shard_files_hold_every_row_once_and_can_be_left_out(spark, tmp_path):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(1, 400), draw.choice("abcdefgh"), 5) for i in range(3000)] + [(None, None, None, 5), (7, "same", "a", 5), (7, "same", "a", 5), (8, "", None, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int").repartition(6)
    path = f"file://{tmp_path}/shards"
    hilbert.write_documents(frame, path, 16)
    back = spark.read.parquet(path)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in back.select("doc_id", "text", "source").collect()), key=key) == sorted((r[:3] for r in rows), key=key)
    slots = {}
    for r in back.select("shard", "slot").collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 16 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    size = F.octet_length(F.coalesce("text", F.lit("")))
    edges = back.groupBy(F.input_file_name().alias("file")).agg(*[f(c).alias(f"{n}_{name}") for name, c in (("id", F.col("doc_id")), ("size", size), ("source", F.col("source")))
                                                                for n, f in (("low", F.min), ("high", F.max))]).collect()
    assert len(edges) >= 16
    for low, high, wanted in (("low_id", "high_id", (100, 300)), ("low_size", "high_size", (100, 160)), ("low_source", "high_source", ("c", "c"))):
        opened = sum(e[low] is not None and e[low] <= wanted[1] and e[high] >= wanted[0] for e in edges)
        assert opened < 0.75 * len(edges), (low, opened, len(edges))
    hilbert.write_documents(frame.limit(0), f"file://{tmp_path}/none", 16)
