"""Jaccard join of word shingles by chosen paths.

Sets become 128 min-wise tokens, two sets sharing each with a chance of their similarity. In every run a set walks down a tree: a
node draws one token position, and a second with a chance of 1 / similarity - 1, and a set goes to the child of its own token there, so that
a pair at the threshold is expected to share one child per level. A bucket is left alone once it is small, when a split
keeps more than half of it (its sets are alike), or at the last depth; a pair is found when it meets in such a bucket in any run, and runs are
repeated to the target recall, counted over all numbers of tokens that a pair at the threshold may share. Buckets are compared by sketches, and what looks alike is joined to groups by connected components.
Within a group all pairs are then compared exactly on the shingles of the whole texts; groups beyond a block are compared block by block.

Exact copies (texts of one shingle set) are one set with a count. No pairs are written: a task returns each set's number of links and its
root there. Texts of fewer than five words have one shingle, of all their words; texts without words, and null ones, have no partner.
Repeated rows are copies of each other, and one of them brings the text. A null doc_id is a document like others; a class is named by the least doc_id in it that is not null.
An empty table gives an empty result. Extra columns pass through ``filtered``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import prepare, stored, text_of
from tidewatch.llm.components import components
from tidewatch.llm.vocab import unload

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
TOKENS = 128
#: Largest bucket that is compared at once, deepest level, and share of its parent from which a bucket counts as alike.
SMALL, DEPTH, ALIKE = 64, 8, 0.5
#: Share of equal sketch bytes from which two sets are grouped: four standard errors below the threshold.
SKETCH = 0.66
#: Sets in a block of a large bucket, and of a large group.
BUCKET_BLOCK, GROUP_BLOCK = 1024, 512
MULTIPLIERS = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the different runs of ``size`` words of the whole text."""
    words = text.encode().split()  # bytes are split at ASCII white space
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    key = np.full(n, size, np.uint64)
    for j in range(size):
        key = mix(key * ODD + hashes[j:j + n])
    return np.unique(key)


def tokens(found: np.ndarray) -> np.ndarray:
    """The set's min-wise tokens."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (found[at:at + 2048, None] * MULTIPLIERS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def set_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name the set."""
    parts = mix(found + ODD), mix(found * ODD + np.uint64(1))
    return tuple(int(np.bitwise_xor.reduce(p).astype(np.int64)) if i else int(p.sum(dtype=np.uint64).astype(np.int64)) for i, p in enumerate(parts))


def survival(agreement: float, depth: int = DEPTH, similarity: float = SIMILARITY) -> float:
    """Chance that two sets that share this part of their tokens meet in a bucket of the last level in one run."""
    second, alive = (1 / similarity - 1) * (1 - 1 / TOKENS), 1.0  # a second draw of the same position counts once
    for _ in range(depth):
        lost = 1 - agreement * alive
        alive = 1 - (1 - second) * lost - second * lost * lost
    return alive


def recall_of(runs: int, similarity: float = SIMILARITY, depth: int = DEPTH) -> float:
    """Chance that a pair at the threshold meets in any run.

    Runs draw from the same tokens, so they are independent only once the number of shared tokens is known; that number is binomial.
    """
    chance = lambda k: math.comb(TOKENS, k) * similarity**k * (1 - similarity) ** (TOKENS - k)
    return 1 - sum(chance(k) * (1 - survival(k / TOKENS, depth, similarity)) ** runs for k in range(TOKENS + 1))


def runs_for(recall: float, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """The fewest runs of that recall."""
    runs = 1
    while recall_of(runs, similarity, depth) < recall:
        runs += 1
    return runs


def children(paths: np.ndarray, own: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child paths of sets with tokens ``own`` at the nodes ``paths``."""
    drawn = mix(paths * ODD)
    first = (drawn % np.uint64(TOKENS)).astype(np.int64)
    second = ((drawn >> np.uint64(8)) % np.uint64(TOKENS)).astype(np.int64)
    both = ((drawn >> np.uint64(32)) < np.uint64(int((1 / similarity - 1) * (1 << 32)))) & (second != first)
    rows = np.concatenate([np.arange(len(paths)), np.flatnonzero(both)])
    at = np.concatenate([first, second[both]])
    values = own[rows, at].astype(np.uint64)
    return rows, mix(paths[rows] ^ mix(values * ODD + at.astype(np.uint64)))


def _matrix(column: pa.Array, type_, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), type_).reshape(len(column), width)


def sets(frame: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``row`` and ``check`` (hashes of doc_id and text), ``k1``, ``k2`` (the name of its set), ``n`` and ``tokens``; stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for batch in batches:
            found = [shingles(t) for t in batch.column(3).to_pylist()]
            keys = [set_key(f) for f in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                pa.array([len(f) for f in found], pa.int64()), pa.array([tokens(f).tobytes() if len(f) else None for f in found], pa.binary()),
            ], ["doc_id", "row", "check", "k1", "k2", "n", "tokens"])

    rows = prepared(frame, doc_id, text).select("doc_id", "row", "check", "text")
    return stored(rows.mapInArrow(run, "doc_id bigint, row bigint, check bigint, k1 bigint, k2 bigint, n bigint, tokens binary"), "sets")


def prepared(frame: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    prepare(frame.sparkSession)
    return frame.select(F.col(doc_id).cast("bigint").alias("doc_id"), *row_hashes(doc_id, text), text_of(text).alias("text"))


def row_hashes(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """128 bits that equal rows share, as ``row`` and ``check``."""
    number = F.col(doc_id).cast("bigint")
    return [F.xxhash64(number, text_of(text)).alias("row"), F.xxhash64(F.lit(1), text_of(text), number).alias("check")]


def distinct_sets(sets_: DataFrame) -> DataFrame:
    """One row per set: ``id``, its name, ``copies``, the least doc_id, ``row`` and ``check`` of one document, ``tokens``; stored."""
    some = sets_.where("n > 0").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_doc"), F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), "row", "check")).alias("one"), F.first("tokens").alias("tokens"))
    return stored(some.select(F.monotonically_increasing_id().alias("id"), "k1", "k2", "copies", "least_doc", "one.row", "one.check", "tokens"), "distinct-sets")


def _walk(starts: np.ndarray | None) -> Callable:
    """The children of each row's node; of the roots ``starts`` if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column(0).to_numpy(), _matrix(batch.column(1), np.uint32, TOKENS)
            if starts is None:
                paths, parents = batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy()
                rows, paths = children(paths, own)
                parents = parents[rows]
            else:
                found = [children(np.full(len(ids), s, np.uint64), own) for s in starts]
                rows, paths = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                parents = np.zeros(len(rows), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(paths.view(np.int64)), pa.array(parents)], ["id", "path", "parent"])

    return run


def buckets(distinct: DataFrame, recall: float = RECALL) -> DataFrame:
    """``id``, ``path``, ``size`` of the buckets of two sets or more where paths end, over all runs."""
    starts = mix(np.arange(1, runs_for(recall) + 1, dtype=np.uint64) * ODD)
    schema, ended = "id bigint, path bigint, parent bigint", []
    walked = distinct.select("id", "tokens").mapInArrow(_walk(starts), schema)
    for level in range(1, DEPTH + 1):
        walked = stored(walked, "walked")
        sizes = walked.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = stored(walked.join(sizes, "path").select("id", "path", "size", "parent"), "sized")
        done = (F.col("size") <= SMALL) | (F.col("size") > ALIKE * F.col("parent")) & (F.col("parent") > 0) | F.lit(level == DEPTH)
        ended.append(sized.where(done).select("id", "path", "size"))
        deeper = sized.where(~done)
        if level == DEPTH or deeper.isEmpty():
            break
        joined = deeper.join(distinct.select("id", "tokens"), "id").select("id", "tokens", "path", F.col("size").alias("parent"))
        walked = joined.mapInArrow(_walk(None), schema)
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    return found


def in_blocks(rows: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """``rows`` with ``unit``, ``first``, ``second`` and ``own``: each pair of blocks of a key's rows is one unit of work.

    A key of up to ``block`` rows is one unit; a row of a larger one goes to as many units as there are blocks.
    """
    n = F.ceil(F.col(size) / block).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(7), "id"), n).cast("int")
    spread = rows.withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    first, second = F.least("own", "other"), F.greatest("own", "other")
    return spread.withColumns({"unit": F.xxhash64(key, first, second), "first": first, "second": second}).drop("other")


def whole_units(batches: Iterator[pa.RecordBatch], unit: int = 0) -> Iterator[pa.Table]:
    """The batches of a partition sorted by its ``unit`` column, cut so that no unit is torn."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(unit).to_numpy()
        start = int(np.searchsorted(keys, keys[-1]))  # the last unit may go on
        if held and held[-1].column(unit)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))


def roots(alike: np.ndarray) -> np.ndarray:
    """The least index of each row's component in a symmetric matrix."""
    n = len(alike)
    label = np.arange(n)
    near = alike | np.eye(n, dtype=bool)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)), np.int32)
    step = max(1, (1 << 22) // (max(len(b), 1) * TOKENS))
    for at in range(0, len(a), step):
        out[at:at + step] = (a[at:at + step, None, :] == b[None, :, :]).sum(axis=2)
    return out


def _join_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per unit, an edge from each set to the root of its sketch-alike component."""
    least = SKETCH * TOKENS
    for part in whole_units(batches):
        keys, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
        sketches = _matrix(part.column(2), np.uint8, TOKENS)
        starts, sizes = spans(keys)
        a, b = [], []
        two = starts[sizes == 2]
        two = two[(sketches[two] == sketches[two + 1]).sum(axis=1) >= least]
        a.append(ids[two])
        b.append(ids[two + 1])
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            own = slice(start, start + size)
            label = roots(_same(sketches[own], sketches[own]) >= least)
            moved = np.flatnonzero(label != np.arange(size))
            a.append(ids[own][moved])
            b.append(ids[own][label[moved]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def groups(distinct: DataFrame, recall: float = RECALL) -> DataFrame:
    """``node``, ``root``: sets that chosen paths and sketches bring together."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = (_matrix(batch.column(1), np.uint32, TOKENS) & 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in low], pa.binary())], ["id", "sketch"])

    sketches = distinct.select("id", "tokens").mapInArrow(sketch, "id bigint, sketch binary")
    rows = buckets(distinct, recall).join(sketches, "id")
    units = in_blocks(rows, "path", "size", BUCKET_BLOCK).select("unit", "id", "sketch")
    edges = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_join_alike, "a bigint, b bigint")
    return components(edges)


def jaccard_matrix(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact similarities of all pairs of two lists of sets, from products of the incidence of the shared shingles."""
    every = [*left, *right]
    sizes = np.array([len(s) for s in every], np.float64)
    rows = np.repeat(np.arange(len(every)), sizes.astype(np.int64))
    values, inverse, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    keep = times[inverse] > 1
    number = np.cumsum(times > 1) - 1
    rows, columns = rows[keep], number[inverse[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    n, total, step = len(left), int((times > 1).sum()), 4096
    common = np.zeros((n, len(right)), np.float64)
    for at in range(0, total, step):
        own = slice(*np.searchsorted(columns, [at, at + step]))
        incidence = np.zeros((len(every), min(step, total - at)), np.float32)
        incidence[rows[own], columns[own] - at] = 1
        common += incidence[:n] @ incidence[n:].T
    return common / (sizes[:n, None] + sizes[None, n:] - common)


def _compare(similarity: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for part in whole_units(batches):
            for start, size in zip(*spans(part.column(0).to_numpy())):
                unit = part.slice(start, size)
                ids, own = unit.column("id").to_numpy(), unit.column("own").to_numpy()
                copies, first, second = unit.column("copies").to_numpy(), unit.column("first")[0].as_py(), unit.column("second")[0].as_py()
                found = [shingles(t) for t in unit.column("text").to_pylist()]
                names = [set_key(f) for f in found]
                true = np.array([k == (a, b) for k, a, b in zip(names, unit.column("k1").to_pylist(), unit.column("k2").to_pylist())])
                left, right = (np.flatnonzero(true & (own == side)) for side in (first, second))
                if not len(left) or not len(right):
                    continue
                linked = jaccard_matrix([found[i] for i in left], [found[i] for i in right]) >= similarity
                if first == second:
                    np.fill_diagonal(linked, False)
                    both, alike, links = left, linked, linked @ copies[left]
                else:
                    both = np.concatenate([left, right])
                    alike = np.zeros((len(both), len(both)), bool)
                    alike[:len(left), len(left):] = linked
                    alike |= alike.T
                    links = np.concatenate([linked @ copies[right], linked.T @ copies[left]])
                label = roots(alike)
                some = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[both][some]), pa.array(links[some].astype(np.int64)), pa.array(ids[both][label[some]]),
                    pa.array(np.full(len(some), unit.column("blocks")[0].as_py() > 1)),
                ], ["id", "links", "root", "open"])

    return run


def one_of_equal(rows: DataFrame) -> DataFrame:
    """Equal rows become one where they are read, so that a row repeated a million times is shipped once by each task."""
    return rows.groupBy("row", "check").agg(F.first("text").alias("text"))


def links(frame: DataFrame, distinct: DataFrame, grouped: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Per set with links ``id``, ``links`` (documents of other sets at or above the similarity), and ``id``, ``root`` of its class; stored."""
    sizes = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    wanted = stored(grouped.join(sizes, "root").join(distinct.drop("tokens"), F.col("node") == F.col("id")).select("id", "root", "size", "row", "check", "k1", "k2", "copies"), "wanted")
    # Both sides are always dealt out by row: the wanted rows grow with the documents, so they are not to be broadcast at any size.
    texts = one_of_equal(frame).join(wanted.hint("shuffle_merge"), ["row", "check"]).withColumn("blocks", F.ceil(F.col("size") / GROUP_BLOCK).cast("int"))
    units = in_blocks(texts, "root", "size", GROUP_BLOCK).select("unit", "id", "own", "first", "second", "copies", "k1", "k2", "blocks", "text")
    compared = stored(units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_compare(similarity), "id bigint, links bigint, root bigint, open boolean"), "compared")
    counts = compared.groupBy("id").agg(F.sum("links").alias("links"))
    # A group of one block has its classes already; the others' blocks are joined.
    across = components(compared.where("open").select(F.col("id").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("id"), "root")
    classes = compared.where("not open").select("id", "root").unionByName(across)
    return counts, stored(classes, "classes")


def joined(frame: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """The documents' sets, and per set ``k1``, ``k2``, ``class_id``, ``row`` and ``check`` of the class's first document, ``n_links``."""
    rows = prepared(frame)
    sets_ = sets(frame)
    distinct = distinct_sets(sets_)
    counts, classes = links(rows, distinct, stored(groups(distinct, recall), "groups"), similarity)
    named = distinct.select("id", "k1", "k2", "copies", "least_doc", "row", "check").join(counts, "id", "left").join(classes, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = stored(named, "named")
    first = F.min(F.struct(F.coalesce("least_doc", F.lit((1 << 63) - 1)), "row", "check"))
    heads = named.groupBy("root").agg(F.min("least_doc").alias("class_id"), first.alias("first")).select("root", "class_id", "first.row", "first.check")
    per_set = named.drop("row", "check").join(heads, "root").select("k1", "k2", "class_id", "row", "check", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return sets_, stored(per_set, "per-set")


def report(frame: DataFrame) -> DataFrame:
    """Per document ``doc_id``, ``class_id``, ``n_links``: documents, its copies included, that it is linked to."""
    sets_, per_set = joined(frame.select("doc_id", "text"))
    rows = sets_.select("doc_id", "k1", "k2", "n").join(per_set, ["k1", "k2"], "left")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def filtered(frame: DataFrame) -> DataFrame:
    """One document of each class, the one of the least doc_id, with the columns of ``frame``; texts without words all stay.

    Of equal rows the first that is met stays. They become one where they are read, so that no task gets all of them.
    """
    _, per_set = joined(frame.select("doc_id", "text"))
    keepers = per_set.select(F.col("row").alias("__row"), F.col("check").alias("__check")).distinct()
    row, check = row_hashes()
    worded = text_of().rlike(r"[^\x20\x09-\x0D]")
    whole = F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("__whole")
    once = frame.where(worded).select(row.alias("__row"), check.alias("__check"), whole).groupBy("__row", "__check").agg(F.first("__whole").alias("__whole"))
    kept = once.join(keepers.hint("shuffle_merge"), ["__row", "__check"], "left_semi").select("__whole.*")
    return kept.unionByName(frame.where(~worded))


REPORT_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM worded),
named AS (SELECT md5(array_to_string(list_sort(s), '|')) AS k, doc_id, s FROM sets WHERE len(s) > 0),
uniq AS (SELECT k, min(doc_id) AS rep, count(*) AS copies, any_value(s) AS s FROM named GROUP BY k),
flat AS (SELECT k, len(s) AS n, unnest(s) AS t FROM uniq),
pairs AS (
  SELECT a.k AS x, b.k AS y FROM flat a JOIN flat b ON a.t = b.t AND a.k <> b.k AND b.n >= 0.8 * a.n AND a.n >= 0.8 * b.n
  GROUP BY a.k, b.k, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
reach AS (SELECT k AS x, k AS y FROM uniq UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
class AS (SELECT r.x AS k, min(u.rep) AS class_id FROM reach r JOIN uniq u ON u.k = r.y GROUP BY r.x),
links AS (SELECT p.x AS k, sum(u.copies) AS links FROM pairs p JOIN uniq u ON u.k = p.y GROUP BY p.x)
SELECT s.doc_id, coalesce(c.class_id, s.doc_id) AS class_id, (coalesce(l.links, 0) + coalesce(u.copies, 1) - 1)::BIGINT AS n_links
FROM sets s LEFT JOIN named n ON n.doc_id = s.doc_id LEFT JOIN uniq u ON u.k = n.k LEFT JOIN class c ON c.k = n.k LEFT JOIN links l ON l.k = n.k
"""
