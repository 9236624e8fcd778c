"""Exact top-k by inner product with KD-trees per shard.

A bounded sample of the vectors is cut by median splits into spaces, and every row is dealt to its space; a space of more rows than a shard
takes is dealt on by row, so equal vectors and repeated ids are split as well. Each shard grows one tree by median splits on the widest side,
with the tight box of every node, and is stored with it. No vector in a box scores above sum(max(q * low, q * high)). A query is
searched in its home shard first; its kth score then goes with it to those shards whose root box reaches that score. Within a tree nodes are
opened best first, until the highest bound of the open nodes is below the kth score; the queries of a block do so in step, each on its own front.
Queries and shards, and queries and root boxes, meet in blocks.

Cases: vectors that are null or hold null, NaN or infinite components take no part, as query or candidate; only vectors of one
length meet; a query's own row, and any row of its id, is no candidate; ties go to the smaller id; with fewer than k candidates all are
returned; repeated rows count each, and query rows of one id share one list; an empty table gives an empty result. Only the id and vector
columns are read. Components are integers; scores are exact as long as they fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import prepare, stored

LEAF = 128
NONE = -(1 << 62)
#: Rows that the spaces are cut from, and how many of them a space has at least.
SAMPLE, SPACE_SAMPLE = 16_384, 16
#: Most components (rows x length) and root boxes that meet a block of queries.
COMPONENTS, BOXES = 1 << 19, 2048


class Tree(NamedTuple):
    """Nodes in order of their making: rows ``order[start:end]``, the first child (the other follows; -1 for a leaf), tight boxes, and the
    side and value of the split."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray
    side: np.ndarray
    cut: np.ndarray


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    order, spans, child, low, high, side, cut = np.arange(len(points)), [(0, len(points))], [], [], [], [], []
    for a, b in spans:  # grows as nodes are split
        own = points[order[a:b]]
        low.append(own.min(axis=0))
        high.append(own.max(axis=0))
        widest, value, first = 0, 0, -1
        if b - a > leaf and points.shape[1]:
            widest, half = int(np.argmax(high[-1] - low[-1])), (b - a) // 2
            parted = np.argpartition(own[:, widest], half)
            order[a:b] = order[a:b][parted]
            value, first = int(own[parted[half], widest]), len(spans)
            spans += [(a, a + half), (a + half, b)]
        side.append(widest)
        cut.append(value)
        child.append(first)
    start, end = np.array(spans).T
    return Tree(order, start, end, np.array(child), np.array(low), np.array(high), np.array(side), np.array(cut))


def space_of(points: np.ndarray, tree: Tree) -> np.ndarray:
    """The leaf of each point by the splits of a tree of other points."""
    at, every = np.zeros(len(points), np.int64), np.arange(len(points))
    while (inner := tree.child[at] >= 0).any():
        right = points[every, tree.side[at]] >= tree.cut[at]
        at = np.where(inner, tree.child[at] + right, at)
    return at


def exact_type(points: np.ndarray, queries: np.ndarray) -> type:
    """Doubles where all sums are exact in them, as their products are much faster."""
    largest = float(np.abs(points).max(initial=1)) * float(np.abs(queries).max(initial=1)) * max(points.shape[1], 1)
    return np.float64 if largest < 2.0**52 else np.int64


def reach(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Queries x boxes: no vector in the box scores above this."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search(tree: Tree, ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores and ids (queries x k) of the best rows of one shard, ``NONE`` where there are no more that can count, and the leaves each opened.

    ``bounds`` is a kth score that each query already has elsewhere. ``ids`` and ``points`` are in the tree's order.
    """
    kind = exact_type(points, queries)
    points, queries, low, high = (np.asarray(x, kind) for x in (points, queries, tree.low, tree.high))
    best, best_ids = np.full((len(queries), k), NONE, np.int64), np.full((len(queries), k), np.iinfo(np.int64).max)
    opened = np.zeros(len(queries), np.int64)
    front = np.full((len(queries), len(tree.child)), NONE, kind)
    front[:, 0] = reach(queries, low[:1], high[:1])[:, 0]
    active = np.arange(len(queries))
    while len(active):
        at = front[active].argmax(axis=1)
        value = front[active, at]
        open_ = (value > NONE) & (value >= np.maximum(bounds[active], best[active, k - 1]))
        active, at = active[open_], at[open_]
        front[active, at] = NONE
        for node in np.unique(at):
            who, child = active[at == node], tree.child[node]
            if child >= 0:
                front[who, child:child + 2] = reach(queries[who], low[child:child + 2], high[child:child + 2])
                continue
            rows = slice(tree.start[node], tree.end[node])
            scores = (queries[who] @ points[rows].T).astype(np.int64)
            scores[ids[rows][None, :] == query_ids[who][:, None]] = NONE
            all_scores = np.concatenate([best[who], scores], axis=1)
            all_ids = np.concatenate([best_ids[who], np.broadcast_to(ids[rows], scores.shape)], axis=1)
            first = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best[who], best_ids[who] = np.take_along_axis(all_scores, first, 1), np.take_along_axis(all_ids, first, 1)
            opened[who] += 1
    return best, best_ids, opened


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


UNIT = ("dim", "space", "part")
TREE = "dim int, space int, part int, low array<bigint>, high array<bigint>, ids binary, points binary, nodes binary, boxes binary"
FOUND = "query_id bigint, id bigint, score bigint"


def _grow(rows: pa.Table) -> pa.Table:
    """A shard as one row: its vectors in the tree's order, nodes, boxes and root box."""
    dim = rows.column("dim")[0].as_py()
    ids, points = rows.column("id").to_numpy(), _matrix(rows.column("vec"), dim)
    tree = build(points)
    nodes = np.stack([tree.start, tree.end, tree.child]).astype(np.int64)
    boxes = np.stack([tree.low, tree.high]).astype(np.int64)
    return pa.table({
        **{name: rows.column(name).combine_chunks()[:1] for name in UNIT}, "low": pa.array([tree.low[0]], pa.list_(pa.int64())), "high": pa.array([tree.high[0]], pa.list_(pa.int64())),
        "ids": [ids[tree.order].tobytes()], "points": [points[tree.order].astype(np.int64).tobytes()], "nodes": [nodes.tobytes()], "boxes": [boxes.tobytes()]})


def _meet(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("query_id", "id", "score")})
        shard, dim = left.slice(0, 1).to_pylist()[0], left.column("dim")[0].as_py()
        read = lambda name, *shape: np.frombuffer(shard[name], np.int64).reshape(*shape)
        ids, (start, end, child) = read("ids", -1), read("nodes", 3, -1)
        low, high = read("boxes", 2, len(start), dim)
        tree = Tree(np.arange(len(ids)), start, end, child, low, high, child, child)
        query_ids = right.column("query_id").to_numpy()
        best, found, _ = search(tree, ids, read("points", len(ids), dim), query_ids, _matrix(right.column("asked"), dim), right.column("kth").to_numpy(), k)
        keep = best > NONE
        return pa.table({"query_id": np.repeat(query_ids, keep.sum(axis=1)), "id": found[keep], "score": best[keep]})

    return run


def _near(left: pa.Table, right: pa.Table) -> pa.Table:
    """The queries of a block, once for each shard but their own whose root box reaches their kth score."""
    empty = pa.table({"space": pa.array([], pa.int32()), "part": pa.array([], pa.int32())})
    asked = right.select(["q", "query_id", "asked", "dim", "kth"])
    if not left.num_rows or not right.num_rows:
        return pa.table({**{n: asked.column(n).slice(0, 0) for n in asked.column_names}, **{n: empty.column(n) for n in ("space", "part")}})
    dim = left.column("dim")[0].as_py()
    low, high, queries = _matrix(left.column("low"), dim), _matrix(left.column("high"), dim), _matrix(right.column("asked"), dim)
    kind = exact_type(np.concatenate([low, high]), queries)
    near = reach(np.asarray(queries, kind), np.asarray(low, kind), np.asarray(high, kind)) >= right.column("kth").to_numpy()[:, None]
    space, part = (left.column(n).to_numpy() for n in ("space", "part"))
    near &= (space != right.column("space").to_numpy()[:, None]) | (part != right.column("part").to_numpy()[:, None])
    who, shard = np.nonzero(near)
    taken = asked.take(pa.array(who))
    return pa.table({**{n: taken.column(n) for n in taken.column_names}, "space": pa.array(space[shard], pa.int32()), "part": pa.array(part[shard], pa.int32())})


def _dealt(rows: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """``rows`` with ``space``; vectors of a length that the sample lacks share space 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            spaces = np.zeros(len(dims), np.int32)
            for dim in set(dims.tolist()) & set(trees):
                own = np.flatnonzero(dims == dim)
                spaces[own] = space_of(_matrix(batch.column(batch.schema.get_field_index("vec")).take(pa.array(own)), dim), trees[dim])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spaces)], [*batch.schema.names, "space"])

    return rows.mapInArrow(run, "id bigint, vec array<bigint>, dim int, space int")


def spaces(rows: DataFrame, total: int, shard_rows: int) -> dict[int, Tree]:
    """Per vector length, the tree that cuts a hash sample of about ``SAMPLE`` rows into spaces of about ``shard_rows`` of all rows."""
    drawn = F.pmod(F.xxhash64(F.lit(3), "id", "vec"), F.lit(max(total, 1))) < SAMPLE
    sample: dict[int, list] = {}
    for (vec,) in rows.where(drawn & F.expr("size(vec) > 0")).select("vec").toLocalIterator():
        sample.setdefault(len(vec), []).append(vec)
    leaf = max(SPACE_SAMPLE, -(-shard_rows * min(SAMPLE, total) // max(total, 1)))
    return {dim: build(np.array(vecs, np.int64), leaf) for dim, vecs in sample.items()}


def shards(candidates: DataFrame, trees: dict[int, Tree], shard_rows: int) -> DataFrame:
    """One row per shard, with its tree; stored."""
    dealt = stored(_dealt(candidates.select("id", "vec", F.size("vec").alias("dim")), trees).withColumn("row", F.monotonically_increasing_id()), "dealt")
    room = F.least(F.lit(shard_rows), F.greatest(F.lit(LEAF), F.floor(F.lit(COMPONENTS) / F.greatest("dim", F.lit(1)))))
    sizes = dealt.groupBy("dim", "space").agg(F.ceil(F.count(F.lit(1)) / room).cast("int").alias("parts"))
    placed = dealt.join(sizes, ["dim", "space"]).withColumn("part", F.pmod(F.xxhash64(F.lit(1), "row"), F.col("parts")).cast("int"))
    return stored(placed.select(*UNIT, "id", "vec").groupBy(*UNIT).applyInArrow(_grow, TREE), "shards")


def searched(shards_: DataFrame, asked: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The best of each query in the shard it is sent to; shards and the blocks of their queries are single tasks' work."""
    blocks = asked.groupBy(*UNIT).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    left = shards_.drop("low", "high").join(blocks, [*UNIT]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = asked.join(blocks, [*UNIT]).withColumn("block", F.pmod(F.xxhash64(F.lit(2), "q"), F.col("blocks")).cast("int")).drop("blocks")
    return left.groupBy(*UNIT, "block").cogroup(right.groupBy(*UNIT, "block")).applyInArrow(_meet(k), FOUND)


def top_k(candidates: DataFrame, queries: DataFrame, k: int, shard_rows: int = 8192, block_rows: int = 4096) -> DataFrame:
    """``query_id``, ``rank``, ``id``, ``score``; both inputs have ``id`` (long) and ``vec`` (array of long, without nulls)."""
    prepare(candidates.sparkSession)
    trees = spaces(candidates, candidates.count(), shard_rows)
    all_shards = shards(candidates, trees, shard_rows)
    parts = all_shards.groupBy("dim", "space").agg(F.count(F.lit(1)).alias("parts"))
    asked = _dealt(queries.select("id", "vec", F.size("vec").alias("dim")), trees).withColumn("q", F.monotonically_increasing_id())
    home = F.pmod(F.xxhash64(F.lit(1), "q"), F.coalesce("parts", F.lit(1))).cast("int")
    asked = stored(asked.join(parts, ["dim", "space"], "left").select("q", F.col("id").alias("query_id"), F.col("vec").alias("asked"), *UNIT[:2], home.alias("part")), "asked")

    at_home = stored(searched(all_shards, asked.withColumn("kth", F.lit(NONE).cast("long")), k, block_rows), "at-home")
    kth = at_home.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(NONE).alias("kth"))
    away = asked.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(NONE).cast("long")))
    n_boxes, n_blocks = max(1, -(-all_shards.count() // BOXES)), max(1, -(-asked.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    boxes = all_shards.select(*UNIT, "low", "high", F.pmod(F.xxhash64(F.lit(4), *UNIT), F.lit(n_boxes)).cast("int").alias("boxes")).withColumn("block", every(n_blocks))
    blocks = away.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "q"), F.lit(n_blocks)).cast("int")).withColumn("boxes", every(n_boxes))
    keys = ("dim", "boxes", "block")
    near = stored(boxes.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(
        _near, "q bigint, query_id bigint, asked array<bigint>, dim int, kth bigint, space int, part int"), "near")
    found = searched(all_shards, near, k, block_rows).unionByName(at_home)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def quantised(frame: DataFrame, id_: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``id`` and ``vec`` = floor(scale * component), of the rows whose vectors are whole and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return frame.where(F.col(id_).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id_).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vec"),
    )


def every_nth(frame: DataFrame, n: int = 50, k: int = 5) -> DataFrame:
    """Top k for the rows whose id is divisible by ``n``, against all others."""
    rows = stored(quantised(frame), "quantised")
    return top_k(rows, rows.where(F.col("id") % n == 0), k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


EVERY_NTH_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.vec) = len(c.vec)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
