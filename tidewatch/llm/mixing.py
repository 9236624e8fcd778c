"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, and each document is taken floor(rate) times plus once more
where a hash of it falls below the fraction (a Bernoulli copy, seeded per source). All of it is DataFrame operations; no document's text is shuffled.

Cases: a null text has no words, a null source is a source of its own and the last, a source without words takes nothing,
repeated rows (same doc_id, source and text) draw alike, an empty table gives an empty one. Extra columns stay; columns that this
module adds are dropped again or start with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import WORD, before_parts, in_order, stored, text_of

#: Bits of a draw, and how many seeds are tried per source. All tries are independent hashes of a document; the one that brings a
#: source's words closest to its target is its seed, so that small sources come near it too.
DRAW_BITS, SEEDS = 52, 32


def words(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def hashes(*columns: str) -> dict[str, Column]:
    """``__a`` and ``__b``: two 52-bit numbers from a hash of the columns."""
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).cast("binary"))
    number = lambda at: F.conv(F.substring(key, at, DRAW_BITS // 4), 16, 10).cast("long")
    return {"__a": number(1), "__b": number(1 + DRAW_BITS // 4)}


def takes(seed: Column) -> Column:
    """How often a document with ``__a``, ``__b`` and its source's ``rate`` is taken."""
    drawn = (F.col("__a") + seed * F.col("__b")).bitwiseAND((1 << DRAW_BITS) - 1).cast("double") / float(1 << DRAW_BITS)
    whole = F.floor("rate")
    return (whole + F.when(drawn < F.col("rate") - whole, 1).otherwise(0)).cast("int")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """``sources`` with ``weight`` 1, 2 .. ``cycle``, repeating in code-point order of ``source``, null last."""
    ordered = in_order(sources, F.col("source").asc_nulls_last())
    base = before_parts(ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("rows")), "__part", "rows")
    placed = ordered.join(base, "__part").withColumn("weight", 1 + F.pmod(F.col("__before_rows") + F.col("__place"), F.lit(cycle)))
    return placed.select(*sources.columns, "weight")


def targets(sources: DataFrame, cap: int = 3, volume: float = 1.0) -> DataFrame:
    """``sources`` (``source``, ``source_size``, ``weight``) with ``target``: ``volume`` of all sizes shared by weight.

    A target stops at ``cap`` times its source's size; the excess goes to the others by weight, until none is above.
    Each round is one aggregate of two sums; in every round but the last another source stops, so they end.
    """
    sources = stored(sources, "sources")
    limit, total = F.col("source_size") * F.lit(cap), sources.agg(F.sum("source_size")).first()[0] or 0
    total, level, known = total * volume if volume != 1.0 else total, 0.0, None
    while True:
        stopped = limit <= F.col("weight") * F.lit(level)
        sums = sources.agg(F.sum(F.when(stopped, limit).otherwise(0)), F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        if tuple(sums) == known or not sums[1]:
            break
        known, level = tuple(sums), (total - sums[0]) / sums[1]
    shared = F.col("weight") * F.lit(float(level))
    every = limit.cast("double")
    return sources.withColumn("target", every if not sums[1] else F.least(every, shared))


def measured(frame: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` and the hashes of every document, stored."""
    sizes = frame.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"), *[c.alias(n) for n, c in hashes(doc_id, source, text).items()])
    return stored(sizes, "measured")


def with_rates(frame: DataFrame, rates_: DataFrame, source: str = "source") -> DataFrame:
    """``frame`` with its source's row of ``rates_``.

    That table was stored, so the planner knows its size and broadcasts it when it is below the broadcast threshold;
    else rows are sorted by source and adaptive execution splits a hot one.
    """
    right = rates_.withColumnRenamed("source", "__source")
    return frame.join(right, F.col(f"`{source}`").eqNullSafe(F.col("__source"))).drop("__source")


def rates(measured_: DataFrame, cap: int = 3, cycle: int = 3) -> DataFrame:
    """Per source ``source``, ``source_size``, ``weight``, ``target``, ``rate`` and ``seed``, stored."""
    sizes = stored(measured_.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    found = stored(targets(cyclic_weights(sizes, cycle), cap).withColumn("rate", rate), "rates")
    tries = [F.sum(F.col("size") * takes(F.lit(s))).alias(f"__{s}") for s in range(SEEDS)]
    taken = with_rates(measured_, found.select("source", "rate")).groupBy("source").agg(*tries).withColumnRenamed("source", "__source")
    off = F.array(*[F.abs(F.col("target") - F.col(f"__{s}")) for s in range(SEEDS)])
    seeded = found.join(taken, F.col("source").eqNullSafe(F.col("__source"))).withColumn("seed", (F.array_position(off, F.array_min(off)) - 1).cast("int"))
    return stored(seeded.select(*found.columns, "seed"), "seeded")


def mix(frame: DataFrame, cap: int = 3, cycle: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix: the columns of ``frame``, each row as often as it is taken."""
    inner = [F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(frame.columns)]  # no clash with the columns added here
    rows = frame.select(*inner, F.col(source).alias("__of"), *[c.alias(n) for n, c in hashes(doc_id, source, text).items()])
    taken = with_rates(rows, rates(measured(frame, doc_id, text, source), cap, cycle).select("source", "rate", "seed"), "__of")
    copies = taken.withColumn("__copies", takes(F.col("seed"))).where("__copies > 0").withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
    return copies.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(frame.columns)])


def plan(frame: DataFrame, cap: int = 3, cycle: int = 3) -> DataFrame:
    """Per document ``doc_id``, ``size``, ``source_size``, ``target`` of its source, and ``taken``: the words that the mix takes of it."""
    rows = measured(frame)
    joined = with_rates(rows, rates(rows, cap, cycle).select("source", "source_size", "target", "rate", "seed"))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * takes(F.col("seed"))).alias("taken"))


PLAN_SQL = r"""
WITH keyed AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), coalesce(text, ''))) AS k
  FROM documents),
measured AS (SELECT doc_id, source, size, ('0x' || substr(k, 1, 13))::BIGINT AS a, ('0x' || substr(k, 14, 13))::BIGINT AS b FROM keyed),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM measured GROUP BY source),
levels AS (
  SELECT 3.0 * b.source_size / b.weight AS ratio,
         ((SELECT sum(size)::BIGINT FROM measured) - sum(CASE WHEN 3.0 * a.source_size / a.weight < 3.0 * b.source_size / b.weight THEN 3 * a.source_size ELSE 0 END)::BIGINT)::DOUBLE
         / sum(CASE WHEN 3.0 * a.source_size / a.weight < 3.0 * b.source_size / b.weight THEN 0 ELSE a.weight END)::DOUBLE AS level
  FROM sources a, sources b GROUP BY b.source, b.source_size, b.weight),
found AS (
  SELECT s.*, least(3.0 * source_size, weight * coalesce((SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio), 1e300))::DOUBLE AS target FROM sources s),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM found),
tries AS (
  SELECT m.doc_id, m.size, r.source, r.source_size, r.target, s.seed,
         (size * (floor(rate) + CASE WHEN ((a + s.seed * b) & 4503599627370495)::DOUBLE / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
  FROM measured m JOIN rated r ON m.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range(32)) AS seed) s),
best AS (
  SELECT source, arg_min(seed, (off, seed)) AS seed FROM (
    SELECT source, seed, abs(any_value(target) - sum(taken)::BIGINT) AS off FROM tries GROUP BY source, seed) GROUP BY source)
SELECT doc_id, size, source_size, target, taken FROM tries t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.seed = b.seed
"""
