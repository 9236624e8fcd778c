"""Late data: merge rebuilt session rows into stored ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.operators.sessions import SharedEvents, flag_columns, summed_events
from tidewatch.settings import DEFAULTS, Settings


def merge_values(kind: T.DataType, old: Column, new: Column) -> Column:
    """Newer non-empty scalar wins, structs recurse, arrays become an ordered union."""
    if isinstance(kind, T.StructType):
        fields = [merge_values(f.dataType, old[f.name], new[f.name]).alias(f.name) for f in kind.fields]
        return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.when(F.coalesce(F.size(old), F.lit(0)) <= 0, F.when(F.size(new) > 0, new).otherwise(old)).when(
            F.coalesce(F.size(new), F.lit(0)) <= 0, old).otherwise(F.array_union(old, new))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.when(new != "", new), old)
    return F.coalesce(new, old)


def first_per_id(items: Column, key: str, limit: int | None) -> Column:
    """Keep the first element per id (blank ids are all kept), at most ``limit`` if there is one."""
    ids = F.transform(items, lambda x: x[key])
    kept = F.filter(items, lambda x, i: F.coalesce(x[key], F.lit("")).eqNullSafe("") | (F.array_position(ids, x[key]) == i + 1))
    return kept if limit is None else F.slice(kept, 1, limit)


def count_kept_events(zeek: Column) -> Column:
    return F.coalesce(F.aggregate(F.map_values(zeek), F.lit(0), lambda acc, e: acc + F.size(e)), F.lit(0))


def merge_sessions(stored: DataFrame, built: DataFrame, settings: Settings = DEFAULTS, events: DataFrame | SharedEvents | None = None) -> DataFrame:
    """Full outer join on the session id; rows on both sides are merged, others pass through.

    ``merge_state`` is created, updated or kept.  Rows without an id are dropped.
    ``events`` are the kept events of both sides as a long table (``sessions.kept_event_rows``) or with certificates once (``sessions.shared_events``).  Then the sides carry ``key`` and
    no arrays of events, are joined on the key, and the events of updated rows are counted in the table.
    """
    by = "session_id" if events is None else "key"
    names = [n for n in built.columns if n != by]
    old = stored.select(by, F.lit(True).alias("_old"), *[F.col(n).alias(f"o_{n}") for n in names])
    new = built.where("session_id is not null").select(by, F.lit(True).alias("_new"), *[F.col(n).alias(f"n_{n}") for n in names])
    pair = old.join(new, by, "full_outer")
    both = F.col("_old") & F.col("_new")
    types = {f.name: f.dataType for f in built.schema.fields}

    def joined(n: str) -> Column:
        return F.flatten(F.filter(F.array(F.col(f"o_{n}"), F.col(f"n_{n}")), lambda x: x.isNotNull()))

    cols: dict[str, Column] = {}
    for n in names:
        o, w = F.col(f"o_{n}"), F.col(f"n_{n}")
        if n == "zeek":
            value = F.map_zip_with(
                F.coalesce(o, w), F.coalesce(w, o),
                lambda k, a, b: first_per_id(F.flatten(F.filter(F.array(a, b), lambda x: x.isNotNull())), "raw_id",
                                             settings.max_events_per_log_type))
        elif n == "evidence":
            value = first_per_id(joined(n), "id", settings.max_evidence_items)
        elif n in ("session_id", "ts", "conn_local_orig", "conn_local_resp"):
            value = F.coalesce(o, w)
        elif n == "fragment":
            value = F.coalesce(o | w, o, w)
        elif n in ("event_count", "evidence_count", "normalized_event_count"):  # of batches without common events; arrays are counted anew
            value = F.when(both, F.coalesce(o, F.lit(0)) + F.coalesce(w, F.lit(0))).otherwise(F.coalesce(o, w))
        elif n == "log_types":
            value = F.array_sort(F.array_distinct(joined(n)))
        elif n == "first_seen":
            value = F.least(o, w)
        elif n == "last_seen":
            value = F.greatest(o, w)
        else:
            value = merge_values(types[n], o, w)
        cols[n] = value
    state = F.when(both, "updated").when(F.col("_new"), "created").otherwise("kept")
    merged = pair.select(by, state.alias("merge_state"), *[v.alias(k) for k, v in cols.items()])
    kept = count_kept_events(F.col("zeek"))
    recount = F.when(kept > 0, kept).otherwise(F.size("evidence")).cast("bigint")
    if events is not None:
        if isinstance(events, SharedEvents):
            counted = summed_events(events).select("key", F.col("n").alias("_n"))
        else:
            counted = events.select("key", "log_type", "raw_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
        merged, recount = merged.join(counted, "key", "left"), F.col("_n")
    updated = (F.col("merge_state") == "updated") & (recount >= 0)
    merged = merged.withColumns(
        {"event_count": F.when(updated, recount).otherwise(F.col("event_count"))} | flag_columns(F.col("log_types")))
    return merged.select(*built.columns, "merge_state")
