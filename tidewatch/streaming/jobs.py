"""Structured Streaming jobs: the batch operators inside micro-batches.

Each job is at-least-once; keyed upserts and whole-window rewrites make it idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.operators.behaviors import affected_sessions, build_behaviors, preserve_ml_state
from tidewatch.operators.rules import US, Rule
from tidewatch.operators.sessions import build_sessions
from tidewatch.settings import ASSET_15M, DEFAULTS, FeatureSpec, Settings
from tidewatch.sources.tables import SessionTable

c = F.col


def start(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None,
          mode: str = "append") -> StreamingQuery:
    """Run ``on_batch`` per micro-batch: on a timer, or once over everything available."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def new_events(raw: DataFrame, overlap_seconds: int = DEFAULTS.session_overlap_seconds, time: str = "ingest_ts") -> DataFrame:
    """Drop events already seen within the overlap; state is bounded by the watermark."""
    return raw.withWatermark(time, f"{overlap_seconds} seconds").dropDuplicatesWithinWatermark(["raw_id"])


def upsert_sessions(table: SessionTable, settings: Settings = DEFAULTS) -> Callable[[DataFrame, int], None]:
    """Build sessions from the batch's events and merge them into the session table."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table.upsert(build_sessions(batch, settings))
    return on_batch


def rebuild_windows(sessions: Callable[[], DataFrame], stored: Callable[[], DataFrame | None], write: Callable[[DataFrame], None],
                    spec: FeatureSpec = ASSET_15M, settings: Settings = DEFAULTS) -> Callable[[DataFrame, int], None]:
    """Recompute every window a changed session falls into, keeping scores of unchanged vectors."""
    def on_batch(changed: DataFrame, batch_id: int) -> None:
        rows = build_behaviors(affected_sessions(sessions(), changed, spec, settings.entity_mode), spec, settings)
        old = stored()
        write(rows if old is None else preserve_ml_state(rows, old))
    return on_batch


def sliding_counts(events: DataFrame, rule: Rule, slide: str = "30 seconds", delay: str | None = None) -> DataFrame:
    """Hop-window form of a rule for streams: approximate distinct values, or exact event counts."""
    rows = events.withWatermark("ts", delay) if delay else events
    hits = F.approx_count_distinct(rule.value) if rule.value else F.count("*")
    counted = rows.groupBy(F.window("ts", f"{rule.span_seconds} seconds", slide).alias("w"), *rule.key).agg(hits.alias("hits"))
    met = c("hits") > rule.threshold if rule.value else c("hits") >= rule.threshold
    return counted.where(met).select(*rule.key, c("w.start").alias("window_start"), c("w.end").alias("ts"), "hits")


def suppress_stream(matches: DataFrame, key: Sequence[str], realert_seconds: int, schema: str) -> DataFrame:
    """Realert suppression on a stream: per key only the time of the last kept match is state.

    There is no timeout (a processing-time one would keep run-once jobs alive): one number per
    key that ever alerted stays in the state store.
    ``matches`` has the key columns and ``us``; ``schema`` describes exactly those columns.
    """
    wait = realert_seconds * US

    def keep(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        for pdf in [pd.concat(list(batches)).sort_values("us")]:
            chosen = []
            for i, us in enumerate(pdf["us"].tolist()):
                if last is None or us - last >= wait:
                    chosen.append(i)
                    last = us
            yield pdf.iloc[chosen]
        state.update((last,))

    return matches.groupBy(*key).applyInPandasWithState(keep, schema, "last bigint", "append", GroupStateTimeout.NoTimeout)


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Documents read and lag per finished micro-batch, for the job-state table."""
    return [{"batch": p["batchId"], "documents_read": p["numInputRows"], "seconds": p["batchDuration"] / 1000.0} for p in query.recentProgress]


def malformed_counts(parsed: DataFrame) -> DataFrame:
    """Rows that were set aside instead of failing the batch."""
    return parsed.groupBy("parse_error").agg(F.count("*").alias("rows"))
