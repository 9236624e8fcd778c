"""Incremental jobs over keyed tables: sessions merged as logs arrive, behaviour windows rebuilt, late rows set aside, progress kept.

Each job is a function of (micro-batch, batch id) for ``foreachBatch``. What a batch changes is written as that batch's delta or folder,
and what it reads of earlier state is the state before that batch, so a batch that runs again after a failure leaves the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidewatch.operators.behaviors import KEY, build_behaviors, preserve_ml_state, with_behavior_key
from tidewatch.operators.merge import merge_sessions
from tidewatch.operators.sessions import SharedEvents, build_sessions, certificate_table, shared_events
from tidewatch.session import discard, stored
from tidewatch.settings import ASSET_15M, DEFAULTS, FeatureSpec, Settings
from tidewatch.sources.keyed import KeyedTable
from tidewatch.sources.tables import write_counts

c = F.col
OnBatch = Callable[[DataFrame, int], None]


class SessionStore:
    """Sessions by key, and the events behind them as a long table, both upserted per batch.

    A batch meets only the stored rows of its own keys: the index of the tables leads to the files that hold them. Events are never
    gathered, so a session of any size is many rows. Certificates are kept once, beside which session shows which (``SharedEvents``).
    ``certificates`` are the certificate rows all batches may refer to; without them a batch refers to those that come with it.
    """

    def __init__(self, spark: SparkSession, path: str, certificates: DataFrame | None = None, settings: Settings = DEFAULTS,
                 sections: Sequence[str] | None = None, buckets: int = 16, updated_at: Column | None = None):
        self.sessions = KeyedTable(spark, f"{path}/sessions", ["key"], buckets=buckets)
        self.events = KeyedTable(spark, f"{path}/events", ["key"], ["key", "log_type", "raw_id"], buckets=buckets)
        self.shown = KeyedTable(spark, f"{path}/shown", ["key"], ["key", "token"], buckets=buckets)
        self.shared = KeyedTable(spark, f"{path}/certificates", ["token"], ["token", "raw_id"], buckets=buckets)
        self.certificates, self.settings, self.sections, self.updated_at = certificates, settings, sections, updated_at
        self.counts: dict[int, dict[str, int]] = {}
        self._known: tuple[DataFrame, DataFrame] | None = None

    def _certificates(self) -> tuple[DataFrame, DataFrame] | None:
        """Summaries and events of the certificates that all batches know, put together once."""
        if self.certificates is not None and self._known is None:
            names = self.sections is None or "x509" in self.sections
            self._known = (stored(certificate_table(self.certificates, self.settings, False, names), "certificates"),
                           stored(shared_events(self.certificates, self.settings).certificates, "certificate-events"))
        return self._known

    def merged(self, batch: DataFrame, batch_id: int, scratch: str = "batch") -> tuple[DataFrame, SharedEvents]:
        """The batch's sessions merged with what was stored before it (with ``merge_state``), and the batch's events; their tables lie in ``scratch``."""
        known = self._certificates()
        raw = batch if known is None else batch.where("log_type <> 'x509'")
        build = build_sessions(raw, self.settings, sections=self.sections, parts=("certificates",), certificates=known and known[0],
                               updated_at=self.updated_at, with_key=True)
        built = stored(build, f"{scratch}/built")
        events = shared_events(raw, self.settings)
        if known is None:
            events = SharedEvents(*(stored(t, f"{scratch}/events") for t in events.tagged(str(batch_id))))
        else:
            events = SharedEvents(stored(events.own, f"{scratch}/events"), stored(events.shown, f"{scratch}/shown"), known[1])
        keys = built.select("key")
        old = self.sessions.lookup(keys, batch_id)
        old = built.limit(0) if old is None else old.select(*built.columns)

        def both(new: DataFrame, table: KeyedTable, asked: DataFrame) -> DataFrame:
            """Without the events themselves, as merging counts them."""
            new = new.drop("event")
            before = table.lookup(asked, batch_id, new.columns)
            return new if before is None else new.unionByName(before.select(*new.columns))

        own, shown = both(events.own, self.events, keys), both(events.shown, self.shown, keys)
        certificates = both(events.certificates, self.shared, shown.select("token")) if known is None else events.certificates
        return stored(merge_sessions(old, built, self.settings, events=SharedEvents(own, shown, certificates)), f"{scratch}/merged"), events

    def upsert(self, batch: DataFrame, batch_id: int, dry_run: bool = False) -> dict[str, int]:
        """Counts of created and updated sessions; a dry run writes nothing."""
        scratch = f"batch-{uuid.uuid4().hex}"
        rows, events = self.merged(batch, batch_id, scratch)
        counts = write_counts(rows).first().asDict()
        if not dry_run:
            self.events.write(events.own, batch_id)
            self.shown.write(events.shown, batch_id)
            if self.certificates is None:
                self.shared.write(events.certificates, batch_id)
            self.sessions.write(rows.drop("merge_state"), batch_id)
            self.counts[batch_id] = counts
        discard(batch.sparkSession, scratch)
        return counts


class WindowStore:
    """Sessions by behaviour window, and the behaviours of those windows.

    ``identity`` tells a session from others. A session whose window changes leaves a mark in the old one, so both are rebuilt.
    """

    def __init__(self, spark: SparkSession, path: str, identity: Sequence[str] = ("session_id",), spec: FeatureSpec = ASSET_15M,
                 settings: Settings = DEFAULTS, buckets: int = 16, updated_at: Column | None = None):
        self.identity, self.spec, self.settings, self.updated_at = list(identity), spec, settings, updated_at
        self.placed = KeyedTable(spark, f"{path}/placed", self.identity, buckets=buckets)
        self.members = KeyedTable(spark, f"{path}/members", KEY, [*KEY, *self.identity], buckets=buckets)
        self.behaviors = KeyedTable(spark, f"{path}/behaviors", KEY, buckets=buckets)

    def rebuild(self, changed: DataFrame, batch_id: int) -> None:
        """Every window that the changed sessions are in, or were in before, is read whole and written anew."""
        rows = stored(changed.transform(with_behavior_key, self.spec, self.settings.entity_mode).drop("entity_kind"), "changed")
        now = rows.select(*self.identity, *KEY)
        before = self.placed.lookup(now.select(*self.identity), batch_id)
        moved = None
        if before is not None:
            moved = stored(before.join(now, [*self.identity, *KEY], "left_anti").select(*self.identity, *KEY), "moved")
        self.members.write(rows, batch_id, gone=moved)
        self.placed.write(now, batch_id)
        windows = now.select(*KEY) if moved is None else now.select(*KEY).unionByName(moved.select(*KEY))
        windows = stored(windows.distinct(), "windows")
        whole = self.members.lookup(windows).drop(*KEY)
        built = build_behaviors(whole, self.spec, self.settings, self.updated_at)
        old = self.behaviors.lookup(windows, batch_id)
        built = built if old is None else preserve_ml_state(built, old.select(*built.columns))
        built = stored(built.withColumn("sensor_key", F.coalesce("sensor", F.lit(""))), "rebuilt")
        self.behaviors.write(built, batch_id, gone=windows.join(built.select(*KEY), KEY, "left_anti"))


class Progress:
    """One row per batch: what it read, kept and set aside, its newest event and the watermark it ran under.

    The counts are observed while the batch is written, not in a job of their own. Where the next batch starts follows from these rows.
    """

    SCHEMA = "batch bigint, documents_read bigint, rows_written bigint, rows_late bigint, newest timestamp, watermark timestamp, finished timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/*")

    def newest_before(self, batch_id: int):
        return self.read().where(c("batch") < batch_id).agg(F.max("newest").alias("t")).first().t

    def record(self, batch_id: int, seen: dict, watermark) -> None:
        row = self.spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch"), F.lit(seen["n"]).cast("bigint").alias("documents_read"),
            F.lit(seen["n"] - seen["late"]).cast("bigint").alias("rows_written"), F.lit(seen["late"]).cast("bigint").alias("rows_late"),
            F.timestamp_micros(F.lit(seen["us"]).cast("bigint")).alias("newest"), F.lit(watermark).cast("timestamp").alias("watermark"),
            F.current_timestamp().alias("finished"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/of-{batch_id}")

    def lag(self, as_of: Column) -> DataFrame:
        """Per batch how far its newest event lay behind ``as_of``, in seconds."""
        return self.read().select("batch", "documents_read", "rows_written", "rows_late",
                                  F.greatest(F.lit(0.0), (F.unix_micros(as_of) - F.unix_micros("newest")) / F.lit(1e6)).alias("lag_seconds"))

    def next_start(self, overlap_seconds: int) -> DataFrame:
        """Where a restarted job reads from: the newest event of all finished batches, less the overlap."""
        return self.read().agg((F.max("newest") - F.make_dt_interval(secs=F.lit(overlap_seconds))).alias("start"))


def split_late(path: str, progress: Progress, delay_seconds: int = DEFAULTS.session_overlap_seconds, time: str = "ts", then: OnBatch | None = None) -> OnBatch:
    """Rows older than the newest event of earlier batches less the delay go to a side table, the others to the main one.

    Both are folders of one write, ``late=false`` and ``late=true`` under the batch's own, which a replay overwrites. Rows without a time
    are not late. ``then`` receives the rows in time.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        newest = progress.newest_before(batch_id)
        spark = batch.sparkSession
        watermark = None if newest is None else spark.range(1).select((F.lit(newest) - F.make_dt_interval(secs=F.lit(delay_seconds))).alias("w")).first().w
        late = F.lit(False) if watermark is None else F.coalesce(c(time) < F.lit(watermark), F.lit(False))
        seen = Observation()
        rows = batch.withColumn("late", late)
        watched = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("late").alias("late"), F.max(F.unix_micros(time)).alias("us"))
        folder = f"{path}/batch={batch_id}"
        watched.write.mode("overwrite").partitionBy("late").parquet(folder)
        if then is not None:
            then(spark.read.parquet(folder).where(~c("late").cast("boolean")).drop("late"), batch_id)
        progress.record(batch_id, seen.get, watermark)
    return on_batch


def run_in_parts(spark: SparkSession, base: str, parts: Sequence[DataFrame], on_batch: OnBatch, view: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Each part is added to a folder that a stream reads and taken in as one micro-batch; the stream starts again from its checkpoint each time."""
    schema = parts[0].schema
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        stream = view(spark.readStream.schema(schema).parquet(f"{base}/in"))
        stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(on_batch).start().awaitTermination()
