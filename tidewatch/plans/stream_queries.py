"""Streaming jobs run once over everything available, read back from the tables they wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.operators import rules as R
from tidewatch.operators.forest import training_rows
from tidewatch.operators.ingest import with_route
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.rule_queries import _R01, _R02, _R03, _greedy, _rule_sql
from tidewatch.plans.views import behavior_table, epoch, parsed_lines, session_table, us
from tidewatch.session import configure, ensure_checkpoint_dir, stored as spark_stored
from tidewatch.settings import DEFAULTS
from tidewatch.sources import logs as L, tables as T
from tidewatch.sources.adapters import raw_columns
from tidewatch.streaming import incremental as I, jobs as J
from tidewatch.streaming.rule_state import rule_alerts
from tidewatch.streaming.scoring import ModelStore, ScoreStore

c = F.col


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-log view over a streaming read of the event files."""
    configure(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/event[s].parquet")
    return raw_columns(events)


def _collect_table(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    write = lambda batch, _id: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{base}/table")
    J.start(stream, write, f"{base}/state", mode=mode).awaitTermination()
    return spark.read.parquet(f"{base}/table")


@query("w01_micro_batch", O.raw("SELECT log_type, count(*) AS n FROM raw GROUP BY 1"))
def micro_batch(spark, d):
    rows = _collect_table(spark, raw_stream(spark, d).select("raw_id", "log_type"))
    return rows.groupBy("log_type").agg(F.count("*").alias("n"))


@query("w03_stream_dedup", O.raw("SELECT log_type, count(DISTINCT raw_id) AS n FROM raw GROUP BY 1"))
def stream_dedup(spark, d):
    rows = J.new_events(raw_stream(spark, d).select("raw_id", "log_type", "ingest_ts"))
    return _collect_table(spark, rows).groupBy("log_type").agg(F.count("*").alias("n"))


@query("w06_streaming_rule", O.raw("""SELECT orig_h AS src_ip, resp_h AS dst_ip, (us // 30000000 - s + 10) * 30000000 AS us, count(*) AS hits FROM raw, (SELECT unnest(range(10)) AS s) x
    WHERE log_type = 'conn' AND resp_p = 22 GROUP BY 1, 2, 3 HAVING count(*) >= 8"""))
def streaming_rule(spark, d):
    events = raw_stream(spark, d).where("log_type = 'conn' and resp_p = 22").select("ts", c("orig_h").alias("src_ip"), c("resp_h").alias("dst_ip"))
    rows = _collect_table(spark, J.sliding_counts(events, R.SSH_BRUTE_FORCE), mode="complete")
    return rows.select("src_ip", "dst_ip", F.unix_micros("ts").alias("us"), "hits")


@query("w08_failure_isolation", O.lines("SELECT NOT (e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7) AS parse_error, count(*) AS rows FROM lines GROUP BY 1"))
def failure_isolation(spark, d):
    return J.malformed_counts(parsed_lines(spark, d))


# ---------------------------------------------------------------- late rows and progress

_PROGRESS: dict[tuple[str, str], tuple[str, I.Progress]] = {}


def _late_run(spark, d):
    """Events in three parts by time, a twentieth of them a part too late, taken in by a restarted stream; made once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _PROGRESS:
        events = spark.read.parquet(f"{d}/events.parquet")
        end = events.agg(F.max("event_id")).scalar() + 1
        part = F.least(F.lit(2), F.floor(c("event_id") * 3 / end) + F.when(c("event_id") % 20 == 3, 1).otherwise(0))
        base = f"{ensure_checkpoint_dir(spark)}/late-{uuid.uuid4().hex}"
        state = I.Progress(spark, f"{base}/progress")
        view = lambda df: raw_columns(df).select("raw_id", "log_type", "ts")
        I.run_in_parts(spark, base, [events.where(part == i) for i in range(3)], I.split_late(f"{base}/out", state), view)
        _PROGRESS[key] = (base, state)
    return _PROGRESS[key]


_PARTS = """parts AS (SELECT *, least(2, e * 3 // (m + 1) + CASE WHEN e % 20 = 3 THEN 1 ELSE 0 END) AS part FROM raw, (SELECT max(e) AS m FROM raw) x),
marks AS (SELECT p.part, max(q.us) AS before_us FROM (SELECT DISTINCT part FROM parts) p LEFT JOIN (SELECT part, max(us) AS us FROM parts GROUP BY part) q ON q.part < p.part GROUP BY p.part),
judged AS (SELECT parts.*, coalesce(us < before_us - 1800000000, false) AS late FROM parts JOIN marks USING (part))"""


@query("w02_late_data_watermark", f"WITH raw AS ({O.RAW}), {_PARTS} SELECT late, log_type, count(*) AS n, count(DISTINCT raw_id) AS ids, min(us) AS first_us, max(us) AS last_us FROM judged GROUP BY 1, 2")
def late_data(spark, d):
    base, _ = _late_run(spark, d)
    rows = spark.read.parquet(f"{base}/out").withColumn("late", c("late").cast("boolean"))
    return rows.groupBy("late", "log_type").agg(F.count("*").alias("n"), F.count_distinct("raw_id").alias("ids"), F.min(us("ts")).alias("first_us"), F.max(us("ts")).alias("last_us"))


@query("w09_progress", f"""WITH {O.HARD}, {_PARTS} SELECT CAST(part AS BIGINT) AS batch, count(*) AS documents_read, count(*) FILTER (WHERE NOT late) AS rows_written, count(*) FILTER (WHERE late) AS rows_late,
    ((SELECT max(us) FROM raw) - max(us)) / 1000000.0 AS lag_seconds, (SELECT max(us) FROM raw) - 1800000000 AS next_start_us,
    (SELECT count(*) FROM hard) AS sessions, (SELECT max(last_us) FROM hard) AS sessions_last_us FROM judged GROUP BY part""")
def progress(spark, d):
    """Progress of the batches, and how far the hardened sessions behind them have come."""
    _, state = _late_run(spark, d)
    newest = state.read().agg(F.max("newest")).scalar()
    start = state.next_start(DEFAULTS.session_overlap_seconds).select(F.unix_micros("start").alias("next_start_us"))
    done = session_table(spark, d).agg(F.count("*").alias("sessions"), F.max(us("last_seen")).alias("sessions_last_us"))
    return state.lag(newest).withColumn("next_start_us", start.scalar()).crossJoin(F.broadcast(done))


# ---------------------------------------------------------------- sinks

_SINKS: dict[tuple[str, str], str] = {}


def _sink_run(spark, d):
    """Routed raw logs of a stream of three batches, the last of them written twice; made once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SINKS:
        base = f"{ensure_checkpoint_dir(spark)}/sinks-{uuid.uuid4().hex}"
        parts = [spark.read.parquet(f"{d}/events.parquet").where(c("event_id") % 3 == i) for i in range(3)]
        view = lambda df: with_route(raw_columns(df))
        write = lambda batch, number: T.write_routed(batch, base, number)
        I.run_in_parts(spark, base, parts, write, view)
        write(view(parts[2]), 2)
        _SINKS[key] = base
    return _SINKS[key]


@query("s10_routed_sink", O.raw("""SELECT CASE WHEN log_type IN ('smb_files', 'smb_mapping') THEN 'smb' WHEN log_type IN ('conn', 'dns', 'http', 'ssl', 'files', 'weird', 'notice', 'x509', 'ssh', 'ftp', 'ldap') THEN log_type
    ELSE 'other' END AS route, CAST(make_timestamp(us) AS DATE) AS event_date, count(*) AS n, count(DISTINCT raw_id) AS ids, count(DISTINCT log_type) AS log_types FROM raw GROUP BY 1, 2"""))
def routed_sink(spark, d):
    rows = spark.read.parquet(f"{_sink_run(spark, d)}/routed")
    return rows.groupBy("route", "event_date").agg(F.count("*").alias("n"), F.count_distinct("raw_id").alias("ids"), F.count_distinct("log_type").alias("log_types"))


@query("s13_dated_sink", O.raw("SELECT CAST(make_timestamp(us) AS DATE) AS event_date, count(*) AS n, count(DISTINCT raw_id) AS ids, min(us) AS first_us, max(us) AS last_us FROM raw GROUP BY 1"))
def dated_sink(spark, d):
    rows = spark.read.parquet(f"{_sink_run(spark, d)}/whole")
    return rows.groupBy("event_date").agg(F.count("*").alias("n"), F.count_distinct("raw_id").alias("ids"), F.min(us("ts")).alias("first_us"), F.max(us("ts")).alias("last_us"))


@query("s03_dead_letter_sink", O.lines("""SELECT DATE '2024-01-01' AS event_date, value AS raw_message, CASE WHEN value = '' THEN 'empty line' ELSE 'not a JSON object' END AS parse_error_reason, count(*) AS n
    FROM lines WHERE NOT (e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7) GROUP BY 1, 2, 3"""))
def dead_letter_sink(spark, d):
    base = f"{ensure_checkpoint_dir(spark)}/dead-{uuid.uuid4().hex}"
    letters = L.dead_letters(parsed_lines(spark, d))
    for batch in (0, 1, 1):  # the second batch is written again
        T.write_dead_letters(letters.where(c("file_offset") % 2 == batch), base, batch, F.to_date(epoch()))
    rows = spark.read.schema("raw_message string, parse_error_reason string, event_date date, batch int").json(base)
    return rows.groupBy("event_date", "raw_message", "parse_error_reason").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- windows rebuilt as sessions arrive

@query("w05_recompute_windows", O.behaviors(f"""SELECT {O.WIN}, count(*) AS total, count(*) FILTER (WHERE eligible) AS used, count(DISTINCT dst_ip) FILTER (WHERE eligible) AS destinations,
    CAST(coalesce(sum(coalesce(bytes, 0)) FILTER (WHERE eligible), 0) AS BIGINT) AS bytes FROM rows_all GROUP BY {O.BY_WIN}"""))
def recompute_windows(spark, d):
    """Every window gets sessions in each of three batches; some sessions first stand in an earlier window; the last batch runs twice."""
    s = session_table(spark, d)
    base = f"{ensure_checkpoint_dir(spark)}/windows-{uuid.uuid4().hex}"
    store = I.WindowStore(spark, base, ("session_id", "ts"), buckets=4, updated_at=epoch())
    part = F.pmod(F.xxhash64("session_id"), F.lit(3))
    early = c("first_seen") - F.make_dt_interval(mins=F.lit(15))
    moved = s.where((part == 1) & (F.pmod(F.xxhash64("session_id"), F.lit(7)) == 0)).withColumn("first_seen", early)
    parts = [s.where(part == 0).unionByName(moved), s.where(part == 1), s.where(part == 2)]
    I.run_in_parts(spark, base, parts, store.rebuild)
    store.rebuild(parts[2], 2)
    rows = store.behaviors.read()
    return rows.select("entity", c("sensor_key").alias("sensor"), us("window_start").alias("window_us"), c("quality.session_count_total").alias("total"),
                       c("quality.session_count_used").alias("used"), c("features.unique_destination_ip_count").alias("destinations"), c("features.network_bytes_sum").alias("bytes"))


# ---------------------------------------------------------------- rules with state

def _stream_alerts(spark, d, rule, pick):
    """The rule's alerts over sessions in three parts by time; the stream starts again from its state after each."""
    events = pick(session_table(spark, d)).select("ts", *rule.key, *([rule.value] if rule.value and rule.value not in rule.key else []))
    events = spark_stored(events, "rule-events")
    low, high = events.agg(F.min(us("ts")).alias("low"), F.max(us("ts")).alias("high")).first()
    part = F.floor((us("ts") - (low or 0)) * 3 / ((high or 0) - (low or 0) + 1))
    base = f"{ensure_checkpoint_dir(spark)}/rule-{uuid.uuid4().hex}"
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")
    I.run_in_parts(spark, base, [events.where(part == i) for i in range(3)], write, lambda stream: rule_alerts(stream, rule))
    return spark.read.parquet(f"{base}/out")


@query("w06_vertical_scan_stream", _rule_sql(_R01, "SELECT src_ip, dst_ip, us FROM kept", _greedy("src_ip, dst_ip", 60000000)))
def vertical_scan_stream(spark, d):
    return _stream_alerts(spark, d, R.VERTICAL_SCAN, R.scan_sessions).select("src_ip", "dst_ip", "us")


@query("w06_horizontal_scan_stream", _rule_sql(_R02, "SELECT src_ip, us FROM kept", _greedy("src_ip", 900000000)))
def horizontal_scan_stream(spark, d):
    return _stream_alerts(spark, d, R.HORIZONTAL_SCAN, R.sweep_sessions).select("src_ip", "us")


@query("w06_ssh_bruteforce_stream", _rule_sql(_R03, "SELECT src_ip, dst_ip, us FROM kept", _greedy("src_ip, dst_ip", 600000000)))
def ssh_bruteforce_stream(spark, d):
    return _stream_alerts(spark, d, R.SSH_BRUTE_FORCE, R.ssh_sessions).select("src_ip", "dst_ip", "us")


@query("w07_score_new_only", O.behaviors(f"SELECT count(*) AS n FROM (SELECT count(*) FILTER (WHERE eligible) AS u FROM rows_all GROUP BY {O.BY_WIN}) w WHERE u >= 2 AND u % 2 = 1"))
def score_new_only(spark, d):
    from tidewatch.operators.forest import unscored
    from tidewatch.plans.views import behavior_table
    done = c("quality.session_count_used") % 2 == 0
    b = behavior_table(spark, d).withColumn("ml", c("ml").withField("scoring_status", F.when(done, "scored").otherwise("not_scored")))
    return unscored(b).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- scores of new and changed rows

_SCORES: dict[tuple[str, str], ScoreStore] = {}
_HOURS = (0, 1, 7)


def _score_run(spark, d) -> ScoreStore:
    """Behaviours in three batches: a third of them; all, some with other vectors; all, others with other vectors and the model too old.

    The last batch runs twice. Made once per application.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _SCORES:
        b = behavior_table(spark, d)
        total = c("quality.session_count_total")
        moved = lambda rows, hit, by: rows.withColumn("ml", F.when(hit, c("ml").withField("feature_vector", F.transform("ml.feature_vector", lambda v: v + by))).otherwise(c("ml")))
        second = moved(b, total % 4 == 1, 1)
        parts = [b.where(total % 3 == 0), second, moved(second, total % 5 == 0, 10)]
        base = f"{ensure_checkpoint_dir(spark)}/scores-{uuid.uuid4().hex}"
        store = ScoreStore(ModelStore(spark, f"{base}/models"), f"{base}/scores", buckets=4)
        as_of = lambda number: epoch() + F.make_dt_interval(hours=F.lit(_HOURS[number]))
        score = lambda batch, number: store.score(batch, number, lambda: training_rows(b), as_of(number))
        I.run_in_parts(spark, base, parts, score)
        score(parts[2], 2)
        _SCORES[key] = store
    return _SCORES[key]


_SCORED = f"""scored AS (SELECT *, CASE WHEN total % 5 = 0 THEN 2 ELSE 1 END AS model, CASE WHEN total % 5 = 0 THEN 2 WHEN total % 3 = 0 AND total % 4 <> 1 THEN 0 ELSE 1 END AS batch FROM (
    SELECT 'asset_15m_v1|' || sensor_key || '|' || entity || '|' || strftime(make_timestamp(window_us), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS behavior_id, count(*) FILTER (WHERE eligible) AS used, count(*) AS total
    FROM rows_all GROUP BY {O.BY_WIN}) t WHERE used >= 2)"""


@query("w07_scored_batches", f"WITH {O.BEH}, {_SCORED} SELECT behavior_id, model, batch, true AS in_range FROM scored")
def scored_batches(spark, d):
    rows = _score_run(spark, d).scores.read()
    in_range = (c("ml.scoring_status") == "scored") & c("ml.anomaly_score").between(0.5, 0.732) & (c("score.final") == F.round(c("ml.anomaly_score") * 100, 2))
    return rows.select("behavior_id", "model", c("scored_batch").alias("batch"), in_range.alias("in_range"))


@query("k08_model_versions", f"""WITH {O.BEH}, {_SCORED} SELECT model AS number, 1704067200000000 + CASE model WHEN 2 THEN 7 ELSE 0 END * 3600000000 AS trained_us, (SELECT count(*) FROM scored) AS training_rows,
    count(*) AS current_scores FROM scored GROUP BY model""")
def model_versions(spark, d):
    store = _score_run(spark, d)
    current = store.scores.read().groupBy(c("model").alias("number")).agg(F.count("*").alias("current_scores"))
    return store.models.versions().join(current, "number").select("number", us("trained_at").alias("trained_us"), "training_rows", "current_scores")


@query("s16_job_checkpoint", O.hardened("SELECT 'sessions' AS job, max(last_us) - 1800000000 AS start_us, max(last_us) + 60000000 AS end_us FROM hard"))
def job_checkpoint(spark, d):
    from tidewatch.settings import DEFAULTS
    from tidewatch.sources.tables import next_window
    s = session_table(spark, d)
    state = s.agg(F.max("last_seen").alias("last_successful_timestamp")).withColumn("job", F.lit("sessions"))
    now = s.agg(F.max("last_seen")).scalar() + F.make_dt_interval(mins=F.lit(1))
    rows = next_window(state, "sessions", now, DEFAULTS.session_overlap_seconds, DEFAULTS.session_initial_lookback_seconds)
    return rows.select("job", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"))
