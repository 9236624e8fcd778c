"""Data-quality and health queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidewatch.operators import health as H
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.views import behavior_table, flows, raw_table, session_table

c = F.col
_PICK = ["id", "status"]


def _metric(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(*_PICK, *[F.try_element_at(c("metrics"), F.lit(n)).cast("bigint").alias(n) for n in names])


def _now(spark, d, minutes: int = 0):
    return raw_table(spark, d).agg(F.max("ts")).scalar() + F.make_dt_interval(mins=F.lit(minutes))


_NOW = "(SELECT max(us) FROM raw)"


@query("h01_session_report", O.hardened("""SELECT metric, CAST(value AS BIGINT) AS value FROM (SELECT unnest(['session_count', 'missing_network_protocol', 'missing_evidence', 'missing_source_ip', 'missing_destination_ip', 'control_plane_tagged',
    'non_flow_sessions', 'malformed_raw_sessions', 'flag_mismatches', 'duplicate_session_ids']) AS metric, unnest([count(*), 0, 0, count(*) FILTER (WHERE flow_based AND src_ip IS NULL), count(*) FILTER (WHERE flow_based AND dst_ip IS NULL),
    count(*) FILTER (WHERE excluded), count(*) FILTER (WHERE NOT flow_based), count(*) FILTER (WHERE category = 'malformed_raw'),
    count(*) FILTER (WHERE list_contains(log_types, 'tls') AND NOT list_contains(log_types, 'ssl')), (SELECT count(*) FROM (SELECT session_id FROM hard GROUP BY 1 HAVING count(*) > 1) x)]) AS value FROM hard) t"""))
def session_report(spark, d):
    return H.session_report(session_table(spark, d)).where("metric <> 'events_truncated'")


@query("h01_top_protocols", O.hardened("SELECT protocol AS value, count(*) AS n FROM hard GROUP BY 1 ORDER BY n DESC, value LIMIT 30"))
def top_protocols(spark, d):
    return H.terms(session_table(spark, d), c("protocol"), 30)


@query("h01_top_combos", O.hardened("SELECT array_to_string(log_types, ',') AS value, count(*) AS n FROM hard GROUP BY 1 ORDER BY n DESC, value LIMIT 30"))
def top_combos(spark, d):
    return H.terms(session_table(spark, d), F.array_join("log_types", ","), 30, "MISSING")


@query("h02_behavior_report", O.behaviors(f"""SELECT metric, CAST(value AS BIGINT) AS value FROM (SELECT unnest(['behavior_count', 'ml_ready_count', 'bad_vector_length', 'missing_entity', 'exit_code']) AS metric,
    unnest([count(*), count(*) FILTER (WHERE u >= 2), 0, 0, 0]) AS value FROM (SELECT count(*) FILTER (WHERE eligible) AS u FROM rows_all GROUP BY {O.BY_WIN}) w) t"""))
def behavior_report(spark, d):
    return H.behavior_report(behavior_table(spark, d)).where(c("metric").isin("behavior_count", "ml_ready_count", "bad_vector_length", "missing_entity", "exit_code"))


def _age(kind: str, latest: str, warn: int, crit: int) -> str:
    return f"SELECT '{kind}.freshness' AS id, CASE WHEN a >= {crit} THEN 'crit' WHEN a >= {warn} THEN 'warn' ELSE 'ok' END AS status, CAST(floor(a) AS BIGINT) AS age_seconds FROM (SELECT ({_NOW} - ({latest})) / 1000000.0 AS a) t"


@query("h03_freshness", O.behaviors(" UNION ALL ".join([
    _age("raw", "SELECT max(us) FROM raw", 300, 900), _age("session", "SELECT max(ts_us) FROM hard", 900, 1800), _age("behavior", "SELECT max(window_us) FROM rows_all", 1800, 3600)])))
def freshness(spark, d):
    now = _now(spark, d, 0)
    rows = H.freshness(raw_table(spark, d), "raw", "raw_ingestion", now)
    rows = rows.unionByName(H.freshness(session_table(spark, d), "session", "sessionizer", now))
    return _metric(rows.unionByName(H.freshness(behavior_table(spark, d), "behavior", "behaviorizer", now, "window_start")), "age_seconds")


_SEEN = f"(SELECT DISTINCT log_type FROM raw WHERE us >= {_NOW} - 3600000000)"


@query("h04_log_type_coverage", O.raw(f"""SELECT 'raw.log_type_coverage' AS id, CASE WHEN m = 0 THEN 'ok' WHEN m <= 5 THEN 'warn' ELSE 'crit' END AS status, m AS missing_count FROM (SELECT count(*) AS m
    FROM (SELECT unnest(['conn', 'dns', 'http', 'kerberos', 'rdp', 'ssl', 'files', 'notice', 'weird', 'ssh']) AS x) t WHERE x NOT IN {_SEEN}) s"""))
def coverage(spark, d):
    wanted = ("conn", "dns", "http", "kerberos", "rdp", "ssl", "files", "notice", "weird", "ssh")
    return _metric(H.log_type_coverage(raw_table(spark, d), _now(spark, d), wanted), "missing_count")


@query("h05_sensor_coverage", O.raw(f"SELECT 'raw.sensor_coverage' AS id, 'warn' AS status, count(DISTINCT sensor) AS observed_sensors, 1 AS missing_sensors FROM raw WHERE us >= {_NOW} - 3600000000"))
def sensors(spark, d):
    rows = raw_table(spark, d).withColumn("agent", F.lit(None).cast("string"))
    return _metric(H.sensor_coverage(rows, _now(spark, d), ("sensor1", "sensor9"), ("agent", "sensor", "uid")), "observed_sensors", "missing_sensors")


_FIELDS = ("log_type", "orig_h", "uid", "resp_p")


@query("h06_missing_fields", O.raw("SELECT field, missing, total, round(missing * 100 / total, 2) AS percent FROM (SELECT unnest(['log_type', 'orig_h', 'uid', 'resp_p']) AS field, "
                                   "unnest([0, count(*) FILTER (WHERE orig_h IS NULL), count(*) FILTER (WHERE uid IS NULL), count(*) FILTER (WHERE resp_p IS NULL)]) AS missing, count(*) AS total FROM raw) t"))
def missing_fields(spark, d):
    return H.missing_percent(raw_table(spark, d), {n: c(n) for n in _FIELDS})


@query("h06_schema_quality", O.raw(f"""SELECT 'raw.schema_quality' AS id, CASE WHEN p > 25 THEN 'crit' WHEN p > 5 THEN 'warn' ELSE 'ok' END AS status FROM (SELECT greatest(count(*) FILTER (WHERE orig_h IS NULL),
    count(*) FILTER (WHERE uid IS NULL)) * 100.0 / count(*) AS p FROM raw WHERE us >= {_NOW} - 3600000000) t"""))
def schema_quality(spark, d):
    return H.schema_quality(raw_table(spark, d), {n: c(n) for n in _FIELDS}, _now(spark, d)).select(*_PICK)


@query("h07_session_flow", O.hardened(f"""SELECT 'sessionizer.output' AS id, (SELECT count(*) FROM raw WHERE us BETWEEN {_NOW} - 1800000000 AND {_NOW}) AS raw_count_30m,
    count(*) FILTER (WHERE ts_us BETWEEN {_NOW} - 1800000000 AND {_NOW}) AS session_count_30m FROM hard"""))
def session_flow(spark, d):
    return _metric(H.session_flow_check(raw_table(spark, d), session_table(spark, d), _now(spark, d), {"src_ip": c("src_ip")}), "raw_count_30m", "session_count_30m").drop("status")


@query("h08_behavior_flow", O.behaviors(f"""SELECT 'behaviorizer.output' AS id, (SELECT count(*) FROM hard WHERE ts_us BETWEEN {_NOW} - 7200000000 AND {_NOW}) AS session_count_2h,
    count(*) FILTER (WHERE window_us BETWEEN {_NOW} - 7200000000 AND {_NOW}) AS behavior_count_2h FROM (SELECT DISTINCT {O.BY_WIN} FROM rows_all) w"""))
def behavior_flow(spark, d):
    return _metric(H.behavior_flow_check(session_table(spark, d), behavior_table(spark, d), _now(spark, d)), "session_count_2h", "behavior_count_2h").drop("status")


@query("h09_scoring_backlog", O.behaviors(f"""SELECT 'ml.scoring' AS id, CASE WHEN count(*) FILTER (WHERE u >= 2) >= 20 THEN 'crit' ELSE 'warn' END AS status, count(*) FILTER (WHERE u >= 2) AS ready_behaviors,
    count(*) FILTER (WHERE u >= 2) AS unscored_ready FROM (SELECT count(*) FILTER (WHERE eligible) AS u FROM rows_all GROUP BY {O.BY_WIN}) w"""))
def backlog(spark, d):
    return _metric(H.scoring_check(behavior_table(spark, d)), "ready_behaviors", "unscored_ready")


@query("h10_alert_presence", O.raw("SELECT 'elastalert.state' AS id, 'ok' AS status, count(*) FILTER (WHERE log_type = 'notice') AS alerts_total FROM raw"))
def alert_presence(spark, d):
    raw = raw_table(spark, d)
    return _metric(H.alert_presence(raw.where("log_type = 'conn'"), raw.where("log_type = 'notice'"), _now(spark, d)), "alerts_total")


@query("h10_flow_presence", O.flows("SELECT 'netflow.indices' AS id, 'crit' AS status, count(*) AS flow_docs FROM flow WHERE l_orderkey % 97 <> 5 AND l_orderkey % 101 <> 6 AND l_orderkey % 103 <> 7"))
def flow_presence(spark, d):
    return _metric(H.flow_presence(flows(spark, d), F.to_timestamp(F.lit("2030-01-01 00:00:00"))), "flow_docs")


def _metric_lines(spark, d):
    """Exposition lines, one per raw row: counters per log type and sensor, with comments in between."""
    raw = raw_table(spark, d)
    k, e = F.get_json_object("doc", "$.k").cast("int"), F.get_json_object("doc", "$.e").cast("bigint")
    line = (
        F.when(k % 10 == 0, "# HELP x").when(k % 10 == 1, F.concat(F.lit("vector_component_errors_total{component_id=\"c"), k.cast("string"), F.lit("\",host=\"a\\\"b\"} "), e.cast("string")))
        .when(k % 10 == 2, F.concat(F.lit("vector_component_discarded_events_total{intentional=\"true\",component_id=\"zeek_filter\"} "), e.cast("string")))
        .when(k % 10 == 3, "broken line").otherwise(F.concat(F.lit("events_sent_total "), e.cast("string"), F.lit(".5"))))
    return raw.where("log_type = 'conn'").select("raw_id", "sensor", c("ts").alias("scraped_at"), line.alias("line"))


_SERIES = """samples AS MATERIALIZED (SELECT raw_id, e, k, us, CASE k % 10 WHEN 1 THEN 'vector_component_errors_total' WHEN 2 THEN 'vector_component_discarded_events_total' ELSE 'events_sent_total' END AS name,
    CASE k % 10 WHEN 1 THEN 'vector_component_errors_total{component_id=c' || k || ',host=a"b}' WHEN 2 THEN 'vector_component_discarded_events_total{component_id=zeek_filter,intentional=true}' ELSE 'events_sent_total{}' END AS series,
    CASE WHEN k % 10 IN (1, 2) THEN CAST(e AS DOUBLE) ELSE e + 0.5 END AS value FROM raw WHERE log_type = 'conn' AND k % 10 NOT IN (0, 3))"""


@query("h11_metric_parse", f"WITH raw AS ({O.RAW}), {_SERIES} SELECT raw_id, name, series, value FROM samples")
def metric_parse(spark, d):
    return H.parse_metrics(_metric_lines(spark, d)).select("raw_id", "name", "series", "value")


@query("h12_counter_delta", f"WITH raw AS ({O.RAW}), {_SERIES} SELECT series, count(delta) AS n, CAST(coalesce(sum(delta), 0) AS BIGINT) AS total FROM (SELECT series, value - lag(value) OVER (PARTITION BY series ORDER BY us) AS delta FROM samples) t GROUP BY 1")
def counter_delta(spark, d):
    rows = H.counter_deltas(H.parse_metrics(_metric_lines(spark, d)))
    return rows.groupBy("series").agg(F.count("delta").alias("n"), F.coalesce(F.sum("delta"), F.lit(0)).cast("bigint").alias("total"))


@query("h13_error_classification", f"WITH raw AS ({O.RAW}), {_SERIES} SELECT CASE name WHEN 'vector_component_errors_total' THEN 'error' WHEN 'vector_component_discarded_events_total' THEN 'intentional' ELSE 'other' END AS kind, count(*) AS n FROM samples GROUP BY 1")
def error_kinds(spark, d):
    return H.classify_series(H.parse_metrics(_metric_lines(spark, d))).groupBy("kind").agg(F.count("*").alias("n"))


@query("h13_error_check", f"WITH raw AS ({O.RAW}), {_SERIES} SELECT 'vector.metrics' AS id, CASE WHEN bad = 0 THEN 'ok' WHEN bad >= 10 THEN 'crit' ELSE 'warn' END AS status, CAST(bad AS BIGINT) AS new_error_delta FROM (SELECT coalesce(sum(delta), 0) AS bad FROM (SELECT name, value - lag(value) OVER (PARTITION BY series ORDER BY us) AS delta FROM samples) t WHERE name = 'vector_component_errors_total') x")
def error_check(spark, d):
    rows = H.classify_series(H.counter_deltas(H.parse_metrics(_metric_lines(spark, d))))
    return _metric(H.error_check(rows), "new_error_delta")


@query("h14_series_sum", f"WITH raw AS ({O.RAW}), {_SERIES} SELECT CAST(sum(value) AS DOUBLE) AS total FROM samples WHERE name = 'events_sent_total'")
def series_sum(spark, d):
    return H.total_value(H.parse_metrics(_metric_lines(spark, d)), H.name_has("sent"))


@query("h14_top_series", f"WITH raw AS ({O.RAW}), {_SERIES} SELECT series, value FROM samples WHERE name = 'events_sent_total' ORDER BY value DESC LIMIT 10")
def top_series(spark, d):
    return H.largest_samples(H.parse_metrics(_metric_lines(spark, d)), H.name_has("sent")).select("series", "value")


def _check_rows(spark, d):
    """A check row per raw row: component = log type, status by k."""
    k = F.get_json_object("doc", "$.k").cast("int")
    status = F.when(k < 1, "crit").when(k < 3, "warn").when(k < 4, "unknown").otherwise("ok")
    return raw_table(spark, d).select(c("raw_id").alias("id"), c("log_type").alias("component"), status.alias("status"), c("raw_id").alias("summary"), F.unix_micros("ts").alias("seq"))


_CHECKS = "checks AS MATERIALIZED (SELECT raw_id AS id, us AS seq, log_type AS component, CASE WHEN k < 1 THEN 'crit' WHEN k < 3 THEN 'warn' WHEN k < 4 THEN 'unknown' ELSE 'ok' END AS status FROM raw)"
_ROLL = """SELECT component, count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'warn') AS warn, count(*) FILTER (WHERE status = 'crit') AS crit, count(*) FILTER (WHERE status = 'unknown') AS unknown,
    CAST(greatest(0, 100 - 18 * count(*) FILTER (WHERE status = 'crit') - 7 * count(*) FILTER (WHERE status = 'warn') - 3 * count(*) FILTER (WHERE status = 'unknown')) AS INT) AS score,
    CASE WHEN bool_or(status = 'crit') THEN 'crit' WHEN bool_or(status = 'warn') THEN 'warn' WHEN bool_or(status = 'unknown') THEN 'unknown' ELSE 'ok' END AS status FROM checks GROUP BY ROLLUP (component)"""


@query("h15_worst_and_score", f"WITH raw AS ({O.RAW}), {_CHECKS} SELECT score, status FROM ({_ROLL}) t WHERE component IS NULL")
def worst(spark, d):
    return H.component_summary(_check_rows(spark, d)).where("component is null").select("score", "status")


@query("h16_component_roll_up", f"WITH raw AS ({O.RAW}), {_CHECKS} {_ROLL}")
def roll_up(spark, d):
    return H.component_summary(_check_rows(spark, d)).drop("label")


@query("h17_highlights", f"WITH raw AS ({O.RAW}), {_CHECKS} SELECT string_agg(id, '|' ORDER BY seq, id) AS highlights FROM (SELECT id, seq FROM checks WHERE status = 'crit' ORDER BY seq, id LIMIT 6) t")
def highlights(spark, d):
    return H.highlights(_check_rows(spark, d)).select(F.array_join("highlights", "|").alias("highlights"))


@query("h18_scan_history", O.raw("SELECT raw_id AS scan_id, max(us) AS us FROM raw WHERE log_type = 'conn' GROUP BY 1 ORDER BY us DESC LIMIT 500"))
def scan_history(spark, d):
    scans = raw_table(spark, d).where("log_type = 'conn'").select(c("raw_id").alias("scan_id"), c("ts").alias("generated_at")).distinct()
    cut = scans.agg(F.max("generated_at")).scalar() - F.make_dt_interval(mins=F.lit(10))
    kept = H.append_scan(scans.where(c("generated_at") < cut), scans.where(c("generated_at") >= cut))
    return kept.select("scan_id", F.unix_micros("generated_at").alias("us"))


@query("h19_table_presence", O.behaviors(f"SELECT 'opensearch.indices' AS id, 'ok' AS status, 0 AS missing_count, (SELECT count(*) FROM raw) + (SELECT count(*) FROM hard) + (SELECT count(*) FROM (SELECT DISTINCT {O.BY_WIN} FROM rows_all) w) AS rows"))
def table_presence(spark, d):
    tables = {"raw": raw_table(spark, d), "sessions": session_table(spark, d), "behaviors": behavior_table(spark, d)}
    return _metric(H.table_presence(tables), "missing_count", "rows")


@query("t03_multi_facet_terms", O.behaviors(f"""SELECT 'ready' AS facet, CAST(u >= 2 AS STRING) AS value, count(*) AS n FROM (SELECT count(*) FILTER (WHERE eligible) AS u FROM rows_all GROUP BY {O.BY_WIN}) w GROUP BY 2
    UNION ALL SELECT 'feature_set', 'asset_15m_v1', count(*) FROM (SELECT DISTINCT {O.BY_WIN} FROM rows_all) v"""))
def facets(spark, d):
    return H.facet_terms(behavior_table(spark, d), {"ready": c("ml.ready"), "feature_set": c("feature_set")}).select("facet", "value", "n")


@query("t08_vector_length_rows", O.behaviors(f"SELECT count(*) AS bad FROM (SELECT {O.BY_WIN} FROM rows_all GROUP BY {O.BY_WIN} HAVING count(*) FILTER (WHERE eligible) % 2 = 1) t"))
def bad_vectors(spark, d):
    b = behavior_table(spark, d)
    cut = F.when(c("quality.session_count_used") % 2 == 1, F.slice("ml.feature_vector", 1, 60)).otherwise(c("ml.feature_vector"))
    return H.bad_vectors(b.withColumn("ml", c("ml").withField("feature_vector", cut))).agg(F.count("*").alias("bad"))
