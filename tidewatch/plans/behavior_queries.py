"""Eligibility, keys, window features, top lists, evidence, quality, state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import behaviors as B
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.views import behavior_table, joined, session_table, us
from tidewatch.settings import ASSET_15M

c = F.col
_X509_STATS = """xf AS (SELECT key, list(DISTINCT cert_issuer) AS issuers, list(DISTINCT cert_subject) AS subjects, min(cert_not_valid_after) AS oldest FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY us, raw_id) AS r FROM (SELECT DISTINCT * FROM prepared WHERE log_type = 'x509') a) x WHERE r <= 20 GROUP BY key)"""


def _win(select: str, source: str = "used", extra: str = "") -> str:
    """One row per window; windows whose sessions are all excluded give the empty aggregate."""
    return f"WITH {O.BEH}{extra} SELECT {O.WIN}, {select} FROM {source} GROUP BY {O.BY_WIN}"


def _features(spark, d, *names):
    b = behavior_table(spark, d).where("quality.session_count_used > 0")
    return b.select("entity", F.coalesce("sensor", F.lit("")).alias("sensor"), us("window_start").alias("window_us"), *[c(f"features.{n}").alias(n) for n in names])


@query("f10_eligibility", O.behaviors("SELECT session_id, ts_us, eligible, nullif(array_to_string(reasons, '|'), '') AS reasons FROM (SELECT *, len(reasons) = 0 AS eligible FROM eligibility) t"))
@query("f11_ip_reasons", O.behaviors("SELECT session_id, ts_us, eligible, nullif(array_to_string(reasons, '|'), '') AS reasons FROM (SELECT *, len(reasons) = 0 AS eligible FROM eligibility) t"))
def eligibility(spark, d):
    return B.with_eligibility(session_table(spark, d)).select("session_id", us("ts").alias("ts_us"), "eligible", joined(c("reasons")).alias("reasons"))


@query("b01_entity_modes", O.behaviors(f"""SELECT 'asset_sensor' AS mode, {O.WIN}, count(*) AS n FROM rows_all GROUP BY {O.BY_WIN} UNION ALL
    SELECT 'host_sensor', src_ip, coalesce(sensor, ''), first_us - first_us % 900000000, count(*) FROM hard WHERE src_ip IS NOT NULL GROUP BY ALL UNION ALL
    SELECT 'host', src_ip, '', first_us - first_us % 900000000, count(*) FROM hard WHERE src_ip IS NOT NULL GROUP BY ALL"""))
def entity_modes(spark, d):
    out = None
    for mode in ("asset_sensor", "host_sensor", "host"):
        rows = B.with_behavior_key(session_table(spark, d), ASSET_15M, mode).groupBy(*B.KEY).agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(mode).alias("mode"), "entity", c("sensor_key").alias("sensor"), us("window_start").alias("window_us"), "n")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("b02_event_time", O.behaviors("SELECT window_us, count(*) AS n FROM rows_all GROUP BY 1"))
@query("b03_tumbling_window", O.behaviors("SELECT window_us, count(*) AS n FROM rows_all GROUP BY 1"))
def windows(spark, d):
    return B.with_behavior_key(session_table(spark, d)).groupBy(us("window_start").alias("window_us")).agg(F.count("*").alias("n"))


_BASE = """count(*) AS session_count, count(DISTINCT dst_ip) AS unique_destination_ip_count, count(DISTINCT dst_port) AS unique_destination_port_count,
    CAST(sum(coalesce(bytes, 0)) AS BIGINT) AS network_bytes_sum, CAST(sum(coalesce(packets, 0)) AS BIGINT) AS network_packets_sum,
    round(avg(coalesce(duration, 0.0)), 6) AS avg_session_duration, round(max(coalesce(duration, 0.0)), 6) AS max_session_duration"""


@query("b04_base_features", _win(_BASE))
def base(spark, d):
    return _features(spark, d, "session_count", "unique_destination_ip_count", "unique_destination_port_count", "network_bytes_sum", "network_packets_sum",
                     "avg_session_duration", "max_session_duration")


@query("b05_locality_features", _win("""count(*) FILTER (WHERE NOT d_in) AS external_destination_count, count(*) FILTER (WHERE d_in) AS internal_destination_count,
    count(*) FILTER (WHERE direction = 'inbound') AS inbound_count, count(*) FILTER (WHERE direction = 'outbound') AS outbound_count, count(*) FILTER (WHERE direction = 'internal') AS internal_count"""))
def locality(spark, d):
    return _features(spark, d, "external_destination_count", "internal_destination_count", "inbound_count", "outbound_count", "internal_count")


@query("b06_scope_features", _win(", ".join(f"count(*) FILTER (WHERE scope = '{s}') AS {s}_count" for s in B.SCOPES) + ", count(*) FILTER (WHERE scope IN ('same_subnet', 'same_spoke_cross_subnet')) AS same_spoke_count"))
def scopes(spark, d):
    return _features(spark, d, *[f"{s}_count" for s in B.SCOPES], "same_spoke_count")


@query("b07_external_features", _win("""count(DISTINCT CASE WHEN NOT s_in THEN src_ip END) AS unique_external_source_ip_count, count(DISTINCT CASE WHEN NOT d_in THEN dst_ip END) AS unique_external_destination_ip_count,
    count(DISTINCT CASE WHEN asset_side = 'destination' THEN src_ip ELSE dst_ip END) AS unique_counterpart_ip_count, count(DISTINCT CASE WHEN direction = 'inbound' THEN dst_port END) AS unique_inbound_destination_port_count,
    count(DISTINCT CASE WHEN direction = 'outbound' THEN dst_port END) AS unique_outbound_destination_port_count,
    count(*) FILTER (WHERE direction = 'inbound' AND (state = 'REJ' OR history = 'Hr')) AS rejected_inbound_count"""))
def external(spark, d):
    return _features(spark, d, "unique_external_source_ip_count", "unique_external_destination_ip_count", "unique_counterpart_ip_count",
                     "unique_inbound_destination_port_count", "unique_outbound_destination_port_count", "rejected_inbound_count")


def _with(section: str, first: dict[str, str], *types: str, extra: str = "") -> str:
    cols = ", ".join(f"{O.first_of(x, *types)} AS {f}" for f, x in first.items())
    listed = ", ".join(f"'{t}'" for t in types)
    return f", {section} AS (SELECT key, {cols}{extra} FROM prepared GROUP BY key HAVING count(*) FILTER (WHERE log_type IN ({listed})) > 0)"


_DNS = _with("dns", {"query": "query", "qtype_name": "qtype_name", "rcode_name": "rcode_name"}, "dns")


@query("b08_dns_features", _win("""count(q.key) AS dns_session_count, count(DISTINCT lower(query)) AS dns_unique_query_count, count(*) FILTER (WHERE rcode_name = 'NXDOMAIN') AS dns_nxdomain_count,
    coalesce(round(count(*) FILTER (WHERE rcode_name = 'NXDOMAIN') / nullif(count(q.key), 0), 6), 0.0) AS dns_nxdomain_ratio, count(*) FILTER (WHERE qtype_name = 'TXT') AS dns_txt_count,
    count(*) FILTER (WHERE length(query) >= 80) AS dns_long_query_count, CAST(coalesce(max(length(query)), 0) AS INT) AS dns_max_query_length,
    coalesce(round(avg(length(query)), 6), 0.0) AS dns_avg_query_length""", "used LEFT JOIN dns q ON q.key = used.key", _DNS))
def dns(spark, d):
    return _features(spark, d, "dns_session_count", "dns_unique_query_count", "dns_nxdomain_count", "dns_nxdomain_ratio", "dns_txt_count", "dns_long_query_count",
                     "dns_max_query_length", "dns_avg_query_length")


_HTTP = _with("http", {"host": "host", "user_agent": "user_agent", "status_code": "status_code", "response": "response_body_len"}, "http")


@query("b09_http_features", _win("""count(q.key) AS http_session_count, count(DISTINCT lower(host)) AS http_unique_host_count, count(DISTINCT user_agent) AS http_unique_user_agent_count,
    count(*) FILTER (WHERE status_code BETWEEN 400 AND 499) AS http_error_4xx_count, count(*) FILTER (WHERE status_code BETWEEN 500 AND 599) AS http_error_5xx_count,
    CAST(coalesce(sum(response), 0) AS BIGINT) AS http_response_body_bytes_sum,
    count(*) FILTER (WHERE q.key IS NOT NULL AND (response > 0 OR list_contains(log_types, 'files'))) AS http_download_count""", "used LEFT JOIN http q ON q.key = used.key", _HTTP))
def http(spark, d):
    return _features(spark, d, "http_session_count", "http_unique_host_count", "http_unique_user_agent_count", "http_error_4xx_count", "http_error_5xx_count",
                     "http_response_body_bytes_sum", "http_download_count")


_FILES = """, fl AS (SELECT key, count(DISTINCT fuid) AS fuids, count(DISTINCT md5) + count(DISTINCT sha1) AS hashes, coalesce(nullif(sum(total_bytes), 0), sum(seen_bytes)) AS size FROM prepared WHERE log_type = 'files' GROUP BY key),
    mimes AS (SELECT entity, sensor_key, window_us, count(DISTINCT lower(mime_type)) AS m FROM used JOIN prepared p USING (key) WHERE p.log_type = 'files' AND p.mime_type <> '' GROUP BY 1, 2, 3)"""


@query("b10_files_features", f"""WITH {O.BEH}{_FILES} SELECT entity, sensor_key AS sensor, window_us, CAST(coalesce(sum(fuids), 0) AS BIGINT) AS files_count, CAST(coalesce(sum(size), 0) AS BIGINT) AS files_total_bytes_sum,
    coalesce(any_value(m), 0) AS files_unique_mime_type_count, CAST(coalesce(sum(hashes), 0) AS BIGINT) AS files_hash_count
    FROM used LEFT JOIN fl ON fl.key = used.key LEFT JOIN mimes USING (entity, sensor_key, window_us) GROUP BY 1, 2, 3""")
def files(spark, d):
    return _features(spark, d, "files_count", "files_total_bytes_sum", "files_unique_mime_type_count", "files_hash_count")


from tidewatch.plans.session_queries import _TLS as _TLS_FIELDS, _merged_tls  # noqa: E402

_TLS = f", tl AS (SELECT key, {', '.join(_merged_tls(x) for x in _TLS_FIELDS)} FROM prepared GROUP BY key HAVING count(*) FILTER (WHERE log_type IN ('ssl', 'tls')) > 0), {_X509_STATS}"


@query("b11_tls_features", _win("""count(t.key) AS tls_session_count, count(DISTINCT lower(server_name)) AS tls_unique_sni_count,
    count(*) FILTER (WHERE validation_status <> 'ok') AS tls_invalid_cert_count, count(*) FILTER (WHERE NOT sni_matches_cert) AS tls_sni_mismatch_count,
    count(*) FILTER (WHERE t.key IS NOT NULL AND (validation_status LIKE '%self%' OR coalesce(list_has_any(issuers, subjects), false))) AS tls_self_signed_count,
    count(*) FILTER (WHERE t.key IS NOT NULL AND (validation_status LIKE '%expired%' OR oldest < first_us / 1000000.0)) AS tls_expired_cert_count,
    count(*) FILTER (WHERE resumed) AS tls_resumed_count""", "used LEFT JOIN tl t ON t.key = used.key LEFT JOIN xf ON xf.key = used.key", _TLS))
def tls(spark, d):
    return _features(spark, d, "tls_session_count", "tls_unique_sni_count", "tls_invalid_cert_count", "tls_sni_mismatch_count", "tls_self_signed_count",
                     "tls_expired_cert_count", "tls_resumed_count")


_SSH = _with("sh", {"ok": "auth_success", "tries": "auth_attempts"}, "ssh")


@query("b12_ssh_features", _win("""count(q.key) AS ssh_session_count, count(*) FILTER (WHERE q.key IS NOT NULL AND (NOT d_in OR direction = 'outbound')) AS ssh_external_session_count,
    count(*) FILTER (WHERE q.key IS NOT NULL AND dst_port <> 22) AS ssh_nonstandard_port_count, count(*) FILTER (WHERE ok) AS ssh_auth_success_count,
    CAST(coalesce(sum(tries), 0) AS BIGINT) AS ssh_auth_attempt_sum""", "used LEFT JOIN sh q ON q.key = used.key", _SSH))
def ssh(spark, d):
    return _features(spark, d, "ssh_session_count", "ssh_external_session_count", "ssh_nonstandard_port_count", "ssh_auth_success_count", "ssh_auth_attempt_sum")


_NW = ", nw AS (SELECT key, count(DISTINCT note) AS notes, count(DISTINCT CASE WHEN log_type = 'weird' THEN name END) AS weirds, bool_or(log_type = 'notice') AS n, bool_or(log_type = 'weird') AS w FROM prepared GROUP BY key)"


@query("b13_notice_weird", _win("CAST(coalesce(sum(CASE WHEN n THEN greatest(1, notes) END), 0) AS BIGINT) AS notice_count, CAST(coalesce(sum(CASE WHEN w THEN greatest(1, weirds) END), 0) AS BIGINT) AS weird_count",
                                "used JOIN nw ON nw.key = used.key", _NW))
def notice_weird(spark, d):
    return _features(spark, d, "notice_count", "weird_count")


@query("b14_log_type_presence", O.sessions("SELECT t AS log_type, count(*) AS n FROM (SELECT unnest(log_types) AS t FROM sess) x WHERE t IN ('dns', 'http', 'ssh', 'notice', 'weird', 'files') GROUP BY 1"))
def presence(spark, d):
    s = session_table(spark, d)
    names = ("dns", "http", "ssh", "notice", "weird", "files")
    flags = F.filter(F.array(*[F.when(B._has(n), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    return s.select(F.explode(flags).alias("log_type")).groupBy("log_type").agg(F.count("*").alias("n"))


@query("b15_top_lists", O.behaviors(f"""SELECT {O.WIN}, string_agg(dst_ip || '=' || n, '|' ORDER BY n DESC, dst_ip) AS top_ips FROM (SELECT *, row_number() OVER (PARTITION BY {O.BY_WIN} ORDER BY n DESC, dst_ip) AS r FROM (
    SELECT {O.BY_WIN}, dst_ip, count(*) AS n FROM used WHERE dst_ip IS NOT NULL GROUP BY {O.BY_WIN}, dst_ip) a) b WHERE r <= 10 GROUP BY {O.BY_WIN}"""))
def top_lists(spark, d):
    b = behavior_table(spark, d).where("quality.session_count_used > 0")
    text = F.array_join(F.transform("human.top_destination_ips", lambda t: F.concat(t["value"], F.lit("="), t["count"].cast("string"))), "|")
    return b.select("entity", F.coalesce("sensor", F.lit("")).alias("sensor"), us("window_start").alias("window_us"), text.alias("top_ips"))


@query("b16_session_refs", _win("count(*) AS refs, min(session_id) AS first_id"))
def refs(spark, d):
    rows = B.session_ref_rows(session_table(spark, d)).groupBy(*B.KEY).agg(F.count("*").alias("refs"), F.min("session_id").alias("first_id"))
    return rows.select("entity", c("sensor_key").alias("sensor"), us("window_start").alias("window_us"), "refs", "first_id")


@query("b17_quality", _win("count(*) AS total, count(*) FILTER (WHERE eligible) AS used, count(*) FILTER (WHERE NOT eligible) AS excluded, "
                           "100 - CASE WHEN count(*) FILTER (WHERE NOT eligible) > 0 THEN 5 ELSE 0 END - CASE WHEN count(*) FILTER (WHERE eligible) = 0 THEN 5 ELSE 0 END AS score", "rows_all"))
def quality(spark, d):
    return behavior_table(spark, d).select(
        "entity", F.coalesce("sensor", F.lit("")).alias("sensor"), us("window_start").alias("window_us"), c("quality.session_count_total").alias("total"),
        c("quality.session_count_used").alias("used"), c("quality.excluded_session_count").alias("excluded"), c("quality.data_quality_score").alias("score"))


@query("b18_feature_vector", _win("65 AS length, CAST(count(*) FILTER (WHERE eligible) AS DOUBLE) AS first_value, count(*) FILTER (WHERE eligible) >= 2 AS ready", "rows_all"))
def vector(spark, d):
    return behavior_table(spark, d).select("entity", F.coalesce("sensor", F.lit("")).alias("sensor"), us("window_start").alias("window_us"),
                                           F.size("ml.feature_vector").alias("length"), F.get("ml.feature_vector", F.lit(0)).alias("first_value"), c("ml.ready").alias("ready"))


@query("b19_behavior_document", O.behaviors("""SELECT 'asset_15m_v1|' || sensor_key || '|' || entity || '|' || strftime(make_timestamp(window_us), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS behavior_id,
    window_us, window_us + 900000000 AS window_end_us, arg_min('local_asset.ip' || CASE WHEN sensor_key <> '' THEN '+sensor.name' ELSE '' END || ':' || asset_side, (first_us, session_id)) AS entity_type
    FROM rows_all GROUP BY entity, sensor_key, window_us"""))
def document(spark, d):
    return behavior_table(spark, d).select("behavior_id", us("window_start").alias("window_us"), us("window_end").alias("window_end_us"), "entity_type")


@query("j06_affected_windows", O.behaviors(f"SELECT count(*) AS n, min(ts_us) AS first_us FROM rows_all WHERE ({O.BY_WIN}) IN (SELECT {O.BY_WIN} FROM rows_all WHERE list_contains(log_types, 'notice'))"))
def affected(spark, d):
    s = session_table(spark, d)
    return B.affected_sessions(s, s.where("has_notice")).agg(F.count("*").alias("n"), F.min(us("ts")).alias("first_us"))


@query("j07_state_preservation", O.behaviors(f"SELECT n % 2 = 0 AS preserved, CASE WHEN n % 2 = 0 THEN 'scored' ELSE 'not_scored' END AS status, count(*) AS windows FROM (SELECT count(*) AS n FROM rows_all GROUP BY {O.BY_WIN}) t GROUP BY 1, 2"))
def preservation(spark, d):
    b = behavior_table(spark, d)
    odd = c("quality.session_count_total") % 2 == 1
    old = b.withColumn("ml", c("ml").withField("scoring_status", F.lit("scored")).withField(
        "feature_vector", F.transform("ml.feature_vector", lambda v: F.when(odd, v + 1).otherwise(v + 1e-12))))
    kept = B.preserve_ml_state(b, old)
    return kept.groupBy(c("ml_state_preserved").alias("preserved"), c("ml.scoring_status").alias("status")).agg(F.count("*").alias("windows"))
