"""Scan, parse, route and noise queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import settings as S
from tidewatch.operators import ingest as G
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.views import epoch, joined, parsed_lines
from tidewatch.sources import logs as L, tables as T
from tidewatch.sources.adapters import raw_logs, log_lines

c = F.col
_OK = "e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7"
_TYPE = """CASE e % 7 WHEN 0 THEN 'conn' WHEN 1 THEN 'dns' WHEN 2 THEN 'http' WHEN 3 THEN 'stats' WHEN 4 THEN 'conn-summary' WHEN 5 THEN 'ssl' ELSE 'weird' END"""


@query("s01_tailed_files", O.lines("SELECT file, count(*) AS n FROM lines WHERE e % 7 IN (0, 1, 6) GROUP BY file"))
def tailed_files(spark, d):
    return log_lines(spark, d).where(L.tailed_file(c("file"))).groupBy("file").agg(F.count("*").alias("n"))


@query("s02_safe_json_parse", O.lines(f"""SELECT e AS file_offset, NOT ({_OK}) AS parse_error, CASE WHEN NOT ({_OK}) THEN 'zeek_parse_json' END AS stage,
    CASE WHEN NOT ({_OK}) THEN value END AS raw_message FROM lines"""))
def safe_parse(spark, d):
    return parsed_lines(spark, d).select("file_offset", "parse_error", c("parse_error_stage").alias("stage"), "raw_message")


@query("s03_dead_letters", O.lines(f"""SELECT e AS file_offset, value AS raw_message, 'zeek_parse_json' AS parse_error_stage, file,
    CASE WHEN value = '' THEN 'empty line' ELSE 'not a JSON object' END AS parse_error_reason FROM lines WHERE NOT ({_OK})"""))
def dead_letters(spark, d):
    return L.dead_letters(parsed_lines(spark, d))


@query("s04_event_time", O.lines(f"""SELECT 'R' || e AS raw_id, CASE WHEN e % 11 <> 3 THEN (1704067200 + e * 3) * 1000000 + (e % 1000) * 1000 ELSE 1704067200000000 END AS us FROM lines WHERE {_OK}"""))
def event_time(spark, d):
    rows = L.to_raw_logs(L.valid_lines(parsed_lines(spark, d)), "s1", epoch())
    return rows.select("raw_id", F.unix_micros("ts").alias("us"))


@query("s05_log_type_from_path", O.lines(f"SELECT {_TYPE} AS log_type, count(*) AS n FROM lines GROUP BY 1"))
def log_type(spark, d):
    return log_lines(spark, d).groupBy(L.log_type_from_path(c("file")).alias("log_type")).agg(F.count("*").alias("n"))


@query("s06_ingest_stamp", O.lines(f"SELECT 's1' AS sensor, 1704067200000000 AS ingest_us, count(*) AS n FROM lines WHERE {_OK}"))
def ingest_stamp(spark, d):
    rows = L.to_raw_logs(L.valid_lines(parsed_lines(spark, d)), "s1", epoch())
    return rows.groupBy("sensor", F.unix_micros("ingest_ts").alias("ingest_us")).agg(F.count("*").alias("n"))


@query("s07_type_coercion", O.lines(f"""SELECT 'R' || e AS raw_id, CAST(k % 4 AS STRING) AS rcode, CAST(k % 2 AS STRING) AS opcode,
    CASE WHEN k % 2 = 0 THEN 'one' || k ELSE 'a' || k || '|b' END AS answers FROM lines WHERE {_OK}"""))
def coercion(spark, d):
    rows = L.to_raw_logs(L.valid_lines(parsed_lines(spark, d)), "s1", epoch())
    return rows.select("raw_id", "rcode", "opcode", joined(c("answers")).alias("answers"))


@query("s08_rename_keys", O.raw("""SELECT raw_id, us AS timestamp_us, coalesce(http_method, method) AS http_method, CASE WHEN http_method IS NOT NULL THEN method END AS method,
    status_code AS http_status, request_body_len AS http_request_bytes, url_path, uri, user_agent AS user_agent_name FROM raw"""))
def rename_keys(spark, d):
    return G.rename_keys(raw_logs(spark, d)).select(
        "raw_id", F.unix_micros("timestamp").alias("timestamp_us"), "http_method", "method", "http_status", "http_request_bytes", "url_path", "uri", "user_agent_name")


@query("s09_constant_defaults", O.raw("SELECT CASE WHEN log_type = 'quic' THEN 'unknown' ELSE log_type END AS log_type, 'logs' AS data_stream_type, 'zeek' AS data_stream_dataset, count(*) AS n FROM raw GROUP BY 1"))
def defaults(spark, d):
    rows = raw_logs(spark, d).withColumn("log_type", F.nullif(c("log_type"), F.lit("quic")))
    return G.with_defaults(rows).groupBy("log_type", "data_stream_type", "data_stream_dataset").agg(F.count("*").alias("n"))


@query("s10_content_routing", O.raw("""SELECT CASE WHEN log_type IN ('smb_files', 'smb_mapping') THEN 'smb' WHEN log_type IN ('conn', 'dns', 'http', 'ssl', 'files', 'weird', 'notice', 'x509', 'ssh', 'ftp', 'ldap') THEN log_type
    ELSE 'other' END AS route, CAST(make_timestamp(us) AS DATE) AS event_date, count(*) AS n FROM raw GROUP BY 1, 2"""))
def routing(spark, d):
    return G.with_route(raw_logs(spark, d)).groupBy("route", "event_date").agg(F.count("*").alias("n"))


@query("s12_incremental_scan", O.raw("""SELECT raw_id, count(*) AS n FROM raw WHERE CASE WHEN k % 5 = 0 THEN us ELSE us + 60000000 END BETWEEN (SELECT max(us) FROM raw) - 3600000000 AND (SELECT max(us) FROM raw) GROUP BY raw_id"""))
def incremental(spark, d):
    rows = raw_logs(spark, d)
    k = F.get_json_object("doc", "$.k").cast("int")
    rows = rows.withColumn("ingest_ts", F.when(k % 5 != 0, c("ingest_ts")))
    last = rows.agg(F.max("ts")).scalar()
    return L.changed_rows(rows, "ingest_ts", "ts", last - F.make_dt_interval(hours=F.lit(1)), last).groupBy("raw_id").agg(F.count("*").alias("n"))


@query("s13_date_partition", O.raw("SELECT CAST(make_timestamp(us) AS DATE) AS event_date, count(*) AS n FROM raw GROUP BY 1"))
def date_partition(spark, d):
    return T.with_event_date(raw_logs(spark, d), "ts").groupBy("event_date").agg(F.count("*").alias("n"))


@query("f01_drop_junk", O.lines(f"SELECT log_type, count(*) AS n FROM (SELECT {_TYPE} AS log_type FROM lines WHERE {_OK}) t WHERE log_type NOT IN ('stats', 'conn-summary') GROUP BY 1"))
def drop_junk(spark, d):
    rows = L.valid_lines(parsed_lines(spark, d)).select(L.log_type_from_path(c("file")).alias("log_type"))
    return G.drop_junk(rows).groupBy("log_type").agg(F.count("*").alias("n"))


def _edges(rows):
    return rows.groupBy("log_type").agg(F.count("*").alias("n"))


@query("f02_drop_platform_ips", O.raw("SELECT log_type, count(*) AS n FROM raw WHERE coalesce(resp_h, '') <> '10.51.3.1' AND coalesce(orig_h, '') <> '10.51.3.1' GROUP BY 1"))
def drop_platform(spark, d):
    # The platform addresses never occur in the view; one of its own addresses stands in for them.
    swap = lambda n: F.when(c(n) == "10.51.3.1", S.PLATFORM_IPS[0]).otherwise(c(n))
    return _edges(G.drop_platform_ips(raw_logs(spark, d).withColumns({"orig_h": swap("orig_h"), "resp_h": swap("resp_h")})))


@query("f03_drop_own_export", O.raw("SELECT log_type, count(*) AS n FROM raw WHERE NOT (coalesce(orig_h, '') = '10.51.2.11' AND coalesce(resp_h, '') = '10.51.3.2' AND coalesce(resp_p, 0) = 22) GROUP BY 1"))
def drop_own_export(spark, d):
    return _edges(G.drop_own_export(raw_logs(spark, d), "10.51.2.11", "10.51.3.2", 22))


@query("f04_drop_broadcast", O.raw("SELECT log_type, count(*) AS n FROM raw WHERE coalesce(resp_h, '') <> 'ff02::1' GROUP BY 1"))
def drop_broadcast(spark, d):
    return _edges(G.drop_broadcast(raw_logs(spark, d)))


@query("f05_drop_agent_software", O.raw("SELECT log_type, count(*) AS n FROM raw WHERE NOT (log_type = 'http' AND k % 3 = 0 AND host = 'h6.Example.com') GROUP BY 1"))
def drop_agent(spark, d):
    k = F.get_json_object("doc", "$.k").cast("int")
    rows = raw_logs(spark, d).withColumn("kind0", c("log_type"))
    rows = rows.withColumns({"log_type": F.when((c("log_type") == "http") & (k % 3 == 0), "software").otherwise(c("log_type")),
                             "name": F.when((c("log_type") == "http") & (k % 3 == 0), S.AGENT_SOFTWARE_NAME).otherwise(c("name"))})
    return G.drop_agent_software(rows, "h6.Example.com").groupBy(c("kind0").alias("log_type")).agg(F.count("*").alias("n"))


@query("f06_drop_reset_noise", O.raw("SELECT log_type, count(*) AS n FROM raw WHERE NOT coalesce(resp_h IN ('10.51.3.1', '10.51.3.2') AND orig_h = '10.51.2.11' AND resp_p = 22 AND conn_state = 'OTH' AND g % 7 = 0, false) GROUP BY 1"))
def drop_reset(spark, d):
    rows = raw_logs(spark, d).withColumn("history", F.when(c("history") == "Hr", "R").otherwise(c("history")))
    return _edges(G.drop_reset_noise(rows, "10.51.2.11", ("10.51.3.1", "10.51.3.2"), 22))


@query("f07_mark_package_noise", O.raw("SELECT raw_id, ndr_noise, ndr_noise_type, ndr_noise_reason FROM raw"))
def mark_noise(spark, d):
    rows = raw_logs(spark, d).drop("ndr_noise", "ndr_noise_type", "ndr_noise_reason")
    rows = rows.withColumns({"ndr_noise_type": F.lit(None).cast("string"), "ndr_noise_reason": F.lit(None).cast("string")})
    return G.mark_package_noise(rows).select("raw_id", "ndr_noise", "ndr_noise_type", "ndr_noise_reason")


@query("s00_clean_chain", O.raw("SELECT log_type, ndr_noise, count(*) AS n FROM raw WHERE coalesce(resp_h, '') <> 'ff02::1' GROUP BY 1, 2"))
def clean_chain(spark, d):
    return G.clean(raw_logs(spark, d), "10.0.0.1", "10.0.0.2", 2021).groupBy("log_type", "ndr_noise").agg(F.count("*").alias("n"))


@query("u01_overlap_union", O.raw("SELECT raw_id, min(us) AS us FROM raw GROUP BY raw_id"))
def overlap_union(spark, d):
    rows = raw_logs(spark, d).select("raw_id", "ts")
    cut = rows.agg(F.max("ts")).scalar() - F.make_dt_interval(secs=F.lit(S.DEFAULTS.session_overlap_seconds))
    return rows.unionByName(rows.where(c("ts") >= cut)).dropDuplicates(["raw_id"]).select("raw_id", F.unix_micros("ts").alias("us"))


@query("u02_array_union", O.raw("SELECT raw_id, CASE WHEN k % 5 = k % 3 THEN '10.0.0.' || (k % 5) || '|10.0.1.' || (k % 3) ELSE '10.0.0.' || (k % 5) || '|10.0.1.' || (k % 3) END || '|10.0.9.9' AS items FROM raw WHERE log_type = 'dns'"))
def array_union(spark, d):
    from tidewatch.operators.merge import merge_values
    rows = raw_logs(spark, d).where("log_type = 'dns'")
    kind = rows.schema["answers"].dataType
    new = F.concat(F.slice("answers", 2, 1), F.array(F.lit("10.0.9.9")))
    return rows.select("raw_id", joined(merge_values(kind, c("answers"), new)).alias("items"))


@query("u03_expected_minus_observed", O.raw("SELECT x AS missing FROM (SELECT unnest(['conn', 'dns', 'kerberos', 'rdp', 'ssh']) AS x) t WHERE x NOT IN (SELECT log_type FROM raw)"))
def expected_minus_observed(spark, d):
    from tidewatch.operators.health import missing_values
    return missing_values(raw_logs(spark, d), "log_type", ("conn", "dns", "kerberos", "rdp", "ssh")).select(F.explode("missing").alias("missing"))


@query("u04_noise_intersection", O.raw("SELECT raw_id, CASE WHEN log_type = 'dhcp' THEN 'dhcp' END AS noise FROM raw"))
def noise_intersection(spark, d):
    words = F.array(*[F.lit(t) for t in S.NOISE_TOKENS])
    return raw_logs(spark, d).select("raw_id", joined(F.array_intersect(F.array("log_type", F.lit("x")), words)).alias("noise"))


@query("t04_multi_valued_terms", O.sessions("SELECT t AS value, count(*) AS n FROM (SELECT unnest(log_types) AS t FROM sess) x GROUP BY 1"))
def multi_terms(spark, d):
    from tidewatch.plans.views import sessions
    return sessions(spark, d).select(F.explode("log_types").alias("value")).groupBy("value").agg(F.count("*").alias("n"))


@query("t05_latest_timestamp", O.raw("SELECT max(us) AS us FROM raw"))
def latest_timestamp(spark, d):
    from tidewatch.operators.health import latest
    return latest(raw_logs(spark, d)).select(F.unix_micros("latest").alias("us"))


@query("t06_count_with_predicate", O.raw("SELECT count(*) AS n FROM raw WHERE log_type = 'dns' AND rcode_name = 'NXDOMAIN'"))
def count_predicate(spark, d):
    return raw_logs(spark, d).where("log_type = 'dns' and rcode_name = 'NXDOMAIN'").agg(F.count("*").alias("n"))


@query("t07_cardinality", O.raw("SELECT log_type, count(DISTINCT resp_p) AS ports FROM raw GROUP BY 1"))
def cardinality(spark, d):
    return raw_logs(spark, d).groupBy("log_type").agg(F.count_distinct("resp_p").alias("ports"))


@query("t07_cardinality_approximate")
def cardinality_approx(spark, d):
    return raw_logs(spark, d).groupBy("log_type").agg(F.approx_count_distinct("resp_p").alias("ports"))


@query("t02_terms_with_missing", O.raw("SELECT coalesce(conn_state, '__missing__') AS value, count(*) AS n FROM raw GROUP BY 1 ORDER BY n DESC, value LIMIT 4"))
def terms_missing(spark, d):
    from tidewatch.operators.health import terms
    return terms(raw_logs(spark, d), c("conn_state"), 4)


@query("t09_field_type_check")
def field_types(spark, d):
    from tidewatch.schemas import RAW_COLUMNS, schema_rows
    return schema_rows(raw_logs(spark, d), RAW_COLUMNS)
