"""Scalar column helpers, run as bulk jobs over the telemetry views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import ip as I, protocols as P, values as V
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.views import joined, parsed_lines
from tidewatch.sources.adapters import flow_lines, raw_logs, spark_sql, FLOWS_SQL
from tidewatch.sources.logs import valid_lines
from tidewatch.operators.flows import ALIASES, get_first, parse_flow_lines

c = F.col


@query("n01_get_field", O.lines("""SELECT 'R' || e AS raw_id, CASE WHEN e % 3 = 2 THEN NULL ELSE src_ip END AS orig_h,
    CASE WHEN e % 3 = 2 THEN NULL ELSE g % 30000 + 1024 END AS orig_p, dst_port AS resp_p FROM lines WHERE e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7"""))
def get_field(spark, d):
    v = c("v")
    return valid_lines(parsed_lines(spark, d)).select(
        P.get_field(v, "raw_id").alias("raw_id"), P.get_field(v, "id.orig_h").alias("orig_h"),
        P.get_field(v, "id.orig_p", "bigint").alias("orig_p"), P.get_field(v, "id.resp_p", "bigint").alias("resp_p"))


@query("n02_first_present", O.raw("""SELECT raw_id, coalesce(nullif(service, ''), nullif(rcode, ''), rcode_name, uri, url_path, 'none') AS picked,
    coalesce(answers[1], san_dns[1], actions[1]) AS first_item FROM raw"""))
def first_present(spark, d):
    lists = V.first_present_list(c("answers"), c("san_dns"), c("actions"))
    return raw_logs(spark, d).select(
        "raw_id", V.first_present(c("service"), c("rcode"), c("rcode_name"), c("uri"), c("url_path"), F.lit("none")).alias("picked"),
        F.get(lists, F.lit(0)).alias("first_item"))


@query("n03_as_list", O.lines("""SELECT 'R' || e AS raw_id, CASE WHEN k % 2 = 0 THEN 'one' || k ELSE 'a' || k || '|b' END AS answers FROM lines
    WHERE e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7"""))
def as_list(spark, d):
    v = c("v")
    return valid_lines(parsed_lines(spark, d)).select(P.get_field(v, "raw_id").alias("raw_id"), joined(P.get_list(v, "answers")).alias("answers"))


@query("n04_unique_values", O.raw("""SELECT raw_id, CASE WHEN log_type = 'dns' THEN CASE WHEN k % 5 = k % 3 THEN '10.0.0.' || (k % 5) || '|10.0.1.' || (k % 3) || '|' || query
    ELSE '10.0.0.' || (k % 5) || '|10.0.1.' || (k % 3) || '|' || query END WHEN log_type = 'http' THEN host ELSE NULL END AS items FROM raw"""))
def unique_values(spark, d):
    items = F.concat(F.coalesce("answers", F.array().cast("array<string>")), F.array("query", "host", "query", F.lit("")),
                     F.coalesce("answers", F.array().cast("array<string>")))
    return raw_logs(spark, d).select("raw_id", joined(V.unique_values(items)).alias("items"))


@query("n05_safe_int_strict", O.lines("""SELECT e, CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS strict_value, k AS lenient_value, CAST(k AS DOUBLE) AS float_value
    FROM lines WHERE e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7"""))
@query("n06_safe_int_lenient", O.lines("""SELECT e, CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS strict_value, k AS lenient_value, CAST(k AS DOUBLE) AS float_value
    FROM lines WHERE e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7"""))
@query("n07_safe_float", O.lines("""SELECT e, CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS strict_value, k AS lenient_value, CAST(k AS DOUBLE) AS float_value
    FROM lines WHERE e % 97 <> 5 AND e % 101 <> 6 AND e % 103 <> 7"""))
def safe_numbers(spark, d):
    text = P.get_field(c("v"), "orig_bytes")
    return valid_lines(parsed_lines(spark, d)).select(
        c("file_offset").alias("e"), V.safe_int_strict(text).alias("strict_value"), V.safe_int_lenient(text).alias("lenient_value"),
        V.safe_float(text).alias("float_value"))


@query("n08_safe_bool", O.raw("""SELECT raw_id, k % 3 = 0 AND k % 2 = 0 OR k % 7 = 0 AS truthy FROM raw"""))
def safe_bool(spark, d):
    k = F.get_json_object("doc", "$.k").cast("int")
    text = F.when(k % 7 == 0, " Success ").when((k % 3 == 0) & (k % 2 == 0), "YES").when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("no"), k.cast("string")))
    return raw_logs(spark, d).select("raw_id", V.safe_bool(text).alias("truthy"))


@query("n09_parse_ts", O.raw("""SELECT raw_id, CASE WHEN k % 4 = 3 THEN NULL WHEN k % 4 = 2 THEN us - us % 1000000 ELSE us END AS us FROM raw"""))
def parse_ts(spark, d):
    k = F.get_json_object("doc", "$.k").cast("int")
    text = (
        F.when(k % 4 == 0, V.iso_millis(c("ts"))).when(k % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
        .when(k % 4 == 2, F.unix_seconds("ts").cast("string")).otherwise("yesterday"))
    return raw_logs(spark, d).select("raw_id", F.unix_micros(V.parse_ts(text)).alias("us"))


@query("n10_isoformat", O.raw("SELECT raw_id, strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(us // 1000 % 1000 AS STRING), 3, '0') || 'Z' AS iso FROM raw"))
def isoformat(spark, d):
    return raw_logs(spark, d).select("raw_id", V.iso_millis(c("ts")).alias("iso"))


@query("n11_floor_time", O.raw("SELECT raw_id, us // 1000000 - us // 1000000 % 900 AS start_s FROM raw"))
def floor_time(spark, d):
    return raw_logs(spark, d).select("raw_id", F.unix_seconds(V.floor_time(c("ts"), 900)).alias("start_s"))


@query("n12_safe_log_type", O.raw("""SELECT raw_id, CASE WHEN k % 9 = 0 THEN 'unknown' ELSE log_type || '__x' END AS name FROM raw"""))
def safe_log_type(spark, d):
    k = F.get_json_object("doc", "$.k").cast("int")
    text = F.when(k % 9 == 0, "  ").otherwise(F.concat(F.lit(" "), F.upper("log_type"), F.lit(".$X ")))
    return raw_logs(spark, d).select("raw_id", V.safe_log_type(text).alias("name"))


@query("n13_synthetic_session_id", O.raw(f"SELECT raw_id, {O._SYNTH} AS sid FROM raw WHERE log_type <> 'x509'"))
def synthetic_id(spark, d):
    rows = raw_logs(spark, d).where("log_type <> 'x509'")
    sid = V.synthetic_session_id(
        c("sensor"), c("log_type"), V.iso_millis(V.floor_time(c("ts"), 60)), V.first_present(c("orig_h"), c("src")),
        F.coalesce("orig_p", "p"), V.first_present(c("resp_h"), c("dst")), c("resp_p"))
    return rows.select("raw_id", sid.alias("sid"))


_IPS = """SELECT raw_id, ip, CASE WHEN ip IS NULL THEN NULL WHEN ip = 'not-an-ip' THEN 'invalid_ip' WHEN ip LIKE 'ff02::%' THEN 'multicast'
    WHEN ip LIKE 'fd00::%' OR ip LIKE '10.%' THEN 'private' ELSE 'public' END AS class,
    CASE WHEN ip IS NULL OR ip = 'not-an-ip' THEN NULL ELSE ip LIKE 'ff02::%' OR ip LIKE 'fd00::%' OR ip LIKE '10.%' END AS local
    FROM (SELECT raw_id, orig_h AS ip FROM raw UNION ALL SELECT raw_id, resp_h FROM raw) t"""


@query("n14_ip_classification", O.raw(_IPS))
def ip_classification(spark, d):
    raw = raw_logs(spark, d)
    ips = raw.select("raw_id", c("orig_h").alias("ip")).unionAll(raw.select("raw_id", c("resp_h").alias("ip")))
    ips = I.with_parsed_ips(ips, a=c("ip"))
    p = I.parsed("a", c("ip"))
    return ips.select("raw_id", "ip", I.class_test(p).alias("class"), I.local_test(p, ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")).alias("local"))


@query("n15_direction_from_local", O.raw("""SELECT raw_id, CASE WHEN local_orig AND local_resp THEN 'internal' WHEN local_orig AND NOT local_resp THEN 'outbound'
    WHEN NOT local_orig AND local_resp THEN 'inbound' ELSE 'external_or_unknown' END AS direction FROM raw"""))
def direction(spark, d):
    return raw_logs(spark, d).select("raw_id", I.direction_from_local(c("local_orig"), c("local_resp")).alias("direction"))


@query("n16_flow_direction", O.flows(f"""SELECT l_orderkey, l_linenumber, CASE WHEN s AND NOT t THEN 'outbound' WHEN NOT s AND t THEN 'inbound' WHEN s AND t THEN 'internal'
    WHEN NOT s AND NOT t THEN 'external' END AS direction FROM (SELECT l_orderkey, l_linenumber, {O.private('src_ip')} AS s, {O.private('dst_ip')} AS t FROM flow) x"""))
def flow_direction(spark, d):
    rows = spark_sql(spark, d, FLOWS_SQL)
    rows = I.with_parsed_ips(rows, s=c("src_ip"), d=c("dst_ip"))
    s, t = (F.when(p.valid, p.private()) for p in (I.parsed("s", c("src_ip")), I.parsed("d", c("dst_ip"))))
    return rows.select("l_orderkey", "l_linenumber", I.flow_direction(s, t).alias("direction"))


@query("n17_service_tokens", O.raw("""SELECT raw_id, CASE WHEN log_type <> 'conn' THEN NULL ELSE CASE service WHEN 'ssl' THEN 'tls' WHEN 'SSL, http' THEN 'tls|http' ELSE nullif(service, '') END END AS tokens FROM raw"""))
def service_tokens(spark, d):
    return raw_logs(spark, d).select("raw_id", joined(P.service_tokens(c("service"))).alias("tokens"))


@query("n18_canonical_protocol", O.raw("""SELECT raw_id, CASE service WHEN 'ssl' THEN 'tls' WHEN 'SSL, http' THEN 'http' ELSE nullif(service, '') END AS protocol FROM raw"""))
def canonical_protocol(spark, d):
    return raw_logs(spark, d).select("raw_id", P.canonical_protocol(P.service_tokens(c("service"))).alias("protocol"))


@query("n19_infer_service", O.raw("""SELECT raw_id, CASE log_type WHEN 'http' THEN 'http' WHEN 'dns' THEN 'dns' WHEN 'ssl' THEN 'tls' WHEN 'ssh' THEN 'ssh' WHEN 'ftp' THEN 'ftp'
    WHEN 'smtp' THEN 'smtp' WHEN 'ldap' THEN 'ldap' WHEN 'irc' THEN 'irc' ELSE CASE resp_p WHEN 53 THEN 'dns' WHEN 80 THEN 'http' WHEN 443 THEN 'tls' WHEN 22 THEN 'ssh'
    WHEN 21 THEN 'ftp' WHEN 25 THEN 'smtp' WHEN 389 THEN 'ldap' WHEN 636 THEN 'ldaps' END END AS service FROM raw"""))
def infer_service(spark, d):
    return raw_logs(spark, d).select("raw_id", P.infer_service(F.array("log_type"), c("resp_p")).alias("service"))


@query("n20_harden_protocol", O.hardened("SELECT session_id, ts_us, protocol FROM hard"))
def harden_protocol(spark, d):
    from tidewatch.operators.hardening import harden_protocol as harden
    from tidewatch.plans.views import sessions
    return harden(sessions(spark, d)).select("session_id", F.unix_micros("ts").alias("ts_us"), "protocol")


@query("n21_dns_text_features", O.raw("""SELECT raw_id, CAST(length(query) AS INT) AS query_length, CAST(len(string_split(query, '.')) - CASE WHEN k = 0 THEN 1 ELSE 0 END AS INT) AS label_count,
    CAST(greatest(k, 7) AS INT) AS longest_label_length, k % 10 = 0 AS is_txt, k % 4 = 0 AS is_nxdomain FROM raw WHERE log_type = 'dns'"""))
def dns_features(spark, d):
    labels = P.dns_labels(c("query"))
    return raw_logs(spark, d).where("log_type = 'dns'").select(
        "raw_id", F.length("query").alias("query_length"), F.size(labels).alias("label_count"), P.longest(labels).alias("longest_label_length"),
        (c("qtype_name") == "TXT").alias("is_txt"), (c("rcode_name") == "NXDOMAIN").alias("is_nxdomain"))


@query("n22_null_pruning", O.raw("""SELECT raw_id, CASE WHEN nullif(service, '') IS NOT NULL THEN '{"s":"' || service || '","r":"' || raw_id || '"}' ELSE '{"r":"' || raw_id || '"}' END AS pruned,
    CASE WHEN service IS NOT NULL THEN '{"s":"' || service || '","r":"' || raw_id || '"}' ELSE '{"r":"' || raw_id || '"}' END AS kept_blank FROM raw"""))
def null_pruning(spark, d):
    return raw_logs(spark, d).select(
        "raw_id", F.to_json(F.struct(V.blank_to_null(c("service")).alias("s"), c("raw_id").alias("r")), {"ignoreNullFields": "true"}).alias("pruned"),
        F.to_json(F.struct(c("service").alias("s"), c("raw_id").alias("r")), {"ignoreNullFields": "true"}).alias("kept_blank"))


@query("n23_normalize_proto", O.flows("""SELECT l_orderkey, l_linenumber, CASE proto WHEN '6' THEN 'tcp' WHEN '17' THEN 'udp' WHEN 'TCP' THEN 'tcp' ELSE proto END AS transport,
    CASE proto WHEN 'TCP' THEN '6' WHEN 'icmp' THEN '1' WHEN 'weirdo' THEN NULL ELSE proto END AS iana FROM flow"""))
def normalize_proto(spark, d):
    return spark_sql(spark, d, FLOWS_SQL).select("l_orderkey", "l_linenumber", P.transport_name(c("proto")).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@query("n24_ns_to_iso", O.flows("SELECT l_orderkey, l_linenumber, start_ns // 1000 AS start_us, end_ns // 1000 AS end_us FROM flow"))
def ns_to_iso(spark, d):
    return spark_sql(spark, d, FLOWS_SQL).select("l_orderkey", "l_linenumber", F.unix_micros(V.ns_to_ts(c("start_ns"))).alias("start_us"),
                                                 F.unix_micros(V.ns_to_ts(c("end_ns"))).alias("end_us"))


@query("n26_alias_coalescing", O.flows("""SELECT proto, src_ip, dst_ip, CAST(src_port AS STRING) AS src_port, CAST(bytes AS STRING) AS bytes, CASE WHEN l_linenumber % 2 = 0 THEN 'NETFLOW_V9' ELSE '9' END AS version
    FROM flow WHERE l_orderkey % 97 <> 5 AND l_orderkey % 101 <> 6 AND l_orderkey % 103 <> 7"""))
def alias_coalescing(spark, d):
    rows = parse_flow_lines(flow_lines(spark, d)).where("line_status = 'parsed'")
    return rows.select(*[get_first(c("v"), ALIASES[n]).alias(n) for n in ("proto", "src_ip", "dst_ip", "src_port", "bytes", "version")])


@query("n27_behavior_id", O.raw("""SELECT raw_id, 'asset_15m_v1|' || sensor || '|' || coalesce(orig_h, 'x') || '|' || CAST(e AS STRING) AS short_id,
    'asset_15m_v1|' || substr(sha256('asset_15m_v1|' || repeat(sensor, 90) || '|' || coalesce(orig_h, 'x') || '|' || CAST(e AS STRING)), 1, 24) || '|' || CAST(e AS STRING) AS long_id FROM raw"""))
def behavior_id(spark, d):
    e = F.get_json_object("doc", "$.e")
    entity = F.coalesce("orig_h", F.lit("x"))
    return raw_logs(spark, d).select("raw_id", V.joined_id("asset_15m_v1", c("sensor"), entity, e).alias("short_id"),
                                     V.joined_id("asset_15m_v1", F.repeat("sensor", 90), entity, e).alias("long_id"))


@query("n28_sigmoid", O.raw("SELECT raw_id, round(1 / (1 + pow(2.718281828, -(k / 100.0))), 6) AS score FROM raw"))
def sigmoid(spark, d):
    from tidewatch.operators.forest import squash
    return raw_logs(spark, d).select("raw_id", squash(F.get_json_object("doc", "$.k").cast("double") / F.lit(100.0)).alias("score"))


@query("n29_age_text", O.raw("""SELECT raw_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' WHEN s < 172800 THEN (s // 3600) || 'h ' || (s // 60 % 60) || 'm'
    ELSE (s // 86400) || 'd ' || (s // 3600 % 24) || 'h' END AS age FROM (SELECT raw_id, e * e % 400000 AS s FROM raw) t"""))
def age_text(spark, d):
    e = F.get_json_object("doc", "$.e").cast("bigint")
    return raw_logs(spark, d).select("raw_id", V.seconds_to_human(V.age_seconds(F.timestamp_seconds(F.lit(0)), F.timestamp_seconds((e * e) % 400000))).alias("age"))


@query("n30_summaries", O.raw("SELECT raw_id, 'Host ' || coalesce(orig_h, 'unknown') || ' asked ' || k || ' times: ' || coalesce(answers[1], '-') AS text FROM raw"))
def summaries(spark, d):
    k = F.get_json_object("doc", "$.k").cast("int")
    first = F.coalesce(F.array_join(F.slice("answers", 1, 1), ", "), F.lit("-"))
    return raw_logs(spark, d).select("raw_id", F.format_string("Host %s asked %d times: %s", F.coalesce("orig_h", F.lit("unknown")), k, first).alias("text"))
