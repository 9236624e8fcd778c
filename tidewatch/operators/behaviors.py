"""Sessions to behaviour windows: one row per (entity, sensor, tumbling window).

Every distinct count and every top list comes from one long table of (window, facet, value)
counts.  It is aggregated on the map side and shuffled by the value too, so a host that owns
a third of all sessions is spread over many tasks, and no set of values is ever held in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.ip import BROADCAST, LINK_LOCAL, LOOPBACK, MULTICAST, UNSPECIFIED, ParsedIp, drop_parsed_ips, parsed, with_parsed_ips
from tidewatch.functions.values import blank_to_null, floor_time, iso_millis, joined_id
from tidewatch.settings import (
    ASSET_15M, DEFAULTS, EXCLUDED_CATEGORIES, NOISE_TOKENS, TRUSTED_CERT_WORDS, FeatureSpec, Settings,
)

c = F.col
KEY = ["entity", "sensor_key", "window_start"]
TOP_FACETS = {
    "top_protocols": "protocol", "top_destination_ips": "dst_ip", "top_destination_ports": "dst_port",
    "top_counterpart_ips": "counterpart", "top_external_source_ips": "ext_src_ip", "top_inbound_destination_ports": "in_port",
    "top_outbound_destination_ports": "out_port", "top_dns_queries": "dns_query", "top_http_hosts": "http_host",
    "top_tls_sni": "sni", "top_file_mime_types": "mime", "top_tls_issuers": "issuer",
}
UNIQUE_FACETS = {
    "unique_destination_ip_count": "dst_ip", "unique_destination_port_count": "dst_port", "unique_protocol_count": "protocol",
    "unique_external_source_ip_count": "ext_src_ip", "unique_external_destination_ip_count": "ext_dst_ip",
    "unique_counterpart_ip_count": "counterpart", "unique_inbound_destination_port_count": "in_port",
    "unique_outbound_destination_port_count": "out_port", "dns_unique_query_count": "dns_query", "http_unique_host_count": "http_host",
    "http_unique_user_agent_count": "user_agent", "files_unique_mime_type_count": "mime", "tls_unique_sni_count": "sni",
    "tls_unique_issuer_count": "issuer", "tls_unique_subject_count": "subject",
}
SCOPES = ("same_subnet", "same_spoke_cross_subnet", "same_vnet_cross_subnet", "cross_spoke", "internal_unknown",
          "inbound_external", "outbound_external", "external_external")


# ---------------------------------------------------------------- eligibility

def ip_reason(p: ParsedIp, role: str) -> Column:
    """Why an address does not describe a host; null when it does or is missing."""
    return (
        F.when(p.ip.isNull() | (p.ip == ""), F.lit(None).cast("string")).when(~p.valid, "invalid_ip")
        .when(p.within(UNSPECIFIED), f"{role}_unspecified").when(p.within(MULTICAST), f"{role}_multicast")
        .when(p.within(LOOPBACK), f"{role}_loopback").when(p.within(LINK_LOCAL), f"{role}_link_local")
        .when(p.within(BROADCAST), f"{role}_broadcast")
    )


def with_eligibility(sessions: DataFrame) -> DataFrame:
    """Add ``reasons`` (sorted, distinct) and ``eligible``."""
    df = with_parsed_ips(sessions, s=c("src_ip"), d=c("dst_ip"))
    category = F.replace(F.lower("category"), F.lit("-"), F.lit("_"))
    noise = F.transform(F.coalesce("noise_reasons", F.array().cast("array<string>")),
                        lambda x: F.replace(F.lower(F.trim(x)), F.lit("-"), F.lit("_")))
    unknown = F.coalesce(F.lower("protocol"), F.lit("")).isin("", "unknown") & (F.coalesce("dst_port", F.lit(0)) == 0)
    reasons = F.concat(
        F.array(
            F.when(~F.coalesce("flow_based", F.lit(False)), "not_flow_based"),
            F.when(c("excluded_from_behavior"), "session_excluded_from_behavior"),
            F.when(category.isin(*EXCLUDED_CATEGORIES), category),
            ip_reason(parsed("s", c("src_ip")), "source"), ip_reason(parsed("d", c("dst_ip")), "destination"),
            F.when(unknown, "unknown_port_zero"),
        ),
        F.array_intersect(noise, F.array(*[F.lit(t) for t in NOISE_TOKENS])),
    )
    found = F.sort_array(F.array_distinct(F.filter(reasons, lambda r: r.isNotNull())))
    # A generator of one row: a filter on the reasons stays above it instead of finding and parsing everything anew, many times over.
    df = df.select("*", F.explode(F.array(found)).alias("reasons"))
    return drop_parsed_ips(df.withColumn("eligible", F.size("reasons") == 0), "s", "d")


# ---------------------------------------------------------------- keys

def entity_kind(mode: str) -> Column:
    """What the entity of a session is: the asset side's address, a local side's, or the source's in the host modes.

    The texts are fixed values.
    """
    sensed = blank_to_null(c("sensor")).isNotNull()
    either = lambda with_sensor, alone: F.when(sensed, F.lit(with_sensor)).otherwise(F.lit(alone))
    if mode in ("asset_sensor", "local_asset_sensor", "monitored_asset_sensor"):
        side = F.concat(either("local_asset.ip+sensor.name", "local_asset.ip"), F.lit(":"), F.coalesce(blank_to_null(c("asset_side")), F.lit("unknown")))
        return F.when(blank_to_null(c("asset_ip")).isNotNull(), side).when(
            c("src_local") & blank_to_null(c("src_ip")).isNotNull(), either("local_asset.source.ip+sensor.name", "local_asset.source.ip")
        ).otherwise(either("local_asset.destination.ip+sensor.name", "local_asset.destination.ip"))
    if mode in ("host_sensor", "source_sensor", "source.ip+sensor.name"):
        return either("source.ip+sensor.name", "source.ip")
    if mode in ("sensor_host", "sensor_source"):
        return either("sensor.name+source.ip", "source.ip")
    return F.lit("source.ip")


def with_behavior_key(sessions: DataFrame, spec: FeatureSpec = ASSET_15M, mode: str = "asset_sensor") -> DataFrame:
    """Add entity, sensor_key ('' = none) and window_start; rows without an entity or a time are dropped."""
    src, dst, asset = (blank_to_null(c(n)) for n in ("src_ip", "dst_ip", "asset_ip"))
    sensor = F.coalesce("sensor", F.lit(""))
    if mode in ("asset_sensor", "local_asset_sensor", "monitored_asset_sensor"):
        entity = F.coalesce(asset, F.when(c("src_local"), src), F.when(c("dst_local"), dst))
    else:
        entity = src
        if mode not in ("host_sensor", "source_sensor", "source.ip+sensor.name", "sensor_host", "sensor_source"):
            sensor = F.lit("")
    start = floor_time(F.coalesce("first_seen", "ts"), spec.window_seconds)
    keyed = sessions.withColumns({"entity": entity, "sensor_key": sensor, "window_start": start, "entity_kind": entity_kind(mode)})
    return keyed.where(c("entity").isNotNull() & c("window_start").isNotNull())


# ---------------------------------------------------------------- per-session measures

def _has(log_type: str) -> Column:
    listed = F.coalesce(F.array_contains(F.transform("log_types", lambda x: F.lower(x)), log_type), F.lit(False))
    return F.coalesce(c(f"has_{log_type}"), listed)


def _list_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.array().cast("array<string>"))


def _present(items: Column) -> Column:
    return F.filter(_list_or_empty(items), lambda x: x != "")


def _n(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def measures(spec: FeatureSpec) -> dict[str, Column]:
    """Per-session inputs of the window sums; each is null or zero when it does not apply."""
    is_dns, is_http, is_ssh = _has("dns"), _has("http"), _has("ssh")
    is_tls = _has("tls") | F.coalesce(F.array_contains("log_types", "ssl"), F.lit(False))
    query = blank_to_null(c("dns.query"))
    labels = F.filter(F.split(query, r"\."), lambda x: x != "")
    validation = F.coalesce(F.lower("tls.validation_status"), F.lit(""))
    issuers, subjects = _present(c("x509.issuers")), _present(c("x509.subjects"))
    seen = F.unix_micros(F.coalesce("first_seen", "ts")) / F.lit(1000000.0)
    outdated = F.exists(F.coalesce("x509.not_valid_after_all", F.array().cast("array<double>")), lambda x: x < seen)
    file_count = _n(c("files.count"))
    has_files = _has("files") | (file_count != 0)
    hashes = F.size(_present(c("files.md5"))) + F.size(_present(c("files.sha1"))) + F.size(_present(c("files.sha256")))
    bytes_ = F.when(c("bytes") >= 0, c("bytes")).otherwise(_n(c("conn.orig_bytes")) + _n(c("conn.resp_bytes")))
    packets = F.when(c("packets") >= 0, c("packets")).otherwise(_n(c("conn.orig_pkts")) + _n(c("conn.resp_pkts")))
    response = _n(c("http.response_body_bytes"))
    when = lambda gate, value: F.when(gate, value)
    def names(section: str, first: str, second: str) -> Column:
        a, b = _list_or_empty(c(f"{section}.{first}")), _list_or_empty(c(f"{section}.{second}"))
        return F.greatest(F.lit(1), F.when(F.size(a) > 0, F.size(a)).otherwise(F.size(b)))
    return {
        "is_dns": is_dns, "is_http": is_http, "is_tls": is_tls, "is_ssh": is_ssh,
        "m_bytes": F.greatest(F.lit(0), bytes_), "m_packets": F.greatest(F.lit(0), packets),
        "m_duration": F.when(_n(c("conn.duration")) >= 0, F.coalesce("conn.duration", F.lit(0.0))),
        "m_rejected": (F.lower("direction") == "inbound") & ((F.upper("conn.state") == "REJ") | (c("conn.history") == "Hr")),
        "m_nx": is_dns & (F.coalesce("dns.is_nxdomain", F.lit(False)) | F.coalesce(F.upper("dns.rcode_name") == "NXDOMAIN", F.lit(False))),
        "m_txt": is_dns & (F.coalesce("dns.is_txt", F.lit(False)) | F.coalesce(F.upper("dns.qtype_name") == "TXT", F.lit(False))),
        "m_qlen": when(is_dns, F.coalesce(F.when(c("dns.query_length") >= 0, c("dns.query_length")), F.length(query))),
        "m_labels": when(is_dns, F.coalesce(F.when(c("dns.label_count") >= 0, c("dns.label_count")), F.when(query.isNotNull(), F.size(labels)))),
        "m_longest": when(is_dns, F.coalesce(F.when(c("dns.longest_label_length") >= 0, c("dns.longest_label_length")),
                                             F.when(query.isNotNull(), F.coalesce(F.array_max(F.transform(labels, lambda x: F.length(x))), F.lit(0))))),
        "m_4xx": is_http & c("http.status_code").between(400, 499), "m_5xx": is_http & c("http.status_code").between(500, 599),
        "m_response": when(is_http, response), "m_download": is_http & ((file_count > 0) | (response > 0)),
        "m_files": when(has_files, F.when(file_count != 0, file_count).otherwise(F.size(_list_or_empty(c("files.fuids"))))),
        "m_file_bytes": when(has_files, _n(c("files.total_bytes"))),
        "m_hashes": when(has_files, F.greatest(F.lit(0), F.coalesce(F.when(c("files.hash_count") >= 0, c("files.hash_count")), hashes))),
        "m_invalid": is_tls & (validation != "") & ~validation.isin(*TRUSTED_CERT_WORDS),
        "m_mismatch": is_tls & ~F.coalesce("tls.sni_matches_cert", F.lit(True)),
        "m_self": is_tls & (validation.contains("self") | F.arrays_overlap(subjects, issuers)),
        "m_expired": is_tls & (validation.contains("expired") | outdated),
        "m_resumed": is_tls & F.coalesce("tls.resumed", F.lit(False)),
        "m_ssh_external": is_ssh & (~F.coalesce("dst_local", F.lit(True)) | F.coalesce(F.lower("direction") == "outbound", F.lit(False))),
        "m_ssh_port": is_ssh & (F.coalesce("dst_port", F.lit(22)) != 22),
        "m_ssh_ok": is_ssh & F.coalesce("ssh.auth_success", F.lit(False)), "m_ssh_attempts": when(is_ssh, _n(c("ssh.auth_attempts"))),
        "m_notices": when(_has("notice"), names("notice", "notes", "messages")),
        "m_weirds": when(_has("weird"), names("weird", "names", "messages")),
        "m_issuers": when(is_tls, issuers), "m_subjects": when(is_tls, subjects),
        "m_mimes": when(has_files, F.transform(_present(c("files.mime_types")), lambda x: F.lower(x))),
    }


def facet_values() -> Column:
    """All (facet, value) pairs of one eligible session."""
    protocols = F.coalesce(
        *[F.when(F.size(x) > 0, x) for x in (
            _present(c("protocols")), F.array_compact(F.array(blank_to_null(c("protocol")))), _present(c("log_types")))],
        F.array().cast("array<string>"))
    port = F.when(c("dst_port") >= 0, c("dst_port").cast("string"))
    dst, src = blank_to_null(c("dst_ip")), blank_to_null(c("src_ip"))
    far = F.when((F.lower("asset_side") == "destination") & src.isNotNull(), src).otherwise(dst)
    single = {
        "dst_ip": dst, "dst_port": port, "ext_dst_ip": F.when(~c("dst_local"), dst), "ext_src_ip": F.when(~c("src_local"), src),
        "counterpart": far, "in_port": F.when(F.lower("direction") == "inbound", port),
        "out_port": F.when(F.lower("direction") == "outbound", port),
        "dns_query": F.when(c("is_dns"), blank_to_null(F.lower("dns.query"))), "http_host": F.when(c("is_http"), blank_to_null(F.lower("http.host"))),
        "user_agent": F.when(c("is_http"), blank_to_null(c("http.user_agent"))), "sni": F.when(c("is_tls"), blank_to_null(F.lower("tls.server_name"))),
    }
    many = {"protocol": F.transform(protocols, lambda x: F.lower(x)), "mime": c("m_mimes"), "issuer": c("m_issuers"), "subject": c("m_subjects")}
    pair = lambda name, value: F.struct(F.lit(name).alias("facet"), value.alias("value"))

    def tagged(name: str, values: Column) -> Column:
        return F.transform(_list_or_empty(values), lambda v: pair(name, v))

    ones = F.filter(F.array(*[pair(n, v) for n, v in single.items()]), lambda p: p.value.isNotNull())
    return F.concat(ones, *[tagged(n, v) for n, v in many.items()])


# ---------------------------------------------------------------- windows

def base_features(rows: DataFrame) -> DataFrame:
    """Counts, sums, averages and maxima per window: one partial + final hash aggregate."""
    used = c("eligible")

    def n(cond: Column) -> Column:
        return F.count_if(used & F.coalesce(cond, F.lit(False)))

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(used, value)), F.lit(0)).cast("bigint")

    def mean(value: Column) -> Column:
        return F.coalesce(F.round(F.avg(F.when(used, value)), 6), F.lit(0.0))

    def top(value: Column) -> Column:
        return F.coalesce(F.max(F.when(used, value)), F.lit(0))

    direction, scope = F.lower("direction"), F.lower("scope")
    first = F.struct(F.coalesce("first_seen", "ts").alias("t"), "session_id")
    aggs = {
        "session_count": F.count_if(used), "session_count_total": F.count("*"),
        "network_bytes_sum": total(c("m_bytes")), "network_packets_sum": total(c("m_packets")),
        "avg_session_duration": mean(c("m_duration")), "max_session_duration": F.round(top(c("m_duration")), 6),
        "external_destination_count": n(~c("dst_local")), "internal_destination_count": n(c("dst_local")),
        **{f"{d}_count": n(direction == d) for d in ("inbound", "outbound", "internal")},
        **{f"{s}_count": n(scope == s) for s in SCOPES},
        "same_spoke_count": n(scope.isin("same_subnet", "same_spoke_cross_subnet")),
        "rejected_inbound_count": n(c("m_rejected")),
        "dns_session_count": n(c("is_dns")), "dns_nxdomain_count": n(c("m_nx")),
        "dns_nxdomain_ratio": F.coalesce(F.round(n(c("m_nx")) / F.nullif(n(c("is_dns")), F.lit(0)), 6), F.lit(0.0)),
        "dns_txt_count": n(c("m_txt")), "dns_long_query_count": n(c("m_qlen") >= c("dns_limit")),
        "dns_max_query_length": top(c("m_qlen")), "dns_avg_query_length": mean(c("m_qlen")),
        "dns_max_label_length": top(c("m_longest")), "dns_avg_label_count": mean(c("m_labels")),
        "http_session_count": n(c("is_http")), "http_error_4xx_count": n(c("m_4xx")), "http_error_5xx_count": n(c("m_5xx")),
        "http_response_body_bytes_sum": total(c("m_response")), "http_download_count": n(c("m_download")),
        "files_count": total(c("m_files")), "files_total_bytes_sum": total(c("m_file_bytes")), "files_hash_count": total(c("m_hashes")),
        "tls_session_count": n(c("is_tls")), "tls_invalid_cert_count": n(c("m_invalid")), "tls_sni_mismatch_count": n(c("m_mismatch")),
        "tls_self_signed_count": n(c("m_self")), "tls_expired_cert_count": n(c("m_expired")), "tls_resumed_count": n(c("m_resumed")),
        "ssh_session_count": n(c("is_ssh")), "ssh_external_session_count": n(c("m_ssh_external")),
        "ssh_nonstandard_port_count": n(c("m_ssh_port")), "ssh_auth_success_count": n(c("m_ssh_ok")),
        "ssh_auth_attempt_sum": total(c("m_ssh_attempts")),
        "notice_count": total(c("m_notices")), "weird_count": total(c("m_weirds")),
        "entity_type": F.min_by("entity_kind", first),
        "asset": F.min_by(F.struct(*[c(f"asset_{f}").alias(f) for f in ("spoke", "vnet", "subnet", "subnet_cidr")]), first),
    }
    return rows.groupBy(*KEY).agg(*[v.alias(k) for k, v in aggs.items()])


def facet_counts(rows: DataFrame) -> DataFrame:
    """(window, facet, value, n): values of eligible sessions, reasons of excluded ones."""
    rows = rows.select(F.struct(*KEY).alias("key"), "*")
    reason = F.transform("reasons", lambda r: F.struct(F.lit("excluded_reason").alias("facet"), r.alias("value")))
    pairs = F.when(c("eligible"), facet_values()).otherwise(reason)
    tagged = F.transform(pairs, lambda p: F.struct(c("key"), p.facet.alias("facet"), p.value.alias("value")))
    flat = rows.select(F.explode(tagged).alias("p")).select(*[c(f"p.key.{k}").alias(k) for k in KEY], "p.facet", "p.value")
    return flat.groupBy(*KEY, "facet", "value").agg(F.count("*").alias("n"))


def facet_summary(counts: DataFrame, limit: int = 10) -> DataFrame:
    """Distinct counts, top lists (count desc, value asc) and excluded reasons per window."""
    # Both halves read the same columns and rows of the counts, so that Spark makes and shuffles them once.
    unique = counts.groupBy(*KEY).agg(*[F.count_if((c("facet") == f) & (c("n") > 0)).alias(n) for n, f in UNIQUE_FACETS.items()])
    order = Window.partitionBy(*KEY, "facet").orderBy(F.desc("n"), "value")
    ranked = (
        counts.withColumn("rank", F.row_number().over(order))
        .where(((c("rank") <= limit) & c("facet").isin(*TOP_FACETS.values())) | (c("facet") == "excluded_reason"))
    )
    lists = ranked.groupBy(*KEY).agg(F.collect_list(F.struct("facet", "rank", "value", "n")).alias("ranked"))

    def top(facet: str) -> Column:
        hits = F.array_sort(F.filter("ranked", lambda r: r.facet == facet))
        return F.transform(hits, lambda r: F.struct(r.value.alias("value"), r.n.alias("count")))

    reasons = F.array_sort(F.transform(F.filter("ranked", lambda r: r.facet == "excluded_reason"),
                                       lambda r: F.struct(r.value.alias("value"), r.n.alias("count"))))
    lists = lists.select(*KEY, *[top(f).alias(n) for n, f in TOP_FACETS.items()], reasons.alias("excluded_reasons"))
    return unique.join(lists, KEY, "left")


def session_ref_rows(sessions: DataFrame, spec: FeatureSpec = ASSET_15M, mode: str = "asset_sensor") -> DataFrame:
    """Every eligible session of every window, uncut: (window key, t, session_id, ref)."""
    return _refs(sessions.transform(with_behavior_key, spec, mode).transform(with_eligibility))


def _refs(rows: DataFrame) -> DataFrame:
    ref = F.struct(
        F.date_format("first_seen", "yyyy.MM.dd").alias("index"), c("session_id").alias("id"), "session_id", "uid", "community_id",
        c("ts").alias("timestamp"), "log_types", c("src_ip").alias("source_ip"), c("dst_ip").alias("destination_ip"),
        c("dst_port").alias("destination_port"))
    return rows.where("eligible").select(*KEY, F.coalesce("first_seen", "ts").alias("t"), "session_id", ref.alias("ref"))


def session_refs(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` eligible sessions of each window, by time then id: for display, see :func:`session_ref_rows` for all."""
    order = Window.partitionBy(*KEY).orderBy("t", "session_id")
    cut = _refs(rows).withColumn("rank", F.row_number().over(order)).where(c("rank") <= limit)
    listed = cut.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("rank", "ref"))).alias("l"))
    return listed.select(*KEY, F.transform("l", lambda x: x.ref).alias("session_refs"))


def prepare_rows(sessions: DataFrame, spec: FeatureSpec = ASSET_15M, mode: str = "asset_sensor") -> DataFrame:
    """Keyed sessions with eligibility and the per-session measures."""
    rows = sessions.transform(with_behavior_key, spec, mode).transform(with_eligibility)
    return rows.withColumns(measures(spec) | {"dns_limit": F.lit(spec.dns_long_query_length)})


def build_behaviors(sessions: DataFrame, spec: FeatureSpec = ASSET_15M, settings: Settings = DEFAULTS,
                    updated_at: Column | None = None) -> DataFrame:
    """Behaviour rows with features, vector, top lists, evidence and quality."""
    rows = prepare_rows(sessions, spec, settings.entity_mode)
    joined = (
        base_features(rows).join(facet_summary(facet_counts(rows)), KEY, "left")
        .join(session_refs(rows, settings.max_session_refs), KEY, "left")
    )
    used, excluded = c("session_count"), c("session_count_total") - c("session_count")
    warnings = F.array_compact(F.array(F.when(excluded > 0, "excluded_sessions_present"), F.when(used == 0, "no_behavior_eligible_sessions")))
    ready = used >= settings.min_sessions_for_ml
    start = iso_millis(c("window_start"))
    sensor = blank_to_null(c("sensor_key"))
    refs = F.coalesce(c("session_refs"), F.array().cast(dict(joined.dtypes)["session_refs"]))
    feature = {n: F.coalesce(c(n), F.lit(0)) for n in spec.vector}
    summary = F.format_string(f"Host %s generated %d behavior-eligible sessions in this {spec.window} window.", "entity", used)
    return joined.select(
        joined_id(spec.feature_set, c("sensor_key"), c("entity"), start).alias("behavior_id"),
        F.lit(spec.behavior_type).alias("behavior_type"), F.lit(spec.feature_set).alias("feature_set"),
        "entity_type",
        "entity", sensor.alias("sensor"), "window_start",
        F.timestamp_seconds(F.unix_seconds("window_start") + spec.window_seconds).alias("window_end"), "asset",
        F.struct(*[v.alias(n) for n, v in feature.items()]).alias("features"),
        F.struct(summary.alias("summary"), *TOP_FACETS).alias("human"),
        F.struct(used.alias("session_ref_count"), (used > settings.max_session_refs).alias("session_refs_truncated"),
                 refs.alias("session_refs")).alias("evidence"),
        F.struct(
            ready.alias("feature_complete"), "session_count_total", used.alias("session_count_used"),
            excluded.alias("excluded_session_count"), F.lit(0).alias("missing_required_fields"), warnings.alias("warnings"),
            F.coalesce(c("excluded_reasons"), F.array().cast("array<struct<value:string,count:bigint>>")).alias("excluded_reasons"),
            F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - F.size(warnings) * 5)).alias("data_quality_score")).alias("quality"),
        F.struct(
            ready.alias("ready"), F.array(*[F.lit(n) for n in spec.vector]).alias("feature_names"),
            F.array(*[v.cast("double") for v in feature.values()]).alias("feature_vector"), F.lit(len(spec.vector)).alias("vector_length"),
            F.lit(None).cast("string").alias("model_name"), F.lit(None).cast("string").alias("model_version"),
            F.lit(None).cast("double").alias("anomaly_score"), F.lit(None).cast("boolean").alias("is_anomaly"),
            F.lit(None).cast("timestamp").alias("scored_at"), F.lit("not_scored").alias("scoring_status"),
            F.array().cast("array<struct<name:string,value:double,baseline:double,deviation:double>>").alias("top_features")).alias("ml"),
        F.struct(
            F.lit(None).cast("double").alias("ml"), F.lit(None).cast("double").alias("final"), F.lit("none").alias("severity"),
            F.array().cast("array<string>").alias("reasons")).alias("score"),
        F.lit(False).alias("ml_state_preserved"),
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
    )


def affected_sessions(all_sessions: DataFrame, changed: DataFrame, spec: FeatureSpec = ASSET_15M, mode: str = "asset_sensor") -> DataFrame:
    """All sessions of the windows that changed sessions fall into.

    The entity is computed before matching, so every session lands in exactly one window and
    a peer's window is never rewritten from a part of its sessions.
    """
    touched = changed.transform(with_behavior_key, spec, mode).select(*KEY).distinct()
    return all_sessions.transform(with_behavior_key, spec, mode).join(touched, KEY, "left_semi").drop(*KEY, "entity_kind")


def preserve_ml_state(incoming: DataFrame, stored: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Keep the stored score of a rebuilt window whose vector did not change; otherwise it is scored again."""
    old = stored.select("behavior_id", "window_start", c("ml").alias("_ml"), c("score").alias("_score"))
    pair = incoming.join(old, ["behavior_id", "window_start"], "left")
    same = (
        (c("ml.feature_names") == c("_ml.feature_names")) & (F.size("ml.feature_vector") == F.size("_ml.feature_vector"))
        & F.forall(F.zip_with("ml.feature_vector", "_ml.feature_vector", lambda a, b: F.abs(a - b) < tolerance), lambda ok: ok)
    )
    keep = F.coalesce((c("ml.scoring_status") != "scored") & (c("_ml.scoring_status") == "scored") & same, F.lit(False))
    pair = pair.withColumn("_keep", keep)
    return pair.withColumns({
        "ml": F.when(c("_keep"), c("_ml")).otherwise(c("ml")), "score": F.when(c("_keep"), c("_score")).otherwise(c("score")),
        "ml_state_preserved": c("_keep") | c("ml_state_preserved"),
    }).select(*incoming.columns)
