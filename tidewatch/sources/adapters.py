"""Views of the benchmark tables as telemetry.

Each view is one SQL text that both Spark and the checking engine can run; only array
construction and JSON access are spelled per engine (``ARR(`` and ``JSON_K``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.schemas import RAW_COLUMNS, conform_raw
from tidewatch.session import configure

_BASE = """
SELECT event_id AS e, event_type AS et, value AS v, CAST(JSON_K AS BIGINT) AS k,
       CAST(floor(event_id / 3) AS BIGINT) AS g, event_id % 3 AS m,
       CAST(floor(event_id / 120) AS BIGINT) AS q,
       (1704067200 + event_id * 3) * 1000000 + (event_id % 1000) * 1000 AS us
FROM events
"""

_TYPED = f"""
SELECT *, CASE
    WHEN m = 0 THEN 'conn'
    WHEN m = 1 THEN CASE et WHEN 'click' THEN 'http' WHEN 'view' THEN 'dns' WHEN 'purchase' THEN 'ssl' WHEN 'error' THEN 'ssh' ELSE 'files' END
    WHEN et = 'error' THEN 'notice' WHEN et = 'signup' THEN 'weird' WHEN et = 'view' THEN 'http'
    WHEN et = 'purchase' THEN CASE k % 4 WHEN 0 THEN 'x509' WHEN 1 THEN 'ssl' WHEN 2 THEN 'tls' ELSE 'quic' END
    ELSE CASE k % 10 WHEN 0 THEN 'analyzer' WHEN 1 THEN 'ftp' WHEN 2 THEN 'smtp' WHEN 3 THEN 'smb_files' WHEN 4 THEN 'smb_mapping'
         WHEN 5 THEN 'ldap' WHEN 6 THEN 'ldap_search' WHEN 7 THEN 'dhcp' WHEN 8 THEN 'irc' ELSE 'dns' END
    END AS log_type,
    CASE WHEN q % 5 = 4 THEN '8.8.' || (q % 7) || '.' || (q % 200 + 1) WHEN g % 107 = 0 THEN 'fd00::' || (g % 9 + 1)
         ELSE '10.51.' || (q % 4 + 1) || '.' || (q % 50 + 10) END AS src_ip,
    CASE WHEN q % 5 = 4 THEN '10.51.' || (q % 4 + 1) || '.' || (g % 7 + 1) WHEN g % 101 = 0 THEN 'ff02::1' WHEN g % 103 = 0 THEN 'not-an-ip'
         WHEN q % 3 = 2 THEN '203.0.114.' || (g % 40 + 1) ELSE '10.51.3.' || (q % 7 + 1) END AS dst_ip,
    CASE WHEN g % 97 = 0 THEN 9200 WHEN g % 89 = 0 THEN 123 WHEN q % 3 = 0 THEN g % 1000 + 1 WHEN q % 3 = 1 THEN 22 ELSE 443 END AS dst_port
FROM (SELECT * FROM ({_BASE}) a UNION ALL SELECT * FROM ({_BASE}) b WHERE e % 50 = 7) u
"""

_WEB = "log_type = 'http'"
_TLS = "log_type IN ('ssl', 'tls')"
RAW_SQL = f"""
SELECT e, g, k, us, 'R' || lpad(CAST(e AS STRING), 9, '0') AS raw_id, 'zeek-logs' AS raw_index, log_type,
    'sensor' || (q % 2 + 1) AS sensor,
    CASE WHEN g % 17 <> 0 THEN 'C' || g END AS uid,
    CASE WHEN g % 34 <> 0 THEN '1:' || g END AS community_id,
    CASE WHEN log_type IN ('files', 'x509', 'dhcp') OR (log_type IN ('notice', 'weird') AND k % 2 = 0) THEN NULL ELSE src_ip END AS orig_h,
    CASE WHEN log_type IN ('files', 'x509', 'dhcp') OR (log_type IN ('notice', 'weird') AND k % 2 = 0) THEN NULL ELSE g % 30000 + 1024 END AS orig_p,
    CASE WHEN log_type IN ('files', 'x509', 'dhcp') OR (log_type IN ('notice', 'weird') AND k % 2 = 0) THEN NULL ELSE dst_ip END AS resp_h,
    CASE WHEN log_type IN ('files', 'x509', 'dhcp') OR (log_type IN ('notice', 'weird') AND k % 2 = 0) THEN NULL ELSE dst_port END AS resp_p,
    CASE WHEN log_type = 'notice' THEN src_ip END AS src, CASE WHEN log_type = 'notice' THEN dst_ip END AS dst,
    CASE WHEN log_type = 'notice' THEN dst_port END AS p,
    CASE WHEN log_type IN ('conn', 'notice') THEN CASE WHEN g % 11 = 0 THEN 'udp' ELSE 'tcp' END END AS proto,
    CASE WHEN log_type = 'conn' THEN CASE g % 6 WHEN 1 THEN 'ssl' WHEN 2 THEN 'dns' WHEN 3 THEN 'SSL, http' WHEN 4 THEN 'ssh' WHEN 5 THEN '' END END AS service,
    CASE WHEN log_type = 'conn' THEN CASE g % 5 WHEN 0 THEN 'REJ' WHEN 1 THEN 'S0' WHEN 2 THEN 'RSTO' WHEN 3 THEN 'OTH' ELSE 'SF' END END AS conn_state,
    CASE WHEN log_type = 'conn' THEN CASE WHEN g % 7 = 0 THEN 'Hr' ELSE 'ShADadFf' END END AS history,
    CASE WHEN log_type = 'conn' THEN floor(v * 8) / 8.0E0 END AS duration,
    CASE WHEN log_type = 'conn' AND g % 13 <> 0 THEN CAST(floor(v * 100) AS BIGINT) END AS orig_bytes,
    CASE WHEN log_type = 'conn' AND g % 13 <> 0 THEN g % 1000 END AS resp_bytes,
    CASE WHEN log_type = 'conn' THEN g % 9 END AS orig_pkts, CASE WHEN log_type = 'conn' THEN g % 5 END AS resp_pkts,
    CASE WHEN log_type = 'conn' THEN g % 3 END AS missed_bytes,
    CASE WHEN log_type = 'conn' AND g % 3 <> 0 THEN q % 5 <> 4 END AS local_orig,
    CASE WHEN log_type = 'conn' AND g % 3 <> 0 THEN q % 3 <> 2 END AS local_resp,
    CASE WHEN log_type = 'dns' THEN repeat('a', CAST(k AS INT)) || '.' || k || '.Example.com' END AS query,
    CASE WHEN log_type = 'dns' THEN CASE WHEN k % 10 = 0 THEN 16 ELSE 1 END END AS qtype,
    CASE WHEN log_type = 'dns' THEN CASE WHEN k % 10 = 0 THEN 'TXT' ELSE 'A' END END AS qtype_name,
    CASE WHEN log_type = 'dns' AND k % 3 <> 0 THEN CASE WHEN k % 4 = 0 THEN '3' ELSE '0' END END AS rcode,
    CASE WHEN log_type = 'dns' THEN CASE WHEN k % 4 = 0 THEN 'NXDOMAIN' ELSE 'NOERROR' END END AS rcode_name,
    CASE WHEN log_type = 'dns' THEN ARR('10.0.0.' || (k % 5), '10.0.1.' || (k % 3)) END AS answers,
    CASE WHEN log_type = 'dns' THEN ARR(CAST(k % 7 AS DOUBLE), CAST(300.0 AS DOUBLE)) END AS ttls,
    CASE WHEN {_WEB} THEN CASE WHEN k % 25 = 0 THEN 'Download.Docker.com' ELSE 'h' || (k % 20) || '.Example.com' END END AS host,
    CASE WHEN {_WEB} THEN CASE WHEN k % 3 = 0 THEN 'POST' ELSE 'GET' END END AS method,
    CASE WHEN {_WEB} AND k % 9 = 0 THEN 'PUT' END AS http_method,
    CASE WHEN {_WEB} AND k % 4 <> 0 THEN '/p/' || k END AS uri, CASE WHEN {_WEB} THEN '/u/' || k END AS url_path,
    CASE WHEN {_WEB} THEN CASE WHEN k % 10 < 6 THEN 200 WHEN k % 10 < 9 THEN 404 ELSE 503 END END AS status_code,
    CASE WHEN {_WEB} THEN CASE WHEN k % 33 = 0 THEN 'Python-urllib/3' ELSE 'ua' || (k % 6) END END AS user_agent,
    CASE WHEN {_WEB} THEN k END AS request_body_len,
    CASE WHEN {_WEB} THEN CASE WHEN k % 5 = 0 THEN 0 ELSE CAST(floor(v * 10) AS BIGINT) END END AS response_body_len,
    CASE WHEN {_WEB} AND k % 2 = 0 THEN 'http://ref/' || (k % 4) END AS referrer,
    CASE WHEN {_TLS} AND k % 7 <> 0 THEN 'S' || (k % 15) || '.example.com' END AS server_name,
    CASE WHEN {_TLS} THEN 'TLSv1' || (k % 4) WHEN {_WEB} THEN '1.1' END AS version,
    CASE WHEN {_TLS} THEN 'c' || (k % 3) END AS cipher, CASE WHEN {_TLS} AND k % 2 = 0 THEN 'x25519' END AS curve,
    CASE WHEN {_TLS} THEN CASE k % 5 WHEN 0 THEN 'self signed certificate' WHEN 1 THEN 'certificate has expired' WHEN 2 THEN NULL ELSE 'ok' END END AS validation_status,
    CASE WHEN {_TLS} THEN k % 2 = 0 END AS established, CASE WHEN {_TLS} THEN k % 3 = 0 END AS resumed,
    CASE WHEN {_TLS} AND k % 6 <> 5 THEN k % 4 <> 0 END AS sni_matches_cert,
    CASE WHEN {_TLS} THEN 'h' || (k % 2 + 1) END AS next_protocol,
    CASE WHEN {_TLS} THEN CASE WHEN k % 2 = 0 THEN ARR('F' || (k % 20), 'F' || ((k + 8) % 20)) ELSE ARR('F' || (k % 20)) END END AS cert_chain_fps,
    CASE WHEN log_type = 'x509' THEN 'F' || (k % 20) END AS fingerprint,
    CASE WHEN log_type = 'x509' THEN 'CN=' || (k % 6) END AS subject, CASE WHEN log_type = 'x509' THEN 'CN=' || (k % 3) END AS issuer,
    CASE WHEN log_type = 'x509' THEN 'S' || k END AS serial,
    CASE WHEN log_type = 'x509' THEN 'CN=' || (k % 6) END AS cert_subject, CASE WHEN log_type = 'x509' THEN 'CN=' || (k % 3) END AS cert_issuer,
    CASE WHEN log_type = 'x509' THEN CAST(1600000000 + k AS DOUBLE) END AS not_valid_before,
    CASE WHEN log_type = 'x509' THEN CAST(1700000000 + k * 100000 AS DOUBLE) END AS not_valid_after,
    CASE WHEN log_type = 'x509' THEN CAST(1600000000 + k AS DOUBLE) END AS cert_not_valid_before,
    CASE WHEN log_type = 'x509' THEN CAST(1700000000 + k * 100000 AS DOUBLE) END AS cert_not_valid_after,
    CASE WHEN log_type = 'x509' THEN 'rsa' END AS key_type, CASE WHEN log_type = 'x509' THEN 'rsaEncryption' END AS key_alg,
    CASE WHEN log_type = 'x509' THEN 'rsa' END AS cert_key_type, CASE WHEN log_type = 'x509' THEN 2048 + k % 2 * 2048 END AS key_length,
    CASE WHEN log_type = 'x509' THEN 2048 + k % 2 * 2048 END AS cert_key_length,
    CASE WHEN log_type = 'x509' THEN 'sha256' END AS sig_alg, CASE WHEN log_type = 'x509' THEN 'sha256' END AS cert_sig_alg,
    CASE WHEN log_type = 'x509' THEN ARR('d' || (k % 3) || '.example.com', 'd' || (k % 5) || '.example.com') END AS san_dns,
    CASE WHEN log_type = 'x509' THEN k % 8 = 0 END AS basic_constraints_ca,
    CASE WHEN log_type = 'notice' THEN CASE WHEN k < 50 THEN 'SSL::Invalid_Server_Cert' ELSE 'Scan::Port_Scan' END END AS note,
    CASE WHEN log_type = 'notice' THEN 'm' || (k % 9) END AS msg,
    CASE WHEN log_type = 'notice' THEN 's' || (k % 4) WHEN log_type = 'smtp' THEN NULL END AS sub,
    CASE WHEN log_type = 'notice' THEN ARR('Notice::ACTION_LOG', 'A' || (k % 3)) END AS actions,
    CASE WHEN log_type = 'notice' THEN CAST(3600.0 AS DOUBLE) END AS suppress_for,
    CASE WHEN log_type = 'weird' THEN 'w' || (k % 8) WHEN log_type IN ('smb_files', 'smb_mapping') THEN 'n' || (k % 3) END AS name,
    CASE WHEN log_type = 'weird' AND k % 3 = 0 THEN 'frag' END AS message,
    CASE WHEN log_type = 'analyzer' AND k % 20 = 0 THEN 'an' || (k % 3) END AS analyzer, CASE WHEN log_type = 'analyzer' THEN 'kind' || (k % 2) END AS kind,
    CASE WHEN log_type = 'analyzer' THEN 'because' || (k % 4) END AS failure_reason,
    CASE WHEN log_type = 'files' THEN 'FU' || e END AS fuid,
    CASE WHEN log_type = 'files' THEN CASE k % 3 WHEN 0 THEN 'Text/plain' WHEN 1 THEN 'image/png' ELSE '' END END AS mime_type,
    CASE WHEN log_type = 'files' THEN 'md' || k END AS md5, CASE WHEN log_type = 'files' AND k % 2 = 0 THEN 'sh' || k END AS sha1,
    CASE WHEN log_type = 'files' AND k % 4 = 0 THEN 'f' || k || '.bin' END AS filename,
    CASE WHEN log_type = 'files' THEN k * 1000 END AS seen_bytes, CASE WHEN log_type = 'files' AND k % 6 <> 0 THEN k * 1001 END AS total_bytes,
    CASE WHEN log_type = 'files' THEN k % 2 END AS missing_bytes,
    CASE WHEN log_type = 'ssh' THEN k % 3 = 0 END AS auth_success, CASE WHEN log_type = 'ssh' THEN k % 6 END AS auth_attempts,
    CASE WHEN log_type = 'ssh' THEN 'SSH-2.0-c' || (k % 4) END AS client, CASE WHEN log_type = 'ssh' THEN 'SSH-2.0-s' END AS server,
    CASE WHEN log_type = 'ssh' THEN 'aes' END AS cipher_alg, CASE WHEN log_type = 'ssh' THEN 'hk' || (k % 5) END AS host_key_fingerprint,
    CASE WHEN log_type = 'ftp' THEN 'user' || (k % 5) WHEN log_type = 'smb_files' THEN 'smbuser' || (k % 2) END AS user,
    CASE WHEN log_type = 'ftp' THEN 'RETR' WHEN log_type = 'irc' THEN 'JOIN' END AS command, CASE WHEN log_type = 'ftp' THEN 200 + k END AS reply_code,
    CASE WHEN log_type = 'ftp' THEN '10.0.0.' || (k % 9) END AS data_channel_resp_h, CASE WHEN log_type = 'ftp' THEN 20 + k END AS data_channel_resp_p,
    CASE WHEN log_type = 'ftp' THEN k % 2 = 0 END AS data_channel_passive,
    CASE WHEN log_type = 'smtp' THEN 'helo' || (k % 3) END AS helo, CASE WHEN log_type = 'smtp' THEN 'a' || k || '@x.org' END AS mailfrom,
    CASE WHEN log_type = 'smtp' THEN ARR('b' || k || '@y.org', 'c@y.org') END AS rcptto, CASE WHEN log_type = 'smtp' THEN k % 2 = 1 END AS tls,
    CASE WHEN log_type IN ('smb_files', 'smb_mapping') THEN 'op' || (k % 4) WHEN log_type = 'ldap' THEN 'bind' END AS operation,
    CASE WHEN log_type = 'smb_mapping' THEN 'share' || (k % 5) END AS path,
    CASE WHEN log_type = 'smb_mapping' THEN 'DISK' END AS share_type, CASE WHEN log_type IN ('smb_files', 'smb_mapping') THEN k % 2 = 0 END AS success,
    CASE WHEN log_type = 'ldap_search' THEN 'search' END AS message_type, CASE WHEN log_type = 'ldap_search' THEN 'dc=' || (k % 3) END AS base_object,
    CASE WHEN log_type IN ('ldap', 'ldap_search') THEN 'ok' || (k % 2) END AS result,
    CASE WHEN log_type = 'dhcp' THEN '10.51.9.' || k END AS assigned_addr, CASE WHEN log_type = 'dhcp' THEN 'host' || k END AS host_name,
    CASE WHEN log_type = 'dhcp' THEN CAST(3600.5 AS DOUBLE) END AS lease_time, CASE WHEN log_type = 'dhcp' THEN ARR('DISCOVER', 'ACK' || (k % 2)) END AS msg_types,
    CASE WHEN log_type = 'irc' THEN 'nick' || (k % 4) END AS nick, CASE WHEN log_type = 'irc' THEN '#c' || (k % 3) END AS value,
    ({_WEB} AND (k % 25 = 0 OR k % 33 = 0)) AS ndr_noise,
    CASE WHEN {_WEB} AND (k % 25 = 0 OR k % 33 = 0) THEN 'package_update' END AS ndr_noise_type,
    CASE WHEN {_WEB} AND (k % 25 = 0 OR k % 33 = 0) THEN 'known package manager or repository traffic' END AS ndr_noise_reason
FROM ({_TYPED}) t
"""

# Sensor files: the JSON text of a conn or dns line, with broken, blank and non-object lines in between.
LINES_SQL = f"""
SELECT *, CASE
    WHEN e % 97 = 5 THEN '{{"ts": 17040, "uid": "C'
    WHEN e % 101 = 6 THEN ''
    WHEN e % 103 = 7 THEN '[1, 2]'
    ELSE '{{"raw_id":"R' || e || '",' || CASE WHEN e % 11 <> 3 THEN '"ts":' || (1704067200 + e * 3) || '.' || lpad(CAST(e % 1000 AS STRING), 3, '0') || '456,' ELSE '' END
         || CASE e % 3 WHEN 0 THEN '"id.orig_h":"' || src_ip || '","id.orig_p":' || (g % 30000 + 1024) || ',"id.resp_h":"' || dst_ip || '","id.resp_p":' || dst_port
                       WHEN 1 THEN '"id":{{"orig_h":"' || src_ip || '","orig_p":"' || (g % 30000 + 1024) || '","resp_h":"' || dst_ip || '","resp_p":' || dst_port || '}}'
                       ELSE '"id.orig_h":null,"id":{{"orig_h":"' || src_ip || '"}},"id.resp_p":' || dst_port || '.7' END
         || ',"rcode":' || (k % 4) || ',"opcode":"' || (k % 2) || '","answers":' || CASE WHEN k % 2 = 0 THEN '"one' || k || '"' ELSE '["a' || k || '","b"]' END
         || ',"orig_bytes":"' || k || CASE WHEN k % 5 = 0 THEN '.0' ELSE '' END || '","future_field":{{"a":' || k || '}}}}'
    END AS value,
    '/logs/' || CASE e % 7 WHEN 0 THEN 'conn.log' WHEN 1 THEN 'dns.log' WHEN 2 THEN 'HTTP.2024-01-01-00-00-00.log' WHEN 3 THEN 'stats.log'
        WHEN 4 THEN 'conn-summary.2024-01-01-01-00-00.log' WHEN 5 THEN 'ssl.json' ELSE 'weird.log' END AS file,
    e AS file_offset
FROM ({_TYPED}) t
"""

# Flow exporter lines out of order lines: numbers sometimes as text, two spellings of the keys.
FLOWS_SQL = """
SELECT *, CASE
    WHEN l_orderkey % 97 = 5 THEN 'not json' WHEN l_orderkey % 101 = 6 THEN '  ' WHEN l_orderkey % 103 = 7 THEN '{"broken":'
    WHEN l_linenumber % 2 = 0 THEN '{"proto":"' || proto || '","src_addr":"' || src_ip || '","dst_addr":"' || dst_ip || '","src_port":' || src_port || ',"dst_port":"' || dst_port
        || '","time_flow_start_ns":' || start_ns || CASE WHEN end_ns IS NULL THEN '' ELSE ',"time_flow_end_ns":' || end_ns END
        || ',"time_received_ns":' || received_ns || ',"bytes":' || bytes || ',"packets":' || packets || ',"type":"NETFLOW_V9","in_if":' || l_linenumber || ',"sampler_address":"10.51.1.15"}'
    ELSE '{"proto":"","protocol":"' || proto || '","srcaddr":"' || src_ip || '","ipv4_dst_addr":"' || dst_ip || '","l4_src_port":"' || src_port || '","dstport":' || dst_port
        || ',"flow_start_ns":"' || start_ns || '"' || CASE WHEN end_ns IS NULL THEN '' ELSE ',"flow_end_ns":"' || end_ns || '"' END
        || ',"received_ns":' || received_ns || ',"octets":"' || bytes || '","pkts":' || packets || ',"vlan_id":' || l_linenumber || ',"version":"9","agent_ip":"10.51.1.15"}'
    END AS value
FROM (
SELECT l_orderkey, l_partkey, l_linenumber,
    CASE WHEN l_orderkey % 50 = 0 THEN '10.51.1.15' WHEN l_orderkey % 41 = 0 THEN '2001:db8::' || (l_partkey % 9) ELSE '10.51.' || (l_suppkey % 4) || '.' || (l_partkey % 250 + 1) END AS src_ip,
    CASE l_linenumber % 5 WHEN 0 THEN '168.63.129.16' WHEN 1 THEN '8.8.' || (l_partkey % 200) || '.4' WHEN 2 THEN '10.51.1.11' WHEN 3 THEN '999.1.1.1' ELSE '100.64.0.' || (l_partkey % 100) END AS dst_ip,
    l_partkey % 60000 + 1 AS src_port, CASE WHEN l_partkey % 3 = 0 THEN 2055 ELSE l_partkey % 1000 END AS dst_port,
    CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN '6' WHEN 1 THEN '17' WHEN 2 THEN 'TCP' WHEN 3 THEN 'icmp' WHEN 4 THEN '99' ELSE 'weirdo' END AS proto,
    CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS bytes,
    CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE CAST(floor(l_quantity) AS BIGINT) END AS packets,
    (1704067200 + l_orderkey) * 1000000000 + (l_partkey % 1000) * 1000000 AS start_ns,
    CASE WHEN l_orderkey % 7 <> 0 THEN (1704067200 + l_orderkey) * 1000000000 + (l_partkey % 1000) * 1000000 + CAST(floor(l_quantity) AS BIGINT) * 123456789 END AS end_ns,
    (1704067205 + l_orderkey) * 1000000000 AS received_ns
FROM lineitem) f
"""

# The monitored subnets of the example deployment, plus a wider overlapping one.
SUBNETS = (
    ("hub", "hub-vnet", "wide", "10.51.0.0/16"),
    ("spoke1", "spoke1-vnet", "app", "10.51.1.0/24"),
    ("spoke1", "spoke1-vnet", "db", "10.51.2.0/24"),
    ("spoke2", "spoke2-vnet", "web", "10.51.3.0/24"),
)


def spark_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the view texts over the parquet tables of ``sf_dir``."""
    configure(spark)
    text = text.replace("ARR(", "array(").replace("JSON_K", "get_json_object(props, '$.k')")
    for table in ("events", "lineitem"):
        if f"FROM {table}" in text:
            text = text.replace(f"FROM {table}", f"FROM parquet.`{sf_dir.rstrip('/')}/{table}.parquet`")
    return spark.sql(text)


def oracle_text(text: str) -> str:
    return text.replace("ARR(", "list_value(").replace("JSON_K", "json_extract_string(props, '$.k')")


def _finish(df: DataFrame) -> DataFrame:
    return conform_raw(_timed(df))


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ts": F.timestamp_micros("us"), "doc": F.format_string('{"e":%d,"k":%d}', "e", "k"),
        "ingest_ts": F.timestamp_micros(F.col("us") + F.lit(60000000)),
    })


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw-log rows (``doc`` carries a small JSON text)."""
    return _finish(spark_sql(spark, sf_dir, RAW_SQL))


#: Events a task turns into raw logs.
SLICE_ROWS = 50_000


def sliced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in slices of neighbouring ids.

    A scan has no more tasks than its files have row groups, and some writers put millions of rows in one. Slices grow in number with
    the rows; events of a connection follow each other, so most of them stay in one slice.
    """
    configure(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return events.repartitionByRange(max(1, -(-events.count() // SLICE_ROWS)), "event_id", "event_type", "value", "props")


def logged_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-log rows without the columns that the view does not have; ``conform_raw`` adds these as nulls."""
    rows = _timed(_raw_view(sliced_events(spark, sf_dir)))
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in RAW_COLUMNS.items() if n in rows.columns])


def raw_columns(events: DataFrame) -> DataFrame:
    """The raw-log view over any frame of events, also a streaming one."""
    return _finish(_raw_view(events))


def _raw_view(events: DataFrame) -> DataFrame:
    name = f"events_{uuid.uuid4().hex}"
    events.createOrReplaceTempView(name)
    text = RAW_SQL.replace("ARR(", "array(").replace("JSON_K", "get_json_object(props, '$.k')").replace("FROM events", f"FROM {name}")
    return events.sparkSession.sql(text)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, LINES_SQL).select("value", "file", "file_offset")


def flow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, FLOWS_SQL).select("value")
