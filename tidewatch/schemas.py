"""Explicit schemas.  Raw logs are one wide typed table; unknown keys survive in ``doc``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# column -> (JSON key, type).  Types: string, bigint, double, boolean, list (of string), dlist (of double).
_SAME = {
    "string": (
        "uid community_id src dst proto service message ndr_noise_type ndr_noise_reason "
        "conn_state history query qtype_name rcode rcode_name host method uri path user_agent referrer referer "
        "server_name version cipher curve validation_status next_protocol fingerprint "
        "note msg sub name analyzer kind failure_reason reason fuid mime_type md5 sha1 sha256 filename "
        "client server cipher_alg mac_alg kex_alg host_key_alg host_key_fingerprint "
        "user command reply_msg helo mailfrom subject date msg_id last_reply "
        "operation named_pipe share_type username hostname server_dns_computer_name server_nb_computer_name "
        "message_type argument attributes base_object result result_code "
        "assigned_addr client_addr server_addr host_name domain mac msg_type nick value addl action opcode"
    ),
    "bigint": (
        "p orig_bytes resp_bytes orig_pkts resp_pkts missed_bytes qtype status_code request_body_len "
        "request_body_bytes response_body_len response_body_bytes seen_bytes total_bytes missing_bytes "
        "overflow_bytes auth_attempts reply_code"
    ),
    "double": "duration suppress_for lease_time",
    "boolean": "local_orig local_resp ndr_noise established resumed sni_matches_cert auth_success is_webmail tls success",
    "list": "answers cert_chain_fps actions fuids mime_types rcptto msg_types",
}
RAW_FIELDS: dict[str, tuple[str, str]] = {
    "orig_h": ("id.orig_h", "string"),
    "orig_p": ("id.orig_p", "bigint"),
    "resp_h": ("id.resp_h", "string"),
    "resp_p": ("id.resp_p", "bigint"),
}
for _type, _names in _SAME.items():
    for _name in _names.split():
        RAW_FIELDS[_name] = (_name, _type)
RAW_FIELDS |= {
    "http_method": ("http.request.method", "string"),
    "http_status": ("http.response.status_code", "bigint"),
    "http_request_bytes": ("http.request.body.bytes", "bigint"),
    "http_response_bytes": ("http.response.body.bytes", "bigint"),
    "http_referrer": ("http.request.referrer", "string"),
    "url_path": ("url.path", "string"),
    "user_agent_name": ("user_agent.name", "string"),
    "firewall_event": ("netflow.firewall_event", "string"),
    "ttls": ("TTLs", "dlist"),
    "issuer": ("issuer", "string"),
    "serial": ("serial", "string"),
    "key_type": ("key_type", "string"),
    "key_alg": ("key_alg", "string"),
    "sig_alg": ("sig_alg", "string"),
    "key_length": ("key_length", "bigint"),
    "not_valid_before": ("not_valid_before", "double"),
    "not_valid_after": ("not_valid_after", "double"),
    "san_dns": ("san.dns", "list"),
    "basic_constraints_ca": ("basic_constraints.ca", "boolean"),
    # flat certificate keys, kept apart from the nested object of the same names
    "cert_subject": ("certificate.subject", "string"),
    "cert_issuer": ("certificate.issuer", "string"),
    "cert_not_valid_before": ("certificate.not_valid_before", "double"),
    "cert_not_valid_after": ("certificate.not_valid_after", "double"),
    "cert_key_type": ("certificate.key_type", "string"),
    "cert_key_length": ("certificate.key_length", "bigint"),
    "cert_sig_alg": ("certificate.sig_alg", "string"),
    "data_channel_orig_h": ("data_channel.orig_h", "string"),
    "data_channel_resp_h": ("data_channel.resp_h", "string"),
    "data_channel_resp_p": ("data_channel.resp_p", "bigint"),
    "data_channel_passive": ("data_channel.passive", "boolean"),
    "mail_from": ("from", "string"),
    "mail_to": ("to", "list"),
    "sw_major": ("version.major", "bigint"),
    "sw_minor": ("version.minor", "bigint"),
    "sw_minor2": ("version.minor2", "bigint"),
    "sw_minor3": ("version.minor3", "bigint"),
    "sw_addl": ("version.addl", "string"),
}
SPARK_TYPE = {"string": "string", "bigint": "bigint", "double": "double", "boolean": "boolean",
              "list": "array<string>", "dlist": "array<double>"}

RAW_HEAD = {
    "raw_id": "string", "raw_index": "string", "ts": "timestamp", "ingest_ts": "timestamp",
    "log_type": "string", "sensor": "string", "doc": "string",
}
RAW_COLUMNS: dict[str, str] = RAW_HEAD | {c: SPARK_TYPE[t] for c, (_, t) in RAW_FIELDS.items()}


def raw_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in RAW_COLUMNS.items()))


def conform_raw(df: DataFrame) -> DataFrame:
    """Give any frame the raw-log schema: missing columns become typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in RAW_COLUMNS.items()
    ])


def null_of(ddl: str) -> Column:
    return F.lit(None).cast(ddl)


EVIDENCE = "struct<index:string,id:string,log_type:string,timestamp:timestamp,uid:string,community_id:string>"

CERT = ("struct<fingerprint:string,subject:string,issuer:string,san_dns:array<string>,not_valid_before:double,"
        "not_valid_after:double,key_type:string,key_length:bigint,sig_alg:string,ca:boolean>")

# The few keys that hardening reads from a kept raw event, beside the full document text.
KEPT_EVENT = (
    "struct<ts:timestamp,raw_id:string,raw_index:string,uid:string,community_id:string,orig_h:string,resp_h:string,"
    f"message:string,local_orig:boolean,local_resp:boolean,noise:boolean,noise_type:string,noise_reason:string,cert:{CERT},doc:string>"
)


def schema_rows(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """One row per expected column: wanted type, actual type, verdict."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, t, actual.get(c), actual.get(c) == t) for c, t in expected.items()]
    return df.sparkSession.createDataFrame(rows, "field string, expected string, actual string, ok boolean")
