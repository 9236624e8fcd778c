"""Per-log-type session sections: which columns they read and how lists are gathered.

A section has scalars (taken from the earliest event of its log type), ordered distinct
lists (over all its events) and, for files, sums.  The registry below is the extension
point: add an entry to teach sessions a new log type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.protocols import dns_labels, longest
from tidewatch.functions.values import blank_to_null, first_present

c = F.col


def _text(*names: str) -> Callable[[], Column]:
    return lambda: first_present(*[c(n) for n in names])


def _value(*names: str) -> Callable[[], Column]:
    return lambda: F.coalesce(*[c(n) for n in names])


def _nonempty(name: str) -> Callable[[], Column]:
    return lambda: F.when(F.size(c(name)) > 0, c(name))


def _one(*names: str) -> Callable[[], Column]:
    """A list source that holds at most one value per event."""
    return lambda: F.array(first_present(*[c(n).cast("string") for n in names]))


def _many(*names: str) -> Callable[[], Column]:
    """A list source that concatenates scalar and array columns of one event."""
    def build() -> Column:
        empty = F.array().cast("array<string>")
        arrays = {"answers", "ttls", "actions", "fuids", "mime_types", "msg_types", "san_dns"}
        return F.concat(*[
            F.coalesce(c(n).cast("array<string>"), empty) if n in arrays else F.array(c(n).cast("string")) for n in names
        ])
    return build


@dataclass(frozen=True)
class Section:
    log_types: tuple[str, ...]
    scalars: dict[str, Callable[[], Column]] = field(default_factory=dict)
    lists: dict[str, Callable[[], Column]] = field(default_factory=dict)
    list_types: dict[str, str] = field(default_factory=dict)
    sums: tuple[str, ...] = ()


def _same_text(names: str) -> dict[str, Callable[[], Column]]:
    return {n: _text(n) for n in names.split()}


def _same(names: str) -> dict[str, Callable[[], Column]]:
    return {n: _value(n) for n in names.split()}


def _query_measure(measure) -> Callable[[], Column]:
    return lambda: F.when(c("query") != "", measure(c("query")))


SECTIONS: dict[str, Section] = {
    "conn": Section(("conn",), {"state": _text("conn_state"), "history": _text("history")}
                    | _same("duration orig_bytes resp_bytes orig_pkts resp_pkts missed_bytes")),
    "dns": Section(
        ("dns",),
        _same_text("query qtype_name rcode_name") | _same("qtype") | {
            "rcode": _text("rcode", "rcode_name"),
            "query_length": _query_measure(F.length),
            "label_count": _query_measure(lambda q: F.size(dns_labels(q))),
            "longest_label_length": _query_measure(lambda q: longest(dns_labels(q))),
            "is_txt": lambda: F.coalesce(F.upper(c("qtype_name")) == "TXT", F.lit(False)),
            "is_nxdomain": lambda: F.coalesce(F.upper(c("rcode_name")) == "NXDOMAIN", F.lit(False)),
        },
        {"answers": _many("answers"), "ttls": _many("ttls")}, {"ttls": "array<double>"}),
    "http": Section(("http",), {
        "host": _text("host"), "method": _text("method", "http_method"), "uri": _text("uri", "path", "url_path"),
        "status_code": _value("status_code", "http_status"), "user_agent": _text("user_agent", "user_agent_name"),
        "request_body_bytes": _value("request_body_len", "request_body_bytes", "http_request_bytes"),
        "response_body_bytes": _value("response_body_len", "response_body_bytes", "http_response_bytes"),
        "referrer": _text("referrer", "referer", "http_referrer"),
    }),
    "tls": Section(("ssl", "tls"), _same_text("server_name version cipher curve validation_status next_protocol")
                   | _same("established resumed sni_matches_cert")),
    "x509": Section(
        ("x509",),
        _same_text("subject issuer serial key_type key_alg sig_alg")
        | _same("not_valid_before not_valid_after key_length") | {"basic_constraints_ca": _value("basic_constraints_ca")},
        {"san_dns": _many("san_dns"), "fingerprints": _one("fingerprint"), "subjects": _one("cert_subject"), "issuers": _one("cert_issuer"),
         "not_valid_before_all": _one("cert_not_valid_before"), "not_valid_after_all": _one("cert_not_valid_after"),
         "key_types": _one("cert_key_type"), "key_lengths": _one("cert_key_length"), "signature_algorithms": _one("cert_sig_alg"),
         "ca_flags": _one("basic_constraints_ca")},
        {"not_valid_before_all": "array<double>", "not_valid_after_all": "array<double>", "key_lengths": "array<bigint>", "ca_flags": "array<boolean>"}),
    "notice": Section(("notice",), {}, {
        "notes": _one("note"), "messages": _one("msg"), "actions": _many("actions"), "subs": _one("sub"),
        "suppress_for": _one("suppress_for")}, {"suppress_for": "array<double>"}),
    "weird": Section(("weird",), {}, {"names": _one("name"), "messages": _one("msg", "message")}),
    "analyzer": Section(("analyzer",), {}, {
        "names": _one("analyzer", "name"), "kinds": _one("kind"), "failure_reasons": _one("failure_reason", "reason")}),
    "files": Section(("files",), {}, {
        "fuids": _many("fuid", "fuids"), "mime_types": _many("mime_type", "mime_types"), "md5": _one("md5"),
        "sha1": _one("sha1"), "sha256": _one("sha256"), "filenames": _one("filename", "name")},
        sums=("seen_bytes", "total_bytes", "missing_bytes", "overflow_bytes")),
    "ssh": Section(("ssh",), _same("auth_success auth_attempts") | _same_text(
        "client server cipher_alg mac_alg kex_alg host_key_alg host_key_fingerprint")),
    "ftp": Section(("ftp",), _same_text("user command reply_msg data_channel_orig_h data_channel_resp_h")
                   | _same("reply_code data_channel_resp_p data_channel_passive")),
    "smtp": Section(("smtp",), _same_text("helo mailfrom subject date msg_id last_reply") | _same("is_webmail tls") | {
        "from": _text("mail_from"), "rcptto": _nonempty("rcptto"), "to": _nonempty("mail_to")}),
    "smb": Section(("smb_files", "smb_mapping", "ntlm", "dce_rpc"), {}, {
        "operations": _one("operation"), "paths": _one("path", "name"), "names": _one("name"),
        "named_pipes": _one("named_pipe"), "share_types": _one("share_type"), "usernames": _one("username", "user"),
        "hostnames": _one("hostname", "host"), "server_dns_computer_names": _one("server_dns_computer_name"),
        "server_nb_computer_names": _one("server_nb_computer_name"), "success_values": _one("success")},
        {"success_values": "array<boolean>"}),
    "ldap": Section(("ldap", "ldap_search"), {}, {
        "operations": _one("operation", "message_type"), "arguments": _one("argument", "attributes", "base_object"),
        "results": _one("result", "result_code")}),
    "dhcp": Section(("dhcp",), _same_text("assigned_addr client_addr server_addr host_name domain mac") | _same("lease_time"),
                    {"msg_types": _many("msg_type", "msg_types")}),
    "irc": Section(("irc",), _same_text("nick command value addl")),
}
SECTION_OF_LOG_TYPE = {t: name for name, s in SECTIONS.items() for t in s.log_types}


def scalar_struct(section: str) -> Column:
    return F.struct(*[build().alias(name) for name, build in SECTIONS[section].scalars.items()])


def list_values(rows: DataFrame, sections, us: Column, raw_id: Column, *keep: str) -> DataFrame | None:
    """(keep.., field, us, id, pos, value) of every list value of every event; none where the sections have no lists.

    One ``when`` branch per log type, so an event only pays for its own lists.  Lists are dealt out first and their values next:
    two plain generators instead of functions over array elements, which Spark interprets.
    """
    chain = None
    for name in sections:
        spec = SECTIONS[name]
        if not spec.lists:
            continue
        for log_type in spec.log_types:
            field_of = (lambda f: f"{name}.{f}.{log_type}") if len(spec.log_types) > 1 else (lambda f: f"{name}.{f}")
            lists = F.array(*[F.struct(F.lit(field_of(f)).alias("field"), build().alias("values")) for f, build in spec.lists.items()])
            hit = c("log_type") == log_type
            chain = F.when(hit, lists) if chain is None else chain.when(hit, lists)
    if chain is None:
        return None
    lists = rows.select(*keep, us.alias("us"), raw_id.alias("id"), F.explode(chain).alias("l"))
    values = lists.select(*keep, "l.field", "us", "id", F.posexplode("l.values").alias("pos", "value"))
    return values.where(blank_to_null(c("value")).isNotNull())
