"""Raw logs to session rows.

One connection's events share a key (uid, else community id, else a synthetic digest).
Scalars, counts and noise are partial aggregates over all events, and list values are made distinct before they are
gathered, so a key that holds a third of all rows never reaches a single task whole.  Nothing that is computed depends on
the arrays of evidence and raw events, which are for display only and may be limited by ``Settings``.

Certificates are summarised once per fingerprint and the summary joins each session, so a
certificate seen by many sessions costs one row per session instead of one per pair.  Lists over certificates are made once per
set of fingerprints that sessions show, and events are counted and listed by such sets (:class:`SharedEvents`).

Deviation: a synthetic session keeps the key of its own events even when an attached
certificate is its earliest event.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.ip import bind, direction_from_local, is_private
from tidewatch.functions.protocols import canonical_protocol, infer_service, service_tokens
from tidewatch.functions.values import (
    blank_to_null, event_order, first_present, floor_time, iso_millis, packed, safe_log_type, synthetic_session_id, unpacked,
)
from tidewatch.operators.sections import SECTIONS, list_values, scalar_struct
from tidewatch.schemas import CERT, EVIDENCE, KEPT_EVENT, null_of
from tidewatch.settings import DEFAULTS, Settings

c = F.col
FLAGS = {"has_notice": ("notice",), "has_weird": ("weird",), "has_files": ("files",), "has_tls": ("ssl", "tls"),
         "has_http": ("http",), "has_dns": ("dns",), "has_ssh": ("ssh",)}
_FIRST = ("uid", "community_id", "orig_h", "src", "orig_p", "p", "resp_h", "dst", "resp_p",
          "local_orig", "local_resp", "proto", "sensor")
_BACKBONE = ("ts", "log_type", "community_id", "orig_h", "src", "orig_p", "p", "resp_h", "dst", "resp_p", "local_orig",
             "local_resp", "proto", "service", "sensor", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts")


def session_key() -> Column:
    return F.coalesce(
        blank_to_null(c("uid")), blank_to_null(c("community_id")),
        synthetic_session_id(
            c("sensor"), c("log_type"), iso_millis(floor_time(c("ts"), 60)),
            first_present(c("orig_h"), c("src")), F.coalesce(c("orig_p"), c("p")),
            first_present(c("resp_h"), c("dst")), c("resp_p")),
    )


def with_session_key(raw: DataFrame) -> DataFrame:
    """Events that can build a session, keyed; certificates and summary logs are left out."""
    typed = raw.withColumn("log_type", safe_log_type(c("log_type")))
    return typed.where((c("log_type") != "x509") & ~c("log_type").startswith("conn-summary")).withColumn("key", session_key())


def evidence_ref() -> Column:
    return F.struct(c("raw_index").alias("index"), c("raw_id").alias("id"), "log_type", c("ts").alias("timestamp"),
                    "uid", "community_id").cast(EVIDENCE)


def kept_event(keep_documents: bool) -> Column:
    cert = F.struct(
        c("fingerprint"), c("cert_subject").alias("subject"), c("cert_issuer").alias("issuer"), c("san_dns"),
        c("cert_not_valid_before").alias("not_valid_before"), c("cert_not_valid_after").alias("not_valid_after"),
        c("cert_key_type").alias("key_type"), c("cert_key_length").alias("key_length"), c("cert_sig_alg").alias("sig_alg"),
        c("basic_constraints_ca").alias("ca"))
    return F.struct(
        "ts", "raw_id", "raw_index", "uid", "community_id", "orig_h", "resp_h", "message", "local_orig", "local_resp",
        c("ndr_noise").alias("noise"), c("ndr_noise_type").alias("noise_type"), c("ndr_noise_reason").alias("noise_reason"),
        F.when(c("log_type") == "x509", cert).cast(CERT).alias("cert"),
        (c("doc") if keep_documents else null_of("string")).alias("doc"),
    ).cast(KEPT_EVENT)


def _us() -> Column:
    return event_order(c("ts"), c("raw_id")).getField("us")


def certificate_table(raw: DataFrame, settings: Settings = DEFAULTS, samples: bool = True, names: bool = True) -> DataFrame:
    """One summary row per fingerprint over its distinct certificate events.

    ``samples`` adds the first evidence references and events, ``names`` the list values.
    """
    x509 = raw.where((safe_log_type(c("log_type")) == "x509") & (c("fingerprint") != "")).withColumn("log_type", F.lit("x509"))
    x509 = x509.dropDuplicates(["fingerprint", "raw_id"]).withColumn("us", _us())
    ordered = F.struct("us", "raw_id")
    summary = x509.groupBy("fingerprint").agg(
        F.count("*").alias("n"), F.min("ts").alias("ts"), F.max("ts").alias("last_ts"),
        F.min(F.struct("us", c("raw_id").alias("id"))).alias("ord"),
        F.min_by(scalar_struct("x509"), ordered).alias("x509_scalars"),
        F.min_by(F.struct(*[b for b in _BACKBONE if b not in ("ts", "log_type")]), ordered).alias("b"),
        *[F.min_by(f, F.when(c(f).isNotNull() & (c(f).cast("string") != ""), ordered)).alias(f"first_{f}") for f in _FIRST],
    )
    if samples:
        order = Window.partitionBy("fingerprint").orderBy("us", "raw_id")
        ranked = (
            x509.select("fingerprint", "us", "raw_id", evidence_ref().alias("ref"), kept_event(settings.keep_raw_documents).alias("event"))
            .withColumn("rank", F.row_number().over(order)).where(within(c("rank"), settings.max_evidence_items))
        )
        summary = summary.join(ranked.groupBy("fingerprint").agg(
            F.collect_list(F.struct("us", c("raw_id").alias("id"), "ref")).alias("refs"),
            F.collect_list(F.when(within(c("rank"), settings.max_events_per_log_type), F.struct("us", c("raw_id").alias("id"), "event"))).alias("events"),
        ), "fingerprint")
    if names:
        listed = list_values(x509, ["x509"], c("us"), c("raw_id"), "fingerprint")
        values = listed.unionByName(noise_items(x509, "fingerprint")).groupBy("fingerprint", "field", "value").agg(F.min(F.struct("us", "id", "pos")).alias("o"))
        summary = summary.join(values.groupBy("fingerprint").agg(
            F.collect_list(F.struct("field", "o.us", "o.id", "o.pos", "value")).alias("items")), "fingerprint", "left")
    return summary


def noise_items(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep.., field ``noise``, us, id, pos, value) of the rows that were marked as noise: what kind, and why."""
    kind, why = blank_to_null(c("ndr_noise_type")), blank_to_null(c("ndr_noise_reason"))
    tags = F.array(F.coalesce(kind, F.lit("vector_noise")), F.coalesce(why, kind, F.lit("vector_noise")))
    marked = rows.where(F.coalesce("ndr_noise", F.lit(False))).select(*keep, _us().alias("us"), c("raw_id").alias("id"), F.posexplode(tags).alias("pos", "value"))
    return marked.select(*keep, F.lit("noise").alias("field"), "us", "id", "pos", "value")


def evidence_rows(raw: DataFrame, certificates: bool = True) -> DataFrame:
    """Every event behind every session, uncut: (key, log_type, us, raw_id, ref), once each, certificates included."""
    return _long_rows(raw, evidence_ref().alias("ref"), certificates)


def kept_event_rows(raw: DataFrame, settings: Settings = DEFAULTS, certificates: bool = True) -> DataFrame:
    """The kept events of every session, uncut: (key, log_type, us, raw_id, event), once each, certificates included.

    Rows are dealt out by event, so a session of any size is spread over many tasks.
    """
    return _long_rows(raw, kept_event(settings.keep_raw_documents).alias("event"), certificates)


def _long_rows(raw: DataFrame, value: Column, certificates: bool) -> DataFrame:
    keyed = with_session_key(raw).select("key", "log_type", _us().alias("us"), "raw_id", value)
    if certificates:
        keyed = keyed.unionByName(attach_certificates(with_session_key(raw), _certificate_rows(raw, value)).drop("fingerprint"))
    return keyed.dropDuplicates(["key", "log_type", "raw_id"])


def _certificate_rows(raw: DataFrame, value: Column) -> DataFrame:
    """(fingerprint, log_type, us, raw_id, value) of every certificate event, once each."""
    x509 = raw.where((safe_log_type(c("log_type")) == "x509") & (c("fingerprint") != "")).withColumn("log_type", F.lit("x509"))
    return x509.select("fingerprint", "log_type", _us().alias("us"), "raw_id", value).dropDuplicates(["fingerprint", "raw_id"])


class SharedEvents(NamedTuple):
    """The events of sessions without a row per session and certificate, of which there are as many as the product of both.

    ``own`` is the long table without certificates, ``shown`` has (key, token) per session and fingerprint, ``certificates`` the
    events of each token. A session's events are its own and those of its tokens, once each.
    """

    own: DataFrame
    shown: DataFrame
    certificates: DataFrame

    def tagged(self, tag: str) -> SharedEvents:
        """Tokens of a read window of their own: a session shows only the certificates of the window."""
        name = F.concat(F.lit(f"{tag}:"), "token")
        return SharedEvents(self.own, self.shown.withColumn("token", name), self.certificates.withColumn("token", name))

    def union(self, other: SharedEvents) -> SharedEvents:
        return SharedEvents(*(a.unionByName(b) for a, b in zip(self.tagged("0"), other.tagged("1"), strict=True)))


def shared_evidence(raw: DataFrame) -> SharedEvents:
    """What :func:`evidence_rows` has, with each certificate once."""
    return _shared(raw, evidence_rows(raw, certificates=False), evidence_ref().alias("ref"))


def shared_events(raw: DataFrame, settings: Settings = DEFAULTS) -> SharedEvents:
    """What :func:`kept_event_rows` has, with each certificate once."""
    return _shared(raw, kept_event_rows(raw, settings, certificates=False), kept_event(settings.keep_raw_documents).alias("event"))


def _shared(raw: DataFrame, own: DataFrame, value: Column) -> SharedEvents:
    return SharedEvents(own, shown_fingerprints(with_session_key(raw)).withColumnRenamed("fingerprint", "token"),
                        _certificate_rows(raw, value).withColumnRenamed("fingerprint", "token"))


def summed_events(events: SharedEvents) -> DataFrame:
    """(key, n, first, last): number of a session's events, and (us, raw_id) of the first and last of them.

    Certificate events of the same tokens are one group, which sessions count as a whole; a session meets a group once, however many of its tokens it shows.
    """
    at = F.struct("us", "raw_id")
    summary = (F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))
    own = events.own.select("key", "log_type", "us", "raw_id").groupBy("key", "log_type", "raw_id").agg(F.min("us").alias("us")).groupBy("key").agg(*summary)
    placed = events.certificates.groupBy("raw_id").agg(F.min("us").alias("us"), F.array_sort(F.collect_set("token")).alias("tokens"))
    groups = placed.groupBy("tokens").agg(*summary).select(F.sha2(F.to_json("tokens"), 256).alias("group"), "n", "first", "last", F.explode("tokens").alias("token"))
    met = events.shown.join(groups, "token").select("key", "group", "n", "first", "last").distinct().drop("group")
    return own.unionByName(met).groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def listed_shared_ids(events: SharedEvents) -> DataFrame:
    """What :func:`listed_ids` gives; ids of certificates are put together once per set of tokens that sessions show."""
    known = events.certificates.select("token").distinct()
    sets = events.shown.distinct().join(known, "token", "left_semi").groupBy("key").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    members = sets.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    rows = members.join(events.certificates.select("token", "log_type", "us", "raw_id"), "token").dropDuplicates(["tokens", "raw_id"])
    lists = listed_ids(rows.select(c("tokens").alias("key"), "log_type", "us", "raw_id")).withColumnRenamed("key", "tokens")
    return listed_ids(events.own).unionByName(sets.join(lists, "tokens").drop("tokens"))


def listed_ids(events: DataFrame) -> DataFrame:
    """(key, log_type, n, ids): ids in time order as one text, sorted and joined by minute first, so that no task sorts a whole session."""
    minute = F.floor(c("us") / 60000000).alias("minute")
    ids = F.transform(F.array_sort(F.collect_list(F.struct("us", "raw_id"))), lambda e: e.raw_id)
    parts = events.groupBy("key", "log_type", minute).agg(F.count(F.lit(1)).alias("n"), F.array_join(ids, "|").alias("ids"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("minute", "ids"))), lambda e: e.ids)
    return parts.groupBy("key", "log_type").agg(F.sum("n").alias("n"), F.array_join(texts, "|").alias("ids"))


def attach_certificates(keyed: DataFrame, certificates: DataFrame) -> DataFrame:
    """(key, certificate summary) for every distinct fingerprint a session's handshakes presented."""
    return shown_fingerprints(keyed).join(certificates, "fingerprint")


def shown_fingerprints(keyed: DataFrame) -> DataFrame:
    """(key, fingerprint) of the handshakes, once each."""
    return (
        keyed.where(c("log_type").isin("ssl", "tls"))
        .select("key", F.explode("cert_chain_fps").alias("fingerprint"))
        .where(c("fingerprint") != "").distinct()
    )


def _certificate_lists(keyed: DataFrame, certificates: DataFrame, names: Sequence[str]) -> DataFrame:
    """(key, cert_lists, cert_noise): list values over all certificates a session shows, made once per set of fingerprints."""
    sets = shown_fingerprints(keyed).groupBy("key").agg(F.array_sort(F.collect_list("fingerprint")).alias("shown"))
    members = sets.select("shown").distinct().select("shown", F.explode("shown").alias("fingerprint"))
    items = members.join(certificates.select("fingerprint", "items"), "fingerprint").select("shown", F.explode("items").alias("i")).select("shown", "i.*")
    entries = (
        items.groupBy("shown", "field", "value").agg(F.min(F.struct("us", "id", "pos")).alias("o"))
        .groupBy("shown").agg(F.collect_list(F.struct("field", "o", "value")).alias("entries"))
    )
    lists = F.struct(*[_list_field("x509", f).alias(f) for f in SECTIONS["x509"].lists]) if "x509" in names else null_of("int")
    return sets.join(entries.select("shown", lists.alias("cert_lists"), _noise_entries(c("entries")).alias("cert_noise")), "shown").drop("shown")


def _noise_entries(entries: Column) -> Column:
    return F.filter(entries, lambda e: e.field == "noise")


def _own_partials(keyed: DataFrame) -> DataFrame:
    ordered = event_order(c("ts"), c("raw_id"))
    return keyed.select("*", F.lit(1).cast("bigint").alias("n"), c("ts").alias("last_ts"), ordered.alias("ord"))


def _certificate_partials(attached: DataFrame, types: dict[str, str]) -> DataFrame:
    """Attached certificate summaries in the shape of an event, so both aggregate together."""
    have = {"key": c("key"), "n": c("n"), "ts": c("ts"), "last_ts": c("last_ts"), "ord": c("ord"), "log_type": F.lit("x509"),
            "raw_id": c("ord.id")}
    have |= {b: c(f"b.{b}") for b in _BACKBONE if b not in ("ts", "log_type")}
    have |= {f: c(f"first_{f}") for f in _FIRST}
    have |= {f: c(f"x509_scalars.{f}") for f in SECTIONS["x509"].scalars}
    return attached.select(*[(have[w] if w in have else null_of(t)).cast(t).alias(w) for w, t in types.items()])


def _ranked(rows: DataFrame, by: Sequence[str], limit: int | None) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("us", "raw_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(within(c("rank"), limit))


def within(rank: Column, limit: int | None) -> Column:
    return F.lit(True) if limit is None else rank <= limit


def first_items(items: Column, limit: int | None) -> Column:
    return items if limit is None else F.slice(items, 1, limit)


def _list_field(section: str, name: str) -> Column:
    spec = SECTIONS[section]

    def values(tag: str) -> Column:
        hits = F.sort_array(F.filter(c("entries"), lambda e: e.field == tag))
        return F.transform(hits, lambda e: e.value)

    if len(spec.log_types) == 1:
        out = values(f"{section}.{name}")
    else:  # lists of merged log types are joined in the order in which the types first appear
        per_type = F.array(*[
            F.struct(F.coalesce(c(f"first_{t}"), F.lit(9223372036854775807)).alias("o"), values(f"{section}.{name}.{t}").alias("l"))
            for t in spec.log_types
        ])
        out = F.array_distinct(F.flatten(F.transform(F.array_sort(per_type), lambda x: x.l)))
    filled = bind(out, lambda values: F.when(F.size(values) > 0, values))
    return filled.cast(spec.list_types.get(name, "array<string>"))


def build_sessions(raw: DataFrame, settings: Settings = DEFAULTS, sections: Sequence[str] | None = None,
                   parts: Sequence[str] = ("certificates", "facts", "evidence", "events"),
                   certificates: DataFrame | None = None, updated_at: Column | None = None,
                   with_key: bool = False) -> DataFrame:
    """Session rows from raw logs.

    ``sections`` and ``parts`` restrict the work to what a caller reads; the omitted columns
    are typed nulls.  ``facts`` are what hardening needs of all events: their number, noise, fragments.  The parts ``evidence``
    and ``events`` are arrays for documents; :func:`evidence_rows` and :func:`kept_event_rows` have the same as long tables, for sessions of any size.
    ``certificates`` replaces the certificate table of this read window,
    e.g. by a stored one that also knows certificates logged earlier.
    """
    names = list(SECTIONS) if sections is None else list(sections)
    keyed = with_session_key(raw)
    partials, attached = _own_partials(keyed), None
    if "certificates" in parts:
        if certificates is None:
            certificates = certificate_table(raw, settings, bool({"evidence", "events"} & set(parts)), "x509" in names or "facts" in parts)
        attached = attach_certificates(keyed, certificates)
        partials = partials.unionByName(_certificate_partials(attached, dict(partials.dtypes)))

    def present(f: str) -> Column:
        return c(f).isNotNull() & (c(f).cast("string") != "")

    aggs = [
        F.sum("n").alias("event_count"), F.min("ts").alias("first_seen"), F.max("last_ts").alias("last_seen"),
        F.array_sort(F.collect_set("log_type")).alias("log_types"),
        F.min_by(F.struct(*_BACKBONE), F.when(c("log_type") == "conn", c("ord"))).alias("conn_backbone"),
        F.min_by(F.struct(*_BACKBONE), "ord").alias("any_backbone"),
        *[F.min_by(f, F.when(present(f), c("ord"))).alias(f"first_{f}") for f in _FIRST],
        F.bool_or(present("message") & ~present("uid") & ~present("orig_h") & ~present("resp_h")).alias("fragment"),
    ]
    for name in names:
        spec = SECTIONS[name]
        for t in spec.log_types:
            here = F.when(c("log_type") == t, c("ord"))
            if spec.scalars:
                aggs.append(F.min_by(scalar_struct(name), here).alias(f"s_{t}"))
            if len(spec.log_types) > 1:
                aggs.append(F.min(here.getField("us")).alias(f"first_{t}"))
        for f in spec.sums:
            aggs.append(F.sum(F.when(c("log_type").isin(*spec.log_types), c(f))).alias(f"sum_{f}"))
    core = partials.groupBy("key").agg(*aggs)

    # One column while the other parts are joined to it: sorts and joins copy it as a whole.
    core = core.select("key", F.struct(*core.columns[1:]).alias("core"))

    listed = list_values(keyed, names, _us(), c("raw_id"), "key")
    if listed is not None or "facts" in parts:
        exploded = noise_items(keyed, "key") if "facts" in parts else None
        if listed is not None:
            exploded = listed if exploded is None else exploded.unionByName(listed)
        entries = (
            exploded.groupBy("key", "field", "value").agg(F.min(F.struct("us", "id", "pos")).alias("o"))
            .groupBy("key").agg(F.collect_list(F.struct("field", "o", "value")).alias("entries"))
        )
        core = core.join(entries, "key", "left")
    if attached is not None and ("x509" in names or "facts" in parts):
        core = core.join(_certificate_lists(keyed, certificates, names), "key", "left")

    if "facts" in parts:
        ids = keyed.select("key", "raw_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("own_ids"))
        core = core.join(ids, "key")
        if attached is not None:
            core = core.join(attached.groupBy("key").agg(F.sum("n").alias("cert_ids")), "key", "left")
    # A copied event counts in event_count but is kept once here.
    distinct_events = keyed.dropDuplicates(["key", "raw_id"]).withColumn("us", _us())
    if "evidence" in parts:
        refs = _ranked(distinct_events.select("key", "us", "raw_id", evidence_ref().alias("ref")), ["key"], settings.max_evidence_items)
        core = core.join(refs.groupBy("key").agg(F.collect_list(F.struct("us", c("raw_id").alias("id"), "ref")).alias("refs")), "key", "left")
    if "events" in parts:
        events = _ranked(distinct_events.select("key", "log_type", "us", "raw_id", kept_event(settings.keep_raw_documents).alias("event")),
                         ["key", "log_type"], settings.max_events_per_log_type)
        events = events.groupBy("key", "log_type").agg(F.collect_list(F.struct("us", c("raw_id").alias("id"), "event")).alias("l"))
        events = events.groupBy("key").agg(F.collect_list(F.struct("log_type", F.transform(F.array_sort("l"), lambda e: e.event).alias("l"))).alias("events"))
        core = core.join(events, "key", "left")
    if attached is not None and {"evidence", "events"} & set(parts):
        samples = attached.groupBy("key").agg(
            F.flatten(F.collect_list("refs")).alias("cert_refs"),
            first_items(F.array_sort(F.flatten(F.collect_list("events"))), settings.max_events_per_log_type).alias("cert_events"))
        core = core.join(samples, "key", "left")
    return _assemble(core, names, settings, F.current_timestamp() if updated_at is None else updated_at, with_key)


def flag_columns(log_types: Column) -> dict[str, Column]:
    return {name: F.arrays_overlap(log_types, F.array(*[F.lit(t) for t in types])) for name, types in FLAGS.items()}


# Columns that only hardening fills; present from the start so stored and new rows share one schema.
HARDENED_COLUMNS = {
    "key_type": "string", "flow_based": "boolean", "category": "string", "excluded_from_behavior": "boolean",
    "noise_reasons": "array<string>", "evidence_count": "int", "raw_event_count": "int", "normalized_event_count": "int",
    "events_truncated": "boolean", "noise_tags": "array<string>", "fragment": "boolean", "conn_local_orig": "boolean", "conn_local_resp": "boolean", "scope": "string", "same_subnet": "boolean", "same_spoke": "boolean", "same_vnet": "boolean",
    **{f"asset_{f}": "string" for f in ("ip", "side", "spoke", "vnet", "subnet", "subnet_cidr", "scope")},
    **{f"{side}_{f}": "string" for side in ("src", "dst") for f in ("scope", "spoke", "vnet", "subnet", "subnet_cidr")},
}


def _assemble(df: DataFrame, names: Sequence[str], settings: Settings, updated_at: Column, with_key: bool = False) -> DataFrame:
    df = df.select("core.*", *[n for n in df.columns if n != "core"])
    light = {"key", "log_types", "conn_backbone", "any_backbone", *[f"first_{f}" for f in _FIRST]}
    df, kept = packed(df, [n for n in df.columns if n not in light])
    df = df.withColumn("bb", F.coalesce("conn_backbone", "any_backbone"))

    def pick(*fields: str) -> Column:
        options = [c(f"bb.{f}") for f in fields] + [c(f"first_{f}") for f in fields]
        return F.coalesce(*[F.when(o.cast("string") != "", o) for o in options])

    def total(a: str, b: str) -> Column:
        value = F.coalesce(c(f"bb.{a}"), F.lit(0)) + F.coalesce(c(f"bb.{b}"), F.lit(0))
        return F.when(value != 0, value)

    df = df.withColumns({
        "src_ip": pick("orig_h", "src"), "src_port": pick("orig_p", "p"), "dst_ip": pick("resp_h", "dst"), "dst_port": pick("resp_p"),
        "community_id": pick("community_id"), "uid": c("first_uid"), "transport": pick("proto"), "sensor": pick("sensor"),
        "bytes": total("orig_bytes", "resp_bytes"), "packets": total("orig_pkts", "resp_pkts"),
    })
    df = df.withColumns({
        "src_local": F.coalesce(pick("local_orig"), is_private(c("src_ip"))),
        "dst_local": F.coalesce(pick("local_resp"), is_private(c("dst_ip"))),
        "protocols": service_tokens(F.coalesce(blank_to_null(c("bb.service")), infer_service(c("log_types"), c("dst_port")))),
    })
    df = unpacked(df, kept)
    have = set(df.columns)
    out = {"key": c("key")} if with_key else {}
    out |= {
        "session_id": F.coalesce("uid", "community_id", "key"),
        "ts": F.coalesce("bb.ts", "first_seen"),
        **{n: c(n) for n in ("uid", "community_id", "first_seen", "last_seen", "log_types", "event_count")},
        **flag_columns(c("log_types")),
        **{n: c(n) for n in ("sensor", "src_ip", "src_port", "src_local", "dst_ip", "dst_port", "dst_local", "transport")},
        "protocol": canonical_protocol(c("protocols")),
        "protocols": F.when(F.size("protocols") > 0, c("protocols")),
        "bytes": c("bytes"), "packets": c("packets"),
        "direction": direction_from_local(c("src_local"), c("dst_local")),
        **{n: null_of(t) for n, t in HARDENED_COLUMNS.items()},
    }
    for name in names:
        out[name] = _section_column(name, have)
    if "own_ids" in have:
        total_ids = F.col("own_ids") + (F.coalesce("cert_ids", F.lit(0)) if "cert_ids" in have else F.lit(0))
        none = F.array().cast(dict(df.dtypes)["entries"])
        noise = _noise_entries(F.coalesce("entries", none))
        if "cert_noise" in have:
            noise = F.concat(noise, F.coalesce("cert_noise", none))
        noise = F.array_distinct(F.transform(F.array_sort(noise), lambda e: e.value))
        out |= {"evidence_count": total_ids.cast("int"), "normalized_event_count": total_ids.cast("int"), "noise_tags": noise, "fragment": c("fragment"),
                "conn_local_orig": c("conn_backbone.local_orig"), "conn_local_resp": c("conn_backbone.local_resp")}
    out["evidence"] = _evidence(have, settings)
    out["zeek"] = _kept_events(have)
    out["updated_at"] = updated_at
    return df.select(*[v.alias(n) for n, v in out.items()])


def _evidence(have: set[str], settings: Settings) -> Column:
    if "refs" not in have:
        return null_of(f"array<{EVIDENCE}>")
    refs = c("refs")
    if "cert_refs" in have:
        refs = F.concat(F.coalesce("refs", F.array().cast(f"array<struct<us:bigint,id:string,ref:{EVIDENCE}>>")),
                        F.coalesce("cert_refs", F.array().cast(f"array<struct<us:bigint,id:string,ref:{EVIDENCE}>>")))
    return F.transform(first_items(F.array_sort(refs), settings.max_evidence_items), lambda e: e.ref)


def _kept_events(have: set[str]) -> Column:
    """Kept events as a map from log type to its first events in time order."""
    if "events" not in have:
        return null_of(f"map<string,array<{KEPT_EVENT}>>")
    entries = F.coalesce("events", F.array().cast(f"array<struct<log_type:string,l:array<{KEPT_EVENT}>>>"))
    if "cert_events" in have:
        certs = F.filter(F.array(F.struct(F.lit("x509").alias("log_type"), F.transform("cert_events", lambda e: e.event).alias("l"))),
                         lambda x: F.size(x.l) > 0)
        entries = F.concat(entries, certs)
    return F.map_from_entries(entries)


_HARDENED_FIELDS = {
    "x509": {"is_ca": "boolean"},
    "files": {"count": "int", "mime_type_count": "int", "hash_count": "int"},
}


def _section_column(name: str, have: set[str]) -> Column:
    spec = SECTIONS[name]
    fields = []
    if spec.scalars and len(spec.log_types) == 1:
        t = spec.log_types[0]
        fields += [c(f"s_{t}.{f}").alias(f) for f in spec.scalars]
    elif spec.scalars:  # two log types with scalars: the one that appeared later wins where it has a value
        a, b = spec.log_types
        newer_a = F.coalesce(c(f"first_{a}"), F.lit(-1)) > F.coalesce(c(f"first_{b}"), F.lit(-1))
        for f in spec.scalars:
            va, vb = c(f"s_{a}.{f}"), c(f"s_{b}.{f}")
            fields.append(F.when(newer_a, F.coalesce(va, vb)).otherwise(F.coalesce(vb, va)).alias(f))
    if name == "x509":  # its events are certificates, so its lists come with them
        fields += [(c(f"cert_lists.{f}") if "cert_lists" in have else null_of(spec.list_types.get(f, "array<string>"))).alias(f) for f in spec.lists]
    else:
        fields += [_list_field(name, f).alias(f) for f in spec.lists]
    fields += [c(f"sum_{f}").alias(f) for f in spec.sums]
    fields += [null_of(t).alias(f) for f, t in _HARDENED_FIELDS.get(name, {}).items()]
    seen = F.arrays_overlap(c("log_types"), F.array(*[F.lit(t) for t in spec.log_types]))
    return F.when(seen, F.struct(*fields))


def to_documents(sessions: DataFrame) -> DataFrame:
    """The nested document shape of a session, for sinks and readers that want it."""
    s = dict(sessions.dtypes)
    group = lambda *pairs: F.struct(*[c(a).alias(b) for a, b in pairs if a in s])
    place = lambda side: group(*[(f"{side}_{f}", f) for f in ("scope", "spoke", "vnet", "subnet", "subnet_cidr")])
    asset = group(*[(f"asset_{f}", f) for f in ("ip", "side", "spoke", "vnet", "subnet", "subnet_cidr", "scope")])
    return sessions.select(
        iso_millis(c("ts")).alias("@timestamp"), F.struct(F.lit("ndr_session").alias("type")).alias("doc"),
        group(("session_id", "id"), *[(n, n) for n in ("uid", "community_id", "first_seen", "last_seen", "log_types", "event_count", *FLAGS,
              "key_type", "flow_based", "category", "excluded_from_behavior", "noise_reasons", "evidence_count", "raw_event_count",
              "normalized_event_count", "events_truncated")]).alias("session"),
        group(("sensor", "name")).alias("sensor"),
        group(("src_ip", "ip"), ("src_port", "port"), ("src_local", "local")).alias("source"),
        group(("dst_ip", "ip"), ("dst_port", "port"), ("dst_local", "local")).alias("destination"),
        F.struct(*[c(n) for n in ("transport", "protocol", "protocols", "community_id", "bytes", "packets", "direction", "scope",
                                  "same_subnet", "same_spoke", "same_vnet")], asset.alias("asset")).alias("network"),
        F.struct(F.lit("azure").alias("provider"), F.struct(place("src").alias("source"), place("dst").alias("destination")).alias("azure")).alias("cloud"),
        *[c(n) for n in SECTIONS if n in s], "evidence", "zeek", F.struct("updated_at").alias("sessionizer"),
    )
