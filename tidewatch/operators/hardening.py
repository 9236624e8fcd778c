"""Session hardening.  The step order is part of the semantics: later steps overwrite earlier ones.

In particular the control-plane step runs last and, when it finds nothing, sets
``excluded_from_behavior`` back to false, also for noise and non-flow sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.ip import (
    classify_ip, direction_from_local, drop_parsed_ips, local_test, parsed, with_parsed_ips,
)
from tidewatch.functions.protocols import hardened_protocol, literal_map
from tidewatch.functions.values import blank_to_null, packed, unique_values, unpacked
from tidewatch.operators.merge import count_kept_events
from tidewatch.operators.sections import SECTIONS
from tidewatch.operators.sessions import FLAGS
from tidewatch.settings import DEFAULTS, SEMANTIC_PORTS, Settings

c = F.col
Subnets = Sequence[tuple[str, str, str, str]]


def _texts() -> Column:
    return F.array().cast("array<string>")


def harden_protocol(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumn("protocol", hardened_protocol(c("protocol"), c("log_types"), c("dst_port"), settings.unknown_protocol))


def _with_ends(df: DataFrame) -> DataFrame:
    """Both addresses parsed, for the steps that test them."""
    return with_parsed_ips(df, s=c("src_ip"), d=c("dst_ip"))


def _without_ends(df: DataFrame) -> DataFrame:
    return drop_parsed_ips(df, "s", "d")


def harden_direction(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Sensor flags of the first kept conn event, else address locality.  Topology overrides this."""
    return df.transform(_with_ends).transform(_direction, settings).transform(_without_ends)


def _direction(df: DataFrame, settings: Settings) -> DataFrame:
    df = df.withColumns({
        "_sl": F.coalesce(c("conn_local_orig"), local_test(parsed("s", c("src_ip")), settings.internal_networks)),
        "_dl": F.coalesce(c("conn_local_resp"), local_test(parsed("d", c("dst_ip")), settings.internal_networks)),
    })
    df = df.withColumns({
        "src_local": F.coalesce("_sl", "src_local"), "dst_local": F.coalesce("_dl", "dst_local"),
        "direction": direction_from_local(c("_sl"), c("_dl")),
    })
    return df.drop("_sl", "_dl")


def classify_topology(df: DataFrame, subnets: Subnets) -> DataFrame:
    """Scope, direction and asset side from the subnets of both ends."""
    return df.transform(_with_ends).transform(_topology, subnets).transform(_without_ends)


def _topology(df: DataFrame, subnets: Subnets) -> DataFrame:
    df = df.withColumns({"_s": classify_ip(parsed("s", c("src_ip")), subnets), "_d": classify_ip(parsed("d", c("dst_ip")), subnets)})

    def same(field: str) -> Column:
        return blank_to_null(c(f"_s.{field}")) == blank_to_null(c(f"_d.{field}"))

    src, dst = (F.coalesce(c(f"{x}.local"), F.lit(False)) for x in ("_s", "_d"))
    df = df.withColumns({"_src": src, "_dst": dst, "_subnet": same("subnet_cidr"), "_spoke": same("spoke"), "_vnet": same("vnet")})
    both, out, inward = c("_src") & c("_dst"), c("_src") & ~c("_dst"), ~c("_src") & c("_dst")
    scope = (
        F.when(both & c("_subnet"), "same_subnet").when(both & c("_spoke"), "same_spoke_cross_subnet")
        .when(both & c("_vnet"), "same_vnet_cross_subnet").when(both & ~c("_spoke"), "cross_spoke")
        .when(both, "internal_unknown").when(out, "outbound_external").when(inward, "inbound_external").otherwise("external_external")
    )
    direction = F.when(both, "internal").when(out, "outbound").when(inward, "inbound").otherwise("external_or_unknown")
    df = df.withColumn("_asset", F.when(c("_src"), c("_s")).when(c("_dst"), c("_d")))
    found = c("_asset.ip").isNotNull()
    side = F.when(c("_src"), "source").otherwise("destination")
    df = df.withColumns({
        "src_local": F.coalesce("_s.local", "src_local"), "dst_local": F.coalesce("_d.local", "dst_local"),
        "direction": direction, "scope": scope,
        "same_subnet": F.coalesce("_subnet", "same_subnet"), "same_spoke": F.coalesce("_spoke", "same_spoke"),
        "same_vnet": F.coalesce("_vnet", "same_vnet"),
        "asset_ip": F.coalesce("_asset.ip", "asset_ip"), "asset_side": F.when(found, side).otherwise(c("asset_side")),
        **{f"asset_{f}": F.coalesce(f"_asset.{f}", f"asset_{f}") for f in ("spoke", "vnet", "subnet", "subnet_cidr", "scope")},
        **{f"{a}_{f}": F.coalesce(f"_{a[0]}.{f}", f"{a}_{f}") for a in ("src", "dst") for f in ("scope", "spoke", "vnet", "subnet", "subnet_cidr")},
    })
    return df.drop("_s", "_d", "_src", "_dst", "_subnet", "_spoke", "_vnet", "_asset")


def harden_counts(df: DataFrame) -> DataFrame:
    """Counts over all events; those of arrays where a merge has put them together anew."""
    kept = count_kept_events(c("zeek"))
    df = df.withColumns({
        "evidence_count": F.coalesce(F.nullif(F.size("evidence"), F.lit(-1)), c("evidence_count"), F.lit(0)),
        "normalized_event_count": F.when(kept > 0, kept).otherwise(F.coalesce("normalized_event_count", F.lit(0))),
    })
    return df.withColumns({"raw_event_count": c("evidence_count"), "events_truncated": c("evidence_count") > c("normalized_event_count")})


def harden_x509(df: DataFrame) -> DataFrame:
    """Whether any certificate of the session is an authority's; the lists over all its certificates are there already."""
    if "x509" not in df.columns:
        return df
    ca = F.coalesce(F.array_contains("x509.ca_flags", True), F.lit(False))
    return df.withColumn("x509", F.when(c("x509").isNotNull(), c("x509").withField("is_ca", ca)))


def harden_files(df: DataFrame) -> DataFrame:
    if "files" not in df.columns:
        return df

    def distinct(*fields: str) -> Column:
        return F.size(unique_values(F.concat(*[F.coalesce(c(f"files.{f}"), _texts()) for f in fields])))

    x = c("files").withField("count", distinct("fuids")).withField("mime_type_count", distinct("mime_types"))
    x = x.withField("hash_count", distinct("md5", "sha1", "sha256"))
    x = x.withField("total_bytes", F.coalesce(F.when(c("files.total_bytes") != 0, c("files.total_bytes")), c("files.seen_bytes"),
                                              c("files.total_bytes")))
    return df.withColumn("files", F.when(c("files").isNotNull(), x))


def roll_up_noise(df: DataFrame) -> DataFrame:
    found = F.coalesce(F.size("noise_tags"), F.lit(0)) > 0
    return df.withColumns({
        "category": F.when(found, "noise").otherwise(c("category")),
        "excluded_from_behavior": F.when(found, True).otherwise(c("excluded_from_behavior")),
        "noise_reasons": F.when(found, unique_values(F.concat(F.coalesce("noise_reasons", _texts()), "noise_tags"))).otherwise(c("noise_reasons")),
    })


def key_type_and_flow(df: DataFrame) -> DataFrame:
    filled = lambda x: F.coalesce(x != "", F.lit(False))
    sid = F.coalesce(c("session_id"), F.lit(""))
    key_type = (
        F.when(sid.startswith("synthetic:"), "synthetic").when(filled(c("uid")), "uid")
        .when(filled(c("community_id")), "community_id").otherwise("unknown")
    )
    fragment = c("fragment")
    df = df.withColumns({
        "key_type": key_type,
        "flow_based": filled(c("src_ip")) & filled(c("dst_ip")) & c("src_port").isNotNull() & c("dst_port").isNotNull() & filled(c("uid")),
        "_why": F.when(F.array_contains("log_types", "dhcp"), "non_flow:dhcp")
        .when(F.coalesce(fragment, F.lit(False)), "malformed_raw_event").otherwise("non_flow:synthetic"),
    })
    category = (
        F.when(c("flow_based"), c("category")).when(c("_why") == "non_flow:dhcp", "control_plane")
        .when(c("_why") == "malformed_raw_event", "malformed_raw")
        .otherwise(F.coalesce(blank_to_null(c("category")), F.lit("non_flow")))
    )
    reasons = unique_values(F.concat(F.coalesce("noise_reasons", _texts()), F.array("_why")))
    return df.withColumns({
        "category": category,
        "excluded_from_behavior": F.when(c("flow_based"), c("excluded_from_behavior")).otherwise(True),
        "noise_reasons": F.when(c("flow_based"), c("noise_reasons")).otherwise(reasons),
    }).drop("_why")


def tag_control_plane(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    protocol, dst, src = c("protocol"), c("dst_port"), c("src_port")
    names = literal_map(SEMANTIC_PORTS)
    reasons = unique_values(F.array(
        F.when(protocol.isin(*settings.control_plane_protocols), F.concat(F.lit("protocol:"), protocol)),
        F.when(dst.isin(*settings.control_plane_ports), F.concat(F.lit("destination_port:"), dst.cast("string"))),
        F.when(src.isin(*settings.control_plane_ports), F.concat(F.lit("source_port:"), src.cast("string"))),
        F.try_element_at(names, dst.cast("int")), F.try_element_at(names, src.cast("int")),
    ))
    df = df.withColumn("_r", reasons)
    hit = F.size("_r") > 0
    return df.withColumns({
        "category": F.when(hit, "control_plane").otherwise(c("category")), "excluded_from_behavior": hit,
        "noise_reasons": F.when(hit, c("_r")).otherwise(c("noise_reasons")),
    }).drop("_r")


# Columns that no step reads or writes: they pass through as one.
UNTOUCHED = ("key", "ts", "first_seen", "last_seen", "event_count", *FLAGS, "sensor", "transport", "protocols", "bytes", "packets",
             *[name for name in SECTIONS if name not in ("x509", "files")], "updated_at")


def harden_sessions(df: DataFrame, subnets: Subnets = (), settings: Settings = DEFAULTS) -> DataFrame:
    """All steps in their fixed order; one narrow stage, no shuffle."""
    rows, kept = packed(df, [n for n in df.columns if n in UNTOUCHED])
    rows = (
        rows.transform(harden_protocol, settings)
        .transform(_with_ends)  # the addresses do not change in between
        .transform(_direction, settings)
        .transform(_topology, subnets)
        .transform(_without_ends)
        .transform(harden_counts)
        .transform(harden_x509)
        .transform(harden_files)
        .transform(roll_up_noise)
        .transform(key_type_and_flow)
        .transform(tag_control_plane, settings)
    )
    hardened = unpacked(rows, kept)
    return hardened.select(*df.columns, *[n for n in hardened.columns if n not in df.columns])
