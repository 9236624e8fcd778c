"""Flow-record normalisation (NetFlow / IPFIX JSON lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import settings as S
from tidewatch.functions.ip import flow_direction, parsed, with_parsed_ips
from tidewatch.functions.protocols import transport_name
from tidewatch.functions.values import ns_to_ts, safe_int_strict

# Accepted spellings of each field family, in order of preference.
ALIASES = {
    "proto": ("proto", "protocol", "ip_proto"),
    "src_ip": ("src_addr", "srcaddr", "ipv4_src_addr", "ipv6_src_addr"),
    "dst_ip": ("dst_addr", "dstaddr", "ipv4_dst_addr", "ipv6_dst_addr"),
    "src_port": ("src_port", "l4_src_port", "srcport"),
    "dst_port": ("dst_port", "l4_dst_port", "dstport"),
    "start_ns": ("time_flow_start_ns", "flow_start_ns"),
    "end_ns": ("time_flow_end_ns", "flow_end_ns"),
    "received_ns": ("time_received_ns", "received_ns"),
    "bytes": ("bytes", "in_bytes", "octets", "flow_bytes"),
    "packets": ("packets", "in_pkts", "pkts", "flow_packets"),
    "observer_ip": ("sampler_address", "agent_ip", "exporter_ip"),
    "src_mac": ("src_mac", "source_mac"),
    "dst_mac": ("dst_mac", "destination_mac"),
    "src_vlan": ("src_vlan", "vlan_id"),
    "dst_vlan": ("dst_vlan", "vlan_id"),
    "flow_id": ("flow_id", "id"),
    "version": ("type", "version"),
    "sequence_num": ("sequence_num",),
    "sampling_rate": ("sampling_rate",),
    "in_interface": ("in_if", "input_snmp"),
    "out_interface": ("out_if", "output_snmp"),
    "tcp_flags": ("tcp_flags",),
    "ip_tos": ("ip_tos",),
    "forwarding_status": ("forwarding_status",),
}


def parse_flow_lines(lines: DataFrame) -> DataFrame:
    """Keep decodable JSON objects; ``line_status`` tells blank, skipped and good lines apart."""
    text = F.trim("value")
    v = F.when(text.startswith("{"), F.try_parse_json(text))
    status = F.when(text == "", "blank").when(v.isNull(), "skipped").otherwise("parsed")
    return lines.select("*", v.alias("v"), status.alias("line_status"))


def get_first(v: Column, names) -> Column:
    """First spelling that is present and not blank, as text."""
    found = F.array(*[F.try_variant_get(v, f"$.{n}", "string") for n in names])
    return F.get(F.filter(found, lambda x: x != ""), F.lit(0))


def flow_noise_reasons(src_ip: Column, dst_ip: Column, dst_port: Column, bytes_: Column, packets: Column) -> Column:
    export = src_ip.isin(*S.FLOW_EXPORTER_IPS) & dst_ip.isin(*S.FLOW_COLLECTOR_IPS) & dst_port.isin(*S.FLOW_EXPORT_PORTS)
    empty = (F.coalesce(bytes_, F.lit(0)) == 0) & (F.coalesce(packets, F.lit(0)) == 0)
    platform = F.coalesce(src_ip.isin(*S.FLOW_NOISE_IPS), F.lit(False)) | F.coalesce(dst_ip.isin(*S.FLOW_NOISE_IPS), F.lit(False))
    reasons = F.array(
        F.when(platform, "azure_platform_or_metadata"),
        F.when(export, "netflow_export_self_traffic"),
        F.when(empty, "zero_counters"),
    )
    return F.filter(reasons, lambda r: r.isNotNull())


def normalize_flows(lines: DataFrame, now: Column | None = None, keep_raw: bool = True,
                    vendor: str = "pfsense", observer_type: str = "firewall", env: str = "lab",
                    collector: str = "goflow2") -> DataFrame:
    """One flow document per parsed line: a single narrow projection."""
    now = F.current_timestamp() if now is None else now
    # The document is bound to a lambda variable and its fields leave through one exploded struct, so
    # neither later expressions nor pushed-down filters can repeat the parsing.
    texts = F.transform(F.array(F.try_parse_json(F.trim("value"))), lambda v: F.struct(
        *[get_first(v, spellings).alias(name) for name, spellings in ALIASES.items()], F.col("value").alias("raw_line")))
    fields = lines.where("line_status = 'parsed'").select(F.explode(texts).alias("f")).select("f.*")
    numbers = ("src_port", "dst_port", "src_vlan", "dst_vlan", "bytes", "packets", "sequence_num", "sampling_rate", "in_interface",
               "out_interface", "tcp_flags", "ip_tos", "forwarding_status")
    times = {n: ns_to_ts(safe_int_strict(F.col(f"{n}_ns"))) for n in ("start", "end", "received")}
    flat = fields.select(
        transport_name(F.col("proto")).alias("tp"), "src_ip", "dst_ip", "observer_ip", "src_mac", "dst_mac", "flow_id", "version", "raw_line",
        *[safe_int_strict(F.col(n)).alias(n) for n in numbers], *[t.alias(n) for n, t in times.items()])
    reasons = flow_noise_reasons(*[F.col(c) for c in ("src_ip", "dst_ip", "dst_port", "bytes", "packets")])
    duration = F.call_function("div", F.unix_micros("end") - F.unix_micros("start"), F.lit(1000).cast("bigint"))
    flat = with_parsed_ips(flat, src=F.col("src_ip"), dst=F.col("dst_ip"))
    src, dst = (F.when(p.valid, p.private()) for p in (parsed("src", F.col("src_ip")), parsed("dst", F.col("dst_ip"))))
    return flat.withColumns({"reasons": reasons, "src_private": src, "dst_private": dst}).select(
        F.coalesce("end", "received", now).alias("ts"),
        F.struct(F.lit("firewall.netflow").alias("dataset"), F.lit("ndr-flow-collector").alias("module"),
                 F.lit("event").alias("kind"), F.array(F.lit("network")).alias("category"),
                 F.array(F.lit("connection")).alias("type")).alias("event"),
        F.struct(F.lit(observer_type).alias("type"), F.lit(vendor).alias("vendor"), F.col("observer_ip").alias("ip")).alias("observer"),
        F.struct(F.col("src_ip").alias("ip"), F.col("src_port").alias("port"), F.col("src_mac").alias("mac"),
                 F.col("src_vlan").alias("vlan_id")).alias("source"),
        F.struct(F.col("dst_ip").alias("ip"), F.col("dst_port").alias("port"), F.col("dst_mac").alias("mac"),
                 F.col("dst_vlan").alias("vlan_id")).alias("destination"),
        F.struct(F.col("tp.transport").alias("transport"), F.col("tp.iana").alias("iana_number"), "bytes", "packets",
                 flow_direction(F.col("src_private"), F.col("dst_private")).alias("direction")).alias("network"),
        F.struct(F.col("flow_id").alias("id"), "start", "end", duration.alias("duration_ms")).alias("flow"),
        F.struct("version", "sequence_num", "sampling_rate", "in_interface", "out_interface", "tcp_flags", "ip_tos",
                 "forwarding_status").alias("netflow"),
        F.struct(F.lit("firewall_netflow").alias("source_type"), F.lit(collector).alias("collector"), F.lit(env).alias("env"),
                 F.lit("goflow2_to_opensearch").alias("pipeline"),
                 (F.size("reasons") > 0).alias("noise"), F.col("reasons").alias("noise_reason"),
                 F.when(F.array_contains("reasons", "zero_counters"), "zero_counters").otherwise("normal").alias("flow_quality")).alias("ndr"),
        *([F.col("raw_line").alias("goflow2")] if keep_raw else []),
    )


def drop_noisy_flows(flows: DataFrame) -> DataFrame:
    return flows.where(~F.col("ndr.noise"))
