"""Renames, defaults, routing and noise handling of raw log rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import settings as S

RENAMES = {
    "method": "http_method", "status_code": "http_status", "request_body_len": "http_request_bytes",
    "uri": "url_path", "user_agent": "user_agent_name", "action": "firewall_event",
}
SOFTWARE_RENAMES = {"sw_major": "sw_version_major", "sw_minor": "sw_version_minor", "sw_minor2": "sw_version_minor2",
                    "sw_minor3": "sw_version_minor3", "sw_addl": "sw_version_addl"}


def rename_keys(df: DataFrame) -> DataFrame:
    """Move a value to its target name unless the target already holds one."""
    moved = {}
    for source, target in RENAMES.items():
        moved[target] = F.coalesce(F.col(target), F.col(source))
        moved[source] = F.when(F.col(target).isNotNull(), F.col(source))
    for source, target in SOFTWARE_RENAMES.items():
        moved[target] = F.coalesce(F.col(target), F.col(source)) if target in df.columns else F.col(source)
    return df.withColumns(moved | {"timestamp": F.col("ts")}).drop(*SOFTWARE_RENAMES)


def with_defaults(df: DataFrame) -> DataFrame:
    have = set(df.columns)

    def keep(name: str, value: str) -> Column:
        return F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value)

    return df.withColumns({
        "data_stream_type": keep("data_stream_type", "logs"),
        "data_stream_dataset": keep("data_stream_dataset", "zeek"),
        "log_type": keep("log_type", "unknown"),
    })


def with_route(df: DataFrame) -> DataFrame:
    """``route`` names the typed table of a row; the unrouted copy is simply the whole table."""
    route = reduce(lambda acc, kv: acc.when(F.col("log_type") == kv[0], F.lit(kv[1])), S.ROUTES.items(), F)
    return df.withColumns({"route": route.otherwise("other"), "event_date": F.to_date("ts")})


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _either(values) -> Column:
    return _text("orig_h").isin(*values) | _text("resp_h").isin(*values)


def drop_junk(df: DataFrame) -> DataFrame:
    t = _text("log_type")
    return df.where(~(t.startswith("conn-summary") | t.isin(*S.JUNK_LOG_TYPES)))


def drop_platform_ips(df: DataFrame) -> DataFrame:
    return df.where(~_either(S.PLATFORM_IPS))


def drop_own_export(df: DataFrame, sensor_ip: str, collector_ip: str, port: int) -> DataFrame:
    return df.where(~((_text("orig_h") == sensor_ip) & (_text("resp_h") == collector_ip) & (_text("resp_p") == str(port))))


def drop_broadcast(df: DataFrame, addresses=S.BROADCAST_IPS) -> DataFrame:
    return df.where(~_either(addresses))


def drop_agent_software(df: DataFrame, host: str) -> DataFrame:
    return df.where(~((_text("log_type") == "software") & (_text("name") == S.AGENT_SOFTWARE_NAME) & (_text("host") == host)))


def drop_reset_noise(df: DataFrame, source=S.RESET_NOISE_SOURCE, destinations=S.RESET_NOISE_DESTINATIONS,
                     port: int = S.RESET_NOISE_PORT) -> DataFrame:
    return df.where(~(
        (_text("orig_h") == source) & _text("resp_h").isin(*destinations) & (_text("resp_p") == str(port))
        & (_text("conn_state") == "OTH") & (_text("history") == "R")
    ))


def package_noise(query: Column, host: Column, agent: Column, name: Column) -> Column:
    def hit(words, *cols) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(F.lower(c), F.lit("")).contains(w) for w in words for c in cols])

    return hit(S.PACKAGE_DOMAINS, query, host) | hit(S.PACKAGE_AGENTS, agent, name)


def mark_package_noise(df: DataFrame) -> DataFrame:
    """Package and update traffic is marked, never dropped."""
    noisy = package_noise(F.col("query"), F.col("host"), F.coalesce(F.col("user_agent_name"), F.col("user_agent")), F.col("name"))
    return df.withColumns({
        "ndr_noise": noisy,
        "ndr_noise_type": F.when(noisy, F.lit(S.PACKAGE_NOISE_TYPE)).otherwise(F.col("ndr_noise_type")),
        "ndr_noise_reason": F.when(noisy, F.lit(S.PACKAGE_NOISE_REASON)).otherwise(F.col("ndr_noise_reason")),
    })


def clean(df: DataFrame, sensor_ip: str, collector_ip: str, port: int, agent_host: str | None = None) -> DataFrame:
    """The whole filter chain in deployed order; every step is a narrow predicate over the scan."""
    return (
        df.transform(drop_junk)
        .transform(drop_platform_ips)
        .transform(drop_own_export, sensor_ip, collector_ip, port)
        .transform(drop_broadcast)
        .transform(drop_agent_software, agent_host or sensor_ip)
        .transform(drop_reset_noise)
        .transform(mark_package_noise)
    )
