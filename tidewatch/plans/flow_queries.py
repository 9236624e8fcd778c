"""Flow-record queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.flows import drop_noisy_flows, parse_flow_lines
from tidewatch.operators.lookups import newest
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.views import flows, joined
from tidewatch.sources.adapters import flow_lines
from tidewatch.sources.tables import with_event_date

c = F.col
_GOOD = "l_orderkey % 97 <> 5 AND l_orderkey % 101 <> 6 AND l_orderkey % 103 <> 7"
_REASONS = """concat_ws('|', CASE WHEN dst_ip = '168.63.129.16' THEN 'azure_platform_or_metadata' END,
    CASE WHEN src_ip = '10.51.1.15' AND dst_ip = '10.51.1.11' AND dst_port = 2055 THEN 'netflow_export_self_traffic' END, CASE WHEN bytes = 0 AND packets = 0 THEN 'zero_counters' END)"""
_FLOW = f"""src_ip, dst_ip, CASE proto WHEN '6' THEN 'tcp' WHEN '17' THEN 'udp' WHEN 'TCP' THEN 'tcp' ELSE proto END AS transport, bytes, packets,
    coalesce(end_ns, received_ns) // 1000 AS us, (end_ns // 1000 - start_ns // 1000) // 1000 AS duration_ms, nullif({_REASONS}, '') AS reasons,
    CASE WHEN bytes = 0 AND packets = 0 THEN 'zero_counters' ELSE 'normal' END AS quality, CASE WHEN s AND NOT t THEN 'outbound' WHEN NOT s AND t THEN 'inbound'
    WHEN s AND t THEN 'internal' WHEN NOT s AND NOT t THEN 'external' END AS direction"""
_FROM = f"(SELECT *, {O.private('src_ip')} AS s, {O.private('dst_ip')} AS t FROM flow WHERE {_GOOD}) x"


@query("s11_flow_line_scan", O.flows("""SELECT CASE WHEN l_orderkey % 97 = 5 THEN 'skipped' WHEN l_orderkey % 101 = 6 THEN 'blank' WHEN l_orderkey % 103 = 7 THEN 'skipped' ELSE 'parsed' END AS line_status,
    count(*) AS n FROM flow GROUP BY 1"""))
def flow_scan(spark, d):
    return parse_flow_lines(flow_lines(spark, d)).groupBy("line_status").agg(F.count("*").alias("n"))


@query("a14_flow_normalize", O.flows(f"SELECT {_FLOW} FROM {_FROM}"))
@query("n25_flow_duration", O.flows(f"SELECT {_FLOW} FROM {_FROM}"))
def flow_normalize(spark, d):
    return flows(spark, d).select(
        c("source.ip").alias("src_ip"), c("destination.ip").alias("dst_ip"), "network.transport", "network.bytes", "network.packets",
        F.unix_micros("ts").alias("us"), "flow.duration_ms", joined(c("ndr.noise_reason")).alias("reasons"), c("ndr.flow_quality").alias("quality"), "network.direction")


@query("f08_flow_noise", O.flows(f"SELECT nullif({_REASONS}, '') AS reasons, count(*) AS n FROM flow WHERE {_GOOD} GROUP BY 1"))
def flow_noise(spark, d):
    return flows(spark, d).groupBy(joined(c("ndr.noise_reason")).alias("reasons")).agg(F.count("*").alias("n"))


@query("f09_drop_noisy_flows", O.flows(f"SELECT l.dst_ip, count(*) AS n FROM flow l WHERE {_GOOD} AND {_REASONS} = '' GROUP BY 1"))
def drop_noisy(spark, d):
    return drop_noisy_flows(flows(spark, d)).groupBy(c("destination.ip").alias("dst_ip")).agg(F.count("*").alias("n"))


@query("s13_flow_days", O.flows(f"SELECT CAST(make_timestamp(coalesce(end_ns, received_ns) // 1000) AS DATE) AS event_date, count(*) AS n FROM flow WHERE {_GOOD} GROUP BY 1"))
def flow_days(spark, d):
    return with_event_date(flows(spark, d), "ts").groupBy("event_date").agg(F.count("*").alias("n"))


@query("t01_latest_flows", O.flows(f"SELECT coalesce(end_ns, received_ns) // 1000 AS us FROM flow WHERE {_GOOD} ORDER BY us DESC LIMIT 10"))
def latest_flows(spark, d):
    return newest(flows(spark, d), 10, [F.unix_micros("ts").alias("us")])


@query("t02_flow_terms", O.flows(f"""SELECT CASE proto WHEN '6' THEN 'tcp' WHEN '17' THEN 'udp' WHEN 'TCP' THEN 'tcp' ELSE proto END AS transport, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM flow WHERE {_GOOD} GROUP BY 1"""))
def flow_terms(spark, d):
    return flows(spark, d).groupBy("network.transport").agg(F.count("*").alias("n"), F.sum("network.bytes").alias("bytes"))
