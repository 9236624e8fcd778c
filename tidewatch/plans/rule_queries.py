"""Detection rules, suppression and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import rules as R
from tidewatch.plans import oracle as O
from tidewatch.plans.catalog import query
from tidewatch.plans.views import joined, session_table
from tidewatch.sources.adapters import raw_logs

c = F.col
_SCAN = "src_ip IS NOT NULL AND dst_ip IS NOT NULL AND dst_port IS NOT NULL AND transport = 'tcp' AND state IN ('REJ', 'RSTO', 'S0', 'RSTR', 'OTH')"
_SWEEP = "src_ip IS NOT NULL AND transport = 'tcp' AND state IN ('REJ', 'S0', 'OTH')"
_SSH = "src_ip IS NOT NULL AND dst_ip IS NOT NULL AND dst_port IS NOT NULL AND (protocol = 'ssh' OR dst_port = 22 OR list_contains(log_types, 'ssh'))"


def _hits(where: str, key: str, count: str, condition: str) -> str:
    return f"""hits AS MATERIALIZED (SELECT {key}, ts_us AS us, max(hits) AS hits, count(*) AS n_events FROM (SELECT *, {count} OVER (PARTITION BY {key} ORDER BY ts_us
        RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW) AS hits FROM hard WHERE {where}) t WHERE hits {condition} GROUP BY {key}, ts_us)"""


_R01 = _hits(_SCAN, "src_ip, dst_ip", "count(DISTINCT dst_port)", "> 20")
_R02 = _hits(_SWEEP, "src_ip", "count(DISTINCT dst_ip)", "> 10")
_R03 = _hits(_SSH, "src_ip, dst_ip", "count(*)", ">= 8")


def _greedy(key: str, wait: int) -> str:
    """Follow each key from its first match to the next one that is ``wait`` microseconds later."""
    same = " AND ".join(f"h.{k} = kept.{k}" for k in key.split(", "))
    return f"""kept AS (SELECT {key}, min(us) AS us FROM hits GROUP BY {key} UNION ALL
        SELECT * FROM (SELECT {', '.join('kept.' + k for k in key.split(', '))}, (SELECT min(h.us) FROM hits h WHERE {same} AND h.us >= kept.us + {wait}) AS us FROM kept) n WHERE us IS NOT NULL)"""


def _rule_sql(hits: str, tail: str, greedy: str | None = None) -> str:
    return f"WITH RECURSIVE {O.HARD}, {hits}{', ' + greedy if greedy else ''} {tail}"


def _events(spark, d, rule):
    s = session_table(spark, d)
    return {R.VERTICAL_SCAN: R.scan_sessions, R.HORIZONTAL_SCAN: R.sweep_sessions, R.SSH_BRUTE_FORCE: R.ssh_sessions}[rule](s)


@query("f14_rule_filters", O.hardened(f"SELECT 'scan' AS rule, count(*) AS n FROM hard WHERE {_SCAN} UNION ALL SELECT 'sweep', count(*) FROM hard WHERE {_SWEEP} UNION ALL SELECT 'ssh', count(*) FROM hard WHERE {_SSH}"))
def rule_filters(spark, d):
    s = session_table(spark, d).select("src_ip", "dst_ip", "dst_port", "transport", "protocol", "has_ssh", "conn")
    parts = [f(s).agg(F.count("*").alias("n")).select(F.lit(n).alias("rule"), "n") for n, f in
             (("scan", R.scan_sessions), ("sweep", R.sweep_sessions), ("ssh", R.ssh_sessions))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("r01_vertical_scan", _rule_sql(_R01, "SELECT src_ip, dst_ip, us, hits, n_events FROM hits"))
def vertical(spark, d):
    return R.sliding_matches(_events(spark, d, R.VERTICAL_SCAN), R.VERTICAL_SCAN).select("src_ip", "dst_ip", "us", "hits", "n_events")


@query("r02_horizontal_scan", _rule_sql(_R02, "SELECT src_ip, us, hits, n_events FROM hits"))
def horizontal(spark, d):
    return R.sliding_matches(_events(spark, d, R.HORIZONTAL_SCAN), R.HORIZONTAL_SCAN).select("src_ip", "us", "hits", "n_events")


@query("r03_ssh_bruteforce", _rule_sql(_R03, "SELECT src_ip, dst_ip, us, CAST(hits AS BIGINT) AS hits, n_events FROM hits"))
def ssh(spark, d):
    return R.sliding_matches(_events(spark, d, R.SSH_BRUTE_FORCE), R.SSH_BRUTE_FORCE).select("src_ip", "dst_ip", "us", "hits", "n_events")


@query("r03_ssh_bruteforce_alerts", _rule_sql(_R03, "SELECT src_ip, dst_ip, us, 'ssh_bruteforce' AS alert_type, 'T1110' AS mitre_id, 'NDR SSH brute force suspected: ' || src_ip || ' -> ' || dst_ip AS subject FROM kept",
                                              _greedy("src_ip, dst_ip", 600000000)))
@query("s17_alert_projection", _rule_sql(_R03, "SELECT src_ip, dst_ip, us, 'ssh_bruteforce' AS alert_type, 'T1110' AS mitre_id, 'NDR SSH brute force suspected: ' || src_ip || ' -> ' || dst_ip AS subject FROM kept",
                                         _greedy("src_ip, dst_ip", 600000000)))
def ssh_alerts(spark, d):
    kept = R.run_rule(_events(spark, d, R.SSH_BRUTE_FORCE), R.SSH_BRUTE_FORCE)
    return R.to_alerts(kept, R.SSH_BRUTE_FORCE).select("src_ip", "dst_ip", "us", "alert_type", "mitre_id", "subject")


_NOTICE = "hits AS MATERIALIZED (SELECT DISTINCT 1 AS one, us FROM raw WHERE log_type = 'notice' AND note = 'SSL::Invalid_Server_Cert')"


@query("r04_invalid_certificate", f"WITH RECURSIVE raw AS ({O.RAW}), {_NOTICE}, {_greedy('one', 600000000)} SELECT us, min(raw_id) AS raw_id FROM kept JOIN raw USING (us) WHERE log_type = 'notice' AND note = 'SSL::Invalid_Server_Cert' GROUP BY us")
def invalid_cert(spark, d):
    return R.any_rule(R.invalid_cert_notices(raw_logs(spark, d)), R.INVALID_CERT).select("us", "event.raw_id")


@query("r05_realert_suppression", _rule_sql(_R01, "SELECT src_ip, dst_ip, us FROM kept", _greedy("src_ip, dst_ip", 60000000)))
def suppression(spark, d):
    return R.run_rule(_events(spark, d, R.VERTICAL_SCAN), R.VERTICAL_SCAN).select("src_ip", "dst_ip", "us")


@query("r05_horizontal_alerts", _rule_sql(_R02, "SELECT src_ip, us FROM kept", _greedy("src_ip", 900000000)))
def horizontal_alerts(spark, d):
    return R.run_rule(_events(spark, d, R.HORIZONTAL_SCAN), R.HORIZONTAL_SCAN).select("src_ip", "us")


_TOP = """SELECT src_ip, dst_ip, alert_us, field, value, n, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY src_ip, dst_ip, alert_us, field ORDER BY n DESC, value) AS INT) AS rank FROM (
    SELECT k.src_ip, k.dst_ip, k.us AS alert_us, field, value, count(*) AS n FROM kept k JOIN (SELECT *, unnest(['dst_port', 'state', 'protocol']) AS field,
    unnest([CAST(dst_port AS STRING), state, protocol]) AS value FROM hard WHERE """ + _SCAN + """) s ON s.src_ip = k.src_ip AND s.dst_ip = k.dst_ip AND s.ts_us BETWEEN k.us - 300000000 AND k.us
    WHERE value IS NOT NULL GROUP BY ALL) a) b WHERE rank <= 10"""


@query("r06_top_counts", _rule_sql(_R01, _TOP, _greedy("src_ip, dst_ip", 60000000)))
def top_counts(spark, d):
    events = _events(spark, d, R.VERTICAL_SCAN)
    fields = {"dst_port": c("dst_port"), "state": c("conn.state"), "protocol": c("protocol")}
    return R.top_counts(R.run_rule(events, R.VERTICAL_SCAN), events, R.VERTICAL_SCAN, fields)


@query("r07_query_delay", O.hardened(f"SELECT count(*) AS n FROM hard WHERE {_SCAN} AND ts_us <= (SELECT max(us) FROM raw) - 180000000"))
def query_delay(spark, d):
    now = raw_logs(spark, d).agg(F.max("ts")).scalar()
    return R.settled(_events(spark, d, R.VERTICAL_SCAN), now, R.VERTICAL_SCAN).agg(F.count("*").alias("n"))


@query("r08_related_events", _rule_sql(_R03, f"""SELECT k.src_ip, k.dst_ip, k.us AS alert_us, session_id, CAST(row_number() OVER (PARTITION BY k.src_ip, k.dst_ip, k.us ORDER BY s.ts_us, session_id) AS INT) AS place FROM kept k JOIN (SELECT * FROM hard WHERE {_SSH}) s
    ON s.src_ip = k.src_ip AND s.dst_ip = k.dst_ip AND s.ts_us BETWEEN k.us - 300000000 AND k.us""", _greedy("src_ip, dst_ip", 600000000)))
def related(spark, d):
    events = _events(spark, d, R.SSH_BRUTE_FORCE)
    rows = R.related_events(R.run_rule(events, R.SSH_BRUTE_FORCE), events, R.SSH_BRUTE_FORCE)
    return rows.select("src_ip", "dst_ip", "alert_us", "session_id", "place")


@query("r09_latest_per_key", O.raw("SELECT src, dst, max(us) AS us, arg_max(raw_id, us) AS raw_id FROM raw WHERE log_type = 'notice' GROUP BY src, dst"))
def latest(spark, d):
    rows = raw_logs(spark, d).where("log_type = 'notice'").select("src", "dst", "ts", "raw_id")
    return R.latest_per_key(rows, ["src", "dst"], "ts").select("src", "dst", F.unix_micros("ts").alias("us"), "raw_id")


_ENRICH = """SELECT k.src_ip, k.dst_ip, k.us AS alert_us, count(DISTINCT dst_port) AS unique_ports, array_to_string(list_sort(list(DISTINCT dst_port) FILTER (WHERE state IS DISTINCT FROM 'REJ')), '|') AS interesting,
    array_to_string(list_sort(list(DISTINCT dst_port)), '|') AS sample, count(*) FILTER (WHERE state = 'REJ') AS rejected, count(*) FILTER (WHERE state IS DISTINCT FROM 'REJ' AND protocol = 'ssh') AS open_ssh
    FROM kept k JOIN (SELECT * FROM hard WHERE transport = 'tcp') s ON s.src_ip = k.src_ip AND s.dst_ip = k.dst_ip AND s.ts_us BETWEEN k.us - 300000000 AND k.us + 180000000 GROUP BY ALL"""


@query("j10_scan_enrichment", _rule_sql(_R01, _ENRICH, _greedy("src_ip, dst_ip", 60000000)))
def enrichment(spark, d):
    s = session_table(spark, d)
    rows = R.enrich_scans(R.run_rule(R.scan_sessions(s), R.VERTICAL_SCAN), s)
    zero = lambda m, k: F.coalesce(F.try_element_at(c(m), F.lit(k)), F.lit(0))
    return rows.select("src_ip", "dst_ip", "alert_us", "unique_ports", joined(c("interesting_ports")).alias("interesting"), joined(c("ports")).alias("sample"),
                       zero("states", "REJ").alias("rejected"), zero("protocols", "ssh").alias("open_ssh"))
