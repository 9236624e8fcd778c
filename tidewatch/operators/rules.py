"""Detection rules over a sliding look-back, realert suppression and scan enrichment.

A rule asks, at each event, how many distinct values (or events) its key showed during the
last ``span`` seconds.  Instead of one window frame per key - which would put a busy key into
one task and rescan its frame at every row - time is cut into buckets of one span:

* an event at t can only see its own bucket and the one before;
* a value seen in the earlier bucket stays visible until its last sighting there plus the
  span, and once seen in the current bucket it stays visible to the bucket's end.

So per (key, bucket) the answer is a running sum of a few +1/-1 steps.  Sightings are reduced
to first and last per (key, value, bucket) before any shuffle by key, buckets that cannot
reach the threshold are dropped first, and each (key, bucket) is evaluated on its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.session import stored

c = F.col
US = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``value`` set: distinct values above ``threshold``; unset: at least ``threshold`` events."""

    name: str
    key: tuple[str, ...]
    threshold: int
    value: str | None = None
    span_seconds: int = 300
    realert_seconds: int = 60
    query_delay_seconds: int = 0


# Thresholds of the deployed rules.
VERTICAL_SCAN = Rule("NDR - Possible Nmap Port Scan", ("src_ip", "dst_ip"), 20, "dst_port", 300, 60, 180)
HORIZONTAL_SCAN = Rule("NDR - Possible Horizontal Scan", ("src_ip",), 10, "dst_ip", 300, 900)
SSH_BRUTE_FORCE = Rule("NDR - Possible SSH Brute Force", ("src_ip", "dst_ip"), 8, None, 300, 600, 60)
INVALID_CERT = Rule("NDR - Zeek SSL Invalid Certificate", (), 1, None, 300, 600)
SCAN_STATES = ("REJ", "RSTO", "S0", "RSTR", "OTH")
SWEEP_STATES = ("REJ", "S0", "OTH")
INVALID_CERT_NOTE = "SSL::Invalid_Server_Cert"


# ---------------------------------------------------------------- rule inputs

def scan_sessions(sessions: DataFrame) -> DataFrame:
    present = c("src_ip").isNotNull() & c("dst_ip").isNotNull() & c("dst_port").isNotNull()
    return sessions.where(present & (c("transport") == "tcp") & c("conn.state").isin(*SCAN_STATES))


def sweep_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where((c("transport") == "tcp") & c("conn.state").isin(*SWEEP_STATES) & c("src_ip").isNotNull())


def ssh_sessions(sessions: DataFrame) -> DataFrame:
    present = c("src_ip").isNotNull() & c("dst_ip").isNotNull() & c("dst_port").isNotNull()
    return sessions.where(present & ((c("protocol") == "ssh") | (c("dst_port") == 22) | c("has_ssh")))


def invalid_cert_notices(raw: DataFrame) -> DataFrame:
    return raw.where((c("log_type") == "notice") & (c("note") == INVALID_CERT_NOTE))


def settled(events: DataFrame, as_of: Column, rule: Rule) -> DataFrame:
    """Only events old enough that late rows have arrived."""
    return events.where(c("ts") <= as_of - F.make_dt_interval(secs=F.lit(rule.query_delay_seconds)))


# ---------------------------------------------------------------- sliding counts

def _steps_distinct(events: DataFrame, key: Sequence[str], value: str, span: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    seen = events.where(c(value).isNotNull()).groupBy(*key, "bucket", value).agg(F.min("us").alias("s"), F.max("us").alias("last"))
    both = (
        seen.select(*key, "bucket", value, "s", F.lit(None).cast("bigint").alias("m"))
        .unionByName(seen.select(*key, (c("bucket") + 1).alias("bucket"), value, F.lit(None).cast("bigint").alias("s"), c("last").alias("m")))
        .groupBy(*key, "bucket", value).agg(F.min("s").alias("s"), F.max("m").alias("m"))
    )
    possible = both.groupBy(*key, "bucket").agg(F.count("*").alias("values"), F.count("s").alias("own"))
    possible = possible.where((c("values") > threshold) & (c("own") > 0)).select(*key, "bucket")
    ends = c("m") + span + 1
    gap = c("s").isNull() | (c("s") >= ends)
    step = lambda at, d: F.struct(at.alias("us"), F.lit(d).cast("bigint").alias("d"))
    steps = F.array_compact(F.array(
        F.when(c("m").isNotNull(), step(c("bucket") * span, 1)),
        F.when(c("m").isNotNull() & gap, step(ends, -1)),
        F.when(c("s").isNotNull() & (c("m").isNull() | gap), step(c("s"), 1)),
    ))
    return both.select(*key, "bucket", F.explode(steps).alias("x")).select(*key, "bucket", "x.us", "x.d"), possible


def _steps_events(events: DataFrame, key: Sequence[str], span: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    times = events.groupBy(*key, "bucket", "us").agg(F.count("*").alias("n"))
    here = times.groupBy(*key, "bucket").agg(F.sum("n").alias("n"))
    reach = (
        here.select(*key, "bucket", "n", c("n").alias("own"))
        .unionByName(here.select(*key, (c("bucket") + 1).alias("bucket"), "n", F.lit(0).cast("bigint").alias("own")))
        .groupBy(*key, "bucket").agg(F.sum("n").alias("n"), F.sum("own").alias("own"))
    )
    possible = reach.where((c("n") >= threshold) & (c("own") > 0)).select(*key, "bucket")
    step = lambda b, at, d: F.struct(b.alias("bucket"), at.alias("us"), d.alias("d"))
    steps = F.array(
        step(c("bucket"), c("us"), c("n")), step(c("bucket") + 1, (c("bucket") + 1) * span, c("n")),
        step(c("bucket") + 1, c("us") + span + 1, -c("n")),
    )
    flat = times.select(*key, F.explode(steps).alias("x")).select(*key, "x.*")
    return flat.groupBy(*key, "bucket", "us").agg(F.sum("d").alias("d")), possible


def sliding_matches(events: DataFrame, rule: Rule, detail: Sequence[str] = ("session_id",)) -> DataFrame:
    """One row per (key, event time) at which the rule's condition holds.

    ``hits`` is the count in the look-back (both ends inclusive), ``n_events`` the events at
    that very time and ``first_event`` the details of the one with the smallest session id.
    """
    key, span = list(rule.key), rule.span_seconds * US
    rows = events.withColumn("us", F.unix_micros("ts"))
    rows = rows.withColumn("bucket", F.floor(c("us") / F.lit(span)).cast("bigint"))
    if rule.value:
        steps, possible = _steps_distinct(rows, key, rule.value, span, rule.threshold)
    else:
        steps, possible = _steps_events(rows, key, span, rule.threshold)
    points = rows.groupBy(*key, "bucket", "us").agg(
        F.count("*").alias("n_events"), F.min_by(F.struct(*detail), "session_id").alias("first_event"))
    timeline = (
        points.select(*key, "bucket", "us", F.lit(0).cast("bigint").alias("d"), "n_events", "first_event")
        .unionByName(steps.select(*key, "bucket", "us", "d"), allowMissingColumns=True)
        .join(possible, [*key, "bucket"], "left_semi")
    )
    running = Window.partitionBy(*key, "bucket").orderBy("us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = timeline.withColumn("hits", F.sum("d").over(running)).where(c("n_events").isNotNull())
    met = c("hits") > rule.threshold if rule.value else c("hits") >= rule.threshold
    return counted.where(met).select(*key, F.timestamp_micros("us").alias("ts"), "us", "hits", "n_events", "first_event")


# ---------------------------------------------------------------- realert suppression

def _next_matches(nodes: DataFrame, group: list[str], wait: int) -> tuple[DataFrame, DataFrame]:
    """(starts, next): times that are kept in any case, and per time ``us`` the first one at least ``wait`` later, ``then``.

    Time is cut into buckets of ``wait``: the next time lies in the following bucket or is the first of a later one, so windows run
    over one bucket's times, or over one row per bucket.
    """
    nodes = nodes.withColumn("bucket", F.floor(c("us") / F.lit(wait)).cast("bigint"))
    order = Window.partitionBy(*group).orderBy("bucket")
    edges = nodes.groupBy(*group, "bucket").agg(F.min("us").alias("low"), F.max("us").alias("high")).select(
        *group, "bucket", "low", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("later"))
    starts = edges.where(c("before").isNull() | (c("low") - c("before") >= wait)).select(*group, c("low").alias("us"))
    asked = nodes.select(*group, (c("bucket") + 1).alias("bucket"), (c("us") + wait).alias("at"), "us", F.lit(None).cast("bigint").alias("node"))
    points = asked.unionByName(nodes.select(*group, "bucket", c("us").alias("at"), F.lit(None).cast("bigint").alias("us"), c("us").alias("node")))
    ahead = Window.partitionBy(*group, "bucket").orderBy("at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    found = points.withColumn("inside", F.min("node").over(ahead)).where(c("us").isNotNull()).select(*group, "bucket", "us", "inside")
    own = edges.select(*group, "bucket", c("later").alias("after"), F.lit(True).alias("there"))
    previous = edges.select(*group, (c("bucket") + 1).alias("bucket"), c("later").alias("beyond"))
    joined = found.join(own, [*group, "bucket"], "left").join(previous, [*group, "bucket"], "left")
    then = F.coalesce("inside", F.when(c("there"), c("after")).otherwise(c("beyond")))
    return starts, joined.select(*group, "us", then.alias("then")).where(c("then").isNotNull())


def suppress_realerts(matches: DataFrame, key: Sequence[str], realert_seconds: int) -> DataFrame:
    """Keep a match only if the last kept one of its key is at least ``realert_seconds`` older.

    From a kept time the chain goes on to the first time that much later.  A gap of that length restarts it in any case, so the chains
    of a key start at all its gaps and are followed by doubling: after k rounds, each a join on (key, time), everything within
    2^k steps of a start is found.  Without a key, times spread the work.  Rounds are stored, one Spark job each.
    """
    key, wait = list(key), realert_seconds * US
    group = key or ["_all"]
    rows = matches if key else matches.withColumn("_all", F.lit(1))
    starts, step = _next_matches(rows.select(*group, "us").distinct(), group, wait)
    kept, step = stored(starts, "kept"), stored(step, "steps")
    while True:
        reached = kept.join(step, [*group, "us"]).select(*group, c("then").alias("us")).join(kept, [*group, "us"], "left_anti").distinct()
        reached = stored(reached, "reached")
        if reached.isEmpty():
            break
        kept = stored(kept.unionByName(reached), "kept")
        further = step.select(*group, c("us").alias("then"), c("then").alias("_then"))
        step = stored(step.join(further, [*group, "then"]).select(*group, "us", c("_then").alias("then")), "steps")
    return rows.join(kept, [*group, "us"], "left_semi").drop("_all")


def run_rule(events: DataFrame, rule: Rule, detail: Sequence[str] = ("session_id",)) -> DataFrame:
    """Matches are stored before suppression, which reads them several times; else each of its plans, and the caller's, would hold the whole count anew."""
    return stored(sliding_matches(events, rule, detail), "matches").transform(suppress_realerts, rule.key, rule.realert_seconds)


def any_rule(events: DataFrame, rule: Rule, id_col: str = "raw_id") -> DataFrame:
    """Every event matches; suppression is global when the rule has no key.  Equal times keep the smallest id."""
    rows = events.withColumn("us", F.unix_micros("ts"))
    first = F.min_by(F.struct(*[c(n) for n in events.columns]), id_col)
    points = rows.groupBy(*rule.key, "us").agg(first.alias("event"))
    return suppress_realerts(points, rule.key, rule.realert_seconds)


# ---------------------------------------------------------------- attachments

def within_lookback(alerts: DataFrame, events: DataFrame, key: Sequence[str], before: int, after: int) -> DataFrame:
    """Equi join on key and time bucket, then the exact interval [alert - before, alert + after].

    The few alerts are spread over the buckets they cover; events are never duplicated.
    """
    width = (before + after) * US
    spread = F.explode(F.sequence(F.floor((c("us") - before * US) / width).cast("bigint"), F.floor((c("us") + after * US) / width).cast("bigint")))
    a = alerts.select(*key, c("us").alias("alert_us"), spread.alias("b"))
    e = events.withColumn("us", F.unix_micros("ts")).withColumn("b", F.floor(c("us") / width).cast("bigint"))
    return a.join(e, [*key, "b"]).where(c("us").between(c("alert_us") - before * US, c("alert_us") + after * US)).drop("b")


def related_events(alerts: DataFrame, events: DataFrame, rule: Rule) -> DataFrame:
    """The sessions behind each alert, all of them: one row per alert and session, ``place`` 1 for the oldest."""
    hits = within_lookback(alerts, events, rule.key, rule.span_seconds, 0)
    by = [*rule.key, "alert_us"]
    order = Window.partitionBy(*by).orderBy("us", "session_id")
    return hits.select(*by, "us", "session_id").withColumn("place", F.row_number().over(order))


def top_counts(alerts: DataFrame, events: DataFrame, rule: Rule, fields: dict[str, Column], limit: int = 10) -> DataFrame:
    """Top values of several fields in the look-back of each alert: (key, alert_us, field, value, n, rank)."""
    hits = within_lookback(alerts, events, rule.key, rule.span_seconds, 0)
    by = [*rule.key, "alert_us"]
    pairs = F.filter(F.array(*[F.struct(F.lit(n).alias("field"), v.cast("string").alias("value")) for n, v in fields.items()]),
                     lambda p: p.value.isNotNull())
    counts = hits.select(*by, F.explode(pairs).alias("p")).groupBy(*by, "p.field", "p.value").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*by, "field").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(c("rank") <= limit)


def enrich_scans(alerts: DataFrame, sessions: DataFrame, before_seconds: int = 300, after_seconds: int = 180, shown_ports: int = 100) -> DataFrame:
    """Scan context of each alert: ports, states, protocols and the message text.

    Ports are at most 65,536 and states and protocols a fixed set, so the lists are whole; only the message names at most ``shown_ports``.
    """
    by = ["src_ip", "dst_ip", "alert_us"]
    tcp = sessions.where(c("transport") == "tcp").select(
        "src_ip", "dst_ip", "ts", c("dst_port").alias("port"), c("conn.state").alias("state"), "protocol")
    hits = within_lookback(alerts, tcp, ["src_ip", "dst_ip"], before_seconds, after_seconds)
    cells = hits.groupBy(*by, "port", "state", "protocol").agg(F.count("*").alias("n"))
    open_ = ~F.coalesce(c("state") == "REJ", F.lit(False))
    none = F.lit(None)
    kinds = {"port": (c("port"), none), "state": (none, c("state")), "protocol": (none, F.when(open_, c("protocol")))}
    items = F.array(*[F.struct(F.lit(k).alias("kind"), p.cast(tcp.schema["port"].dataType).alias("port"), v.cast("string").alias("value")) for k, (p, v) in kinds.items()])
    # The join with the alerts is read once: ports, states and protocols are counted together and parted at the end.
    counts = (
        cells.select(*by, "n", open_.alias("open"), F.explode(items).alias("i")).select(*by, "n", "open", "i.*")
        .where(c("port").isNotNull() | c("value").isNotNull())
        .groupBy(*by, "kind", "port", "value").agg(F.sum("n").alias("n"), F.max("open").alias("open"))
    )

    def listed(condition: Column, value: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, value)))

    port = c("kind") == "port"
    joined = counts.groupBy(*by).agg(
        F.count_if(port).alias("unique_ports"), listed(port, c("port")).alias("ports"), listed(port & c("open"), c("port")).alias("open_ports"),
        *[listed(c("kind") == k, F.struct("value", "n")).alias(f"{k}s") for k in ("state", "protocol")],
    ).where(c("unique_ports") > 0)
    joined = joined.withColumns({n: F.when(F.size(n) > 0, F.map_from_entries(n)) for n in ("states", "protocols")})
    rejected = F.coalesce(F.try_element_at(c("states"), F.lit("REJ")), F.lit(0))
    shown = F.slice("open_ports", 1, shown_ports).cast("array<string>")
    named = F.when(F.size(shown) > 0, F.array_join(shown, ", ")).otherwise("none observed")
    message = F.format_string(
        "Possible Nmap port scan detected: %s scanned %d unique TCP destination ports on %s within the detection window. "
        "Most ports were rejected/closed (REJ=%d). Interesting/open ports observed: %s.",
        "src_ip", "unique_ports", "dst_ip", rejected, named)
    return joined.select(
        *by, "unique_ports", c("open_ports").alias("interesting_ports"), "states", "protocols", "ports",
        F.timestamp_micros(c("alert_us") - before_seconds * US).alias("window_from"),
        F.timestamp_micros(c("alert_us") + after_seconds * US).alias("window_to"), message.alias("message"))


# ---------------------------------------------------------------- alert rows

# Constant fields of the alert documents.
ALERT_FIELDS = {
    VERTICAL_SCAN.name: {
        "alert_type": "nmap_port_scan", "severity": "medium", "mitre_tactic": "Discovery",
        "mitre_technique": "Network Service Discovery", "mitre_id": "T1046",
        "detection_logic": "cardinality(destination.port) > 20 grouped by source.ip + destination.ip over 5 minutes",
        "expected_scan_pattern": "many TCP conn-only sessions, mostly REJ/RSTO, network.protocol often unknown",
    },
    HORIZONTAL_SCAN.name: {"alert_type": "horizontal_scan"},
    SSH_BRUTE_FORCE.name: {
        "alert_type": "ssh_bruteforce", "severity": "medium", "message": "Possible SSH brute-force activity detected",
        "mitre_tactic": "Credential Access", "mitre_technique": "Brute Force", "mitre_id": "T1110",
    },
    INVALID_CERT.name: {
        "alert_name": "NDR - Invalid TLS Certificate", "severity": "medium", "category": "tls",
        "use_case": "tls_certificate_validation", "engine": "elastalert2", "status": "open",
    },
}
SUBJECTS = {
    VERTICAL_SCAN.name: "NDR possible Nmap port scan: {src_ip} -> {dst_ip}",
    HORIZONTAL_SCAN.name: "NDR possible horizontal scan from {src_ip}",
    SSH_BRUTE_FORCE.name: "NDR SSH brute force suspected: {src_ip} -> {dst_ip}",
}


def alert_subject(rule: Rule) -> Column:
    text = SUBJECTS[rule.name]
    names = [n for n in ("src_ip", "dst_ip") if "{" + n + "}" in text]
    return F.format_string(text.replace("{src_ip}", "%s").replace("{dst_ip}", "%s"), *names)


def to_alerts(kept: DataFrame, rule: Rule) -> DataFrame:
    """Alert rows: rule name, constants, key fields and the details of the matching event."""
    constants = [F.lit(v).alias(k) for k, v in ALERT_FIELDS[rule.name].items()]
    subject = [alert_subject(rule).alias("subject")] if rule.name in SUBJECTS else []
    own = [x for x in kept.columns if x not in ("first_event", "event")]
    nested = [x for x in ("first_event", "event") if x in kept.columns]
    detail = [c(f"{n}.{f}") for n in nested for f in kept.schema[n].dataType.names if f not in own]
    return kept.select(F.lit(rule.name).alias("rule_name"), *own, *detail, *constants, *subject)


def latest_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Newest row per key: ``max_by`` keeps one row of state per key, also on the map side."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")
