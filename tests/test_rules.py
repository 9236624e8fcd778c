"""Sliding counts and suppression against brute force, and the exact bounds."""

import random
from datetime import datetime, timedelta, timezone

from tidewatch.operators import rules as R
from tidewatch.streaming.jobs import suppress_stream

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def events(spark, rows):
    data = [(f"s{i:05d}", T0 + timedelta(seconds=t), src, dst, port) for i, (t, src, dst, port) in enumerate(rows)]
    return spark.createDataFrame(data, "session_id string, ts timestamp, src_ip string, dst_ip string, dst_port bigint")


def times(df):
    return sorted((r.us - int(T0.timestamp() * 1e6)) / 1e6 for r in df.collect())


def test_twenty_ports_are_not_a_scan_but_twenty_one_are(spark):
    rows = [(i, "a", "b", i) for i in range(21)]
    assert times(R.sliding_matches(events(spark, rows[:20]), R.VERTICAL_SCAN)) == []
    assert times(R.sliding_matches(events(spark, rows), R.VERTICAL_SCAN)) == [20.0]


def test_look_back_includes_exactly_five_minutes(spark):
    rows = [(0, "a", "b", 22)] * 7
    assert times(R.sliding_matches(events(spark, rows + [(300, "a", "b", 22)]), R.SSH_BRUTE_FORCE)) == [300.0]
    assert times(R.sliding_matches(events(spark, rows + [(300.001, "a", "b", 22)]), R.SSH_BRUTE_FORCE)) == []


def test_random_events_agree_with_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(0, 3000), rng.choice("ab"), "d", rng.randrange(40)) for _ in range(600)]
    for rule, measure, met in ((R.VERTICAL_SCAN, lambda w: len({p for _, _, _, p in w}), lambda n: n > 20),
                               (R.SSH_BRUTE_FORCE, len, lambda n: n >= 8)):
        expected = {}
        for t, s, _, _ in rows:
            n = measure([r for r in rows if r[1] == s and t - 300 <= r[0] <= t])
            if met(n):
                expected[(s, float(t))] = n
        base = int(T0.timestamp() * 1e6)
        got = {(r.src_ip, (r.us - base) / 1e6): r.hits for r in R.sliding_matches(events(spark, rows), rule).collect()}
        assert got == expected


def greedy(points, wait):
    kept, last = [], None
    for t in sorted(set(points)):
        if last is None or t - last >= wait:
            kept.append(t)
            last = t
    return kept


def test_suppression_is_greedy(spark):
    rng = random.Random(3)
    points = [rng.randrange(0, 5000) for _ in range(300)] + [20000, 20059, 20060]
    df = spark.createDataFrame([("k", t * 1_000_000) for t in points], "k string, us bigint")
    got = sorted({r.us // 1_000_000 for r in R.suppress_realerts(df, ["k"], 60).collect()})
    assert got == greedy(points, 60)


def test_streaming_suppression_matches_batch(spark, tmp_path):
    points = [0, 30, 61, 100, 121, 300]
    spark.createDataFrame([("k", t * 1_000_000) for t in points], "k string, us bigint").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, us bigint").parquet(str(tmp_path / "in"))
    q = (suppress_stream(stream, ["k"], 60, "k string, us bigint").writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.us // 1_000_000 for r in spark.read.parquet(str(tmp_path / "out")).collect()) == greedy(points, 60)


def test_enrichment_interval_bounds(spark):
    rows = [(1000, "a", "b", 1), (700, "a", "b", 2), (699, "a", "b", 3), (1180, "a", "b", 4), (1181, "a", "b", 5)]
    df = events(spark, rows)
    alerts = df.where("dst_port = 1").selectExpr("src_ip", "dst_ip", "unix_micros(ts) as us")
    full = df.selectExpr("*", "'tcp' as transport", "named_struct('state', if(dst_port = 4, 'REJ', 'SF')) as conn", "'ssh' as protocol")
    r = R.enrich_scans(alerts, full).first()
    assert (r.unique_ports, r.ports, r.interesting_ports, r.states) == (3, [1, 2, 4], [1, 2], {"REJ": 1, "SF": 2})


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_alerts_are_found_among_stored_matches(spark):
    rows = [(i, "a", "b", i) for i in range(90)]
    alerts = R.run_rule(events(spark, rows), R.VERTICAL_SCAN)
    assert "Window" not in plan(alerts) and "dst_port" not in plan(alerts)
    assert times(alerts) == [20.0, 80.0]


def test_enrichment_reads_its_join_once(spark):
    rows = [(1000, "a", "b", 1), (1001, "a", "b", None), (1002, "a", "b", 2), (1003, "a", "b", 2), (1000, "c", "d", None)]
    df = events(spark, rows).selectExpr("*", "'tcp' as transport", "if(dst_port = 2, named_struct('state', 'REJ'), named_struct('state', null)) as conn", "if(dst_port = 2, 'ssh', null) as protocol")
    alerts = df.where("ts = timestamp_seconds(%d)" % (T0.timestamp() + 1000)).selectExpr("src_ip", "dst_ip", "unix_micros(ts) as us")
    out = R.enrich_scans(alerts, df)
    assert plan(out).count("Join ") == 1
    r, = out.collect()  # an alert without any port has no row
    assert (r.src_ip, r.unique_ports, r.ports, r.interesting_ports, r.states, r.protocols) == ("a", 2, [1, 2], [1], {"REJ": 2}, None)
