"""IP, metric text and score helpers against the standard library or plain arithmetic."""

import ipaddress

from pyspark.sql import functions as F

from tidewatch.functions import ip as I
from tidewatch.operators import findings as FI, forest as K, health as H

ADDRESSES = [
    "10.0.0.1", "8.8.8.8", "172.31.255.255", "172.32.0.0", "100.64.0.1", "203.0.113.7", "203.0.114.7", "192.0.0.9", "192.0.0.11", "0.0.0.0", "255.255.255.255",
    "127.0.0.1", "169.254.1.1", "224.0.0.22", "01.2.3.4", "1.2.3", "256.1.1.1", "", "::", "::1", "fe80::1", "ff02::1", "2001:db8::1", "2606:4700::1111", "fd00::1",
    "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8::", ":1::2", "1::2::3", "::ffff:10.0.0.1", "::ffff:8.8.8.8", "g::1", "2002::1", "64:ff9b:1::1",
]


def test_addresses_match_the_standard_library(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "ip string")
    got = {r.ip: (r.p, r.hex) for r in df.select("ip", I.is_private(F.col("ip")).alias("p"), I.v6_hex(F.col("ip")).alias("hex")).collect()}
    for text in ADDRESSES:
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            assert got[text] == (None, None), text
            continue
        assert got[text][0] == address.is_private, text
        if address.version == 6:
            assert got[text][1] == address.packed.hex(), text


def test_subnet_lookup_prefers_the_longest_prefix(spark):
    nets = spark.createDataFrame([("a", "v", "wide", "10.0.0.0/8"), ("b", "v", "near", "10.1.2.0/24")], "spoke string, vnet string, subnet string, subnet_cidr string")
    ips = spark.createDataFrame([("10.1.2.3",), ("10.9.9.9",), ("8.8.8.8",), ("x",)], "ip string")
    assert {r.ip: r.subnet for r in I.lookup_subnets(ips, nets).collect()} == {"10.1.2.3": "near", "10.9.9.9": "wide", "8.8.8.8": None, "x": None}


def test_metric_text(spark):
    lines = spark.createDataFrame([('component_errors_total{component_id="dp",component_type="sink"} 3',), ("up 1",), ("# c",), ("nope",)], "line string")
    rows = sorted(H.parse_metrics(lines).collect(), key=lambda r: r.name)
    assert [(r.name, dict(r.labels), r.value) for r in rows] == [("component_errors_total", {"component_id": "dp", "component_type": "sink"}, 3.0), ("up", {}, 1.0)]


def test_health_score(spark):
    checks = spark.createDataFrame([("a", "x", "ok", ""), ("b", "x", "warn", ""), ("c", "x", "unknown", "")], "id string, component string, status string, summary string")
    r = H.component_summary(checks).where("component is null").first()
    assert (r.status, r.score) == ("warn", 90)


def test_gate_bounds(spark):
    rows = [(0.61, True, ["x"]), (0.62, True, ["x"]), (0.62, True, []), (0.69, True, []), (0.70, True, []), (0.9, False, ["x"])]
    df = spark.createDataFrame(rows, "score double, anomaly boolean, found array<string>")
    got = [r.g for r in df.select(FI.gate(F.col("score"), F.col("anomaly"), F.col("found")).alias("g")).collect()]
    assert got == [False, True, False, False, True, False]


def test_forest_isolates_the_outlier(spark):
    from tidewatch.settings import Settings
    settings = Settings(trees=40, sample_size=64)
    data = [(f"b{i}", [float(i % 7), float(i % 5)]) for i in range(200)] + [("odd", [500.0, -500.0])]
    m = spark.createDataFrame(data, "behavior_id string, x array<double>")
    nodes = K.train_forest(m, settings)
    assert nodes.select("tree").distinct().count() == 40
    score = K.score_function(nodes, 64)
    best = m.select("behavior_id", score("x").alias("s")).orderBy(F.desc("s")).first()
    assert best.behavior_id == "odd" and 0.5 < best.s <= 1.0
