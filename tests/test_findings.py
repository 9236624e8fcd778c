"""Findings: pivots over whole windows."""

from pyspark.sql import functions as F
from test_sessions import event, raw

from tidewatch.operators.behaviors import KEY, session_ref_rows, session_refs, with_behavior_key, with_eligibility
from tidewatch.operators.findings import INDICATORS, pivot_to_raw, pivot_to_sessions
from tidewatch.operators.hardening import harden_sessions
from tidewatch.operators.sessions import build_sessions
from tidewatch.plans.model_queries import both_branches


def test_pivot_reaches_every_session_of_a_window(spark, tmp_path):
    names = [f"C{i:03d}" for i in range(250)]
    rows = raw(spark, *[event("conn", f"r{i:03d}", i, uid=n, service="ssl") for i, n in enumerate(names)],
               event("conn", "later", 1200, uid="D1", service="ssl"))
    harden_sessions(build_sessions(rows, sections=(), parts=("facts",))).write.parquet(str(tmp_path / "sessions"))
    sessions = spark.read.parquet(str(tmp_path / "sessions"))
    windows = session_ref_rows(sessions).groupBy(*KEY).agg(F.count("*").alias("n")).where("n = 250")
    findings = windows.select("*", c_("b", "behavior_id"), c_("d", "dedup_id"), c_("asset_15m_v1", "feature_set"), F.nullif("sensor_key", F.lit("")).alias("sensor"))
    refs = pivot_to_sessions(findings, sessions)
    assert sorted(r.session_id for r in refs.collect()) == names
    assert sorted(r.raw_id for r in pivot_to_raw(refs, rows).collect()) == [f"r{i:03d}" for i in range(250)]
    shown = session_refs(with_eligibility(with_behavior_key(sessions)), 200).where(F.size("session_refs") > 1).first()
    assert [r.id for r in shown.session_refs] == names[:200]


def c_(value, name):
    return F.lit(value).alias(name)


def test_both_branches_of_the_gate_equal_brute_force(spark):
    conditions = {name: cond for name, cond in INDICATORS}
    features = sorted({f for cond in conditions.values() for f, _, _ in cond})
    bases = [{}] + [{f: bound + (op == ">") for f, op, bound in cond} for cond in conditions.values()]
    bases += [{f: bound - (op == ">=") * (0.01 if f.endswith("ratio") else 1) for f, op, bound in cond} for cond in conditions.values()]
    cases = [(b, score, anomaly) for b in bases for score in (0.61, 0.62, 0.69, 0.70, 0.9, None) for anomaly in (True, False, None)]
    rows = [(str(i), *[float(b.get(f, 0)) for f in features], score, anomaly) for i, (b, score, anomaly) in enumerate(cases)]
    flat = spark.createDataFrame(rows, f"behavior_id string, {', '.join(f'{f} double' for f in features)}, s double, a boolean")
    none = lambda t, n: F.lit(None).cast(t).alias(n)
    scored = flat.select(
        "behavior_id", c_("h", "entity"), none("string", "sensor"), F.timestamp_seconds(F.lit(0)).alias("window_start"), F.timestamp_seconds(F.lit(900)).alias("window_end"),
        c_("asset_15m_v1", "feature_set"), F.struct(F.lit(1).alias("n")).alias("evidence"), F.struct(*features).alias("features"),
        F.struct(F.col("s").alias("anomaly_score"), F.col("a").alias("is_anomaly"), none("string", "model_name"), none("string", "model_version"),
                 F.array().cast("array<struct<name:string>>").alias("top_features")).alias("ml"),
        F.struct(F.array().cast("array<string>").alias("reasons"), c_("medium", "severity"), c_(1.0, "final")).alias("score"))
    want = {}
    for i, (b, score, anomaly) in enumerate(cases):
        hits = [n for n, cond in conditions.items() if all(b.get(f, 0) >= x if op == ">=" else b.get(f, 0) > x for f, op, x in cond)]
        if anomaly and score is not None and (score >= 0.70 or score >= 0.62 and hits):
            want[f"{i}|ml_behavior_anomaly"] = (score, "|".join(hits) or None)
    got = {r.dedup_id: (r.confidence, r.indicators) for r in both_branches(scored).collect()}
    assert got == want and {0.62, 0.69} <= {score for score, _ in want.values()}
