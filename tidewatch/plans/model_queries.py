"""Training selection, baseline, scores, findings and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import findings as FI, forest as K
from tidewatch.plans import oracle as O
from tidewatch.plans.behavior_queries import _DNS, _FILES, _NW, _SSH, _TLS
from tidewatch.plans.catalog import query
from tidewatch.plans.views import behavior_table, epoch, joined, raw_table, session_table, stored, us
from tidewatch.settings import ASSET_15M, DEFAULTS

c = F.col
_WINDOWS = f"""w AS MATERIALIZED (SELECT 'asset_15m_v1|' || sensor_key || '|' || entity || '|' || strftime(make_timestamp(window_us), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS behavior_id, window_us,
    count(*) FILTER (WHERE eligible) AS used, count(*) AS total, CAST(coalesce(sum(coalesce(bytes, 0)) FILTER (WHERE eligible), 0) AS DOUBLE) AS bytes, count(DISTINCT dst_port) FILTER (WHERE eligible) AS ports
    FROM rows_all GROUP BY {O.BY_WIN})"""


def _sql(tail: str) -> str:
    return f"WITH {O.BEH}, {_WINDOWS} {tail}"


@query("k01_feature_matrix", _sql("SELECT behavior_id, CAST(used AS DOUBLE) AS first_value FROM w WHERE used >= 2"))
def matrix(spark, d):
    return K.feature_matrix(behavior_table(spark, d), ASSET_15M).select("behavior_id", F.get("x", F.lit(0)).alias("first_value"))


_QUANTILES = """SELECT 'session_count' AS feature, median(used) AS median, CASE WHEN quantile_cont(used, 0.9) = quantile_cont(used, 0.1) THEN 1.0 ELSE quantile_cont(used, 0.9) - quantile_cont(used, 0.1) END AS spread FROM w WHERE used >= 2
    UNION ALL SELECT 'network_bytes_sum', median(bytes), quantile_cont(bytes, 0.9) - quantile_cont(bytes, 0.1) FROM w WHERE used >= 2"""


@query("k02_median_baseline", _sql(_QUANTILES))
def baseline(spark, d):
    rows = K.robust_baseline(K.feature_matrix(behavior_table(spark, d), ASSET_15M), ASSET_15M)
    return rows.where(c("feature").isin("session_count", "network_bytes_sum")).select("feature", "median", "spread")


@query("k03_robust_scale", _sql("SELECT behavior_id, round((bytes - (SELECT median(bytes) FROM w WHERE used >= 2)) / (SELECT quantile_cont(bytes, 0.9) - quantile_cont(bytes, 0.1) FROM w WHERE used >= 2), 6) AS scaled_bytes FROM w WHERE used >= 2"))
def robust_scale(spark, d):
    m = K.feature_matrix(behavior_table(spark, d), ASSET_15M)
    rows = K.scaled(m, K.robust_baseline(m, ASSET_15M))
    return rows.select("behavior_id", F.round(F.get("x", F.lit(4)), 6).alias("scaled_bytes"))


def scored_table(spark, d):
    return stored(spark, d, "scored", lambda: K.score_behaviors(behavior_table(spark, d), K.training_rows(behavior_table(spark, d)), ASSET_15M))


@query("k04_isolation_forest")
def forest(spark, d):
    m = K.feature_matrix(K.training_rows(behavior_table(spark, d)), ASSET_15M)
    return K.train_forest(m).groupBy("tree").agg(F.count("*").alias("nodes"), F.max("path").alias("deepest"))


@query("k05_scores")
def scores(spark, d):
    return scored_table(spark, d).select("behavior_id", "ml.anomaly_score", "ml.is_anomaly", "score.final", "score.severity")


def _injected(spark, d):
    """Behaviours with a score derived from their counts, so that everything after scoring is exactly checkable."""
    b = behavior_table(spark, d)
    n = c("quality.session_count_total")
    raw = b.select("behavior_id", ((n * 37 % 100) / F.lit(100.0)).alias("raw")).where(c("raw") > 0)
    base = F.array(*[F.lit(float(i % 3)) for i in range(len(ASSET_15M.vector))])
    return K.apply_scores(b, raw, F.lit(0.8), base, ASSET_15M, epoch())


_RAW = "(total * 37 % 100) / 100.0"
_SCORE = f"round(1 / (1 + pow(2.718281828, -{_RAW})), 6)"


@query("k06_top_drivers", _sql(f"SELECT behavior_id, 'network_bytes_sum' AS driver FROM w WHERE {_RAW} > 0 AND bytes > 1000"))
def drivers(spark, d):
    rows = _injected(spark, d).where("features.network_bytes_sum > 1000 and ml.anomaly_score is not null")
    big = F.filter("ml.top_features", lambda t: t["name"] == "network_bytes_sum")
    return rows.select("behavior_id", F.get(big, F.lit(0))["name"].alias("driver"))


@query("k07_severity", _sql(f"SELECT behavior_id, {_SCORE} AS score, CASE WHEN {_RAW} > 0.8 THEN 'medium' ELSE 'none' END AS severity, round({_SCORE} * 100, 2) AS final FROM w WHERE {_RAW} > 0"))
def severity(spark, d):
    return _injected(spark, d).where("ml.anomaly_score is not null").select("behavior_id", c("ml.anomaly_score").alias("score"), "score.severity", "score.final")


@query("k08_model_staleness", O.raw("SELECT raw_id, count(*) AS n, k * 1000 >= 21600 AS stale FROM raw GROUP BY raw_id, k"))
def staleness(spark, d):
    k = F.get_json_object("doc", "$.k").cast("bigint")
    stale = K.model_is_stale(F.timestamp_seconds(F.lit(1704067200) - k * 1000), epoch())
    return raw_table(spark, d).groupBy("raw_id", stale.alias("stale")).agg(F.count("*").alias("n"))


_COUNTED = """SELECT 'asset_15m_v1|' || sensor_key || '|' || entity || '|' || strftime(make_timestamp(window_us), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS behavior_id,
    count(*) FILTER (WHERE q.qtype_name = 'TXT') AS txt, count(*) FILTER (WHERE length(q.query) >= 80) AS long_names,
    coalesce(round(count(*) FILTER (WHERE q.rcode_name = 'NXDOMAIN') / nullif(count(q.key), 0), 6), 0.0) AS missing_names, count(q.key) AS names,
    count(sh.key) AS ssh, coalesce(sum(sh.tries), 0) AS tries, count(DISTINCT used.dst_port) AS used_ports,
    coalesce(sum(CASE WHEN nw.n THEN greatest(1, nw.notes) END), 0) AS notices, coalesce(sum(CASE WHEN nw.w THEN greatest(1, nw.weirds) END), 0) AS weirds,
    count(*) FILTER (WHERE t.validation_status <> 'ok') AS invalid,
    count(*) FILTER (WHERE t.key IS NOT NULL AND (t.validation_status LIKE '%self%' OR coalesce(list_has_any(issuers, subjects), false))) AS self_signed,
    count(*) FILTER (WHERE t.key IS NOT NULL AND (t.validation_status LIKE '%expired%' OR oldest < first_us / 1000000.0)) AS expired, coalesce(sum(fl.size), 0) AS file_bytes
    FROM used LEFT JOIN dns q ON q.key = used.key LEFT JOIN sh ON sh.key = used.key LEFT JOIN nw ON nw.key = used.key LEFT JOIN tl t ON t.key = used.key
    LEFT JOIN xf ON xf.key = used.key LEFT JOIN fl ON fl.key = used.key GROUP BY entity, sensor_key, window_us"""
_SHOWN = (
    ("dns_txt_queries", "txt > 0"), ("long_dns_queries", "long_names > 0"), ("high_dns_nxdomain_ratio", "missing_names >= 0.5 AND names >= 20"), ("ssh_activity_burst", "ssh >= 10"),
    ("ssh_auth_attempt_burst", "tries >= 10"), ("many_destination_ports", "used_ports >= 100"), ("zeek_notice_present", "notices > 0"), ("zeek_weird_present", "weirds > 0"),
    ("tls_invalid_cert", "invalid > 0"), ("tls_self_signed_cert", "self_signed > 0"), ("tls_expired_cert", "expired > 0"), ("large_file_transfer", "file_bytes >= 10000000"))
_FOUND = f"""{_DNS}{_FILES}{_TLS}{_SSH}{_NW}, counted AS ({_COUNTED}),
marked AS (SELECT w.*, coalesce(list_filter([{', '.join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _SHOWN)}], lambda x: x IS NOT NULL), []) AS found FROM w LEFT JOIN counted USING (behavior_id)),
gated AS (SELECT *, {_SCORE} AS confidence, behavior_id || '|ml_behavior_anomaly' AS dedup_id FROM marked WHERE {_RAW} > 0.8 AND ({_SCORE} >= 0.70 OR {_SCORE} >= 0.62 AND len(found) > 0))"""


def _findings_sql(tail: str) -> str:
    """Over ``marked``, windows with their indicators, and ``gated``, those that pass either branch of the gate."""
    return f"WITH {O.BEH}, {_WINDOWS}{_FOUND} {tail}"


@query("k09_security_indicators", _findings_sql("SELECT behavior_id, nullif(array_to_string(found, '|'), '') AS indicators FROM marked"))
def indicator_rows(spark, d):
    return behavior_table(spark, d).select("behavior_id", joined(FI.indicators()).alias("indicators"))


@query("k10_finding_gate", _findings_sql("SELECT count(*) FILTER (WHERE confidence >= 0.70) AS strong, count(*) FILTER (WHERE confidence < 0.70) AS fair FROM gated"))
def finding_gate(spark, d):
    strong = c("confidence") >= FI.STRONG_SCORE
    return FI.build_findings(_injected(spark, d), created_at=epoch()).agg(F.count_if(strong).alias("strong"), F.count_if(~strong).alias("fair"))


@query("k11_finding_build", _findings_sql("SELECT dedup_id, confidence, 'new' AS status, window_us FROM gated"))
def finding_build(spark, d):
    return FI.build_findings(_injected(spark, d), created_at=epoch()).select("dedup_id", "confidence", "status", us("window_start").alias("window_us"))


def both_branches(scored):
    """Findings of both branches of the gate: strong anomalies, and fair ones with a security indicator."""
    rows = FI.build_findings(scored, created_at=epoch())
    return rows.select("dedup_id", "confidence", "status", us("window_start").alias("window_us"), joined(c("security_indicators")).alias("indicators"))


@query("k11_all_findings", _findings_sql("SELECT dedup_id, confidence, 'new' AS status, window_us, nullif(array_to_string(found, '|'), '') AS indicators FROM gated"))
def all_findings(spark, d):
    return both_branches(_injected(spark, d))


@query("k12_model_row", _sql("SELECT 'asset_15m_v1_iforest_v1' AS version, count(*) AS training_rows, CASE WHEN count(*) < 20 THEN 'not_enough_training_data' ELSE 'trained' END AS status FROM w WHERE used >= 2"))
def model_row(spark, d):
    return K.model_row(K.feature_matrix(behavior_table(spark, d), ASSET_15M), ASSET_15M).select("version", "training_rows", "status")


@query("k13_cold_start", _sql("SELECT 'not_enough_training_data' AS status, count(*) AS n FROM w"))
def cold_start(spark, d):
    return K.with_status(behavior_table(spark, d), "not_enough_training_data").groupBy(c("ml.scoring_status").alias("status")).agg(F.count("*").alias("n"))


@query("f12_unscored_selection", _sql("SELECT behavior_id FROM w WHERE used >= 2"))
def unscored(spark, d):
    return K.unscored(behavior_table(spark, d)).select("behavior_id")


@query("f13_training_selection", _sql("SELECT behavior_id FROM w WHERE used >= 2 AND total % 5 <> 0 AND total % 7 <> 0"))
def training(spark, d):
    b = behavior_table(spark, d)
    total = c("quality.session_count_total")
    feedback = b.where(total % 5 == 0).select("behavior_id", F.lit("False_Positive").alias("status"))
    return K.training_rows(b, b.where(total % 7 == 0), feedback).select("behavior_id")


def _statuses(spark, d):
    """Analyst statuses: two per window, the later one decides."""
    b = behavior_table(spark, d)
    n = c("quality.session_count_total")
    pairs = F.array(F.struct(F.lit("new").alias("status"), F.lit(1).alias("t")),
                    F.struct(F.when(n % 3 == 0, "False_Positive").when(n % 3 == 1, "confirmed").otherwise("new").alias("status"), F.lit(2).alias("t")))
    rows = b.select("behavior_id", F.concat("behavior_id", F.lit("|ml_behavior_anomaly")).alias("dedup_id"), F.explode(pairs).alias("p"))
    return rows.select("behavior_id", "dedup_id", "p.status", F.timestamp_seconds("p.t").alias("created_at"))


@query("j08_latest_status", _sql("SELECT behavior_id, CASE total % 3 WHEN 0 THEN 'false_positive' WHEN 1 THEN 'confirmed' ELSE 'new' END AS status FROM w"))
def latest_status(spark, d):
    return FI.latest_status(_statuses(spark, d), "behavior_id")


@query("j09_feedback_suppression", _findings_sql("SELECT dedup_id, CASE total % 3 WHEN 1 THEN 'confirmed' ELSE 'new' END AS status FROM gated WHERE total % 3 <> 0"))
def suppression(spark, d):
    return FI.build_findings(_injected(spark, d), _statuses(spark, d), created_at=epoch()).select("dedup_id", "status")


@query("j11_finding_pivot", _findings_sql("""SELECT dedup_id, count(*) AS sessions FROM gated JOIN (SELECT *, 'asset_15m_v1|' || sensor_key || '|' || entity || '|' || strftime(make_timestamp(window_us), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS behavior_id FROM used) u
    USING (behavior_id) GROUP BY 1"""))
def pivot(spark, d):
    rows = FI.build_findings(_injected(spark, d), created_at=epoch())
    return FI.pivot_to_sessions(rows, session_table(spark, d)).groupBy("dedup_id").agg(F.count("*").alias("sessions"))


@query("t01_latest_behaviors", _sql("SELECT behavior_id, window_us FROM w ORDER BY window_us DESC, behavior_id LIMIT 10"))
def latest_behaviors(spark, d):
    from tidewatch.operators.lookups import newest
    return newest(behavior_table(spark, d), 10, ["behavior_id", us("window_start").alias("window_us")], "window_start", "behavior_id")
