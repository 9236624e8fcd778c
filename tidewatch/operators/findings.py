"""From scored behaviours to findings: indicators, gate, analyst feedback, evidence pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.values import iso_millis
from tidewatch.operators.behaviors import KEY, session_ref_rows
from tidewatch.settings import ASSET_15M, DEFAULTS, FeatureSpec, Settings

c = F.col
FINDING_TYPE = "ml_behavior_anomaly"
# Indicator name and the feature conditions that raise it (feature, operator, bound).
INDICATORS = (
    ("dns_txt_queries", (("dns_txt_count", ">", 0),)),
    ("long_dns_queries", (("dns_long_query_count", ">", 0),)),
    ("high_dns_nxdomain_ratio", (("dns_nxdomain_ratio", ">=", 0.5), ("dns_session_count", ">=", 20))),
    ("ssh_activity_burst", (("ssh_session_count", ">=", 10),)),
    ("ssh_auth_attempt_burst", (("ssh_auth_attempt_sum", ">=", 10),)),
    ("many_destination_ports", (("unique_destination_port_count", ">=", 100),)),
    ("zeek_notice_present", (("notice_count", ">", 0),)),
    ("zeek_weird_present", (("weird_count", ">", 0),)),
    ("tls_invalid_cert", (("tls_invalid_cert_count", ">", 0),)),
    ("tls_self_signed_cert", (("tls_self_signed_count", ">", 0),)),
    ("tls_expired_cert", (("tls_expired_cert_count", ">", 0),)),
    ("large_file_transfer", (("files_total_bytes_sum", ">=", 10000000),)),
)
STRONG_SCORE, RELEVANT_SCORE = 0.70, 0.62


def indicators(features: str = "features") -> Column:
    def one(name: str, conditions) -> Column:
        hit = F.lit(True)
        for feature, op, bound in conditions:
            value = F.coalesce(c(f"{features}.{feature}"), F.lit(0))
            hit = hit & (value >= bound if op == ">=" else value > bound)
        return F.when(hit, F.lit(name))

    return F.array_compact(F.array(*[one(n, cond) for n, cond in INDICATORS]))


def gate(score: Column, anomaly: Column, found: Column) -> Column:
    """A strong anomaly, or a fair one that also shows a security indicator."""
    strong = score >= STRONG_SCORE
    return F.coalesce(anomaly, F.lit(False)) & (strong | ((score >= RELEVANT_SCORE) & (F.size(found) > 0)))


def latest_status(findings: DataFrame, key: str) -> DataFrame:
    """Newest analyst status per behaviour or dedup id."""
    known = findings.where(c("status").isNotNull() & (c("status") != ""))
    return known.groupBy(key).agg(F.lower(F.max_by("status", F.struct("created_at", "status"))).alias("status"))


def build_findings(scored: DataFrame, stored: DataFrame | None = None, settings: Settings = DEFAULTS,
                   created_at: Column | None = None) -> DataFrame:
    """Finding rows keyed by dedup_id; statuses of stored findings suppress or carry over.

    ``stored`` has (dedup_id, status, created_at).
    """
    rows = scored.withColumn("found", indicators()).where(gate(c("ml.anomaly_score"), c("ml.is_anomaly"), c("found")))
    rows = rows.withColumn("dedup_id", F.concat("behavior_id", F.lit(f"|{FINDING_TYPE}")))
    if stored is None:
        rows = rows.withColumn("known", F.lit(None).cast("string"))
    else:
        rows = rows.join(latest_status(stored, "dedup_id").withColumnRenamed("status", "known"), "dedup_id", "left")
    rows = rows.where(~F.coalesce(c("known").isin(*settings.excluded_feedback), F.lit(False)))
    reasons = F.array_union(F.coalesce(c("score.reasons"), F.array().cast("array<string>")), c("found"))
    reasons = F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit(FINDING_TYPE)))
    drivers = F.slice(F.transform("ml.top_features", lambda t: t["name"]), 1, 5)
    tail = F.when(F.size(drivers) > 0, F.concat(F.lit("Main drivers: "), F.array_join(drivers, ", "), F.lit("."))).otherwise(
        "Review ml.top_features for the main drivers.")
    summary = F.concat(
        F.lit("ML behavior anomaly detected for host "), F.coalesce("entity", F.lit("unknown")), F.lit(" during "), iso_millis(c("window_start")),
        F.lit(" to "), iso_millis(c("window_end")), F.lit(" with severity "), c("score.severity"), F.lit(" and anomaly score "),
        c("ml.anomaly_score").cast("string"), F.lit(". "), tail)
    return rows.select(
        "dedup_id", F.lit(FINDING_TYPE).alias("type"), c("window_start").alias("ts"), c("score.severity").alias("severity"),
        c("ml.anomaly_score").alias("confidence"), F.coalesce("known", F.lit("new")).alias("status"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        "behavior_id", "entity", "sensor", "window_start", "window_end", "feature_set", c("score.final").alias("final_score"),
        c("found").alias("security_indicators"), reasons.alias("reasons"), "evidence",
        F.struct(*[c(f"ml.{n}") for n in ("anomaly_score", "is_anomaly", "model_name", "model_version", "top_features")]).alias("ml"),
        summary.alias("summary"),
    ).dropDuplicates(["dedup_id"])


def pivot_to_sessions(findings: DataFrame, sessions: DataFrame, spec: FeatureSpec = ASSET_15M, settings: Settings = DEFAULTS) -> DataFrame:
    """finding -> all eligible sessions of its window; ``spec`` is the feature set of the findings that are read.

    The list in ``evidence.session_refs`` is for display only, as it is cut.
    """
    keys = findings.where(c("feature_set") == spec.feature_set).select(
        "dedup_id", "behavior_id", "entity", F.coalesce("sensor", F.lit("")).alias("sensor_key"), "window_start")
    refs = session_ref_rows(sessions, spec, settings.entity_mode).select(*KEY, c("ref").alias("r"))
    return keys.join(refs, KEY).select("dedup_id", "behavior_id", "r.*")


def pivot_to_raw(refs: DataFrame, raw: DataFrame) -> DataFrame:
    """Session references -> raw events, by uid, or by community id where there is no uid."""
    by_uid = refs.where(c("uid").isNotNull()).select("dedup_id", "session_id", "uid").join(
        raw.select("uid", "raw_id", "log_type", "ts"), "uid").drop("uid")
    by_cid = refs.where(c("uid").isNull() & c("community_id").isNotNull()).select("dedup_id", "session_id", "community_id").join(
        raw.select("community_id", "raw_id", "log_type", "ts"), "community_id").drop("community_id")
    return by_uid.unionByName(by_cid)
