"""Data-quality checks: each turns tables into check rows, and check rows roll up to a score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.protocols import literal_map
from tidewatch.functions.values import age_seconds, seconds_to_human
from tidewatch.operators.sessions import FLAGS
from tidewatch.settings import COMPONENT_LABELS, DEFAULTS, FRESHNESS_LIMITS, REQUIRED_LOG_TYPES, Settings

c = F.col
RANK = {"ok": 0, "unknown": 1, "warn": 2, "crit": 3}
PENALTY = {"crit": 18, "warn": 7, "unknown": 3}


def _minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def recent(df: DataFrame, as_of: Column, minutes: int, ts: str = "ts") -> DataFrame:
    return df.where(c(ts).between(as_of - _minutes(minutes), as_of))


def check_row(df: DataFrame, id_: str, component: str, status: Column, summary: Column, **metrics: Column) -> DataFrame:
    values = F.create_map(*[x for k, v in metrics.items() for x in (F.lit(k), v.cast("double"))]) if metrics else F.create_map().cast("map<string,double>")
    return df.select(F.lit(id_).alias("id"), F.lit(component).alias("component"), status.alias("status"), summary.alias("summary"), values.alias("metrics"))


# ---------------------------------------------------------------- reports

def session_report(sessions: DataFrame) -> DataFrame:
    """Counters over the whole session table (one aggregate), as (metric, value) rows."""
    blank = lambda x: F.coalesce(x, F.lit("")) == ""
    flow = F.coalesce(c("flow_based"), F.lit(True))
    # The report expects has_tls for ssl only, unlike the builder, which also counts tls.
    expected = {f: ("ssl" if f == "has_tls" else types[0]) for f, types in FLAGS.items()}
    mismatches = reduce(lambda a, b: a + b, [
        (F.coalesce(c(f), F.lit(False)) != F.coalesce(F.array_contains("log_types", t), F.lit(False))).cast("int") for f, t in expected.items()])
    per_id = sessions.groupBy("session_id").agg(F.count("*").alias("n"))
    one = sessions.agg(
        F.count("*").alias("session_count"), F.count_if(blank(c("protocol"))).alias("missing_network_protocol"),
        F.count_if(F.coalesce("evidence_count", F.lit(0)) <= 0).alias("missing_evidence"),
        F.count_if(flow & blank(c("src_ip"))).alias("missing_source_ip"), F.count_if(flow & blank(c("dst_ip"))).alias("missing_destination_ip"),
        F.count_if(c("excluded_from_behavior")).alias("control_plane_tagged"), F.count_if(~flow).alias("non_flow_sessions"),
        F.count_if(c("category") == "malformed_raw").alias("malformed_raw_sessions"), F.count_if(c("events_truncated")).alias("events_truncated"),
        F.coalesce(F.sum(mismatches), F.lit(0)).alias("flag_mismatches"))
    dup = per_id.agg(F.count_if(c("n") > 1).alias("v")).select(F.lit("duplicate_session_ids").alias("metric"), c("v").cast("bigint").alias("value"))
    return to_metrics(one).unionByName(dup)


def to_metrics(one_row: DataFrame) -> DataFrame:
    names = one_row.columns
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), c(n).cast("bigint").alias("value")) for n in names])
    return one_row.select(F.explode(pairs).alias("m")).select("m.*")


def terms(df: DataFrame, value: Column, limit: int = 10, missing: str | None = "__missing__") -> DataFrame:
    """Top values with their counts; nulls form a bucket unless ``missing`` is None."""
    v = value.cast("string")
    rows = df.select((F.coalesce(v, F.lit(missing)) if missing is not None else v).alias("value")).where(c("value").isNotNull())
    return rows.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(limit)


def facet_terms(df: DataFrame, facets: dict[str, Column], limit: int = 10) -> DataFrame:
    """Several terms lists in one pass over the table."""
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), v.cast("string").alias("value")) for n, v in facets.items()])
    counts = df.select(F.explode(pairs).alias("p")).where("p.value is not null").groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("facet").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(c("rank") <= limit)


def bad_vectors(behaviors: DataFrame) -> DataFrame:
    names, vector = F.size("ml.feature_names"), F.size("ml.feature_vector")
    return behaviors.where((names != vector) | (vector != F.coalesce(c("ml.vector_length"), names)))


def behavior_report(behaviors: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    ready = c("ml.ready")
    names, vector = F.size("ml.feature_names"), F.size("ml.feature_vector")
    refs = c("evidence.session_ref_count")
    one = behaviors.agg(
        F.count("*").alias("behavior_count"), F.count_if(c("ml.feature_vector").isNull()).alias("missing_feature_vector"),
        F.count_if(c("ml.feature_names").isNull()).alias("missing_feature_names"), F.count_if(c("entity").isNull()).alias("missing_entity"),
        F.count_if(c("window_start").isNull() | c("window_end").isNull()).alias("missing_window"),
        F.count_if(c("quality.data_quality_score").isNull()).alias("missing_quality"),
        F.count_if(ready & (refs.isNull() | (refs <= 0) | ~F.exists("evidence.session_refs", lambda r: r["id"].isNotNull()))).alias("missing_evidence_refs"),
        F.count_if(ready & c("entity").isin("0.0.0.0", "::")).alias("noisy_entity_ml_ready"), F.count_if(ready).alias("ml_ready_count"),
        F.count_if(c("quality.feature_complete")).alias("feature_complete_count"),
        F.count_if((names != vector) | (vector != F.coalesce(c("ml.vector_length"), names))).alias("bad_vector_length"),
        F.count_if(c("ml.scoring_status") == "not_enough_training_data").alias("not_enough_data_windows"))
    out = to_metrics(one)
    fatal = ("missing_feature_vector", "missing_feature_names", "bad_vector_length", "missing_entity", "missing_window", "missing_quality",
             "noisy_entity_ml_ready")
    bad = reduce(lambda a, b: a | b, [c(n) > 0 for n in fatal])
    out = out.unionByName(one.select(F.lit("exit_code").alias("metric"), F.when((c("behavior_count") > 0) & bad, 2).otherwise(0).cast("bigint").alias("value")))
    if findings is not None:
        out = out.unionByName(to_metrics(findings.agg(
            F.count("*").alias("finding_count"), F.count_if(c("dedup_id").isNull()).alias("findings_missing_dedup_id"))))
    return out


# ---------------------------------------------------------------- checks

def classify_age(age: Column, warn: int, crit: int) -> Column:
    return F.when(age.isNull(), "unknown").when(age >= crit, "crit").when(age >= warn, "warn").otherwise("ok")


def latest(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.max(ts).alias("latest"))


def freshness(df: DataFrame, kind: str, component: str, as_of: Column, ts: str = "ts") -> DataFrame:
    age = age_seconds(c("latest"), as_of)
    warn, crit = FRESHNESS_LIMITS[kind]
    text = F.concat(F.lit(f"Latest {kind} event age is "), seconds_to_human(age), F.lit("."))
    return check_row(latest(df, ts), f"{kind}.freshness", component, classify_age(age, warn, crit), text, age_seconds=F.coalesce(age, F.lit(-1.0)))


def missing_values(df: DataFrame, value: str, expected: Sequence[str]) -> DataFrame:
    """One row (missing, n_expected): expected values that never occur, in the given order."""
    wanted = F.array(*[F.lit(x) for x in expected]) if expected else F.array().cast("array<string>")
    seen = df.where(c(value).isin(*expected)) if expected else df.limit(0)
    return seen.agg(F.collect_set(c(value)).alias("seen")).select(F.array_except(wanted, "seen").alias("missing"), F.lit(len(expected)).alias("n_expected"))


def log_type_coverage(raw: DataFrame, as_of: Column, required: Sequence[str] = REQUIRED_LOG_TYPES, minutes: int = 60) -> DataFrame:
    one = missing_values(recent(raw, as_of, minutes), "log_type", required)
    n = F.size("missing")
    status = F.when(n == 0, "ok").when(n <= max(1, len(required) // 2), "warn").otherwise("crit")
    text = F.when(n == 0, "All required log types were observed.").otherwise(F.concat(F.lit("Missing required log types: "), F.array_join("missing", ", "), F.lit(".")))
    return check_row(one, "raw.log_type_coverage", "raw_ingestion", status, text, missing_count=n)


def sensor_coverage(raw: DataFrame, as_of: Column, expected: Sequence[str], candidates: Sequence[str] = ("sensor",), minutes: int = 60) -> DataFrame:
    """The first identity column with any recent value is used for all rows."""
    rows = recent(raw, as_of, minutes)
    counts = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), c(n).cast("string").alias("v")) for i, n in enumerate(candidates)])).alias("p"))
    seen = counts.where("p.v is not null").groupBy("p.i").agg(F.collect_set("p.v").alias("seen"))
    one = seen.agg(F.min_by("seen", "i").alias("seen"), F.min("i").alias("i"))
    wanted = F.array(*[F.lit(x) for x in expected]) if expected else F.array().cast("array<string>")
    one = one.select("i", F.coalesce("seen", F.array().cast("array<string>")).alias("seen")).withColumn("missing", F.array_except(wanted, "seen"))
    n = F.size("missing")
    status = F.when((n > 0) & (n == len(expected)), "crit").when(n > 0, "warn").when(c("i").isNull(), "unknown").otherwise("ok")
    text = F.when(c("i").isNull(), "No sensor identity field could be found in recent raw logs.").when(
        n > 0, F.concat(F.lit("Some expected sensors did not send raw logs: "), F.array_join("missing", ", "), F.lit("."))).otherwise(
        F.format_string("Observed %d sensor(s).", F.size("seen")))
    return check_row(one, "raw.sensor_coverage", "raw_ingestion", status, text, observed_sensors=F.size("seen"), missing_sensors=n)


def missing_percent(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, missing, total, percent): one pass for all fields."""
    one = df.agg(F.count("*").alias("total"), *[F.count_if(v.isNull()).alias(f"m{i}") for i, v in enumerate(fields.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("field"), c(f"m{i}").alias("missing")) for i, n in enumerate(fields)])
    return one.where("total > 0").select("total", F.explode(rows).alias("r")).select(
        "r.field", "r.missing", "total", F.round(c("r.missing") / c("total") * 100, 2).alias("percent"))


def schema_quality(df: DataFrame, fields: dict[str, Column], as_of: Column, minutes: int = 60, settings: Settings = DEFAULTS) -> DataFrame:
    one = missing_percent(recent(df, as_of, minutes), fields).agg(
        F.coalesce(F.max("percent"), F.lit(0.0)).alias("worst"),
        F.array_sort(F.collect_list(F.when(c("percent") > settings.max_missing_percent, c("field")))).alias("bad"))
    status = F.when(F.size("bad") == 0, "ok").when(c("worst") > 25, "crit").otherwise("warn")
    text = F.when(F.size("bad") == 0, "Required raw fields are present.").otherwise(F.concat(F.lit("Missing too often: "), F.array_join("bad", ", "), F.lit(".")))
    return check_row(one, "raw.schema_quality", "raw_ingestion", status, text, max_missing_percent=c("worst"))


def _single(df: DataFrame, *aggs: Column) -> Column:
    return df.agg(F.struct(*aggs).alias("s")).scalar()


def session_flow_check(raw: DataFrame, sessions: DataFrame, as_of: Column, required: dict[str, Column] | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Raw rows without sessions, stale sessions, missing fields, too many exclusions."""
    within = lambda m: c("ts").between(as_of - _minutes(m), as_of)
    fields = required or {}
    one = sessions.agg(
        F.max("ts").alias("latest"), F.count_if(within(30)).alias("sessions"), F.count_if(within(120)).alias("total"),
        F.count_if(within(120) & c("excluded_from_behavior")).alias("excluded"),
        F.array_compact(F.array(*[F.when(F.count_if(within(120) & v.isNull()) * 100 > F.count_if(within(120)) * settings.max_missing_percent, n)
                                  for n, v in fields.items()])).cast("array<string>").alias("missing"))
    one = one.withColumn("raw", recent(raw, as_of, 30).agg(F.count("*")).scalar())
    age = age_seconds(c("latest"), as_of)
    percent = F.coalesce(F.round(c("excluded") * 100 / F.nullif(c("total"), F.lit(0)), 2), F.lit(0.0))
    base = classify_age(age, *FRESHNESS_LIMITS["session"])
    status = F.when((c("raw") > 0) & (c("sessions") == 0), "crit").when(
        (base == "ok") & ((F.size("missing") > 0) | (percent > settings.max_excluded_percent)), "warn").otherwise(base)
    text = F.format_string("Sessions latest age=%s, raw_30m=%d, sessions_30m=%d.", seconds_to_human(age), "raw", "sessions")
    return check_row(one, "sessionizer.output", "sessionizer", status, text, raw_count_30m=c("raw"), session_count_30m=c("sessions"), excluded_percent_2h=percent)


def behavior_flow_check(sessions: DataFrame, behaviors: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> DataFrame:
    b = behaviors.withColumn("ts", c("window_start"))
    within = lambda m: c("ts").between(as_of - _minutes(m), as_of)
    required = {"window_start": c("ts"), "entity": c("entity"), "features": c("features"), "quality": c("quality.data_quality_score"), "ready": c("ml.ready")}
    one = b.agg(F.max("ts").alias("latest"), F.count_if(within(120)).alias("behaviors"), F.count_if(within(1440) & c("ml.ready")).alias("ready"),
                F.array_compact(F.array(*[F.when(F.count_if(within(1440) & v.isNull()) * 100 > F.count_if(within(1440)) * settings.max_missing_percent, n)
                                          for n, v in required.items()])).alias("missing"))
    one = one.withColumn("sessions", recent(sessions, as_of, 120).agg(F.count("*")).scalar())
    age = age_seconds(c("latest"), as_of)
    base = classify_age(age, *FRESHNESS_LIMITS["behavior"])
    status = F.when((c("sessions") > 0) & (c("behaviors") == 0), "crit").when((base == "ok") & (F.size("missing") > 0), "warn").otherwise(base)
    text = F.format_string("Behaviors latest age=%s, sessions_2h=%d, behaviors_2h=%d, ml_ready_24h=%d.", seconds_to_human(age), "sessions", "behaviors", "ready")
    return check_row(one, "behaviorizer.output", "behaviorizer", status, text, session_count_2h=c("sessions"), behavior_count_2h=c("behaviors"), ml_ready_24h=c("ready"))


def scoring_check(behaviors: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    scored = c("ml.anomaly_score").isNotNull()
    one = behaviors.agg(
        F.count_if(c("ml.ready")).alias("ready"), F.count_if(scored).alias("scored"),
        F.count_if(c("ml.ready") & ~scored & ~F.coalesce(c("ml.scoring_status") == "scored", F.lit(False))).alias("waiting"))
    few = c("ready") < settings.min_ready_behaviors
    status = F.when(~few & (c("scored") == 0), "crit").when((c("waiting") > settings.max_unscored_behaviors) | few, "warn").otherwise("ok")
    text = F.when(status == "crit", F.format_string("ML-ready behaviors exist (%d) but no behavior appears scored.", "ready")).when(
        (status == "warn") & few, F.format_string("Only %d ML-ready behavior(s); model may still be waiting for training data.", "ready")).when(
        status == "warn", F.format_string("There are %d ML-ready behaviors waiting for scoring.", "waiting")).otherwise(
        F.format_string("ML pipeline has scored %d behavior(s).", "scored"))
    return check_row(one, "ml.scoring", "ml", status, text, ready_behaviors=c("ready"), scored_behaviors=c("scored"), unscored_ready=c("waiting"))


def alert_presence(state_rows: DataFrame, alerts: DataFrame, as_of: Column) -> DataFrame:
    one = alerts.agg(F.count("*").alias("total"), F.count_if(c("ts").between(as_of - _minutes(1440), as_of)).alias("recent"))
    one = one.withColumn("state", state_rows.agg(F.count("*")).scalar())
    text = F.when(c("state") == 0, "Alert state has no documents yet.").otherwise(F.format_string("Alert state is present; alerts_total=%d, alerts_24h=%d.", "total", "recent"))
    return check_row(one, "elastalert.state", "elastalert", F.when(c("state") == 0, "warn").otherwise("ok"), text, alerts_total=c("total"), alerts_24h=c("recent"))


def flow_presence(flows: DataFrame, as_of: Column) -> DataFrame:
    one = flows.agg(F.count("*").alias("total"), F.max("ts").alias("latest"))
    age = age_seconds(c("latest"), as_of)
    status = F.when(c("total") == 0, "warn").otherwise(classify_age(age, *FRESHNESS_LIMITS["flow"]))
    text = F.when(c("total") == 0, "No NetFlow/IPFIX documents found.").otherwise(
        F.format_string("NetFlow documents exist; latest age=%s, total=%d.", seconds_to_human(age), "total"))
    return check_row(one, "netflow.indices", "netflow", status, text, flow_docs=c("total"))


def table_presence(tables: dict[str, DataFrame], required: Sequence[str] = ("raw", "sessions", "behaviors")) -> DataFrame:
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    one = reduce(DataFrame.unionByName, rows).agg(F.collect_list(F.when(c("n") > 0, c("name"))).alias("present"), F.sum("n").alias("rows"))
    one = one.withColumn("missing", F.array_except(F.array(*[F.lit(x) for x in required]), "present"))
    softer = F.array_contains("missing", "behaviors") | F.array_contains("missing", "sessions")
    status = F.when(F.size("missing") == 0, "ok").when(softer, "warn").otherwise("crit")
    text = F.when(F.size("missing") == 0, "All core tables exist.").otherwise(F.concat(F.lit("Missing tables: "), F.array_join("missing", ", "), F.lit(".")))
    return check_row(one, "opensearch.indices", "opensearch", status, text, missing_count=F.size("missing"), rows=c("rows"))


# ---------------------------------------------------------------- metric text

_NAME = "^[A-Za-z_:][0-9A-Za-z_:]*$"


def _unescaped(value: Column) -> Column:
    """A quoted label value as its text: backslash, quote and newline were escaped."""
    mark = F.lit("\x00")
    halfway = F.replace(F.replace(F.replace(value, F.lit("\\\\"), mark), F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    return F.replace(halfway, mark, F.lit("\\"))


def parse_metrics(lines: DataFrame) -> DataFrame:
    """Exposition text lines to (name, labels, value, sampled_at, series); comments and bad lines are dropped.

    A line is a name, optional labels in braces, a number (NaN and infinities too) and an optional time in milliseconds. Quoted label
    values are taken out first, so that braces, commas and blanks in them do not matter to the cuts that follow.
    """
    quoted = r'"(?:[^"\\]|\\.)*"'
    text = F.trim("line")
    bare = F.regexp_replace(text, quoted, '""')
    rows = lines.where((text != "") & ~text.startswith("#")).withColumns({"_bare": bare, "_quoted": F.regexp_extract_all(text, F.lit(quoted), F.lit(0))})
    braced = F.locate("{", "_bare") > 0
    head = F.when(braced, F.substring_index("_bare", "{", 1)).otherwise(F.regexp_substr("_bare", F.lit("^[^ \t]+")))
    inner = F.when(braced, F.substring_index(F.substring_index("_bare", "}", 1), "{", -1)).otherwise("")
    tail = F.when(braced, F.substring_index("_bare", "}", -1)).otherwise(F.expr("substring(_bare, length(regexp_substr(_bare, '^[^ \\t]+')) + 1)"))
    rows = rows.withColumns({
        "name": F.trim(head), "_closed": ~braced | (F.locate("}", "_bare") > 0), "_tail": F.split(F.trim(tail), "[ \t]+"),
        "_labels": F.filter(F.transform(F.split(inner, ","), F.trim), lambda x: x != ""),
    })
    number = F.get("_tail", F.lit(0))
    rows = rows.withColumns({"value": number.try_cast("double"), "_time": F.get("_tail", F.lit(1)).try_cast("bigint")})
    whole = F.forall("_labels", lambda x: x.endswith('=""')) & (F.size("_labels") == F.size("_quoted"))
    good = c("name").rlike(_NAME) & c("_closed") & whole & c("value").isNotNull() & ~number.rlike("[dDfF]$") & (F.size("_tail") <= 2) & ((F.size("_tail") == 1) | c("_time").isNotNull())
    keys = F.transform("_labels", lambda x: F.trim(F.substring_index(x, "=", 1)))
    pairs = F.zip_with(keys, "_quoted", lambda k, q: F.struct(k.alias("key"), _unescaped(F.substring(q, F.lit(2), F.length(q) - 2)).alias("value")))
    rows = rows.where(good).withColumn("_pairs", pairs)
    # A repeated label keeps its last value.
    last = F.filter("_pairs", lambda e, at: ~F.exists(F.slice("_pairs", at + 2, F.size("_pairs")), lambda later: later.key == e.key))
    rest = [x for x in lines.columns if x != "line"]
    out = rows.select(*rest, "name", F.map_from_entries(last).alias("labels"), "value", F.timestamp_millis("_time").alias("sampled_at"))
    named = F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e.key, F.lit("="), e.value)))
    return out.withColumn("series", F.concat("name", F.lit("{"), F.array_join(named, ","), F.lit("}")))


def counter_deltas(samples: DataFrame, time: str = "scraped_at", bucket_seconds: int = 3600) -> DataFrame:
    """Growth since the previous scrape of a series: null at first sight, zero after a reset.

    Time is cut into buckets, so a series that holds most samples is many groups; a bucket's first sample looks at the last value of
    the bucket before it, found among one row per series and bucket.
    """
    rows = samples.withColumn("_bucket", F.floor(F.unix_micros(time) / (bucket_seconds * 1_000_000)))
    ends = rows.groupBy("series", "_bucket").agg(F.max_by("value", time).alias("_last"))
    earlier = ends.select("series", "_bucket", F.lag("_last").over(Window.partitionBy("series").orderBy("_bucket")).alias("_earlier"))
    joined = rows.join(earlier, ["series", "_bucket"])
    inside = F.lag("value").over(Window.partitionBy("series", "_bucket").orderBy(time))
    before = F.coalesce(inside, c("_earlier"))
    return joined.withColumn("delta", F.when(before.isNull(), None).when(c("value") < before, 0.0).otherwise(c("value") - before)).drop("_bucket", "_earlier")


def _any_word(text: Column, words: Sequence[str]) -> Column:
    return text.rlike("|".join(words))


# Words in series names and labels by which counters are judged.
INTENTIONAL_COUNTER, INTENTIONAL_PREFIX, INTENTIONAL_FILTER = "vector_component_discarded_events_total", "zeek_drop_", "zeek_filter"
GAUGE_WORDS, GAUGE_ENDS = ("latency", "duration", "utilization"), ("_bucket", "_sum")
COUNTER_WORDS, COUNTER_ENDS = ("events_total", "event_bytes_total"), ("_total", "_count")
PROBLEM_WORDS = {"vector": ("error", "discard", "drop", "failed", "failures"), "dataprepper": ("error", "fail", "drop", "reject", "dlq", "exception")}
PROBLEM_LABEL_WORDS = ("error", "failed", "failure")


def classify_series(samples: DataFrame, component: str = "vector") -> DataFrame:
    """``kind`` is intentional, error or other. Series of the collector are judged by their kind and labels too, others by name only."""
    name = F.lower("name")
    problem = _any_word(name, PROBLEM_WORDS[component])
    if component != "vector":
        return samples.withColumn("kind", F.when(problem, "error").otherwise("other"))
    label = lambda k: F.coalesce(F.lower(F.try_element_at(c("labels"), F.lit(k))), F.lit(""))
    ends = lambda options: reduce(lambda a, b: a | b, [name.endswith(e) for e in options])
    from_filter = (label("component_kind") == "transform") & (label("component_type") == "filter")
    named = label("component_id").startswith(INTENTIONAL_PREFIX) | (label("component_id") == INTENTIONAL_FILTER)
    intentional = (label("intentional") == "true") | ((name == INTENTIONAL_COUNTER) & from_filter & named)
    gauge = ends(GAUGE_ENDS) | _any_word(name, GAUGE_WORDS)
    counter = ends(COUNTER_ENDS) | _any_word(name, COUNTER_WORDS)
    labelled = _any_word(F.lower(F.array_join(F.map_values("labels"), " ")), PROBLEM_LABEL_WORDS)
    return samples.withColumn("kind", F.when(intentional, "intentional").when(~gauge & counter & (problem | labelled), "error").otherwise("other"))


def error_check(deltas: DataFrame, component: str = "vector") -> DataFrame:
    """Grown error counters; intentional drops do not count."""
    one = deltas.agg(
        F.coalesce(F.sum(F.when((c("kind") == "error") & (c("delta") > 0), c("delta"))), F.lit(0.0)).alias("bad"),
        F.coalesce(F.sum(F.when((c("kind") == "intentional") & (c("delta") > 0), c("delta"))), F.lit(0.0)).alias("ignored"))
    status = F.when(c("bad") == 0, "ok").when(c("bad") >= 10, "crit").otherwise("warn")
    text = F.when(c("bad") > 0, "Error counters grew.").when(c("ignored") > 0, "No real error growth; intentional drops ignored.").otherwise("No new errors.")
    return check_row(one, f"{component}.metrics", component, status, text, new_error_delta=c("bad"), ignored_intentional_delta=c("ignored"))


def name_has(*words: str) -> Column:
    """Series whose name has one of the words, in any case."""
    return _any_word(F.lower("name"), [w.lower() for w in words])


def label_has(label: str, word: str) -> Column:
    return F.coalesce(F.lower(F.try_element_at(c("labels"), F.lit(label))), F.lit("")).contains(word.lower())


def total_value(samples: DataFrame, which: Column) -> DataFrame:
    """Sum of the values of some series."""
    return samples.agg(F.coalesce(F.sum(F.when(which, c("value"))), F.lit(0.0)).alias("total"))


def largest_samples(samples: DataFrame, which: Column, limit: int = 10) -> DataFrame:
    """The samples of some series with the largest values in size."""
    return samples.where(which).orderBy(F.desc(F.abs("value")), "series").limit(limit)


# ---------------------------------------------------------------- roll-up

def score_column() -> Column:
    penalty = reduce(lambda a, b: a + b, [F.count_if(c("status") == s) * p for s, p in PENALTY.items()])
    return F.when(F.count("*") == 0, 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - penalty))).cast("int")


def worst_status() -> Column:
    rank = F.try_element_at(literal_map(RANK), c("status"))
    return F.coalesce(F.max_by("status", rank), F.lit("unknown"))


def component_summary(checks: DataFrame) -> DataFrame:
    """Per component and, in the row without a component, over all checks."""
    counts = [F.count_if(c("status") == s).alias(s) for s in ("ok", "warn", "crit", "unknown")]
    rolled = checks.rollup("component").agg(F.count("*").alias("total"), *counts, score_column().alias("score"), worst_status().alias("status"))
    label = F.coalesce(F.try_element_at(literal_map(COMPONENT_LABELS), F.coalesce("component", F.lit(""))), F.initcap(F.replace("component", F.lit("_"), F.lit(" "))))
    return rolled.withColumn("label", label)


def highlights(checks: DataFrame, limit: int = 6, order: Sequence[str] = ("seq", "id")) -> DataFrame:
    """The first critical summaries, or the first warnings when nothing is critical, in the order in which checks were made."""
    by = Window.partitionBy("status").orderBy(*order)
    top = checks.where(c("status").isin("crit", "warn")).withColumn("rank", F.row_number().over(by)).where(c("rank") <= limit)
    one = top.agg(*[F.transform(F.array_sort(F.collect_list(F.when(c("status") == s, F.struct("rank", "summary")))), lambda x: x.summary).alias(s)
                    for s in ("crit", "warn")])
    healthy = F.array(F.lit("All configured NDR validator checks are healthy."))
    return one.select(F.when(F.size("crit") > 0, c("crit")).when(F.size("warn") > 0, c("warn")).otherwise(healthy).alias("highlights"))


def append_scan(history: DataFrame, scan: DataFrame, keep: int = 500) -> DataFrame:
    """Scan history with the newest ``keep`` scans; a repeated scan id is replaced."""
    rest = history.join(scan.select("scan_id"), "scan_id", "left_anti")
    return rest.unionByName(scan).orderBy(F.desc("generated_at"), F.desc("scan_id")).limit(keep)
