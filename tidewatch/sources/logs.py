"""Log-file source: tailed JSON lines to the typed raw-log table, with a dead-letter branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.protocols import get_field, get_list
from tidewatch.functions.values import safe_log_type
from tidewatch.schemas import RAW_COLUMNS, RAW_FIELDS
from tidewatch.settings import SKIPPED_LOG_FILES, TAILED_LOG_TYPES

LINE_SCHEMA = "value string, file string, file_offset bigint"


def tailed_file(path: Column) -> Column:
    """True for the files on the include list and not on the exclude list."""
    name = F.element_at(F.split(path, "/"), -1)
    included = name.isin(*[f"{t}.log" for t in TAILED_LOG_TYPES])
    skipped = name.rlike("^(" + "|".join(f"{p}.*" if p == "conn-summary" else p for p in SKIPPED_LOG_FILES) + r")\.log$")
    return included & ~skipped


def read_lines(spark: SparkSession, directory: str, streaming: bool = False) -> DataFrame:
    """Lines of the tailed files with their path and block offset."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.format("text").option("pathGlobFilter", "*.log").option("recursiveFileLookup", "true").load(directory)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("file_offset")
    ).where(tailed_file(F.col("file")))


def parse_json(lines: DataFrame) -> DataFrame:
    """Attach the parsed document; a bad line keeps its text, a stage and a reason.

    A generator of one row parses each line once: neither later filters nor later columns repeat what is below it.
    """
    def judged(doc: Column) -> Column:
        ok = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
        return F.struct(F.when(ok, doc).alias("v"), (~ok).alias("parse_error"))

    rows = lines.select("*", F.inline(F.transform(F.array(F.try_parse_json("value")), judged)))
    bad = F.col("parse_error")
    return rows.select(
        "*", F.when(bad, F.lit("zeek_parse_json")).alias("parse_error_stage"),
        F.when(bad, F.when(F.trim("value") == "", "empty line").otherwise("not a JSON object")).alias("parse_error_reason"),
        F.when(bad, F.col("value")).alias("raw_message"),
    )


def valid_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("parse_error"))


def dead_letters(parsed: DataFrame) -> DataFrame:
    columns = ["raw_message", "parse_error_stage", "parse_error_reason", "file", "file_offset"]
    return parsed.where("parse_error").select(*columns)


def event_time(v: Column, now: Column) -> Column:
    """``ts`` seconds truncated to milliseconds, else ``@timestamp``, else the ingest time."""
    seconds = F.try_variant_get(v, "$.ts", "double")
    from_ts = F.timestamp_millis((seconds * F.lit(1000)).cast("bigint"))
    return F.coalesce(from_ts, F.try_variant_get(v, "$['@timestamp']", "timestamp"), now)


def log_type_from_path(path: Column) -> Column:
    """Base name, lower case, without extension and without a rotation stamp."""
    base = F.lower(F.element_at(F.split(path, "/"), -1))
    base = F.regexp_replace(base, r"\.(log|json)$", "")
    return F.regexp_replace(base, r"\.[0-9]{4}-[0-9]{2}-[0-9]{2}(-[0-9]{2}){3}$", "")


def _field(column: str, v: Column) -> Column:
    key, kind = RAW_FIELDS[column]
    if kind == "list":
        return get_list(v, key)
    if kind == "dlist":
        both = get_field(v, key, "variant")
        return F.when(both.isNotNull(), get_list(v, key, "double")).otherwise(get_list(v, key.lower(), "double"))
    if column.startswith("cert_") and key.startswith("certificate."):
        return F.try_variant_get(v, f"$['{key}']", kind)  # flat spelling only
    value = get_field(v, key, kind)
    if column in ("subject", "issuer", "serial", "key_type", "key_alg", "sig_alg", "key_length",
                  "not_valid_before", "not_valid_after"):
        value = F.coalesce(value, F.try_variant_get(v, f"$.certificate.{column}", kind))
    return value


def to_raw_logs(valid: DataFrame, sensor: str, ingest_time: Column | None = None) -> DataFrame:
    """Typed raw-log rows.  The row id is a digest of file and text, so a re-read line keeps its id."""
    now = F.current_timestamp() if ingest_time is None else ingest_time
    v = F.col("v")
    path_type = F.when(F.col("file") != "", log_type_from_path(F.col("file")))
    log_type = F.coalesce(path_type, get_field(v, "log_type"), F.lit("unknown"))
    head = {
        "raw_id": F.coalesce(get_field(v, "raw_id"), F.sha1(F.concat_ws("|", "file", "value"))),
        "raw_index": F.lit("zeek-logs"),
        "ts": event_time(v, now),
        "ingest_ts": now,
        "log_type": safe_log_type(log_type),
        "sensor": F.coalesce(get_field(v, "sensor"), F.lit(sensor)),
        "doc": F.col("value"),
    }
    return valid.select(*[
        (head[c] if c in head else _field(c, v)).cast(t).alias(c) for c, t in RAW_COLUMNS.items()
    ])


def read_raw_logs(spark: SparkSession, directory: str, sensor: str, streaming: bool = False) -> DataFrame:
    return to_raw_logs(valid_lines(parse_json(read_lines(spark, directory, streaming))), sensor)


def changed_rows(df: DataFrame, processed: str, event: str, start: Column, end: Column) -> DataFrame:
    """Rows processed in [start, end]; rows without a processing time count by event time."""
    return df.where(F.coalesce(F.col(processed), F.col(event)).between(start, end))
