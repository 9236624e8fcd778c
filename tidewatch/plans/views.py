"""The tables the queries start from, derived from the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.operators.behaviors import build_behaviors
from tidewatch.operators.flows import normalize_flows, parse_flow_lines
from tidewatch.operators.hardening import harden_sessions
from tidewatch.operators.sessions import build_sessions
from tidewatch.schemas import conform_raw
from tidewatch.sources.adapters import SUBNETS, flow_lines, log_lines, logged_columns, raw_columns, raw_logs, sliced_events
from tidewatch.sources.logs import parse_json
from tidewatch.session import ensure_checkpoint_dir


def epoch() -> Column:
    """Fixed processing time, so that results do not depend on the clock."""
    return F.timestamp_seconds(F.lit(1704067200))


ALL = ("certificates", "facts")


def sessions(spark: SparkSession, sf_dir: str, *names: str, parts=("certificates",)) -> DataFrame:
    return build_sessions(raw_logs(spark, sf_dir), sections=names, parts=parts, updated_at=epoch())


def hardened(spark: SparkSession, sf_dir: str, *names: str, parts=ALL) -> DataFrame:
    return harden_sessions(sessions(spark, sf_dir, *names, parts=parts), SUBNETS)


BEHAVIOR_SECTIONS = ("conn", "dns", "http", "files", "tls", "x509", "ssh", "notice", "weird")


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, kind: str, build) -> DataFrame:
    """A table that an earlier job of the pipeline writes, built once per application.

    It lives in the shared checkpoint folder, so it survives the loss of executors and later
    queries start from a scan, as the rule, behaviour and health jobs do in operation.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _STORED:
        path = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built from the stored raw logs: they are read once per part of a session, and a scan is cheaper to plan and run than the view."""
    def build() -> DataFrame:
        rows = build_sessions(raw_table(spark, sf_dir), sections=BEHAVIOR_SECTIONS, parts=ALL, updated_at=epoch())
        return harden_sessions(rows, SUBNETS)
    return stored(spark, sf_dir, "sessions", build)


def behavior_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "behaviors", lambda: build_behaviors(session_table(spark, sf_dir), updated_at=epoch()))


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that the logs do not have are not stored; they are nulls that plans can fold."""
    return conform_raw(stored(spark, sf_dir, "raw", lambda: logged_columns(spark, sf_dir)))


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in slices, for jobs that read some of them several times and need no raw table."""
    return stored(spark, sf_dir, "events", lambda: sliced_events(spark, sf_dir))


def certificate_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The certificate rows of the raw table alone."""
    def build() -> DataFrame:
        return raw_columns(event_table(spark, sf_dir)).where("log_type = 'x509'")
    return stored(spark, sf_dir, "x509", build)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_flows(parse_flow_lines(flow_lines(spark, sf_dir)), now=epoch(), keep_raw=False)


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_json(log_lines(spark, sf_dir))


def joined(items: Column) -> Column:
    """Array as text, for comparison; null and empty are both null."""
    return F.nullif(F.array_join(items.cast("array<string>"), "|"), F.lit(""))


def us(ts: str) -> Column:
    return F.unix_micros(ts)
