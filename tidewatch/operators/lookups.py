"""Investigation look-ups over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

c = F.col


def by_uid(sessions: DataFrame, uid: Column) -> DataFrame:
    return sessions.where(c("uid") == uid)


def by_community_id(sessions: DataFrame, community_id: Column) -> DataFrame:
    return sessions.where(c("community_id") == community_id)


def with_notice(sessions: DataFrame) -> DataFrame:
    return sessions.where("has_notice")


def tls_with_validation(sessions: DataFrame) -> DataFrame:
    return sessions.where(c("has_tls") & c("tls.validation_status").isNotNull())


def long_dns(sessions: DataFrame, length: int = 80) -> DataFrame:
    return sessions.where(c("dns.query_length") >= length)


def sessions_by_ids(sessions: DataFrame, ids: DataFrame) -> DataFrame:
    return sessions.join(ids.select("session_id"), "session_id", "left_semi")


def behavior_by_id(behaviors: DataFrame, behavior_id: Column) -> DataFrame:
    return behaviors.where(c("behavior_id") == behavior_id)


def raw_of_connection(raw: DataFrame, uid: Column | None = None, community_id: Column | None = None) -> DataFrame:
    hit = c("uid") == uid if uid is not None else c("community_id") == community_id
    return raw.where(hit).orderBy("ts", "raw_id")


def newest(df: DataFrame, n: int, columns: list, ts: str = "ts", tie: str | None = None) -> DataFrame:
    """Latest rows with a column list: sort and limit stay one top-k operator."""
    order = [F.desc(ts)] + ([F.asc(tie)] if tie else [])
    return df.orderBy(*order).limit(n).select(*columns)
