"""Column helpers for messy scalar values: blanks, casts, timestamps, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.settings import TRUTHY_WORDS

NEVER_US = 9223372036854775807  # sorts after every real event time


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def first_present(*cols: Column) -> Column:
    """First string that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def first_present_list(*cols: Column) -> Column:
    """First array that is neither null nor empty."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in cols])


def as_list(col: Column, element: str = "string") -> Column:
    """Scalar to one-element array; null or blank to the empty array."""
    empty = F.array().cast(f"array<{element}>")
    return F.when(col.isNull() | (col.cast("string") == ""), empty).otherwise(F.array(col.cast(element)))


def unique_values(arr: Column) -> Column:
    """Order-preserving distinct without nulls and empty strings."""
    return F.array_distinct(F.filter(arr, lambda x: x.isNotNull() & (x.cast("string") != "")))


def safe_int_strict(text: Column) -> Column:
    """Integer text only: "5" -> 5, "5.0" -> null.  Use a plain cast for numeric input."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed).try_cast("bigint")


def safe_int_lenient(text: Column, default: int | None = 0) -> Column:
    """Integer text, else truncated decimal text, else the default."""
    as_double = F.trim(text).try_cast("double")
    whole = F.when(F.abs(as_double) < F.lit(9.2e18), as_double).try_cast("bigint")
    value = F.coalesce(safe_int_strict(text), whole)
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def safe_float(text: Column, default: float | None = None) -> Column:
    value = F.trim(text).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def safe_bool(text: Column) -> Column:
    """Truthy words in any case; null and everything else is false."""
    return F.coalesce(F.lower(F.trim(text)).isin(*TRUTHY_WORDS), F.lit(False))


def epoch_seconds_to_ts(seconds: Column) -> Column:
    return F.timestamp_micros((seconds * F.lit(1000000)).cast("bigint"))


def parse_ts(text: Column) -> Column:
    """ISO-8601 text (Z, offset or naive = UTC) or epoch-second text; anything else is null."""
    t = F.trim(text)
    iso = t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
    number = t.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?$")
    seconds = F.when(number, t).try_cast("double")
    seconds = F.when(F.abs(seconds) < F.lit(2.5e11), seconds)
    return F.coalesce(F.when(iso, t).try_cast("timestamp"), epoch_seconds_to_ts(seconds))


def iso_millis(ts: Column) -> Column:
    """UTC text with milliseconds and a trailing Z (session time zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def floor_time(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned interval that holds ``ts``."""
    s = F.unix_seconds(ts)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds)))


# Names that are safe as they are; looked up, which is cheaper than the pattern for every event of every scan.
SAFE_LOG_TYPES = ("conn", "dns", "http", "ssl", "tls", "quic", "x509", "notice", "weird", "analyzer", "files", "ssh", "ftp", "smtp", "smb_files",
                   "smb_mapping", "ntlm", "dce_rpc", "ldap", "ldap_search", "dhcp", "irc")


def safe_log_type(text: Column) -> Column:
    name = F.coalesce(blank_to_null(F.lower(F.trim(text))), F.lit("unknown"))
    return F.when(text.isin(*SAFE_LOG_TYPES), text).otherwise(F.regexp_replace(name, "[^A-Za-z0-9_-]", "_"))


def synthetic_session_id(*parts: Column) -> Column:
    joined = F.concat_ws("|", *[blank_to_null(p.cast("string")) for p in parts])
    return F.concat(F.lit("synthetic:"), F.substring(F.sha2(joined, 256), 1, 32))


def joined_id(feature_set: str, sensor: Column, entity: Column, window_start: Column) -> Column:
    """Readable window id; beyond 512 characters the middle is replaced by a hash."""
    readable = F.concat_ws("|", F.lit(feature_set), blank_to_null(sensor), entity, window_start)
    hashed = F.concat_ws("|", F.lit(feature_set), F.substring(F.sha2(readable, 256), 1, 24), window_start)
    return F.when(F.length(readable) > 512, hashed).otherwise(readable)


def ns_to_ts(ns: Column) -> Column:
    """Epoch nanoseconds; zero, negative and null become null."""
    return F.when(ns > 0, F.timestamp_micros(_div(ns, 1000)))


def _div(col: Column, by: int) -> Column:
    return F.call_function("div", col.cast("bigint"), F.lit(by).cast("bigint"))


def event_order(ts: Column, raw_id: Column) -> Column:
    """Total order of events inside a session: time (missing last), then id."""
    return F.struct(F.coalesce(F.unix_micros(ts), F.lit(NEVER_US)).alias("us"), raw_id.alias("id"))


def age_seconds(ts: Column, as_of: Column) -> Column:
    return F.greatest(F.lit(0.0), (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(1000000.0))


def seconds_to_human(seconds: Column) -> Column:
    s = F.floor(seconds).cast("bigint")
    m, h, d = _div(s, 60), _div(s, 3600), _div(s, 86400)
    return (
        F.when(s.isNull(), F.lit("unknown"))
        .when(s < 60, F.format_string("%ds", s))
        .when(m < 60, F.format_string("%dm %ds", m, s % 60))
        .when(h < 48, F.format_string("%dh %dm", h, m % 60))
        .otherwise(F.format_string("%dd %dh", d, h % 24))
    )


def empty_struct_to_null(struct_col: Column, fields: list[str]) -> Column:
    """Null out a struct whose named fields are all null."""
    keep = F.lit(False)
    for f in fields:
        keep = keep | struct_col.getField(f).isNotNull()
    return F.when(keep, struct_col)


def packed(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with these columns as the one column ``_kept``, and their names.

    Steps that each add columns to a wide row write all of it anew; a struct is copied as a whole.
    """
    return df.select(*[n for n in df.columns if n not in names], F.struct(*names).alias("_kept")), names


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    """Undo :func:`packed`; the columns come last."""
    return df.select(*[n for n in df.columns if n != "_kept"], *[F.col("_kept").getField(n).alias(n) for n in names])
