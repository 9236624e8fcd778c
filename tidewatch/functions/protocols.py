"""Service and transport names, DNS text measures, field access on VARIANT documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewatch import settings as S
from tidewatch.functions.values import blank_to_null, safe_int_strict


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def in_list_order(candidates, present: Column) -> Column:
    """First candidate contained in the array ``present``."""
    return F.get(F.filter(F.array(*[F.lit(c) for c in candidates]), lambda c: F.array_contains(present, c)), F.lit(0))


def service_tokens(text: Column) -> Column:
    """Comma-separated service text to distinct canonical tokens; null gives an empty array."""
    parts = F.filter(F.transform(F.split(F.lower(text), ","), lambda x: F.trim(x)), lambda x: x != "")
    canonical = F.transform(parts, lambda x: F.coalesce(F.try_element_at(literal_map(S.SERVICE_ALIASES), x), x))
    return F.coalesce(F.array_distinct(canonical), F.array().cast("array<string>"))


def canonical_protocol(tokens: Column) -> Column:
    return F.coalesce(in_list_order(S.PROTOCOL_PRIORITY, tokens), F.get(tokens, F.lit(0)))


def infer_service(log_types: Column, dst_port: Column) -> Column:
    by_type = in_list_order(S.INFER_LOG_TYPES, log_types)
    by_type = F.when(by_type == "ssl", F.lit("tls")).otherwise(by_type)
    return F.coalesce(by_type, F.try_element_at(literal_map(S.INFER_PORTS), dst_port.cast("int")))


def hardened_protocol(protocol: Column, log_types: Column, dst_port: Column, default: str) -> Column:
    order = F.lit(None).cast("string")
    for log_type, name in reversed(S.HARDEN_LOG_TYPES):
        order = F.when(F.array_contains(log_types, log_type), F.lit(name)).otherwise(order)
    by_port = F.try_element_at(literal_map(S.HARDEN_PORTS), dst_port.cast("int"))
    return F.coalesce(blank_to_null(protocol), order, by_port, F.lit(default))


def transport_name(proto: Column) -> Column:
    """Struct(transport, iana) from a protocol number or name given as text."""
    text = blank_to_null(F.lower(F.trim(proto)))
    names = {str(k): v for k, v in S.IP_PROTOCOLS.items()}
    numbers = {v: k for k, v in names.items()}
    number = safe_int_strict(text).cast("string")
    by_number = F.try_element_at(literal_map(names), number)
    by_name = F.try_element_at(literal_map(numbers), text)
    transport = F.coalesce(by_number, number, text)
    return F.struct(transport.alias("transport"), F.coalesce(number, by_name).alias("iana"))


def dns_labels(query: Column, strip_dots: bool = True) -> Column:
    return F.filter(F.split(F.trim(query, F.lit(".")) if strip_dots else query, r"\."), lambda x: x != "")


def longest(labels: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(labels, lambda x: F.length(x))), F.lit(0))


def get_field(doc: Column, path: str, kind: str = "string") -> Column:
    """Read ``a.b`` from a VARIANT: the flat key wins even when it is JSON null, else the nested path."""
    flat = f"$['{path}']"
    value = F.try_variant_get(doc, flat, kind)
    if "." not in path:
        return value
    nested = "$" + "".join(f"['{p}']" for p in path.split("."))
    has_flat = F.try_variant_get(doc, flat, "variant").isNotNull()
    return F.when(has_flat, value).otherwise(F.try_variant_get(doc, nested, kind))


def get_list(doc: Column, path: str, element: str = "string") -> Column:
    """Array field, with a scalar wrapped into one element and blank or missing giving an empty array."""
    scalar = get_field(doc, path, element)
    empty = F.array().cast(f"array<{element}>")
    wrapped = F.when(scalar.isNull() | (scalar.cast("string") == ""), empty).otherwise(F.array(scalar))
    return F.coalesce(get_field(doc, path, f"array<{element}>"), wrapped)
