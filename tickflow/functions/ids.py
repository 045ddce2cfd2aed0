"""Deterministic event ids (E1): RFC 4122 UUID version 5 as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickflow.functions.timeutil import ISO_SECONDS

# Fixed value: the RFC 4122 DNS namespace UUID.
NAMESPACE_DNS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


def uuid5(name: Column, namespace: str = NAMESPACE_DNS) -> Column:
    """UUID5(namespace, name) as a lowercase 8-4-4-4-12 string.

    SHA-1 over namespace bytes + UTF-8 name; version nibble set to 5 and the
    variant bits to 10xx, all with built-in functions (no Python UDF).
    """
    ns_hex = namespace.replace("-", "")
    h = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
                            .bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def iso_seconds(ts) -> Column:
    """Whole-second UTC ISO-8601 text, e.g. 2026-03-14T12:00:00Z."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(F.date_trunc("second", c), ISO_SECONDS)


def event_id(commodity, ts) -> Column:
    """The producer's deterministic id: uuid5(DNS, '<commodity>:<iso ts>')."""
    c = F.col(commodity) if isinstance(commodity, str) else commodity
    return uuid5(F.concat(c, F.lit(":"), iso_seconds(ts)))
