"""Time helpers.  All timestamps are UTC wall-clock ``timestamp_ntz``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def ts_lit(value) -> Column:
    """A timestamp_ntz literal from a datetime, ISO string or Column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def trunc(unit: str, ts) -> Column:
    """``date_trunc`` that keeps the ``timestamp_ntz`` type."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def minus(ts, expr: str) -> Column:
    """``ts - INTERVAL expr`` (e.g. ``minus(as_of, '24 hours')``)."""
    return ts_lit(ts) - F.expr(f"INTERVAL {expr}")


def seconds_between(later, earlier) -> Column:
    """Signed seconds between two timestamps, as double (microsecond exact)."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / F.lit(1e6)


def round_seconds(later, earlier) -> Column:
    """Whole seconds between two instants, rounded (as SQL numeric::integer)."""
    return F.round(seconds_between(later, earlier)).cast("int")


def scalar(df: DataFrame, expr: Column):
    """Evaluate a one-row global aggregate and return the Python value.

    Used only for bounds (max bucket, as_of) that become literals so that the
    following scan can prune partitions; the aggregate itself is distributed.
    """
    return df.agg(expr.alias("v")).collect()[0]["v"]


def default_as_of(ticks: DataFrame) -> dt.datetime:
    """Deterministic stand-in for now(): the newest ingest time in the table."""
    return scalar(ticks, F.max("ingest_ts"))
