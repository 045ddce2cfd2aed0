"""FX-weekend calendar (P6, P7, U2) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import dims

OPEN_LABEL = "● OPEN"
CLOSED_LABEL = "● CLOSED"


def _c(ts) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def fx_closed(ts) -> Column:
    """True from Friday 22:00:00 UTC (inclusive) until Sunday 22:00:00 UTC (exclusive)."""
    t = _c(ts)
    dow = F.weekday(t)          # Monday = 0 ... Sunday = 6
    hr = F.hour(t)
    return ((dow == 4) & (hr >= 22)) | (dow == 5) | ((dow == 6) & (hr < 22))


def should_publish(symbol, ts) -> Column:
    """Gated FX symbols publish only while the FX market is open; others always."""
    s = _c(symbol)
    return ~(s.isin(*dims.FX_GATED_SYMBOLS) & fx_closed(ts))


def _instrument_rows(instant_col: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(c).alias("commodity"), F.lit(s).alias("symbol"))
                               for c, s in dims.INSTRUMENTS])).alias("inst")


def market_status(instants: DataFrame, instant_col: str = "instant") -> DataFrame:
    """OPEN/CLOSED label per instrument at each instant.

    The instrument list is a fixed configuration (3 rows), expanded per row
    with ``explode`` rather than a join.
    """
    x = instants.select(F.col(instant_col).alias("instant"), _instrument_rows(instant_col))
    return x.select("instant", F.col("inst.symbol").alias("instrument"),
                    F.when(should_publish(F.col("inst.symbol"), F.col("instant")), OPEN_LABEL)
                    .otherwise(CLOSED_LABEL).alias("status"))


def active_symbols(instants: DataFrame, instant_col: str = "instant") -> DataFrame:
    """Instruments that would be fetched/published at each instant."""
    x = instants.select(F.col(instant_col).alias("instant"), _instrument_rows(instant_col))
    return (x.filter(should_publish(F.col("inst.symbol"), F.col("instant")))
            .select("instant", F.col("inst.commodity").alias("commodity"),
                    F.col("inst.symbol").alias("symbol")))
