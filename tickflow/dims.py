"""Reference data: instruments, price bounds, move and jump thresholds.

These are small, fixed-size dimension tables (a handful of rows each), so
broadcasting them is always safe: their size is bounded by configuration,
not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the original pipeline's for identical results.
# ---------------------------------------------------------------------------
# Instruments: (commodity, symbol)
INSTRUMENTS = [
    ("gold", "XAU/USD"),
    ("bitcoin", "BTC/USD"),
    ("eurusd", "EUR/USD"),
]
# Inclusive price bounds per symbol: (low, high)
PRICE_BOUNDS = {
    "XAU/USD": (500.0, 15000.0),
    "BTC/USD": (100.0, 1000000.0),
    "EUR/USD": (0.5, 2.0),
}
# Move-classification thresholds on |pct change| (>=): (extreme, large, medium)
MOVE_THRESHOLDS = {
    "BTC/USD": (0.015, 0.007, 0.003),
    "XAU/USD": (0.006, 0.003, 0.0015),
    "EUR/USD": (0.0025, 0.0012, 0.0006),
}
# Minute-to-minute jump limits on |pct change| (strictly >)
JUMP_LIMITS = {
    "EUR/USD": 0.05,
    "XAU/USD": 0.10,
    "BTC/USD": 0.30,
}
# Symbols whose market closes for the FX weekend (Fri 22:00 to Sun 22:00 UTC)
FX_GATED_SYMBOLS = ["EUR/USD", "XAU/USD"]
SUPPORTED_SCHEMA_VERSION = 1
# Move class labels
EXTREME, LARGE, MEDIUM, NORMAL = "EXTREME_MOVE", "LARGE_MOVE", "MEDIUM_MOVE", "NORMAL"
# Gap guard for move detection: consecutive ticks must be closer than this
MOVE_GAP_MINUTES = 30
# ---------------------------------------------------------------------------


def instruments_df(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(INSTRUMENTS, "commodity string, symbol string"))


def bounds_df(spark: SparkSession) -> DataFrame:
    rows = [(s, lo, hi) for s, (lo, hi) in PRICE_BOUNDS.items()]
    return F.broadcast(spark.createDataFrame(rows, "symbol string, lo double, hi double"))


def thresholds_df(spark: SparkSession) -> DataFrame:
    rows = [(s, e, l, m) for s, (e, l, m) in MOVE_THRESHOLDS.items()]
    return F.broadcast(spark.createDataFrame(
        rows, "symbol string, extreme double, large double, medium double"))
