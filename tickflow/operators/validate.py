"""Event validation.

The whole chain is one CASE expression evaluated inside whole-stage codegen;
price bounds come from the fixed ``dims.PRICE_BOUNDS`` (literals), or from a
broadcast bounds table with ``with_error_reason_join`` when they are data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import dims

# ---------------------------------------------------------------------------
# Error reasons written to the DLQ (must match the original).
# ---------------------------------------------------------------------------
ERR_PARSE = "JSON_PARSE_ERROR_OR_EMPTY"
ERR_MISSING = "MISSING_FIELD:"          # + field name
ERR_BAD_TS = "INVALID_FIELD:event_ts"
ERR_NON_POSITIVE = "INVALID_FIELD:price<=0"
ERR_VERSION = "UNSUPPORTED_SCHEMA_VERSION"
ERR_RANGE = "INVALID_FIELD:price_out_of_range"
# Required fields, in the order they are checked
REQUIRED_FIELDS = ["event_id", "commodity", "symbol", "price", "currency", "source"]
# ---------------------------------------------------------------------------

GOOD_COLUMNS = ["event_id", "commodity", "symbol", "price", "currency", "event_ts", "source",
                "ingest_ts", "kafka_partition", "kafka_offset", "schema_version",
                "ingest_interval_sec"]


def within_bounds(symbol, price) -> Column:
    """Inclusive bounds check; symbols without bounds pass (P5)."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    p = F.col(price) if isinstance(price, str) else price
    expr = None
    for sym, (lo, hi) in dims.PRICE_BOUNDS.items():
        cond = s == sym
        val = p.between(lo, hi)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return F.coalesce(expr.otherwise(F.lit(True)), F.lit(True))


def _chain(out_of_range: Column) -> Column:
    c = F.col
    expr = F.when(c("event_id").isNull() & c("commodity").isNull() & c("symbol").isNull()
                  & c("price").isNull(), ERR_PARSE)
    for f in REQUIRED_FIELDS:
        expr = expr.when(c(f).isNull(), ERR_MISSING + f)
    return (expr.when(c("event_ts").isNull(), ERR_BAD_TS)
            .when(c("price") <= 0, ERR_NON_POSITIVE)
            .when(~c("schema_version").eqNullSafe(F.lit(dims.SUPPORTED_SCHEMA_VERSION)), ERR_VERSION)
            .when(out_of_range, ERR_RANGE))


def error_reason() -> Column:
    """First failing rule, or NULL for a valid event."""
    return _chain(~within_bounds("symbol", "price"))


def with_error_reason(df: DataFrame) -> DataFrame:
    return df.withColumn("error_reason", error_reason())


def with_error_reason_join(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Same chain with bounds from a small (broadcast) table."""
    j = df.join(F.broadcast(bounds.select("symbol", "lo", "hi")), "symbol", "left")
    oor = F.coalesce(~F.col("price").between(F.col("lo"), F.col("hi")), F.lit(False))
    return j.withColumn("error_reason", _chain(oor)).drop("lo", "hi")


def split(df: DataFrame, stream_instance_id: str, batch_id) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good rows in fact-table shape, bad rows in DLQ shape."""
    good = df.filter(F.col("error_reason").isNull()).select(
        *[c for c in GOOD_COLUMNS if c in df.columns])
    bid = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    bad = df.filter(F.col("error_reason").isNotNull()).select(
        F.lit(stream_instance_id).alias("stream_instance_id"),
        bid.cast("bigint").alias("batch_id"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").cast("int").alias("kafka_partition"),
        F.col("kafka_offset").cast("bigint").alias("kafka_offset"),
        "error_reason", "raw_payload",
        *([F.col("kafka_timestamp").alias("ts_utc")] if "kafka_timestamp" in df.columns else []),
    )
    return good, bad


def batch_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """good/bad counts in one pass; zero (not NULL) on empty input (A1)."""
    aggs = [F.count_if(F.col("error_reason").isNull()).alias("good_rows"),
            F.count_if(F.col("error_reason").isNotNull()).alias("bad_rows")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
