"""Dashboard panel queries (D1, D3, D4, D5; D2 is ``calendar.market_status``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.numeric import dround
from tickflow.functions.timeutil import scalar, ts_lit


def _price_text(symbol: Column, price: Column) -> Column:
    """4 decimals for EUR/USD, 2 otherwise (rounded first, then printed)."""
    return F.when(symbol == "EUR/USD", F.format_string("%.4f", dround(price, 4))) \
        .otherwise(F.format_string("%.2f", dround(price, 2)))


def last_update(raw: DataFrame, commodity: str = "bitcoin") -> DataFrame:
    """'As of HH:mm UTC dd/MM/yyyy' of the newest row of one commodity.

    ``orderBy(...).limit(1)`` plans as TakeOrderedAndProject: each task keeps
    its own top row, so only one row per task reaches the final merge.
    """
    top = (raw.filter(F.col("commodity") == commodity)
           .orderBy(F.desc("event_ts"), F.desc("event_id")).limit(1))
    return top.select(F.concat(F.lit("As of "), F.date_format("event_ts", "HH:mm"), F.lit(" UTC "),
                               F.date_format("event_ts", "dd/MM/yyyy")).alias("last_update"))


def moves(events: DataFrame, hour_start) -> DataFrame:
    """Largest |change %| and event count per symbol within one hour."""
    lo = ts_lit(hour_start)
    return (events.filter((F.col("event_ts") >= lo) & (F.col("event_ts") < lo + F.expr("INTERVAL 1 HOUR")))
            .groupBy("symbol").agg(F.max(F.abs("price_change_pct")).alias("largest_move"),
                                   F.count(F.lit(1)).alias("events")))


def price_statistics(vol: DataFrame, events: DataFrame) -> DataFrame:
    """Latest completed hour per instrument with its largest move (D3).

    The latest hour is a one-row aggregate turned into a literal, so both the
    volatility and the events scans are pruned to that hour.
    """
    h = scalar(vol, F.max("hour_bucket"))
    v = vol.filter(F.col("hour_bucket") == ts_lit(h)) if h is not None else vol.limit(0)
    m = moves(events, h) if h is not None else moves(events.limit(0), "1970-01-01 00:00:00")
    # both sides are per-instrument aggregates of one hour; AQE turns the join
    # into a broadcast from their measured sizes
    j = v.join(m, "symbol", "left")
    return j.select(
        F.col("symbol").alias("instrument"),
        _price_text(F.col("symbol"), F.col("avg_price")).alias("avg_price"),
        dround("price_range", 4).alias("price_range"),
        dround("range_pct", 3).alias("range_pct"),
        dround("price_stddev", 4).alias("stddev"),
        dround(F.coalesce(F.col("largest_move"), F.lit(0.0)), 3).alias("largest_move"),
        F.coalesce(F.col("events"), F.lit(0)).cast("bigint").alias("events"),
        F.col("observations_count").alias("observations"),
    ).orderBy(F.desc("range_pct"), "instrument")


def hourly_change(vol: DataFrame, lo, hi) -> DataFrame:
    """range_pct per instrument and hour inside a time range."""
    return (vol.filter(F.col("hour_bucket").between(ts_lit(lo), ts_lit(hi)))
            .select(F.col("hour_bucket").alias("time"), dround("range_pct", 2).alias("range"),
                    F.col("symbol").alias("metric"))
            .orderBy("time", "range", "metric"))


def recent_events(events: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` price events, formatted."""
    top = events.orderBy(F.desc("event_ts"), "symbol").limit(n)
    s = F.col("symbol")
    return top.select(
        F.date_format("event_ts", "yyyy-MMM-dd").alias("date"),
        F.date_format("event_ts", "HH:mm:ss").alias("time"),
        s.alias("instrument"),
        F.col("event_type").alias("event"),
        dround("price_change_pct", 2).alias("change"),
        _price_text(s, F.col("prev_price")).alias("prev_price"),
        _price_text(s, F.col("current_price")).alias("current_price"),
    )


def newest(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows by the given columns, descending.

    Top-k with ``limit``: each task keeps its own ``n`` rows, the final merge
    sees ``n x tasks`` rows at most.
    """
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)
