"""Streams that take late ticks in: moves in event-time order (R8), hours revised by whatever arrives.

* ``moves_in_order``: ticks wait in state until the watermark has passed them
  and are then compared in event-time order, so a tick that comes late, but
  within the watermark's delay, gets its true neighbours.  An event-time timer per
  instrument wakes the state; what is kept is the last compared tick and the
  ticks of one delay.
* ``revise_hours``: each micro-batch of a stored fact table tells which hours
  of which instruments it touches; those are computed anew from the facts and
  merged into the stored mart by key, however late the ticks are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickflow import dims
from tickflow.functions.timeutil import trunc
from tickflow.operators import marts
from tickflow.plans import sinks
from tickflow.session import ship_package

_PAIRS = "commodity string, symbol string, prev_us long, us long, price double, prev_price double"
_TICK = "us long, event_id string, price double"
_BATCH = pa.schema([("us", pa.int64()), ("event_id", pa.string()), ("price", pa.float64())])
_GAP_US = dims.MOVE_GAP_MINUTES * 60 * 1_000_000
_SLICE_US = 6 * _GAP_US


def in_slices(ticks: DataFrame) -> DataFrame:
    """Each tick under the ``slice`` (its start, in us) it lies in; one of a slice's last ``MOVE_GAP_MINUTES``
    also under the next slice, whose first tick it may precede."""
    start = lambda us: us - F.pmod(us, F.lit(_SLICE_US))
    us = F.col("us")
    return ticks.withColumn("slice", F.explode(F.array_distinct(F.array(start(us), start(us + F.lit(_GAP_US))))))


def _pack(ticks: pd.DataFrame) -> tuple[bytes]:
    """Ticks as one list entry of the state."""
    return (pa.RecordBatch.from_pandas(ticks, _BATCH, preserve_index=False).serialize().to_pybytes(),)


class _InOrder(StatefulProcessor):
    """Emits each tick of a slice with the one before it, once the watermark has passed both."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _TICK)
        self.waiting = handle.getListState("waiting", "ticks binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for ticks in rows:
            if len(ticks):
                self.waiting.appendValue(_pack(ticks[_BATCH.names]))
                self.handle.registerTimer(int(ticks["us"].min()) // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        commodity, symbol, start = key
        passed_us, end_us = timerValues.getCurrentWatermarkInMs() * 1000, int(start) + _SLICE_US
        batches = [pa.ipc.read_record_batch(pa.py_buffer(ticks), _BATCH) for ticks, in self.waiting.get()]
        waiting = pa.Table.from_batches(batches, _BATCH).to_pandas().sort_values(_BATCH.names, ignore_index=True)
        n = int((waiting["us"] <= passed_us).sum())
        ticks, later = waiting[:n], waiting[n:]
        if n and len(later):
            self.waiting.put([_pack(later)])
        elif n:
            self.waiting.clear()
        if n and self.last.exists():
            ticks = pd.concat([pd.DataFrame([tuple(self.last.get())], columns=_BATCH.names), ticks], ignore_index=True)
        if len(later):
            self.handle.registerTimer(int(later["us"].iloc[0]) // 1000 + 1)
        elif passed_us >= end_us:
            self.last.clear()
        else:
            self.handle.registerTimer(end_us // 1000)
        if not n:
            return iter([])
        if len(later) or passed_us < end_us:
            us, event_id, price = ticks.iloc[-1]
            self.last.update((int(us), event_id, float(price)))
        before = ticks.shift(1)
        found = (ticks["us"] >= int(start)) & (ticks["us"] - before["us"] < _GAP_US)
        if not found.any():
            return iter([])
        return iter([pd.DataFrame({"commodity": commodity, "symbol": symbol, "prev_us": before["us"][found].astype("int64"), "us": ticks["us"][found],
                                   "price": ticks["price"][found], "prev_price": before["price"][found]})])

    def close(self) -> None:
        pass


def moves_in_order(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Streaming W1 with late ticks: the moves between consecutive ticks, for ticks up to ``delay`` late.

    A move is emitted once the watermark has passed its tick.  The state holds the ticks of one
    delay, per instrument and slice of time; a trigger reads those of the slices it wakes.  Only ticks less than
    ``MOVE_GAP_MINUTES`` apart make a move, so a slice needs no more of the one before than its end; one without a time makes none.
    """
    ship_package(stream.sparkSession)
    ticks = stream.select("commodity", "symbol", F.col("event_ts").cast("timestamp").alias("event_ts"), "event_id", "price")
    ticks = in_slices(ticks.withColumn("us", F.unix_micros("event_ts")).filter(F.col("us").isNotNull())).withWatermark("event_ts", delay)
    pairs = ticks.groupBy("commodity", "symbol", "slice").transformWithStateInPandas(_InOrder(), _PAIRS, "Append", "EventTime")
    at = {c: F.timestamp_micros(F.col(u)).cast("timestamp_ntz").alias(c) for c, u in (("event_ts", "us"), ("prev_event_ts", "prev_us"))}
    return marts.moves_between(pairs.select("commodity", "symbol", *at.values(), "price", "prev_price"))


HOUR_KEY = ["commodity", "symbol", "hour_bucket"]


def revise_hours(spark: SparkSession, facts: DataFrame, touched: DataFrame, mart_path: str, as_of) -> None:
    """Computes the hours of ``touched`` (ticks) anew from ``facts`` and merges them into the stored mart.

    ``facts`` is read at the hours' own dates only, where it is partitioned by ``event_date``
    (the join prunes them while it runs).  Doing it twice gives the same table.
    """
    hours = touched.select("commodity", "symbol", trunc("hour", "event_ts").alias("hour_bucket"), F.to_date("event_ts").alias("event_date")).distinct()
    dated = facts if "event_date" in facts.columns else facts.withColumn("event_date", F.to_date("event_ts"))
    mine = dated.withColumn("hour_bucket", trunc("hour", "event_ts")).join(hours, [*HOUR_KEY, "event_date"], "left_semi")
    fresh = marts.price_volatility_1h(mine, as_of).withColumn("bucket_date", F.to_date("hour_bucket"))
    if sinks.path_exists(spark, mart_path):
        sinks.upsert(spark, fresh, mart_path, HOUR_KEY, "bucket_date")
    else:
        sinks.write_mart(fresh, mart_path, "bucket_date")


def start_hours(spark: SparkSession, fact_path: str, mart_path: str, checkpoint: str, as_of=None, max_files: int | None = None,
                available_now: bool = False, trigger_seconds: int = 300):
    """Follows a fact table and keeps the hourly mart right, late ticks included; hours complete as of ``as_of`` (now unless given)."""
    schema = spark.read.parquet(fact_path).schema
    stream = spark.readStream.schema(schema).options(**({} if max_files is None else {"maxFilesPerTrigger": max_files})).parquet(fact_path)

    def revise(rows: DataFrame, _) -> None:
        now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
        revise_hours(spark, spark.read.parquet(fact_path), rows, mart_path, now)

    w = stream.writeStream.queryName("hourly_mart").foreachBatch(revise).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
