"""Incremental mart builds with a late-data lookback.

``run`` reads ``max(bucket)`` of the stored mart (a one-row aggregate turned
into a literal so the source scan prunes partitions), recomputes the model
over ``source[bucket >= max - lookback]`` (or ``as_of - 7 days`` when the
mart is empty, or everything on the first build), and upserts the result by
key into the touched date partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.timeutil import minus, scalar
from tickflow.plans import sinks

EMPTY_FALLBACK = "7 days"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = sinks._fs(spark, path)
    return fs.exists(p)


def _newest_partition(spark: SparkSession, path: str, partition_col: str) -> str | None:
    """The newest ``partition_col=`` directory of a date-partitioned table
    (file listing only, no data scan)."""
    fs, root = sinks._fs(spark, path)
    names = [st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(root)
             if st.isDirectory() and st.getPath().getName().startswith(f"{partition_col}=")]
    return max(names) if names else None


def lower_bound(spark: SparkSession, target_path: str, bucket_col: str, lookback: str, as_of,
                partition_col: str = "bucket_date", empty_fallback: str | None = EMPTY_FALLBACK):
    """max(bucket) - lookback, or as_of - ``empty_fallback`` for an emptied mart
    (None: all of the source again), or None when the mart does not exist yet (full build).

    ``max(bucket)`` is read from the newest date partition only.
    """
    if not _exists(spark, target_path):
        return None
    newest = _newest_partition(spark, target_path, partition_col)
    m = None
    if newest is not None:
        m = scalar(sinks.read_mart(spark, target_path).filter(F.col(partition_col) == F.lit(newest)),
                   F.max(bucket_col))
    if m is None:
        return None if empty_fallback is None else scalar(spark.range(1), minus(as_of, empty_fallback))
    return scalar(spark.range(1), minus(m, lookback))


def run(spark: SparkSession, model: Callable[[DataFrame, object], DataFrame], source: DataFrame,
        target_path: str, keys: Sequence[str], bucket_col: str, lookback: str, as_of,
        partition_col: str = "bucket_date", replace_slice: bool = False,
        source_date_col: str = "event_date", empty_fallback: str | None = EMPTY_FALLBACK) -> dict:
    """One incremental (or first full) build of ``model`` into ``target_path``.

    ``replace_slice=True`` drops stored rows inside the recomputed range that
    the new slice no longer produces (e.g. an event reclassified as NORMAL by
    a late tick); the default keeps them, as a keyed merge does.
    """
    since = lower_bound(spark, target_path, bucket_col, lookback, as_of, partition_col, empty_fallback)
    if since is not None and source_date_col in source.columns:
        # the slice bound on event time, restated on the source's date partitions
        source = source.filter(F.col(source_date_col) >= F.to_date(F.lit(since).cast("timestamp_ntz")))
    new = model(source, since).withColumn(partition_col, F.to_date(bucket_col))
    if since is None:
        sinks.write_mart(new, target_path, partition_col)
    else:
        sinks.upsert(spark, new, target_path, keys, partition_col,
                     replace_from=(bucket_col, since) if replace_slice else None)
    return {"since": since}


# Model adapters: (source, since) -> mart slice.

def minute_model(stg: DataFrame, since) -> DataFrame:
    from tickflow.operators.marts import minute_last_price
    return minute_last_price(stg, since)


def events_model(stg: DataFrame, since) -> DataFrame:
    from tickflow.operators.marts import price_events
    return price_events(stg, since)


def volatility_model(as_of):
    def _m(stg: DataFrame, since) -> DataFrame:
        from tickflow.operators.marts import price_volatility_1h
        return price_volatility_1h(stg, as_of, since)
    return _m
