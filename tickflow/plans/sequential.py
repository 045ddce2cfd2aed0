"""Ordered per-key scans (lag, running max) that do not put a whole key in one task.

A plain ``Window.partitionBy(symbol).orderBy(ts)`` sends every row of a symbol
to one task; with a handful of instruments, one of which may carry a third of
all rows, that is a straggler that grows with the data.  Instead the ordered
scan is split by a time bucket:

1. the input is hash-partitioned once on ``(keys, bucket)``; the window runs
   per ``(keys, bucket)``, so the work spreads over ``#keys x #buckets``
   groups;
2. a per-``(keys, bucket)`` summary (one row per bucket) carries the bucket's
   last row; it is aggregated from the same shuffle output (the exchange is
   reused), so the input is scanned and shuffled once;
3. a window over that small summary finds each bucket's predecessor bucket
   (skipping empty buckets);
4. the predecessor is joined back on ``(keys, bucket)`` and used only by the
   bucket's first row.  The big side is already hash-partitioned on those keys
   by step 1, so only the summary is exchanged (or broadcast by AQE when its
   measured size is small).

The result equals the global window exactly (see tests/test_properties.py).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_seq_bucket"


ADAPTIVE = "adaptive"
HOT_BUCKET_ROWS = 5_000_000     # rows above which a clock bucket is split finer
HOT_BROADCAST_LIMIT = 1_000_000  # hot (key, hour|minute) entries broadcast into the bucket join


def _bucket_expr(bucket, order_first: str) -> Column:
    if isinstance(bucket, Column):
        return bucket
    # bucket is a date_trunc unit applied to the first ordering column
    return F.date_trunc(bucket, F.col(order_first)).cast("timestamp_ntz")


def add_bucket(df: DataFrame, keys: Sequence[str], order_first: str, bucket=ADAPTIVE,
               name: str = _B, hot_rows: int | None = None) -> DataFrame:
    """Attach a bucket column that is monotone in ``order_first``.

    ``bucket="adaptive"``: clock hours, except that an hour of one key with
    more than ``hot_rows`` rows is split into minutes, such a minute into
    seconds, such a second into milliseconds and such a millisecond into
    microseconds (only rows sharing one microsecond stay together).  Bucket
    values are the start instants of disjoint, nested time ranges, so they
    stay ordered.  The hour partitions grow with the time span; the
    split keeps a burst (say a third of all rows in one hour) from becoming
    one huge window partition.  Costs one partially aggregated minute-count
    pass (checkpointed hot sets: at most ``rows / hot_rows`` entries, usually
    none) and two broadcast joins against them; if the counted hot sets
    exceed ``HOT_BROADCAST_LIMIT`` the joins shuffle instead.  The sub-second
    pass runs only when hot minutes exist.
    """
    if not (isinstance(bucket, str) and bucket == ADAPTIVE):
        return df.withColumn(name, _bucket_expr(bucket, order_first))
    limit = hot_rows if hot_rows is not None else HOT_BUCKET_ROWS
    keys = list(keys)
    t = F.col(order_first)
    d = (df.withColumn("_bm", _trunc("minute", t)).withColumn("_bh", _trunc("hour", t)))
    hot = _hot_sets(d, keys, "_bm", "hour", limit)
    d, hot_minutes = _flag_hot(d, keys, hot, ("_bh", "_hh"), ("_bm", "_hm"))
    b = (F.when(F.col("_hm"), _trunc("second", t))
         .when(F.col("_hh"), F.col("_bm"))
         .otherwise(F.col("_bh")))
    if hot_minutes:
        # seconds of hot minutes: hot ones are split into milliseconds, hot
        # milliseconds into microseconds (one more pass over those rows only)
        d = d.withColumn("_bms", _trunc("millisecond", t)).withColumn("_bs", _trunc("second", t))
        hot2 = _hot_sets(d.filter(F.col("_hm")), keys, "_bms", "second", limit)
        d, _ = _flag_hot(d, keys, hot2, ("_bs", "_hs"), ("_bms", "_hms"))
        b = (F.when(F.col("_hms"), _trunc("microsecond", t))
             .when(F.col("_hs"), F.col("_bms"))
             .otherwise(b))
    return d.withColumn(name, b).drop("_bm", "_bh", "_hm", "_hh", "_bms", "_bs", "_hms", "_hs")


def _trunc(unit: str, t: Column) -> Column:
    return F.date_trunc(unit, t).cast("timestamp_ntz")


def _hot_sets(rows: DataFrame, keys: list, fine: str, coarse_unit: str, limit: int) -> DataFrame:
    """Checkpointed (keys, _bt, _lvl): fine buckets ("f") and their coarse
    buckets ("c") holding more than ``limit`` rows, from one partially
    aggregated count per fine bucket."""
    from tickflow.session import checkpoint_root
    per = rows.groupBy(*keys, fine).agg(F.count(F.lit(1)).alias("_n"))
    hot = (per.filter(F.col("_n") > limit)
           .select(*keys, F.col(fine).alias("_bt"), F.lit("f").alias("_lvl"))
           .unionByName(per.groupBy(*keys, _trunc(coarse_unit, F.col(fine)).alias("_bt"))
                        .agg(F.sum("_n").alias("_n")).filter(F.col("_n") > limit)
                        .select(*keys, "_bt", F.lit("c").alias("_lvl"))))
    checkpoint_root(rows.sparkSession)
    return hot.checkpoint()


def _flag_hot(d: DataFrame, keys: list, hot: DataFrame, coarse: tuple, fine: tuple):
    """Left-join the hot flags onto ``d``; returns (d, number of hot fine buckets).

    The hot sets are counted first (read back from the checkpoint) and
    broadcast only when provably small; above ``HOT_BROADCAST_LIMIT`` the
    joins shuffle instead.
    """
    counts = {r["_lvl"]: r["n"] for r in hot.groupBy("_lvl").agg(F.count(F.lit(1)).alias("n")).collect()}
    c = hot.filter(F.col("_lvl") == "c").select(*keys, F.col("_bt").alias(coarse[0]),
                                                  F.lit(True).alias(coarse[1]))
    f = hot.filter(F.col("_lvl") == "f").select(*keys, F.col("_bt").alias(fine[0]),
                                                  F.lit(True).alias(fine[1]))
    if sum(counts.values()) <= HOT_BROADCAST_LIMIT:
        c, f = F.broadcast(c), F.broadcast(f)
    return d.join(c, [*keys, coarse[0]], "left").join(f, [*keys, fine[0]], "left"), counts.get("f", 0)


def with_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
             bucket=ADAPTIVE, prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>`` = ``lag(c)`` over (keys ordered by order) for c in cols.

    ``bucket`` is ``"adaptive"`` (clock hours, hot ones split finer; see
    ``add_bucket``), a ``date_trunc`` unit for ``order[0]`` (a timestamp), or
    a Column that is monotone in the ordering.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    d = add_bucket(df, keys, order[0], bucket).repartition(*keys, _B)
    w = Window.partitionBy(*keys, _B).orderBy(*[F.col(c) for c in order])
    lagged = d.select(
        "*",
        *[F.lag(c).over(w).alias(f"_lag_{c}") for c in cols],
        (F.row_number().over(w) == 1).alias("_first_in_bucket"),
    )
    # one row per (keys, bucket): its last row's carried columns
    last = d.groupBy(*keys, _B).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]),
                 F.struct(*[F.col(c) for c in order])).alias("_last"))
    ws = Window.partitionBy(*keys).orderBy(_B)
    pred = last.select(*keys, _B, F.lag("_last").over(ws).alias("_pred"))
    joined = lagged.join(pred, on=[*keys, _B], how="left")
    out = joined.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("_first_in_bucket"), F.col(f"_pred.{c}"))
          .otherwise(F.col(f"_lag_{c}")).alias(f"{prefix}{c}") for c in cols],
    )
    return out


def with_running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
                     out: str, bucket=ADAPTIVE) -> DataFrame:
    """Add ``out`` = running ``max(col)`` over rows up to and including the
    current one, per keys in the given order (nulls ignored)."""
    keys, order = list(keys), list(order)
    d = add_bucket(df, keys, order[0], bucket).repartition(*keys, _B)
    w = (Window.partitionBy(*keys, _B).orderBy(*[F.col(c) for c in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = d.withColumn("_run_in", F.max(col).over(w))
    summ = d.groupBy(*keys, _B).agg(F.max(col).alias("_bmax"))
    ws = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, _B, F.max("_bmax").over(ws).alias("_carry"))
    j = inner.join(carry, on=[*keys, _B], how="left")
    return j.select(*[F.col(c) for c in df.columns],
                    F.greatest(F.col("_run_in"), F.col("_carry")).alias(out))
