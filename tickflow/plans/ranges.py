"""Ordered per-key scans by ranges: sort once over the whole cluster, carry one row across each border.

The rows are range-partitioned and sorted by (keys, order), so a key of any
size is spread over as many tasks as its share of the rows asks for, and rows
with equal timestamps are split by the rest of the order.  Each task passes
over its sorted rows once, an Arrow batch at a time, and the result is written
with the number of its range: that fixes the ranges, whatever is rerun later.
What a range needs from those before it is one row per range, the last one;
there are at most as many as shuffle partitions, however large the input is,
and they go by the driver and a broadcast to the ranges that follow.

Compared with ``sequential`` (clock buckets): no pass to find hot buckets, no
summary per key and bucket, no second window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.session import scratch_path, ship_package

PART, FIRST, LAST = "_range", "_first", "_last"


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Null-safe equality."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def _shifted(column: pa.Array, before: pa.Array | None) -> pa.Array:
    """The column moved on by one row; ``before`` is the row ahead of it, none at the start."""
    head = pa.nulls(1, column.type) if before is None else before
    return pa.concat_arrays([head.cast(column.type), column.slice(0, len(column) - 1)])


def _continues(batch: pa.RecordBatch, keys: Sequence[str], held: pa.RecordBatch | None) -> pa.Array:
    """Whether each row has the key of the row ahead of it."""
    same = pa.array(np.ones(batch.num_rows, bool))
    for k in keys:
        column = batch.column(k)
        same = pc.and_(same, _same(column, _shifted(column, None if held is None else held.column(k))))
    if held is None:
        same = pa.concat_arrays([pa.array([False]), same.slice(1)])
    return same


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range's number and marks its first and last row; the last row of a batch waits for the next."""
    number, waiting, first = TaskContext.get().partitionId(), None, True

    def marked(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        nonlocal first
        starts, ends = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
        starts[0], ends[-1] = first, last
        first = False
        for name, column in ((PART, pa.array(np.full(batch.num_rows, number, np.int32))), (FIRST, pa.array(starts)), (LAST, pa.array(ends))):
            batch = batch.append_column(name, column)
        return batch

    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            yield marked(waiting, False)
        if batch.num_rows > 1:
            yield marked(batch.slice(0, batch.num_rows - 1), False)
        waiting = batch.slice(batch.num_rows - 1)
    if waiting is not None:
        yield marked(waiting, True)


def _scanned(df: DataFrame, keys: Sequence[str], order: Sequence[str], added: list[T.StructField],
             scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """The rows in ranges, with what ``scan`` adds to each, written below the shared folder and read back."""
    spark = df.sparkSession
    ship_package(spark)
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    marks = [T.StructField(PART, T.IntegerType()), T.StructField(FIRST, T.BooleanType()), T.StructField(LAST, T.BooleanType())]
    schema = T.StructType([*df.schema.fields, *added, *marks])
    path = scratch_path(spark, "ranges")
    (df.repartitionByRange(*by).sortWithinPartitions(*by)
     .mapInArrow(lambda batches: _marked(scan(batches)), schema).write.parquet(path))
    return spark.read.schema(schema).parquet(path)


def _carried(lasts: DataFrame, keys: Sequence[str], cols: Sequence[str], along: Callable[[object, object], object] | None = None) -> DataFrame:
    """What each range is given by the one before it with rows: that one's last row, as ``_k_`` and ``_c_`` columns.

    ``along(before, own)`` adds up a single column over ranges that end in the same key.
    ``lasts`` has one row per range, at most as many as shuffle partitions.
    """
    given, rows = None, []
    for row in sorted(lasts.collect(), key=lambda r: r[PART]):
        if given is not None:
            rows.append((row[PART], *given))
        key, values = [row[k] for k in keys], [row[c] for c in cols]
        if along is not None and given is not None and given[:len(keys)] == key:
            values = [along(given[-1], values[0])]
        given = [*key, *values]
    fields = {f.name: f.dataType for f in lasts.schema.fields}
    schema = T.StructType([T.StructField(PART, T.IntegerType()), *[T.StructField(f"_k_{k}", fields[k]) for k in keys],
                           *[T.StructField(f"_c_{c}", fields[c]) for c in cols]])
    return lasts.sparkSession.createDataFrame(rows, schema)


def with_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Adds ``prev_<c>``: the value of c in the row before, per keys in the given order (nulls first)."""
    keys, order, cols = list(keys), list(order), list(cols)
    fields = {f.name: f for f in df.schema.fields}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            same, out = _continues(batch, keys, held), batch
            for c in cols:
                column = batch.column(c)
                before = _shifted(column, None if held is None else held.column(c))
                out = out.append_column(prefix + c, pc.if_else(same, before, pa.nulls(1, column.type)[0]))
            held = batch.slice(batch.num_rows - 1)
            yield out

    staged = _scanned(df, keys, order, [T.StructField(prefix + c, fields[c].dataType) for c in cols], scan)
    carried = _carried(staged.filter(LAST).select(PART, *dict.fromkeys([*keys, *cols])), keys, cols)
    joined = staged.join(F.broadcast(carried), PART, "left")  # one row per range
    mine = F.col(FIRST)
    for k in keys:
        mine = mine & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return joined.select(*df.columns, *[F.when(mine, F.col(f"_c_{c}")).otherwise(F.col(prefix + c)).alias(prefix + c) for c in cols])


def with_running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, out: str) -> DataFrame:
    """Adds ``out``: the largest ``col`` (a timestamp or number; nulls ignored) up to and with each row, per keys in the given order."""
    keys, order = list(keys), list(order)
    kind = next(f.dataType for f in df.schema.fields if f.name == col)
    head = "_in_first_key"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, so_far, in_first = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            same = _continues(batch, keys, held).to_numpy(zero_copy_only=False)
            if held is None:
                same[0] = True
            column = batch.column(col)
            column = pa.concat_arrays([pa.nulls(1, column.type) if so_far is None else so_far, column])
            known = ~column.is_null().to_numpy(zero_copy_only=False)
            order_of = pc.rank(column, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
            place = np.where(known, order_of, 0)  # 0: no value yet
            run = np.cumsum(np.concatenate([[False], ~same]))
            top = np.maximum.accumulate(run * (len(place) + 1) + place) - run * (len(place) + 1)
            at = np.zeros(len(place) + 1, np.int64)
            at[place] = np.arange(len(place))
            best = pa.array(at[top], mask=top == 0)
            largest = column.take(best)
            so_far = largest.slice(len(largest) - 1)
            batch_head = (run[1:] == 0) & in_first
            in_first = bool(batch_head[-1])
            held = batch.slice(batch.num_rows - 1)
            yield batch.append_column(out, largest.slice(1)).append_column(head, pa.array(batch_head))

    staged = _scanned(df, keys, order, [T.StructField(out, kind), T.StructField(head, T.BooleanType())], scan)
    # ranges that end within one key pass on the largest of all of them
    carried = _carried(staged.filter(LAST).select(PART, *keys, out), keys, [out], lambda a, b: max((x for x in (a, b) if x is not None), default=None))
    joined = staged.join(F.broadcast(carried), PART, "left")  # one row per range
    mine = F.col(head)
    for k in keys:
        mine = mine & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return joined.select(*df.columns, F.greatest(F.col(out), F.when(mine, F.col(f"_c_{out}"))).alias(out))
