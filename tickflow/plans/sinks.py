"""Write paths: idempotent insert, DLQ insert, batch staging, keyed upsert,
retention, log append (K1-K4, K7, K8).

Storage is plain Parquet partitioned by a date column; there is no database
and no lakehouse jar.  The guarantees of the original pipeline map as follows:

* ``ON CONFLICT DO NOTHING``  -> dedupe in the batch (lowest Kafka position
  wins) + ``left_anti`` join against the stored keys, scanning only the dates
  the batch touches (``scope="partition"``, partition pruning) or everything
  (``scope="full"``).
* staging table + merge under a lock -> every micro-batch writes its own
  ``batch_token`` partition with dynamic partition overwrite: a replayed
  batch rewrites exactly its own files and nothing else.
* incremental ``unique_key`` merge -> for the touched dates only,
  ``existing left_anti new`` union ``new``, staged to a fresh path and then
  swapped in with dynamic partition overwrite (Spark refuses to overwrite a
  path it is reading).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.session import scratch_path

DLQ_KEY = ["stream_instance_id", "batch_id", "kafka_partition", "kafka_offset"]


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order`` (ascending).

    ``row_number() = 1`` plans as a WindowGroupLimit: each map task keeps one
    row per key before the shuffle, so a heavily repeated key does not pile
    up in one reducer.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedupe_dlq(bad: DataFrame) -> DataFrame:
    order = ["ts_utc"] if "ts_utc" in bad.columns else ["kafka_offset"]
    return dedupe(bad, DLQ_KEY, order)


BROADCAST_KEYS_LIMIT = 2_000_000


def new_rows(batch: DataFrame, target: DataFrame | None, key: str = "event_id",
             order: Sequence[str] = ("kafka_partition", "kafka_offset"),
             scope: str = "full", partition_col: str = "event_date",
             batch_partition_expr=None, broadcast_limit: int = BROADCAST_KEYS_LIMIT) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``target``.

    The stored side can be huge, the batch is not: the batch's distinct keys
    are counted, and when they are below ``broadcast_limit`` (always true for
    a rate-limited micro-batch) they are broadcast into a semi join against
    the stored keys, so the stored table is only scanned (one column, pruned
    dates), never shuffled.  Above the limit a plain shuffle anti join is used.
    """
    d = dedupe(batch, [key], list(order))
    if target is None:
        return d
    expr = batch_partition_expr if batch_partition_expr is not None else F.to_date("event_ts")
    # one job: the batch's key count and (bounded) set of touched dates
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.collect_set(expr).alias("dates")).collect()[0]
    stored = target
    if scope == "partition" and partition_col in target.columns:
        stored = target.filter(F.col(partition_col).isin(list(stats["dates"])))
    ids = d.select(key)
    if stats["n"] <= broadcast_limit:
        hits = stored.select(key).join(F.broadcast(ids), key, "left_semi")
        return d.join(F.broadcast(hits), key, "left_anti")
    return d.join(stored.select(key), key, "left_anti")


def dlq_new_rows(bad: DataFrame, existing: DataFrame | None, partition_col: str = "dlq_date",
                 date_expr=None, broadcast_limit: int = BROADCAST_KEYS_LIMIT) -> DataFrame:
    """DLQ rows whose (instance, batch, partition, offset) key is not stored yet (K2).

    The batch is de-duplicated on the key first; stored keys are read only
    from the dates the batch touches (a replayed record keeps its Kafka
    timestamp, hence its date).  As in ``new_rows``, the batch's keys are
    counted (same job as the touched dates) and, below ``broadcast_limit``,
    broadcast into a semi join against the stored keys, so the stored DLQ is
    scanned but not shuffled; above it a shuffle anti join is used.
    """
    d = dedupe_dlq(bad)
    if existing is None:
        return d
    expr = date_expr if date_expr is not None else F.to_date("ts_utc")
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.collect_set(expr).alias("dates")).collect()[0]
    stored = existing
    if partition_col in existing.columns:
        stored = existing.filter(F.col(partition_col).isin(list(stats["dates"])))
    stored = stored.select(*DLQ_KEY)
    if stats["n"] <= broadcast_limit:
        hits = stored.join(F.broadcast(d.select(*DLQ_KEY)), DLQ_KEY, "left_semi")
        return d.join(F.broadcast(hits), DLQ_KEY, "left_anti")
    return d.join(stored, DLQ_KEY, "left_anti")


# ------------------------------------------------------------------ writes

def write_batch(df: DataFrame, path: str, batch_token: str,
                date_expr=None, date_col: str = "event_date") -> None:
    """Write one micro-batch into its own (date, batch_token) partitions (K3).

    Re-running the same batch replaces exactly those partitions.
    """
    d = df.withColumn(date_col, date_expr if date_expr is not None else F.to_date("event_ts")) \
        .withColumn("batch_token", F.lit(batch_token))
    (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col, "batch_token").parquet(path))


def append_log(df: DataFrame, path: str, date_col: str | None = None) -> None:
    """Append-only operational log (K7)."""
    w = df.write.mode("append")
    if date_col:
        w = w.partitionBy(date_col)
    w.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate data."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# --- small tables that are replaced as a whole: one folder per version, complete once it has _SUCCESS

def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(version, complete) of a published table, oldest first."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted((int(n[1:]), fs.exists(hadoop(f"{path}/{n}/_SUCCESS"))) for n in found if n[:1] == "v" and n[1:].isdigit())


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, None if there is none. A write that broke off is never seen."""
    done = [v for v, complete in _versions(spark, path) if complete]
    return spark.read.parquet(f"{path}/v{done[-1]}") if done else None


def publish(df: DataFrame, path: str) -> None:
    """Writes a new version; the one before stays for running readers, older ones go.

    ``df`` may read the version before.  One writer at a time.
    """
    spark = df.sparkSession
    old = _versions(spark, path)
    new = old[-1][0] + 1 if old else 0
    df.write.parquet(f"{path}/v{new}")
    last = max((v for v, complete in old if complete), default=-1)
    for v, _ in old:
        if v != last:
            delete_path(spark, f"{path}/v{v}")


# --- marts whose columns may change: the current schema lies beside the data, files keep the columns they were written with

SCHEMA_FILE = "_mart_schema.json"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The recorded columns of a mart, None for a table without a record."""
    fs, p = _fs(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, p = _fs(spark, f"{path}/{SCHEMA_FILE}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(schema.json().encode()))
    finally:
        out.close()


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A mart with its current columns: rows written before a column came have NULL there, dropped columns are not seen.

    No file footers are merged: the recorded schema is given to the reader.
    """
    schema = stored_schema(spark, path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def write_mart(df: DataFrame, path: str, partition_col: str) -> None:
    """A mart's first or full build."""
    df.write.mode("overwrite").partitionBy(partition_col).parquet(path)
    record_schema(df.sparkSession, path, df.schema)


def synced_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of ``new``; a column of both must keep its type."""
    kinds = {f.name: f.dataType for f in old.fields}
    changed = [f"{f.name}: {kinds[f.name].simpleString()} -> {f.dataType.simpleString()}"
               for f in new.fields if f.name in kinds and kinds[f.name] != f.dataType]
    if changed:
        raise ValueError(f"stored columns cannot change their type, rebuild the mart: {', '.join(changed)}")
    return T.StructType([T.StructField(f.name, f.dataType) for f in new.fields])


SWAP_MARKER = "_SWAP_IN_PROGRESS"
DONE_MARKER = "_LAST_COMPLETED_RUN"


class swap_guard:
    """Mark a table as being swapped for the duration of a multi-partition
    rewrite; ``read_consistent`` waits while the marker exists.  On success
    the marker is replaced by a completed-run marker."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __enter__(self):
        fs, _ = _fs(self.spark, self.path)
        jvm = self.spark.sparkContext._jvm
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{SWAP_MARKER}"), True).close()
        return self

    def __exit__(self, exc_type, exc, tb):
        fs, _ = _fs(self.spark, self.path)
        jvm = self.spark.sparkContext._jvm
        if exc_type is None:
            fs.create(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{DONE_MARKER}"), True).close()
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{SWAP_MARKER}"), False)
        return False     # a failed swap leaves the marker: readers keep waiting / fail loudly


def read_consistent(spark: SparkSession, path: str, timeout_s: float = 600.0,
                    poll_s: float = 2.0) -> DataFrame:
    """Read a table only when no swap is in progress (K4 readers)."""
    import time as _time
    fs, _ = _fs(spark, path)
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{SWAP_MARKER}")
    deadline = _time.time() + timeout_s
    while fs.exists(marker):
        if _time.time() > deadline:
            raise TimeoutError(f"{path}: a partition swap is still in progress")
        _time.sleep(poll_s)
    return read_mart(spark, path)


def upsert(spark: SparkSession, new: DataFrame, target_path: str, keys: Sequence[str],
           partition_col: str, replace_from: tuple | None = None) -> None:
    """Delete-then-insert by key for the partitions touched by ``new`` (K4).

    Keys absent from ``new`` are kept, unless ``replace_from = (column,
    bound)`` is given: then every stored row of the touched partitions with
    ``column >= bound`` is replaced by the slice.  ``new`` is computed once and staged;
    the touched partitions are read from the staged copy, merged with the
    stored rows of those partitions only, staged again, and swapped into the
    target with dynamic partition overwrite.  The mart's columns follow ``new``: a new
    column is NULL in rows stored before it came, one that ``new`` no longer has is dropped.
    """
    keys = list(keys)
    staged_new = scratch_path(spark, "upsert-new")
    new.write.partitionBy(partition_col).parquet(staged_new)
    fs, root = _fs(spark, staged_new)
    touched = [st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(root)
               if st.isDirectory() and st.getPath().getName().startswith(f"{partition_col}=")]
    if not touched:
        delete_path(spark, staged_new)
        return
    stored = read_mart(spark, target_path)
    if stored_schema(spark, target_path) is None:  # folder names have no type of their own, what is read from them is a guess
        typed = T.StructType([new.schema[f.name] if f.name == partition_col else f for f in stored.schema.fields])
        stored = spark.read.schema(typed).parquet(target_path)
    schema = synced_schema(stored.schema, new.schema)
    fresh = spark.read.schema(schema).parquet(staged_new)
    existing = stored.filter(F.col(partition_col).cast("string").isin(touched))
    if replace_from is not None:
        col, bound = replace_from
        from tickflow.functions.timeutil import ts_lit
        existing = existing.filter(~(F.col(col) >= ts_lit(bound)))
    merged = fresh.unionByName(existing.join(fresh.select(*keys), keys, "left_anti"), allowMissingColumns=True).select(*new.columns)
    staging = scratch_path(spark, "upsert-staging")
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(staging)
    with swap_guard(spark, target_path):
        (spark.read.schema(schema).parquet(staging).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target_path))
        record_schema(spark, target_path, schema)
    for done in (staged_new, staging):
        delete_path(spark, done)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition column names of a Hive-style table, outermost first (listing only)."""
    fs, p = _fs(spark, path)
    cols = []
    while True:
        dirs = [st for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()]
        if not dirs:
            return cols
        cols.append(dirs[0].getPath().getName().split("=", 1)[0])
        p = dirs[0].getPath()


def _leaf_dirs(spark: SparkSession, path: str, below: str = "") -> set[str]:
    """The innermost partition folders under ``path`` (and ``below``), relative to ``path`` (listing only)."""
    fs, p = _fs(spark, f"{path}/{below}" if below else path)
    inner = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()]
    if not inner:
        return {below}
    return set().union(*(_leaf_dirs(spark, path, f"{below}/{n}" if below else n) for n in inner))


def apply_retention(spark: SparkSession, path: str, ts_col: str, cutoff,
                    partition_col: str | None = None) -> dict:
    """Delete rows with ``ts_col < cutoff`` (K8).

    Whole expired date partitions are removed as directories; only the
    boundary date (the date of the cutoff) is rewritten, keeping any inner
    partition levels (e.g. ``batch_token``).  An unpartitioned table is
    rewritten through a staging copy.
    """
    from tickflow.functions.timeutil import ts_lit
    cut = ts_lit(cutoff)
    cols = partition_columns(spark, path)
    if partition_col is None:
        partition_col = cols[0] if cols else None
    fs, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    if partition_col is None:
        kept = spark.read.parquet(path).filter(F.col(ts_col) >= cut)
        staging = scratch_path(spark, "retention-staging")
        kept.write.parquet(staging)
        spark.read.parquet(staging).write.mode("overwrite").parquet(path)
        delete_path(spark, staging)
        return {"rewritten": True}
    inner = [c for c in cols if c != partition_col]
    cutoff_date = spark.range(1).select(F.to_date(cut).alias("d")).collect()[0]["d"]
    df = spark.read.parquet(path)
    dropped = 0
    # Partition directories are listed from the file system (no data scan).
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{partition_col}="):
            if name.split("=", 1)[1] < str(cutoff_date):
                fs.delete(st.getPath(), True)
                dropped += 1
    boundary_path = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={cutoff_date}")
    if fs.exists(boundary_path):
        kept = df.filter((F.col(partition_col) == F.lit(cutoff_date)) & (F.col(ts_col) >= cut))
        if kept.limit(1).count() == 0:
            fs.delete(boundary_path, True)
        else:
            staging = scratch_path(spark, "retention-staging")
            kept.write.partitionBy(partition_col, *inner).parquet(staging)
            # inner partitions without rows to keep go first (they hold expired rows only); the others are
            # replaced by Spark's own commit, so a break-off at any point loses no row to keep
            kept_dirs = _leaf_dirs(spark, staging)
            with swap_guard(spark, path):
                for leaf in _leaf_dirs(spark, path, f"{partition_col}={cutoff_date}") - kept_dirs:
                    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{leaf}"), True)
                (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(partition_col, *inner).parquet(path))
            delete_path(spark, staging)
    return {"dropped_partitions": dropped, "boundary": str(cutoff_date)}


COMPACTED = "compacted"
TARGET_FILE_BYTES = 256 * 1024 * 1024


def compact(spark: SparkSession, path: str, date_col: str = "event_date", dates=None,
            key: str = "event_id", order: Sequence[str] = ("kafka_partition", "kafka_offset"),
            files_per_date: int | None = None) -> list:
    """Merge the per-batch ``batch_token`` partitions of whole dates into one.

    Meant for dates no longer being written.  Rows are re-deduplicated on
    ``key`` (ids stay unique), staged, written as ``batch_token=compacted``,
    and only then are the old token directories removed.  A later replay of an
    old batch finds all its ids stored (in the compacted token) and inserts
    nothing.
    """
    fs, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    done = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(f"{date_col}=")):
            continue
        d = name.split("=", 1)[1]
        if dates is not None and d not in {str(x) for x in dates}:
            continue
        tokens = [t for t in fs.listStatus(st.getPath())
                  if t.isDirectory() and t.getPath().getName().startswith("batch_token=")]
        if len(tokens) <= 1:
            continue
        rows = spark.read.parquet(path).filter(F.col(date_col) == F.lit(d).cast("date"))
        rows = dedupe(rows, [key], list(order)).drop("batch_token")
        staging = scratch_path(spark, "compact-staging")
        # output files follow the date's stored size, so a hot date is written
        # by many tasks rather than one
        n = files_per_date or max(1, -(-fs.getContentSummary(st.getPath()).getLength()
                                       // TARGET_FILE_BYTES))
        rows.coalesce(n).write.parquet(staging)
        with swap_guard(spark, path):
            (spark.read.parquet(staging).withColumn("batch_token", F.lit(COMPACTED))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(date_col, "batch_token").parquet(path))
            for t in tokens:
                if t.getPath().getName() != f"batch_token={COMPACTED}":
                    fs.delete(t.getPath(), True)
        delete_path(spark, staging)
        done.append(d)
    return done
