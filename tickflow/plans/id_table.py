"""A hash-bucketed table of the ids stored in a fact table.

The facts lie by date, an id's conflicts may lie under any date, so a conflict
check over the facts scans their whole id column for every micro-batch.  This
table beside the facts holds (id, date) by hash bucket instead.  A probe reads
only the folders of the buckets that its ids fall in, and within a file only
row groups whose hashes may match: rows are sorted by hash, and the bounds of
the probe's hashes in each bucket reach the Parquet reader.

Each micro-batch writes its ids under its own ``batch_token``, as the facts do,
so a replay replaces exactly its own files.  ``fold`` merges the tokens of
buckets that have gathered many.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.plans import sinks
from tickflow.session import scratch_path

FOLDED = "folded"


@dataclass(frozen=True)
class IdTable:
    """``buckets`` is fixed when the table is made: the folder's own list of buckets is not asked for it."""

    path: str
    buckets: int = 16
    key: str = "event_id"
    date: str = "event_date"

    def hash_of(self) -> Column:
        return F.xxhash64(F.col(self.key).cast("string"))

    def _hashed(self, rows: DataFrame) -> DataFrame:
        h = self.hash_of()
        return rows.withColumn("id_hash", h).withColumn("bucket", F.pmod(h, F.lit(self.buckets)).cast("int"))

    def exists(self, spark: SparkSession) -> bool:
        return sinks.path_exists(spark, self.path) and bool(sinks._leaf_dirs(spark, self.path) - {""})

    def write(self, rows: DataFrame, token: str) -> None:
        """Stores the ids of ``rows`` (id and date columns) under a token, in place of what the token held."""
        ids = self._hashed(rows.select(self.key, self.date)).withColumn("batch_token", F.lit(token))
        (ids.repartition("bucket").sortWithinPartitions("bucket", "id_hash").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_token").parquet(self.path))

    def build(self, facts: DataFrame, date: Column) -> None:
        """The table of facts that are stored already, by their own tokens where they have any."""
        token = F.col("batch_token") if "batch_token" in facts.columns else F.lit(FOLDED)
        ids = self._hashed(facts.select(self.key, date.alias(self.date), token.alias("batch_token")))
        (ids.repartition("bucket").sortWithinPartitions("bucket", "batch_token", "id_hash").write.mode("overwrite")
         .partitionBy("bucket", "batch_token").parquet(self.path))

    def touched(self, ids: DataFrame) -> list[tuple[int, int, int]]:
        """(bucket, least hash, largest hash) of the ids: a row per bucket at most."""
        per = self._hashed(ids.select(self.key)).groupBy("bucket").agg(F.min("id_hash").alias("lo"), F.max("id_hash").alias("hi"))
        return sorted(map(tuple, per.collect()))

    def hits(self, ids: DataFrame, token: str | None = None, fact_path: str | None = None) -> DataFrame:
        """The stored (id, date) of any of ``ids``.

        A replay must not take its own rows for conflicts: ids under ``token`` don't count for dates
        whose facts still lie under that token (a compacted date's do count).
        """
        spark = ids.sparkSession
        touched = self.touched(ids)
        table = spark.read.parquet(self.path)
        stored = table.filter(F.col("bucket").isin([b for b, _, _ in touched]))
        if touched:  # bounds over all buckets reach the row groups' statistics
            stored = stored.filter(F.col("id_hash").between(min(lo for _, lo, _ in touched), max(hi for _, _, hi in touched)))
        own = self._own_dates(table, token, fact_path)
        if own:
            stored = stored.filter(~((F.col("batch_token") == token) & F.col(self.date).isin(own)))
        probe = self._hashed(ids.select(self.key)).select("bucket", "id_hash", self.key)
        return stored.join(probe, ["bucket", "id_hash", self.key], "left_semi").select(self.key, self.date)

    def _own_dates(self, table: DataFrame, token: str | None, fact_path: str | None) -> list:
        """Dates that an earlier run of the batch has stored facts under; none unless this is a replay."""
        if token is None:
            return []
        dates = [r[0] for r in table.filter(F.col("batch_token") == token).select(self.date).distinct().collect()]  # dates of one batch
        if fact_path is None:
            return dates
        return [d for d in dates if sinks.path_exists(table.sparkSession, f"{fact_path}/{self.date}={d}/batch_token={token}")]

    def forget(self, facts: DataFrame, upto: str) -> None:
        """After retention: of the ids dated up to ``upto`` only those stay whose facts do (K8).

        What stays is written before what goes is removed, so a break-off forgets nothing that is stored.
        """
        spark = facts.sparkSession
        ids = spark.read.parquet(self.path)
        old = F.col(self.date) <= F.lit(upto).cast("date")
        there = facts.filter(old).select(F.col(self.key).cast("string").alias(self.key))
        kept = ids.filter(~old).unionByName(ids.filter(old).join(there, self.key, "left_semi").select(*ids.columns))
        staging = scratch_path(spark, "ids-kept")
        kept.repartition("bucket").sortWithinPartitions("bucket", "batch_token", "id_hash").write.partitionBy("bucket", "batch_token").parquet(staging)
        leaves = sinks._leaf_dirs(spark, staging) - {""}
        if leaves:
            (spark.read.parquet(staging).repartition("bucket").sortWithinPartitions("bucket", "batch_token", "id_hash").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_token").parquet(self.path))
        for leaf in sinks._leaf_dirs(spark, self.path) - leaves - {""}:
            sinks.delete_path(spark, f"{self.path}/{leaf}")
        sinks.delete_path(spark, staging)

    def fold(self, spark: SparkSession, most: int = 32) -> list[int]:
        """Merges the tokens of every bucket that holds more than ``most``; returns those buckets.

        The merged files are written first, so a break-off leaves ids twice, which changes no probe.
        """
        fs, root = sinks._fs(spark, self.path)
        crowded = {}
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("bucket="):
                tokens = [t.getPath() for t in fs.listStatus(st.getPath()) if t.isDirectory()]
                if len(tokens) > most:
                    crowded[int(name.partition("=")[2])] = tokens
        if not crowded:
            return []
        staging = scratch_path(spark, "id-fold")
        merged = (spark.read.parquet(self.path).filter(F.col("bucket").isin(sorted(crowded)))
                  .select(self.key, self.date, "id_hash", "bucket").distinct())
        merged.repartition("bucket").sortWithinPartitions("bucket", "id_hash").write.partitionBy("bucket").parquet(staging)
        (spark.read.parquet(staging).withColumn("batch_token", F.lit(FOLDED)).repartition("bucket").sortWithinPartitions("bucket", "id_hash")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_token").parquet(self.path))
        for tokens in crowded.values():
            for t in tokens:
                if t.getName() != f"batch_token={FOLDED}":
                    fs.delete(t, True)
        sinks.delete_path(spark, staging)
        return sorted(crowded)


def new_rows(batch: DataFrame, ids: IdTable, token: str | None = None, fact_path: str | None = None,
             order=("kafka_partition", "kafka_offset")) -> DataFrame:
    """Rows of ``batch`` whose id is stored nowhere yet, whatever date it is stored under; the first row of each id."""
    first = sinks.dedupe(batch, [ids.key], list(order))
    return first.join(ids.hits(first, token, fact_path).select(ids.key), ids.key, "left_anti")
