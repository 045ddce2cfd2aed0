"""Batch and streaming readers (S3, S6, S7) and the Kafka writer (K6).

The streaming tick source (S1) lives in ``tickflow.streaming.ingest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.timeutil import ts_lit


def read_table(spark: SparkSession, path: str, as_of=None, ts_col: str = "event_ts",
               date_col: str = "event_date") -> DataFrame:
    """The stored fact table, optionally as of an instant (S3).

    The ``date_col <= date(as_of)`` predicate prunes whole date partitions
    (Catalyst cannot derive it from a predicate on ``ts_col``); the ``ts_col``
    predicate is pushed to the Parquet reader.
    """
    df = spark.read.parquet(path)
    if as_of is not None:
        a = ts_lit(as_of)
        if date_col in df.columns:
            df = df.filter(F.col(date_col) <= F.to_date(a))
        df = df.filter(F.col(ts_col) <= a)
    return df


WATERMARK_SCHEMA = "partition int, low bigint, high bigint"


def read_watermarks(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Broker watermark snapshots ``(partition, low, high)`` as a table."""
    return spark.read.schema(WATERMARK_SCHEMA).format(fmt).load(path)


def alert_lines(lines: DataFrame) -> DataFrame:
    """(file, received_ts, body) of text lines, batch or stream, from their files' metadata."""
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("received_ts"), F.col("value").alias("body"))


def number_payloads(lines: DataFrame) -> DataFrame:
    """``(payload_id, received_ts, body)``: the n equal lines of a file are n payloads, numbered 1 to n.

    A line's id is the hash of its file, body and number; equal lines can be told apart by
    nothing else, so the ids are the same however a file is split and whenever it is read
    again.  Lines are counted before the shuffle: one repeated very often is one row there.
    """
    counted = lines.groupBy("file", "body").agg(F.min("received_ts").alias("received_ts"), F.count(F.lit(1)).alias("n"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select(F.xxhash64("file", "body", "copy").alias("payload_id"), "received_ts", "body")


def read_alert_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Alert webhook bodies, one JSON document per line (S7): ``(payload_id, received_ts, body)``.

    Non-object bodies are rejected later by ``ingest.flatten_alerts``.  ``streaming.alerts`` is the stream.
    """
    return number_payloads(alert_lines(spark.read.text(path)))


def write_kafka(rows: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Publish ``(key, value)`` rows (see ``ingest.to_kafka_rows``) to a topic (K6).

    Needs the Spark Kafka connector on the classpath.
    """
    (rows.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
     .option("topic", topic).save())
