"""Alert webhook bodies as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators import ingest
from tickflow.sources import readers
from tickflow.streaming.ingest import checkpoint_query_id


def start_alerts(spark: SparkSession, path: str, out_path: str, checkpoint: str, max_files: int | None = None,
                 available_now: bool = False, trigger_seconds: int = 60):
    """Follows a folder of payload files and stores their alerts, a partition per micro-batch.

    A batch that runs again replaces its own partition, and payload ids depend on files and lines only,
    so a replay gives the same rows.
    """
    lines = readers.alert_lines(spark.readStream.options(**({} if max_files is None else {"maxFilesPerTrigger": max_files})).text(path))

    def store(rows: DataFrame, batch_id: int) -> None:
        token = f"{checkpoint_query_id(spark, checkpoint)}-{batch_id}"
        (ingest.flatten_alerts(readers.number_payloads(rows)).withColumn("batch_token", F.lit(token)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_token").parquet(out_path))

    w = lines.writeStream.queryName("alert_events").foreachBatch(store).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
