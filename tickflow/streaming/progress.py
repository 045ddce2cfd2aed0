"""What a running stream says of itself, batch by batch.

Counts are observed on the streaming plan, so they come with the batch's own
pass over its rows; a listener takes them, with the number of input rows, from
each progress report.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = ("query_id string, batch_id bigint, input_rows bigint, good_rows bigint, bad_rows bigint, "
                   "trigger_ms bigint, over_limit boolean")
OBSERVED = "validated"


def observed(validated: DataFrame) -> DataFrame:
    """``validated`` (with an error_reason) with its good and bad rows counted as they pass."""
    good = F.col("error_reason").isNull()
    return validated.observe(OBSERVED, F.count_if(good).alias("good_rows"), F.count_if(~good).alias("bad_rows"))


class ProgressLog(StreamingQueryListener):
    """Collects a row per batch with input, a few numbers each, until they are taken.

    ``most``: the rows that a trigger may take at most; a batch above it is marked.
    """

    def __init__(self, most: int | None = None):
        self.most, self.rows, self.ended, self._lock = most, [], threading.Event(), threading.Lock()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = (p.observedMetrics or {}).get(OBSERVED)
        if counts is None or not p.numInputRows:
            return
        row = (str(p.id), int(p.batchId), int(p.numInputRows), int(counts["good_rows"]), int(counts["bad_rows"]),
               int((p.durationMs or {}).get("triggerExecution", 0)), self.most is not None and p.numInputRows > self.most)
        with self._lock:
            self.rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def take(self, spark: SparkSession) -> DataFrame:
        """What has been logged since the last call."""
        with self._lock:
            rows, self.rows = self.rows, []
        return spark.createDataFrame(rows, PROGRESS_SCHEMA)
