"""Readers (S3, S6, S7) and the as-of table read."""

import json

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from tickflow.operators import ingest, marts
from tickflow.session import scratch_path
from tickflow.sources import fixtures as fx
from tickflow.sources import readers


def test_read_table_as_of_prunes_dates(spark):
    stg = marts.stg_raw_prices(fx.ticks(fx.read_events(spark, SF_SMALL)))
    path = scratch_path(spark, "rt")
    stg.withColumn("event_date", F.to_date("event_ts")).write.partitionBy("event_date").parquet(path)
    cut = "2024-01-10 12:00:00"
    df = readers.read_table(spark, path, as_of=cut)
    assert df.count() == stg.filter(F.col("event_ts") <= F.lit(cut).cast("timestamp_ntz")).count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan


def test_read_watermarks(spark, tmp_path):
    p = tmp_path / "wm.json"
    p.write_text("\n".join(json.dumps({"partition": i, "low": 0, "high": 10 * i}) for i in range(3)))
    rows = sorted(tuple(r) for r in readers.read_watermarks(spark, str(p)).collect())
    assert rows == [(0, 0, 0), (1, 0, 10), (2, 0, 20)]


def test_read_alert_payloads_then_flatten(spark, tmp_path):
    p = tmp_path / "alerts.jsonl"
    p.write_text("\n".join([json.dumps({"orgId": 1, "alerts": [{"status": "firing"}, {"status": "resolved"}]}),
                            json.dumps(["not", "an", "object"])]))
    raw = readers.read_alert_payloads(spark, str(p))
    assert raw.count() == 2
    flat = ingest.flatten_alerts(raw).collect()
    assert sorted(r["state"] for r in flat) == ["firing", "resolved"]
