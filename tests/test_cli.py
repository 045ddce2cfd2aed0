"""End-to-end jobs over a warehouse folder: ingest -> marts -> checks -> alerts -> retention."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from tickflow import cli
from tickflow.session import scratch_path
from tickflow.sources import fixtures as fx


def test_jobs_end_to_end(spark):
    ev = fx.read_events(spark, SF_SMALL)
    root = scratch_path(spark, "warehouse")
    src = scratch_path(spark, "cli-src")
    fx.raw_payloads(ev).repartition(2).write.parquet(src)
    base = dict(root=root, as_of="2024-01-31 00:00:00", master=None)
    cli.run_ingest(spark, SimpleNamespace(**base, source_format="parquet", source_path=src,
                                          bootstrap="", topic="prices", starting_offsets="earliest",
                                          fail_on_data_loss="false", max_per_trigger=1,
                                          trigger_seconds=1, available_now=True, checkpoint=None,
                                          instance_id="stream1"))
    raw = spark.read.parquet(f"{root}/raw_prices")
    n_raw = raw.count()
    assert n_raw > 0 and raw.select("event_id").distinct().count() == n_raw
    from tickflow.operators import monitor
    r = monitor.dlq_rate_from_metrics(spark.read.parquet(f"{root}/batch_metrics")).collect()[0]
    n_dlq = spark.read.parquet(f"{root}/dead_letter_events").count()
    assert r["good_rows"] == n_raw and r["bad_rows"] == n_dlq
    assert abs(r["dlq_rate"] - n_dlq / (n_dlq + n_raw)) < 1e-6
    cli.run_marts(spark, SimpleNamespace(**base))
    cli.run_marts(spark, SimpleNamespace(**base))          # incremental second run is a no-op
    for m in ["mart_minute_last_price", "mart_price_events", "mart_price_volatility_1h", "mart_latest_prices"]:
        assert cli._table(spark, root, m).count() > 0
    s = cli.run_checks(spark, SimpleNamespace(**base, environment="ci")).collect()[0]
    assert s["total"] == 66 and s["status"] in ("PASS", "WARN", "FAIL")
    inputs = scratch_path(spark, "cli-inputs")
    fx.api_calls_raw(ev).write.parquet(f"{inputs}/calls")
    fx.watermarks(ev).write.parquet(f"{inputs}/watermarks")
    fx.alert_payloads(ev).select(F.regexp_replace("body", "[\\r\\n]", " ").alias("value")).write.text(f"{inputs}/alerts")
    kafka = dict(topic="prices", group_id="tick_ingest")
    assert cli.run_api_calls(spark, SimpleNamespace(**base, input=f"{inputs}/calls", format="parquet")).count() == ev.count()
    assert cli.run_lag(spark, SimpleNamespace(**base, **kafka, input=f"{inputs}/watermarks", format="parquet")).count() == 1
    assert cli.run_alert_events(spark, SimpleNamespace(**base, input=f"{inputs}/alerts", format="text")).count() > 0
    for log in ("api_calls", "kafka_lag", "alert_events"):
        assert spark.read.parquet(f"{root}/{log}").count() > 0
    ev_rows = cli.run_alerts(spark, SimpleNamespace(**base, topic="prices", group_id="tick_ingest")).collect()
    assert len(ev_rows) == 11
    values = {r["rule_uid"]: r["value"] for r in ev_rows}
    assert values["kafka_lag_warn_gt_50"] is not None and values["api_errors_18m_ge_1"] is not None
    assert cli._table(spark, root, "alert_states").count() == 11
    folded = cli.run_compact(spark, SimpleNamespace(**base))
    assert folded["dates"] and spark.read.parquet(f"{root}/raw_prices").count() == n_raw
    done = cli.run_retention(spark, SimpleNamespace(**base, days=7))
    kept = spark.read.parquet(f"{root}/raw_prices")
    assert kept.filter(F.col("event_ts") < F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")).count() == 0
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/raw_prices_ids").select("event_id").collect()) == sorted(r[0] for r in kept.select("event_id").collect())
    assert "raw_prices" in done
