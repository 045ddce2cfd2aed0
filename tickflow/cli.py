"""Command-line jobs over stored tables (one Spark application per invocation).

    python -m tickflow ingest  --root R --source-format kafka --bootstrap host:9092
    python -m tickflow compact --root R [--as-of TS]
    python -m tickflow marts   --root R [--as-of TS] [--rebuild-emptied]
    python -m tickflow checks  --root R [--as-of TS] [--results P]
    python -m tickflow alerts  --root R [--as-of TS]
    python -m tickflow retention --root R [--days 90] [--as-of TS]
    python -m tickflow api-calls    --root R --input P [--format json]   # -> api_calls
    python -m tickflow lag          --root R --input P [--format json]   # -> kafka_lag
    python -m tickflow alert-events --root R --input P                   # -> alert_events

``R`` is a warehouse folder on shared storage holding ``raw_prices``
(partitioned by ``event_date``/``batch_token``), ``dead_letter_events``,
``batch_metrics``, the marts (partitioned by ``bucket_date``) and the
operational logs (``api_calls``, ``kafka_lag``, ``test_runs``,
``backup_log``, ``alert_evaluations``, ``check_results``).  ``--as-of``
defaults to the current time.  Repeated runs are the caller's schedule.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.timeutil import minus, ts_lit
from tickflow.operators import ingest, marts, monitor, quality
from tickflow.plans import incremental, sinks
from tickflow.plans.id_table import IdTable
from tickflow.session import build_session
from tickflow.sources import readers
from tickflow.streaming import ingest as sing

MART_SPECS = {
    # name: (model factory, keys, bucket column, lookback)
    "mart_minute_last_price": (lambda as_of: incremental.minute_model,
                               ["commodity", "symbol", "minute_bucket"], "minute_bucket", "30 minutes"),
    "mart_price_events": (lambda as_of: incremental.events_model,
                          ["commodity", "symbol", "event_ts"], "event_ts", "2 hours"),
    "mart_price_volatility_1h": (incremental.volatility_model,
                                 ["commodity", "symbol", "hour_bucket"], "hour_bucket", "2 hours"),
}
API_CALL_SCHEMA = ("call_id bigint, ts_utc timestamp_ntz, symbols string, http_status int, latency_ms int, "
                   "body string")
LOG_TABLES = {  # table: time column (retention; partition layout is detected)
    "raw_prices": "event_ts", "dead_letter_events": "ts_utc", "alert_events": "ts_utc",
    "api_calls": "ts_utc", "kafka_lag": "ts_utc", "test_runs": "run_ts_utc",
    "backup_log": "backup_ts",
}

PUBLISHED = {"latest_prices_state", "mart_latest_prices", "alert_states"}   # replaced as a whole, by version


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S")


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    if not incremental._exists(spark, _path(root, name)):
        return None
    if name in PUBLISHED:
        return sinks.published(spark, _path(root, name))
    return sinks.read_consistent(spark, _path(root, name))


def run_ingest(spark: SparkSession, a) -> None:
    cfg = sing.IngestConfig(
        fact_path=_path(a.root, "raw_prices"), dlq_path=_path(a.root, "dead_letter_events"),
        metrics_path=_path(a.root, "batch_metrics"),
        checkpoint=a.checkpoint or _path(a.root, "_checkpoints/ingest"),
        source_format=a.source_format, source_path=a.source_path,
        bootstrap_servers=a.bootstrap, topic=a.topic, starting_offsets=a.starting_offsets,
        fail_on_data_loss=a.fail_on_data_loss, max_per_trigger=a.max_per_trigger,
        trigger_seconds=a.trigger_seconds, available_now=a.available_now,
        stream_instance_id=a.instance_id, latest_path=_path(a.root, "latest_prices_state"))
    if cfg.available_now:
        sing.start_ingest(spark, cfg).awaitTermination()
        return
    with sing.StopRequest() as stop:   # a continuous query ends on SIGTERM / SIGINT
        sing.run_until_stopped(sing.start_ingest(spark, cfg), stop)


def run_marts(spark: SparkSession, a) -> dict:
    """Incremental builds of the three marts, then the latest-price table
    (from the state the ingest stream maintains when present, else computed)."""
    raw = _table(spark, a.root, "raw_prices")
    if raw is None:
        return {}
    # typed columns plus the date partition, so slices prune partitions
    stg = raw.select(*[F.col(c).cast(t).alias(c) for c, t in marts.STG_COLUMNS], "event_date")
    out = {}
    for name, (factory, keys, bucket, lookback) in MART_SPECS.items():
        out[name] = incremental.run(spark, factory(a.as_of), stg, _path(a.root, name), keys, bucket,
                                    lookback, a.as_of, empty_fallback=None if getattr(a, "rebuild_emptied", False) else incremental.EMPTY_FALLBACK)
    state = sinks.published(spark, _path(a.root, "latest_prices_state"))
    latest = marts.latest_view(state) if state is not None else marts.latest_prices(stg, a.as_of)
    sinks.publish(latest, _path(a.root, "mart_latest_prices"))
    return out


def run_checks(spark: SparkSession, a) -> DataFrame:
    """All data checks; results appended to ``check_results`` and summarised
    into one ``test_runs`` row; the age of the fact table is one more check."""
    raw = spark.read.parquet(_path(a.root, "raw_prices"))
    tables = {"stg_raw_prices": marts.stg_raw_prices(raw)}
    for name in ["mart_latest_prices", *MART_SPECS]:
        t = _table(spark, a.root, name)
        if t is not None:
            tables[name] = t.drop("bucket_date")
    specs = {k: v for k, v in quality.default_specs().items() if k in tables}
    fresh = monitor.source_freshness(raw, "ingest_ts", a.as_of).select(
        F.lit("raw_prices").alias("table_name"), F.lit("freshness:ingest_ts").alias("check_name"),
        F.when(F.col("status") == "pass", 0).otherwise(1).cast("bigint").alias("failures"), "status")
    res = quality.run_checks(tables, specs).unionByName(fresh).withColumn("run_ts_utc", ts_lit(a.as_of))
    res.write.mode("append").parquet(_path(a.root, "check_results"))
    saved = spark.read.parquet(_path(a.root, "check_results")).filter(F.col("run_ts_utc") == ts_lit(a.as_of))
    summary = quality.summarise(saved, environment=a.environment)
    sinks.append_log(summary, _path(a.root, "test_runs"))
    if getattr(a, "results", None):   # run documents of another test runner
        runs = quality.document_runs(quality.read_test_documents(spark, a.results), a.environment)
        sinks.append_log(runs.select(*summary.columns), _path(a.root, "test_runs"))
    return summary


def run_alerts(spark: SparkSession, a) -> DataFrame:
    """Metric snapshot at ``as_of`` -> rule evaluation rows appended to ``alert_evaluations``."""
    def t(name, schema):
        df = _table(spark, a.root, name)
        return df if df is not None else spark.createDataFrame([], schema)
    raw = t("raw_prices", "commodity string, ingest_ts timestamp_ntz, event_ts timestamp_ntz")
    metrics = monitor.metric_results(spark, monitor.metric_queries(
        a.as_of, raw=raw,
        calls=t("api_calls", "ts_utc timestamp_ntz, ok boolean"),
        dlq=t("dead_letter_events", "ts_utc timestamp_ntz"),
        lag_log=t("kafka_lag", "group_id string, topic string, ts_utc timestamp_ntz, "
                               "total_lag bigint, max_partition_lag bigint"),
        runs=t("test_runs", "run_ts_utc timestamp_ntz, status string"),
        backups=t("backup_log", "backup_ts timestamp_ntz, status string"),
        latest=t("mart_latest_prices", "last_timestamp timestamp_ntz"),
        group_id=a.group_id, topic=a.topic))
    ev = monitor.evaluate_rules(metrics, monitor.rules_df(spark)).withColumn("ts", ts_lit(a.as_of))
    sinks.append_log(ev, _path(a.root, "alert_evaluations"))
    # the state of each rule follows from all its evaluations: a condition fires once it has held long enough
    stored = spark.read.schema(ev.schema).parquet(_path(a.root, "alert_evaluations"))
    sinks.publish(monitor.alert_timeline(stored.select("rule_uid", "ts", "value", "error"), monitor.rules_df(spark)),
                  _path(a.root, "alert_states"))
    return ev


def run_api_calls(spark: SparkSession, a) -> DataFrame:
    """Stored API responses (call_id, ts_utc, symbols, http_status, latency_ms, body), classified and
    appended to ``api_calls``."""
    calls = spark.read.schema(API_CALL_SCHEMA).format(a.format).load(a.input)
    rows = ingest.classify_api_calls(calls)
    sinks.append_log(rows, _path(a.root, "api_calls"))
    return rows


def run_lag(spark: SparkSession, a) -> DataFrame:
    """A lag snapshot from broker watermarks and the stored offsets, appended to ``kafka_lag``."""
    raw = _table(spark, a.root, "raw_prices")
    if raw is None:
        raw = spark.createDataFrame([], "kafka_partition int, kafka_offset bigint")
    lag = monitor.consumer_lag(readers.read_watermarks(spark, a.input, a.format), raw)
    rows = lag.select(F.lit(a.group_id).alias("group_id"), F.lit(a.topic).alias("topic"), ts_lit(a.as_of).alias("ts_utc"),
                      "total_lag", "max_partition_lag")
    sinks.append_log(rows, _path(a.root, "kafka_lag"))
    return rows


def run_alert_events(spark: SparkSession, a) -> DataFrame:
    """Alert webhook bodies, one JSON document per line, flattened and appended to ``alert_events``."""
    bodies = readers.read_alert_payloads(spark, a.input)
    rows = ingest.flatten_alerts(bodies.withColumnRenamed("received_ts", "ts_utc"))
    sinks.append_log(rows, _path(a.root, "alert_events"))
    return rows


def run_retention(spark: SparkSession, a) -> dict:
    cutoff = spark.range(1).select(minus(a.as_of, f"{a.days} days").alias("c")).collect()[0]["c"]
    done = {}
    for name, col in LOG_TABLES.items():
        if incremental._exists(spark, _path(a.root, name)):
            done[name] = sinks.apply_retention(spark, _path(a.root, name), col, cutoff)
    ids = IdTable(_path(a.root, "raw_prices_ids"))
    if ids.exists(spark):   # ids whose facts are gone may come again
        ids.forget(spark.read.parquet(_path(a.root, "raw_prices")), str(cutoff)[:10])
    return done


def run_compact(spark: SparkSession, a) -> dict:
    """Folds the facts of closed dates (before the day of ``as_of``) and crowded buckets of the table of ids."""
    path = _path(a.root, "raw_prices")
    if not sinks.path_exists(spark, path):
        return {}
    fs, root = sinks._fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    closed = [n.partition("=")[2] for n in names if n.startswith("event_date=") and n.partition("=")[2] < str(a.as_of)[:10]]
    ids = IdTable(_path(a.root, "raw_prices_ids"))
    return {"dates": sinks.compact(spark, path, dates=closed), "buckets": ids.fold(spark) if ids.exists(spark) else []}


JOBS = {"ingest": run_ingest, "compact": run_compact, "marts": run_marts, "checks": run_checks, "alerts": run_alerts,
        "retention": run_retention, "api-calls": run_api_calls, "lag": run_lag, "alert-events": run_alert_events}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in JOBS:
        s = sub.add_parser(name)
        s.add_argument("--root", required=True)
        s.add_argument("--as-of", dest="as_of", default=None)
        s.add_argument("--master", default=None)
        if name == "ingest":
            s.add_argument("--source-format", default="kafka")
            s.add_argument("--source-path", default=None)
            s.add_argument("--bootstrap", default="localhost:9092")
            s.add_argument("--starting-offsets", default="earliest")
            s.add_argument("--fail-on-data-loss", default="false")
            s.add_argument("--max-per-trigger", type=int, default=None)
            s.add_argument("--trigger-seconds", type=int, default=300)
            s.add_argument("--available-now", action="store_true")
            s.add_argument("--checkpoint", default=None)
            s.add_argument("--instance-id", default="stream1")
        if name in ("api-calls", "lag", "alert-events"):
            s.add_argument("--input", required=True)
            s.add_argument("--format", default="json")
        if name in ("ingest", "alerts", "lag"):
            s.add_argument("--topic", default="prices")
        if name in ("alerts", "lag"):
            s.add_argument("--group-id", default="tick_ingest")
        if name == "marts":
            s.add_argument("--rebuild-emptied", action="store_true")
        if name == "checks":
            s.add_argument("--environment", default="dev")
            s.add_argument("--results", default=None)
        if name == "retention":
            s.add_argument("--days", type=int, default=90)
    return p


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    a.as_of = a.as_of or _now()
    spark = build_session(a.master, app=f"tickflow-{a.cmd}")
    JOBS[a.cmd](spark, a)
