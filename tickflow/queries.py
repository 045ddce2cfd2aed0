"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the driver tables under ``sf_dir`` (through the fixture
derivations) and runs a library function over the whole input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow import dims
from tickflow import session as tsession
from tickflow.functions import calendar, ids
from tickflow.functions.timeutil import default_as_of, minus, trunc, ts_lit
from tickflow.operators import dashboards, ingest, marts, monitor, quality, validate
from tickflow.plans import id_table, incremental, sinks
from tickflow.plans.id_table import IdTable
from tickflow.session import scratch_path
from tickflow.sources import fixtures as fx
from tickflow.sources import readers
from tickflow.streaming import alerts as salerts
from tickflow.streaming import ingest as sing
from tickflow.streaming import marts as smarts
from tickflow.streaming import ordered as sordered
from tickflow.streaming import progress as sprogress


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tsession.configure(spark)
    return fx.read_events(spark, sf_dir)


def _stg(spark, sf_dir, variant=fx.ticks) -> DataFrame:
    return marts.stg_raw_prices(variant(_events(spark, sf_dir)))


_MEMO: dict = {}


def _memo(spark, key, fn):
    """Per-session memo for scalars and written tables derived from the input."""
    k = (spark.sparkContext.applicationId, key)
    if k not in _MEMO:
        _MEMO[k] = fn()
    return _MEMO[k]


def _as_of(spark, sf_dir):
    return _memo(spark, ("as_of", sf_dir), lambda: default_as_of(fx.ticks(_events(spark, sf_dir))))


def q_stg_ticks(spark, sf_dir):
    return _stg(spark, sf_dir)


def q_price_volatility_1h(spark, sf_dir):
    return marts.price_volatility_1h(_stg(spark, sf_dir), _as_of(spark, sf_dir))


def q_price_volatility_extreme(spark, sf_dir):
    """Prices far outside what decimals hold stop no hour from being built."""
    return marts.price_volatility_1h(_stg(spark, sf_dir, fx.ticks_extreme), _as_of(spark, sf_dir))


def q_minute_last_price(spark, sf_dir):
    return marts.minute_last_price(_stg(spark, sf_dir))


def q_latest_prices(spark, sf_dir):
    return marts.latest_prices(_stg(spark, sf_dir, fx.ticks_stale_instrument), _as_of(spark, sf_dir))


def q_latest_prices_single_pass(spark, sf_dir):
    return marts.latest_prices_single_pass(_stg(spark, sf_dir, fx.ticks_stale_instrument))


def q_price_events(spark, sf_dir):
    return marts.price_events(_stg(spark, sf_dir))


def q_price_events_join(spark, sf_dir):
    """Move classes by thresholds from a table."""
    return marts.price_events(_stg(spark, sf_dir), thresholds=dims.thresholds_df(spark))


def q_price_jumps(spark, sf_dir):
    return quality.price_jumps(marts.minute_last_price(_stg(spark, sf_dir, fx.ticks_spiked)))


# ---------------------------------------------------------------- ingest side

def _validated(spark, sf_dir, payloads=fx.raw_payloads) -> DataFrame:
    env = _memo(spark, ("envelope", sf_dir, payloads.__name__),
                lambda: fx.materialize(payloads(_events(spark, sf_dir)), "envelope"))
    typed = ingest.parse_and_type(env, ingest_ts=F.col("kafka_timestamp"))
    return validate.with_error_reason(typed)


def q_validate_ticks(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "kafka_partition", "kafka_offset", "event_id", "commodity", "symbol", "price", "currency",
        "event_ts", "source", "schema_version", "ingest_interval_sec", "error_reason")


def q_kafka_envelope(spark, sf_dir):
    """Kafka source rows (value, topic, partition, offset, timestamp) unwrapped."""
    env = fx.raw_payloads(_events(spark, sf_dir))
    rows = env.select(F.col("kafka_topic").cast("binary").alias("key"), F.col("raw_payload").cast("binary").alias("value"),
                      F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"),
                      F.col("kafka_offset").alias("offset"), F.col("kafka_timestamp").cast("timestamp").alias("timestamp"))
    return ingest.unwrap_kafka(rows)


def q_validate_ticks_join(spark, sf_dir):
    """Validation with the bounds from a table."""
    env = fx.raw_payloads(_events(spark, sf_dir))
    typed = ingest.parse_and_type(env, ingest_ts=F.col("kafka_timestamp"))
    return validate.with_error_reason_join(typed, dims.bounds_df(spark)).select("kafka_partition", "kafka_offset", "error_reason")


def q_built_events(spark, sf_dir):
    """Wire events as published: key and the value read back."""
    prices = _stg(spark, sf_dir).select("commodity", "symbol", "price", F.col("event_ts").alias("ts"))
    rows = ingest.to_kafka_rows(ingest.build_events(prices, "rest_api", 360))
    return rows.select("key", F.from_json("value", ingest.EVENT_SCHEMA).alias("e")).select("key", "e.*")


def q_stored_ticks_as_of(spark, sf_dir):
    """The stored fact table read as of an instant."""
    path = scratch_path(spark, "facts")
    _stg(spark, sf_dir).withColumn("event_date", F.to_date("event_ts")).write.partitionBy("event_date").parquet(path)
    return readers.read_table(spark, path, as_of=UPSERT_CUTOFF).drop("event_date")


def q_watermark_lag(spark, sf_dir):
    """Lag per partition from watermarks stored as JSON."""
    path = scratch_path(spark, "watermarks")
    fx.watermarks(_events(spark, sf_dir)).write.json(path)
    return monitor.partition_lag(readers.read_watermarks(spark, path), _good(spark, sf_dir)).select("partition", "lag")


def q_dlq_rows(spark, sf_dir):
    v = _validated(spark, sf_dir, fx.replayed_payloads)
    _, bad = validate.split(v, fx.STREAM_INSTANCE, fx.micro_batch_id())
    return sinks.dedupe_dlq(bad)


def q_batch_counts(spark, sf_dir):
    v = _validated(spark, sf_dir, fx.replayed_payloads).withColumn("batch_id", fx.micro_batch_id())
    return validate.batch_counts(v, ["batch_id"])


def q_error_reason_counts(spark, sf_dir):
    v = _validated(spark, sf_dir)
    _, bad = validate.split(v, fx.STREAM_INSTANCE, fx.micro_batch_id())
    return monitor.dlq_by_reason(bad, _as_of(spark, sf_dir))


def q_fx_gate(spark, sf_dir):
    t = _stg(spark, sf_dir)
    return t.select("event_id", "symbol", "event_ts",
                    calendar.fx_closed("event_ts").alias("fx_closed"),
                    calendar.should_publish("symbol", "event_ts").alias("publish"))


def _instants(spark, sf_dir) -> DataFrame:
    return _stg(spark, sf_dir).select(trunc("hour", "event_ts").alias("instant")).distinct()


def q_market_status(spark, sf_dir):
    return calendar.market_status(_instants(spark, sf_dir))


def q_active_symbols(spark, sf_dir):
    return calendar.active_symbols(_instants(spark, sf_dir))


def q_within_bounds(spark, sf_dir):
    t = _stg(spark, sf_dir)
    scale = (F.when(F.col("event_id").cast("bigint") % 5 == 0, F.lit(1000.0))
             .when(F.col("event_id").cast("bigint") % 5 == 1, F.lit(0.001)).otherwise(F.lit(1.0)))
    x = t.select("event_id", "symbol", (F.col("price") * scale).alias("price_checked"))
    return x.withColumn("within_bounds", validate.within_bounds("symbol", "price_checked"))


def q_event_uuid5(spark, sf_dir):
    t = _stg(spark, sf_dir)
    name = F.concat(F.col("commodity"), F.lit(":"), ids.iso_seconds("event_ts"))
    return t.select("event_id", name.alias("name"), ids.uuid5(name).alias("uuid"))


def q_price_responses(spark, sf_dir):
    return ingest.flatten_price_responses(fx.api_calls_raw(_events(spark, sf_dir)))


def q_api_call_classes(spark, sf_dir):
    return ingest.classify_api_calls(fx.api_calls_raw(_events(spark, sf_dir)))


# ---------------------------------------------------------------- write paths

def _good(spark, sf_dir, payloads=fx.raw_payloads) -> DataFrame:
    good, _ = validate.split(_validated(spark, sf_dir, payloads), fx.STREAM_INSTANCE, 0)
    return good


def _bad(spark, sf_dir, payloads=fx.raw_payloads) -> DataFrame:
    _, bad = validate.split(_validated(spark, sf_dir, payloads), fx.STREAM_INSTANCE,
                            fx.micro_batch_id())
    return bad


FACT_COLUMNS = ["event_id", "commodity", "symbol", "price", "currency", "event_ts", "source",
                "kafka_partition", "kafka_offset"]


def q_insert_new(spark, sf_dir):
    """Replayed batch -> rows not yet stored (stored = every 4th tick, every 8th under
    another date than the batch's), by the bucketed table of the stored ids."""
    shift = F.when(F.col("event_id").cast("bigint") % 8 == 0, 1).otherwise(0)
    target = _stg(spark, sf_dir).filter(F.col("event_id").cast("bigint") % 4 == 0)
    ids = IdTable(scratch_path(spark, "stored-ids"))
    ids.build(target, F.date_add(F.to_date("event_ts"), shift))
    return id_table.new_rows(_good(spark, sf_dir, fx.replayed_payloads), ids).select(*FACT_COLUMNS)


def q_insert_new_scan(spark, sf_dir):
    """The same without a table of ids: the facts' whole id column is scanned."""
    shift = F.when(F.col("event_id").cast("bigint") % 8 == 0, 1).otherwise(0)
    target = (_stg(spark, sf_dir).filter(F.col("event_id").cast("bigint") % 4 == 0)
              .withColumn("event_date", F.date_add(F.to_date("event_ts"), shift)))
    new = sinks.new_rows(_good(spark, sf_dir, fx.replayed_payloads), target, scope="full")
    return new.select(*FACT_COLUMNS)


UPSERT_CUTOFF = "2024-01-20 00:00:00"


def _arrivals(spark, sf_dir) -> DataFrame:
    late = F.col("event_id").cast("bigint") % 50 == 0
    return _stg(spark, sf_dir).withColumn(
        "arrival_ts", F.when(late, F.col("event_ts") + F.expr("INTERVAL 45 MINUTES"))
        .otherwise(F.col("ingest_ts")))


def q_upsert_minute(spark, sf_dir):
    """Two builds of the minute mart: full over arrivals before the cutoff,
    then an incremental run (30-minute lookback) over everything."""
    arr = _arrivals(spark, sf_dir)
    path = scratch_path(spark, "mart_minute_last_price")
    keys = ["commodity", "symbol", "minute_bucket"]
    as_of = _as_of(spark, sf_dir)
    incremental.run(spark, incremental.minute_model, arr.filter(F.col("arrival_ts") < ts_lit(UPSERT_CUTOFF)),
                    path, keys, "minute_bucket", "30 minutes", as_of)
    incremental.run(spark, incremental.minute_model, arr, path, keys, "minute_bucket", "30 minutes", as_of)
    return sinks.read_mart(spark, path).select("commodity", "symbol", "minute_bucket", "last_price", "n",
                                           "min_price", "max_price")


def q_minute_last_price_ties(spark, sf_dir):
    """Timestamps truncated to the minute: the last price is decided by event_id."""
    return marts.minute_last_price(_stg(spark, sf_dir, fx.ticks_minute_ties))


def q_price_events_ties(spark, sf_dir):
    return marts.price_events(_stg(spark, sf_dir, fx.ticks_minute_ties))


def q_upsert_new_column(spark, sf_dir):
    """The minute mart built without ``n``; the next build has ``n`` and ``price_range`` and no ``min_price``: the mart's columns follow."""
    arr = _arrivals(spark, sf_dir)
    path = scratch_path(spark, "mart_minute_changed")
    keys = ["commodity", "symbol", "minute_bucket"]
    as_of = _as_of(spark, sf_dir)
    incremental.run(spark, lambda src, since: marts.minute_last_price(src, since).drop("n"),
                    arr.filter(F.col("arrival_ts") < ts_lit(UPSERT_CUTOFF)), path, keys, "minute_bucket", "30 minutes", as_of)
    incremental.run(spark, lambda src, since: marts.minute_last_price(src, since)
                    .withColumn("price_range", F.col("max_price") - F.col("min_price")).drop("min_price"),
                    arr, path, keys, "minute_bucket", "30 minutes", as_of)
    return sinks.read_mart(spark, path).drop("bucket_date")


def q_upsert_price_events(spark, sf_dir):
    """Events mart: full build over arrivals before the cutoff, then an
    incremental run with the 2-hour lookback (first slice row has no
    predecessor; older stored events survive, as in the original)."""
    arr = _arrivals(spark, sf_dir)
    path = scratch_path(spark, "mart_price_events")
    keys = ["commodity", "symbol", "event_ts"]
    as_of = _as_of(spark, sf_dir)
    incremental.run(spark, incremental.events_model, arr.filter(F.col("arrival_ts") < ts_lit(UPSERT_CUTOFF)),
                    path, keys, "event_ts", "2 hours", as_of)
    incremental.run(spark, incremental.events_model, arr, path, keys, "event_ts", "2 hours", as_of)
    return spark.read.parquet(path).drop("bucket_date")


def q_upsert_volatility(spark, sf_dir):
    """Volatility mart: completed hours as of the cutoff, then an incremental
    run as of the final instant with the 2-hour lookback."""
    arr = _arrivals(spark, sf_dir)
    path = scratch_path(spark, "mart_price_volatility_1h")
    keys = ["commodity", "symbol", "hour_bucket"]
    as_of = _as_of(spark, sf_dir)
    incremental.run(spark, incremental.volatility_model(UPSERT_CUTOFF),
                    arr.filter(F.col("arrival_ts") < ts_lit(UPSERT_CUTOFF)),
                    path, keys, "hour_bucket", "2 hours", UPSERT_CUTOFF)
    incremental.run(spark, incremental.volatility_model(as_of), arr, path, keys, "hour_bucket",
                    "2 hours", as_of)
    return spark.read.parquet(path).drop("bucket_date")


RETENTION_DAYS = 14


def q_retention(spark, sf_dir):
    """Fact table written by date, then rows older than as_of - 14 days removed."""
    path = scratch_path(spark, "raw_prices")
    _stg(spark, sf_dir).withColumn("event_date", F.to_date("event_ts")) \
        .write.partitionBy("event_date").parquet(path)
    as_of = _as_of(spark, sf_dir)
    cutoff = spark.range(1).select(minus(as_of, f"{RETENTION_DAYS} days").alias("c")).collect()[0]["c"]
    sinks.apply_retention(spark, path, "event_ts", cutoff, "event_date")
    return spark.read.parquet(path).select(*[c for c, _ in marts.STG_COLUMNS])


# ---------------------------------------------------------------- monitoring

def q_health_metrics(spark, sf_dir):
    return monitor.pipeline_metrics(_stg(spark, sf_dir), _as_of(spark, sf_dir))


def q_health_metrics_late(spark, sf_dir):
    """Late ticks (old event dates, just ingested) count as ingested."""
    return monitor.pipeline_metrics(_stg(spark, sf_dir, fx.ticks_late), _as_of(spark, sf_dir))


def q_api_metrics_18m(spark, sf_dir):
    return monitor.api_metrics(fx.api_calls(_events(spark, sf_dir)), _as_of(spark, sf_dir), 18)


def q_api_status_histogram(spark, sf_dir):
    return monitor.api_status(fx.api_calls(_events(spark, sf_dir)), _as_of(spark, sf_dir), 15)


def q_api_latency_p95(spark, sf_dir):
    return monitor.api_p95(fx.api_calls(_events(spark, sf_dir)), _as_of(spark, sf_dir), 60)


def q_consumer_lag(spark, sf_dir):
    return monitor.consumer_lag(fx.watermarks(_events(spark, sf_dir)), _good(spark, sf_dir))


def q_kafka_lag_latest(spark, sf_dir):
    return monitor.lag_latest(fx.kafka_lag_log(_events(spark, sf_dir)))


def q_dlq_per_day(spark, sf_dir):
    return monitor.dlq_per_day(_bad(spark, sf_dir), _as_of(spark, sf_dir), 7)


def q_dlq_rate(spark, sf_dir):
    return monitor.dlq_rate(_validated(spark, sf_dir), _as_of(spark, sf_dir), 7)


def q_freshness(spark, sf_dir):
    as_of = _as_of(spark, sf_dir)
    stg = _stg(spark, sf_dir)
    backups = fx.backup_log(_events(spark, sf_dir)).filter(F.col("status") == "OK")
    parts = [
        monitor.freshness_seconds(stg, "ingest_ts", as_of).select(F.lit("ingest").alias("source"), "seconds"),
        monitor.freshness_seconds(backups, "backup_ts", as_of).select(F.lit("backup").alias("source"), "seconds"),
        monitor.freshness_seconds(marts.latest_prices(stg, as_of), "last_timestamp", as_of)
        .select(F.lit("mart_latest_prices").alias("source"), "seconds"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_throughput_per_cycle(spark, sf_dir):
    return monitor.throughput(_stg(spark, sf_dir), "6 minutes")


def q_table_summary(spark, sf_dir):
    return monitor.table_summary(_stg(spark, sf_dir))


def _mart_tables(spark, sf_dir) -> dict:
    stg = _stg(spark, sf_dir)
    as_of = _as_of(spark, sf_dir)
    return {
        "stg_raw_prices": stg,
        "mart_latest_prices": marts.latest_prices(stg, as_of),
        "mart_minute_last_price": marts.minute_last_price(stg),
        "mart_price_events": marts.price_events(stg),
        "mart_price_volatility_1h": marts.price_volatility_1h(stg, as_of),
    }


def q_quality_results(spark, sf_dir):
    return quality.run_checks(_mart_tables(spark, sf_dir), quality.default_specs())


def q_test_run_summary(spark, sf_dir):
    return quality.summarise(fx.test_results(_events(spark, sf_dir)))


def _metric_tables(spark, sf_dir) -> dict:
    ev = _events(spark, sf_dir)
    as_of = _as_of(spark, sf_dir)
    stg = _stg(spark, sf_dir)
    return dict(raw=stg, calls=fx.api_calls(ev), dlq=_bad(spark, sf_dir),
                lag_log=fx.kafka_lag_log(ev), runs=quality.summarise(fx.test_results(ev)),
                backups=fx.backup_log(ev), latest=marts.latest_prices(stg, as_of),
                group_id=fx.CONSUMER_GROUP, topic=fx.TOPIC)


def q_alert_rules(spark, sf_dir):
    metrics = monitor.metric_snapshot(_as_of(spark, sf_dir), **_metric_tables(spark, sf_dir))
    return monitor.evaluate_rules(metrics, monitor.rules_df(spark))


def q_alert_rules_error(spark, sf_dir):
    """The same while the backup log cannot be read: its rule fires by its error state, the ten others are evaluated."""
    tables = _metric_tables(spark, sf_dir)
    broken = F.raise_error(F.lit("backup log is unreadable")).cast("string")
    tables["backups"] = tables["backups"].withColumn("status", F.when(F.col("backup_ts").isNotNull(), broken).otherwise(F.col("status")))
    results = monitor.metric_results(spark, monitor.metric_queries(_as_of(spark, sf_dir), **tables))
    return monitor.evaluate_rules(results, monitor.rules_df(spark)).drop("error")


def _write_test_documents(spark, sf_dir) -> str:
    """A run-results document per day, that of every 7th day broken off in the middle."""
    path = scratch_path(spark, "test-documents")
    results = fx.test_results(_events(spark, sf_dir)).withColumn("day", F.to_date("run_ts_utc"))
    result = F.struct("unique_id", "status", F.lit(0).cast("bigint").alias("failures"))
    days = results.groupBy("day").agg(F.collect_list(result).alias("results"))
    text = F.to_json(F.struct(F.struct(F.concat(F.col("day").cast("string"), F.lit("T12:00:00Z")).alias("generated_at")).alias("metadata"), "results"))
    cut = F.when(F.dayofmonth("day") % 7 == 0, F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))).otherwise(text)
    days.select("day", cut.alias("value")).write.partitionBy("day").text(path)
    return path


def q_test_documents(spark, sf_dir):
    """Run-results documents as test runs, each by its folder's day; a broken one is a failed run."""
    docs = quality.read_test_documents(spark, _write_test_documents(spark, sf_dir) + "/*/*.txt")
    day = F.regexp_extract("file", "day=([0-9-]+)", 1).cast("date").alias("day")
    return quality.document_runs(docs, keep=["file"]).select(day, "environment", "status", "total", *quality.TEST_STATUSES, "broken")


def q_alert_timeline(spark, sf_dir):
    return monitor.alert_timeline(fx.alert_samples(_events(spark, sf_dir)), monitor.rules_df(spark))


def q_alert_payloads(spark, sf_dir):
    return ingest.flatten_alerts(fx.alert_payloads(_events(spark, sf_dir)))


# ---------------------------------------------------------------- dashboards

def q_price_statistics(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    return dashboards.price_statistics(marts.price_volatility_1h(stg, _as_of(spark, sf_dir)),
                                       marts.price_events(stg))


def q_hourly_price_change(spark, sf_dir):
    as_of = _as_of(spark, sf_dir)
    vol = marts.price_volatility_1h(_stg(spark, sf_dir), as_of)
    lo = spark.range(1).select(minus(as_of, "7 days").alias("c")).collect()[0]["c"]
    return dashboards.hourly_change(vol, lo, as_of)


def q_recent_price_events(spark, sf_dir):
    return dashboards.recent_events(marts.price_events(_stg(spark, sf_dir)), 100)


def q_last_update_label(spark, sf_dir):
    return dashboards.last_update(_stg(spark, sf_dir), "bitcoin")


def q_price_events_bucketed(spark, sf_dir):
    """The same mart with plain clock-hour buckets instead of adaptive ones."""
    return marts.price_events(_stg(spark, sf_dir), bucket="hour")


def q_source_freshness(spark, sf_dir):
    return monitor.source_freshness(_stg(spark, sf_dir), "ingest_ts", _as_of(spark, sf_dir), 10, 20)


def q_newest_raw_rows(spark, sf_dir):
    return dashboards.newest(_stg(spark, sf_dir), ["ingest_ts", "event_id"], 20)


def q_newest_test_runs(spark, sf_dir):
    return dashboards.newest(quality.summarise(fx.test_results(_events(spark, sf_dir))), ["run_ts_utc"], 5)


def q_test_pass_rate(spark, sf_dir):
    return quality.pass_rate(quality.summarise(fx.test_results(_events(spark, sf_dir))),
                             _as_of(spark, sf_dir), 24)


def q_ingest_idle_time(spark, sf_dir):
    return monitor.idle_time(_stg(spark, sf_dir), "ingest_ts", "event_id", 360)


def q_api_idle_time(spark, sf_dir):
    return monitor.idle_time(fx.api_calls(_events(spark, sf_dir)), "ts_utc", "call_id", 360)


# ---------------------------------------------------------------- streaming

def _run_to_table(stream: DataFrame, name: str, spark) -> DataFrame:
    """Run a streaming query to completion (availableNow) into a Parquet sink
    under the shared checkpoint folder and return the sink as a table."""
    out, ckpt = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def _tick_stream(spark, sf_dir, df: DataFrame | None = None) -> DataFrame:
    t = df if df is not None else _stg(spark, sf_dir)
    src = fx.materialize(t, "tick-source")
    return spark.readStream.schema(src.schema).parquet(src.inputFiles()[0].rsplit("/", 1)[0])


def q_streaming_hourly(spark, sf_dir):
    return _run_to_table(smarts.hourly(_tick_stream(spark, sf_dir)), "stream-hourly", spark)


def q_streaming_dedup(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    doubled = stg.unionByName(stg.filter(F.col("event_id").cast("bigint") % 10 == 0))
    return _run_to_table(smarts.dedup(_tick_stream(spark, sf_dir, doubled), "2 hours"),
                         "stream-dedup", spark).select(*[c for c, _ in marts.STG_COLUMNS])


def q_streaming_moves(spark, sf_dir):
    return _run_to_table(smarts.moves(_tick_stream(spark, sf_dir)), "stream-moves", spark)


PIECES = 4
#: Rows of a source file about; the files of a micro-batch grow in number with the input.
FILE_ROWS = 100_000


def _in_pieces(spark, sf_dir, late: str, by_date: bool = False) -> tuple[str, DataFrame, int]:
    """Ticks as files of ``PIECES`` equal spans of time, oldest first, and the number of files of a span; ticks with
    ``late`` come with the next span, or with ``by_date`` (under their event dates) with the last."""
    stg = _stg(spark, sf_dir)
    bounds = stg.agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi")).first()
    span = (F.unix_micros(ts_lit(bounds["hi"]).cast("timestamp")) - F.unix_micros(ts_lit(bounds["lo"]).cast("timestamp"))) / PIECES + 1
    place = (F.unix_micros(F.col("event_ts").cast("timestamp")) - F.unix_micros(ts_lit(bounds["lo"]).cast("timestamp"))) / span
    piece = F.floor(place)
    moved = F.when(F.expr(late), F.lit(PIECES - 1) if by_date else F.least(piece + (place - piece > 0.95).cast("int"), F.lit(PIECES - 1))).otherwise(piece)
    rows = fx.materialize(stg.withColumn("piece", moved.cast("int")), "tick-pieces")
    path = scratch_path(spark, "tick-files")
    most = max((r["count"] for r in rows.groupBy("piece").count().collect()), default=0)  # a row per piece
    files = max(1, -(-most // FILE_ROWS))

    def write_span(span_rows: DataFrame, i: int) -> None:
        span_rows.repartition(files).write.mode("append").parquet(path)
        for _ in range((i + 1) * files - len(spark.read.parquet(path).inputFiles())):  # a trigger takes as many files of every span
            span_rows.limit(0).coalesce(1).write.mode("append").parquet(path)

    for i in range(PIECES):
        mine = rows.filter(F.col("piece") == i).drop("piece")
        if by_date:
            mine.withColumn("event_date", F.to_date("event_ts")).repartition("event_date").write.mode("append").partitionBy("event_date").parquet(path)
        else:
            if i == PIECES - 1:  # a tick of no instrument, two days on, lets the watermark pass all others
                clock = mine.limit(1).withColumn("event_ts", ts_lit(bounds["hi"]) + F.expr("INTERVAL 2 DAYS")).withColumn("symbol", F.lit("CLOCK"))
                write_span(mine, i)
                clock.coalesce(1).write.mode("append").parquet(path)
            else:
                write_span(mine, i)
    return path, stg, files


def q_streaming_moves_late(spark, sf_dir):
    """Moves over several micro-batches, every 5th tick of a span's last twentieth coming one batch late."""
    path, stg, files = _in_pieces(spark, sf_dir, "cast(event_id as bigint) % 5 = 0")
    stream = spark.readStream.schema(stg.schema).option("maxFilesPerTrigger", files).parquet(path)
    return _run_to_table(sordered.moves_in_order(stream, "1 day"), "stream-moves-late", spark)


def q_streaming_hourly_late(spark, sf_dir):
    """The hourly mart kept by a stream over the fact table, every 20th tick coming with the last files, days late."""
    path, *_ = _in_pieces(spark, sf_dir, "cast(event_id as bigint) % 20 = 0", by_date=True)
    mart = scratch_path(spark, "hourly-mart")
    files = len(spark.read.parquet(path).inputFiles())
    sordered.start_hours(spark, path, mart, scratch_path(spark, "hourly-ckpt"), as_of=_as_of(spark, sf_dir),
                         max_files=-(-files // PIECES), available_now=True).awaitTermination()
    return sinks.read_mart(spark, mart).drop("bucket_date")


def q_ingest_progress(spark, sf_dir):
    """What the ingest stream reports of itself over several micro-batches."""
    events = _events(spark, sf_dir)
    rows = events.count()
    files = max(2, -(-rows // (PIECES * FILE_ROWS)))
    src = scratch_path(spark, "progress-source")
    fx.raw_payloads(events).repartition(files * PIECES).write.parquet(src)
    cfg = sing.IngestConfig(
        fact_path=scratch_path(spark, "fact-p"), dlq_path=scratch_path(spark, "dlq-p"), metrics_path=scratch_path(spark, "metrics-p"),
        checkpoint=scratch_path(spark, "ckpt-p"), source_format="parquet", source_path=src, max_per_trigger=files, available_now=True)
    log = sprogress.ProgressLog(most=rows)
    spark.streams.addListener(log)
    try:
        sing.start_ingest(spark, cfg, "tick_ingest_progress").awaitTermination()
        log.ended.wait(120)
    finally:
        spark.streams.removeListener(log)
    p = log.take(spark)
    return p.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in ("input_rows", "good_rows", "bad_rows")],
                 F.count_if("over_limit").alias("over_limit"))


def q_alert_stream(spark, sf_dir):
    """Payload files as a stream, every 5th line twice in its file; run again with nothing new, and from the start beside it."""
    path, out = scratch_path(spark, "alert-files"), scratch_path(spark, "alert-events")
    lines = fx.alert_payloads(_events(spark, sf_dir))
    lines = lines.select("payload_id", F.translate("body", "\r\n", "  ").alias("value"))
    twice = F.when(F.col("payload_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    lines.withColumn("copy", F.explode(twice)).repartition(PIECES, "payload_id").select("value").write.text(path)
    checkpoint = scratch_path(spark, "alert-ckpt")
    for ckpt in (checkpoint, checkpoint, scratch_path(spark, "alert-ckpt-again")):
        salerts.start_alerts(spark, path, out, ckpt, max_files=1, available_now=True).awaitTermination()
    stored = spark.read.parquet(out)
    by_run = stored.groupBy(F.regexp_extract("batch_token", "^(.*)-[0-9]+$", 1).alias("run"), *[c for c in stored.columns if c not in ("batch_token", "received_ts")])
    rows = by_run.agg(F.count(F.lit(1)).alias("n")).drop("run")
    # two runs with the same payload ids: each row stands under both
    both = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("runs"))
    return both.groupBy(*[c for c in both.columns if c not in ("payload_id", "n", "runs")]).agg(
        F.sum("n").alias("alerts"), F.min("runs").alias("runs"), F.max("runs").alias("most_runs"))


def _ingest_files(spark) -> int:
    # files per write of the replay source: the session's shuffle parallelism,
    # so no single task writes a whole slice
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _ingest_source(spark, sf_dir) -> str:
    """The replayed envelope as files: originals first, re-publishes in later files."""
    ev = _events(spark, sf_dir)
    src = scratch_path(spark, "ingest-source")
    n = _ingest_files(spark)
    fx.raw_payloads(ev).repartition(n).write.parquet(src)
    again = fx.raw_payloads(ev.filter(F.col("event_id") % 10 == 0)) \
        .withColumn("kafka_offset", F.col("kafka_offset") + 10_000_000)
    again.repartition(n).write.mode("append").parquet(src)
    return src


def _ingest_run(spark, sf_dir) -> sing.IngestConfig:
    """One run of the ingest stream per session and input (shared by the
    queries that read its outputs): one write's files per micro-batch
    (originals, then re-publishes), the fact,
    DLQ, metrics and latest-price tables written under the shared folder."""
    def run():
        cfg = sing.IngestConfig(
            fact_path=scratch_path(spark, "fact"), dlq_path=scratch_path(spark, "dlq"),
            metrics_path=scratch_path(spark, "metrics"),
            checkpoint=scratch_path(spark, "ingest-ckpt"), source_format="parquet",
            source_path=_ingest_source(spark, sf_dir), max_per_trigger=_ingest_files(spark),
            available_now=True,
            latest_path=scratch_path(spark, "latest"))
        sing.start_ingest(spark, cfg).awaitTermination()
        return cfg
    return _memo(spark, ("ingest-run", sf_dir), run)


def q_stream_latest_prices(spark, sf_dir):
    """Latest price per instrument maintained by the ingest stream, batch by batch."""
    return marts.latest_view(sinks.published(spark, _ingest_run(spark, sf_dir).latest_path))


def q_stream_ingest(spark, sf_dir):
    """The replayed envelope as files (originals first, re-publishes later),
    ingested by the foreachBatch pipeline."""
    return spark.read.parquet(_ingest_run(spark, sf_dir).fact_path).select(*FACT_COLUMNS)


def q_ingest_metrics(spark, sf_dir):
    """What the ingest stream logged over all its micro-batches."""
    log = spark.read.parquet(_ingest_run(spark, sf_dir).metrics_path)
    return log.agg(*[F.sum(c).alias(c) for c in ("good_rows", "inserted", "conflict_skipped", "bad_rows", "dlq_write_failed")])


def q_ingest_replayed(spark, sf_dir):
    """The whole source ingested again under a new checkpoint: every id is stored already."""
    first = _ingest_run(spark, sf_dir)
    fact = scratch_path(spark, "fact-again")
    spark.read.parquet(first.fact_path).write.partitionBy("event_date", "batch_token").parquet(fact)
    again = replace(first, fact_path=fact, dlq_path=scratch_path(spark, "dlq-again"), metrics_path=scratch_path(spark, "metrics-again"),
                    checkpoint=scratch_path(spark, "ckpt-again"), latest_path=None)
    sing.start_ingest(spark, again, "tick_ingest_again").awaitTermination()
    return spark.read.parquet(fact).select(*FACT_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_ticks": q_stg_ticks,
    "price_volatility_1h": q_price_volatility_1h,
    "price_volatility_extreme": q_price_volatility_extreme,
    "minute_last_price": q_minute_last_price,
    "latest_prices": q_latest_prices,
    "latest_prices_single_pass": q_latest_prices_single_pass,
    "price_events": q_price_events,
    "price_events_join": q_price_events_join,
    "price_jumps": q_price_jumps,
    "validate_ticks": q_validate_ticks,
    "kafka_envelope": q_kafka_envelope,
    "validate_ticks_join": q_validate_ticks_join,
    "built_events": q_built_events,
    "stored_ticks_as_of": q_stored_ticks_as_of,
    "watermark_lag": q_watermark_lag,
    "dlq_rows": q_dlq_rows,
    "batch_counts": q_batch_counts,
    "error_reason_counts": q_error_reason_counts,
    "fx_gate": q_fx_gate,
    "market_status": q_market_status,
    "active_symbols": q_active_symbols,
    "within_bounds": q_within_bounds,
    "event_uuid5": q_event_uuid5,
    "price_responses": q_price_responses,
    "api_call_classes": q_api_call_classes,
    "insert_new": q_insert_new,
    "insert_new_scan": q_insert_new_scan,
    "upsert_minute": q_upsert_minute,
    "retention": q_retention,
    "minute_last_price_ties": q_minute_last_price_ties,
    "price_events_ties": q_price_events_ties,
    "upsert_new_column": q_upsert_new_column,
    "upsert_price_events": q_upsert_price_events,
    "upsert_volatility": q_upsert_volatility,
    "health_metrics": q_health_metrics,
    "health_metrics_late": q_health_metrics_late,
    "api_metrics_18m": q_api_metrics_18m,
    "api_status_histogram": q_api_status_histogram,
    "api_latency_p95": q_api_latency_p95,
    "consumer_lag": q_consumer_lag,
    "kafka_lag_latest": q_kafka_lag_latest,
    "dlq_per_day": q_dlq_per_day,
    "dlq_rate": q_dlq_rate,
    "freshness": q_freshness,
    "throughput_per_cycle": q_throughput_per_cycle,
    "table_summary": q_table_summary,
    "quality_results": q_quality_results,
    "test_run_summary": q_test_run_summary,
    "alert_rules": q_alert_rules,
    "alert_rules_error": q_alert_rules_error,
    "test_documents": q_test_documents,
    "alert_timeline": q_alert_timeline,
    "alert_payloads": q_alert_payloads,
    "price_statistics": q_price_statistics,
    "hourly_price_change": q_hourly_price_change,
    "recent_price_events": q_recent_price_events,
    "last_update_label": q_last_update_label,
    "price_events_bucketed": q_price_events_bucketed,
    "source_freshness": q_source_freshness,
    "ingest_idle_time": q_ingest_idle_time,
    "api_idle_time": q_api_idle_time,
    "newest_raw_rows": q_newest_raw_rows,
    "newest_test_runs": q_newest_test_runs,
    "test_pass_rate": q_test_pass_rate,
    "streaming_hourly": q_streaming_hourly,
    "streaming_dedup": q_streaming_dedup,
    "streaming_moves": q_streaming_moves,
    "streaming_moves_late": q_streaming_moves_late,
    "streaming_hourly_late": q_streaming_hourly_late,
    "ingest_progress": q_ingest_progress,
    "alert_stream": q_alert_stream,
    "stream_ingest": q_stream_ingest,
    "stream_latest_prices": q_stream_latest_prices,
    "ingest_metrics": q_ingest_metrics,
    "ingest_replayed": q_ingest_replayed,
}
