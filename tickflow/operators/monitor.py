"""Monitoring metrics (A5-A19), consumer lag (A9, J4), alert rules and
alert state timelines (L1, L2, W4).

Each metric is a global or grouped aggregate over a time-pruned slice; they
are designed to be unioned into one long ``(metric, value)`` frame that the
rule evaluator joins against the (small, fixed) rule table.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.functions.numeric import dround
from tickflow.functions.timeutil import minus, round_seconds, seconds_between, trunc, ts_lit

EMPTY_FRESHNESS = 999999


# ------------------------------------------------------------------ pipeline health

def pipeline_metrics(raw: DataFrame, as_of) -> DataFrame:
    """One row: seconds since last ingest, rows in the last 6 min, BTC rows in 20 min (A5).

    The windows are on ingest time and late events have old event dates, so no
    event-date partition can be left out; the scan reads two columns.
    """
    a = ts_lit(as_of)
    return raw.agg(
        round_seconds(a, F.max("ingest_ts")).alias("time_since_last_ingest_seconds"),
        F.count_if(F.col("ingest_ts") >= minus(as_of, "6 minutes")).alias("events_last_6m"),
        F.count_if((F.col("ingest_ts") >= minus(as_of, "20 minutes"))
                   & (F.col("commodity") == "bitcoin")).alias("btc_events_last_20m"),
    )


def api_metrics(calls: DataFrame, as_of, minutes: int = 18) -> DataFrame:
    """calls, errors and success % (1 dp; 100.0 with no calls) over a trailing window."""
    w = calls.filter(F.col("ts_utc") >= minus(as_of, f"{minutes} minutes"))
    n = F.count(F.lit(1))
    return w.agg(
        n.alias(f"calls_{minutes}m"),
        F.count_if(~F.col("ok")).alias(f"errors_{minutes}m"),
        F.when(n > 0, dround(F.count_if(F.col("ok")) * 100.0 / n, 1))
        .otherwise(F.lit(100.0)).alias(f"success_rate_{minutes}m"),
    )


def api_status(calls: DataFrame, as_of, minutes: int = 15) -> DataFrame:
    """HTTP status histogram over a trailing window, most frequent first."""
    return (calls.filter(F.col("ts_utc") >= minus(as_of, f"{minutes} minutes"))
            .groupBy("http_status").agg(F.count(F.lit(1)).alias("calls"))
            .orderBy(F.desc("calls"), F.asc_nulls_last("http_status")))


def api_p95(calls: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Exact P95 latency over a trailing window (A14), interpolated between neighbours.

    Calls are first counted per latency (whole milliseconds, so few values however many
    calls); only these counts are ordered.
    """
    w = calls.filter(F.col("ts_utc") >= minus(as_of, f"{minutes} minutes"))
    each = w.groupBy("latency_ms").agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("latency_ms").isNotNull(), F.col("n")).otherwise(0)
    order = Window.orderBy(F.col("latency_ms").asc_nulls_first())
    at = each.select("latency_ms", "n", F.sum(known).over(order).alias("upto"), F.sum(known).over(Window.partitionBy()).alias("known"))
    place = 0.95 * (F.col("known") - 1)
    low, high = (F.min(F.when(F.col("upto") > f(place), F.col("latency_ms"))) for f in (F.floor, F.ceil))
    part = F.max(place - F.floor(place))
    p = low + (high - low) * part
    return at.agg(dround(p, 6).alias("p95_latency_ms"), F.coalesce(F.sum("n"), F.lit(0)).alias("calls"))


# ------------------------------------------------------------------ Kafka lag

def processed_offsets(raw: DataFrame) -> DataFrame:
    """max(kafka_offset) per partition of the fact table."""
    return raw.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("last_processed"))


def partition_lag(watermarks: DataFrame, raw: DataFrame,
                  extra_offsets: DataFrame | None = None) -> DataFrame:
    """Per partition: ``max(0, high - max(last + 1, low))``, or ``high - low``
    when nothing was processed.  Partitions only in the table are ignored (A9, J4).

    By default only fact-table offsets count as processed, so a rejected last
    message leaves lag > 0 (as in the original); ``extra_offsets`` (e.g. the
    DLQ's ``kafka_partition, kafka_offset``) are counted as processed too.
    """
    src = raw.select("kafka_partition", "kafka_offset")
    if extra_offsets is not None:
        src = src.unionByName(extra_offsets.select("kafka_partition", "kafka_offset"))
    done = processed_offsets(src).withColumnRenamed("kafka_partition", "partition")
    j = watermarks.join(done, "partition", "left")
    nxt = F.when(F.col("last_processed").isNull(), F.col("low")) \
        .otherwise(F.greatest(F.col("last_processed") + 1, F.col("low")))
    return j.select("partition", "low", "high", "last_processed",
                    F.greatest(F.lit(0).cast("bigint"), F.col("high") - nxt).alias("lag"))


def consumer_lag(watermarks: DataFrame, raw: DataFrame,
                 extra_offsets: DataFrame | None = None) -> DataFrame:
    """One row: total and max partition lag."""
    return partition_lag(watermarks, raw, extra_offsets).agg(
        F.coalesce(F.sum("lag"), F.lit(0)).cast("bigint").alias("total_lag"),
        F.coalesce(F.max("lag"), F.lit(0)).cast("bigint").alias("max_partition_lag"))


def lag_latest(lag_log: DataFrame) -> DataFrame:
    """Newest lag snapshot per (group_id, topic) (A10)."""
    best = F.max_by(F.struct("ts_utc", "total_lag", "max_partition_lag"), F.col("ts_utc"))
    return (lag_log.groupBy("group_id", "topic").agg(best.alias("b"))
            .select("group_id", "topic", F.col("b.ts_utc").alias("ts_utc"),
                    F.col("b.total_lag").alias("total_lag"),
                    F.col("b.max_partition_lag").alias("max_partition_lag")))


# ------------------------------------------------------------------ DLQ

DLQ_WINDOWS = [("15m", "15 minutes"), ("1h", "1 hour"), ("24h", "24 hours"), ("7d", "7 days")]


def dlq_by_reason(dlq: DataFrame, as_of, windows=DLQ_WINDOWS) -> DataFrame:
    """DLQ rows per error_reason in each trailing window (A11): one scan of the
    widest window, conditional counts per window, then unpivot."""
    widest = max(windows, key=lambda w: _span_seconds(w[1]))[1]
    a = ts_lit(as_of)
    s = dlq.filter((F.col("ts_utc") >= minus(as_of, widest)) & (F.col("ts_utc") <= a))
    agg = s.groupBy("error_reason").agg(*[
        F.count_if(F.col("ts_utc") >= minus(as_of, span)).alias(f"w_{name}")
        for name, span in windows])
    stacked = agg.select("error_reason", F.explode(F.array(*[
        F.struct(F.lit(name).alias("window_name"), F.col(f"w_{name}").alias("n"))
        for name, _ in windows])).alias("x"))
    return (stacked.select(F.col("x.window_name").alias("window_name"), "error_reason",
                           F.col("x.n").alias("n"))
            .filter(F.col("n") > 0))


def _span_seconds(span: str) -> int:
    n, unit = span.split()
    mult = {"minute": 60, "minutes": 60, "hour": 3600, "hours": 3600, "day": 86400, "days": 86400}
    return int(n) * mult[unit]


def dlq_per_day(dlq: DataFrame, as_of, days: int = 7) -> DataFrame:
    """DLQ rows per UTC day over the trailing ``days``."""
    return (dlq.filter((F.col("ts_utc") >= minus(as_of, f"{days} days")) & (F.col("ts_utc") <= ts_lit(as_of)))
            .groupBy(trunc("day", "ts_utc").alias("day")).agg(F.count(F.lit(1)).alias("dlq_events")))


def dlq_rate(validated: DataFrame, as_of, days: int = 7) -> DataFrame:
    """bad / (bad + good) per UTC day of arrival."""
    s = validated.filter((F.col("kafka_timestamp") >= minus(as_of, f"{days} days"))
                         & (F.col("kafka_timestamp") <= ts_lit(as_of)))
    g = s.groupBy(trunc("day", "kafka_timestamp").alias("day")).agg(
        F.count_if(F.col("error_reason").isNotNull()).alias("bad_rows"),
        F.count_if(F.col("error_reason").isNull()).alias("good_rows"))
    return g.withColumn("dlq_rate", dround(F.col("bad_rows") / (F.col("bad_rows") + F.col("good_rows")), 6))


# ------------------------------------------------------------------ freshness, summaries

def freshness_seconds(df: DataFrame, col: str, as_of, empty: int = EMPTY_FRESHNESS) -> DataFrame:
    """Seconds since max(col), rounded to whole ones; ``empty`` when there is no row."""
    return df.agg(F.coalesce(F.round(seconds_between(ts_lit(as_of), F.max(col))).cast("bigint"),
                             F.lit(empty).cast("bigint")).alias("seconds"))


def source_freshness(df: DataFrame, col: str, as_of, warn_minutes: int = 10,
                     error_minutes: int = 20) -> DataFrame:
    """pass / warn / error by the age of max(col)."""
    f = freshness_seconds(df, col, as_of)
    return f.select("seconds", F.when(F.col("seconds") > error_minutes * 60, "error")
                    .when(F.col("seconds") > warn_minutes * 60, "warn")
                    .otherwise("pass").alias("status"))


def table_summary(raw: DataFrame) -> DataFrame:
    """Total rows, newest event, newest ingest."""
    return raw.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.max("event_ts").alias("newest_event"),
                   F.max("ingest_ts").alias("newest_ingest"))


def throughput(raw: DataFrame, cycle: str = "6 minutes") -> DataFrame:
    """Rows and mean ingest latency per ingest cycle window."""
    g = raw.groupBy(F.window("ingest_ts", cycle).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"),
        dround(F.avg(seconds_between("ingest_ts", "event_ts")), 6).alias("avg_latency_s"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("cycle_start"), "rows", "avg_latency_s")


# ------------------------------------------------------------------ alert rules (L1)

# Alert rules (uid, metric, comparison, threshold, severity,
# no-data state, pending period in seconds).
RULES = [
    ("stale_ingest_13m", "time_since_last_ingest_seconds", "gt", 780.0, "critical", "Alerting", 120),
    ("btc_events_last_20m_low", "btc_events_last_20m", "lt", 2.0, "warning", "Alerting", 120),
    ("api_errors_18m_ge_1", "errors_18m", "gt", 0.0, "warning", "Alerting", 120),
    ("api_errors_18m_ge_3", "errors_18m", "gt", 2.0, "critical", "Alerting", 120),
    ("dlq_events_last_15m_gt_0", "dlq_events_last_15m", "gt", 0.0, "warning", "OK", 120),
    ("kafka_lag_warn_gt_50", "total_lag", "gt", 50.0, "warning", "OK", 120),
    ("kafka_lag_crit_gt_500", "total_lag", "gt", 500.0, "critical", "OK", 120),
    ("dbt_test_failures_35m", "test_failures_35m", "gt", 0.0, "warning", "Alerting", 120),
    ("kafka_partition_lag_warn_gt_30", "max_partition_lag", "gt", 30.0, "warning", "OK", 120),
    ("backup_stale_25h", "backup_age_seconds", "gt", 90000.0, "warning", "Alerting", 120),
    ("mart_latest_prices_stale_20m", "latest_prices_age_seconds", "gt", 1200.0, "warning",
     "Alerting", 120),
]
RULE_SCHEMA = ("rule_uid string, metric string, op string, threshold double, severity string, "
               "no_data_state string, for_seconds int")
# Fixed value: the state of every rule whose metric fails.
EXEC_ERR_STATE = "Alerting"


def rules_df(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(RULES, RULE_SCHEMA).withColumn("exec_err_state", F.lit(EXEC_ERR_STATE)))


def _one(df: DataFrame, metric: str, value_col: str) -> DataFrame:
    return df.select(F.lit(metric).alias("metric"), F.col(value_col).cast("double").alias("value"))


def metric_queries(as_of, raw: DataFrame, calls: DataFrame, dlq: DataFrame, lag_log: DataFrame,
                   runs: DataFrame, backups: DataFrame, latest: DataFrame,
                   group_id: str, topic: str) -> dict[str, Callable[[], DataFrame]]:
    """Every rule's scalar query at ``as_of``, by metric; each is built when it is called."""
    from tickflow.operators.quality import failed_runs

    def health(name: str, empty: int) -> DataFrame:
        return _one(pipeline_metrics(raw, as_of).select(F.coalesce(F.col(name), F.lit(empty)).alias("v")), name, "v")

    def lag(name: str) -> DataFrame:
        latest_lag = lag_latest(lag_log.filter(F.col("ts_utc") <= ts_lit(as_of)))
        return _one(latest_lag.filter((F.col("group_id") == group_id) & (F.col("topic") == topic)), name, name)

    def count(df: DataFrame, name: str) -> DataFrame:
        return _one(df.agg(F.count(F.lit(1)).alias("v")), name, "v")

    return {
        "time_since_last_ingest_seconds": lambda: health("time_since_last_ingest_seconds", EMPTY_FRESHNESS),
        "btc_events_last_20m": lambda: health("btc_events_last_20m", 0),
        "errors_18m": lambda: _one(api_metrics(calls, as_of, 18), "errors_18m", "errors_18m"),
        "dlq_events_last_15m": lambda: count(dlq.filter(F.col("ts_utc") >= minus(as_of, "15 minutes")), "dlq_events_last_15m"),
        "total_lag": lambda: lag("total_lag"),
        "max_partition_lag": lambda: lag("max_partition_lag"),
        "test_failures_35m": lambda: count(failed_runs(runs, as_of, 35), "test_failures_35m"),
        "backup_age_seconds": lambda: _one(freshness_seconds(backups.filter(F.col("status") == "OK"), "backup_ts", as_of), "backup_age_seconds", "seconds"),
        "latest_prices_age_seconds": lambda: _one(freshness_seconds(latest, "last_timestamp", as_of), "latest_prices_age_seconds", "seconds"),
    }


def metric_snapshot(as_of, **tables) -> DataFrame:
    """Long (metric, value) frame of all metrics in one query: one that fails, fails them all."""
    parts = [query() for query in metric_queries(as_of, **tables).values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_results(spark: SparkSession, queries: dict[str, Callable[[], DataFrame]], at_once: int = 4) -> DataFrame:
    """(metric, value, error): each metric's query runs by itself, so a failing one costs its own value only.

    A query gives one row at most.  Without a row the metric has no data; with an error, the
    first line of what went wrong.
    """
    def result(name: str) -> list[tuple]:
        try:
            return [(name, r["value"], None) for r in queries[name]().collect()]
        except Exception as failure:  # whatever it is, it is this metric's state
            return [(name, None, str(failure).strip().split("\n")[0][:500] or type(failure).__name__)]

    with ThreadPoolExecutor(at_once) as pool:
        rows = [row for found in pool.map(result, queries) for row in found]
    return spark.createDataFrame(rows, "metric string, value double, error string")


def _breach(value, op, threshold) -> F.Column:
    return (F.when(op == "gt", value > threshold).when(op == "lt", value < threshold)
            .when(op == "ge", value >= threshold).when(op == "le", value <= threshold)
            .when(op == "eq", value == threshold))


def _breached(failed) -> F.Column:
    """A metric that failed, or has no value, resolves by the rule's state for that."""
    return (F.when(failed, F.col("exec_err_state") == "Alerting")
            .when(F.col("value").isNull(), F.col("no_data_state") == "Alerting")
            .otherwise(_breach(F.col("value"), F.col("op"), F.col("threshold"))))


def evaluate_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule_uid, metric, value, breached, severity); a metric with no row is
    'no data' and resolves by the rule's no-data state.

    Metrics with an ``error`` column (``metric_results``) add ``error`` and ``state``: Error, NoData,
    Alerting or Normal; a failed metric resolves by the rule's state for execution errors.
    """
    j = rules.join(metrics, "metric", "left")
    columns = ["rule_uid", "metric", "value"]
    if "error" not in metrics.columns:
        return j.select(*columns, _breached(F.lit(False)).alias("breached"), "severity")
    breached = _breached(F.col("error").isNotNull())
    state = (F.when(F.col("error").isNotNull(), "Error").when(F.col("value").isNull(), "NoData")
             .when(breached, "Alerting").otherwise("Normal"))
    return j.select(*columns, breached.alias("breached"), "severity", "error", state.alias("state"))


def grouped_alerts(evaluated: DataFrame, by: str = "rule_uid") -> DataFrame:
    """Notifications: the breached evaluations of one group and severity as one row (alert grouping, severity routes)."""
    return (evaluated.filter("breached").groupBy(by, "severity")
            .agg(F.count(F.lit(1)).alias("alerts"), F.max("value").alias("max_value")))


# ------------------------------------------------------------------ alert timeline

def alert_timeline(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """State per evaluation: normal / pending / firing / resolved.

    A rule fires once its condition has held for ``for_seconds`` since the
    first breached sample of the current run of breached samples (gaps and
    islands).  Run starts come from ``lag`` and the run start of each row
    from a running max, both by ranges (``plans.ranges``).
    """
    from tickflow.plans import ranges
    r = samples.join(rules.select("rule_uid", "op", "threshold", "no_data_state", "exec_err_state", "for_seconds"), "rule_uid")
    breached = _breached(F.col("error").isNotNull() if "error" in samples.columns else F.lit(False))
    s = r.select("rule_uid", "ts", "value", "for_seconds", breached.alias("breached"))
    lagged = ranges.with_lag(s, ["rule_uid"], ["ts"], ["breached", "ts"])
    starts = lagged.withColumn(
        "start_ts", F.when(F.col("breached") & ~F.coalesce(F.col("prev_breached"), F.lit(False)),
                           F.col("ts")))
    runs = ranges.with_running_max(starts, ["rule_uid"], ["ts"], "start_ts", "island_start")
    held = seconds_between("ts", "island_start") >= F.col("for_seconds")
    prev_held = seconds_between("prev_ts", "island_start") >= F.col("for_seconds")
    state = (F.when(F.col("breached") & held, "firing")
             .when(F.col("breached"), "pending")
             .when(F.coalesce(F.col("prev_breached"), F.lit(False)) & prev_held, "resolved")
             .otherwise("normal"))
    return runs.select("rule_uid", "ts", "value", "breached", state.alias("state"))


def idle_time(df: DataFrame, ts_col: str, tie_col: str, cycle_seconds: int = 360) -> DataFrame:
    """Idle time per UTC day (A19): gaps between consecutive rows in time order.

    ``max_gap_seconds`` is the longest gap ending that day, ``idle_gaps`` the
    number of gaps longer than one cycle and ``idle_seconds`` their excess
    over the cycle.  The one order over all rows is range-partitioned
    (``plans.ranges``): no task holds more than its range, and no window runs over
    the whole.  (Session windows would lose the longest gap of a day without idle time.)
    """
    from tickflow.plans import ranges
    base = df.select(F.col(ts_col).alias("_t"), F.col(tie_col).alias("_k"))
    lagged = ranges.with_lag(base, [], ["_t", "_k"], ["_t"])
    gap = seconds_between("_t", "prev__t")
    return (lagged.filter(F.col("prev__t").isNotNull())
            .groupBy(trunc("day", "_t").alias("day"))
            .agg(dround(F.max(gap), 6).alias("max_gap_seconds"),
                 F.count_if(gap > cycle_seconds).alias("idle_gaps"),
                 dround(F.coalesce(F.sum(F.when(gap > cycle_seconds, gap - cycle_seconds)), F.lit(0.0)), 6)
                 .alias("idle_seconds")))


def dlq_rate_from_metrics(metrics: DataFrame) -> DataFrame:
    """bad / (bad + good) over a per-batch metrics log (A12 from K5 rows)."""
    bad, good = F.sum("bad_rows"), F.sum("good_rows")
    return metrics.agg(bad.alias("bad_rows"), good.alias("good_rows"),
                       F.when(bad + good > 0, dround(bad / (bad + good), 6)).alias("dlq_rate"))
