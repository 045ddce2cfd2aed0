"""Tick-domain tables derived from the driver's ``events`` table.

Every table here is a pure, deterministic projection (or a small aggregate)
of ``events``: no shuffles except where an aggregate is the point, no
driver-side data, so these scale with the input like any other scan.  The
same rules are written as DuckDB SQL in ``tickflow.oracle`` so both engines
start from identical inputs.

Mapping (event_type -> instrument, price):
    click    -> bitcoin / BTC/USD  60000 + value*10      (24/7)
    view     -> gold    / XAU/USD  2000 + value/8        (FX-gated)
    purchase -> eurusd  / EUR/USD  1.08 + value/50000    (FX-gated)
    signup   -> silver  / XAG/USD  25 + value/100        (no bounds)
    error    -> oil     / WTI/USD  75 + value/50         (no bounds)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "prices"
CONSUMER_GROUP = "tick_ingest"
SOURCE = "rest_api"
STREAM_INSTANCE = "stream1"
INGEST_INTERVAL_SEC = 360


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/events.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Give an unsplittable small input (one file, one row group) at least
    ``defaultParallelism`` partitions so the per-row work after the scan is
    not confined to one task.  A large scan already has more splits than
    cores and is returned unchanged (no shuffle)."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def materialize(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the session's shared checkpoint
    folder and read it back: cuts lineage, and turns a generated column into
    a plain scanned column (as the Kafka source would deliver it)."""
    from tickflow.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.repartition(partitions) if partitions else df).write.parquet(path)
    return spark.read.parquet(path)


def _case(col: str, mapping: dict, default) -> Column:
    c = F.col(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(default)


def _commodity() -> Column:
    return _case("event_type", {"click": "bitcoin", "view": "gold", "purchase": "eurusd",
                                "signup": "silver"}, "oil")


def _symbol() -> Column:
    return _case("event_type", {"click": "BTC/USD", "view": "XAU/USD", "purchase": "EUR/USD",
                                "signup": "XAG/USD"}, "WTI/USD")


def _price() -> Column:
    v = F.col("value")
    t = F.col("event_type")
    return (F.when(t == "click", F.lit(60000.0) + v * 10)
            .when(t == "view", F.lit(2000.0) + v / 8)
            .when(t == "purchase", F.lit(1.08) + v / 50000)
            .when(t == "signup", F.lit(25.0) + v / 100)
            .otherwise(F.lit(75.0) + v / 50))


def ticks(events: DataFrame) -> DataFrame:
    """The fact table ``raw_prices`` (10 columns) built from ``events``."""
    eid = F.col("event_id")
    return events.select(
        eid.cast("string").alias("event_id"),
        _commodity().alias("commodity"),
        _symbol().alias("symbol"),
        _price().alias("price"),
        F.lit("USD").alias("currency"),
        F.col("ts").alias("event_ts"),
        F.lit(SOURCE).alias("source"),
        (F.col("ts") + F.make_dt_interval(secs=(F.lit(5) + eid % 115).cast("decimal(18,6)")))
        .alias("ingest_ts"),
        (eid % 3).cast("int").alias("kafka_partition"),
        F.floor(eid / 3).cast("bigint").alias("kafka_offset"),
    )


def ticks_minute_ties(events: DataFrame) -> DataFrame:
    """Variant whose event_ts is truncated to the minute, so ties need event_id."""
    return ticks(events).withColumn(
        "event_ts", F.date_trunc("minute", "event_ts").cast("timestamp_ntz"))


def ticks_spiked(events: DataFrame) -> DataFrame:
    """Variant with a 1.5x price spike on every 97th event (exercises price_jumps)."""
    t = ticks(events)
    return t.withColumn("price", F.when(F.col("event_id").cast("bigint") % 97 == 0,
                                        F.col("price") * 1.5).otherwise(F.col("price")))


def ticks_stale_instrument(events: DataFrame) -> DataFrame:
    """Variant in which all WTI/USD ticks are three days older (exercises the
    latest-price fallback branch)."""
    older = F.col("event_ts") - F.expr("INTERVAL 3 DAYS")
    return ticks(events).withColumn(
        "event_ts", F.when(F.col("symbol") == "WTI/USD", older).otherwise(F.col("event_ts")))


def ticks_late(events: DataFrame) -> DataFrame:
    """Variant in which every 10th tick is nine days older when it is ingested."""
    older = F.col("event_ts") - F.expr("INTERVAL 9 DAYS")
    return ticks(events).withColumn(
        "event_ts", F.when(F.col("event_id").cast("bigint") % 10 == 0, older).otherwise(F.col("event_ts")))


# prices that every symbol without bounds accepts, by event_id % 4
EXTREME_PRICES = (1e30, 3e-13, -1e30, 4.5e17)


def ticks_extreme(events: DataFrame) -> DataFrame:
    """Variant with an extreme price on every 7th tick, each under a symbol of its own."""
    eid = F.col("event_id").cast("bigint")
    odd = eid % 7 == 0
    price = F.get(F.array(*map(F.lit, EXTREME_PRICES)), (eid % len(EXTREME_PRICES)).cast("int"))
    return (ticks(events).withColumn("price", F.when(odd, price).otherwise(F.col("price")))
            .withColumn("symbol", F.when(odd, F.concat(F.lit("X"), F.col("event_id"))).otherwise(F.col("symbol"))))


# --------------------------------------------------------------------------
# Kafka envelope with wire payloads (good and deliberately bad)
# --------------------------------------------------------------------------

def _price_txt(c: Column) -> Column:
    # fixed 8 decimals, HALF_UP (same digits as printf-style %.8f for these prices)
    return c.cast("decimal(20,8)").cast("string")


def raw_payloads(events: DataFrame) -> DataFrame:
    """Kafka envelope rows: raw_payload, kafka_topic, kafka_partition, kafka_offset.

    Payload variant by ``event_id % 23``: 0 truncated JSON; 1-7 one missing
    field (event_id, commodity, symbol, price, currency, source, timestamp);
    8 price as a string; 9 negative price; 10 price x1000 (out of range for
    bounded symbols); 11 schema_version 2; 12 fractional-second timestamp;
    13 no schema_version; 14 no core field; 15 empty payload; else valid.
    """
    eid = F.col("event_id")
    v = eid % 23
    p = _price()

    def field(name, text, missing_on):
        return F.when(v == missing_on, F.lit(None)).otherwise(F.concat(F.lit(f'"{name}":'), text))

    def q(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    sec_ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    frac_ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    price_txt = (F.when(v == 8, q(_price_txt(p)))
                 .when(v == 9, _price_txt(-p))
                 .when(v == 10, _price_txt(p * 1000))
                 .otherwise(_price_txt(p)))
    sv = (F.when(v == 13, F.lit(None)).when(v == 11, F.lit('"schema_version":2'))
          .otherwise(F.lit('"schema_version":1')))
    fields = [
        sv,
        field("event_id", q(eid.cast("string")), 1),
        field("commodity", q(_commodity()), 2),
        field("symbol", q(_symbol()), 3),
        field("price", price_txt, 4),
        field("currency", q(F.lit("USD")), 5),
        field("timestamp", q(F.when(v == 12, frac_ts).otherwise(sec_ts)), 7),
        field("source", q(F.lit(SOURCE)), 6),
        F.lit(f'"ingest_interval_sec":{INGEST_INTERVAL_SEC}'),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    core_less = F.lit('{"schema_version":1,"ingest_interval_sec":%d}' % INGEST_INTERVAL_SEC)
    payload = (F.when(v == 0, F.substring(body, 1, 40))
               .when(v == 14, core_less)
               .when(v == 15, F.lit(""))
               .otherwise(body))
    return events.select(
        payload.alias("raw_payload"),
        F.lit(TOPIC).alias("kafka_topic"),
        (eid % 3).cast("int").alias("kafka_partition"),
        F.floor(eid / 3).cast("bigint").alias("kafka_offset"),
        (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("kafka_timestamp"),
    )


def replayed_payloads(events: DataFrame) -> DataFrame:
    """The envelope plus a re-publish of every 10th event at a later offset
    (same payload, offset + 10,000,000): a producer retry after a lost ack."""
    base = raw_payloads(events)
    again = (raw_payloads(events.filter(F.col("event_id") % 10 == 0))
             .withColumn("kafka_offset", F.col("kafka_offset") + 10_000_000))
    return base.unionByName(again)


def micro_batch_id(offset_col: str = "kafka_offset") -> Column:
    """Simulated micro-batch number of an envelope row (500 offsets per batch)."""
    return F.floor(F.col(offset_col) / 500).cast("bigint")


# --------------------------------------------------------------------------
# Stored API calls (status, requested symbols, response body)
# --------------------------------------------------------------------------

ALL3 = "BTC/USD,XAU/USD,EUR/USD"


def api_calls_raw(events: DataFrame) -> DataFrame:
    """One API call per event: call_id, ts_utc, symbols, http_status, latency_ms, body.

    Body shape by ``event_id % 10``: 0 {symbol,price}; 1 {price}; 2 all three
    symbols nested; 3 partial nested; 4 unparseable price; 5 {}; 6 status=error;
    7 nested with one bad price; 8 {price} for two symbols; 9 {symbol,price}
    for an unrequested symbol.  HTTP status by ``event_id % 20``: 7 -> 429,
    13 -> 503, else 200; ``event_id % 20 == 17`` returns a non-JSON body.
    ``event_id % 60``: 19 -> no status and no body (a timeout), 39 -> no status
    and an empty body.
    """
    eid = F.col("event_id")
    w = eid % 10
    sym = _symbol()
    p = F.format_string("%.8f", _price())
    p2 = F.format_string("%.5f", F.lit(2000.0) + F.col("value") / 8)
    p3 = F.format_string("%.7f", F.lit(1.08) + F.col("value") / 50000)

    def nested(s, val):
        return F.concat(F.lit(f'"{s}":{{"price":"'), val, F.lit('"}'))

    body = (F.when(eid % 60 == 19, F.lit(None)).when(eid % 60 == 39, F.lit(""))
            .when(eid % 20 == 17, F.lit("<html>504 gateway timeout</html>"))
            .when(w == 0, F.concat(F.lit('{"symbol":"'), sym, F.lit('","price":"'), p, F.lit('"}')))
            .when(w == 1, F.concat(F.lit('{"price":"'), p, F.lit('"}')))
            .when(w == 2, F.concat(F.lit("{"), nested("BTC/USD", p), F.lit(","),
                                   nested("XAU/USD", p2), F.lit(","), nested("EUR/USD", p3), F.lit("}")))
            .when(w == 3, F.concat(F.lit("{"), nested("BTC/USD", p), F.lit(","),
                                   nested("EUR/USD", p3), F.lit("}")))
            .when(w == 4, F.concat(F.lit('{"symbol":"'), sym, F.lit('","price":"n/a"}')))
            .when(w == 5, F.lit("{}"))
            .when(w == 6, F.concat(F.lit('{"status":"error","code":400,"message":"quota exceeded '),
                                   eid.cast("string"), F.lit('"}')))
            .when(w == 7, F.concat(F.lit("{"), nested("BTC/USD", p), F.lit(","),
                                   nested("XAU/USD", F.lit("n/a")), F.lit("}")))
            .when(w == 8, F.concat(F.lit('{"price":"'), p, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"symbol":"XAG/USD","price":"'), p, F.lit('"}'))))
    symbols = (F.when(w.isin(2, 3, 6), F.lit(ALL3))
               .when(w.isin(7, 8), F.lit("BTC/USD,XAU/USD"))
               .when(w == 9, F.lit("BTC/USD"))
               .otherwise(sym))
    status = (F.when((eid % 60).isin(19, 39), F.lit(None)).when(eid % 20 == 7, 429)
              .when(eid % 20 == 13, 503).otherwise(200))
    return events.select(
        eid.alias("call_id"),
        F.col("ts").alias("ts_utc"),
        symbols.alias("symbols"),
        status.cast("int").alias("http_status"),
        F.floor(F.col("value") * 10).cast("int").alias("latency_ms"),
        body.alias("body"),
    )


def api_calls(events: DataFrame) -> DataFrame:
    """The ``api_calls`` monitoring log: each stored call classified."""
    from tickflow.operators.ingest import classify_api_calls
    return classify_api_calls(api_calls_raw(events))


# --------------------------------------------------------------------------
# Operational logs: Kafka watermarks and lag snapshots, test runs, backups
# --------------------------------------------------------------------------

def watermarks(events: DataFrame) -> DataFrame:
    """Broker watermarks per partition from the envelope: ``low`` skips the
    first ``partition`` offsets (expired by retention), ``high`` runs
    ``7 * partition`` offsets past the newest record (not yet consumed)."""
    env = raw_payloads(events)
    p = F.col("kafka_partition")
    return (env.groupBy(p.alias("partition"))
            .agg(F.min("kafka_offset").alias("_lo"), F.max("kafka_offset").alias("_hi"))
            .select("partition", (F.col("_lo") + F.col("partition")).cast("bigint").alias("low"),
                    (F.col("_hi") + 1 + 7 * F.col("partition")).cast("bigint").alias("high")))


def kafka_lag_log(events: DataFrame) -> DataFrame:
    """Lag snapshots (group_id, topic, ts_utc, total_lag, max_partition_lag),
    one per event."""
    u = F.col("user_id")
    return (events
            .select(F.when(u % 3 == 0, F.lit("other_group")).otherwise(F.lit(CONSUMER_GROUP))
                    .alias("group_id"),
                    F.lit(TOPIC).alias("topic"),
                    F.col("ts").alias("ts_utc"),
                    (u % 600).cast("bigint").alias("total_lag"),
                    (u % 200).cast("bigint").alias("max_partition_lag")))


def test_results(events: DataFrame) -> DataFrame:
    """Data-test results (run_ts_utc, unique_id, status): one run per hour,
    one result per event; statuses from the event's type and value."""
    t, v = F.col("event_type"), F.col("value")
    status = (F.when((t == "error") & (v > 480), "fail")
              .when((t == "error") & (v > 460), "error")
              .when((t == "signup") & (v > 450), "warn")
              .when((t == "purchase") & (v > 470), "skipped")
              .otherwise("pass"))
    run_ts = F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 30 MINUTES")
    return events.select(run_ts.alias("run_ts_utc"),
                         F.concat(F.lit("test."), F.col("event_id").cast("string")).alias("unique_id"),
                         status.alias("status"))


def backup_log(events: DataFrame) -> DataFrame:
    """One backup attempt per day with data, at 02:00; every 6th day of the
    month fails."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    g = events.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    failed = F.dayofmonth("day") % 6 == 0
    return g.select((F.col("day") + F.expr("INTERVAL 2 HOURS")).alias("backup_ts"),
                    F.concat(F.lit("backup_"), F.date_format("day", "yyyyMMdd"), F.lit(".sql.gz"))
                    .alias("file_name"),
                    (F.col("n") * 1000).cast("bigint").alias("file_size_bytes"),
                    F.when(failed, "FAILED").otherwise("OK").alias("status"),
                    F.when(failed, "dump failed").alias("error_msg"))


# --------------------------------------------------------------------------
# Alert webhook payloads and alert-rule evaluation samples
# --------------------------------------------------------------------------

def alert_payloads(events: DataFrame) -> DataFrame:
    """Webhook bodies (payload_id, received_ts, body), one per event.

    Shape by ``event_id % 14``: 0 two alerts; 1 no alerts key; 2 alerts not a
    list; 3 non-object elements mixed in; 4 older field names; 5 string ids;
    6 empty list; 7 only non-objects; 8 a JSON array body; 9 broken JSON;
    10 white space around; 11 text behind; 12 a string that looks like an
    object; 13 two objects.
    """
    eid = F.col("event_id").cast("string")
    w = F.col("event_id") % 14
    u = F.col("user_id").cast("string")
    d5 = (F.col("event_id") % 5).cast("string")
    p7 = (F.col("event_id") % 7).cast("string")
    body = (
        F.when(w == 0, F.concat(
            F.lit('{"orgId":1,"dashboardUID":"dash-'), d5, F.lit('","panelId":'), p7,
            F.lit(',"state":"alerting","alerts":[{"status":"firing","fingerprint":"fp'), eid,
            F.lit('","labels":{"severity":"critical"},"annotations":{"summary":"Lag '), u,
            F.lit('"}},{"status":"resolved","fingerprint":"fp'), eid,
            F.lit('b","labels":{"severity":"warning"},"annotations":{"summary":"Lag ok"}}]}')))
        .when(w == 1, F.concat(F.lit('{"orgId":1,"state":"ok","title":"t'), eid, F.lit('"}')))
        .when(w == 2, F.lit('{"orgId":1,"alerts":"oops","state":"pending"}'))
        .when(w == 3, F.concat(
            F.lit('{"orgId":1,"alerts":[1,"x",{"state":"firing","ruleUid":"r'), eid,
            F.lit('","title":"T'), eid, F.lit('","labels":{"severity":"warning"}}]}')))
        .when(w == 4, F.concat(
            F.lit('{"orgId":1,"dashboardUID":"","dashboardUid":"old-'), d5,
            F.lit('","panelId":3,"alerts":[{"state":"alerting","uid":"u'), eid,
            F.lit('","annotations":{"title":"Old '), eid, F.lit('"}}]}')))
        .when(w == 5, F.concat(F.lit('{"orgId":"1","panelId":"7","alerts":[{"status":"firing","fingerprint":"fp'),
                               eid, F.lit('"}]}')))
        .when(w == 6, F.lit('{"orgId":2,"alerts":[],"state":"alerting"}'))
        .when(w == 7, F.lit('{"alerts":[null,5]}'))
        .when(w == 8, F.lit('["not","an","object"]'))
        .when(w == 10, F.concat(F.lit('\n\t {"orgId":3,"alerts":[{"state":"ok","uid":"w'), eid, F.lit('"}]}\r\n')))
        .when(w == 11, F.lit('{"orgId":4,"state":"ok"} and more'))
        .when(w == 12, F.lit('{"orgId":5,"alerts":["{\\"state\\":\\"ok\\"}",{"state":"firing","uid":"s"}]}'))
        .when(w == 13, F.lit('{"orgId":6,"state":"ok"},{"orgId":7}'))
        .otherwise(F.lit('{"orgId":1,"alerts":[')))
    return events.select(F.col("event_id").alias("payload_id"), F.col("ts").alias("received_ts"),
                         body.alias("body"))


# rule evaluated by each event type, and the sample value rule
SAMPLE_RULES = {
    "click": "btc_events_last_20m_low",
    "view": "api_errors_18m_ge_1",
    "purchase": "dlq_events_last_15m_gt_0",
    "signup": "kafka_lag_warn_gt_50",
    "error": "stale_ingest_13m",
}


def alert_samples(events: DataFrame) -> DataFrame:
    """Rule evaluations (rule_uid, ts, value): one per event; every 41st has no data."""
    t, v = F.col("event_type"), F.col("value")
    rule = _case("event_type", SAMPLE_RULES, None)
    val = (F.when(t == "click", F.floor(v) % 5)
           .when(t == "view", F.floor(v) % 8)
           .when(t == "purchase", F.floor(v) % 3)
           .when(t == "signup", F.floor(v))
           .otherwise(F.floor(v * 10)))
    return events.select(rule.alias("rule_uid"), F.col("ts").alias("ts"),
                         F.when(F.col("event_id") % 41 == 0, F.lit(None))
                         .otherwise(val).cast("double").alias("value"))
