"""Ingest-side transforms: envelope unwrap, JSON parse, typing, event build,
API response flattening and classification, alert payload flattening.

(S2, P1, P2, P8, K6, S5, P17, L3.)  Everything is a projection or a
``explode``; there is no shuffle in this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions import ids
from tickflow.functions.timeutil import ISO_SECONDS

# ---------------------------------------------------------------------------
# API call error types (must match the original log values).
# ---------------------------------------------------------------------------
API_RATE_LIMIT = "RATE_LIMIT_429"
API_SERVER_PREFIX = "SERVER_"           # + HTTP status
API_EXCEPTION = "EXCEPTION"
API_PAYLOAD_ERROR = "TD_ERROR"
API_EMPTY_PARSE = "EMPTY_PARSE"
API_BAD_JSON_MSG = "response body is not valid JSON"
API_NO_ANSWER_MSG = "no response"
# The source name of alert events.
ALERT_SOURCE = "grafana"
# ---------------------------------------------------------------------------

# The wire schema of one price event, declared, never inferred.
EVENT_SCHEMA = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("commodity", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingest_interval_sec", T.IntegerType()),
])


def unwrap_kafka(df: DataFrame) -> DataFrame:
    """Kafka source rows -> (raw_payload, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp)."""
    return df.select(
        F.col("value").cast("string").alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
    )


def parse_events(df: DataFrame) -> DataFrame:
    """from_json with the declared schema, expanded; malformed JSON -> all NULL."""
    env = [c for c in ("raw_payload", "kafka_topic", "kafka_partition", "kafka_offset",
                       "kafka_timestamp") if c in df.columns]
    return (df.withColumn("e", F.from_json(F.col("raw_payload"), EVENT_SCHEMA))
            .select(*env, "e.*"))


def add_times(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Strict ``yyyy-MM-dd'T'HH:mm:ss'Z'`` parse (NULL if malformed; ANSI stays on)
    and the ingest timestamp (P2)."""
    its = ingest_ts if ingest_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    return (df.withColumn("event_ts", F.try_to_timestamp(F.col("timestamp"), F.lit(ISO_SECONDS))
                          .cast("timestamp_ntz"))
            .withColumn("ingest_ts", its)
            .drop("timestamp"))


def parse_and_type(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    return add_times(parse_events(df), ingest_ts)


# ------------------------------------------------------------------ producer side

def build_events(prices: DataFrame, source: str, interval_sec: int) -> DataFrame:
    """(commodity, symbol, price, ts) -> wire event columns with a UUID5 id."""
    return prices.select(
        F.lit(1).alias("schema_version"),
        ids.event_id("commodity", "ts").alias("event_id"),
        "commodity", "symbol",
        F.col("price").cast("double").alias("price"),
        F.lit("USD").alias("currency"),
        ids.iso_seconds("ts").alias("timestamp"),
        F.lit(source).alias("source"),
        F.lit(interval_sec).alias("ingest_interval_sec"),
    )


def to_kafka_rows(events: DataFrame) -> DataFrame:
    """key = commodity, value = compact JSON of the event (K6)."""
    return events.select(F.col("commodity").alias("key"),
                         F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value"))


# ------------------------------------------------------------------ API responses

_MAP = T.MapType(T.StringType(), T.StringType())


def parsed_prices(body: Column, requested: Column) -> Column:
    """array<struct<symbol, price>> parsed from one API response body.

    Shapes: {symbol, price}; {price} when exactly one symbol was requested;
    {SYM: {price}} filtered to the requested symbols.  An unparseable price
    drops only that symbol.
    """
    m = F.from_json(body, _MAP)
    syms = F.split(requested, ",")
    has_sym = F.map_contains_key(m, "symbol")
    has_price = F.map_contains_key(m, "price")
    shape_a = F.array(F.struct(m["symbol"].alias("symbol"),
                               m["price"].try_cast("double").alias("price")))
    shape_b = F.array(F.struct(syms[0].alias("symbol"),
                               m["price"].try_cast("double").alias("price")))
    shape_c = F.transform(syms, lambda s: F.struct(
        s.alias("symbol"),
        F.get_json_object(m[s], "$.price").try_cast("double").alias("price")))
    arr = (F.when(m.isNull(), F.array().cast("array<struct<symbol:string,price:double>>"))
           .when(has_sym & has_price, shape_a)
           .when(has_price & (F.size(syms) == 1), shape_b)
           .otherwise(shape_c))
    return F.filter(arr, lambda x: x["price"].isNotNull() & x["symbol"].isNotNull())


def flatten_price_responses(calls: DataFrame) -> DataFrame:
    """One row per (call, symbol, price) from stored API responses.

    Only responses that reached the parser count: HTTP < 400 and no
    payload-level ``status = error``.
    """
    ok_http = (F.col("http_status") < 400) & \
        F.coalesce(F.get_json_object("body", "$.status") != "error", F.lit(True))
    return (calls.filter(ok_http)
            .select("call_id", F.explode(parsed_prices(F.col("body"), F.col("symbols"))).alias("p"))
            .select("call_id", F.col("p.symbol").alias("symbol"), F.col("p.price").alias("price")))


def classify_api_calls(calls: DataFrame) -> DataFrame:
    """One monitoring row per API call (P17): ok flag, error_type, error_msg.

    429 and 5xx are logged with their status; any other failure before a
    parsed body (no status as after a timeout, other 4xx, no body or one that is
    not JSON) is an EXCEPTION with no status; a payload-level error is TD_ERROR; a parsed body without a usable
    price is EMPTY_PARSE.
    """
    st = F.col("http_status")
    td_error = F.coalesce(F.get_json_object("body", "$.status") == "error", F.lit(False))
    is_json = F.get_json_object("body", "$").isNotNull()
    n_prices = F.size(parsed_prices(F.col("body"), F.col("symbols")))
    logged_with_status = F.coalesce((st == 429) | st.between(500, 599), F.lit(False))
    answered = F.coalesce(st < 400, F.lit(False))
    exception = ~logged_with_status & ~(answered & is_json)
    etype = (F.when(st == 429, API_RATE_LIMIT)
             .when(st.between(500, 599), F.concat(F.lit(API_SERVER_PREFIX), st.cast("string")))
             .when(exception, API_EXCEPTION)
             .when(td_error, API_PAYLOAD_ERROR)
             .when(n_prices == 0, API_EMPTY_PARSE))
    msg = (F.when(logged_with_status, F.lit(None))
           .when(st.isNull(), F.lit(API_NO_ANSWER_MSG))
           .when(st >= 400, F.concat(F.lit("HTTP "), st.cast("string")))
           .when(~is_json, F.lit(API_BAD_JSON_MSG))
           .when(td_error, F.get_json_object("body", "$.message"))
           .when(n_prices == 0, F.col("body")))
    return calls.select(
        "call_id", "ts_utc", "symbols",
        F.when(exception, F.lit(None)).otherwise(st).cast("int").alias("http_status"),
        F.col("latency_ms").cast("int").alias("latency_ms"),
        etype.isNull().alias("ok"),
        etype.alias("error_type"),
        msg.alias("error_msg"),
    )


# ------------------------------------------------------------------ alert payloads

_ALERT_TOP = T.StructType([
    T.StructField("orgId", T.IntegerType()),
    T.StructField("panelId", T.IntegerType()),
    T.StructField("state", T.StringType()),
])
_ALERT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("ruleUid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("labels", T.StructType([T.StructField("severity", T.StringType())])),
    T.StructField("annotations", T.StructType([T.StructField("summary", T.StringType()),
                                               T.StructField("title", T.StringType())])),
])


def _is_object(body: Column) -> Column:
    """Whether a text is one JSON object and nothing more.

    The parser ignores what follows a value, so the text must also parse as the
    only element of an array and as the only value of an object.
    """
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))), "$", "array<variant>")
    inside = F.try_parse_json(F.concat(F.lit('{"body":'), body, F.lit("}")))
    is_object = (F.size(alone) == 1) & F.schema_of_variant(F.get(alone, 0)).startswith("OBJECT") & inside.isNotNull()
    return F.coalesce(is_object, F.lit(False))


def flatten_alerts(payloads: DataFrame, body_col: str = "body", source: str = ALERT_SOURCE) -> DataFrame:
    """One row per alert object of each webhook payload (L3).

    Bodies that are not one JSON object are rejected, with any JSON white space
    around it allowed and nothing else.  ``alerts`` is read as an array of
    variants so one odd element cannot null the whole array; only objects are
    kept (a string that looks like one is not), and a payload without any yields
    a single row with NULL alert fields.  Integer ids that are not JSON integers
    become NULL.
    """
    b = F.col(body_col)
    p = payloads.filter(_is_object(b)).withColumn("_p", F.from_json(b, _ALERT_TOP))
    items = F.try_variant_get(F.try_parse_json(b), "$.alerts", "array<variant>")
    objs = F.transform(F.filter(items, lambda e: F.schema_of_variant(e).startswith("OBJECT")), lambda e: F.to_json(e))
    x = p.select("*", F.explode_outer(objs).alias("_a_txt"))
    x = x.withColumn("_a", F.from_json("_a_txt", _ALERT))
    # JSON paths are case-sensitive; struct field resolution is not.
    new_uid, old_uid = F.get_json_object(b, "$.dashboardUID"), F.get_json_object(b, "$.dashboardUid")
    dash = F.when(F.length(new_uid) > 0, new_uid).otherwise(old_uid)
    keep = [c for c in payloads.columns if c != body_col]
    return x.select(
        *keep,
        F.lit(source).alias("source"),
        F.col("_a.labels.severity").alias("severity"),
        F.coalesce("_a.fingerprint", "_a.ruleUid", "_a.uid").alias("alert_uid"),
        F.coalesce("_a.annotations.summary", "_a.annotations.title", "_a.title").alias("alert_title"),
        F.coalesce("_a.status", "_a.state", "_p.state").alias("state"),
        dash.alias("dashboard_uid"),
        F.col("_p.panelId").alias("panel_id"),
        F.col("_p.orgId").alias("org_id"),
        b.alias("raw_payload"),
    )
