"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark plans: plain window functions, ordered
aggregates and JSON functions, evaluated by DuckDB over the same parquet
views (``events`` etc.).  The fixture derivations below restate the rules of
``tickflow.sources.fixtures`` in SQL.
"""

from __future__ import annotations

TICKS = """
ticks AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE event_type WHEN 'click' THEN 'bitcoin' WHEN 'view' THEN 'gold'
              WHEN 'purchase' THEN 'eurusd' WHEN 'signup' THEN 'silver' ELSE 'oil' END AS commodity,
         CASE event_type WHEN 'click' THEN 'BTC/USD' WHEN 'view' THEN 'XAU/USD'
              WHEN 'purchase' THEN 'EUR/USD' WHEN 'signup' THEN 'XAG/USD' ELSE 'WTI/USD' END AS symbol,
         CASE event_type WHEN 'click' THEN 60000.0e0 + value * 10
              WHEN 'view' THEN 2000.0e0 + value / 8
              WHEN 'purchase' THEN 1.08e0 + value / 50000
              WHEN 'signup' THEN 25.0e0 + value / 100
              ELSE 75.0e0 + value / 50 END AS price,
         'USD' AS currency,
         ts AS event_ts,
         'rest_api' AS source,
         ts + to_seconds(5 + event_id % 115) AS ingest_ts,
         CAST(event_id % 3 AS INTEGER) AS kafka_partition,
         CAST(event_id // 3 AS BIGINT) AS kafka_offset,
         event_id AS eid
  FROM events
),
as_of AS (SELECT max(ingest_ts) AS t FROM ticks)
"""

SPIKED = """
spiked AS (
  SELECT * REPLACE (CASE WHEN eid % 97 = 0 THEN price * 1.5e0 ELSE price END AS price) FROM ticks
)
"""

STALE = """
stale AS (
  SELECT * REPLACE (CASE WHEN symbol = 'WTI/USD' THEN event_ts - INTERVAL 3 DAY ELSE event_ts END AS event_ts) FROM ticks
)
"""


def q(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([TICKS.strip(), *[c.strip() for c in ctes]]) + "\n" + body


STG_TICKS = q("""
SELECT event_id, commodity, symbol, price, currency, event_ts, source, ingest_ts,
       kafka_partition, kafka_offset
FROM ticks
""")

def _dr(x: str, k: int) -> str:
    """Half-up rounding of the decimal value (matches tickflow.functions.numeric.dround)."""
    return f"coalesce(CAST(round(TRY_CAST({x} AS DECIMAL(38, 10)), {k}) AS DOUBLE), {x})"


VOLATILITY_BODY = f"""
SELECT commodity, symbol, hour_bucket,
       observations_count,
       {_dr('avg_price', 6)} AS avg_price,
       {_dr('min_price', 6)} AS min_price,
       {_dr('max_price', 6)} AS max_price,
       {_dr('coalesce(price_stddev, 0)', 6)} AS price_stddev,
       {_dr('max_price - min_price', 6)} AS price_range,
       {_dr('CASE WHEN avg_price IS NOT NULL AND avg_price <> 0 THEN (max_price - min_price) / avg_price END * 100', 4)} AS range_pct
FROM (
  SELECT commodity, symbol, date_trunc('hour', event_ts) AS hour_bucket,
         count(*) AS observations_count,
         CASE WHEN bool_or(abs(price) >= 1e15 OR (price <> 0 AND abs(price) < 1e-6)) THEN avg(price)
              ELSE CAST(sum(TRY_CAST(price AS DECIMAL(38, 12))) AS DOUBLE) / count(*) END AS avg_price,
         min(price) AS min_price, max(price) AS max_price,
         stddev_samp(price) AS price_stddev
  FROM ticks
  GROUP BY 1, 2, 3
) a
WHERE hour_bucket < date_trunc('hour', (SELECT t FROM as_of))
"""
PRICE_VOLATILITY_1H = q(VOLATILITY_BODY)
PRICE_VOLATILITY_EXTREME = q(VOLATILITY_BODY.replace("FROM ticks", "FROM extreme"), """
extreme AS (
  SELECT * REPLACE (CASE WHEN eid % 7 = 0 THEN 'X' || eid ELSE symbol END AS symbol,
                    CASE WHEN eid % 7 <> 0 THEN price WHEN eid % 4 = 0 THEN 1e30 WHEN eid % 4 = 1 THEN 3e-13
                         WHEN eid % 4 = 2 THEN -1e30 ELSE 4.5e17 END AS price) FROM ticks
)
""")

MINUTE_BODY = """
SELECT commodity, symbol, date_trunc('minute', event_ts) AS minute_bucket,
       first(price ORDER BY event_ts DESC, event_id DESC) AS last_price,
       count(*) AS n, min(price) AS min_price, max(price) AS max_price
FROM {src}
GROUP BY 1, 2, 3
"""
MINUTE_LAST_PRICE = q(MINUTE_BODY.format(src="ticks"))

LATEST_BODY = """
SELECT commodity, symbol, event_ts AS last_timestamp, price AS last_price, currency, source
FROM stale
QUALIFY row_number() OVER (PARTITION BY commodity, symbol
                           ORDER BY event_ts DESC, event_id DESC) = 1
"""
LATEST_PRICES = q(LATEST_BODY, STALE)

# Least absolute change of each class of move, and the largest minute-to-minute change, by symbol.
MOVE_CLASSES = """(VALUES
  ('BTC/USD', 0.003, 'MEDIUM_MOVE'), ('BTC/USD', 0.007, 'LARGE_MOVE'), ('BTC/USD', 0.015, 'EXTREME_MOVE'),
  ('XAU/USD', 0.0015, 'MEDIUM_MOVE'), ('XAU/USD', 0.003, 'LARGE_MOVE'), ('XAU/USD', 0.006, 'EXTREME_MOVE'),
  ('EUR/USD', 0.0006, 'MEDIUM_MOVE'), ('EUR/USD', 0.0012, 'LARGE_MOVE'), ('EUR/USD', 0.0025, 'EXTREME_MOVE')
) classes(symbol, least, class)"""
JUMP_LIMITS = "(VALUES ('EUR/USD', 0.05), ('XAU/USD', 0.10), ('BTC/USD', 0.30)) limits(symbol, most)"

# every pair of neighbouring ticks meets the classes it reaches; the highest one counts
EVENTS_BODY = f"""
SELECT p.commodity, p.symbol, p.before.event_ts AS prev_event_ts, p.event_ts,
       CAST(round(date_diff('microsecond', p.before.event_ts, p.event_ts) / 1e6) AS INTEGER) AS time_gap_seconds,
       p.price AS current_price, p.before.price AS prev_price,
       {_dr("any_value(p.change) * 100", 4)} AS price_change_pct,
       arg_max(class, least) AS event_type
FROM (
  SELECT *, (price - before.price) / nullif(before.price, 0) AS change
  FROM (SELECT *, lag({{{{'event_ts': event_ts, 'price': price}}}}) OVER (
                 PARTITION BY commodity, symbol ORDER BY event_ts, event_id) AS before FROM {{src}}) t
) p JOIN {MOVE_CLASSES} ON classes.symbol = p.symbol AND abs(p.change) >= CAST(classes.least AS DOUBLE)
WHERE p.event_ts - p.before.event_ts < INTERVAL 30 MINUTE
GROUP BY p.commodity, p.symbol, p.event_ts, p.event_id, p.price, p.before
"""
PRICE_EVENTS = q(EVENTS_BODY.format(src="ticks"))

# each minute meets the newest one before it
JUMPS_BODY = f"""
SELECT m.commodity, m.symbol, m.minute_bucket, m.last_price, b.last_price AS prev_price,
       abs(m.last_price - b.last_price) / b.last_price AS pct_change
FROM {{minutes}} m ASOF JOIN {{minutes}} b
     ON m.commodity = b.commodity AND m.symbol = b.symbol AND m.minute_bucket > b.minute_bucket
JOIN {JUMP_LIMITS} ON limits.symbol = m.symbol
WHERE b.last_price <> 0 AND abs(m.last_price - b.last_price) / b.last_price > CAST(most AS DOUBLE)
"""
PRICE_JUMPS = q(JUMPS_BODY.format(minutes="minutes"), SPIKED, "minutes AS (" + MINUTE_BODY.format(src="spiked") + ")")


# ---------------------------------------------------------------- ingest side

ENV = """
env AS (
  SELECT CASE WHEN v = 0 THEN substring(body, 1, 40)
              WHEN v = 14 THEN '{"schema_version":1,"ingest_interval_sec":360}'
              WHEN v = 15 THEN '' ELSE body END AS raw_payload,
         'prices' AS kafka_topic, kafka_partition, kafka_offset,
         event_ts + INTERVAL 2 SECOND AS kafka_timestamp, eid
  FROM (
    SELECT *, '{' || concat_ws(',',
        CASE WHEN v = 13 THEN NULL WHEN v = 11 THEN '"schema_version":2' ELSE '"schema_version":1' END,
        CASE WHEN v = 1 THEN NULL ELSE '"event_id":"' || event_id || '"' END,
        CASE WHEN v = 2 THEN NULL ELSE '"commodity":"' || commodity || '"' END,
        CASE WHEN v = 3 THEN NULL ELSE '"symbol":"' || symbol || '"' END,
        CASE WHEN v = 4 THEN NULL ELSE '"price":' ||
             CASE WHEN v = 8 THEN '"' || printf('%.8f', price) || '"'
                  WHEN v = 9 THEN printf('%.8f', -price)
                  WHEN v = 10 THEN printf('%.8f', price * 1000)
                  ELSE printf('%.8f', price) END END,
        CASE WHEN v = 5 THEN NULL ELSE '"currency":"USD"' END,
        CASE WHEN v = 7 THEN NULL ELSE '"timestamp":"' ||
             CASE WHEN v = 12 THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ')
                  ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') END || '"' END,
        CASE WHEN v = 6 THEN NULL ELSE '"source":"rest_api"' END,
        '"ingest_interval_sec":360') || '}' AS body
    FROM (SELECT *, eid % 23 AS v FROM ticks) t
  ) b
)
"""

REPLAYED = """
replayed AS (
  SELECT raw_payload, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, eid FROM env
  UNION ALL
  SELECT raw_payload, kafka_topic, kafka_partition, kafka_offset + 10000000, kafka_timestamp, eid
  FROM env WHERE eid % 10 = 0
)
"""


def validated_cte(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT *,
    CASE WHEN event_id IS NULL AND commodity IS NULL AND symbol IS NULL AND price IS NULL
              THEN 'JSON_PARSE_ERROR_OR_EMPTY'
         WHEN event_id IS NULL THEN 'MISSING_FIELD:event_id'
         WHEN commodity IS NULL THEN 'MISSING_FIELD:commodity'
         WHEN symbol IS NULL THEN 'MISSING_FIELD:symbol'
         WHEN price IS NULL THEN 'MISSING_FIELD:price'
         WHEN currency IS NULL THEN 'MISSING_FIELD:currency'
         WHEN source IS NULL THEN 'MISSING_FIELD:source'
         WHEN event_ts IS NULL THEN 'INVALID_FIELD:event_ts'
         WHEN price <= 0 THEN 'INVALID_FIELD:price<=0'
         WHEN schema_version IS DISTINCT FROM 1 THEN 'UNSUPPORTED_SCHEMA_VERSION'
         WHEN symbol = 'XAU/USD' AND (price < 500 OR price > 15000) THEN 'INVALID_FIELD:price_out_of_range'
         WHEN symbol = 'BTC/USD' AND (price < 100 OR price > 1000000) THEN 'INVALID_FIELD:price_out_of_range'
         WHEN symbol = 'EUR/USD' AND (price < 0.5 OR price > 2.0) THEN 'INVALID_FIELD:price_out_of_range'
    END AS error_reason
  FROM (
    SELECT raw_payload, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
      CASE WHEN json_type(j, '$.schema_version') IN ('UBIGINT', 'BIGINT')
           THEN CAST(json_extract(j, '$.schema_version') AS INTEGER) END AS schema_version,
      json_extract_string(j, '$.event_id') AS event_id,
      json_extract_string(j, '$.commodity') AS commodity,
      json_extract_string(j, '$.symbol') AS symbol,
      CASE WHEN json_type(j, '$.price') IN ('DOUBLE', 'UBIGINT', 'BIGINT')
           THEN CAST(json_extract(j, '$.price') AS DOUBLE) END AS price,
      json_extract_string(j, '$.currency') AS currency,
      try_strptime(json_extract_string(j, '$.timestamp'), '%Y-%m-%dT%H:%M:%SZ') AS event_ts,
      json_extract_string(j, '$.source') AS source,
      CASE WHEN json_type(j, '$.ingest_interval_sec') IN ('UBIGINT', 'BIGINT')
           THEN CAST(json_extract(j, '$.ingest_interval_sec') AS INTEGER) END AS ingest_interval_sec
    FROM (
      SELECT *, CASE WHEN raw_payload <> '' AND json_valid(raw_payload)
                          AND json_type(raw_payload) = 'OBJECT' THEN raw_payload END AS j
      FROM {src}
    ) p
  ) t
)
"""


VALIDATE_TICKS = q("""
SELECT kafka_partition, kafka_offset, event_id, commodity, symbol, price, currency, event_ts,
       source, schema_version, ingest_interval_sec, error_reason
FROM validated
""", ENV, validated_cte("validated", "env"))

DLQ_ROWS = q("""
SELECT stream_instance_id, batch_id, topic, kafka_partition, kafka_offset, error_reason,
       raw_payload, ts_utc
FROM (
  SELECT 'stream1' AS stream_instance_id, CAST(floor(kafka_offset / 500) AS BIGINT) AS batch_id,
         kafka_topic AS topic, kafka_partition, kafka_offset, error_reason, raw_payload,
         kafka_timestamp AS ts_utc
  FROM validated WHERE error_reason IS NOT NULL
) d
QUALIFY row_number() OVER (PARTITION BY stream_instance_id, batch_id, kafka_partition, kafka_offset
                           ORDER BY ts_utc) = 1
""", ENV, REPLAYED, validated_cte("validated", "replayed"))

BATCH_COUNTS = q("""
SELECT CAST(floor(kafka_offset / 500) AS BIGINT) AS batch_id,
       count(*) FILTER (WHERE error_reason IS NULL) AS good_rows,
       count(*) FILTER (WHERE error_reason IS NOT NULL) AS bad_rows
FROM validated GROUP BY 1
""", ENV, REPLAYED, validated_cte("validated", "replayed"))

ERROR_REASON_COUNTS = q("""
SELECT w.window_name, v.error_reason, count(*) AS n
FROM validated v
JOIN (VALUES ('15m', INTERVAL 15 MINUTE), ('1h', INTERVAL 1 HOUR), ('24h', INTERVAL 24 HOUR),
             ('7d', INTERVAL 7 DAY)) w(window_name, span)
  ON v.kafka_timestamp >= (SELECT t FROM as_of) - w.span
WHERE v.error_reason IS NOT NULL AND v.kafka_timestamp <= (SELECT t FROM as_of)
GROUP BY 1, 2
""", ENV, validated_cte("validated", "env"))

FX_CLOSED_SQL = """((dayofweek({t}) = 5 AND hour({t}) >= 22) OR dayofweek({t}) = 6
                 OR (dayofweek({t}) = 0 AND hour({t}) < 22))"""

FX_GATE = q(f"""
SELECT event_id, symbol, event_ts, {FX_CLOSED_SQL.format(t='event_ts')} AS fx_closed,
       NOT (symbol IN ('EUR/USD', 'XAU/USD') AND {FX_CLOSED_SQL.format(t='event_ts')}) AS publish
FROM ticks
""")

INSTANTS = """
instants AS (SELECT DISTINCT date_trunc('hour', event_ts) AS instant FROM ticks),
instruments AS (SELECT * FROM (VALUES ('gold', 'XAU/USD'), ('bitcoin', 'BTC/USD'),
                                      ('eurusd', 'EUR/USD')) v(commodity, symbol))
"""

MARKET_STATUS = q(f"""
SELECT instant, symbol AS instrument,
       CASE WHEN symbol IN ('EUR/USD', 'XAU/USD') AND {FX_CLOSED_SQL.format(t='instant')}
            THEN '● CLOSED' ELSE '● OPEN' END AS status
FROM instants CROSS JOIN instruments
""", INSTANTS)

ACTIVE_SYMBOLS = q(f"""
SELECT instant, commodity, symbol
FROM instants CROSS JOIN instruments
WHERE NOT (symbol IN ('EUR/USD', 'XAU/USD') AND {FX_CLOSED_SQL.format(t='instant')})
""", INSTANTS)

WITHIN_BOUNDS = q("""
SELECT event_id, symbol, price_checked,
       CASE symbol WHEN 'XAU/USD' THEN price_checked BETWEEN 500 AND 15000
                   WHEN 'BTC/USD' THEN price_checked BETWEEN 100 AND 1000000
                   WHEN 'EUR/USD' THEN price_checked BETWEEN 0.5 AND 2.0
                   ELSE TRUE END AS within_bounds
FROM (SELECT event_id, symbol,
             price * CASE eid % 5 WHEN 0 THEN 1000 WHEN 1 THEN 0.001e0 ELSE 1 END AS price_checked
      FROM ticks) t
""")

EVENT_UUID5 = q("""
SELECT event_id, name,
       substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
       lower(printf('%x', ((('0x' || substr(h, 17, 1))::INTEGER) & 3) | 8)) || substr(h, 18, 3)
       || '-' || substr(h, 21, 12) AS uuid
FROM (
  SELECT event_id, name, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(name)) AS h
  FROM (SELECT event_id, commodity || ':' || strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS name
        FROM ticks) n
) x
""")

API_RAW = """
api_raw AS (
  SELECT eid AS call_id, event_ts AS ts_utc,
         CASE WHEN w IN (2, 3, 6) THEN 'BTC/USD,XAU/USD,EUR/USD'
              WHEN w IN (7, 8) THEN 'BTC/USD,XAU/USD'
              WHEN w = 9 THEN 'BTC/USD' ELSE symbol END AS symbols,
         CAST(CASE WHEN eid % 60 IN (19, 39) THEN NULL WHEN eid % 20 = 7 THEN 429 WHEN eid % 20 = 13 THEN 503 ELSE 200 END AS INTEGER)
           AS http_status,
         CAST(floor(value * 10) AS INTEGER) AS latency_ms,
         CASE WHEN eid % 60 = 19 THEN NULL WHEN eid % 60 = 39 THEN '' WHEN eid % 20 = 17 THEN '<html>504 gateway timeout</html>' ELSE CASE w
           WHEN 0 THEN '{"symbol":"' || symbol || '","price":"' || p || '"}'
           WHEN 1 THEN '{"price":"' || p || '"}'
           WHEN 2 THEN '{"BTC/USD":{"price":"' || p || '"},"XAU/USD":{"price":"' || p2
                       || '"},"EUR/USD":{"price":"' || p3 || '"}}'
           WHEN 3 THEN '{"BTC/USD":{"price":"' || p || '"},"EUR/USD":{"price":"' || p3 || '"}}'
           WHEN 4 THEN '{"symbol":"' || symbol || '","price":"n/a"}'
           WHEN 5 THEN '{}'
           WHEN 6 THEN '{"status":"error","code":400,"message":"quota exceeded ' || eid || '"}'
           WHEN 7 THEN '{"BTC/USD":{"price":"' || p || '"},"XAU/USD":{"price":"n/a"}}'
           WHEN 8 THEN '{"price":"' || p || '"}'
           ELSE '{"symbol":"XAG/USD","price":"' || p || '"}' END END AS body
  FROM (SELECT t.*, e.value, eid % 10 AS w, printf('%.8f', price) AS p,
               printf('%.5f', 2000.0e0 + e.value / 8) AS p2,
               printf('%.7f', 1.08e0 + e.value / 50000) AS p3
        FROM ticks t JOIN events e ON e.event_id = t.eid) x
),
api_parsed AS (
  SELECT call_id, http_status, body, symbols, jbody,
         list_filter(
           CASE
             WHEN NOT jbody IS NOT NULL OR json_type(jbody) <> 'OBJECT' THEN []
             WHEN json_exists(jbody, '$.symbol') AND json_exists(jbody, '$.price')
               THEN [{'symbol': json_extract_string(jbody, '$.symbol'),
                      'price': TRY_CAST(json_extract_string(jbody, '$.price') AS DOUBLE)}]
             WHEN json_exists(jbody, '$.price') AND len(string_split(symbols, ',')) = 1
               THEN [{'symbol': symbols,
                      'price': TRY_CAST(json_extract_string(jbody, '$.price') AS DOUBLE)}]
             ELSE list_transform(string_split(symbols, ','), lambda s: {'symbol': s,
                      'price': TRY_CAST(json_extract_string(json_extract(jbody, '$."' || s || '"'), '$.price') AS DOUBLE)})
           END, lambda x: x.price IS NOT NULL AND x.symbol IS NOT NULL) AS prices
  FROM (SELECT *, CASE WHEN json_valid(body) THEN body END AS jbody FROM api_raw) r
)
"""

PRICE_RESPONSES = q("""
SELECT call_id, u.p.symbol AS symbol, u.p.price AS price
FROM (SELECT call_id, unnest(prices) AS p FROM api_parsed
      WHERE http_status < 400
        AND coalesce(json_extract_string(jbody, '$.status') <> 'error', TRUE)) u
""", API_RAW)

API_CLASSES_SELECT = """
SELECT call_id, ts_utc, symbols,
       CASE WHEN exception THEN NULL ELSE http_status END AS http_status,
       latency_ms, error_type IS NULL AS ok, error_type,
       CASE WHEN http_status = 429 OR http_status BETWEEN 500 AND 599 THEN NULL
            WHEN http_status IS NULL THEN 'no response'
            WHEN http_status >= 400 THEN 'HTTP ' || http_status
            WHEN NOT is_json THEN 'response body is not valid JSON'
            WHEN td_error THEN json_extract_string(jbody, '$.message')
            WHEN len(prices) = 0 THEN body END AS error_msg
FROM (
  SELECT *,
         CASE WHEN http_status = 429 THEN 'RATE_LIMIT_429'
              WHEN http_status BETWEEN 500 AND 599 THEN 'SERVER_' || http_status
              WHEN exception THEN 'EXCEPTION'
              WHEN td_error THEN 'TD_ERROR'
              WHEN len(prices) = 0 THEN 'EMPTY_PARSE' END AS error_type
  FROM (
    SELECT r.*, a.prices, a.jbody, td_error, is_json,
           r.http_status IS NULL OR (r.http_status < 400 AND NOT is_json)
             OR (r.http_status BETWEEN 400 AND 499 AND r.http_status <> 429) OR r.http_status > 599 AS exception
    FROM (SELECT *, coalesce(json_extract_string(CASE WHEN json_valid(body) THEN body END, '$.status')
                              = 'error', FALSE) AS td_error,
                 coalesce(json_valid(body), FALSE) AS is_json
          FROM api_raw) r
    JOIN api_parsed a USING (call_id)
  ) x
) c
"""
API_CALL_CLASSES = q(API_CLASSES_SELECT, API_RAW)
API_CALLS = "api_calls AS (" + API_CLASSES_SELECT + ")"



# ---------------------------------------------------------------- write paths

INSERT_NEW = q("""
SELECT event_id, commodity, symbol, price, currency, event_ts, source, kafka_partition, kafka_offset
FROM (SELECT * FROM validated WHERE error_reason IS NULL
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1) d
WHERE event_id NOT IN (SELECT event_id FROM ticks WHERE eid % 4 = 0)
""", ENV, REPLAYED, validated_cte("validated", "replayed"))

ARRIVALS = """
arrivals AS (
  SELECT *, CASE WHEN eid % 50 = 0 THEN event_ts + INTERVAL 45 MINUTE ELSE ingest_ts END AS arrival_ts
  FROM ticks
)
"""

UPSERT_MINUTE = q("""
SELECT * FROM run1 r
WHERE NOT EXISTS (SELECT 1 FROM run2 n WHERE n.commodity = r.commodity AND n.symbol = r.symbol
                  AND n.minute_bucket = r.minute_bucket)
UNION ALL
SELECT * FROM run2
""", ARRIVALS,
    "run1 AS (" + MINUTE_BODY.format(
        src="(SELECT * FROM arrivals WHERE arrival_ts < TIMESTAMP '2024-01-20 00:00:00') a") + ")",
    "bound AS (SELECT max(minute_bucket) - INTERVAL 30 MINUTE AS b FROM run1)",
    "run2 AS (" + MINUTE_BODY.format(
        src="(SELECT * FROM arrivals WHERE event_ts >= (SELECT b FROM bound)) a") + ")")

UPSERT_NEW_COLUMN = q("""
SELECT commodity, symbol, minute_bucket, last_price, NULL::BIGINT AS n, max_price, NULL::DOUBLE AS price_range FROM run1 r
WHERE NOT EXISTS (SELECT 1 FROM run2 n WHERE n.commodity = r.commodity AND n.symbol = r.symbol
                  AND n.minute_bucket = r.minute_bucket)
UNION ALL
SELECT commodity, symbol, minute_bucket, last_price, n, max_price, max_price - min_price FROM run2
""", ARRIVALS,
    "run1 AS (" + MINUTE_BODY.format(
        src="(SELECT * FROM arrivals WHERE arrival_ts < TIMESTAMP '2024-01-20 00:00:00') a") + ")",
    "bound AS (SELECT max(minute_bucket) - INTERVAL 30 MINUTE AS b FROM run1)",
    "run2 AS (" + MINUTE_BODY.format(
        src="(SELECT * FROM arrivals WHERE event_ts >= (SELECT b FROM bound)) a") + ")")

RETENTION = q("""
SELECT event_id, commodity, symbol, price, currency, event_ts, source, ingest_ts,
       kafka_partition, kafka_offset
FROM ticks WHERE event_ts >= (SELECT t FROM as_of) - INTERVAL 14 DAY
""")

# ---------------------------------------------------------------- monitoring

SECS = "date_diff('microsecond', {b}, {a}) / 1e6"

HEALTH_METRICS = q(f"""
SELECT CAST(round({SECS.format(a='(SELECT t FROM as_of)', b='max(ingest_ts)')}) AS INTEGER)
         AS time_since_last_ingest_seconds,
       count(*) FILTER (WHERE ingest_ts >= (SELECT t FROM as_of) - INTERVAL 6 MINUTE) AS events_last_6m,
       count(*) FILTER (WHERE ingest_ts >= (SELECT t FROM as_of) - INTERVAL 20 MINUTE
                        AND commodity = 'bitcoin') AS btc_events_last_20m
FROM ticks
""")

API_METRICS_18M = q(f"""
SELECT count(*) AS calls_18m, count(*) FILTER (WHERE NOT ok) AS errors_18m,
       CASE WHEN count(*) > 0 THEN {_dr('100.0e0 * count(*) FILTER (WHERE ok) / count(*)', 1)}
            ELSE 100.0e0 END AS success_rate_18m
FROM api_calls WHERE ts_utc >= (SELECT t FROM as_of) - INTERVAL 18 MINUTE
""", API_RAW, API_CALLS)

API_STATUS_HISTOGRAM = q("""
SELECT http_status, count(*) AS calls
FROM api_calls WHERE ts_utc >= (SELECT t FROM as_of) - INTERVAL 15 MINUTE
GROUP BY 1
""", API_RAW, API_CALLS)

API_LATENCY_P95 = q(f"""
SELECT {_dr('quantile_cont(CAST(latency_ms AS DOUBLE), 0.95)', 6)} AS p95_latency_ms, count(*) AS calls
FROM api_calls WHERE ts_utc >= (SELECT t FROM as_of) - INTERVAL 60 MINUTE
""", API_RAW, API_CALLS)

CONSUMER_LAG = q("""
SELECT CAST(coalesce(sum(lag), 0) AS BIGINT) AS total_lag,
       CAST(coalesce(max(lag), 0) AS BIGINT) AS max_partition_lag
FROM (
  SELECT greatest(0, high - CASE WHEN last_processed IS NULL THEN low
                                 ELSE greatest(last_processed + 1, low) END) AS lag
  FROM (SELECT kafka_partition AS partition, min(kafka_offset) + kafka_partition AS low,
               max(kafka_offset) + 1 + 7 * kafka_partition AS high
        FROM env GROUP BY kafka_partition) wm
  LEFT JOIN (SELECT kafka_partition AS partition, max(kafka_offset) AS last_processed
             FROM validated WHERE error_reason IS NULL GROUP BY 1) done USING (partition)
) pl
""", ENV, validated_cte("validated", "env"))

LAG_LOG = """
lag_log AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'other_group' ELSE 'tick_ingest' END AS group_id,
         'prices' AS topic, ts AS ts_utc, CAST(user_id % 600 AS BIGINT) AS total_lag,
         CAST(user_id % 200 AS BIGINT) AS max_partition_lag
  FROM events
)
"""

KAFKA_LAG_LATEST = q("""
SELECT group_id, topic, ts_utc, total_lag, max_partition_lag FROM lag_log
QUALIFY row_number() OVER (PARTITION BY group_id, topic ORDER BY ts_utc DESC) = 1
""", LAG_LOG)

DLQ_PER_DAY = q("""
SELECT date_trunc('day', kafka_timestamp) AS day, count(*) AS dlq_events
FROM validated
WHERE error_reason IS NOT NULL AND kafka_timestamp >= (SELECT t FROM as_of) - INTERVAL 7 DAY
  AND kafka_timestamp <= (SELECT t FROM as_of)
GROUP BY 1
""", ENV, validated_cte("validated", "env"))

DLQ_RATE = q(f"""
SELECT day, bad_rows, good_rows, {_dr('bad_rows / (bad_rows + good_rows)', 6)} AS dlq_rate
FROM (
  SELECT date_trunc('day', kafka_timestamp) AS day,
         count(*) FILTER (WHERE error_reason IS NOT NULL) AS bad_rows,
         count(*) FILTER (WHERE error_reason IS NULL) AS good_rows
  FROM validated
  WHERE kafka_timestamp >= (SELECT t FROM as_of) - INTERVAL 7 DAY
    AND kafka_timestamp <= (SELECT t FROM as_of)
  GROUP BY 1
) d
""", ENV, validated_cte("validated", "env"))

BACKUPS = """
backups AS (
  SELECT day + INTERVAL 2 HOUR AS backup_ts,
         CASE WHEN dayofmonth(day) % 6 = 0 THEN 'FAILED' ELSE 'OK' END AS status
  FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1) d
)
"""
LATEST_TICKS = "latest AS (" + LATEST_BODY.replace("FROM stale", "FROM ticks") + ")"


def fresh(col: str, table: str, where: str = "") -> str:
    return (f"SELECT coalesce(CAST(round({SECS.format(a='(SELECT t FROM as_of)', b=f'max({col})')})"
            f" AS BIGINT), 999999) AS seconds FROM {table} {where}")


FRESHNESS = q(f"""
SELECT 'ingest' AS source, seconds FROM ({fresh('ingest_ts', 'ticks')}) a
UNION ALL SELECT 'backup', seconds FROM ({fresh('backup_ts', 'backups', "WHERE status = 'OK'")}) b
UNION ALL SELECT 'mart_latest_prices', seconds FROM ({fresh('last_timestamp', 'latest')}) c
""", BACKUPS, LATEST_TICKS)

THROUGHPUT_PER_CYCLE = q(f"""
SELECT time_bucket(INTERVAL 6 MINUTE, ingest_ts, TIMESTAMP '1970-01-01 00:00:00') AS cycle_start,
       count(*) AS rows,
       {_dr("avg(date_diff('microsecond', event_ts, ingest_ts) / 1e6)", 6)} AS avg_latency_s
FROM ticks GROUP BY 1
""")

TABLE_SUMMARY = q("""
SELECT count(*) AS total_rows, max(event_ts) AS newest_event, max(ingest_ts) AS newest_ingest FROM ticks
""")


# The checks of each table, written out by hand: columns without NULL, keys, accepted values, expressions.
QUALITY_TABLES = {
    "stg_raw_prices": (
        "event_id commodity symbol price currency event_ts ingest_ts source", "event_id",
        ["event_ts <= ingest_ts + INTERVAL 1 MINUTE", "event_ts >= ingest_ts - INTERVAL 24 HOURS"],
        {"commodity": "'gold', 'bitcoin', 'eurusd'", "currency": "'USD'"}),
    "mart_latest_prices": (
        "commodity symbol last_timestamp last_price currency source", "commodity symbol",
        ["last_price > 0"], {"commodity": "'gold', 'bitcoin', 'eurusd'", "currency": "'USD'"}),
    "mart_minute_last_price": (
        "commodity symbol minute_bucket last_price n min_price max_price", "commodity symbol minute_bucket",
        ["min_price <= max_price", "last_price > 0", "min_price > 0", "max_price > 0", "n >= 1"],
        {"commodity": "'gold', 'bitcoin', 'eurusd'"}),
    "mart_price_events": (
        "commodity symbol prev_event_ts event_ts time_gap_seconds current_price prev_price price_change_pct event_type",
        "commodity symbol event_ts", ["price_change_pct is not null"],
        {"commodity": "'gold', 'bitcoin', 'eurusd'", "event_type": "'MEDIUM_MOVE', 'LARGE_MOVE', 'EXTREME_MOVE'"}),
    "mart_price_volatility_1h": (
        "commodity symbol hour_bucket observations_count avg_price min_price max_price price_stddev price_range range_pct",
        "commodity symbol hour_bucket", ["observations_count >= 1", "min_price <= max_price"],
        {"commodity": "'gold', 'bitcoin', 'eurusd'"}),
}


def _quality_sql() -> str:
    parts = []
    for table, (filled, key, holds, accepted) in QUALITY_TABLES.items():
        names, keys = filled.split(), key.split()
        found = [(f"not_null:{c}", f"count(*) FILTER (WHERE {c} IS NULL)") for c in names]
        found += [(f"accepted_values:{c}", f"count(*) FILTER (WHERE {c} NOT IN ({v}))") for c, v in accepted.items()]
        found += [(f"expression_is_true:{e}", f"count(*) FILTER (WHERE NOT ({e}))") for e in holds]
        single = f"WHERE {keys[0]} IS NOT NULL " if len(keys) == 1 else ""
        found.append((f"unique:{'+'.join(keys)}", f"(SELECT count(*) FROM (SELECT {', '.join(keys)} FROM {table} {single}"
                                                   f"GROUP BY ALL HAVING count(*) > 1) d)"))
        parts += [f"SELECT '{table}' AS table_name, '{n}' AS check_name, CAST({sql} AS BIGINT) AS failures FROM {table}" if "FILTER" in sql
                  else f"SELECT '{table}', '{n}', CAST({sql} AS BIGINT)" for n, sql in found]
    jumps = JUMPS_BODY.format(minutes="mart_minute_last_price")
    parts.append(f"SELECT 'mart_minute_last_price', 'price_jump:last_price', count(*) FROM ({jumps}) j")
    body = ("SELECT table_name, check_name, failures, "
            "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
            + "\nUNION ALL\n".join(parts) + "\n) x")
    return q(body,
             "stg_raw_prices AS (SELECT * FROM ticks)",
             "mart_latest_prices AS (" + LATEST_BODY.replace("FROM stale", "FROM ticks") + ")",
             "mart_minute_last_price AS (" + MINUTE_BODY.format(src="ticks") + ")",
             "mart_price_events AS (" + EVENTS_BODY.format(src="ticks") + ")",
             "mart_price_volatility_1h AS (" + VOLATILITY_BODY + ")")


RESULTS = """
results AS (
  SELECT date_trunc('hour', ts) + INTERVAL 30 MINUTE AS run_ts_utc,
         CASE WHEN event_type = 'error' AND value > 480 THEN 'fail'
              WHEN event_type = 'error' AND value > 460 THEN 'error'
              WHEN event_type = 'signup' AND value > 450 THEN 'warn'
              WHEN event_type = 'purchase' AND value > 470 THEN 'skipped'
              ELSE 'pass' END AS status
  FROM events
),
runs AS (
  SELECT run_ts_utc, 'dev' AS environment,
         CASE WHEN error > 0 OR fail > 0 THEN 'FAIL' WHEN warn > 0 THEN 'WARN' ELSE 'PASS' END AS status,
         total, pass, warn, error, fail, skipped
  FROM (SELECT run_ts_utc, CAST(count(*) AS INTEGER) AS total,
               CAST(count(*) FILTER (WHERE status = 'pass') AS INTEGER) AS pass,
               CAST(count(*) FILTER (WHERE status = 'warn') AS INTEGER) AS warn,
               CAST(count(*) FILTER (WHERE status = 'error') AS INTEGER) AS error,
               CAST(count(*) FILTER (WHERE status = 'fail') AS INTEGER) AS fail,
               CAST(count(*) FILTER (WHERE status = 'skipped') AS INTEGER) AS skipped
        FROM results GROUP BY 1) g
)
"""

TEST_RUN_SUMMARY = q("SELECT * FROM runs", RESULTS)

RULES = """
rules AS (SELECT * FROM (VALUES
  ('stale_ingest_13m', 'time_since_last_ingest_seconds', 'gt', 780.0e0, 'critical', 'Alerting', 120),
  ('btc_events_last_20m_low', 'btc_events_last_20m', 'lt', 2.0e0, 'warning', 'Alerting', 120),
  ('api_errors_18m_ge_1', 'errors_18m', 'gt', 0.0e0, 'warning', 'Alerting', 120),
  ('api_errors_18m_ge_3', 'errors_18m', 'gt', 2.0e0, 'critical', 'Alerting', 120),
  ('dlq_events_last_15m_gt_0', 'dlq_events_last_15m', 'gt', 0.0e0, 'warning', 'OK', 120),
  ('kafka_lag_warn_gt_50', 'total_lag', 'gt', 50.0e0, 'warning', 'OK', 120),
  ('kafka_lag_crit_gt_500', 'total_lag', 'gt', 500.0e0, 'critical', 'OK', 120),
  ('dbt_test_failures_35m', 'test_failures_35m', 'gt', 0.0e0, 'warning', 'Alerting', 120),
  ('kafka_partition_lag_warn_gt_30', 'max_partition_lag', 'gt', 30.0e0, 'warning', 'OK', 120),
  ('backup_stale_25h', 'backup_age_seconds', 'gt', 90000.0e0, 'warning', 'Alerting', 120),
  ('mart_latest_prices_stale_20m', 'latest_prices_age_seconds', 'gt', 1200.0e0, 'warning', 'Alerting', 120)
) r(rule_uid, metric, op, threshold, severity, no_data_state, for_seconds))
"""

ALERT_RULES = q(f"""
SELECT r.rule_uid, r.metric, m.value,
       CASE WHEN m.value IS NULL THEN r.no_data_state = 'Alerting'
            WHEN r.op = 'gt' THEN m.value > r.threshold
            WHEN r.op = 'lt' THEN m.value < r.threshold END AS breached,
       r.severity
FROM rules r LEFT JOIN (
  SELECT 'time_since_last_ingest_seconds' AS metric, CAST(coalesce(CAST(round({SECS.format(a='(SELECT t FROM as_of)', b='max(ingest_ts)')}) AS INTEGER), 999999) AS DOUBLE) AS value FROM ticks
  UNION ALL SELECT 'btc_events_last_20m', CAST(count(*) FILTER (WHERE ingest_ts >= (SELECT t FROM as_of) - INTERVAL 20 MINUTE AND commodity = 'bitcoin') AS DOUBLE) FROM ticks
  UNION ALL SELECT 'errors_18m', CAST(count(*) FILTER (WHERE NOT ok) AS DOUBLE) FROM api_calls WHERE ts_utc >= (SELECT t FROM as_of) - INTERVAL 18 MINUTE
  UNION ALL SELECT 'dlq_events_last_15m', CAST(count(*) AS DOUBLE) FROM validated WHERE error_reason IS NOT NULL AND kafka_timestamp >= (SELECT t FROM as_of) - INTERVAL 15 MINUTE
  UNION ALL SELECT 'total_lag', CAST(total_lag AS DOUBLE) FROM lag_latest
  UNION ALL SELECT 'max_partition_lag', CAST(max_partition_lag AS DOUBLE) FROM lag_latest
  UNION ALL SELECT 'test_failures_35m', CAST(count(*) AS DOUBLE) FROM runs WHERE run_ts_utc >= (SELECT t FROM as_of) - INTERVAL 35 MINUTE AND status = 'FAIL'
  UNION ALL SELECT 'backup_age_seconds', CAST(seconds AS DOUBLE) FROM ({fresh('backup_ts', 'backups', "WHERE status = 'OK'")}) b
  UNION ALL SELECT 'latest_prices_age_seconds', CAST(seconds AS DOUBLE) FROM ({fresh('last_timestamp', 'latest')}) c
) m ON m.metric = r.metric
""", API_RAW, API_CALLS, ENV, validated_cte("validated", "env"), LAG_LOG,
    """lag_latest AS (SELECT * FROM lag_log WHERE ts_utc <= (SELECT t FROM as_of)
       QUALIFY row_number() OVER (PARTITION BY group_id, topic ORDER BY ts_utc DESC) = 1)""",
    RESULTS, BACKUPS, LATEST_TICKS, RULES)
ALERT_RULES = ALERT_RULES.replace("FROM lag_latest\n", "FROM lag_latest WHERE group_id = 'tick_ingest' AND topic = 'prices'\n")

ALERT_TIMELINE = q("""
SELECT rule_uid, ts, value, breached,
       CASE WHEN breached AND date_diff('microsecond', island_start, ts) / 1e6 >= for_seconds THEN 'firing'
            WHEN breached THEN 'pending'
            WHEN coalesce(prev_b, FALSE)
                 AND date_diff('microsecond', island_start, prev_ts) / 1e6 >= for_seconds THEN 'resolved'
            ELSE 'normal' END AS state
FROM (
  SELECT *, max(start_ts) OVER (PARTITION BY rule_uid ORDER BY ts
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island_start
  FROM (
    SELECT *, CASE WHEN breached AND NOT coalesce(prev_b, FALSE) THEN ts END AS start_ts
    FROM (
      SELECT *, lag(breached) OVER w AS prev_b, lag(ts) OVER w AS prev_ts
      FROM (
        SELECT s.rule_uid, s.ts, s.value, r.for_seconds,
               CASE WHEN s.value IS NULL THEN r.no_data_state = 'Alerting'
                    WHEN r.op = 'gt' THEN s.value > r.threshold
                    WHEN r.op = 'lt' THEN s.value < r.threshold END AS breached
        FROM samples s JOIN rules r USING (rule_uid)
      ) b
      WINDOW w AS (PARTITION BY rule_uid ORDER BY ts)
    ) l
  ) st
) r2
""", RULES, """
samples AS (
  SELECT CASE event_type WHEN 'click' THEN 'btc_events_last_20m_low'
              WHEN 'view' THEN 'api_errors_18m_ge_1' WHEN 'purchase' THEN 'dlq_events_last_15m_gt_0'
              WHEN 'signup' THEN 'kafka_lag_warn_gt_50' ELSE 'stale_ingest_13m' END AS rule_uid,
         ts,
         CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(
           CASE event_type WHEN 'click' THEN floor(value) % 5 WHEN 'view' THEN floor(value) % 8
                WHEN 'purchase' THEN floor(value) % 3 WHEN 'signup' THEN floor(value)
                ELSE floor(value * 10) END AS DOUBLE) END AS value
  FROM events
)
""")

ALERT_PAYLOADS = q("""
SELECT payload_id, received_ts, 'grafana' AS source,
       json_extract_string(alert, '$.labels.severity') AS severity,
       coalesce(json_extract_string(alert, '$.fingerprint'), json_extract_string(alert, '$.ruleUid'),
                json_extract_string(alert, '$.uid')) AS alert_uid,
       coalesce(json_extract_string(alert, '$.annotations.summary'),
                json_extract_string(alert, '$.annotations.title'),
                json_extract_string(alert, '$.title')) AS alert_title,
       coalesce(json_extract_string(alert, '$.status'), json_extract_string(alert, '$.state'),
                json_extract_string(body, '$.state')) AS state,
       coalesce(nullif(json_extract_string(body, '$.dashboardUID'), ''),
                json_extract_string(body, '$.dashboardUid')) AS dashboard_uid,
       CASE WHEN json_type(body, '$.panelId') IN ('UBIGINT', 'BIGINT')
            THEN CAST(json_extract(body, '$.panelId') AS INTEGER) END AS panel_id,
       CASE WHEN json_type(body, '$.orgId') IN ('UBIGINT', 'BIGINT')
            THEN CAST(json_extract(body, '$.orgId') AS INTEGER) END AS org_id,
       body AS raw_payload
FROM (
  SELECT payload_id, received_ts, body,
         unnest(CASE WHEN len(objs) = 0 THEN [NULL::JSON] ELSE objs END) AS alert
  FROM (
    SELECT *, list_filter(CASE WHEN json_type(body, '$.alerts') = 'ARRAY'
                               THEN json_extract(body, '$.alerts[*]') ELSE [] END,
                          lambda e: json_type(e) = 'OBJECT') AS objs
    FROM payloads WHERE json_valid(body) AND json_type(body) = 'OBJECT'
  ) o
) x
""", """
payloads AS (
  SELECT event_id AS payload_id, ts AS received_ts,
    CASE event_id % 14
      WHEN 0 THEN '{"orgId":1,"dashboardUID":"dash-' || (event_id % 5) || '","panelId":' || (event_id % 7)
        || ',"state":"alerting","alerts":[{"status":"firing","fingerprint":"fp' || event_id
        || '","labels":{"severity":"critical"},"annotations":{"summary":"Lag ' || user_id
        || '"}},{"status":"resolved","fingerprint":"fp' || event_id
        || 'b","labels":{"severity":"warning"},"annotations":{"summary":"Lag ok"}}]}'
      WHEN 1 THEN '{"orgId":1,"state":"ok","title":"t' || event_id || '"}'
      WHEN 2 THEN '{"orgId":1,"alerts":"oops","state":"pending"}'
      WHEN 3 THEN '{"orgId":1,"alerts":[1,"x",{"state":"firing","ruleUid":"r' || event_id
        || '","title":"T' || event_id || '","labels":{"severity":"warning"}}]}'
      WHEN 4 THEN '{"orgId":1,"dashboardUID":"","dashboardUid":"old-' || (event_id % 5)
        || '","panelId":3,"alerts":[{"state":"alerting","uid":"u' || event_id
        || '","annotations":{"title":"Old ' || event_id || '"}}]}'
      WHEN 5 THEN '{"orgId":"1","panelId":"7","alerts":[{"status":"firing","fingerprint":"fp'
        || event_id || '"}]}'
      WHEN 6 THEN '{"orgId":2,"alerts":[],"state":"alerting"}'
      WHEN 7 THEN '{"alerts":[null,5]}'
      WHEN 8 THEN '["not","an","object"]'
      WHEN 10 THEN chr(10) || chr(9) || ' {"orgId":3,"alerts":[{"state":"ok","uid":"w' || event_id || '"}]}' || chr(13) || chr(10)
      WHEN 11 THEN '{"orgId":4,"state":"ok"} and more'
      WHEN 12 THEN '{"orgId":5,"alerts":["{\\"state\\":\\"ok\\"}",{"state":"firing","uid":"s"}]}'
      WHEN 13 THEN '{"orgId":6,"state":"ok"},{"orgId":7}'
      ELSE '{"orgId":1,"alerts":[' END AS body
  FROM events
)
""")

# ---------------------------------------------------------------- dashboards

def dround(x: str, k: int) -> str:
    """Round as exact decimal (HALF_UP on the decimal value), as numeric rounding does."""
    return _dr(x, k)


VOL_EV = ["vol AS (" + VOLATILITY_BODY + ")", "ev AS (" + EVENTS_BODY.format(src="ticks") + ")"]


def price_text(col: str) -> str:
    return (f"CASE WHEN symbol = 'EUR/USD' THEN printf('%.4f', {dround(col, 4)}) "
            f"ELSE printf('%.2f', {dround(col, 2)}) END")


PRICE_STATISTICS = q(f"""
SELECT v.symbol AS instrument,
       CASE WHEN v.symbol = 'EUR/USD' THEN printf('%.4f', {dround('v.avg_price', 4)})
            ELSE printf('%.2f', {dround('v.avg_price', 2)}) END AS avg_price,
       {dround('v.price_range', 4)} AS price_range, {dround('v.range_pct', 3)} AS range_pct,
       {dround('v.price_stddev', 4)} AS stddev, {dround('coalesce(m.largest_move, 0)', 3)} AS largest_move,
       CAST(coalesce(m.events, 0) AS BIGINT) AS events, v.observations_count AS observations
FROM (SELECT * FROM vol WHERE hour_bucket = (SELECT max(hour_bucket) FROM vol)) v
LEFT JOIN (
  SELECT symbol, max(abs(price_change_pct)) AS largest_move, count(*) AS events FROM ev
  WHERE event_ts >= (SELECT max(hour_bucket) FROM vol)
    AND event_ts < (SELECT max(hour_bucket) FROM vol) + INTERVAL 1 HOUR
  GROUP BY symbol
) m ON v.symbol = m.symbol
""", *VOL_EV)

HOURLY_PRICE_CHANGE = q(f"""
SELECT hour_bucket AS "time", {dround("range_pct", 2)} AS "range", symbol AS metric
FROM vol
WHERE hour_bucket BETWEEN (SELECT t FROM as_of) - INTERVAL 7 DAY AND (SELECT t FROM as_of)
""", VOL_EV[0])

RECENT_PRICE_EVENTS = q(f"""
SELECT strftime(event_ts, '%Y-%b-%d') AS "date", strftime(event_ts, '%H:%M:%S') AS "time",
       symbol AS instrument, event_type AS event, {dround('price_change_pct', 2)} AS change,
       {price_text('prev_price')} AS prev_price, {price_text('current_price')} AS current_price
FROM ev ORDER BY event_ts DESC, symbol LIMIT 100
""", VOL_EV[1])

LAST_UPDATE_LABEL = q("""
SELECT 'As of ' || strftime(event_ts, '%H:%M') || ' UTC ' || strftime(event_ts, '%d/%m/%Y') AS last_update
FROM ticks WHERE commodity = 'bitcoin' ORDER BY event_ts DESC, event_id DESC LIMIT 1
""")


# ---------------------------------------------------------------- streaming

STREAMING_HOURLY = q(VOLATILITY_BODY.replace(
    "WHERE hour_bucket < date_trunc('hour', (SELECT t FROM as_of))",
    "WHERE hour_bucket + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM ticks) - INTERVAL 2 HOUR"))

STREAMING_DEDUP = STG_TICKS

STREAM_INGEST = q("""
SELECT event_id, commodity, symbol, price, currency, event_ts, source, kafka_partition, kafka_offset
FROM validated WHERE error_reason IS NULL
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1
""", ENV, REPLAYED, validated_cte("validated", "replayed"))


SOURCE_FRESHNESS = q(f"""
SELECT seconds, CASE WHEN seconds > 1200 THEN 'error' WHEN seconds > 600 THEN 'warn'
                     ELSE 'pass' END AS status
FROM ({fresh('ingest_ts', 'ticks')}) f
""")

NEWEST_RAW_ROWS = q("""
SELECT event_id, commodity, symbol, price, currency, event_ts, source, ingest_ts,
       kafka_partition, kafka_offset
FROM ticks ORDER BY ingest_ts DESC, event_id DESC LIMIT 20
""")

NEWEST_TEST_RUNS = q("SELECT * FROM runs ORDER BY run_ts_utc DESC LIMIT 5", RESULTS)

TEST_PASS_RATE = q(f"""
SELECT {_dr('sum(pass) * 100.0e0 / sum(total)', 2)} AS pass_rate_pct,
       CAST(floor({SECS.format(a='(SELECT t FROM as_of)', b='max(run_ts_utc)')}) AS BIGINT)
         AS seconds_since_last_run
FROM runs WHERE run_ts_utc >= (SELECT t FROM as_of) - INTERVAL 24 HOUR
""", RESULTS)


TIES = """
ties AS (SELECT * REPLACE (date_trunc('minute', event_ts) AS event_ts) FROM ticks)
"""
MINUTE_LAST_PRICE_TIES = q(MINUTE_BODY.format(src="ties"), TIES)
PRICE_EVENTS_TIES = q(EVENTS_BODY.format(src="ties"), TIES)

UPSERT_PRICE_EVENTS = q("""
SELECT * FROM run1 r
WHERE NOT EXISTS (SELECT 1 FROM run2 n WHERE n.commodity = r.commodity AND n.symbol = r.symbol
                  AND n.event_ts = r.event_ts)
UNION ALL
SELECT * FROM run2
""", ARRIVALS,
    "run1 AS (" + EVENTS_BODY.format(
        src="(SELECT * FROM arrivals WHERE arrival_ts < TIMESTAMP '2024-01-20 00:00:00') a") + ")",
    "bound AS (SELECT max(event_ts) - INTERVAL 2 HOUR AS b FROM run1)",
    "run2 AS (" + EVENTS_BODY.format(
        src="(SELECT * FROM arrivals WHERE event_ts >= (SELECT b FROM bound)) a") + ")")


def vol_body(src: str, as_of_expr: str) -> str:
    return (VOLATILITY_BODY.replace("FROM ticks\n  GROUP BY", f"FROM {src}\n  GROUP BY")
            .replace("(SELECT t FROM as_of)", as_of_expr))


UPSERT_VOLATILITY = q("""
SELECT * FROM run1 r
WHERE NOT EXISTS (SELECT 1 FROM run2 n WHERE n.commodity = r.commodity AND n.symbol = r.symbol
                  AND n.hour_bucket = r.hour_bucket)
UNION ALL
SELECT * FROM run2
""", ARRIVALS,
    "run1 AS (" + vol_body("(SELECT * FROM arrivals WHERE arrival_ts < TIMESTAMP '2024-01-20 00:00:00') a",
                           "TIMESTAMP '2024-01-20 00:00:00'") + ")",
    "bound AS (SELECT max(hour_bucket) - INTERVAL 2 HOUR AS b FROM run1)",
    "run2 AS (" + vol_body("(SELECT * FROM arrivals WHERE event_ts >= (SELECT b FROM bound)) a",
                           "(SELECT t FROM as_of)") + ")")



def idle_sql(table: str, ts: str, tie: str) -> str:
    gap = f"date_diff('microsecond', prev_t, {ts}) / 1e6"
    return f"""
SELECT date_trunc('day', {ts}) AS day,
       {_dr(f'max({gap})', 6)} AS max_gap_seconds,
       count(*) FILTER (WHERE {gap} > 360) AS idle_gaps,
       {_dr(f'coalesce(sum(CASE WHEN {gap} > 360 THEN {gap} - 360 END), 0)', 6)} AS idle_seconds
FROM (SELECT {ts}, lag({ts}) OVER (ORDER BY {ts}, {tie}) AS prev_t FROM {table}) x
WHERE prev_t IS NOT NULL
GROUP BY 1
"""


TEST_DOCUMENTS = q("""
SELECT day, 'dev' AS environment, CASE WHEN broken OR error > 0 OR fail > 0 THEN 'FAIL' WHEN warn > 0 THEN 'WARN' ELSE 'PASS' END AS status,
       CASE WHEN broken THEN 0 ELSE total END AS total, CASE WHEN broken THEN 0 ELSE pass END AS pass, CASE WHEN broken THEN 0 ELSE warn END AS warn,
       CASE WHEN broken THEN 1 ELSE error END AS error, CASE WHEN broken THEN 0 ELSE fail END AS fail,
       CASE WHEN broken THEN 0 ELSE skipped END AS skipped, broken
FROM (SELECT run_ts_utc::DATE AS day, day(run_ts_utc::DATE) % 7 = 0 AS broken, count(*)::INTEGER AS total,
             (count(*) FILTER (WHERE status = 'pass'))::INTEGER AS pass, (count(*) FILTER (WHERE status = 'warn'))::INTEGER AS warn,
             (count(*) FILTER (WHERE status = 'error'))::INTEGER AS error, (count(*) FILTER (WHERE status = 'fail'))::INTEGER AS fail,
             (count(*) FILTER (WHERE status = 'skipped'))::INTEGER AS skipped
      FROM results GROUP BY ALL) x
""", RESULTS)

ALERT_RULES_ERROR = f"""
SELECT rule_uid, metric, CASE WHEN metric <> 'backup_age_seconds' THEN value END AS value, metric = 'backup_age_seconds' OR breached AS breached, severity,
       CASE WHEN metric = 'backup_age_seconds' THEN 'Error' WHEN value IS NULL THEN 'NoData' WHEN breached THEN 'Alerting' ELSE 'Normal' END AS state
FROM ({ALERT_RULES}) evaluated
"""

ALERT_STREAM = f"""
SELECT source, severity, alert_uid, alert_title, state, dashboard_uid, panel_id, org_id,
       translate(raw_payload, chr(13) || chr(10), '  ') AS raw_payload,
       sum(CASE WHEN payload_id % 5 = 0 THEN 2 ELSE 1 END)::BIGINT AS alerts, 2::BIGINT AS runs, 2::BIGINT AS most_runs
FROM ({ALERT_PAYLOADS}) flat GROUP BY ALL
"""

INGEST_PROGRESS = q("""
SELECT 4::BIGINT AS batches, count(*) AS input_rows, count(*) FILTER (WHERE error_reason IS NULL) AS good_rows,
       count(*) FILTER (WHERE error_reason IS NOT NULL) AS bad_rows, 0::BIGINT AS over_limit FROM validated
""", ENV, validated_cte("validated", "env"))

INGEST_IDLE_TIME = q(idle_sql("ticks", "ingest_ts", "event_id"))
API_IDLE_TIME = q(idle_sql("api_calls", "ts_utc", "call_id"), API_RAW, API_CALLS)


STREAM_LATEST_PRICES = q("""
SELECT commodity, symbol, event_ts AS last_timestamp, price AS last_price, currency, source
FROM validated WHERE error_reason IS NULL
QUALIFY row_number() OVER (PARTITION BY commodity, symbol ORDER BY event_ts DESC, event_id DESC) = 1
""", ENV, REPLAYED, validated_cte("validated", "replayed"))


KAFKA_ENVELOPE = q("""
SELECT raw_payload, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp FROM env
""", ENV)

VALIDATE_TICKS_JOIN = q("SELECT kafka_partition, kafka_offset, error_reason FROM validated", ENV, validated_cte("validated", "env"))

BUILT_EVENTS = q("""
SELECT commodity AS key, 1 AS schema_version,
       substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
       lower(printf('%x', ((('0x' || substr(h, 17, 1))::INTEGER) & 3) | 8)) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS event_id,
       commodity, symbol, price, 'USD' AS currency, t AS timestamp, 'rest_api' AS source, 360 AS ingest_interval_sec
FROM (SELECT *, strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS t,
             sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(commodity || ':' || strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ'))) AS h FROM ticks) x
""")

STORED_TICKS_AS_OF = STG_TICKS.rstrip() + "\nWHERE event_ts <= TIMESTAMP '2024-01-20 00:00:00'\n"

WATERMARK_LAG = q("""
SELECT w.partition, CAST(greatest(0, high - greatest(coalesce(last + 1, low), low)) AS BIGINT) AS lag
FROM (SELECT kafka_partition AS partition, min(kafka_offset) + kafka_partition AS low,
             max(kafka_offset) + 1 + 7 * kafka_partition AS high FROM env GROUP BY kafka_partition) w
LEFT JOIN (SELECT kafka_partition AS partition, max(kafka_offset) AS last FROM validated
           WHERE error_reason IS NULL GROUP BY kafka_partition) d ON d.partition = w.partition
""", ENV, validated_cte("validated", "env"))

INGEST_METRICS = q("""
SELECT CAST(count(*) FILTER (WHERE error_reason IS NULL) AS BIGINT) AS good_rows,
       CAST(count(DISTINCT event_id) FILTER (WHERE error_reason IS NULL) AS BIGINT) AS inserted,
       CAST(count(*) FILTER (WHERE error_reason IS NULL) - count(DISTINCT event_id) FILTER (WHERE error_reason IS NULL) AS BIGINT) AS conflict_skipped,
       CAST(count(*) FILTER (WHERE error_reason IS NOT NULL) AS BIGINT) AS bad_rows, CAST(0 AS BIGINT) AS dlq_write_failed
FROM validated
""", ENV, REPLAYED, validated_cte("validated", "replayed"))


def all_sql() -> dict[str, str]:
    return {
        "stg_ticks": STG_TICKS,
        "price_volatility_1h": PRICE_VOLATILITY_1H,
        "price_volatility_extreme": PRICE_VOLATILITY_EXTREME,
        "health_metrics_late": HEALTH_METRICS,
        "minute_last_price": MINUTE_LAST_PRICE,
        "latest_prices": LATEST_PRICES,
        "latest_prices_single_pass": LATEST_PRICES,
        "price_events": PRICE_EVENTS,
        "price_jumps": PRICE_JUMPS,
        "validate_ticks": VALIDATE_TICKS,
        "kafka_envelope": KAFKA_ENVELOPE,
        "validate_ticks_join": VALIDATE_TICKS_JOIN,
        "built_events": BUILT_EVENTS,
        "stored_ticks_as_of": STORED_TICKS_AS_OF,
        "watermark_lag": WATERMARK_LAG,
        "ingest_metrics": INGEST_METRICS,
        "ingest_replayed": STREAM_INGEST,
        "dlq_rows": DLQ_ROWS,
        "batch_counts": BATCH_COUNTS,
        "error_reason_counts": ERROR_REASON_COUNTS,
        "fx_gate": FX_GATE,
        "market_status": MARKET_STATUS,
        "active_symbols": ACTIVE_SYMBOLS,
        "within_bounds": WITHIN_BOUNDS,
        "event_uuid5": EVENT_UUID5,
        "price_responses": PRICE_RESPONSES,
        "api_call_classes": API_CALL_CLASSES,
        "insert_new": INSERT_NEW,
        "insert_new_scan": INSERT_NEW,
        "upsert_minute": UPSERT_MINUTE,
        "retention": RETENTION,
        "minute_last_price_ties": MINUTE_LAST_PRICE_TIES,
        "price_events_ties": PRICE_EVENTS_TIES,
        "upsert_price_events": UPSERT_PRICE_EVENTS,
        "upsert_volatility": UPSERT_VOLATILITY,
        "health_metrics": HEALTH_METRICS,
        "api_metrics_18m": API_METRICS_18M,
        "api_status_histogram": API_STATUS_HISTOGRAM,
        "api_latency_p95": API_LATENCY_P95,
        "consumer_lag": CONSUMER_LAG,
        "kafka_lag_latest": KAFKA_LAG_LATEST,
        "dlq_per_day": DLQ_PER_DAY,
        "dlq_rate": DLQ_RATE,
        "freshness": FRESHNESS,
        "throughput_per_cycle": THROUGHPUT_PER_CYCLE,
        "table_summary": TABLE_SUMMARY,
        "quality_results": _quality_sql(),
        "test_run_summary": TEST_RUN_SUMMARY,
        "alert_rules": ALERT_RULES,
        "alert_timeline": ALERT_TIMELINE,
        "alert_payloads": ALERT_PAYLOADS,
        "price_statistics": PRICE_STATISTICS,
        "hourly_price_change": HOURLY_PRICE_CHANGE,
        "recent_price_events": RECENT_PRICE_EVENTS,
        "last_update_label": LAST_UPDATE_LABEL,
        "price_events_bucketed": PRICE_EVENTS,
        "price_events_join": PRICE_EVENTS,
        "upsert_new_column": UPSERT_NEW_COLUMN,
        "test_documents": TEST_DOCUMENTS,
        "alert_rules_error": ALERT_RULES_ERROR,
        "streaming_moves_late": PRICE_EVENTS,
        "streaming_hourly_late": PRICE_VOLATILITY_1H,
        "ingest_progress": INGEST_PROGRESS,
        "alert_stream": ALERT_STREAM,
        "source_freshness": SOURCE_FRESHNESS,
        "ingest_idle_time": INGEST_IDLE_TIME,
        "api_idle_time": API_IDLE_TIME,
        "newest_raw_rows": NEWEST_RAW_ROWS,
        "newest_test_runs": NEWEST_TEST_RUNS,
        "test_pass_rate": TEST_PASS_RATE,
        "streaming_hourly": STREAMING_HOURLY,
        "streaming_dedup": STREAMING_DEDUP,
        "streaming_moves": PRICE_EVENTS,
        "stream_ingest": STREAM_INGEST,
        "stream_latest_prices": STREAM_LATEST_PRICES,
    }
