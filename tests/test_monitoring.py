"""Lag arithmetic (A9), API responses (S5/P17), alert payloads (L3), rules
and timelines (L1/L2), quality checks (Q1-Q7)."""

import json

import pytest
from pyspark.sql import functions as F

from tickflow.operators import ingest, monitor, quality

LAG_CASES = [  # (high, low, last_processed, expected)
    (40, 0, 39, 0),          # all read
    (40, 0, 31, 8),          # 32 to 39 are left
    (40, 0, None, 40),       # nothing read yet
    (712, 712, None, 0),     # all expired, nothing new
    (750, 712, None, 38),    # only what has not expired counts
    (750, 712, 55, 38),      # read up to before the oldest left
    (40, 0, 0, 39), (40, 0, 20, 19),
    (40, 0, 77, 0),          # the topic was made anew: never below 0
]


def test_partition_lag(spark):
    wm = spark.createDataFrame([(i, lo, hi) for i, (hi, lo, _, _) in enumerate(LAG_CASES)],
                               "partition int, low bigint, high bigint")
    raw = spark.createDataFrame([(i, last) for i, (_, _, last, _) in enumerate(LAG_CASES) if last is not None]
                                + [(99, 5)],  # a partition only in the table is ignored
                                "kafka_partition int, kafka_offset bigint")
    got = {r["partition"]: r["lag"] for r in monitor.partition_lag(wm, raw).collect()}
    assert got == {i: exp for i, (_, _, _, exp) in enumerate(LAG_CASES)}
    tot = monitor.consumer_lag(wm, raw).collect()[0]
    assert tot["total_lag"] == sum(c[3] for c in LAG_CASES)
    assert tot["max_partition_lag"] == max(c[3] for c in LAG_CASES)


API = [  # (call_id, status, symbols, body, expected prices, expected error_type)
    (1, 200, "BTC/USD", '{"symbol":"BTC/USD","price":"41234.75"}', {"BTC/USD": 41234.75}, None),
    (2, 200, "XAU/USD", '{"price":"1875.4"}', {"XAU/USD": 1875.4}, None),
    (3, 200, "EUR/USD,XAU/USD", '{"EUR/USD":{"price":"1.25"},"XAU/USD":{"price":"1900"}}',
     {"EUR/USD": 1.25, "XAU/USD": 1900.0}, None),
    (4, 200, "BTC/USD,XAU/USD,EUR/USD", '{"XAU/USD":{"price":"7"}}', {"XAU/USD": 7.0}, None),
    (5, 200, "EUR/USD", '{"symbol":"EUR/USD","price":"--"}', {}, "EMPTY_PARSE"),
    (6, 200, "EUR/USD", "{}", {}, "EMPTY_PARSE"),
    (7, 429, "EUR/USD", "{}", {}, "RATE_LIMIT_429"),
    (8, 502, "EUR/USD", "{}", {}, "SERVER_502"),
    (9, 403, "EUR/USD", "{}", {}, "EXCEPTION"),
    (10, 200, "EUR/USD", '{"status":"error","message":"plan expired"}', {}, "TD_ERROR"),
    (11, 200, "EUR/USD,XAU/USD", '{"price":"3"}', {}, "EMPTY_PARSE"),
    (12, 200, "XAU/USD,EUR/USD", '{"XAU/USD":{"price":"--"},"EUR/USD":{"price":1.5}}', {"EUR/USD": 1.5}, None),
    (13, 200, "EUR/USD", "<p>busy</p>", {}, "EXCEPTION"),
    (14, 200, "EUR/USD", '[7, "EUR/USD"]', {}, "EMPTY_PARSE"),
    (15, None, "EUR/USD", None, {}, "EXCEPTION"),       # a timeout
    (16, None, "EUR/USD", "", {}, "EXCEPTION"),
    (17, 200, "EUR/USD", None, {}, "EXCEPTION"),
    (18, 200, "EUR/USD", '{"note":"' + 900 * "n" + '"}', {}, "EMPTY_PARSE"),
]


@pytest.fixture(scope="module")
def calls(spark):
    return spark.createDataFrame([(c, s, sy, b, 10) for c, s, sy, b, _, _ in API],
                                 "call_id bigint, http_status int, symbols string, body string, latency_ms int") \
        .withColumn("ts_utc", F.lit("2025-06-02 08:00:00").cast("timestamp_ntz"))


def test_price_responses(calls):
    got = {}
    for r in ingest.flatten_price_responses(calls).collect():
        got.setdefault(r["call_id"], {})[r["symbol"]] = r["price"]
    for c, _, _, _, exp, _ in API:
        assert got.get(c, {}) == exp, c


def test_api_call_classes(calls):
    got = {r["call_id"]: r for r in ingest.classify_api_calls(calls).collect()}
    for c, st, _, body, _, et in API:
        assert got[c]["error_type"] == et, c
        assert got[c]["ok"] == (et is None)
    assert got[9]["http_status"] is None and got[9]["error_msg"] == "HTTP 403"
    assert got[10]["error_msg"] == "plan expired"
    assert len(got[18]["error_msg"]) == 911             # the whole body
    assert got[7]["http_status"] == 429 and got[7]["error_msg"] is None
    assert got[13]["http_status"] is None       # failed before a parsed body


ALERTS = {
    1: {"orgId": 4, "panelId": 21, "dashboardUID": "main",
        "alerts": [{"status": "firing", "fingerprint": "a7", "labels": {"severity": "page"},
                    "annotations": {"summary": "Ticks are late"}}]},
    2: {"dashboardUid": "side", "alerts": [{"state": "pending", "ruleUid": "lag", "title": "Lag grows"}]},
    3: {"orgId": "four", "panelId": "21", "alerts": [{"status": "firing"}]},
    4: {"alerts": [{"status": "resolved"}, {"status": "firing"}, {"status": "pending"}]},
    5: {"state": "pending"},
    6: {"alerts": 12},
    7: {"alerts": []},
    8: {"alerts": [3.5, {"status": "resolved"}, None, '{"status": "firing"}']},
    9: {"alerts": [None, "text"]},
    10: [{"alerts": []}],
    11: {"alerts": [{"fingerprint": None, "ruleUid": "second"}]},
}
RAW_ALERTS = {20: "\r\n\t" + json.dumps(ALERTS[5]) + "\n", 21: json.dumps(ALERTS[5]) + " tail",
              22: json.dumps(ALERTS[5]) * 2, 23: '{"state":"ok"}],[{"state":"ok"}', 24: "", 25: None, 26: '{"state":'}


@pytest.fixture(scope="module")
def alert_rows(spark):
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in ALERTS.items()] + list(RAW_ALERTS.items()), "payload_id int, body string")
    rows = {}
    for r in ingest.flatten_alerts(df).collect():
        rows.setdefault(r["payload_id"], []).append(r)
    return rows


def test_alert_fields(alert_rows):
    r = alert_rows[1][0]
    assert (r["source"], r["severity"], r["alert_uid"]) == (ingest.ALERT_SOURCE, "page", "a7")
    assert (r["alert_title"], r["state"]) == ("Ticks are late", "firing")
    assert (r["dashboard_uid"], r["panel_id"], r["org_id"]) == ("main", 21, 4)
    assert json.loads(r["raw_payload"]) == ALERTS[1]


def test_alert_older_names(alert_rows):
    r = alert_rows[2][0]
    assert (r["severity"], r["alert_uid"], r["alert_title"], r["state"], r["dashboard_uid"]) == \
        (None, "lag", "Lag grows", "pending", "side")


def test_alert_non_integer_ids(alert_rows):
    r = alert_rows[3][0]
    assert (r["panel_id"], r["org_id"]) == (None, None)


@pytest.mark.parametrize("pid,n", [(4, 3), (5, 1), (6, 1), (7, 1), (8, 1), (9, 1)])
def test_alert_row_counts(alert_rows, pid, n):
    assert len(alert_rows[pid]) == n


def test_alert_fallbacks(alert_rows):
    assert alert_rows[5][0]["state"] == "pending"        # payload state when no alert
    assert alert_rows[8][0]["state"] == "resolved"        # non-objects dropped
    assert alert_rows[11][0]["alert_uid"] == "second"     # None counts as missing
    assert 10 not in alert_rows                           # non-object body rejected
    assert set(alert_rows) & set(RAW_ALERTS) == {20}      # white space around is fine, anything else is not


def test_rules_no_data_policy(spark):
    rules = monitor.rules_df(spark)
    metrics = spark.createDataFrame([("errors_18m", 3.0), ("btc_events_last_20m", 5.0)],
                                    "metric string, value double")
    got = {r["rule_uid"]: r["breached"] for r in monitor.evaluate_rules(metrics, rules).collect()}
    assert got["api_errors_18m_ge_1"] and got["api_errors_18m_ge_3"]
    assert got["btc_events_last_20m_low"] is False
    assert got["kafka_lag_warn_gt_50"] is False           # no data, policy OK
    assert got["stale_ingest_13m"] is True                # no data, policy Alerting


def test_alert_timeline_states(spark):
    rules = monitor.rules_df(spark)
    seq = [(0, 0.0), (30, 1.0), (60, 1.0), (90, 1.0), (150, 2.0), (180, 0.0), (210, 1.0), (240, 0.0)]
    samples = [("api_errors_18m_ge_1", f"2025-06-02 08:{s // 60:02d}:{s % 60:02d}", v) for s, v in seq]
    df = spark.createDataFrame(samples, "rule_uid string, t string, value double") \
        .select("rule_uid", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
    got = [r["state"] for r in monitor.alert_timeline(df, rules).orderBy("ts").collect()]
    assert got == ["normal", "pending", "pending", "pending", "firing", "resolved", "pending", "normal"]


def test_quality_checks(spark):
    df = spark.createDataFrame([("1", "gold", 1.0), ("1", "oil", None), (None, "gold", -1.0)],
                               "event_id string, commodity string, price double")
    specs = {"t": [quality.not_null("event_id"), quality.unique("event_id"),
                   quality.accepted("commodity", ["gold"]), quality.expression("price > 0")]}
    got = {r["check_name"]: (r["failures"], r["status"])
           for r in quality.run_checks({"t": df}, specs).collect()}
    assert got["not_null:event_id"] == (1, "fail")
    assert got["unique:event_id"] == (1, "fail")       # one duplicated key; NULL is none
    assert got["accepted_values:commodity"] == (1, "fail")
    assert got["expression_is_true:price > 0"] == (1, "fail")  # NULL result passes


def test_summarise_status_rule(spark):
    res = spark.createDataFrame([("r1", "pass"), ("r1", "warn"), ("r2", "pass"), ("r3", "error"),
                                 ("r3", "pass"), ("r4", "skipped")], "run_ts_utc string, status string")
    got = {r["run_ts_utc"]: (r["status"], r["total"]) for r in quality.summarise(res).collect()}
    assert got == {"r1": ("WARN", 2), "r2": ("PASS", 1), "r3": ("FAIL", 2), "r4": ("PASS", 1)}


def test_test_documents(spark, tmp_path):
    run = {"metadata": {"generated_at": "2024-03-01T10:00:00Z"}, "results": [{"unique_id": "a", "status": "pass"}, {"unique_id": "b", "status": "warn"}]}
    bodies = {"good": json.dumps(run, indent=2), "cut": json.dumps(run)[:60], "empty_results": json.dumps({"results": []}),
              "no_results": json.dumps({"metadata": {}}), "failed": json.dumps({**run, "results": [{"status": "fail"}]})}
    for name, body in bodies.items():
        (tmp_path / f"{name}.json").write_text(body)
    docs = quality.read_test_documents(spark, str(tmp_path))
    got = {r["file"].rsplit("/", 1)[1][:-5]: (r["status"], r["total"], r["warn"], r["error"], r["fail"], r["broken"])
           for r in quality.document_runs(docs, keep=["file"]).collect()}
    assert got == {"good": ("WARN", 2, 1, 0, 0, False), "cut": ("FAIL", 0, 0, 1, 0, True), "empty_results": ("PASS", 0, 0, 0, 0, False),
                   "no_results": ("FAIL", 0, 0, 1, 0, True), "failed": ("FAIL", 1, 0, 0, 1, False)}
    assert docs.filter("run_ts_utc is null").isEmpty()


def test_a_failing_metric_costs_its_own_value_only(spark):
    def boom():
        raise RuntimeError("no such table\nmore")
    one = spark.createDataFrame([("total_lag", 60.0)], "metric string, value double")
    queries = {"total_lag": lambda: one, "errors_18m": boom, "backup_age_seconds": lambda: one.limit(0),
               "max_partition_lag": lambda: one.select("metric", F.raise_error(F.lit("late")).cast("double").alias("value"))}
    res = monitor.metric_results(spark, queries)
    assert {r["metric"] for r in res.filter("error is not null").collect()} == {"errors_18m", "max_partition_lag"}
    ev = {r["rule_uid"]: (r["breached"], r["state"]) for r in monitor.evaluate_rules(res, monitor.rules_df(spark)).collect()}
    assert ev["kafka_lag_warn_gt_50"] == (True, "Alerting") and ev["kafka_lag_crit_gt_500"] == (False, "Normal")
    assert ev["api_errors_18m_ge_1"] == (True, "Error") and ev["kafka_partition_lag_warn_gt_30"] == (True, "Error")
    assert ev["backup_stale_25h"] == (True, "NoData") and ev["dlq_events_last_15m_gt_0"] == (False, "NoData")
    grouped = monitor.grouped_alerts(monitor.evaluate_rules(res, monitor.rules_df(spark)), "metric").collect()
    assert {(r["metric"], r["severity"]): r["alerts"] for r in grouped}[("errors_18m", "critical")] == 1


def test_lag_can_count_dlq_offsets_as_processed(spark):
    wm = spark.createDataFrame([(0, 0, 10)], "partition int, low bigint, high bigint")
    raw = spark.createDataFrame([(0, 7)], "kafka_partition int, kafka_offset bigint")
    dlq = spark.createDataFrame([(0, 9)], "kafka_partition int, kafka_offset bigint")
    assert monitor.consumer_lag(wm, raw).collect()[0]["total_lag"] == 2
    assert monitor.consumer_lag(wm, raw, extra_offsets=dlq).collect()[0]["total_lag"] == 0


def test_late_ticks_count_as_ingested(spark):
    df = spark.sql("""select 'bitcoin' commodity, timestamp_ntz'2025-05-01 00:00:00' event_ts,
                      timestamp_ntz'2025-05-10 00:00:00' ingest_ts""").withColumn("event_date", F.to_date("event_ts"))
    assert tuple(monitor.pipeline_metrics(df, "2025-05-10 00:01:00").first()) == (60, 1, 1)


@pytest.mark.parametrize("age_s,status", [(0, "pass"), (600, "pass"), (601, "warn"), (1200, "warn"),
                                          (1201, "error")])
def test_source_freshness_thresholds(spark, age_s, status):
    df = spark.createDataFrame([(f"2024-01-01 00:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("ingest_ts"))
    as_of = spark.range(1).select((F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                   + F.make_dt_interval(secs=F.lit(age_s))).alias("a")).collect()[0]["a"]
    r = monitor.source_freshness(df, "ingest_ts", as_of).collect()[0]
    assert (r["seconds"], r["status"]) == (age_s, status)


def test_freshness_of_an_empty_table_is_the_sentinel(spark):
    df = spark.createDataFrame([], "ingest_ts timestamp_ntz")
    assert monitor.freshness_seconds(df, "ingest_ts", "2024-01-01 00:00:00").collect()[0][0] == 999999


def test_unique_combinations_count_groups_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1), ("b", 1), (None, None)], "k string, v int")
    got = quality.run_checks({"t": df}, {"t": [quality.unique("k", "v")]}).first()
    assert (got["check_name"], got["failures"]) == ("unique:k+v", 2)


def test_freshness_rounds(spark):
    df = spark.sql("select timestamp_ntz'2025-01-01 00:00:00.4' ingest_ts")
    assert monitor.freshness_seconds(df, "ingest_ts", "2025-01-01 00:00:10").first()[0] == 10


def test_extreme_prices_stop_no_hour(spark):
    from tickflow.operators import marts
    prices = [1e30, float("nan"), float("inf"), 3e-13, -1e30, 1987.25]
    df = spark.createDataFrame([(f"S{i}", p) for i, p in enumerate(prices)], "symbol string, price double").select(
        F.lit("c").alias("commodity"), "symbol", "price", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("event_ts"))
    got = {r["symbol"]: r for r in marts.price_volatility_1h(df, "2025-01-02 00:00:00").collect()}
    assert got["S0"]["avg_price"] == got["S0"]["max_price"] == 1e30 and got["S0"]["range_pct"] == 0
    assert str(got["S1"]["avg_price"]) == "nan" and str(got["S2"]["max_price"]) == "inf"
    assert got["S3"]["range_pct"] == 0 and got["S4"]["min_price"] == -1e30 and got["S5"]["avg_price"] == 1987.25
