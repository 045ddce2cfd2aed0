"""Validation chain (P3/P5): each rule, its bounds and its place in the order, run as
one DataFrame through the JSON parse + typing + validation path."""

import json

import pytest
from pyspark.sql import functions as F

from tickflow import dims
from tickflow.operators import ingest, validate

BASE = {
    "schema_version": 1, "event_id": "e-77", "commodity": "gold", "symbol": "XAU/USD",
    "price": 1987.25, "currency": "USD", "timestamp": "2025-06-02T08:15:30Z",
    "source": "feed", "ingest_interval_sec": 120,
}
LIMITS = dims.PRICE_BOUNDS


def near(symbol, side, factor):
    """A price just inside or outside a bound of the symbol."""
    return LIMITS[symbol][side] * factor


def ev(**kw):
    d = dict(BASE)
    d.update(kw)
    return json.dumps({k: v for k, v in d.items() if v is not None})


CASES = {
    "valid_gold": (ev(), None),
    "valid_btc": (ev(commodity="bitcoin", symbol="BTC/USD", price=41234.75), None),
    "valid_eurusd": (ev(commodity="eurusd", symbol="EUR/USD", price=1.25), None),
    "all_core_missing": (ev(event_id=None, commodity=None, symbol=None, price=None),
                         "JSON_PARSE_ERROR_OR_EMPTY"),
    "missing_event_id": (ev(event_id=None), "MISSING_FIELD:event_id"),
    "missing_commodity": (ev(commodity=None), "MISSING_FIELD:commodity"),
    "missing_symbol": (ev(symbol=None), "MISSING_FIELD:symbol"),
    "missing_price": (ev(price=None), "MISSING_FIELD:price"),
    "missing_currency": (ev(currency=None), "MISSING_FIELD:currency"),
    "missing_source": (ev(source=None), "MISSING_FIELD:source"),
    "missing_timestamp": (ev(timestamp=None), "INVALID_FIELD:event_ts"),
    "zero_price": (ev(price=0.0), "INVALID_FIELD:price<=0"),
    "negative_price": (ev(price=-0.01), "INVALID_FIELD:price<=0"),
    "schema_version_2": (ev(schema_version=2), "UNSUPPORTED_SCHEMA_VERSION"),
    "schema_version_none": (ev(schema_version=None), "UNSUPPORTED_SCHEMA_VERSION"),
    "gold_low": (ev(price=near("XAU/USD", 0, 0.999)), "INVALID_FIELD:price_out_of_range"),
    "gold_high": (ev(price=near("XAU/USD", 1, 1.001)), "INVALID_FIELD:price_out_of_range"),
    "gold_at_low": (ev(price=near("XAU/USD", 0, 1)), None),
    "gold_at_high": (ev(price=near("XAU/USD", 1, 1)), None),
    "btc_low": (ev(commodity="bitcoin", symbol="BTC/USD", price=near("BTC/USD", 0, 0.99)), "INVALID_FIELD:price_out_of_range"),
    "btc_high": (ev(commodity="bitcoin", symbol="BTC/USD", price=near("BTC/USD", 1, 1.01)),
                 "INVALID_FIELD:price_out_of_range"),
    "eur_low": (ev(commodity="eurusd", symbol="EUR/USD", price=near("EUR/USD", 0, 0.9)), "INVALID_FIELD:price_out_of_range"),
    "eur_high": (ev(commodity="eurusd", symbol="EUR/USD", price=near("EUR/USD", 1, 1.1)), "INVALID_FIELD:price_out_of_range"),
    "unknown_symbol": (ev(symbol="ZZZ/USD", price=3.5e9), None),
    "missing_before_bad_price": (ev(event_id=None, price=-2.5), "MISSING_FIELD:event_id"),
    "bad_price_before_version": (ev(price=-1.0, schema_version=2), "INVALID_FIELD:price<=0"),
    "version_before_bounds": (ev(schema_version=7, price=0.01, symbol="EUR/USD"),
                              "UNSUPPORTED_SCHEMA_VERSION"),
    # wire-level cases (Spark parse semantics)
    "truncated_json": ('{"schema_version":1,"event_id":"a', "JSON_PARSE_ERROR_OR_EMPTY"),
    "empty_payload": ("", "JSON_PARSE_ERROR_OR_EMPTY"),
    "top_level_array": ("[1,2]", "JSON_PARSE_ERROR_OR_EMPTY"),
    "price_as_string": (ev(price="1987.25"), "MISSING_FIELD:price"),
    "version_as_string": (ev(schema_version="1"), "UNSUPPORTED_SCHEMA_VERSION"),
    "fractional_timestamp": (ev(timestamp="2025-06-02T08:15:30.5Z"), "INVALID_FIELD:event_ts"),
    "offset_timestamp": (ev(timestamp="2025-06-02T08:15:30+00:00"), "INVALID_FIELD:event_ts"),
    "impossible_date": (ev(timestamp="2025-02-30T08:15:30Z"), "INVALID_FIELD:event_ts"),
    "nan_price_bounded": (ev(price="NaN"), "INVALID_FIELD:price_out_of_range"),
}


@pytest.fixture(scope="module")
def results(spark):
    rows = [(name, payload, "prices", 0, i) for i, (name, (payload, _)) in enumerate(CASES.items())]
    df = spark.createDataFrame(rows, "case string, raw_payload string, kafka_topic string, "
                                     "kafka_partition int, kafka_offset bigint")
    typed = ingest.parse_and_type(df.drop("case").withColumn("case_off", F.col("kafka_offset")))
    out = validate.with_error_reason(typed)
    got = {r["kafka_offset"]: r["error_reason"] for r in out.collect()}
    return {name: got[i] for i, name in enumerate(CASES)}


@pytest.mark.parametrize("name", list(CASES))
def test_rule(results, name):
    assert results[name] == CASES[name][1]


def test_bounds_join_form_matches_literal_form(spark):
    rows = [(p, "prices", 0, i) for i, (p, _) in enumerate(CASES.values())]
    df = spark.createDataFrame(rows, "raw_payload string, kafka_topic string, kafka_partition int, kafka_offset bigint")
    typed = ingest.parse_and_type(df)
    a = {r[0]: r[1] for r in validate.with_error_reason(typed).select("kafka_offset", "error_reason").collect()}
    b = {r[0]: r[1] for r in validate.with_error_reason_join(typed, dims.bounds_df(spark))
         .select("kafka_offset", "error_reason").collect()}
    assert a == b


def test_split_and_counts(spark):
    rows = [(p, "prices", 0, i) for i, (p, _) in enumerate(CASES.values())]
    df = spark.createDataFrame(rows, "raw_payload string, kafka_topic string, kafka_partition int, kafka_offset bigint")
    v = validate.with_error_reason(ingest.parse_and_type(df))
    good, bad = validate.split(v, "stream1", 7)
    n_good = sum(1 for _, r in CASES.values() if r is None)
    assert good.count() == n_good
    assert bad.count() == len(CASES) - n_good
    assert set(bad.columns) >= {"stream_instance_id", "batch_id", "topic", "kafka_partition",
                                "kafka_offset", "error_reason", "raw_payload"}
    c = validate.batch_counts(v).collect()[0]
    assert (c["good_rows"], c["bad_rows"]) == (n_good, len(CASES) - n_good)
    empty = validate.batch_counts(v.limit(0)).collect()[0]
    assert (empty["good_rows"], empty["bad_rows"]) == (0, 0)
