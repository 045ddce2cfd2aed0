"""FX weekend gate (P6/P7/U2) boundary instants, and UUID5 (E1) parity."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tickflow.functions import calendar, ids

INSTANTS = {
    "fri_2159_59": ("2026-03-06 21:59:59", False),
    "fri_2200": ("2026-03-06 22:00:00", True),
    "sat_noon": ("2026-03-07 12:00:00", True),
    "sun_2159_59": ("2026-03-08 21:59:59", True),
    "sun_2200": ("2026-03-08 22:00:00", False),
    "mon_0000": ("2026-03-09 00:00:00", False),
    "wed_2300": ("2026-03-11 23:00:00", False),
}


@pytest.fixture(scope="module")
def closed(spark):
    df = spark.createDataFrame([(k, v) for k, (v, _) in INSTANTS.items()], "k string, t string") \
        .withColumn("ts", F.col("t").cast("timestamp_ntz"))
    return {r["k"]: r["c"] for r in df.select("k", calendar.fx_closed("ts").alias("c")).collect()}


@pytest.mark.parametrize("k", list(INSTANTS))
def test_fx_closed(closed, k):
    assert closed[k] == INSTANTS[k][1]


OFFSET_INSTANTS = {   # ISO instants with a UTC offset -> closed?
    "fri_2359_59_plus2": ("2026-03-06T23:59:59+02:00", False),   # 21:59:59 UTC
    "sat_0000_plus2": ("2026-03-07T00:00:00+02:00", True),       # Fri 22:00 UTC
    "sun_2359_59_plus2": ("2026-03-08T23:59:59+02:00", True),    # Sun 21:59:59 UTC
    "mon_0000_plus2": ("2026-03-09T00:00:00+02:00", False),      # Sun 22:00 UTC
    "fri_1600_minus5": ("2026-03-06T16:00:00-05:00", False),     # Fri 21:00 UTC, still open
    "fri_1700_minus5": ("2026-03-06T17:00:00-05:00", True),      # Fri 22:00 UTC
}


@pytest.mark.parametrize("k", list(OFFSET_INSTANTS))
def test_fx_closed_with_offsets(spark, k):
    iso, expect = OFFSET_INSTANTS[k]
    df = spark.createDataFrame([(iso,)], "t string").select(
        F.to_timestamp("t").cast("timestamp_ntz").alias("ts"))   # session time zone is UTC
    assert df.select(calendar.fx_closed("ts")).collect()[0][0] == expect


def test_should_publish_and_market_status(spark):
    inst = spark.createDataFrame([("2026-03-07 12:00:00",), ("2026-03-09 12:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("instant"))
    st = {(str(r["instant"]), r["instrument"]): r["status"]
          for r in calendar.market_status(inst).collect()}
    assert st[("2026-03-07 12:00:00", "BTC/USD")] == calendar.OPEN_LABEL
    assert st[("2026-03-07 12:00:00", "XAU/USD")] == calendar.CLOSED_LABEL
    assert st[("2026-03-07 12:00:00", "EUR/USD")] == calendar.CLOSED_LABEL
    assert st[("2026-03-09 12:00:00", "EUR/USD")] == calendar.OPEN_LABEL
    act = calendar.active_symbols(inst).collect()
    assert sorted(r["symbol"] for r in act if str(r["instant"]).startswith("2026-03-07")) == ["BTC/USD"]
    assert len([r for r in act if str(r["instant"]).startswith("2026-03-09")]) == 3


def test_uuid5_matches_python(spark):
    names = ["gold:2026-03-14T12:00:00Z", "bitcoin:2024-01-01T00:00:07Z", "", "ünïcode:x"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["u"] for r in df.select("n", ids.uuid5(F.col("n")).alias("u")).collect()}
    for n in names:
        assert got[n] == str(uuid.uuid5(uuid.NAMESPACE_DNS, n))


def test_event_id_uses_whole_second_iso(spark):
    df = spark.createDataFrame([("gold", "2026-03-14 12:00:00.987654")], "c string, t string") \
        .withColumn("ts", F.col("t").cast("timestamp_ntz"))
    r = df.select(ids.event_id("c", "ts").alias("id"), ids.iso_seconds("ts").alias("iso")).collect()[0]
    assert r["iso"] == "2026-03-14T12:00:00Z"
    assert r["id"] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "gold:2026-03-14T12:00:00Z"))


def test_build_events_round_trip(spark):
    """Events built by the producer side parse and validate cleanly."""
    from tickflow.operators import ingest, validate
    prices = spark.createDataFrame([("gold", "XAU/USD", 2150.25, "2026-03-13 10:00:00")],
                                   "commodity string, symbol string, price double, t string") \
        .withColumn("ts", F.col("t").cast("timestamp_ntz"))
    rows = ingest.to_kafka_rows(ingest.build_events(prices, "rest_api", 360))
    env = rows.select(F.col("value").alias("raw_payload"), F.lit("prices").alias("kafka_topic"),
                      F.lit(0).alias("kafka_partition"), F.lit(0).cast("bigint").alias("kafka_offset"))
    v = validate.with_error_reason(ingest.parse_and_type(env)).collect()[0]
    assert v["error_reason"] is None and v["price"] == 2150.25
    assert rows.collect()[0]["key"] == "gold"
