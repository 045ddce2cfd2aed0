"""The derived tick tables match FIXTURES.md."""

from pyspark.sql import functions as F

from sf_dirs import SF_ORACLE
from tickflow.operators import ingest, validate
from tickflow.sources import fixtures as fx

EXPECTED_REASON = {   # payload variant (event_id % 23) -> error reason
    0: "JSON_PARSE_ERROR_OR_EMPTY", 1: "MISSING_FIELD:event_id", 2: "MISSING_FIELD:commodity",
    3: "MISSING_FIELD:symbol", 4: "MISSING_FIELD:price", 5: "MISSING_FIELD:currency",
    6: "MISSING_FIELD:source", 7: "INVALID_FIELD:event_ts", 8: "MISSING_FIELD:price",
    9: "INVALID_FIELD:price<=0", 11: "UNSUPPORTED_SCHEMA_VERSION", 12: "INVALID_FIELD:event_ts",
    13: "UNSUPPORTED_SCHEMA_VERSION", 14: "JSON_PARSE_ERROR_OR_EMPTY", 15: "JSON_PARSE_ERROR_OR_EMPTY",
}


def test_tick_table_shape(spark):
    ev = fx.read_events(spark, SF_ORACLE)
    t = fx.ticks(ev)
    assert t.count() == 10000
    per = {r["symbol"]: r["n"] for r in t.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(per) == {"BTC/USD", "XAU/USD", "EUR/USD", "XAG/USD", "WTI/USD"}
    assert all(1800 < n < 2200 for n in per.values())
    assert t.select("event_id").distinct().count() == 10000
    assert t.filter(F.col("ingest_ts") < F.col("event_ts")).count() == 0


def test_every_payload_variant_gets_its_reason(spark):
    ev = fx.read_events(spark, SF_ORACLE)
    env = fx.raw_payloads(ev)
    v = validate.with_error_reason(ingest.parse_and_type(env))
    # event_id = 3 * offset + partition, so the variant is recoverable from the envelope
    v = v.withColumn("v", (F.col("kafka_offset") * 3 + F.col("kafka_partition")) % 23)
    got = {(r["v"], r["error_reason"]) for r in v.select("v", "error_reason").distinct().collect()}
    for var, reason in EXPECTED_REASON.items():
        assert (var, reason) in got, var
        assert {x for (vv, x) in got if vv == var} == {reason}, var
    # variant 10 (price x1000): out of range for bounded symbols only
    v10 = {x for (vv, x) in got if vv == 10}
    assert v10 == {"INVALID_FIELD:price_out_of_range", None}
    # valid variants parse back to the tick (prices travel with 8 decimals)
    good = v.filter(F.col("v") >= 16)
    assert good.filter(F.col("error_reason").isNotNull()).count() == 0
    joined = good.join(fx.ticks(ev).select("event_id", F.col("price").alias("p0"),
                                           F.col("event_ts").alias("t0")), "event_id")
    assert joined.filter(F.abs(F.col("price") - F.col("p0")) > 1e-8).count() == 0
    assert joined.filter(F.col("event_ts") != F.date_trunc("second", "t0").cast("timestamp_ntz")).count() == 0


def test_replays_and_late_arrivals(spark):
    ev = fx.read_events(spark, SF_ORACLE)
    rep = fx.replayed_payloads(ev)
    assert rep.count() == 11000
    assert rep.filter(F.col("kafka_offset") >= 10_000_000).count() == 1000
