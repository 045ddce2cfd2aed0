"""Physical-plan properties that the scale design relies on."""

import re

import pytest

from sf_dirs import SF_SMALL
from tickflow.queries import QUERIES

def marts_plan(stg):
    from tickflow.operators import marts
    return marts.price_events(stg, bucket="adaptive")._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in QUERIES if not n.startswith("stream"))


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_batch_plans(spark, name):
    p = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p, (name, node)


def test_bucketed_scan_windows_per_bucket(spark):
    p = plan(spark, "price_events_bucketed")
    # the per-row window is fed by a hash exchange on (keys..., bucket)
    assert re.search(r"hashpartitioning\([^)]*_seq_bucket#\d+, \d+\)", p)


@pytest.mark.parametrize("name", ["price_events", "price_jumps", "alert_timeline", "ingest_idle_time", "api_idle_time"])
def test_ordered_scans_have_no_window(spark, name):
    # rows are sorted by ranges and written with what they carry; nothing is windowed by an
    # instrument, and nothing meets in a single partition
    p = plan(spark, name)
    assert "Window" not in p and "SinglePartition" not in p and "BroadcastHashJoin [_range#" in p, p


def test_time_bounds_reach_the_scan(spark):
    p = plan(spark, "price_volatility_1h")
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in p
    # latest_prices: the fallback branch scans older rows only, the recent branch the
    # recent slice only (its fixture shifts timestamps, so the plain ticks show it)
    from tickflow import queries as Q
    from tickflow.operators import marts
    from tickflow.sources import fixtures as fx
    stg = Q._stg(spark, SF_SMALL, fx.ticks)
    recent, older = marts.latest_slices(stg, Q._as_of(spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts," in recent._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in older._jdf.queryExecution().executedPlan().toString()


def test_insert_new_reads_the_buckets_of_its_ids_only(spark):
    from pyspark.sql import functions as F

    from tickflow.plans import id_table
    from tickflow.session import scratch_path
    ids = id_table.IdTable(scratch_path(spark, "t-ids"), buckets=64)
    stored = spark.range(5000).select(F.col("id").cast("string").alias("event_id"), F.lit("2024-01-01").cast("date").alias("event_date"))
    ids.build(stored, F.col("event_date"))
    batch = spark.createDataFrame([("17", 0, 1), ("x", 0, 2), ("4999", 0, 3)], "event_id string, kafka_partition int, kafka_offset long")
    got = id_table.new_rows(batch, ids)
    assert [r["event_id"] for r in got.collect()] == ["x"]
    p = got._jdf.queryExecution().executedPlan().toString()
    touched = {b for b, _, _ in ids.touched(batch)}
    listed = re.search(r"PartitionFilters: \[bucket#\d+ IN \(([0-9,]+)\)", p)
    assert {int(b) for b in listed[1].split(",")} == touched and len(touched) <= 3
    assert "PushedFilters: [IsNotNull(id_hash), GreaterThanOrEqual(id_hash," in p


def test_insert_new_scan_broadcasts_batch_keys(spark):
    p = plan(spark, "insert_new_scan")
    assert "LeftSemi" in p and "BroadcastExchange" in p


def test_column_pruning(spark):
    p = plan(spark, "health_metrics")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p


def test_dedupe_limits_copies_before_the_shuffle(spark):
    # a key repeated across a third of the rows is cut to one row per map
    # task (partial WindowGroupLimit) before the hash exchange on the key
    from tickflow.plans.sinks import dedupe
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) as event_id",
                                       "cast(id % 4 as int) as kafka_partition", "id as kafka_offset")
    d = dedupe(df, ["event_id"], ["kafka_partition", "kafka_offset"])
    p = d._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(event_id#\d+L?, \d+\).*\n.*WindowGroupLimit .*Partial", p), p
    assert d.count() == 20001
    assert d.filter("event_id = 0").first()["kafka_offset"] == 0


def test_adaptive_bucket_joins_broadcast_the_counted_hot_sets(spark):
    # even when the planner would broadcast nothing on its own (large input),
    # the hot hour/minute sets are checkpointed, counted and broadcast, so the
    # input is not shuffled to attach the bucket
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        from tickflow import queries as Q
        p = marts_plan(Q._stg(spark, SF_SMALL))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert re.search(r"BroadcastHashJoin \[[^\]]*_bh#\d+\]", p)
    assert re.search(r"BroadcastHashJoin \[[^\]]*_bm#\d+\]", p)
    assert not re.search(r"SortMergeJoin \[[^\]]*_b[hm]#\d+\]", p)
