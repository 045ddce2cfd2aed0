"""Properties the original project never tested, checked on driver data."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from tickflow.functions.timeutil import default_as_of
from tickflow.operators import marts
from tickflow.plans import incremental, ranges, sequential, sinks
from tickflow.session import scratch_path
from tickflow.sources import fixtures as fx


@pytest.fixture(scope="module")
def stg(spark):
    return marts.stg_raw_prices(fx.ticks(fx.read_events(spark, SF_SMALL)))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
@pytest.mark.parametrize("variant", ["plain", "ties", "gaps"])
def test_bucketed_lag_equals_global_lag(spark, bucket, variant):
    ev = fx.read_events(spark, SF_SMALL)
    t = marts.stg_raw_prices(fx.ticks_minute_ties(ev) if variant == "ties" else fx.ticks(ev))
    if variant == "gaps":   # two whole days missing
        t = t.filter(~F.dayofmonth("event_ts").isin(10, 11))
    base = t.select("commodity", "symbol", "event_ts", "event_id", "price")
    w = Window.partitionBy("commodity", "symbol").orderBy("event_ts", "event_id")
    expect = base.select("*", F.lag("price").over(w).alias("prev_price"),
                         F.lag("event_ts").over(w).alias("prev_event_ts"))
    got = sequential.with_lag(base, ["commodity", "symbol"], ["event_ts", "event_id"],
                              ["price", "event_ts"], bucket=bucket)
    assert _rows(got.select(*expect.columns)) == _rows(expect)


def test_bucketed_running_max_equals_global(spark, stg):
    base = stg.select("symbol", "event_ts", "price")
    w = Window.partitionBy("symbol").orderBy("event_ts").rowsBetween(Window.unboundedPreceding, 0)
    expect = base.withColumn("m", F.max("price").over(w))
    got = sequential.with_running_max(base, ["symbol"], ["event_ts"], "price", "m", bucket="day")
    assert _rows(got.select(*expect.columns)) == _rows(expect)


ODD_TICKS = [("a", None, None, 5, 1.0), ("a", None, 3, 6, None), ("a", "x", 1, 1, 2.0), ("a", "x", 1, 1, 2.5), ("a", "x", 1, 2, None), (None, "x", 9, 1, 4.0),
             (None, "x", 10, 1, float("nan")), ("b", "", -5, 1, 7.0), ("b", "", None, 1, 3.0)]


@pytest.fixture(scope="module")
def hot_ticks(spark):
    """One key with most of the rows, many of them at the same time, then single rows, nulls and repeated rows."""
    hot = spark.range(6000).selectExpr("if(id % 3 < 2, 'hot', concat('k', id % 700)) as k1", "'s' as k2", "if(id % 2 = 0, 7, id % 50) as t",
                                       "(id * 7919) % 6007 as i", "if(id % 11 = 0, null, cast((id * 31) % 997 as double)) as v")
    odd = spark.createDataFrame(ODD_TICKS, "k1 string, k2 string, t bigint, i bigint, v double")
    return hot.unionByName(odd).withColumn("ts", F.timestamp_micros(F.col("t") * 1_000_000).cast("timestamp_ntz"))


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_lag_by_ranges_equals_global_lag(spark, hot_ticks, partitions):
    df = hot_ticks.dropDuplicates(["k1", "k2", "ts", "i"])
    w = Window.partitionBy("k1", "k2").orderBy(F.asc_nulls_first("ts"), F.asc_nulls_first("i"))
    expect = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("ts").over(w).alias("prev_ts"))
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranges.with_lag(df, ["k1", "k2"], ["ts", "i"], ["v", "ts"])
        per = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0]).filter("k1 = 'hot'").groupBy(ranges.PART).count().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(str, got.select(*expect.columns).collect())) == sorted(map(str, expect.collect()))
    assert per > int(partitions) // 3      # the hot key lies in many ranges
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_running_max_by_ranges_equals_global(spark, hot_ticks, partitions):
    df = hot_ticks.dropDuplicates(["k1", "k2", "ts", "i"]).filter("v is null or not isnan(v)").withColumn(
        "w", F.timestamp_micros(F.col("v").cast("bigint")).cast("timestamp_ntz"))
    w = Window.partitionBy("k1", "k2").orderBy(F.asc_nulls_first("ts"), F.asc_nulls_first("i")).rowsBetween(Window.unboundedPreceding, 0)
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for col in ("v", "w"):
            got = ranges.with_running_max(df, ["k1", "k2"], ["ts", "i"], col, "top")
            expect = df.withColumn("top", F.max(col).over(w))
            assert sorted(map(str, got.select(*expect.columns).collect())) == sorted(map(str, expect.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranges_of_nothing(spark, hot_ticks):
    none = hot_ticks.limit(0)
    assert ranges.with_lag(none, ["k1"], ["ts"], ["v"]).count() == 0
    assert ranges.with_running_max(none, [], ["ts"], "v", "top").count() == 0


def test_latest_two_branch_equals_single_pass(spark):
    ev = fx.read_events(spark, SF_SMALL)
    stg = marts.stg_raw_prices(fx.ticks_stale_instrument(ev))
    as_of = default_as_of(fx.ticks(ev))
    assert _rows(marts.latest_prices(stg, as_of)) == _rows(marts.latest_prices_single_pass(stg))


def test_latest_shuffle_fallback_equals_single_pass(spark):
    # above the broadcast limit the anti join shuffles both sides instead
    ev = fx.read_events(spark, SF_SMALL)
    stg = marts.stg_raw_prices(fx.ticks_stale_instrument(ev))
    as_of = default_as_of(fx.ticks(ev))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:       # no automatic broadcast either (the checkpoint has exact stats)
            spark.conf.set(k, "-1")
        got = marts.latest_prices(stg, as_of, broadcast_limit=0)
        assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
        rows = _rows(got)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows == _rows(marts.latest_prices_single_pass(stg))


def test_price_event_counts_match_fixture_doc(spark):
    """FIXTURES section 2 counts (sf0.01): classes per symbol after the gap rule."""
    stg = marts.stg_raw_prices(fx.ticks(fx.read_events(spark, "/root/testdata/sf0.01")))
    got = {(r["symbol"], r["event_type"]): r["n"] for r in
           marts.price_events(stg, keep_normal=True).groupBy("symbol", "event_type")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[("BTC/USD", "EXTREME_MOVE")] == 272 and got[("BTC/USD", "NORMAL")] == 455
    assert got[("XAU/USD", "LARGE_MOVE")] == 341 and got[("EUR/USD", "MEDIUM_MOVE")] == 411
    assert got[("XAG/USD", "NORMAL")] == 1523 and got[("WTI/USD", "NORMAL")] == 1517


@pytest.mark.parametrize("model,bucket,keys,lookback", [
    ("minute", "minute_bucket", ["commodity", "symbol", "minute_bucket"], "30 minutes"),
    ("volatility", "hour_bucket", ["commodity", "symbol", "hour_bucket"], "2 hours"),
])
def test_incremental_equals_full_refresh_for_in_lookback_arrivals(spark, stg, model, bucket, keys, lookback):
    as_of = default_as_of(stg)
    fn = incremental.minute_model if model == "minute" else incremental.volatility_model(as_of)
    path = scratch_path(spark, f"inc-{model}")
    cuts = ["2024-01-08 00:00:00", "2024-01-15 12:00:00", "2024-01-23 06:00:00"]
    for c in cuts:   # arrivals strictly in event-time order: always inside the lookback
        incremental.run(spark, fn, stg.filter(F.col("ingest_ts") < F.lit(c).cast("timestamp_ntz")),
                        path, keys, bucket, lookback, as_of)
    incremental.run(spark, fn, stg, path, keys, bucket, lookback, as_of)
    full = fn(stg, None)
    got = spark.read.parquet(path).select(*full.columns)
    assert _rows(got) == _rows(full)


def test_retention_keeps_boundary_rows(spark, stg):
    path = scratch_path(spark, "ret")
    stg.withColumn("event_date", F.to_date("event_ts")).write.partitionBy("event_date").parquet(path)
    cutoff = "2024-01-20 13:30:00"
    out = sinks.apply_retention(spark, path, "event_ts", cutoff, "event_date")
    got = spark.read.parquet(path)
    assert got.filter(F.col("event_ts") < F.lit(cutoff).cast("timestamp_ntz")).count() == 0
    assert got.count() == stg.filter(F.col("event_ts") >= F.lit(cutoff).cast("timestamp_ntz")).count()
    assert out["dropped_partitions"] == 19


def test_upsert_replaces_keys_and_keeps_others(spark):
    path = scratch_path(spark, "ups")
    a = spark.createDataFrame([("k1", 1, "2024-01-01"), ("k2", 2, "2024-01-01"), ("k3", 3, "2024-01-02")],
                              "k string, v int, d string")
    a.write.partitionBy("d").parquet(path)
    new = spark.createDataFrame([("k2", 20, "2024-01-01"), ("k4", 40, "2024-01-01")], "k string, v int, d string")
    sinks.upsert(spark, new, path, ["k"], "d")
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"k1": 1, "k2": 20, "k3": 3, "k4": 40}


def test_mart_columns_follow_the_model(spark):
    path = scratch_path(spark, "t-mart")
    rows = lambda cols, *r: spark.createDataFrame(list(r), cols)
    sinks.write_mart(rows("k string, v int, d string", ("k1", 1, "a"), ("k2", 2, "a"), ("k3", 3, "b")), path, "d")
    sinks.upsert(spark, rows("k string, v int, w double, d string", ("k2", 20, 0.5, "a")), path, ["k"], "d")
    assert {(r["k"], r["v"], r["w"]) for r in sinks.read_mart(spark, path).collect()} == {("k1", 1, None), ("k2", 20, 0.5), ("k3", 3, None)}
    sinks.upsert(spark, rows("k string, w double, d string", ("k3", 7.0, "b")), path, ["k"], "d")
    got = sinks.read_mart(spark, path)
    assert got.columns == ["k", "w", "d"]
    assert {(r["k"], r["w"]) for r in got.collect()} == {("k1", None), ("k2", 0.5), ("k3", 7.0)}
    with pytest.raises(ValueError, match="w: double -> string"):
        sinks.upsert(spark, rows("k string, w string, d string", ("k3", "x", "b")), path, ["k"], "d")


def test_an_emptied_mart_can_be_rebuilt_whole(spark, stg):
    as_of = default_as_of(stg)
    path = scratch_path(spark, "t-emptied")
    model = incremental.minute_model(stg, None).withColumn("bucket_date", F.to_date("minute_bucket"))
    for fallback, n in (("7 days", None), (None, model.count())):
        sinks.write_mart(model.limit(0), path, "bucket_date")
        incremental.run(spark, incremental.minute_model, stg, path, ["commodity", "symbol", "minute_bucket"], "minute_bucket", "30 minutes", as_of,
                        empty_fallback=fallback)
        got = sinks.read_mart(spark, path).count()
        assert got == n if n else 0 < got < model.count()


def test_threshold_join_form_equals_literal_chain(spark, stg):
    """J7 (data-driven thresholds) classifies exactly like P16 (literal chain)."""
    from tickflow import dims
    ev = marts.price_events(stg, keep_normal=True).select(
        "symbol", "event_ts", (F.col("price_change_pct") / 100).alias("pct_change"), "event_type")
    joined = marts.classify_move_join(ev.drop("event_type"), dims.thresholds_df(spark))
    a = sorted((r["symbol"], str(r["event_ts"]), r["event_type"]) for r in ev.collect())
    b = sorted((r["symbol"], str(r["event_ts"]), r["event_type"]) for r in joined.collect())
    assert len(a) == len(b)
    diff = sum(1 for x, y in zip(a, b) if x != y)
    assert diff <= len(a) * 0.002   # pct here is re-derived from the 4-decimal rounded value


def test_hot_instrument_is_split_across_window_partitions(spark):
    """One instrument with ~90% of all rows: results equal the global window and
    the largest (instrument, bucket) group is a small share of that instrument."""
    ev = fx.read_events(spark, "/root/testdata/sf0.01")
    hot = ev.withColumn("event_type", F.when(F.col("event_id") % 10 != 0, F.lit("click"))
                        .otherwise(F.col("event_type")))
    t = marts.stg_raw_prices(fx.ticks(hot))
    base = t.select("commodity", "symbol", "event_ts", "event_id", "price")
    w = Window.partitionBy("commodity", "symbol").orderBy("event_ts", "event_id")
    expect = base.select("*", F.lag("price").over(w).alias("prev_price"),
                         F.lag("event_ts").over(w).alias("prev_event_ts"))
    got = sequential.with_lag(base, ["commodity", "symbol"], ["event_ts", "event_id"],
                              ["price", "event_ts"], bucket="hour")
    assert _rows(got.select(*expect.columns)) == _rows(expect)
    sizes = (base.filter(F.col("symbol") == "BTC/USD")
             .groupBy(F.date_trunc("hour", "event_ts")).count().agg(F.max("count"), F.sum("count"))
             .collect()[0])
    assert sizes[1] > 0.85 * base.count()
    assert sizes[0] < 0.01 * sizes[1]


def test_readers_wait_for_a_swap_in_progress(spark):
    path = scratch_path(spark, "guarded")
    spark.createDataFrame([("a", 1, "2024-01-01")], "k string, v int, d string") \
        .write.partitionBy("d").parquet(path)
    with sinks.swap_guard(spark, path):
        with pytest.raises(TimeoutError):
            sinks.read_consistent(spark, path, timeout_s=0.5, poll_s=0.1)
    assert sinks.read_consistent(spark, path, timeout_s=1).count() == 1
    new = spark.createDataFrame([("a", 2, "2024-01-01")], "k string, v int, d string")
    sinks.upsert(spark, new, path, ["k"], "d")
    assert [r["v"] for r in sinks.read_consistent(spark, path).collect()] == [2]


def test_replace_slice_drops_rows_the_slice_no_longer_produces(spark):
    path = scratch_path(spark, "replace")
    old = spark.createDataFrame([("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 12:00:00", 2),
                                 ("c", "2024-01-01 13:00:00", 3)], "k string, t string, v int") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    old.withColumn("d", F.to_date("t")).write.partitionBy("d").parquet(path)

    def model(src, since):
        return src.filter(F.col("t") >= F.lit(since).cast("timestamp_ntz")) if since else src

    new_src = spark.createDataFrame([("b", "2024-01-01 12:00:00", 20)], "k string, t string, v int") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    keep = scratch_path(spark, "replace-keep")
    old.withColumn("d", F.to_date("t")).write.partitionBy("d").parquet(keep)
    incremental.run(spark, model, new_src, keep, ["k"], "t", "2 hours", "2024-01-02", "d")
    incremental.run(spark, model, new_src, path, ["k"], "t", "2 hours", "2024-01-02", "d",
                    replace_slice=True)
    assert {r["k"]: r["v"] for r in spark.read.parquet(keep).collect()} == {"a": 1, "b": 20, "c": 3}
    assert {r["k"]: r["v"] for r in spark.read.parquet(path).collect()} == {"a": 1, "b": 20}


@pytest.mark.parametrize("variant", ["plain", "ties", "burst"])
def test_adaptive_buckets_equal_global_lag(spark, variant):
    ev = fx.read_events(spark, SF_SMALL)
    if variant == "burst":   # a third of all rows squeezed into one hour (and a few seconds)
        ev = ev.withColumn("ts", F.when(F.col("event_id") % 3 == 0,
                                        F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
                                        + F.make_dt_interval(secs=(F.col("event_id") % 97).cast("decimal(18,6)")))
                           .otherwise(F.col("ts")))
    t = marts.stg_raw_prices(fx.ticks_minute_ties(ev) if variant == "ties" else fx.ticks(ev))
    base = t.select("commodity", "symbol", "event_ts", "event_id", "price")
    w = Window.partitionBy("commodity", "symbol").orderBy("event_ts", "event_id")
    expect = base.select("*", F.lag("price").over(w).alias("prev_price"),
                         F.lag("event_ts").over(w).alias("prev_event_ts"))
    old = sequential.HOT_BUCKET_ROWS
    sequential.HOT_BUCKET_ROWS = 20          # tiny threshold: exercise hour -> minute -> second splits
    try:
        got = sequential.with_lag(base, ["commodity", "symbol"], ["event_ts", "event_id"],
                                  ["price", "event_ts"], bucket="adaptive")
        assert _rows(got.select(*expect.columns)) == _rows(expect)
        if variant == "burst":
            b = sequential.add_bucket(base, ["commodity", "symbol"], "event_ts", "adaptive")
            per = b.groupBy("commodity", "symbol", sequential._B).count()
            assert per.agg(F.max("count")).collect()[0][0] < 0.05 * base.count()
            # the burst hour was split into minutes / seconds
            assert b.filter(F.minute(sequential._B) + F.second(sequential._B) > 0).count() > 0
    finally:
        sequential.HOT_BUCKET_ROWS = old


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_dlq_new_rows_skips_stored_keys(spark, limit):
    # broadcast semi join (limit above the batch) and shuffle anti join (0) agree
    from tickflow.plans import sinks
    schema = "stream_instance_id string, batch_id bigint, kafka_partition int, kafka_offset bigint, ts_utc timestamp_ntz, raw string"
    rows = [("i", 1, p, o, None, f"r{p}{o}") for p in range(2) for o in range(5)]
    bad = spark.createDataFrame(rows + rows[:3], schema).withColumn(
        "ts_utc", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    stored = bad.limit(0).unionByName(bad.filter("kafka_offset < 2")).withColumn(
        "dlq_date", F.to_date("ts_utc"))
    got = sinks.dlq_new_rows(bad, stored, broadcast_limit=limit)
    assert sorted((r.kafka_partition, r.kafka_offset) for r in got.collect()) == \
        [(p, o) for p in range(2) for o in range(2, 5)]


def test_adaptive_buckets_split_a_hot_second(spark):
    # a third of all rows inside one second: half of them within one
    # millisecond (split into microseconds), half spread over its
    # milliseconds (millisecond buckets); lag still exact
    off = F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 1000) / 1_000_000) \
        .otherwise((F.col("event_id") % 1000) / 1_000)
    ev = fx.read_events(spark, SF_SMALL).withColumn(
        "ts", F.when(F.col("event_id") % 3 == 0,
                     F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
                     + F.make_dt_interval(secs=off.cast("decimal(18,6)")))
        .otherwise(F.col("ts")))
    base = marts.stg_raw_prices(fx.ticks(ev)).select("commodity", "symbol", "event_ts", "event_id", "price")
    w = Window.partitionBy("commodity", "symbol").orderBy("event_ts", "event_id")
    expect = base.select("*", F.lag("price").over(w).alias("prev_price"),
                         F.lag("event_ts").over(w).alias("prev_event_ts"))
    old = sequential.HOT_BUCKET_ROWS
    sequential.HOT_BUCKET_ROWS = 20
    try:
        got = sequential.with_lag(base, ["commodity", "symbol"], ["event_ts", "event_id"],
                                  ["price", "event_ts"], bucket="adaptive")
        assert _rows(got.select(*expect.columns)) == _rows(expect)
        b = sequential.add_bucket(base, ["commodity", "symbol"], "event_ts", "adaptive")
        per = b.groupBy("commodity", "symbol", sequential._B).count()
        assert per.agg(F.max("count")).collect()[0][0] < 0.05 * base.count()
        micros = F.unix_micros(F.col(sequential._B).cast("timestamp"))
        assert b.filter(micros % 1000 != 0).count() > 0          # microsecond buckets
        assert b.filter((micros % 1000 == 0) & (micros % 1_000_000 != 0)).count() > 0   # millisecond buckets
    finally:
        sequential.HOT_BUCKET_ROWS = old
