"""Streaming ingest: replay idempotency and exactly-one-destination accounting."""

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from tickflow.session import scratch_path
from tickflow.sources import fixtures as fx
from tickflow.streaming import ingest as sing


def _cfg(spark, src=None):
    return sing.IngestConfig(
        fact_path=scratch_path(spark, "t-fact"), dlq_path=scratch_path(spark, "t-dlq"),
        metrics_path=scratch_path(spark, "t-metrics"), checkpoint=scratch_path(spark, "t-ckpt"),
        source_format="parquet", source_path=src, max_per_trigger=1, available_now=True)


def _batch(spark):
    env = fx.materialize(fx.replayed_payloads(fx.read_events(spark, SF_SMALL)), "t-env")
    return sing.validated_stream(env)


def test_replayed_batch_is_idempotent(spark):
    cfg = _cfg(spark)
    fn = sing.MicroBatchWriter(spark, cfg, "q1")
    b = _batch(spark)
    fn(b, 0)
    fact1 = sorted(tuple(r) for r in spark.read.parquet(cfg.fact_path).drop("ingest_ts").collect())
    dlq1 = spark.read.parquet(cfg.dlq_path).count()
    fn(b, 0)   # the same micro-batch again (restart before the commit)
    fact2 = sorted(tuple(r) for r in spark.read.parquet(cfg.fact_path).drop("ingest_ts").collect())
    assert fact1 == fact2
    assert spark.read.parquet(cfg.dlq_path).count() == dlq1
    m = spark.read.parquet(cfg.metrics_path).collect()
    assert len(m) == 2 and m[0]["inserted"] == m[1]["inserted"]


def test_every_row_lands_in_exactly_one_destination(spark):
    cfg = _cfg(spark)
    fn = sing.MicroBatchWriter(spark, cfg, "q2")
    b = _batch(spark)
    total = b.count()
    half = F.col("kafka_offset") < 10_000_000
    fn(b.filter(half), 0)
    fn(b.filter(~half), 1)     # re-published events: all conflicts or DLQ
    m = spark.read.parquet(cfg.metrics_path).collect()
    stored = spark.read.parquet(cfg.fact_path).count()
    dlq = spark.read.parquet(cfg.dlq_path).count()
    skipped = sum(r["conflict_skipped"] for r in m)
    assert stored == sum(r["inserted"] for r in m)
    assert stored + dlq + skipped == total
    assert spark.read.parquet(cfg.fact_path).select("event_id").distinct().count() == stored
    assert m[1]["inserted"] == 0 if m[0]["batch_id"] == 0 else m[0]["inserted"] == 0


def test_restart_from_checkpoint_gives_same_tables(spark):
    ev = fx.read_events(spark, SF_SMALL)
    src = scratch_path(spark, "t-src")
    fx.raw_payloads(ev).repartition(3).write.parquet(src)
    cfg = _cfg(spark, src)
    sing.start_ingest(spark, cfg).awaitTermination()
    n1 = spark.read.parquet(cfg.fact_path).count()
    sing.start_ingest(spark, cfg).awaitTermination()       # nothing new: no batch
    assert spark.read.parquet(cfg.fact_path).count() == n1
    assert len(spark.read.parquet(cfg.metrics_path).collect()) == 3


def test_compaction_keeps_ids_unique_and_replay_inserts_nothing(spark):
    from tickflow.plans import sinks
    cfg = _cfg(spark)
    fn = sing.MicroBatchWriter(spark, cfg, "q3")
    b = _batch(spark)
    parts = [b.filter(F.col("kafka_partition") == p) for p in range(3)]
    for i, p in enumerate(parts):
        fn(p, i)
    before = sorted(tuple(r) for r in spark.read.parquet(cfg.fact_path).drop("batch_token", "ingest_ts").collect())
    done = sinks.compact(spark, cfg.fact_path)
    assert done
    after = spark.read.parquet(cfg.fact_path)
    assert sorted(tuple(r) for r in after.drop("batch_token", "ingest_ts").collect()) == before
    assert after.select("event_id").distinct().count() == after.count()
    assert {r[0] for r in after.select("batch_token").distinct().collect()} == {"compacted"}
    fn(parts[0], 0)     # replay of an already compacted batch
    assert spark.read.parquet(cfg.fact_path).count() == len(before)


def test_ids_under_other_dates_are_conflicts_and_fold(spark):
    """A later batch brings stored ids with other dates: none is inserted, before and after the ids are folded."""
    cfg = _cfg(spark)
    cfg.id_buckets = 4
    fn = sing.MicroBatchWriter(spark, cfg, "q5")
    b = _batch(spark)
    for i in range(3):
        fn(b.filter(F.col("kafka_partition") == i), i)
    n = spark.read.parquet(cfg.fact_path).count()
    moved = b.withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 3 DAYS")).withColumn("kafka_offset", F.col("kafka_offset") + 50_000_000)
    fn(moved, 3)
    assert spark.read.parquet(cfg.fact_path).count() == n
    ids = fn.id_table()
    assert ids.fold(spark, most=1) == [0, 1, 2, 3] and ids.fold(spark, most=1) == []
    stored = spark.read.parquet(ids.path)
    assert stored.count() == n == stored.select("event_id").distinct().count()
    fn(moved, 4)
    fn(b.filter(F.col("kafka_partition") == 1), 1)          # a replay after the fold
    assert spark.read.parquet(cfg.fact_path).count() == n


def test_the_table_of_ids_is_made_from_stored_facts(spark):
    cfg = _cfg(spark)
    fn = sing.MicroBatchWriter(spark, cfg, "q6")
    b = _batch(spark)
    fn(b.filter(F.col("kafka_partition") == 0), 0)
    from tickflow.plans import sinks
    sinks.delete_path(spark, fn.id_table().path)
    fn(b, 1)
    got = spark.read.parquet(cfg.fact_path)
    assert got.count() == got.select("event_id").distinct().count()
    assert spark.read.parquet(fn.id_table().path).count() == got.count()


def test_ids_are_forgotten_with_their_facts(spark):
    from tickflow.plans import sinks
    cfg = _cfg(spark)
    fn = sing.MicroBatchWriter(spark, cfg, "q7")
    b = _batch(spark)
    fn(b, 0)
    cutoff = "2024-01-15 07:00:00"
    sinks.apply_retention(spark, cfg.fact_path, "event_ts", cutoff, "event_date")
    facts = spark.read.parquet(cfg.fact_path)
    fn.id_table().forget(facts, "2024-01-15")
    ids = spark.read.parquet(fn.id_table().path)
    assert sorted(r[0] for r in ids.select("event_id").collect()) == sorted(r[0] for r in facts.select("event_id").collect())
    n = facts.count()
    fn(b, 1)      # ids whose facts are gone may come again
    again = spark.read.parquet(cfg.fact_path)
    assert again.count() > n and again.count() == again.select("event_id").distinct().count()


def test_latest_fold_is_idempotent_and_equals_batch_mart(spark):
    from tickflow.operators import marts
    from tickflow.plans import sinks
    stg = marts.stg_raw_prices(fx.ticks(fx.read_events(spark, SF_SMALL)))
    path = scratch_path(spark, "t-latest")
    halves = [stg.filter(F.col("event_ts") < F.lit("2024-01-15").cast("timestamp_ntz")),
              stg.filter(F.col("event_ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))]
    for h in [halves[1], halves[0], halves[1]]:      # out of order and repeated
        sing.update_latest(spark, path, h)
    got = sorted(tuple(r) for r in marts.latest_view(sinks.published(spark, path)).collect())
    assert got == sorted(tuple(r) for r in marts.latest_prices_single_pass(stg).collect())


def test_text_source_lines_are_ingested(spark, tmp_path):
    import json
    good = {"schema_version": 1, "event_id": "t-1", "commodity": "gold", "symbol": "XAU/USD",
            "price": 1987.25, "currency": "USD", "timestamp": "2025-06-02T08:15:30Z",
            "source": "feed", "ingest_interval_sec": 120}
    src = scratch_path(spark, "t-text")
    lines = [json.dumps(good), json.dumps(dict(good, event_id="t-2", price=-1.0)), "not json", "not json",
             "not json", json.dumps(good)]                      # equal bad lines; a duplicate id
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(src)
    cfg = _cfg(spark, src)
    cfg.source_format = "text"
    sing.start_ingest(spark, cfg).awaitTermination()
    assert [r["event_id"] for r in spark.read.parquet(cfg.fact_path).collect()] == ["t-1"]
    reasons = sorted(r["error_reason"] for r in spark.read.parquet(cfg.dlq_path).collect())
    assert reasons == ["INVALID_FIELD:price<=0"] + 3 * ["JSON_PARSE_ERROR_OR_EMPTY"]


def test_compaction_file_count_follows_stored_size(spark):
    # with a tiny target file size a compacted date is written by several
    # tasks (files), not funnelled through one writer; rows are unchanged
    import glob
    from tickflow.plans import sinks
    cfg = _cfg(spark)
    fn = sing.MicroBatchWriter(spark, cfg, "q4")
    b = _batch(spark)
    for i, p in enumerate(b.filter(F.col("kafka_partition") == k) for k in range(3)):
        fn(p, i)
    before = spark.read.parquet(cfg.fact_path).count()
    old = sinks.TARGET_FILE_BYTES
    sinks.TARGET_FILE_BYTES = 4096
    # read splits scaled down with the files, as they are at real sizes
    # (128 MB splits under 256 MB files); otherwise the tiny staged files
    # are packed into one read task
    # (and no AQE merging of the dedupe shuffle's tiny partitions)
    confs = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        done = sinks.compact(spark, cfg.fact_path)
    finally:
        sinks.TARGET_FILE_BYTES = old
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert done
    local = cfg.fact_path.replace("file:", "")
    files = glob.glob(f"{local}/event_date={done[0]}/batch_token=compacted/*.parquet")
    assert len(files) > 1
    assert spark.read.parquet(cfg.fact_path).count() == before


def test_a_broken_publish_is_not_seen(spark):
    from tickflow.plans import sinks
    path = scratch_path(spark, "t-published")
    assert sinks.published(spark, path) is None
    sinks.publish(spark.range(3), path)
    spark.range(99).write.parquet(f"{path}/v1")
    sinks.delete_path(spark, f"{path}/v1/_SUCCESS")            # a write that broke off
    assert sinks.published(spark, path).count() == 3
    sinks.publish(sinks.published(spark, path).unionAll(spark.range(2)), path)
    assert sinks.published(spark, path).count() == 5
    sinks.publish(spark.range(1), path)
    assert [v for v, _ in sinks._versions(spark, path)] == [2, 3]


def test_retention_broken_off_before_its_write_loses_no_row(spark, monkeypatch):
    from tickflow.plans import sinks
    path = scratch_path(spark, "t-retention")
    rows = spark.range(48).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id))").alias("event_ts"),
                                  (F.col("id") % 2).alias("batch_token"))
    rows.withColumn("event_date", F.to_date("event_ts")).write.partitionBy("event_date", "batch_token").parquet(path)
    def fail(*_):
        raise OSError("broken off")
    with monkeypatch.context() as m:
        m.setattr(sinks, "_leaf_dirs", fail)
        try:
            sinks.apply_retention(spark, path, "event_ts", "2024-01-02 06:00:00", "event_date")
        except OSError:
            pass
    keep = F.col("event_ts") >= F.lit("2024-01-02 06:00:00").cast("timestamp_ntz")
    assert spark.read.parquet(path).filter(keep).count() == 18
    sinks.apply_retention(spark, path, "event_ts", "2024-01-02 06:00:00", "event_date")
    assert spark.read.parquet(path).count() == 18 and spark.read.parquet(path).filter(keep).count() == 18


def test_stop_request_ends_a_waiting_query():
    import os
    import signal
    class Query:
        stopped = False
        def awaitTermination(self, _):
            os.kill(os.getpid(), signal.SIGTERM)
            return False
        def stop(self):
            self.stopped = True
    before, q = signal.getsignal(signal.SIGTERM), Query()
    with sing.StopRequest() as stop:
        assert sing.run_until_stopped(q, stop) and q.stopped
    assert signal.getsignal(signal.SIGTERM) is before


def test_moves_of_several_batches_with_late_ticks(spark):
    """Ticks in order over several batches give the batch mart; late ones change no other row."""
    from tickflow.operators import marts
    from tickflow.streaming import marts as smarts
    stg = marts.stg_raw_prices(fx.ticks(fx.read_events(spark, SF_SMALL)))
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-moves-src", "t-moves", "t-moves-ckpt"))
    edges = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-02"]
    late = stg.orderBy("event_ts").limit(5)
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        part = stg.filter(F.col("event_ts").between(F.lit(a).cast("timestamp_ntz"), F.expr(f"timestamp_ntz'{b} 00:00:00' - interval 1 microsecond")))
        (part.unionAll(late) if i == 2 else part).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(stg.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (smarts.moves(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.filter("time_gap_seconds < 0").isEmpty()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, marts.price_events(stg).select(*got.columns).collect()))


def test_moves_in_order_are_kept_by_slices_of_time(spark):
    """Ticks at the borders of slices, at equal times and a batch late give the batch mart; no instrument is one group."""
    from datetime import datetime, timedelta

    from tickflow.operators import marts
    from tickflow.streaming import ordered
    day, hours = datetime(2024, 1, 1), ordered._SLICE_US / 3.6e9
    at = sorted({day + timedelta(hours=i * hours, seconds=s) for i in range(9) for s in (-1800, -1799, -60, 0, 0.000001, 1, 1739, 1740)})
    rows = [(f"e{i}{k}", "bitcoin", "BTC/USD", 60000.0 + 700 * ((i * 7 + k) % 5), t) for i, t in enumerate(at) for k in range(2)]
    stg = spark.createDataFrame(rows, "event_id string, commodity string, symbol string, price double, event_ts timestamp_ntz")
    rows += [("e", "bitcoin", "BTC/USD", 1.0, None), ("f", "bitcoin", "BTC/USD", 2.0, None)]
    sliced = ordered.in_slices(stg.withColumn("us", F.unix_micros(F.col("event_ts").cast("timestamp"))))
    assert sliced.select("commodity", "symbol", "slice").distinct().count() >= 9
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-ordered-src", "t-ordered", "t-ordered-ckpt"))
    n = len(rows)
    clock = [("z", "none", "CLOCK", 1.0, day + timedelta(days=9))]
    late = rows[n // 2 - 9:n // 2:2]
    for part in ([r for r in rows[:n // 2] if r not in late], rows[n // 2:] + late, clock):
        spark.createDataFrame(part, stg.schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(stg.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (ordered.moves_in_order(stream, "1 day").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    want = marts.price_events(stg).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and not want.isEmpty()


def test_source_files_of_a_span_grow_with_its_rows(spark, monkeypatch):
    """A span's ticks are written by several tasks, and each micro-batch still takes one span."""
    from tickflow import queries
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    path, stg, files = queries._in_pieces(spark, SF_SMALL, "cast(event_id as bigint) % 5 = 0")
    assert files > 1
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) == queries.PIECES * files + 1
    assert stored.filter("symbol <> 'CLOCK'").count() == stg.count()
    got, want = queries.q_streaming_moves_late(spark, SF_SMALL), queries.q_price_events(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_files_of_a_progress_batch_grow_with_the_rows(spark, monkeypatch):
    """The number of micro-batches stays, the files of each follow the input."""
    from tickflow import queries
    seen, start = [], sing.start_ingest
    monkeypatch.setattr(queries, "FILE_ROWS", 50)
    monkeypatch.setattr(sing, "start_ingest", lambda s, cfg, name: seen.append(cfg) or start(s, cfg, name))
    row = queries.q_ingest_progress(spark, SF_SMALL).first()
    n = fx.read_events(spark, SF_SMALL).count()
    assert seen[0].max_per_trigger == -(-n // (50 * queries.PIECES)) > 2
    assert (row["batches"], row["input_rows"], row["over_limit"]) == (queries.PIECES, n, 0)
