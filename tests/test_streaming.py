import os
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators.joins import paired_readings
from gaugeflow.operators.parsing import parse_messages
from gaugeflow.schemas import TOPIC_RECORD
from gaugeflow.sinks import writers
from gaugeflow.sources import topics
from gaugeflow.streaming import jobs, wallclock

BASE = datetime(2025, 1, 23, 22, 0)
COLUMNS = ["window_start", "window_end", "avg_timestamp", "avg_temperature", "avg_precipitation", "record_count"]


def records(spark, start, end):
    """One poll per 30 seconds: a temperature and, 20 ms later, a precipitation message."""
    rows = []
    for poll in range(start, end):
        moment = BASE + timedelta(seconds=30 * poll)
        # The observation time is stale: it moves every 15 minutes only.
        stamp = moment.replace(minute=moment.minute // 15 * 15).strftime("%Y-%m-%dT%H:%M")
        for field, value, late in (("temperature_2m", 8 + poll / 10, 0), ("precipitation", poll / 100, 20)):
            body = f'{{"time":"{stamp}","{field}":{value}}}'
            rows.append((body, int(late > 0), poll, moment + timedelta(milliseconds=late)))
        if poll % 10 == 0:
            rows.append(("garbage{", 0, poll, moment))
    return spark.createDataFrame(rows, TOPIC_RECORD).coalesce(1)


def as_set(frame):
    # The order of addition differs between runs.
    rounded = {c: F.round(c, 9) for c in COLUMNS if c in ("avg_temperature", "avg_precipitation")}
    return {tuple(r) for r in frame.withColumns(rounded).select(COLUMNS).collect()}


def beat(session, path):
    body = '{"time":"2999-01-01T00:00","temperature_2m":0,"precipitation":0}'
    return lambda: jobs.heartbeat(session, path, TOPIC_RECORD, value=body, timestamp="2999-01-01 00:00:00")


def test_restarted_stream_equals_batch(spark, tmp_path):
    """Polls pair up, four per window; a stop in between neither loses nor repeats a window."""
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    checkpoint = str(tmp_path / "checkpoint")
    session = jobs.state_session(spark, partitions=2)
    sinks = [writers.window_store(store, "window_date")]

    def stream():
        return jobs.message_windows(topics.read_record_files(session, landed), "1 minute")

    records(spark, 0, 50).write.mode("append").parquet(landed)
    jobs.replay(stream(), sinks, checkpoint)
    early = as_set(writers.read_store(spark, store))
    records(spark, 50, 120).write.mode("append").parquet(landed)
    jobs.replay(stream(), sinks, checkpoint, beat(session, landed))

    batch = jobs.message_windows(records(spark, 0, 120))
    stored = writers.read_store(spark, store)
    assert early and early < as_set(batch)
    assert as_set(stored) == as_set(batch)
    assert stored.count() == 30
    assert {r.record_count for r in stored.collect()} == {4}


def test_dead_letters_of_a_stream(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "dead")
    records(spark, 0, 40).write.parquet(landed)
    session = jobs.state_session(spark, partitions=2)
    dead = jobs.dead_letters(topics.read_record_files(session, landed))
    jobs.replay(dead, [writers.window_store(store)], str(tmp_path / "checkpoint"))
    rows = writers.read_store(spark, store).collect()
    assert [(r.reason, r.raw) for r in rows] == [("bad_json", "garbage{")] * 4


def test_observed_pairs_reach_a_listener(spark):
    readings, _ = parse_messages(records(spark, 0, 20))
    one = readings.where("temperature IS NOT NULL").withColumn("value", F.col("temperature"))
    two = readings.where("precipitation IS NOT NULL").withColumn("value", F.col("precipitation"))
    assert jobs.observed_pairs(paired_readings(one, two)).count() == 20


def test_late_rows_are_dropped_after_the_delay(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    session = jobs.state_session(spark, partitions=2)
    records(spark, 20, 60).write.parquet(landed)
    stream = jobs.message_windows(topics.read_record_files(session, landed), "1 minute")
    sinks = [writers.window_store(store)]
    jobs.replay(stream, sinks, str(tmp_path / "checkpoint"))
    records(spark, 0, 4).write.mode("append").parquet(landed)
    jobs.replay(stream, sinks, str(tmp_path / "checkpoint"), beat(session, landed))
    starts = {r.window_start for r in writers.read_store(spark, store).collect()}
    assert "2025-01-23T22:00:00" not in starts and "2025-01-23T22:28:00" in starts


def test_streaming_join_needs_a_delay(spark, tmp_path):
    landed = str(tmp_path / "landed")
    records(spark, 0, 2).write.parquet(landed)
    with pytest.raises(ValueError):
        jobs.message_windows(topics.read_record_files(spark, landed), max_delay=None)


def test_state_partitions_follow_the_cores(spark):
    def partitions(**options):
        return jobs.state_session(spark, **options).conf.get("spark.sql.shuffle.partitions")

    assert partitions() == str(max(8, spark.sparkContext.defaultParallelism))
    assert partitions(partitions=300) == "300"


def test_one_minute_fills_many_state_keys(spark):
    """All traffic under one minute key: salts spread it over the state partitions."""
    rows = [(f'{{"time":"2025-01-23T22:00","{f}":1}}', 0, n, BASE + timedelta(milliseconds=20 * n))
            for n in range(200) for f in ("temperature_2m", "precipitation")]
    readings, _ = parse_messages(spark.createDataFrame(rows, TOPIC_RECORD))
    one = readings.where("temperature IS NOT NULL").withColumn("value", F.col("temperature"))
    two = readings.where("precipitation IS NOT NULL").withColumn("value", F.col("precipitation"))
    keys = {}
    for salts in (1, 8):
        plan = paired_readings(one, two, salts=salts)
        spread = plan.select(F.pmod(F.xxhash64("obs_key", "obs_ts", "t1", "v1"), F.lit(salts)).alias("s"))
        keys[salts] = spread.distinct().count()
        assert plan.count() == paired_readings(one, two).count()
    assert keys == {1: 1, 8: 8}


def test_totals_over_many_triggers(spark, tmp_path):
    """More triggers than a query remembers: every late row and every observed row is counted."""
    landed = tmp_path / "landed"
    landed.mkdir()
    schema = "ts TIMESTAMP, v DOUBLE"

    def land(number, moment, count):
        frame = pd.DataFrame({"ts": pd.to_datetime([moment] * count).astype("datetime64[us]"), "v": [1.0] * count})
        frame.to_parquet(landed / f"{number:03d}.parquet", index=False)
        os.utime(landed / f"{number:03d}.parquet", (1_700_000_000 + number,) * 2)

    land(0, datetime(2025, 1, 2), 1)
    land(1, datetime(2025, 1, 2), 1)
    for number in range(2, 112):
        land(number, datetime(2025, 1, 1), 2)
    session = jobs.state_session(spark, partitions=1)
    totals = jobs.Totals()
    session.streams.addListener(totals)
    try:
        stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(landed))
        seen = jobs.observed_pairs(stream.withColumn("v1", F.col("v")).withColumn("v2", F.col("v")), "seen")
        windows = seen.withWatermark("ts", "1 minute").groupBy(F.window("ts", "2 minutes")).agg(F.count("*").alias("n"))
        query = jobs.start(windows, [lambda d, b: d.count()], str(tmp_path / "checkpoint"), {"availableNow": True})
        query.awaitTermination()
        deadline = time.time() + 30
        while totals.observed[str(query.id), "seen"] < 222 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        session.streams.removeListener(totals)
    assert totals.observed[str(query.id), "seen"] == 222
    # Spark counts late groups after the partial sum: one per trigger and window.
    assert totals.late[str(query.id)] in (110, 220)


def test_runs_do_not_overwrite_each_other(spark, tmp_path):
    """Two checkpoints on one store, both with a batch 0; then a replay of the second."""
    store = str(tmp_path / "store")
    session = jobs.state_session(spark, partitions=2)
    for run, part in (("one", range(0, 50)), ("two", range(50, 80))):
        landed = str(tmp_path / run)
        rows = [(i, datetime(2025, 1, 1 + i % 3)) for i in part]
        spark.createDataFrame(rows, "id BIGINT, ts TIMESTAMP").coalesce(1).write.parquet(landed)
        stream = session.readStream.schema("id BIGINT, ts TIMESTAMP").parquet(landed)
        dated = stream.withColumn("window_date", F.to_date("ts"))
        jobs.replay(dated, [writers.window_store(store, "window_date")], str(tmp_path / f"{run}-checkpoint"))
    stored = writers.read_store(spark, store)
    assert sorted(r.id for r in stored.collect()) == list(range(80))
    assert stored.select("run").distinct().count() == 2
    assert sorted(p.name for p in (tmp_path / "store").glob("window_date=*")) == [
        f"window_date=2025-01-0{d}" for d in (1, 2, 3)
    ]
    compact = str(tmp_path / "compact")
    writers.compact_store(spark, store, compact, "window_date")
    assert sorted(r.id for r in writers.stored_documents(spark, compact).collect()) == list(range(80))
    assert len(list((tmp_path / "compact").glob("*/*/*/*.parquet"))) == 3


def test_pairs_close_on_the_wall_clock(spark, tmp_path):
    """Join, then windows that close without further input; missing metrics count as rows only."""
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    rows = [("k", i % 2, BASE + timedelta(milliseconds=i), None if i % 10 == 1 else float(i)) for i in range(100)]
    spark.createDataFrame(rows, "obs_key STRING, kind INT, ts TIMESTAMP, value DOUBLE").coalesce(1).write.parquet(landed)
    session = jobs.state_session(spark, partitions=2)

    def one(kind):
        stream = session.readStream.schema("obs_key STRING, kind INT, ts TIMESTAMP, value DOUBLE").parquet(landed)
        return stream.where(F.col("kind") == kind).select("obs_key", F.col("ts").alias("arrival_ts"), "value")

    pairs = paired_readings(one(0), one(1), 0, 0.001, max_delay="1 minute", salts=2)
    closed = wallclock.closed_pair_windows(pairs, size_seconds=2, salts=2)
    query = jobs.start(closed, [writers.window_store(store)], str(tmp_path / "checkpoint"), {"processingTime": "1 second"})
    try:
        deadline, got = time.time() + 60, []
        while time.time() < deadline and sum(r.record_count for r in got) < 50:
            time.sleep(1)
            assert query.exception() is None
            if list((tmp_path / "store").glob("*/*/*.parquet")):
                got = wallclock.merge_closed(writers.read_store(spark, store), ("a", "b")).collect()
    finally:
        query.stop()
    assert sum(r.record_count for r in got) == 50
    (row,) = got
    assert row.a == pytest.approx(sum(range(0, 100, 2)) / 50)
    kept = [i for i in range(1, 100, 2) if i % 10 != 1]
    assert row.b == pytest.approx(sum(kept) / len(kept)) and row.avg_timestamp == "k"


def test_closed_windows_need_no_further_input(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    rows = [(k, float(i), f"t{i:03d}") for i in range(100) for k in ("a", "b")]
    spark.createDataFrame(rows, "k STRING, v DOUBLE, t STRING").write.parquet(landed)
    session = jobs.state_session(spark, partitions=2)
    stream = session.readStream.schema("k STRING, v DOUBLE, t STRING").parquet(landed)
    closed = wallclock.closed_windows(stream, "k", "v", "t", size_seconds=2, salts=2)
    query = jobs.start(
        closed, [writers.window_store(store)], str(tmp_path / "checkpoint"),
        {"processingTime": "1 second"}, "update",
    )
    try:
        deadline = time.time() + 60
        rows = []
        while time.time() < deadline:
            time.sleep(1)
            assert query.exception() is None
            if not list((tmp_path / "store").glob("*/*/*.parquet")):
                continue
            rows = wallclock.merge_closed(writers.read_store(spark, store)).collect()
            if sum(r.record_count for r in rows) == 200:
                break
    finally:
        query.stop()
    assert sorted((r.series_key, r.record_count, r.avg_metric, r.avg_timestamp) for r in rows) == [
        ("a", 100, 49.5, "t099"), ("b", 100, 49.5, "t099")
    ]
    for row in rows:
        start, end = (datetime.fromisoformat(t) for t in (row.window_start, row.window_end))
        assert end - start == timedelta(seconds=2) and start.second % 2 == 0


def test_running_windows_survive_several_batches(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).selectExpr("double(id) AS v").coalesce(1).write.mode(
            "append"
        ).parquet(landed)
    session = jobs.state_session(spark, partitions=2)
    stream = session.readStream.schema("v DOUBLE").option("maxFilesPerTrigger", 1).parquet(landed)
    windows = wallclock.running_windows(stream, {"m": "v"})
    jobs.start(
        windows, [writers.window_store(store)], str(tmp_path / "checkpoint"), {"availableNow": True}, "update"
    ).awaitTermination()
    final = writers.latest_documents(writers.read_store(spark, store), ["window_start_ts"]).collect()
    assert sum(r.record_count for r in final) == 30
    assert sum(r.m * r.record_count for r in final) == pytest.approx(sum(range(30)))
