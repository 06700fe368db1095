import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators.windows import gaps
from gaugeflow.sinks import writers
from gaugeflow.streaming import absence, jobs

BASE = datetime(2025, 1, 1)
SCHEMA = "k string, t timestamp, n int"


def arrivals(seed, count):
    rng, rows, now = random.Random(seed), [], {k: 0.0 for k in ("a", "b", None)}
    for n in range(count):
        k = rng.choice(list(now))
        now[k] += rng.choice([0.1, 0.5, 1.0, 3.0, 3.0001, 9.0, 30.0])
        rows.append((k, BASE + timedelta(seconds=now[k]), n))
    return rows + [("a", None, -1)]


def as_rows(frame):
    return sorted((repr(r.k), r.gap_after, r.resumed_at, r.missing) for r in frame.collect())


def wait_for(query, condition, seconds=90):
    deadline = time.time() + seconds
    while time.time() < deadline and not condition():
        assert query.exception() is None
        time.sleep(0.5)
    assert condition()


@pytest.mark.parametrize("files", [1, 4])
def test_closed_gaps_equal_those_of_the_table(spark, tmp_path, files):
    """And the last silence of each series is reported without further input, its end when data resume."""
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    rows = arrivals(files, 240)
    size = -(-len(rows) // files)
    session = jobs.state_session(spark, partitions=2)
    spark.createDataFrame(rows[:size], SCHEMA).coalesce(1).write.parquet(landed)
    stream = session.readStream.schema(SCHEMA).parquet(landed)
    found = absence.live_gaps(stream, "t", 3, ["k"])
    query = jobs.start(found, [writers.window_store(store)], str(tmp_path / "ck"), {"processingTime": "1 second"}, "update")

    def stored():
        kinds = "k string, kind string, gap_after timestamp, resumed_at timestamp, missing long, run string, batch_id long"
        return spark.read.schema(kinds).parquet(store) if list((tmp_path / "store").glob("*/*/*.parquet")) else None

    def of(kind):
        return [] if stored() is None else as_rows(stored().where(F.col("kind") == kind))

    try:
        for part in range(1, files):
            spark.createDataFrame(rows[part * size : (part + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        df = spark.createDataFrame(rows, SCHEMA)
        expected = as_rows(gaps(df, "t", 3, ["k"]))
        ends = {repr(r.k): r.t for r in df.groupBy("k").agg(F.max("t").alias("t")).collect()}
        wait_for(query, lambda: of("closed") == expected)
        wait_for(query, lambda: {(r[0], r[1]) for r in of("open")} >= set(ends.items()))
        assert all(r[2] is None and r[3] is None for r in of("open"))
        again = len(of("open"))
        # Data resume for one series: its silence gets an end.
        later = ends["'a'"] + timedelta(seconds=7)
        spark.createDataFrame([("a", later, 0)], SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        wait_for(query, lambda: (repr("a"), ends["'a'"], later, 2) in of("closed"))
        assert len(of("open")) >= again and len(of("closed")) == len(expected) + 1
    finally:
        query.stop()


def test_a_busy_series_sends_a_few_rows(spark):
    rows = [("a", BASE + timedelta(milliseconds=k), k) for k in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    spans = absence.thinned(df, ["k"], "t", 3_000_000).collect()
    assert len(spans) <= 4 and min(r.first for r in spans) <= max(r.last for r in spans)
