"""Streamed windows without their pairs, and streamed pairs in pieces."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import joins
from gaugeflow.operators.joined_windows import joined_window_agg
from gaugeflow.schemas import READING, TOPIC_RECORD
from gaugeflow.sources import topics
from gaugeflow.streaming import jobs, one_pass, repair

BASE = datetime(2025, 1, 1)
SCHEMA = "obs_key string, arrival_ts timestamp, value double, kind string"


class State(dict):
    getValue, updateValue, removeKey = dict.__getitem__, dict.__setitem__, dict.__delitem__


class Handle:
    """State and timers of one group, as a processor sees them."""

    def __init__(self):
        self.timers = []

    def getMapState(self, *_):
        return State()

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, watermark=0):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def rows(t, v, side):
    return pd.DataFrame({"t": t, "v": v, "side": side, "late": False, "landed": 0, "probe": False})


def fed(processor, *frames):
    processor.init(Handle())
    return [out for frame in frames for out in processor.handleInputRows(("a", 0, 0), iter([frame]), Clock())]


@pytest.fixture
def no_pairs(monkeypatch):
    def formed(*_, **__):
        raise AssertionError("pairs are formed")

    monkeypatch.setattr(joins, "interval_join", formed)
    monkeypatch.setattr(one_pass, "band_pairs", formed)


def test_pairs_come_in_pieces(monkeypatch):
    monkeypatch.setattr(one_pass, "PAIRS_AT_ONCE", 1000, raising=False)
    n = 300
    t, side = np.arange(2 * n, dtype=np.int64), np.tile([0, 1], n)
    found = fed(one_pass.OnePass(["k"], -10_000_000, 10_000_000), rows(t, 1.0 * t, side))
    assert sum(map(len, found)) == n * n and max(map(len, found)) <= 1000
    assert len(pd.concat(found)[["t1", "t2"]].drop_duplicates()) == n * n


@pytest.mark.parametrize("low,high,seed", [(-5, 5, 0), (0, 0, 1), (-40, -7, 2), (3, 90, 3)])
def test_sums_of_a_band(low, high, seed):
    """Against brute force; a NaN, an infinity and a huge value stay in their bands."""
    rng = np.random.default_rng(seed)
    left, right = rng.integers(-200, 200, 150), np.sort(rng.integers(-200, 200, 150))
    values, known = rng.integers(-9, 9, 150).astype(float), rng.random(150) < 0.8
    values[[20, 70, 110]] = [np.nan, np.inf, 1e300]
    n, some, total = one_pass.band_sums(left, right, values, known, low, high)
    for t, *own in zip(left, n, some, total):
        band = (right >= t + low) & (right <= t + high)
        expected = [band.sum(), (band & known).sum(), values[band & known].sum()]
        assert np.allclose(own, expected, rtol=1e-12, atol=0, equal_nan=True)


def test_windows_of_a_crowd_need_no_pairs(no_pairs):
    """Ten billion pairs in one window, from rows of two batches."""
    n = 100_000
    t = np.zeros(2 * n, dtype=np.int64)
    frame = rows(t, np.tile([2.0, 3.0], n), np.tile([0, 1], n))
    processor = one_pass.OnePass(["k"], -5_000_000, 5_000_000, 120_000_000)
    assert fed(processor, frame[:n], frame[n:]) == []
    (window,) = processor.handleExpiredTimer(("a", 0, 0), Clock(10**6), None)
    assert window.record_count.tolist() == [n * n]
    assert window.v1.tolist() == [2.0 * n * n] and window.v2.tolist() == [3.0 * n * n]


def typed(spark, count, seed):
    rng, out = random.Random(seed), []
    for k in range(count):
        moment = BASE + timedelta(milliseconds=rng.randrange(1_200_000)) if rng.random() < 0.98 else None
        key = rng.choice("abc") if rng.random() < 0.97 else None
        out.append((key, moment, rng.choice([1.0 * k, None, 0.5, 7.25]), rng.choice(["x", "y"])))
    return spark.createDataFrame(out, SCHEMA)


def sides(df):
    return [df.where(F.col("kind") == kind).drop("kind") for kind in "xy"]


@pytest.mark.parametrize("salts", ["auto", 3])
def test_streamed_windows_equal_the_batch(spark, tmp_path, no_pairs, salts):
    """Rows without a value count; rows without a key or a time do not; late ones are counted elsewhere."""
    df, path = typed(spark, 1500, 0), str(tmp_path / "in")
    df.write.parquet(path)
    session = jobs.state_session(spark, partitions=2)
    stream = topics.read_record_files(session, path, df.schema)
    windows = joined_window_agg(*sides(stream), -20, 20, max_delay="10 minutes", salts=salts)
    found = []
    flush = [(k, t, 1.0, kind) for k, t in (("a", BASE), ("z", datetime(2999, 1, 1))) for kind in "xy"]
    query = jobs.replay(
        windows, [lambda out, _: found.extend(out.collect())], str(tmp_path / "checkpoint"),
        lambda: spark.createDataFrame(flush, df.schema).coalesce(1).write.mode("append").parquet(path),
    )
    batch = joined_window_agg(*sides(df), -20, 20)
    columns = ["window_start_ts", "window_end_ts", "record_count", "avg_timestamp", "avg_v1", "avg_v2"]

    def shown(out):
        return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in (r[c] for c in columns)) for r in out)

    assert len(found) == 10 and shown(found) == shown(batch.collect())
    late = sum(p.observedMetrics[one_pass.LATE_ROWS]["rows"] for p in query.recentProgress if p.observedMetrics)
    assert late == 2


def test_message_windows_of_a_stream_form_no_pairs(spark, tmp_path, no_pairs):
    spark.createDataFrame([], TOPIC_RECORD).write.parquet(str(tmp_path / "in"))
    session = jobs.state_session(spark, partitions=2)
    stream = topics.read_record_files(session, str(tmp_path / "in"))
    assert jobs.message_windows(stream).isStreaming


def test_repair_forms_no_pairs(spark, no_pairs):
    """Four hundred million pairs in one window, repaired by sums."""
    n = 20_000
    moment = F.lit(BASE).cast("timestamp")
    number = F.when(F.col("id") % 2 == 0, 2.0), F.when(F.col("id") % 2 == 1, 3.0)
    readings = spark.range(2 * n).select(
        F.lit("a").alias("obs_key"), moment.alias("obs_ts"), moment.alias("arrival_ts"),
        number[0].alias("temperature"), number[1].alias("precipitation"),
    )
    assert readings.columns == READING.names
    late = readings.limit(1).select(F.unix_micros("arrival_ts").alias("t1"), F.lit(None).cast("long").alias("t2"))
    (window,) = repair.repaired_windows(readings, repair.touched_windows(late)).collect()
    assert (window.record_count, window.avg_temperature, window.avg_precipitation) == (n * n, 2.0, 3.0)
