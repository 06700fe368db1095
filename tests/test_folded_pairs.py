"""Pairs of a stream, folded in blocks and unfolded where they are read."""

import math
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.plans import queries
from gaugeflow.schemas import EVENTS
from gaugeflow.sinks import writers
from gaugeflow.streaming import jobs, one_pass

BASE = datetime(2025, 1, 1)
SCHEMA = "obs_key string, area int, arrival_ts timestamp, x double, y double, id long"


def test_a_crowd_is_stored_folded(spark, tmp_path, monkeypatch):
    """Four million pairs, and a few of another hour: the store holds blocks, the result every pair."""
    n = 2_000
    rows = [
        (k, BASE + timedelta(milliseconds=100 * (k // 2)), 0, ("click", "view")[k % 2], float(k), "{}") for k in range(2 * n)
    ]
    rows += [(2 * n + k, BASE + timedelta(hours=2, minutes=4 * k), 0, ("click", "view")[k % 2], 0.5, None) for k in range(6)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda _, label: f"{tmp_path}/{label}")
    pairs = queries.stream_one_pass_pairs(spark, f"{tmp_path}/sf")
    assert writers.read_store(spark, f"{tmp_path}/one-pass/pairs").count() < n * n / 1000
    crowd = pairs.where("v1 <> 0.5").agg(F.count("*"), F.sum("v1"), F.sum("v2"), F.count_distinct("t1", "t2")).first()
    assert tuple(crowd) == (n * n, n * sum(range(0, 2 * n, 2)), n * sum(range(1, 2 * n, 2)), n * n)
    assert pairs.where("v1 = 0.5").count() == 5


@pytest.mark.parametrize("most", [1, 7, 1000])
@pytest.mark.parametrize("low,high,seed", [(-5, 5, 0), (0, 0, 1), (-40, -7, 2), (3, 90, 3), (-1000, 1000, 4)])
def test_blocks_hold_the_pairs_of_a_band(low, high, seed, most):
    rng = np.random.default_rng(seed)
    left, right = rng.integers(-200, 200, 150), np.sort(rng.integers(-200, 200, 130))
    found = []
    for a, first, many, b in one_pass.band_blocks(left, right, low, high, most):
        assert 0 < len(a) == len(first) == len(many) <= most and 0 < b.stop - b.start <= most
        assert many.min() > 0 and first.min() >= 0 and (first + many).max() <= b.stop - b.start
        found += [(i, b.start + f + j) for i, f, m in zip(a.tolist(), first.tolist(), many.tolist()) for j in range(m)]
    expected = [(i, j) for i in range(150) for j in range(130) if low <= right[j] - left[i] <= high]
    assert sorted(found) == expected


def test_a_side_without_rows_has_no_blocks():
    some, none = np.arange(5, dtype=np.int64), np.zeros(0, dtype=np.int64)
    assert not any(list(one_pass.band_blocks(*sides, -9, 9)) for sides in ((some, none), (none, some), (none, none)))


def readings(seed, count):
    rng = random.Random(seed)
    values = [1.0, 2.5, math.nan, math.inf, -0.0, None]
    return [
        (
            rng.choice(["a", "b", None]), rng.choice([1, 2]),
            BASE + timedelta(milliseconds=500 * rng.randrange(600)) if rng.random() < 0.98 else None,
            rng.choice([k / 8, *values]), rng.choice([k / 4, *values]), k,
        )
        for k in range(count)
    ]


@pytest.mark.parametrize("lower,upper,level", [(-20, 20, 0), (0, 2.5, 0), (-30, -1, 2)])
def test_both_forms_agree_over_batches(spark, tmp_path, lower, upper, level):
    """Rows of several batches and parts of keys, equal instants, repeated and late rows, odd values."""
    rows = readings(5, 1200)
    rows += rows[:40]
    os.makedirs(f"{tmp_path}/in")
    for step in range(3):
        part = spark.createDataFrame(rows[step::3], SCHEMA).coalesce(1)
        part.write.parquet(f"{tmp_path}/part-{step}")
        (name,) = [f for f in os.listdir(f"{tmp_path}/part-{step}") if f.endswith(".parquet")]
        os.rename(f"{tmp_path}/part-{step}/{name}", f"{tmp_path}/in/{step}.parquet")
        os.utime(f"{tmp_path}/in/{step}.parquet", (1_700_000_000 + step,) * 2)
    session, keys, stored = jobs.state_session(spark, partitions=2), ["obs_key", "area"], {}
    for folded in (False, True):
        stream = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        marked = one_pass.one_pass(
            stream.withColumn("level", F.lit(level)), "x", "y", keys, lower=lower, upper=upper, max_delay="2 minutes", folded=folded,
        )
        sink = writers.window_store(f"{tmp_path}/{folded}", options=one_pass.BLOCK_STORE)
        jobs.start(marked, [sink], f"{tmp_path}/ck-{folded}", {"availableNow": True}).awaitTermination()
        stored[folded] = writers.read_store(spark, f"{tmp_path}/{folded}")

    def shown(df):
        return sorted(map(repr, df.collect()))

    pairs = {folded: shown(one_pass.pairs_of(df, keys)) for folded, df in stored.items()}
    assert pairs[True] == pairs[False] and len(pairs[True]) > 500
    assert {r.kind for r in stored[True].select("kind").collect()} == {one_pass.FOLDED, one_pass.LATE}
    late = [shown(df.where(F.col("kind") == one_pass.LATE).select(*keys, "t1", "v1", "t2", "v2", "batch_id")) for df in stored.values()]
    assert late[0] == late[1] and len(late[0]) > 100


def test_unfolding_deals_blocks_out(spark):
    """Blocks of one file, as a hot key leaves them, are unfolded by many tasks."""
    block = "array(1L) AS times1, array(1D) AS values1, array(0) AS from2, array(2) AS many2, array(1L, id) AS times2, array(1D, 2D) AS values2"
    blocks = spark.range(400).coalesce(1).selectExpr("'a' AS obs_key", "'folded' AS kind", *block.replace(", array", "|array").split("|"))
    pairs = one_pass.pairs_of(blocks)
    assert pairs.count() == 800 and pairs.where("v2 = 2").select("t2").distinct().count() == 400
    assert pairs.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism
