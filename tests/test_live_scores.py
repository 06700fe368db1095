import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.functions import scoring
from gaugeflow.operators.series import last_n
from gaugeflow.streaming import jobs, live_scores

BASE = datetime(2025, 1, 1)
SCHEMA = "k string, t timestamp, y double, n long"


def rows_of(seed, count):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "b", None]), BASE + timedelta(seconds=rng.randrange(60 + 3 * n)), rng.random() * 0.3, n) for n in range(count)]
    return rows + [("a", None, 1.0, -1), ("b", BASE, None, -2), ("lone", BASE, 0.2, -3)]


def batch(df, size):
    """The newest values of each series, scored by the batch expressions."""
    kept = last_n(df.dropna(subset=["t", "y"]), size, "k", "t", ["n"])
    stats = kept.groupBy("k").agg(
        F.count("*").alias("n"), F.avg("y").alias("mean"), F.max("y").alias("peak"),
        F.array_sort(F.collect_list(F.struct("t", F.col("n").alias("i"), "y"))).alias("all"),
    )
    out = {}
    for r in stats.collect():
        y = np.array([x.y for x in r.all])
        trend = float(np.polyfit(np.arange(len(y)), y, 1)[0]) if len(y) > 1 else 0.0
        out[r.k] = (r.n, r.mean, r.peak, trend)
    return out


@pytest.mark.parametrize("size,files", [(30, 4), (5, 3)])
def test_equals_the_batch_score_after_each_trigger(spark, tmp_path, size, files):
    rows, landed = rows_of(size, 260), str(tmp_path / "landed")
    step = -(-len(rows) // files)
    session = jobs.state_session(spark, partitions=2)
    spark.createDataFrame([], SCHEMA).write.parquet(landed)
    stream = session.readStream.schema(SCHEMA).parquet(landed)
    scores = live_scores.live_scores(stream, ["k"], "t", "y", "n", size)
    current = {}
    for part in range(files):
        spark.createDataFrame(rows[part * step : (part + 1) * step], SCHEMA).repartition(2).write.mode("append").parquet(landed)
        jobs.start(
            scores, [lambda df, batch_id: current.update({r.k: r for r in df.collect()})], str(tmp_path / "ck"),
            {"availableNow": True}, "update",
        ).awaitTermination()
        wanted = batch(spark.createDataFrame(rows[: (part + 1) * step], SCHEMA), size)
        assert set(current) == set(wanted)
        for k, (n, mean, peak, trend) in wanted.items():
            row = current[k]
            assert row.n == n and np.allclose((row.mean, row.peak, row.trend), (mean, peak, trend), atol=1e-12)
            one = spark.createDataFrame([(row.mean, row.peak, row.trend)], "m double, p double, t double")
            (again,) = one.select(scoring.exceedance_score(F.col("m"), F.col("p"), F.col("t"))).first()
            assert row.score == again and row.decision in (scoring.POSITIVE_DECISION, scoring.NEGATIVE_DECISION)


def test_a_busy_series_sends_a_ring(spark):
    frame = spark.range(5000).selectExpr("'a' AS k", "id AS t", "id AS tie", "rand(1) AS y").toPandas()
    kept = live_scores.newest(frame, ["k"], 30)
    assert len(kept) == 30 and kept["t"].min() == 4970
