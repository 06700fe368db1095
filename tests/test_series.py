from datetime import datetime, timedelta

import pytest
from pyspark.errors import DateTimeException
from pyspark.sql import functions as F

from gaugeflow.operators import series

BASE = datetime(2025, 1, 23, 22, 14)
RAW = "series_key STRING, window_start STRING, avg_temperature STRING, avg_precipitation STRING"


def test_clean_keeps_complete_rows(spark):
    rows = [
        ("a", "2025-01-23T22:16:00", "8.5", "0.15"),
        ("a", "2025-01-23T22:14:00", "8.4", "0.10"),
        ("a", "2025-01-23T22:18:00", "abc", "0.10"),
        ("a", "2025-01-23T22:20:00", "8.1", "nan"),
        ("a", "2025-01-23T22:22:00", None, "0.10"),
        ("a", None, "8.1", "0.10"),
    ]
    cleaned = series.clean_series(spark.createDataFrame(rows, RAW))
    indexed = series.series_index(cleaned).orderBy("idx").collect()
    assert [(r.ds, r.y, r.x, r.idx, r.n) for r in indexed] == [
        (BASE, 0.10, 8.4, 0, 2),
        (BASE + timedelta(minutes=2), 0.15, 8.5, 1, 2),
    ]


def test_bad_time_is_an_error(spark):
    frame = spark.createDataFrame([("a", "yesterday", "1", "1")], RAW)
    with pytest.raises(DateTimeException):
        series.clean_series(frame).collect()


def test_sizes_and_splits(spark):
    # n, changepoints, ratio, daily, train_size
    expected = [
        (1, 1, 0.9, False, 1),
        (5, 1, 0.9, False, 5),
        (10, 1, 0.9, False, 10),
        (12, 1, 0.9, False, 10),
        (19, 1, 0.9, False, 17),
        (20, 2, 0.85, False, 17),
        (49, 2, 0.85, False, 41),
        (50, 5, 0.8, True, 40),
        (100, 5, 0.8, True, 80),
    ]
    sizes = spark.createDataFrame([(e[0],) for e in expected], "n BIGINT")
    got = series.with_config(sizes).orderBy("n").collect()
    assert [(r.n, r.changepoints, r.train_ratio, r.daily, r.train_size) for r in got] == expected
    assert [r.batch_size for r in got] == [1, 5, 8, 8, 8, 16, 16, 32, 32]
    assert [r.epochs for r in got] == [30] * 5 + [50] * 2 + [100] * 2
    assert [r.reliability for r in got] == ["low"] * 5 + ["limited"] + ["normal"] * 3


def test_regressor_gate(spark):
    rows = [("flat", 8.5), ("flat", 8.5), ("moving", 8.5), ("moving", 8.6), ("single", 8.5)]
    gated = series.regressor_gate(spark.createDataFrame(rows, "series_key STRING, x DOUBLE"))
    assert {r.series_key: r.use_regressor for r in gated.collect()} == {
        "flat": False, "moving": True, "single": False
    }


def skewed(spark, rows=30_000):
    """One series with a third of all rows and many equal times, some series of one row."""
    pick = F.pmod(F.xxhash64("id"), F.lit(300))
    return spark.range(rows).select(
        "id",
        F.when(pick < 100, "hot").otherwise(F.concat(F.lit("s"), pick.cast("string"))).alias("series_key"),
        F.timestamp_micros(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5_000)) * 1_000_000).alias("ds"),
    )


def test_ranged_index_equals_plain_index(spark):
    frame = skewed(spark)
    plain = series.series_index(frame, ties=["id"], crowded=False)
    ranged = series.series_index(frame, ties=["id"], crowded=True)
    assert ranged.columns == plain.columns
    assert ranged.exceptAll(plain).count() == 0 and plain.exceptAll(ranged).count() == 0


def test_crowding_is_counted(spark):
    frame = skewed(spark)
    assert series.is_crowded(frame, group_limit=9_000)
    assert not series.is_crowded(frame, group_limit=20_000)


def test_last_n_trims_before_the_shuffle(spark):
    newest = series.last_n(skewed(spark), 3, ties=["id"])
    assert newest.groupBy("series_key").count().agg(F.max("count")).first()[0] == 3
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") >= 2


def test_last_values(spark):
    frame = spark.createDataFrame(
        [("a", BASE, 1, 5.0), ("a", BASE, 2, 6.0), ("a", BASE - timedelta(days=1), 3, 7.0)],
        "series_key STRING, ds TIMESTAMP, id INT, x DOUBLE",
    )
    assert series.last_values(frame, ["x"], ties=["id"]).first().x == 6.0


def test_future_frame(spark):
    origins = spark.createDataFrame([("a", BASE)], "series_key STRING, last_ds TIMESTAMP")
    rows = series.future_frame(origins).orderBy("step_no").collect()
    assert len(rows) == 30
    assert rows[0].ds == BASE + timedelta(minutes=2)
    assert rows[-1].ds == BASE + timedelta(minutes=60)
    shown = series.every_kth(series.future_frame(origins)).orderBy("minutes").collect()
    assert [r.minutes for r in shown] == [2, 12, 22, 32, 42, 52]


def test_train_split(spark):
    frame = spark.range(12).select(
        F.lit("a").alias("series_key"), F.timestamp_seconds(F.col("id")).alias("ds")
    )
    split = series.train_split(frame).orderBy("ds").collect()
    assert [r.is_train for r in split] == [True] * 10 + [False] * 2
