from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gaugeflow.functions.times import cell
from gaugeflow.operators import extracts
from gaugeflow.operators.windows import gaps, tumbling_agg

BASE = datetime(2025, 1, 23, 22, 14)


def test_gap_fixture(spark):
    frame = spark.createDataFrame([(BASE + timedelta(minutes=m),) for m in (0, 2, 8)], "t TIMESTAMP")
    found = gaps(frame, "t", 120).collect()
    assert [(g.gap_after, g.resumed_at, g.missing) for g in found] == [
        (BASE + timedelta(minutes=2), BASE + timedelta(minutes=8), 2)
    ]


def test_gaps_equal_a_plain_lag(spark):
    frame = spark.range(4000).select(
        (F.col("id") % 3).alias("k"),
        F.timestamp_micros(F.pmod(F.xxhash64("id"), F.lit(400_000_000_000))).alias("t"),
    )
    times = {}
    for row in frame.collect():
        times.setdefault(row.k, []).append(row.t)
    expected = set()
    for key, moments in times.items():
        moments.sort()
        for before, after in zip(moments, moments[1:]):
            if after - before > timedelta(seconds=120):
                step = (after - before) / timedelta(microseconds=1) / 120e6
                expected.add((key, before, after, -int(-step // 1) - 1))
    assert {tuple(r) for r in gaps(frame, "t", 120, ["k"]).collect()} == expected
    assert expected


def test_mean_time_does_not_overflow(spark):
    """Ten million times of 2025 sum to more than a long holds."""
    start = datetime(2025, 1, 1)
    frame = spark.range(10_000_000).select(F.lit(start).alias("t"), F.lit(1.0).alias("v"))
    row = tumbling_agg(frame, "t", {"m": "v"}, mean_of="t").first()
    assert (row.mean_obs, row.record_count) == (start, 10_000_000)


def test_mean_time_rounds_down(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,)], "ms BIGINT").select(
        F.timestamp_millis(F.col("ms")).alias("t"), F.lit(1.0).alias("v")
    )
    row = tumbling_agg(frame, "t", {"m": "v"}, mean_of="t").select(F.unix_millis("mean_obs")).first()
    assert row[0] == 1


def test_cells_are_exact(spark):
    frame = spark.createDataFrame([(v,) for v in (-1, 0, 9, 10, 1_737_670_500_000_000)], "v BIGINT")
    assert [r[0] for r in frame.select(cell(F.col("v"), 10)).collect()] == [
        -1, 0, 0, 1, 173_767_050_000_000
    ]


def test_sum_of_counts_is_the_input(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    windows = tumbling_agg(events, "ts", {"m": "value"}, keys=["event_type"])
    assert windows.agg(F.sum("record_count")).first()[0] == events.count()


def test_text_and_typed_ranges_agree(spark):
    moments = [datetime(2025, 1, 23, 22, 14, 59) + timedelta(seconds=s) for s in range(0, 1000, 7)]
    frame = spark.createDataFrame([(m,) for m in moments], "t TIMESTAMP").withColumn(
        "text", F.date_format("t", "yyyy-MM-dd'T'HH:mm")
    )
    for low, high in [
        ("2025-01-23 22:15:00", "2025-01-23 22:30:00"),
        ("2025-01-23 22:15:30", "2025-01-23 22:20:10"),
    ]:
        by_text = {r.t for r in extracts.text_range(frame, "text", low, high).collect()}
        by_type = {r.t for r in extracts.typed_range(frame, "t", low, high).collect()}
        assert by_text == by_type and by_text


def test_range_reaches_the_scan(spark, small):
    table = spark.read.parquet(f"{small}/events.parquet")
    found = extracts.typed_range(table, "ts", "2024-01-05 06:15:00", "2024-01-12 18:30:00")
    plan = found.select("ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_latest_is_a_bounded_sort(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    newest = extracts.latest(orders, "o_orderdate", 10, ["o_orderkey"])
    assert "TakeOrderedAndProject" in newest._jdf.queryExecution().executedPlan().toString()


def test_group_means_reject_bad_text(spark):
    import pytest
    from pyspark.errors import NumberFormatException

    frame = spark.createDataFrame([("a", "x")], "k STRING, v STRING")
    with pytest.raises(NumberFormatException):
        extracts.group_means(frame, ["k"], {"m": "v"}).collect()
