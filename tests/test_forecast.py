import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.functions import design, scoring
from gaugeflow.operators import forecast, reports, series

BASE = datetime(2025, 1, 20)
STEP = 120


def make(spark, lengths, noise=0.05):
    """Series of the given lengths: a bend, a daily wave, a moving or a flat regressor."""
    rng = np.random.default_rng(3)
    rows = []
    for name, n in lengths.items():
        for i in range(n):
            x = 8.5 if name.startswith("flat") else 8.5 + math.sin(i / 3)
            t = i * STEP
            y = 0.2 + 0.002 * i + 0.004 * max(0, i - n // 2) + 0.1 * math.sin(t / 86400 * 2 * math.pi)
            y += 0.05 * (x - 8.5) + noise * rng.standard_normal()
            rows.append((name, BASE + timedelta(seconds=t), float(y), float(x)))
    return spark.createDataFrame(rows, "series_key STRING, ds TIMESTAMP, y DOUBLE, x DOUBLE")


LENGTHS = {"one": 1, "few": 12, "medium": 40, "flat": 60, "long": 300}


def by_hand(rows, daily_order, trend_reg=1.0):
    """The additive model of one series, straight from its definition."""
    rows = sorted(rows, key=lambda r: r.ds)
    n = len(rows)
    bends, ratio = (1, 0.9) if n < 20 else (2, 0.85) if n < 50 else (5, 0.8)
    size = max(int(n * ratio), min(10, n))
    epoch = np.array([r.ds.timestamp() for r in rows])
    x = np.array([r.x for r in rows])
    train = slice(0, size)
    std = x.std(ddof=1) if n > 1 else float("nan")
    span = max(epoch[size - 1] - epoch[0], 1e-6)

    def matrix(seconds, values):
        t = (seconds - epoch[0]) / span
        columns = [np.ones_like(t), t]
        for j in range(1, design.MAX_CHANGEPOINTS + 1):
            place = 0.8 * j / (bends + 1)
            columns.append(np.maximum(t - place, 0) if j <= bends else np.zeros_like(t))
        for k in range(1, daily_order + 1):
            phase = 2 * np.pi * k * (seconds % 86400) / 86400
            for wave in (np.sin(phase), np.cos(phase)):
                columns.append(wave if n >= 50 else np.zeros_like(t))
        use = std > 0.01
        columns.append((values - x[train].mean()) / std if use else np.zeros_like(t))
        return np.column_stack(columns)

    a = matrix(epoch[train], x[train])
    y = np.array([r.y for r in rows])[train]
    gram = a.T @ a + np.diag(design.penalties(daily_order, trend_reg))
    weights = np.linalg.solve(gram, a.T @ y)
    ahead = epoch[-1] + STEP * np.arange(1, 31)
    return matrix(epoch, x) @ weights, matrix(ahead, np.full(30, x[-1])) @ weights


@pytest.mark.parametrize("crowded", [False, True])
def test_additive_equals_direct_solution(spark, crowded):
    frame = make(spark, LENGTHS).repartition(5)
    got = forecast.forecast_additive(frame, daily_order=2, crowded=crowded).collect()
    source = frame.collect()
    for name in LENGTHS:
        past, ahead = by_hand([r for r in source if r.series_key == name], 2)
        mine = sorted((r for r in got if r.series_key == name), key=lambda r: (r.is_future, r.ds))
        assert len(mine) == len(past) + 30
        np.testing.assert_allclose([r.yhat for r in mine], [*past, *ahead], atol=1e-6)


def test_additive_follows_the_series(spark):
    frame = make(spark, {"long": 300}, noise=0.0)
    past = forecast.forecast_additive(frame).where("NOT is_future")
    error = past.join(frame, ["series_key", "ds"]).agg(F.avg(F.abs(F.col("yhat") - F.col("y"))))
    assert error.first()[0] < 0.05


def test_regressor_fills_only_the_future(spark):
    frame = make(spark, {"long": 300})
    model = forecast.fit_additive(frame)
    row = model.first()
    last = frame.orderBy(F.desc("ds")).first()
    assert row.use_regressor and row.x_last == last.x
    assert row.last_ds == last.ds and row.train_end == BASE + timedelta(seconds=239 * STEP)


def test_train_end_origin(spark):
    frame = make(spark, {"long": 100})
    for model in (forecast.forecast_linear, forecast.forecast_additive):
        rows = model(frame, origin="train_end").orderBy("ds").collect()
        assert len(rows) == 80 + 30
        assert [r.is_future for r in rows] == [False] * 80 + [True] * 30
        assert rows[80].ds == BASE + timedelta(seconds=80 * STEP)
        assert [r.step_no for r in rows[80:]] == list(range(30))


@pytest.mark.parametrize("crowded", [False, True])
def test_linear_equals_polyfit(spark, crowded):
    frame = make(spark, LENGTHS)
    source = frame.collect()
    got = forecast.forecast_linear(frame, crowded=crowded).collect()
    errors = {
        r.series_key: r for r in forecast.holdout_metrics(frame, crowded=crowded).collect()
    }
    for name, n in LENGTHS.items():
        rows = sorted((r for r in source if r.series_key == name), key=lambda r: r.ds)
        ratio = 0.9 if n < 20 else 0.85 if n < 50 else 0.8
        size = max(int(n * ratio), min(10, n))
        y = np.array([r.y for r in rows])
        line = np.polyfit(range(size), y[:size], 1) if n > 1 else (0.0, y[0])
        mine = sorted((r for r in got if r.series_key == name), key=lambda r: r.ds)
        np.testing.assert_allclose(
            [r.yhat for r in mine], np.polyval(line, range(n + 30)), atol=1e-8
        )
        held = y[size:] - np.polyval(line, range(size, n))
        if not len(held):
            assert name not in errors
            continue
        assert errors[name].held_out == len(held)
        assert errors[name].mae == pytest.approx(np.abs(held).mean())
        assert errors[name].rmse == pytest.approx(math.sqrt((held**2).mean()))


def test_linear_forecast_shuffles_once(spark, tmp_path):
    path = str(tmp_path / "series")
    make(spark, {"medium": 40}).write.parquet(path)
    frame = spark.read.parquet(path)
    plan = forecast.forecast_linear(frame, crowded=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan


SCORES = [
    (0.2, 0.25, 0.002, 100, True),
    (0.1, 0.15, 0.0005, 60, True),
    (0.12, 0.18, 0.001, 60, True),
    (0.13, 0.13, 0.0, 60, True),
    (0.084, 0.12, 0.0, 40, False),
    (0.0839, 0.1199, 0.0, 28.970833, False),
    (0.06, 0.06, -0.001, 17.5, False),
    (-0.06, -0.01, 0.0, 0, False),
]


def test_score_vectors(spark):
    frame = spark.createDataFrame(
        [(float(m), float(p), float(s)) for m, p, s, _, _ in SCORES], "m DOUBLE, p DOUBLE, s DOUBLE"
    )
    score = scoring.exceedance_score(F.col("m"), F.col("p"), F.col("s"))
    rows = frame.select(score.alias("score")).withColumn("d", scoring.decision(F.col("score"))).collect()
    for row, (_, _, _, expected, positive) in zip(rows, SCORES):
        assert row.score == pytest.approx(expected, abs=1e-6)
        assert row.d == (scoring.POSITIVE_DECISION if positive else scoring.NEGATIVE_DECISION)


def test_score_rises_with_the_slope(spark):
    frame = spark.range(-200, 200).select((F.col("id") / 1e5).alias("s"))
    score = scoring.exceedance_score(F.lit(0.1), F.lit(0.13), F.col("s"))
    scores = [r[0] for r in frame.select(score).collect()]
    assert scores == sorted(scores) and 0 <= scores[0] and scores[-1] <= 100


def test_statistics_and_report(spark):
    values = [0.10, 0.12, 0.11, 0.15, 0.14]
    rows = [("a", BASE + timedelta(minutes=2 * i), i, v, True, 25) for i, v in enumerate(values)]
    frame = spark.createDataFrame(
        rows, "series_key STRING, ds TIMESTAMP, step_no INT, yhat DOUBLE, is_future BOOLEAN, n BIGINT"
    )
    frame = series.with_config(frame)
    analysis = reports.score_forecast(frame)
    row = analysis.first()
    assert row.trend == pytest.approx(0.011) and row.predictions == values
    assert row.trend_label == "Rising"
    report = reports.report_summary(analysis).first()
    assert (report.reliability, report.avg_predicted, report.trend) == (
        "limited", "0.1240", "Rising (0.011000)"
    )
    assert [r.minutes for r in reports.report_breakdown(frame).collect()] == [2]


def test_statistics_take_the_last_periods(spark):
    """Also of a longer future, as the reference frame has thirty steps."""
    rows = [("a", BASE + timedelta(minutes=2 * i), i, float(i), True) for i in range(60)]
    frame = spark.createDataFrame(
        rows, "series_key STRING, ds TIMESTAMP, step_no INT, yhat DOUBLE, is_future BOOLEAN"
    )
    row = reports.forecast_statistics(frame).first()
    assert row.avg_predicted == pytest.approx(44.5) and len(row.predictions) == 30


@pytest.mark.parametrize("model", [forecast.forecast_linear, forecast.forecast_additive])
def test_null_keys_are_one_series(spark, model):
    """The rows of a NULL key are forecast alike, however many rows a task may sort."""
    frame = make(spark, {"long": 60}).withColumn("series_key", F.lit(None).cast("string"))
    frame = frame.unionByName(make(spark, {"medium": 40}))
    one, two = (
        sorted(
            ((r.series_key or "", r.is_future, r.ds, round(r.yhat, 6)) for r in model(frame, crowded=c).collect())
        )
        for c in (False, True)
    )
    assert len(one) == 60 + 40 + 2 * 30 and one == two


@pytest.mark.parametrize("horizon,every,least", [(30, 30, 10), (5, 3, 2), (7, 20, 1)])
def test_backtest_equals_refits(spark, horizon, every, least):
    """Every origin against a model fitted anew from the rows before it."""
    df = make(spark, LENGTHS)
    rows = {}
    for r in df.orderBy("ds").collect():
        rows.setdefault(r.series_key, []).append(((r.ds - BASE).total_seconds() / STEP, r.y))
    expected = {}
    for name, points in rows.items():
        for trained in range(least, len(points), every):
            t, y = np.array(points[:trained]).T
            slope = 0.0 if trained == 1 else np.polyfit(t - t.mean(), y, 1)[0]
            ahead = np.array(points[trained : trained + horizon])
            miss = ahead[:, 1] - (y.mean() + slope * (ahead[:, 0] - t.mean()))
            expected[name, trained] = (len(ahead), abs(miss).mean(), np.sqrt((miss**2).mean()))
    out = forecast.backtest_linear(df, step=STEP, horizon=horizon, every=every, least=least).collect()
    assert {(r.series_key, r.trained) for r in out} == set(expected)
    for r in out:
        held, mae, rmse = expected[r.series_key, r.trained]
        assert r.held_out == held
        assert np.allclose((r.mae, r.rmse), (mae, rmse), rtol=1e-7, atol=1e-9)
