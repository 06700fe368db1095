import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import quantiles as module
from gaugeflow.operators.quantiles import quantiles, window_quantiles

SHARES = {"low": 0.0, "q1": 0.25, "median": 0.5, "p95": 0.95, "high": 1.0}


def expected(rows, shares=SHARES):
    groups = {}
    for key, v in rows:
        if v is not None:
            groups.setdefault(key, []).append(v)
    return {k: (len(v), *(float(np.quantile(v, s)) for s in shares.values())) for k, v in groups.items()}


def got(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def agree(found, wanted):
    assert set(found) == set(wanted)
    for key, row in wanted.items():
        assert found[key][0] == row[0] and np.allclose(found[key][1:], row[1:], rtol=1e-12, atol=1e-12)


def skewed(seed, count=6000):
    """A hot group, ties, one-row groups, a null key, nulls."""
    rng = random.Random(seed)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(count)] + [("ties", float(rng.randrange(4))) for _ in range(900)]
    rows += [(None, rng.random()) for _ in range(50)] + [(f"k{i}", rng.random()) for i in range(40) for _ in range(rng.randrange(1, 4))]
    rows += [("one", 5.0), ("one", None), ("none", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("accuracy", [None, 20, 100])
def test_equal_to_sorting(spark, accuracy):
    rows = skewed(1)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    agree(got(quantiles(df, ["k"], "v", SHARES, accuracy)), expected(rows))


def test_a_hot_group_is_never_gathered(spark, monkeypatch):
    """What the ordered window sees of the hot group is the bracket."""
    rows = skewed(2, 20_000)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    seen, placed = [], module.written
    monkeypatch.setattr(module, "written", lambda frame, label: seen.append(frame) or placed(frame, label))
    agree(got(quantiles(df, ["k"], "v", {"median": 0.5}, accuracy=100)), expected(rows, {"median": 0.5}))
    plan = seen[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate", plan.index("Window"))
    low, high = df.where("k = 'hot'").agg(F.percentile_approx("v", [0.48, 0.52], 100)).first()[0]
    assert df.where((F.col("k") == "hot") & F.col("v").between(low, high)).count() < 2000


def test_a_broken_promise_is_noticed(spark):
    """Brackets too narrow for the ranks: those groups are counted whole."""
    rows = skewed(3)
    df = spark.createDataFrame(rows, "k string, v double")
    agree(got(quantiles(df, ["k"], "v", SHARES, accuracy=3, margin=0)), expected(rows))


def test_windows(spark):
    rng, base = random.Random(0), datetime(2025, 1, 1)
    rows = [(rng.choice("ab"), base + timedelta(seconds=rng.randrange(900)), rng.random()) for _ in range(3000)]
    df = spark.createDataFrame([*rows, ("a", None, 1.0)], "k string, t timestamp, v double")
    out = window_quantiles(df, "t", "v", {"median": 0.5, "p95": 0.95}, "2 minutes", ["k"])
    assert out.columns == ["k", "window_start_ts", "window_end_ts", "n", "median", "p95"]
    wanted = expected([((k, t - timedelta(seconds=(t - base).total_seconds() % 120)), v) for k, t, v in rows], {"m": 0.5, "p": 0.95})
    agree({(r.k, r.window_start_ts): (r.n, r.median, r.p95) for r in out.collect()}, wanted)


def test_nan_is_greatest_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 2.0)], "k int, v double")
    (row,) = quantiles(df, ["k"], "v", {"m": 0.5, "top": 1.0}).collect()
    assert row.m == 2.0 and row.top != row.top
    assert quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0
