"""Score and decision of every series on a stream, from its newest values.

A series' state is a ring of its newest values in time order; mean, maximum and slope come
from it after every micro-batch, and the score from these by the same expressions as in
the batch reports. Each task sends at most a ring per series, so a busy one stays small.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from gaugeflow.functions import scoring
from gaugeflow.operators.series import HORIZON


def newest(frame, keys, size):
    """The newest rows of each series, `t` and then `tie` being the order."""
    ordered = frame.sort_values(["t", "tie"], kind="stable")
    return ordered.groupby(keys, dropna=False, sort=False).tail(size)


class Ring(StatefulProcessor):
    """The newest `size` values of a series, and their statistics after each micro-batch."""

    def __init__(self, keys, size):
        self.keys, self.size = keys, size

    def init(self, handle):
        self.ring = handle.getValueState("ring", "t ARRAY<BIGINT>, tie ARRAY<BIGINT>, y ARRAY<DOUBLE>")

    def handleInputRows(self, key, rows, timerValues):
        parts = [part[["t", "tie", "y"]] for part in rows]
        if self.ring.exists():
            parts.insert(0, pd.DataFrame(dict(zip(("t", "tie", "y"), map(list, self.ring.get())))))
        ring = pd.concat(parts, ignore_index=True).sort_values(["t", "tie"], kind="stable").tail(self.size)
        self.ring.update(tuple(ring[c].tolist() for c in ("t", "tie", "y")))
        y = ring["y"].to_numpy()
        place = np.arange(len(y)) - (len(y) - 1) / 2
        spread = float((place**2).sum())
        yield pd.DataFrame({
            **{name: [value] for name, value in zip(self.keys, key)},
            "newest_at": [int(ring["t"].iloc[-1])], "n": [len(y)], "mean": [float(y.mean())], "peak": [float(y.max())],
            "trend": [float((place * (y - y.mean())).sum() / spread) if spread else 0.0],
        })

    def close(self):
        pass


def live_scores(
    df: DataFrame, keys, time, value, tie=None, size=HORIZON, threshold=scoring.EXCEEDANCE_THRESHOLD,
    decision_threshold=scoring.DECISION_THRESHOLD,
) -> DataFrame:
    """One row per series that a micro-batch touched: keys, newest_at, n, mean, peak, trend, score, decision.

    They describe the newest `size` values so far, in the order of `time` and the whole
    number `tie`; rows that arrive late enough to be older than these change nothing.
    Rows without a time or value are ignored, NULL keys are a series of their own. Run it
    in update mode and keep the newest row of a series (`KeyedStore`).
    """
    keys = list(keys)
    kinds = {k: df.schema[k].dataType.simpleString() for k in keys}
    key_schema = ", ".join(f"`{k}` {kind}" for k, kind in kinds.items())
    rows = df.select(
        *keys, F.unix_micros(time).alias("t"), (F.col(tie) if tie else F.lit(0)).cast("long").alias("tie"),
        F.col(value).cast("double").alias("y"),
    ).dropna(subset=["t", "y"])

    def trim(batches):
        for batch in batches:
            yield newest(batch, keys, size)

    trimmed = rows.mapInPandas(trim, rows.schema)
    schema = f"{key_schema}, newest_at BIGINT, n INT, mean DOUBLE, peak DOUBLE, trend DOUBLE"
    stats = trimmed.groupBy(*keys).transformWithStateInPandas(Ring(keys, size), schema, "update", "none")
    score = scoring.exceedance_score(F.col("mean"), F.col("peak"), F.col("trend"), threshold)
    return stats.withColumn("newest_at", F.timestamp_micros("newest_at")).withColumn("score", score).withColumn(
        "decision", scoring.decision(F.col("score"), decision_threshold)
    )
