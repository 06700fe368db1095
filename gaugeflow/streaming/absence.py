"""Silence of a series on a live stream: reported when it begins to matter, and when it ends.

One timer per series runs on the wall clock. If nothing arrives for longer than the step,
an `open` row says since when; as soon as data resume, or where two arrivals lie further
apart than the step, a `closed` row gives the whole gap, the same as `windows.gaps`.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from gaugeflow.functions.times import micros_of

OPEN, CLOSED = "open", "closed"


def thinned(df: DataFrame, keys, time, width) -> DataFrame:
    """(keys, first, last) per key and cell of `width` microseconds, of each batch of rows that a task sees.

    Times closer than a step hold no gap between them, so a busy series sends a few rows.
    """
    rows = df.select(*keys, F.unix_micros(time).alias("t")).where("t IS NOT NULL")

    def shrink(batches):
        for batch in batches:
            cells = batch.assign(_cell=batch["t"] // width)
            spans = cells.groupby([*keys, "_cell"], dropna=False)["t"].agg(["min", "max"]).reset_index()
            yield spans.rename(columns={"min": "first", "max": "last"})[[*keys, "first", "last"]]

    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInPandas(shrink, f"{kinds}, first BIGINT, last BIGINT")


class Silence(StatefulProcessor):
    """Keeps the last arrival of a series and when the clock saw it."""

    def __init__(self, keys, width):
        self.keys, self.width = keys, width

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", "t BIGINT, seen BIGINT, told BOOLEAN")

    def row(self, key, kind, after, resumed=None):
        pause = None if resumed is None else resumed - after
        return {
            **dict(zip(self.keys, key)), "kind": kind, "gap_after": after, "resumed_at": resumed,
            "missing": None if pause is None else -(-pause // self.width) - 1,
        }

    def frame(self, rows):
        columns = [*self.keys, "kind", "gap_after", "resumed_at", "missing"]
        numbers = {c: "Int64" for c in ("gap_after", "resumed_at", "missing")}
        return pd.DataFrame(rows, columns=columns).astype(numbers)

    def handleInputRows(self, key, rows, timerValues):
        spans = sorted((int(a), int(b)) for part in rows for a, b in zip(part["first"], part["last"]))
        last = self.last.get()[0] if self.last.exists() else None
        found = []
        for first, end in spans:
            if last is not None and first - last > self.width:
                found.append(self.row(key, CLOSED, last, first))
            last = end if last is None else max(last, end)
        now = timerValues.getCurrentProcessingTimeInMs()
        self.last.update((last, now, False))
        self.handle.registerTimer(now + self.width // 1000 + 1)
        if found:
            yield self.frame(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, seen, told = self.last.get()
        if not told and timerValues.getCurrentProcessingTimeInMs() - seen > self.width // 1000:
            self.last.update((last, seen, True))
            yield self.frame([self.row(key, OPEN, last)])

    def close(self):
        pass


def live_gaps(df: DataFrame, time, step, keys) -> DataFrame:
    """Gaps of a stream: keys, kind, gap_after, resumed_at, missing (steps without a row).

    `open` rows come once per silence, `step` seconds after the clock saw the last arrival, with
    no further input, and have no end yet; `closed` rows have. The stream is in the order
    of arrival but for its micro-batches; an arrival behind one of an earlier micro-batch
    ends nothing. NULL keys are a series of their own, rows without a time are ignored.
    """
    keys, width = list(keys), micros_of(step)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, kind STRING, gap_after BIGINT, resumed_at BIGINT, missing BIGINT"
    found = thinned(df, keys, time, width).groupBy(*keys).transformWithStateInPandas(
        Silence(keys, width), schema, "update", "processingTime"
    )
    times = [F.timestamp_micros(c).alias(c) for c in ("gap_after", "resumed_at")]
    return found.select(*keys, "kind", *times, "missing")
