"""Windows on the wall clock of the job instead of an arrival column."""

import time

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from gaugeflow.operators.windows import tumbling_agg


def running_windows(df: DataFrame, metrics, size="2 minutes", keys=()) -> DataFrame:
    """Windows on the time of the micro-batch; run it in update mode.

    Each batch re-emits the open window, so the stored row is final as soon as
    its window is over, with no need for later input. Read the store through
    `latest_documents`. Partial aggregation keeps a constant key from becoming
    one task's work.
    """
    stamped = df.withColumn("_now", F.current_timestamp())
    if df.isStreaming:
        # The clock is its own watermark: a window's state goes once it is over.
        stamped = stamped.withWatermark("_now", "0 seconds")
    return tumbling_agg(stamped, "_now", metrics, size, keys)


CLOSED_SCHEMA = (
    "series_key STRING, salt INT, window_start STRING, window_end STRING, "
    "sums ARRAY<DOUBLE>, counts ARRAY<BIGINT>, record_count BIGINT, latest STRING"
)


def closed_windows(
    df: DataFrame, key, metrics, latest, size_seconds=120, salts=8, output_mode="update"
) -> DataFrame:
    """Windows emitted once, when the wall clock passes their end, also without new input.

    `metrics` are one column or several. Rows of a key are spread over `salts` states, each
    holding running sums per open window; `merge_closed` adds the parts up. A missing
    metric is left out of its sum and its count. Behind a streaming join, which appends,
    use `output_mode="append"`.
    """
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    width, count = size_seconds * 1000, len(metrics)
    spread = df.select(
        (F.col(key) if isinstance(key, str) else key).cast("string").alias("series_key"),
        F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int").alias("salt"),
        *[F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(metrics)],
        F.col(latest).cast("string").alias("latest"),
    )

    class Closer(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.open = handle.getMapState(
                "open",
                "start BIGINT",
                "sums ARRAY<DOUBLE>, counts ARRAY<BIGINT>, record_count BIGINT, latest STRING",
            )

        def handleInputRows(self, key, rows, timerValues):
            start = timerValues.getCurrentProcessingTimeInMs() // width * width
            sums, counts, total, newest = [0.0] * count, [0] * count, 0, None
            if self.open.containsKey((start,)):
                sums, counts, total, newest = self.open.getValue((start,))
                sums, counts = list(sums), list(counts)
            else:
                self.handle.registerTimer(start + width)
            for part in rows:
                total += len(part)
                for i in range(count):
                    there = part[f"m{i}"].dropna()
                    sums[i] += float(there.sum())
                    counts[i] += len(there)
                top = part["latest"].dropna()
                if len(top):
                    newest = max(filter(None, (newest, top.max())))
            self.open.updateValue((start,), (sums, counts, total, newest))
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            end = expiredTimerInfo.getExpiryTimeInMs()
            start = end - width
            if not self.open.containsKey((start,)):
                return
            sums, counts, total, newest = self.open.getValue((start,))
            self.open.removeKey((start,))
            bounds = [
                pd.Timestamp(moment, unit="ms").strftime("%Y-%m-%dT%H:%M:%S")
                for moment in (start, end)
            ]
            yield pd.DataFrame(
                {
                    "series_key": [key[0]],
                    "salt": [key[1]],
                    "window_start": [bounds[0]],
                    "window_end": [bounds[1]],
                    "sums": [list(sums)],
                    "counts": [list(counts)],
                    "record_count": [total],
                    "latest": [newest],
                }
            )

        def close(self):
            pass

    return spread.groupBy("series_key", "salt").transformWithStateInPandas(
        Closer(), CLOSED_SCHEMA, output_mode, "processingTime"
    )


def until_idle(query, poll=0.5, closed=False, seconds=1800):
    """Waits until a query with timers over bounded input has read all of it, then stops it.

    Such a query always has another batch to run, so it does not end by itself. It is done
    after a trigger without input; with `closed`, one that left no state either. An error
    if that has not happened after `seconds`.
    """
    until = time.monotonic() + seconds
    try:
        while query.isActive:
            if time.monotonic() > until:
                raise TimeoutError(f"not idle after {seconds} seconds")
            last = query.lastProgress
            if last and not last["numInputRows"]:
                if not closed or not sum(s["numRowsTotal"] for s in last["stateOperators"]):
                    break
            time.sleep(poll)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()


def until_closed(query, poll=0.5):
    """`until_idle` for `closed_windows`: every window has been closed."""
    until_idle(query, poll, closed=True)


def closed_pair_windows(pairs: DataFrame, size_seconds=120, salts=8) -> DataFrame:
    """Closed windows of joined pairs `(keys, t1, v1, t2, v2)`, all pairs as one series.

    A pair belongs to the window in which it is formed, whichever half came last.
    """
    return closed_windows(
        pairs, F.lit("all"), ["v1", "v2"], "obs_key", size_seconds, salts, "append"
    )


def merge_closed(parts: DataFrame, names=("avg_metric",)) -> DataFrame:
    """One row per key and window out of the salted parts, a mean per metric."""
    means = [
        F.try_divide(
            F.sum(F.element_at("sums", i + 1)), F.sum(F.element_at("counts", i + 1))
        ).alias(name)
        for i, name in enumerate(names)
    ]
    return parts.groupBy("series_key", "window_start", "window_end").agg(
        *means, F.sum("record_count").alias("record_count"), F.max("latest").alias("avg_timestamp")
    )
