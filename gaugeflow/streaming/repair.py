"""Late rows kept in a side table, and windows worked out again for them.

The stream closes its windows by the watermark. What comes later joins nothing there: the
sink puts it in the side table. A repair looks at the windows that late rows can touch,
reads the landed readings of these times only, joins them as a batch and replaces the
windows in the store. Run again, it finds the same windows and the same results.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.times import cell, micros_of
from gaugeflow.operators.joined_windows import joined_window_agg
from gaugeflow.operators.parsing import split_metric
from gaugeflow.operators.windows import window_documents
from gaugeflow.session import cut_lineage
from gaugeflow.sinks.writers import store_batch
from gaugeflow.streaming.one_pass import LATE, WINDOW

LATE_ROW = "obs_key STRING, t1 BIGINT, v1 DOUBLE, t2 BIGINT, v2 DOUBLE"


def closed_documents(marked: DataFrame, size_seconds, latest="obs_key", names=("avg_temperature", "avg_precipitation")):
    """Window documents out of the parts that a micro-batch of `one_pass` holds."""
    parts = marked.where(F.col("kind") == WINDOW).groupBy("window_start").agg(
        F.sum("v1").alias("_1"), F.sum("v2").alias("_2"), F.sum("record_count").alias("record_count"),
        F.max(latest).alias("avg_timestamp"),
    )
    start = F.timestamp_micros("window_start")
    end = F.timestamp_micros(F.col("window_start") + micros_of(size_seconds))
    return window_documents(
        parts.select(
            start.alias("window_start_ts"), end.alias("window_end_ts"),
            *[F.try_divide(f"_{i + 1}", "record_count").alias(name) for i, name in enumerate(names)],
            "record_count", "avg_timestamp",
        )
    )


def windows_and_late(store_sink, late_root, size_seconds=120, run=None):
    """A `foreachBatch` sink for `one_pass`: closed windows to a store, late rows to the side table."""

    def write(marked, batch_id):
        own = run or marked.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        marked.persist()
        try:
            late = marked.where(F.col("kind") == LATE).drop("kind", "window_start", "record_count")
            store_batch(late_root, late, batch_id, run=own)
            store_sink(closed_documents(marked, size_seconds), batch_id)
        finally:
            marked.unpersist()

    return write


def touched_windows(late: DataFrame, lower=-5, upper=5, size_seconds=120) -> DataFrame:
    """(window_start): the windows whose pairs a late row can belong to, in microseconds.

    A left row belongs to its own window, a right row to those of all left times it can meet.
    """
    low, high, size = micros_of(lower), micros_of(upper), micros_of(size_seconds)
    first = F.coalesce(F.col("t1"), F.col("t2") - high)
    last = F.coalesce(F.col("t1"), F.col("t2") - low)
    numbers = F.explode(F.sequence(cell(first, size), cell(last, size)))
    return late.select(numbers.alias("n")).distinct().select((F.col("n") * size).alias("window_start"))


def repaired_windows(readings: DataFrame, touched: DataFrame, lower=-5, upper=5, size_seconds=120) -> DataFrame:
    """Window documents of the `touched` windows, worked out from all readings of their times.

    Only readings within the band of a touched window are joined; the span of all touched
    windows is a filter that reaches the scan.
    """
    low, high, size = micros_of(lower), micros_of(upper), micros_of(size_seconds)
    first, last = touched.agg(F.min("window_start"), F.max("window_start")).first()
    first, last = (0, -size) if first is None else (first, last)
    span = F.col("arrival_ts").between(
        F.timestamp_micros(F.lit(first + min(low, 0))), F.timestamp_micros(F.lit(last + size + max(high, 0)))
    )
    inside = readings.where(span).withColumn("_n", cell(F.unix_micros("arrival_ts"), size))
    own = touched.select(cell(F.col("window_start"), size).alias("_n"))
    # Right rows lie in a touched window or in one that its band reaches into.
    near = F.explode(F.sequence(F.col("_n") + low // size, F.col("_n") + (size - 1 + high) // size))
    left = split_metric(inside.join(own, "_n", "left_semi"), "temperature")
    right = split_metric(inside.join(own.select(near.alias("_n")).distinct(), "_n", "left_semi"), "precipitation")
    names = ("avg_temperature", "avg_precipitation")
    windows = joined_window_agg(left, right, lower, upper, f"{size_seconds} seconds", names=names)
    return window_documents(windows)


def repair(store, late: DataFrame, readings: DataFrame, run, lower=-5, upper=5, size_seconds=120):
    """Replaces the windows that the rows of `late` touch; `run` names this repair in the store."""
    touched = cut_lineage(touched_windows(late, lower, upper, size_seconds))
    store.upsert(repaired_windows(readings, touched, lower, upper, size_seconds), 0, run)
