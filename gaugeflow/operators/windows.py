"""Tumbling windows, stored-window documents and gaps."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.times import cell, mean_of_sums, micros_of, second_text, time_sums


def tumbling_agg(
    df: DataFrame,
    time,
    metrics,
    size="2 minutes",
    keys=(),
    latest=None,
    mean_of=None,
) -> DataFrame:
    """Mean of each metric and the row count per epoch-aligned window.

    `metrics` maps output name to column. `latest` names a text column whose
    maximum becomes `avg_timestamp`; `mean_of` a timestamp whose mean becomes
    `mean_obs`. Windows are closed at the start and open at the end. Without
    `keys` there is one group per window; partial aggregation runs before the
    shuffle, so that group is never collected. The count is a long: an int
    would overflow in a busy window.
    """
    window = F.window(time, size).alias("_window")
    sums = {"_rows": F.count("*")}
    for number, column in enumerate(metrics.values()):
        sums[f"_sum{number}"] = F.sum(column)
        sums[f"_count{number}"] = F.count(column)
    if mean_of:
        sums |= time_sums(mean_of)
    if latest and not df.isStreaming:
        # A maximum of text cannot be kept in a hash table and would sort every
        # row; as a grouping key it leaves a few rows per window to sort.
        parts = df.groupBy(*keys, window, F.col(latest).alias("_latest")).agg(
            *[term.alias(name) for name, term in sums.items()]
        )
        grouped = parts.groupBy(*keys, "_window").agg(
            *[F.sum(name).alias(name) for name in sums], F.max("_latest").alias("_latest")
        )
    else:
        newest = [F.max(latest).alias("_latest")] if latest else []
        grouped = df.groupBy(*keys, window).agg(
            *[term.alias(name) for name, term in sums.items()], *newest
        )
    results = [
        F.try_divide(f"_sum{number}", f"_count{number}").alias(name)
        for number, name in enumerate(metrics)
    ]
    results.append(F.col("_rows").alias("record_count"))
    if latest:
        results.append(F.col("_latest").alias("avg_timestamp"))
    if mean_of:
        mean = mean_of_sums(F.col("_high"), F.col("_low"), F.col("_times"))
        results.append(mean.alias("mean_obs"))
    return grouped.select(
        *keys,
        F.col("_window.start").alias("window_start_ts"),
        F.col("_window.end").alias("window_end_ts"),
        *results,
    )


def bounds_as_text(windows: DataFrame) -> DataFrame:
    """Replace the typed bounds by their second-precision text."""
    others = [c for c in windows.columns if c not in ("window_start_ts", "window_end_ts")]
    return windows.select(
        second_text("window_start_ts").alias("window_start"),
        second_text("window_end_ts").alias("window_end"),
        *others,
    )


def window_documents(windows: DataFrame) -> DataFrame:
    """The stored form: text bounds, processing time, typed start and its date."""
    hidden = ("window_start_ts", "window_end_ts")
    return windows.select(
        second_text("window_start_ts").alias("window_start"),
        second_text("window_end_ts").alias("window_end"),
        *[c for c in windows.columns if c not in hidden],
        F.current_timestamp().alias("processed_at"),
        "window_start_ts",
        F.to_date("window_start_ts").alias("window_date"),
    )


def gaps(df: DataFrame, time, step, keys=()) -> DataFrame:
    """Pauses longer than `step` seconds: last time before, first time after, windows missed.

    Times closer than one step cannot hold a gap, so each key is first reduced
    to the earliest and latest time per step-sized cell. What the ordered
    window sees is bounded by the time span over the step, not by the rows.
    """
    width = micros_of(step)
    keys = list(keys)
    micros = F.unix_micros(time)
    cells = df.groupBy(*keys, cell(micros, width).alias("_cell")).agg(
        F.min(micros).alias("_first"), F.max(micros).alias("_last")
    )
    order = Window.partitionBy(*keys).orderBy("_cell")
    paused = cells.withColumn("_before", F.lag("_last").over(order)).withColumn(
        "_pause", F.col("_first") - F.col("_before")
    )
    missed = F.ceil(F.col("_pause") / width) - 1
    return paused.where(F.col("_pause") > width).select(
        *keys,
        F.timestamp_micros("_before").alias("gap_after"),
        F.timestamp_micros("_first").alias("resumed_at"),
        missed.cast("long").alias("missing"),
    )
