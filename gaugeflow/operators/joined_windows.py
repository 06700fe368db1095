"""Window means over interval-joined streams without forming the pairs.

A join followed by a window mean needs work in proportion to the number of
pairs, which grows with the square of the arrival rate. The mean only needs,
for each left row, how many right rows its band holds and what they sum to.
Time is cut into cells as long as the band, so a band is the end of one cell and
the beginning of the next: two running sums, one backwards, one forwards. Nothing
is subtracted, so values outside a band cannot touch its sum. The pairs never
exist: the work is one sort of the distinct arrival instants. Over streams a stateful
operator does the same with what each micro-batch brings (`one_pass.window_means`).
"""

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.times import cell, micros_of
from gaugeflow.operators.joins import paired_readings
from gaugeflow.operators.windows import tumbling_agg
from gaugeflow.streaming import one_pass

_MARK, _POINT, _PROBE = -1, 0, 1
_COUNTS = ("_rows2", "_values2", "_sum2")
# Rows of a cell that one task sorts; more are sorted in slices. The result is the same.
ROWS_PER_SLICE = 1_000_000
MAX_SLICES = 16_384


def joined_window_agg(
    left: DataFrame,
    right: DataFrame,
    lower=-5,
    upper=5,
    size="2 minutes",
    keys=("obs_key",),
    names=("avg_v1", "avg_v2"),
    method="sums",
    slices=None,
    max_delay=None,
    salts="auto",
) -> DataFrame:
    """Same result as `paired_readings` followed by `tumbling_agg` on the left arrival time.

    Inputs are single-metric frames `(keys, arrival_ts, value)`. Rows with a NULL key
    or time pair with nothing; a NULL value counts as a row but not in the mean; NaN and
    infinities spread over the windows of their pairs only. `method="pairs"` forms the
    pairs instead. `slices` per cell are chosen by the busiest cell unless given. Streams
    need `max_delay`, the allowed delay, and take a number for `salts` to cut every key in
    (1 otherwise); "pairs" takes both as `interval_join` does.
    """
    keys = list(keys)
    streaming = left.isStreaming or right.isStreaming
    if streaming and max_delay is None:
        raise ValueError("a streaming interval join needs max_delay")
    if method == "pairs":
        joined = paired_readings(left, right, lower, upper, max_delay, salts, keys=keys)
        metrics = {names[0]: "v1", names[1]: "v2"}
        return tumbling_agg(joined, "t1", metrics, size, latest=keys[0])
    if streaming:
        seconds = pd.Timedelta(size).total_seconds()
        return one_pass.window_means(
            left, right, keys, "arrival_ts", lower, upper, max_delay, seconds, names, 1 if salts == "auto" else salts
        )
    left, right = (side.na.drop(subset=[*keys, "arrival_ts"]) for side in (left, right))
    low, high = micros_of(lower), micros_of(upper)
    width = high - low + 1

    # Aggregating before the shuffle also merges groups of equal arrival times.
    ones = left.groupBy(*keys, F.unix_micros("arrival_ts").alias("_t")).agg(
        F.count("*").alias("_rows1"), F.count("value").alias("_values1"), F.sum("value").alias("_sum1")
    )
    twos = right.groupBy(*keys, F.unix_micros("arrival_ts").alias("_at")).agg(
        F.count("*").alias("_rows2"), F.count("value").alias("_values2"), F.sum("value").alias("_sum2")
    )
    if slices is None:
        slices = min(-(-_busiest_cell(left, right, keys, width) // ROWS_PER_SLICE), MAX_SLICES)
    rows = _both_directions(ones, twos, keys, low, high, width)
    seen = _sliced_sums(rows, keys, width, slices) if slices > 1 else _cell_sums(rows, keys)
    return _window_means(seen.where(F.col("_t").isNotNull()), keys, size, names)


def _busiest_cell(left, right, keys, width):
    cells = left.select(*keys, "arrival_ts").unionByName(right.select(*keys, "arrival_ts"))
    counted = cells.groupBy(*keys, cell(F.unix_micros("arrival_ts"), width).alias("_c")).count()
    return counted.agg(F.max("count")).first()[0] or 0


def _both_directions(ones, twos, keys, low, high, width):
    """Points and probes by `_pos`, forwards (`_way` 1) and backwards (-1, times negated).

    A probe is to see the points of its cell up to its own position. Backwards it stands at
    the start of the band, forwards at the end, unless the band is exactly one cell.
    """
    at = F.col("_at")
    points = twos.select(
        *keys,
        F.lit(_POINT).alias("_kind"),
        cell(at, width).alias("_cell"),
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("_way"), at.alias("_pos")),
                F.struct(F.lit(-1).alias("_way"), (-at).alias("_pos")),
            )
        ),
        *_COUNTS,
    )
    start, end = F.col("_t") + low, F.col("_t") + high
    backwards = F.struct(
        F.lit(-1).alias("_way"), (-start).alias("_pos"), cell(start, width).alias("_cell")
    )
    forwards = F.struct(F.lit(1).alias("_way"), end.alias("_pos"), cell(end, width).alias("_cell"))
    one_cell = cell(start, width) == cell(end, width)
    probes = ones.select(
        *keys,
        F.lit(_PROBE).alias("_kind"),
        F.inline(F.when(one_cell, F.array(backwards)).otherwise(F.array(backwards, forwards))),
        "_t",
        "_rows1",
        "_values1",
        "_sum1",
    )
    return points.unionByName(probes, allowMissingColumns=True)


def _window_means(seen, keys, size, names):
    """Sums over the pairs of each window out of what every probe has seen."""
    met = F.col("_seen_rows2") > 0

    def over_pairs(*factors):
        product = factors[0] * factors[1]
        return F.coalesce(F.sum(F.when(met, product)), F.lit(0))

    rows1, rows2 = F.col("_rows1"), F.col("_seen_rows2")
    per_key = (
        seen.groupBy(*keys, F.window(F.timestamp_micros("_t"), size).alias("_window"))
        .agg(
            over_pairs(rows1, rows2).alias("_pairs"),
            over_pairs(F.col("_values1"), rows2).alias("_count1"),
            over_pairs(F.coalesce("_sum1", F.lit(0.0)), rows2).alias("_total1"),
            over_pairs(rows1, F.col("_seen_values2")).alias("_count2"),
            over_pairs(rows1, F.col("_seen_sum2")).alias("_total2"),
        )
        .where("_pairs > 0")
    )
    means = [
        F.try_divide(F.sum(f"_total{n}"), F.sum(f"_count{n}")).alias(name)
        for n, name in enumerate(names, 1)
    ]
    return (
        per_key.groupBy("_window")
        .agg(*means, F.sum("_pairs").alias("record_count"), F.max(keys[0]).alias("avg_timestamp"))
        .select(
            F.col("_window.start").alias("window_start_ts"),
            F.col("_window.end").alias("window_end_ts"),
            *names,
            "record_count",
            "avg_timestamp",
        )
    )


def _running(rows, partition):
    """Adds the sums of the points up to each row (`_seen...`)."""
    upto = Window.partitionBy(*partition).orderBy("_pos", "_kind")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns(
        {f"_seen{c}": F.coalesce(F.sum(c).over(upto), F.lit(0)) for c in _COUNTS}
    )


def _cell_sums(rows, keys):
    return _running(rows, [*keys, "_way", "_cell"])


def _sliced_sums(rows, keys, width, slices):
    """`_cell_sums` with every cell sorted in slices, so a crowded cell is many tasks.

    Each slice begins with a mark row that holds the sums of the slices before it in the
    cell. Equal instants are merged already, so a slice has at most a few rows per
    microsecond, however many came in.
    """
    slice_width = max(width // slices, 1_000)
    whole = [*keys, "_way", "_cell"]
    rows = rows.withColumn("_slice", cell(F.col("_pos"), slice_width))
    totals = rows.groupBy(*whole, "_slice").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]
    )
    earlier = Window.partitionBy(*whole).orderBy("_slice")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    marks = totals.select(
        *whole,
        "_slice",
        (F.col("_slice") * slice_width).alias("_pos"),
        F.lit(_MARK).alias("_kind"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in _COUNTS],
    )
    return _running(rows.unionByName(marks, allowMissingColumns=True), [*whole, "_slice"])
