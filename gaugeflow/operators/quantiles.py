"""Exact order statistics per group and window, without gathering a group.

Each task summarises its values (a mergeable quantile sketch with a known rank error);
from the merged summary come two values that bracket the wanted rank. One further pass
counts what lies below the bracket, and each different value inside it; a position among
these counts is the exact result. What a task sees of a group is the bracket, a few
multiples of the sketch's error, however large the group is.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.operators.skew import per_key_join
from gaugeflow.session import written

# Rank error of the sketch is one in ACCURACY of a group's rows, less for groups above ROWS.
ACCURACY, ROWS = 10_000, 1_000_000_000
# The bracket reaches this many rank errors to either side.
MARGIN = 2


def window_quantiles(df: DataFrame, time, value, shares, size="2 minutes", keys=()) -> DataFrame:
    """Exact quantiles of `value` per key and epoch-aligned window, with the values' number.

    `shares` maps output names to shares from 0 to 1 (0.5 is the median), interpolated
    between neighbours. NULL values do not count, a window of only such has no row; NaN is
    greater than any number; rows without a time are dropped.
    """
    window = F.window(time, size)
    rows = df.select(*keys, window.start.alias("window_start_ts"), window.end.alias("window_end_ts"), F.col(value).alias("_v"))
    return quantiles(rows, [*keys, "window_start_ts", "window_end_ts"], "_v", shares)


def quantiles(df: DataFrame, keys, value, shares, accuracy=None, margin=MARGIN) -> DataFrame:
    """Exact quantiles of `value` per group of `keys`; one row per group with a value."""
    keys, names = list(keys), list(shares)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    if accuracy is None:
        largest = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        accuracy = ACCURACY * max(1, -(-largest // ROWS))
    bounds = [b for s in shares.values() for b in (max(0.0, s - margin / accuracy), min(1.0, s + margin / accuracy))]
    sketch = F.percentile_approx("_v", bounds, accuracy)
    groups = written(rows.groupBy(*keys).agg(F.count("*").alias("_n"), sketch.alias("_b")), "quantile-brackets")
    brackets = [
        F.struct(F.lit(i).alias("i"), F.col("_b")[2 * i].alias("low"), F.col("_b")[2 * i + 1].alias("high"))
        for i in range(len(names))
    ]
    found = _placed(rows, groups, keys, brackets, shares)
    found = written(found, "quantile-places")
    # The sketch keeps its promise; should a rank lie outside, its groups are counted whole.
    missed = found.groupBy(*keys).agg(F.min("_inside").alias("_ok")).where("NOT _ok").select(*keys)
    if not missed.isEmpty():
        whole = [F.struct(F.lit(i).alias("i"), F.lit(float("-inf")).alias("low"), F.lit(float("nan")).alias("high"))
                 for i in range(len(names))]
        again = _placed(rows, per_key_join(groups, missed, keys), keys, whole, shares)
        found = found.where("_inside").unionByName(again).dropDuplicates([*keys, "_i"])
    wide = [F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(name) for i, name in enumerate(names)]
    return found.groupBy(*keys).agg(F.first("_n").alias("n"), *wide)


def _placed(rows, groups, keys, brackets, shares) -> DataFrame:
    """(keys, _i, _n, _q, _inside): the interpolated value at each share's rank."""
    joined = per_key_join(rows, groups.select(*keys, F.array(*brackets).alias("_brackets")), keys)
    # Everything below a bracket is one entry without a value, so tasks add it up first.
    each = joined.select(*keys, "_v", F.explode("_brackets").alias("b")).where("_v <= b.high")
    inside = F.when(F.col("_v") >= F.col("b.low"), F.col("_v"))
    counts = each.groupBy(*keys, F.col("b.i").alias("_i"), inside.alias("_v")).agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*keys, "_i").orderBy(F.col("_v").asc_nulls_first())
    running = counts.withColumn("_upto", F.sum("_c").over(order))
    ranked = per_key_join(running, groups.select(*keys, "_n"), keys)
    share = F.element_at(F.array(*[F.lit(float(s)) for s in shares.values()]), F.col("_i") + 1)
    rank = (F.col("_n") - 1) * share
    at = [F.min_by("_v", F.when(F.col("_v").isNotNull() & (F.col("_upto") > edge(rank)), F.col("_upto"))) for edge in (F.floor, F.ceil)]
    below = F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_c"))), F.lit(0))
    picked = ranked.withColumn("_rank", rank).groupBy(*keys, "_i", "_n", "_rank").agg(
        at[0].alias("_lower"), at[1].alias("_upper"), below.alias("_below"), F.max("_upto").alias("_all")
    )
    part = F.col("_rank") - F.floor("_rank")
    value = F.when(part == 0, F.col("_lower")).otherwise(F.col("_lower") + (F.col("_upper") - F.col("_lower")) * part)
    fits = (F.col("_below") <= F.floor("_rank")) & (F.col("_all") > F.ceil("_rank"))
    return picked.select(*keys, "_i", "_n", value.alias("_q"), fits.alias("_inside"))
