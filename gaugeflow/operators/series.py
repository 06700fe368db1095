"""Series preparation: clean, index, split, gate, configure, extend."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.times import MICROS, micros_of
from gaugeflow.operators.skew import largest_group, per_key_join
from gaugeflow.session import written

# Fixed values of the batch leg.
STEP_SECONDS = 120
HORIZON = 30
REGRESSOR_MIN_STD = 0.01
# Up to this many rows, one task sorts a whole series. Either way the result is the same.
GROUP_LIMIT = 2_000_000


def clean_series(
    df: DataFrame, time="window_start", target="avg_precipitation", regressor="avg_temperature",
    keys=("series_key",), keep=(),
) -> DataFrame:
    """Typed `(keys, ds, y, x)`; rows with an unreadable or missing number are dropped.

    An unreadable time is an error, a missing one drops the row.
    """
    typed = df.select(
        *keys,
        *keep,
        F.to_timestamp(time).alias("ds"),
        F.col(target).try_cast("double").alias("y"),
        F.col(regressor).try_cast("double").alias("x"),
    )
    return typed.na.drop(subset=["ds", "y", "x"])


def is_crowded(df: DataFrame, key="series_key", group_limit=GROUP_LIMIT) -> bool:
    """Whether some series has too many rows to be sorted by one task."""
    return largest_group(df, [key]) > group_limit


def series_index(
    df: DataFrame, key="series_key", time="ds", ties=(), crowded=None
) -> DataFrame:
    """Adds `idx`, the row's position in its series in time order from 0, and `n`, the series' rows.

    Series of ordinary length are sorted by one window each. If some series is
    `crowded` (counted here unless the caller knows), the rows are
    range-partitioned by (series, time) instead, and each position is its place
    in the partition plus the rows of the same series in the partitions before.
    Rows with a NULL key are a series of their own.
    """
    order = [time, *ties]
    if crowded is None:
        crowded = is_crowded(df, key)
    if not crowded:
        whole = Window.partitionBy(key)
        return df.withColumns(
            {
                "idx": (F.row_number().over(whole.orderBy(*order)) - 1).cast("long"),
                "n": F.count("*").over(whole),
            }
        )
    # Range bounds are sampled per execution, so the sorted rows are written
    # once and read twice.
    placed = written(
        df.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .withColumns({"_pid": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}),
        "series-index",
    )
    chunks = placed.groupBy(key, "_pid").agg(
        F.count("*").alias("_rows"), F.min("_pos").alias("_first")
    )
    series = Window.partitionBy(key)
    before = F.sum("_rows").over(series.orderBy("_pid")) - F.col("_rows")
    offsets = chunks.select(
        key,
        "_pid",
        (before - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(series).alias("n"),
    )
    joined = per_key_join(placed, offsets, [key, "_pid"])
    return joined.withColumn("idx", F.col("_pos") + F.col("_shift")).select(*df.columns, "idx", "n")


def with_config(df: DataFrame, n="n") -> DataFrame:
    """Adds the size-dependent settings of a series with `n` rows."""
    rows = F.col(n)

    def by_size(small, medium, large):
        return F.when(rows < 20, small).when(rows < 50, medium).otherwise(large)

    # Series of under 20, under 50, and 50 or more rows.
    ratio = by_size(F.lit(0.9), F.lit(0.85), F.lit(0.8))
    return df.withColumns(
        {
            "changepoints": by_size(F.lit(1), F.lit(2), F.lit(5)),
            "epochs": by_size(F.lit(30), F.lit(50), F.lit(100)),
            "batch_size": by_size(F.least(F.lit(8), rows), F.lit(16), F.lit(32)).cast("int"),
            "train_ratio": ratio,
            "daily": rows >= 50,
            "train_size": F.greatest(
                F.floor(rows.cast("double") * ratio), F.least(F.lit(10), rows)
            ).cast("long"),
            "reliability": F.when(rows < 20, "low").when(rows < 30, "limited").otherwise("normal"),
        }
    )


def train_split(df: DataFrame, key="series_key", time="ds", ties=(), **options) -> DataFrame:
    """`series_index` plus the settings and `is_train`, true for the leading rows."""
    indexed = with_config(series_index(df, key, time, ties, **options))
    return indexed.withColumn("is_train", F.col("idx") < F.col("train_size"))


def prepare_series(df: DataFrame, key="series_key", **columns) -> DataFrame:
    """Cleaned rows with `use_regressor`; `x` is NULL where the gate is closed.

    The deviation is an aggregate joined back, so no series is sorted for it.
    """
    cleaned = clean_series(df, keys=(key,), **columns)
    gated = regressor_gate(cleaned, key).select(key, "use_regressor")
    joined = per_key_join(cleaned, gated, [key])
    return joined.withColumn("x", F.when(F.col("use_regressor"), F.col("x")))


def regressor_gate(
    df: DataFrame, key="series_key", regressor="x", min_std=REGRESSOR_MIN_STD
) -> DataFrame:
    """Per series: sample deviation of the regressor and whether it is worth using."""
    spread = df.groupBy(key).agg(F.stddev_samp(regressor).alias("x_std"))
    return spread.withColumn("use_regressor", gate(F.col("x_std"), min_std))


def gate(std, min_std=REGRESSOR_MIN_STD):
    return F.coalesce(std > F.lit(float(min_std)), F.lit(False))


def last_values(df: DataFrame, values, key="series_key", time="ds", ties=()) -> DataFrame:
    """Latest value of each column per series. Each task sends one row per series."""
    return last_n(df, 1, key, time, ties).select(key, time, *values)


def last_n(df: DataFrame, n=HORIZON, key="series_key", time="ds", ties=()) -> DataFrame:
    """The newest `n` rows per series (`key` may be several columns). Each task keeps only its own newest `n` before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(time), *[F.desc(t) for t in ties])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def every_kth(df: DataFrame, k=5, index="step_no", step_minutes=2) -> DataFrame:
    """Rows 0, k, 2k, ... (`index` counts from 0) with the minutes from the origin."""
    position = F.col(index)
    return df.where(position % k == 0).withColumn("minutes", (position + 1) * step_minutes)


def future_frame(
    origins: DataFrame, origin="last_ds", step=STEP_SECONDS, periods=HORIZON
) -> DataFrame:
    """`periods` rows per input row: `step_no` from 0 and `ds` one step apart after the origin."""
    number = F.explode(F.sequence(F.lit(0), F.lit(periods - 1)))
    numbered = origins.withColumn("step_no", number)
    shift = (F.col("step_no") + 1).cast("long") * F.lit(micros_of(step))
    return numbered.withColumn("ds", F.timestamp_micros(F.unix_micros(origin) + shift))


def regular_series(
    df: DataFrame, key, time, value, size="1 day", regressor=None
) -> DataFrame:
    """Mean value per key and window as `(series_key, ds, y, x)`."""
    other = F.avg(regressor) if regressor else F.lit(None).cast("double")
    grouped = df.groupBy(F.col(key).cast("string").alias("series_key"), F.window(time, size).alias("_w"))
    return grouped.agg(F.avg(value).alias("y"), other.alias("x")).select(
        "series_key", F.col("_w.start").alias("ds"), "y", "x"
    )


def in_steps(time, step=STEP_SECONDS):
    """A timestamp as a number of steps since the epoch."""
    return F.unix_micros(time) / F.lit(float(step) * MICROS)
