"""Keyed interval join of two metric streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.times import cell, micros_of
from gaugeflow.operators.skew import salt

HOT_CELL_ROWS = 10_000
STREAM_SALTS = 8


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys,
    left_time="t1",
    right_time="t2",
    lower=-5,
    upper=5,
    max_delay=None,
    salts="auto",
) -> DataFrame:
    """Every pair with equal `keys` and `right_time - left_time` in [lower, upper] seconds.

    Inner, many-to-many, both bounds inclusive. Works on batch and streaming
    frames; for streaming ones `max_delay` (e.g. "10 minutes") sets the
    watermark on both sides, which is what lets join state expire.

    The band is also a join key: time is cut into cells twice as long as the
    band, each right row lies in one cell and each left row is copied to the
    one or two cells its band touches. A right row has one cell, so no pair
    appears twice, and a hot key is spread over as many tasks as it has cells.
    Crowded cells are split further: batch joins count both sides per cell and
    cut each side into parts of HOT_CELL_ROWS. Streams cut the left side of every
    cell into STREAM_SALTS parts, since a stream's current traffic lies in few cells.
    A number for `salts` is used for every cell instead (1 for none). NULL keys
    and times pair with nothing.
    """
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    streaming = left.isStreaming or right.isStreaming
    if streaming:
        if max_delay is None:
            raise ValueError("a streaming interval join needs max_delay")
        left = left.withWatermark(left_time, max_delay)
        right = right.withWatermark(right_time, max_delay)

    low, high = micros_of(lower), micros_of(upper)
    width = max(2 * (high - low), 1_000_000)
    at = F.unix_micros(left_time)
    touched = F.explode(F.sequence(cell(at + low, width), cell(at + high, width)))
    join_keys = [*keys, "_cell"]
    left_columns, right_columns = left.columns, right.columns
    crowds = None
    if salts == "auto" and not streaming:
        crowds = _crowded_cells(
            left.select(*keys, touched.alias("_cell")),
            right.select(*keys, cell(F.unix_micros(right_time), width).alias("_cell")),
            join_keys,
        )
    left = left.withColumn("_cell", touched)
    right = right.withColumn("_cell", cell(F.unix_micros(right_time), width))
    if crowds is not None:
        left, right = salt(left, right, join_keys, left_columns, right_columns, crowds)
        join_keys += ["_salt1", "_salt2"]
    else:
        salts = STREAM_SALTS if salts == "auto" else salts
        if salts > 1:
            spread = F.pmod(F.xxhash64(*left_columns), F.lit(salts)).cast("int")
            left = left.withColumn("_salt1", spread)
            right = right.withColumn("_salt1", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            join_keys.append("_salt1")

    left, right = left.alias("_l"), right.alias("_r")
    band = F.expr(
        f"_r.`{right_time}` >= _l.`{left_time}` + make_dt_interval(0, 0, 0, {low / 1e6:.6f}BD) AND "
        f"_r.`{right_time}` <= _l.`{left_time}` + make_dt_interval(0, 0, 0, {high / 1e6:.6f}BD)"
    )
    condition = band
    for key in join_keys:
        condition = condition & (F.col(f"_l.{key}") == F.col(f"_r.{key}"))
    hidden = ("_cell", "_salt1", "_salt2")
    return left.join(right, condition, "inner").select(
        *[F.col(f"_l.{c}").alias(c) for c in left.columns if c not in hidden],
        *[F.col(f"_r.{c}").alias(c) for c in right.columns if c not in (*hidden, *keys)],
    )


def _crowded_cells(left, right, keys):
    """Cells with more than HOT_CELL_ROWS rows on a side, and the parts to cut each side into."""
    one, two = F.lit(1).alias("_1"), F.lit(0).alias("_2")
    both = left.select(*keys, one, two).unionByName(
        right.select(*keys, F.lit(0).alias("_1"), F.lit(1).alias("_2"))
    )
    counted = both.groupBy(*keys).agg(F.sum("_1").alias("_1"), F.sum("_2").alias("_2"))
    # A cell without partners on one side needs no care.
    counted = counted.where("_1 > 0 AND _2 > 0")

    def parts(rows):
        return F.ceil(F.col(rows) / HOT_CELL_ROWS).cast("int")

    crowds = counted.select(*keys, parts("_1").alias("_salts1"), parts("_2").alias("_salts2"))
    return crowds.where("_salts1 > 1 OR _salts2 > 1")


def paired_readings(
    left: DataFrame, right: DataFrame, lower=-5, upper=5, max_delay=None, salts="auto",
    keys=("obs_key",),
) -> DataFrame:
    """Interval join of two single-metric streams.

    Takes `(obs_key, obs_ts, arrival_ts, value)` frames and gives `(keys, obs_ts,
    t1, v1, t2, v2)`: key and observation time are the left side's.
    """
    keys = list(keys)
    extra = ["obs_ts"] if "obs_ts" in left.columns else []
    one = left.select(*keys, *extra, F.col("arrival_ts").alias("t1"), F.col("value").alias("v1"))
    two = right.select(*keys, F.col("arrival_ts").alias("t2"), F.col("value").alias("v2"))
    return interval_join(one, two, keys, "t1", "t2", lower, upper, max_delay, salts)
