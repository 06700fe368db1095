"""Regression features of the additive model as column expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trend may bend within the first 80 % of the training span,
# in at most five places.
CHANGEPOINT_RANGE = 0.8
MAX_CHANGEPOINTS = 5
DAY_MICROS = 86_400_000_000.0


def features(time, regressor, daily_order: int) -> list[Column]:
    """Intercept, slope, bends, daily waves, regressor.

    Refers to the model columns `t0`, `t_span`, `changepoints`, `daily`,
    `use_regressor`, `x_mean` and `x_std` of the row's series. Parts a series
    does not use are 0, which leaves their coefficient at 0.
    """
    micros = F.unix_micros(time)
    t = (micros - F.col("t0")) / F.col("t_span")
    bends = []
    for number in range(1, MAX_CHANGEPOINTS + 1):
        place = F.lit(CHANGEPOINT_RANGE * number) / (F.col("changepoints") + 1)
        bend = F.greatest(t - place, F.lit(0.0))
        bends.append(F.when(F.col("changepoints") >= number, bend).otherwise(0.0))
    phase = F.pmod(micros, F.lit(int(DAY_MICROS))) * F.lit(2 * math.pi / DAY_MICROS)
    waves = []
    for order in range(1, daily_order + 1):
        for wave in (F.sin(phase * order), F.cos(phase * order)):
            waves.append(F.when(F.col("daily"), wave).otherwise(0.0))
    scaled = (F.coalesce(regressor, F.col("x_mean")) - F.col("x_mean")) / F.col("x_std")
    return [F.lit(1.0), t, *bends, *waves, F.when(F.col("use_regressor"), scaled).otherwise(0.0)]


def penalties(daily_order: int, trend_reg: float) -> list[float]:
    """Ridge weight per feature; the bends carry the trend regularisation."""
    return [1e-9, 1e-6, *[trend_reg] * MAX_CHANGEPOINTS, *[1e-2] * (2 * daily_order), 1e-6]
