"""Exceedance score and decision as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and texts of the decision.
EXCEEDANCE_THRESHOLD = 0.12
DECISION_THRESHOLD = 55
POSITIVE_DECISION = "Sorry no making reels today, grab an umbrella!"
NEGATIVE_DECISION = "Make reels for the next hour, princess!!"

# Points by bound, as (share of the threshold, points) from the highest bound
# down, and the points of the threshold itself below the lowest; slopes count by value.
LEVEL_POINTS, LEVEL_BELOW = ((1.0, 40), (0.7, 25)), 20
PEAK_POINTS, PEAK_BELOW = ((1.5, 30), (1.0, 20)), 15
SLOPE_POINTS = ((0.001, 30), (0, 15))
MOST_POINTS = 100
RISING, FALLING = "Rising", "Falling"


def _number(value) -> Column:
    # Always a double: decimal literals would move the boundary cases.
    return F.lit(float(value)).cast("double")


def _steps(value: Column, bounds, otherwise: Column) -> Column:
    """The points of the first bound that the value exceeds."""
    points = otherwise
    for bound, gain in reversed(bounds):
        points = F.when(value > _number(bound), _number(gain)).otherwise(points)
    return points


def _by_threshold(value: Column, threshold, bounds, below) -> Column:
    part = value / _number(threshold) * _number(below)
    return _steps(value, [(threshold * share, gain) for share, gain in bounds], part)


def level_points(mean: Column, threshold: float) -> Column:
    return _by_threshold(mean, threshold, LEVEL_POINTS, LEVEL_BELOW)


def peak_points(peak: Column, threshold: float) -> Column:
    return _by_threshold(peak, threshold, PEAK_POINTS, PEAK_BELOW)


def trend_points(slope: Column) -> Column:
    return _steps(slope, SLOPE_POINTS, _number(0))


def exceedance_score(
    mean: Column, peak: Column, slope: Column, threshold: float = EXCEEDANCE_THRESHOLD
) -> Column:
    """0 to 100 from the forecast's mean, maximum and slope."""
    points = level_points(mean, threshold) + peak_points(peak, threshold) + trend_points(slope)
    return F.least(_number(MOST_POINTS), F.greatest(_number(0), points))


def decision(score: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return F.when(score >= _number(threshold), POSITIVE_DECISION).otherwise(NEGATIVE_DECISION)


def trend_label(slope: Column) -> Column:
    return F.when(slope > _number(0), RISING).otherwise(FALLING)
