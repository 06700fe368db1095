"""Forecast summaries: statistics, score, decision, breakdown."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import scoring
from gaugeflow.operators.forecast import SIZE_COLUMNS
from gaugeflow.operators.series import HORIZON, every_kth, last_n


def forecast_statistics(forecast: DataFrame, key="series_key", periods=HORIZON) -> DataFrame:
    """Mean, maximum and slope of each series' last `periods` predictions, and their array."""
    future = forecast.where("is_future") if "is_future" in forecast.columns else forecast
    recent = last_n(future, periods, key)
    ordered = F.array_sort(F.collect_list(F.struct("ds", "yhat")))
    return recent.groupBy(key).agg(
        F.avg("yhat").alias("avg_predicted"),
        F.max("yhat").alias("max_predicted"),
        F.coalesce(F.regr_slope("yhat", "step_no"), F.lit(0.0)).alias("trend"),
        F.transform(ordered, lambda row: row["yhat"]).alias("predictions"),
        *[F.max(c).alias(c) for c in SIZE_COLUMNS if c in forecast.columns],
    )


def score_forecast(
    forecast: DataFrame, key="series_key", threshold=scoring.EXCEEDANCE_THRESHOLD,
    decision_threshold=scoring.DECISION_THRESHOLD,
) -> DataFrame:
    """One analysis row per series: score, decision, trend label and the statistics behind them."""
    stats = forecast_statistics(forecast, key)
    score = scoring.exceedance_score(
        F.col("avg_predicted"), F.col("max_predicted"), F.col("trend"), threshold
    )
    return stats.withColumn("score", score).withColumns(
        {
            "decision": scoring.decision(F.col("score"), decision_threshold),
            "trend_label": scoring.trend_label(F.col("trend")),
        }
    )


def report_summary(analysis: DataFrame, key="series_key") -> DataFrame:
    """Formatted report row per series out of `score_forecast`."""
    return analysis.select(
        key,
        "n",
        "reliability",
        F.format_string("%.1f%%", "score").alias("probability"),
        F.format_string("%.4f", "avg_predicted").alias("avg_predicted"),
        F.format_string("%.4f", "max_predicted").alias("max_predicted"),
        F.format_string("%s (%.6f)", "trend_label", "trend").alias("trend"),
        "decision",
    )


def report_breakdown(forecast: DataFrame, key="series_key", every=5, step_minutes=2) -> DataFrame:
    """Every fifth future prediction with its distance from the origin."""
    future = forecast.where("is_future")
    return every_kth(future, every, "step_no", step_minutes).select(key, "minutes", "yhat")
