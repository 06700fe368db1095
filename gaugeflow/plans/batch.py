"""The batch job: CSV export to forecast, score, decision and report."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import scoring
from gaugeflow.operators import extracts, forecast, reports, series
from gaugeflow.session import written
from gaugeflow.sources.csv_files import read_csv

MODELS = {"additive": forecast.forecast_additive, "linear": forecast.forecast_linear}


class Report(NamedTuple):
    """What the job has to say about every series."""

    forecast: DataFrame
    analysis: DataFrame
    span: DataFrame  # rows, first and last time that were read
    summary: DataFrame
    breakdown: DataFrame


def forecast_from_csv(
    spark: SparkSession,
    path,
    schema,
    key=None,
    model="additive",
    step=series.STEP_SECONDS,
    origin="last",
    threshold=scoring.EXCEEDANCE_THRESHOLD,
    encoding=None,
) -> Report:
    """Forecast and report of every series in an export of stored windows.

    `key` names the series column; an export without one is a single series. The cleaned
    rows and the forecast are written once, as several results read them.
    """
    raw = read_csv(spark, path, schema, encoding)
    raw = raw.withColumn("series_key", F.col(key).cast("string") if key else F.lit("all"))
    cleaned = written(series.clean_series(raw), "cleaned")
    future = written(MODELS[model](cleaned, step=step, origin=origin, history=False), "forecast")
    analysis = reports.score_forecast(future, threshold=threshold)
    return Report(
        future,
        analysis,
        extracts.continuity(cleaned, "ds", ["series_key"]),
        reports.report_summary(analysis),
        reports.report_breakdown(future),
    )
