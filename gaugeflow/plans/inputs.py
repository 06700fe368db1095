"""The test tables as the pipeline's inputs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.times import minute_text, second_text
from gaugeflow.operators.series import regular_series
from gaugeflow.session import use_utc

DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir) -> DataFrame:
    """Events with a zoned arrival time, which watermarks and epoch functions need."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def hour_key(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH")


def broken_messages(spark, sf_dir) -> DataFrame:
    """Every event as a topic record, in one of eight shapes, five of them defective."""
    minute, second = minute_text("ts"), second_text("ts")
    number = F.col("value").cast("string")

    def text(*parts):
        return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])

    shapes = [
        text('{"time":"', minute, '","temperature_2m":', number, "}"),
        text('{"time":"', second, '","precipitation":', number, "}"),
        text('{"time":"', minute, '","temperature_2m":null}'),
        text('{"temperature_2m":', number, "}"),
        text('{"time":"', minute, '","temperature_2m":'),
        text('{"time":"', second, '.5","precipitation":', number, "}"),
        text('{"time":"', minute, '","temperature_2m":"', number, '"}'),
        text('{"time":"', minute, '","precipitation":true}'),
    ]
    value = F.lit(None).cast("string")
    for number_, shape in enumerate(shapes):
        value = F.when(F.col("event_id") % 8 == number_, shape).otherwise(value)
    return events(spark, sf_dir).select(
        "event_id", value.alias("value"), F.col("ts").alias("timestamp")
    )


def metric_messages(spark, sf_dir) -> DataFrame:
    """Clicks as temperature messages and views as precipitation messages."""
    field = F.when(F.col("event_type") == "click", "temperature_2m").otherwise("precipitation")
    start, colon = F.lit('{"time":"'), F.lit('":')
    head = F.concat(start, minute_text("ts"), F.lit('","'), field, colon)
    return (
        events(spark, sf_dir)
        .where(F.col("event_type").isin("click", "view"))
        .select(
            F.concat(head, F.col("value").cast("string"), F.lit("}")).alias("value"),
            (F.col("event_type") == "view").cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("timestamp"),
        )
    )


def user_days(spark, sf_dir) -> DataFrame:
    """Daily mean value per user, with the daily mean of the `k` property as regressor."""
    prepared = events(spark, sf_dir).withColumn(
        "k", F.get_json_object("props", "$.k").try_cast("double")
    )
    return regular_series(prepared, "user_id", "ts", "value", "1 day", "k")


def type_hours(spark, sf_dir) -> DataFrame:
    """Hourly mean value per event type, long enough for daily waves and all bends."""
    prepared = events(spark, sf_dir).withColumn(
        "k", F.get_json_object("props", "$.k").try_cast("double")
    )
    return regular_series(prepared, "event_type", "ts", "value", "1 hour", "k")


def with_nulls(spark, sf_dir) -> DataFrame:
    """Events of an hour key with NULL keys, NULL values and a NULL type here and there."""
    number = F.col("event_id")
    return events(spark, sf_dir).select(
        "event_id",
        "event_type",
        F.when(number % 5 != 0, hour_key("ts")).alias("obs_key"),
        F.col("ts").alias("arrival_ts"),
        F.when(number % 7 != 0, F.col("value")).alias("value"),
        F.when(number % 3 != 0, F.col("event_type")).alias("series_key"),
    )
