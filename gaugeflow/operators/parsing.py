"""Topic records to readings, with a dead-letter output."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import messages, times

# Metric column -> field name in the message.
METRIC_FIELDS = {"temperature": "temperature_2m", "precipitation": "precipitation"}
TIME_FIELD = "time"


def classify_messages(
    records: DataFrame, mode="strict", metrics=None, value="value", arrival="timestamp"
) -> DataFrame:
    """Parse each record and say why it is unusable (`reason`), or NULL if it is fine.

    Adds `obs_key`, `obs_ts`, `arrival_ts`, one column per metric, `raw` and
    `reason`. Reasons, first match wins: `bad_json`, `no_time`, `bad_time`,
    `no_metric`. `mode="lenient"` clamps impossible days and turns unreadable
    metrics into 0 instead of rejecting them.
    """
    metrics = metrics or METRIC_FIELDS
    raw = F.col(value).cast("string")
    document = messages.decode(raw, [TIME_FIELD, *metrics.values()])
    decoded = records.withColumn("_doc", _once(document))
    time_text = F.col("_doc")[TIME_FIELD]
    if mode == "strict":
        obs_ts = times.parse_time(time_text)
        numbers = {
            name: messages.metric_strict(F.col("_doc")[field]) for name, field in metrics.items()
        }
    elif mode == "lenient":
        obs_ts = times.parse_time_smart(time_text)
        numbers = {
            name: messages.metric_lenient(raw, field, F.col("_doc")[field])
            for name, field in metrics.items()
        }
    else:
        raise ValueError(f"unknown mode {mode!r}")

    known = set(metrics) | {"obs_key", "obs_ts", "arrival_ts", "raw", "reason", "_doc"}
    carried = [c for c in records.columns if c not in known and c not in (value, arrival)]
    reading = F.struct(
        times.minute_key(time_text).alias("obs_key"),
        obs_ts.alias("obs_ts"),
        *[number.alias(name) for name, number in numbers.items()],
        (F.col("_doc").isNull() | F.col("_doc._broken").isNotNull()).alias("_unreadable"),
    )
    parsed = decoded.select(
        *carried,
        F.col(arrival).alias("arrival_ts"),
        raw.alias("raw"),
        _once(reading).alias("_reading"),
    ).select(*carried, "arrival_ts", "_reading.*", "raw")
    reason = (
        F.when(F.col("_unreadable"), "bad_json")
        .when(F.col("obs_key").isNull(), "no_time")
        .when(F.col("obs_ts").isNull(), "bad_time")
        .when(F.coalesce(*[F.col(name) for name in metrics]).isNull(), "no_metric")
    )
    return parsed.withColumn("reason", reason).drop("_unreadable")


def _once(column):
    """The same value through a one-element generator, which keeps later filters
    from copying the expression into their own condition: it runs once per message."""
    return F.explode(F.array(column))


def parse_messages(records: DataFrame, **options):
    """(readings, dead letters). Both sides read the same classified frame."""
    classified = classify_messages(records, **options)
    readings = classified.where("reason IS NULL").drop("raw", "reason")
    dead = classified.where("reason IS NOT NULL").select("arrival_ts", "reason", "raw")
    return readings, dead


def dead_letter_counts(dead: DataFrame) -> DataFrame:
    return dead.groupBy("reason").agg(F.count("*").alias("messages"))


def split_metric(readings: DataFrame, metric: str, value="value", keep=()) -> DataFrame:
    """The single-metric stream of one metric; a reading with two metrics is in both."""
    base = [c for c in ("obs_key", "obs_ts", "arrival_ts") if c in readings.columns]
    return readings.where(F.col(metric).isNotNull()).select(
        *keep, *base, F.col(metric).alias(value)
    )


def unpivot_metrics(df: DataFrame, ids, metrics) -> DataFrame:
    """One row per id and metric."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")


def single_metric_messages(readings: DataFrame, metrics=None, time="obs_key") -> DataFrame:
    """Topic records of a wide reading: one message per metric, each metric on
    its own partition (numbered in the order given)."""
    metrics = metrics or METRIC_FIELDS
    shaped = [
        F.struct(
            messages.encode(F.col(time).alias(TIME_FIELD), F.col(name).alias(field)).alias("value"),
            F.lit(number).alias("partition"),
        )
        for number, (name, field) in enumerate(metrics.items())
    ]
    return readings.select(F.inline(F.array(*shaped)))


def readings_from_response(responses: DataFrame, body="body") -> DataFrame:
    """Readings from nested API responses (`current.*`); absent fields become NULL."""
    return responses.select(
        F.get_json_object(body, f"$.current.{TIME_FIELD}").alias("obs_key"),
        *[
            messages.nested_number(body, f"$.current.{field}").alias(name)
            for name, field in METRIC_FIELDS.items()
        ],
    )
