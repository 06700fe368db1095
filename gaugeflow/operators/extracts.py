"""Queries over stored windows: dimension means, latest rows, time ranges, continuity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_means(df: DataFrame, by, metrics) -> DataFrame:
    """Mean of each metric (cast to double, unreadable text is an error) and rows per group."""
    means = [F.avg(F.col(column).cast("double")).alias(name) for name, column in metrics.items()]
    return df.groupBy(*by).agg(*means, F.count("*").alias("record_count"))


def latest(df: DataFrame, time, k=10, ties=()) -> DataFrame:
    """The `k` newest rows; `ties` make the choice unique."""
    return df.orderBy(F.desc(time), *[F.desc(t) for t in ties]).limit(k)


def text_range(df: DataFrame, text, low, high) -> DataFrame:
    """Rows whose ISO time text lies in [low, high].

    The cast hides the column from the scan's filters; where a typed column
    exists, `typed_range` reads less.
    """
    moment = F.replace(F.col(text), F.lit("T"), F.lit(" ")).cast("timestamp")
    return df.where(moment.between(F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")))


def typed_range(df: DataFrame, time, low, high) -> DataFrame:
    """Same rows as `text_range` over the minute text of `time`, as a pushable predicate.

    The minute text of a time is at most `high` exactly if the time is before
    the following minute.
    """
    kind = df.schema[time].dataType.simpleString()
    start = F.date_trunc("minute", F.lit(low).cast("timestamp"))
    on_minute = F.lit(low).cast("timestamp") == start
    first = F.when(on_minute, start).otherwise(start + F.expr("INTERVAL 1 MINUTE"))
    after = F.date_trunc("minute", F.lit(high).cast("timestamp")) + F.expr("INTERVAL 1 MINUTE")
    return df.where((F.col(time) >= first.cast(kind)) & (F.col(time) < after.cast(kind)))


def continuity(df: DataFrame, time, by=()) -> DataFrame:
    """Row count, earliest and latest time."""
    return df.groupBy(*by).agg(
        F.count("*").alias("total_records"),
        F.min(time).alias("earliest_record"),
        F.max(time).alias("latest_record"),
    )
