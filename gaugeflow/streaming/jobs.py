"""The streaming job: records, readings, interval join, windows, sinks."""

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from gaugeflow.functions.times import minute_text
from gaugeflow.operators.joined_windows import joined_window_agg
from gaugeflow.operators.parsing import parse_messages, split_metric
from gaugeflow.operators.windows import window_documents
from gaugeflow.session import use_utc
from gaugeflow.sinks.writers import fan_out

# Fixed value: the checkpoint interval.
TRIGGER = "60 seconds"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def state_session(spark: SparkSession, partitions=None) -> SparkSession:
    """A session of the same application for stateful queries.

    The number of state partitions is fixed for the life of a checkpoint, so it is chosen
    up front: given, or as many as the application has cores, 8 at least. Every trigger
    commits each of them, so they follow the throughput, not the size of the history.
    State lives in RocksDB, off the heap, one store per partition for both join sides, and
    each micro-batch uploads only what changed.
    """
    session = use_utc(spark.newSession())
    partitions = partitions or max(8, spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    for key, value in STATE_SETTINGS.items():
        session.conf.set(key, value)
    return session


def message_windows(
    records: DataFrame, max_delay="10 minutes", lower=-5, upper=5, size="2 minutes", mode="strict",
    salts="auto",
) -> DataFrame:
    """Window documents of a topic carrying temperature and precipitation messages.

    Over a stream the pairs are never formed; `salts` cuts the traffic of one minute into as
    many state keys (see `joined_window_agg`).
    """
    readings, _ = parse_messages(records, mode=mode)
    windows = joined_window_agg(
        split_metric(readings, "temperature"),
        split_metric(readings, "precipitation"),
        lower,
        upper,
        size,
        names=("avg_temperature", "avg_precipitation"),
        method="sums" if records.isStreaming else "pairs",
        max_delay=max_delay if records.isStreaming else None,
        salts=salts,
    )
    return window_documents(windows)


def dead_letters(records: DataFrame, mode="strict") -> DataFrame:
    return parse_messages(records, mode=mode)[1]


def observed_pairs(pairs: DataFrame, name="pairs") -> DataFrame:
    """The joined stream with running counts for a query listener, in place of a line per pair."""
    return pairs.observe(
        name, F.count("*").alias("rows"), F.avg("v1").alias("v1"), F.avg("v2").alias("v2")
    )


def start(windows: DataFrame, sinks, checkpoint, trigger=None, output_mode="append"):
    """Start a query that feeds every sink once per closed window."""
    writer = (
        windows.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(fan_out(sinks))
    )
    return writer.trigger(**(trigger or {"processingTime": TRIGGER})).start()


def heartbeat(spark: SparkSession, path: str, schema, **values) -> None:
    """Write one record with a far later time into `path`, a folder the query also reads.

    Append mode holds a window back until the watermark passes it. A bounded
    replay is run once over its data and once more after the heartbeat; its checkpoint is
    finished then, as any further record would be late. Give the heartbeat a folder of its
    own, so that nobody else reads it as data.
    """
    columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*columns).coalesce(1).write.mode("append").parquet(path)


def replay(windows: DataFrame, sinks, checkpoint, heartbeat_writer=None):
    """Run a query over everything available, then flush the last windows; gives the last run."""
    conf = windows.sparkSession.conf
    extra_batches = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(extra_batches)
    if heartbeat_writer:
        # The heartbeat's run closes the windows this run would close in an extra batch.
        conf.set(extra_batches, "false")
    try:
        query = start(windows, sinks, checkpoint, {"availableNow": True})
        query.awaitTermination()
    finally:
        conf.set(extra_batches, before)
    if heartbeat_writer:
        heartbeat_writer()
        query = start(windows, sinks, checkpoint, {"availableNow": True})
        query.awaitTermination()
    return query


class Totals(StreamingQueryListener):
    """Adds up what queries report per trigger, from the moment it is added to a session.

    `late` has the rows dropped behind the watermark by query id, `observed` the rows of
    every observation (`observed_pairs`) by query id and name. Recent progress alone
    would forget all but the last hundred triggers.
    """

    def __init__(self):
        self.late, self.observed = Counter(), Counter()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        query = str(event.progress.id)
        for operator in event.progress.stateOperators:
            self.late[query] += operator.numRowsDroppedByWatermark
        for name, row in event.progress.observedMetrics.items():
            self.observed[query, name] += row["rows"] or 0

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def event_pairs(events: DataFrame, left="click", right="view", key=minute_text):
    """Two single-metric streams out of a typed event stream."""

    def one(kind):
        chosen = events.where(F.col("event_type") == kind)
        return chosen.select(
            key("ts").alias("obs_key"),
            F.col("ts").alias("obs_ts"),
            F.col("ts").alias("arrival_ts"),
            "value",
        )

    return one(left), one(right)
