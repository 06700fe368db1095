"""Sinks for topics, stored windows and CSV exports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators.series import last_n
from gaugeflow.sources.csv_files import DIALECT

PLACEHOLDER = "username:password"


def write_topic(messages: DataFrame, brokers, topic, streaming=False, checkpoint=None):
    """Send `(value, partition)` rows to a Kafka topic, each to its stated partition."""
    options = {
        "kafka.bootstrap.servers": brokers if isinstance(brokers, str) else ",".join(brokers),
        "topic": topic,
    }
    shaped = messages.select("value", "partition")
    if streaming:
        writer = shaped.writeStream.format("kafka").options(**options)
        return writer.option("checkpointLocation", checkpoint).start()
    return shaped.write.format("kafka").options(**options).save()


def store_batch(root: str, documents: DataFrame, batch_id: int, partition_by=None, run="batch", options=None) -> None:
    """Write one micro-batch of a run to its own folders, date first if `partition_by` is one.

    A replayed batch replaces its earlier attempt, so a restart leaves neither gaps nor
    duplicates. Batch numbers begin anew with every checkpoint; `run` keeps them apart.
    `options` are those of the parquet writer.
    """
    stamped = documents.withColumns({"run": F.lit(f"run-{run}"), "batch_id": F.lit(batch_id)})
    folders = [*([partition_by] if partition_by else []), "run", "batch_id"]
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**(options or {})).partitionBy(*folders).parquet(root)


def window_store(root: str, partition_by=None, run=None, options=None):
    """`store_batch` for `foreachBatch`; the run is the query's id, which its checkpoint keeps."""

    def write(documents, batch_id):
        context = documents.sparkSession.sparkContext
        own = run or context.getLocalProperty("sql.streaming.queryId")
        if not own:
            raise RuntimeError("no streaming query here: name the run")
        store_batch(root, documents, batch_id, partition_by, own, options)

    return write


def read_store(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """Everything stored so far, plus `run` and `batch_id`. With a schema, an empty store is no error."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root)


def stored_documents(spark: SparkSession, root: str, schema=None) -> DataFrame:
    return read_store(spark, root, schema).drop("run", "batch_id")


def compact_store(spark: SparkSession, root: str, target: str, partition_by, schema=None) -> None:
    """The whole store written to the folder `target` in few files per date, as one run.

    Readers and writers of `root` are not touched; switch readers over when it is done.
    """
    documents = stored_documents(spark, root, schema).hint("rebalance", partition_by)
    store_batch(target, documents, 0, partition_by, "compacted")


def latest_documents(stored: DataFrame, keys) -> DataFrame:
    """The newest version of each document, for stores fed by an update-mode stream.

    Newest by `processed_at` if there is one, then by batch.
    """
    order = [c for c in ("processed_at", "batch_id", "run") if c in stored.columns]
    return last_n(stored, 1, list(keys), order[0], order[1:]).drop("run", "batch_id")


def connector_sink(format: str, options: dict):
    """A `foreachBatch` sink that appends through any installed connector."""

    def write(documents, batch_id):
        documents.write.format(format).options(**options).mode("append").save()

    return write


def console_sink(order="window_start"):
    """Prints every window of each micro-batch, a partition at a time."""

    def write(documents, batch_id):
        for row in documents.orderBy(order).toLocalIterator():
            print(" | ".join(f"{name}={value}" for name, value in row.asDict().items()), flush=True)

    return write


def is_configured(uri) -> bool:
    """Whether a store address was really given."""
    return bool(uri) and PLACEHOLDER not in uri


def choose_sinks(debug=None, store=None, uri=None) -> list:
    """The sinks of a job: the debug tap if given, the store only with a real address."""
    sinks = [debug] if debug else []
    if store and is_configured(uri):
        sinks.append(store)
    return sinks


def fan_out(sinks):
    """One `foreachBatch` function that feeds several sinks from one evaluation."""

    def write(documents, batch_id):
        if len(sinks) == 1:
            sinks[0](documents, batch_id)
            return
        documents.persist()
        try:
            for sink in sinks:
                sink(documents, batch_id)
        finally:
            documents.unpersist()

    return write


def export_csv(df: DataFrame, path: str, single_file=False, encoding="UTF-8") -> None:
    """CSV with a header row, quotes doubled; `single_file` is for small extracts only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**DIALECT).option("encoding", encoding).csv(path)


def save_table(df: DataFrame, name: str, partition_by=None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
