"""Topic records, as a stream or as a bounded replay."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import TOPIC_RECORD


def kafka_options(brokers, topic, group_id=None, starting="earliest", ending=None) -> dict:
    """Reader options; a fresh start begins at the earliest offset, a restart at its checkpoint."""
    options = {
        "kafka.bootstrap.servers": brokers if isinstance(brokers, str) else ",".join(brokers),
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if ending:
        options["endingOffsets"] = ending
    return options


def read_topic(spark: SparkSession, options: dict, streaming=True) -> DataFrame:
    """Value and arrival time of each record of a Kafka topic."""
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**options).load()
    return records.select(
        F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp"
    )


def read_record_files(
    spark: SparkSession, path, schema=TOPIC_RECORD, streaming=True, files_per_batch=None,
    format="parquet",
) -> DataFrame:
    """Records landed as files, with the same downstream contract as a topic.

    `path` is a folder or a pattern.
    """
    reader = (spark.readStream if streaming else spark.read).format(format).schema(schema)
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
