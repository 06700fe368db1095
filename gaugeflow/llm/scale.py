"""Physical choices by measured size; none of them changes a result."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table is broadcast by hand only if it was counted and holds no more than this.
BROADCAST_BYTES = 24 << 20


def counted_broadcast(table: DataFrame, bytes_of=None, limit=BROADCAST_BYTES) -> DataFrame:
    """`table`, marked for broadcast if its measured size is within `limit`.

    `table` should be written or checkpointed, since it is read once to be measured.
    `bytes_of` is the size of a row's variable part. Beyond the limit the join is
    left to Spark, which shuffles both sides.
    """
    width = 16 * len(table.columns)
    variable = F.sum(bytes_of) if bytes_of is not None else F.lit(0)
    rows, extra = table.agg(F.count("*"), F.coalesce(variable, F.lit(0))).first()
    return F.broadcast(table) if rows * width + extra <= limit else table


# Texts are long: Arrow's usual batches of 64 MB would be held several times over by a worker.
BATCH_BYTES = 4 << 20


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """`mapInArrow` with batches of BATCH_BYTES at most, which is set for the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df.mapInArrow(function, schema)
