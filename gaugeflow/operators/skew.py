"""Hot-key handling shared by the joins."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salt(left: DataFrame, right: DataFrame, keys, left_spread, right_spread, crowds: DataFrame):
    """Both sides with `_salt1` and `_salt2` to join on besides `keys`.

    `crowds` has the keys to split and their `_salts1` and `_salts2`. A left row gets one
    first salt by a hash of `left_spread` and a copy per second salt, a right row the other
    way round, so every pair still meets once, and a key that is crowded on either side is
    cut there. Salts come from the data: a re-run task assigns the same ones.
    """

    def own(count, spread):
        return F.pmod(F.xxhash64(*spread), F.coalesce(count, F.lit(1))).cast("int")

    def copies(count):
        return F.explode(F.sequence(F.lit(0), (F.coalesce(count, F.lit(1)) - 1).cast("int")))

    one, two = F.col("_salts1"), F.col("_salts2")
    salted = left.join(crowds, keys, "left").withColumn("_salt1", own(one, left_spread))
    salted = salted.withColumn("_salt2", copies(two)).drop("_salts1", "_salts2")
    copied = right.join(crowds, keys, "left").withColumn("_salt2", own(two, right_spread))
    copied = copied.withColumn("_salt1", copies(one)).drop("_salts1", "_salts2")
    return salted, copied


def per_key_join(rows: DataFrame, per_key: DataFrame, keys) -> DataFrame:
    """Inner join of many rows with a table of one row per key; NULL keys are equal.

    The larger side of a skewed key is split by adaptive execution, which can do so
    because the other side has one row for it; a small table is broadcast by it.
    """
    keys = list(keys)
    other = per_key.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(other, same).drop(*[f"_{k}" for k in keys])


def largest_group(df: DataFrame, keys) -> int:
    """Rows in the biggest group; one partial aggregation, one number to the driver."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return counted.agg(F.max("_rows")).first()[0] or 0
