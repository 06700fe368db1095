"""Connected components of an edge table, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.session import cut_lineage


def _least(edges: DataFrame, node, other) -> DataFrame:
    """(node, m): the least neighbour of every node, by partial minima.

    It is written first: a join with it then shuffles both sides for itself, and adaptive
    execution can split the rows of a hub among tasks, since this side has one row for it.
    """
    return cut_lineage(edges.groupBy(node).agg(F.min(other).alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the least node it knows, itself included."""
    # Nodes without a smaller neighbour know none less than themselves: no row, no change.
    least = _least(edges, "b", "a").withColumnRenamed("b", "a")
    return edges.join(least, "a", "left").select(F.coalesce("m", "a").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the least of them."""
    least = _least(edges, "b", "a")
    joined = edges.join(least, "b")
    hooked = joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return hooked.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an undirected edge table (a, b); the least node names it.

    Nodes are of any ordered type without nulls. Only joins and aggregates over edges:
    a node of any degree is never gathered. Stops when a round changes nothing, after
    about log2 of the longest chain rounds; every round is cut off by a checkpoint.
    """
    rows = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rows, before = cut_lineage(rows.distinct()), None
    while True:
        now = rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        rows = cut_lineage(_small_star(_large_star(rows)))
    members = rows.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.union(rows.select("a", "a").distinct())
