"""A store with one current row per key, out of files that are never rewritten in place.

Every commit writes new files (one date each) and one record of actions: files that are
now live, files that no longer are. The live files follow from these records alone, so a
commit that dies half-way changes nothing, and a batch that is run again takes the place
of its first attempt, with its place in the order of commits. A live file is listed with
the hash buckets of its keys. Readers merge only files that share a bucket with another
of the same date (the newest commit wins); all others are read as they are. Compaction
replaces the files of the dates that need it by merged ones and swaps them in by one
record. One writer at a time.
"""

import uuid
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators.series import last_n
from gaugeflow.schemas import FILE_ACTION

BUCKETS = 4096


class KeyedStore:
    """Rows of `schema` under `root`, one per `keys`; `part` is the column that files are divided by.

    Null keys are equal to each other.
    """

    def __init__(self, spark: SparkSession, root, keys, schema, part="window_date"):
        self.spark, self.root, self.keys, self.schema, self.part = spark, root, list(keys), schema, part

    # ------------------------------------------------------------ what is live

    def _records(self) -> DataFrame:
        try:
            return self.spark.read.schema(FILE_ACTION).parquet(f"{self.root}/log")
        except AnalysisException:
            return self.spark.createDataFrame([], FILE_ACTION)

    def live(self) -> DataFrame:
        """The live files: the last thing said of each is that it was added."""
        last = self._records().groupBy("path").agg(F.max_by(F.struct(*FILE_ACTION.names), "version").alias("_last"))
        return last.select("_last.*").where("action = 'add'")

    def _commit(self, added: DataFrame, removed: DataFrame, version):
        """One record of both, in one file, so it is there or not."""
        gone = removed.select(F.lit("remove").alias("action"), *[
            F.lit(version).cast("long").alias(c) if c == "version" else F.col(c) for c in FILE_ACTION.names[1:]
        ])
        added.unionByName(gone).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def _version(self):
        return (self._records().agg(F.max("version")).first()[0] or 0) + 1

    # ------------------------------------------------------------ writing

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def _written(self, rows: DataFrame, version, seq, run, batch_id) -> DataFrame:
        """New files with `rows`, as actions. Only the new files are looked at for it."""
        folder = f"{self.root}/data/v{version:09d}-{uuid.uuid4().hex}"
        shaped = rows.select(*self.schema.names).withColumn("_part", F.col(self.part).cast("string"))
        shaped.hint("rebalance", "_part").write.partitionBy("_part").parquet(folder)
        files = self._files([folder]).groupBy(F.col("_path").alias("path")).agg(
            F.max(F.col(self.part).cast("string")).alias("part"),
            F.count("*").alias("n"),
            F.sort_array(F.collect_set(self._bucket())).alias("buckets"),
        )
        given = {"action": "add", "seq": seq, "version": version, "run": run, "batch_id": batch_id}
        return files.select(*[
            F.lit(given[f.name]).cast(f.dataType).alias(f.name) if f.name in given else F.col(f.name) for f in FILE_ACTION
        ])

    def _files(self, paths, names=None) -> DataFrame:
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true")
        return reader.parquet(*paths).select(*(names or self.schema.names), F.col("_metadata.file_path").alias("_path"))

    def upsert(self, rows: DataFrame, batch_id=0, run="batch"):
        """The rows of a batch become the current ones of their keys, one row per key of the batch.

        Run again, a batch replaces its first attempt: rows of later commits stay newer.
        """
        version = self._version()
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        before, seq = self.live().where(own), self._records().where(own).agg(F.min("seq")).first()[0]
        single = rows.dropDuplicates(self.keys)
        self._commit(self._written(single, version, seq or version, run, batch_id), before, version)

    def sink(self, run=None):
        """`upsert` for `foreachBatch`; the run is the query's id unless it is named."""

        def write(documents, batch_id):
            context = documents.sparkSession.sparkContext
            own = run or context.getLocalProperty("sql.streaming.queryId")
            if not own:
                raise RuntimeError("no streaming query here: name the run")
            self.upsert(documents, batch_id, own)

        return write

    # ------------------------------------------------------------ reading

    def _shared(self, files: DataFrame) -> DataFrame:
        """Paths of files that may hold a key of another file of the same part."""
        each = files.select("path", "part", F.explode("buckets").alias("bucket"))
        met = each.groupBy("part", "bucket").agg(F.collect_set("path").alias("paths"))
        return met.where("size(paths) > 1").select(F.explode("paths").alias("path")).distinct()

    def read(self, files: DataFrame = None) -> DataFrame:
        """The current row of every key, of all live files or of some of them.

        The list of files passes the driver, as Spark's own file index does.
        """
        files = self.live() if files is None else files
        shared = {r.path for r in self._shared(files).collect()}
        listed = {r.path: r.seq for r in files.select("path", "seq").collect()}
        alone = [p for p in listed if p not in shared]
        out = self._files(alone).drop("_path") if alone else self.spark.createDataFrame([], self.schema)
        if not shared:
            return out
        order = self.spark.createDataFrame([(p, listed[p]) for p in shared], "_path string, _seq long")
        merged = last_n(self._files(sorted(shared)).join(order, "_path"), 1, self.keys, "_seq", ["_path"])
        return out.unionByName(merged.select(*self.schema.names))

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The current rows of the keys in `wanted`; only files that may hold one of them are opened."""
        asked = wanted.select(*self.keys).distinct()
        live = self.live()
        # At most BUCKETS numbers, whatever the number of keys.
        buckets = asked.select(self._bucket().alias("bucket")).distinct()
        paths = live.select("path", F.explode("buckets").alias("bucket")).join(buckets, "bucket", "left_semi")
        renamed = asked.withColumnsRenamed({k: f"_{k}" for k in self.keys})
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        return self.read(live.join(paths, "path", "left_semi")).join(renamed, same, "left_semi")

    def compact(self, most_files=8):
        """Merges the files of every part that has several for a key, or more than `most_files`.

        Files of other parts are not touched. Readers see the files before or those after.
        """
        live = self.live()
        busy = live.groupBy("part").agg(F.count("*").alias("files")).where(F.col("files") > most_files).select("part")
        parts = self._shared(live).join(live, "path").select("part").union(busy).distinct()
        old = live.join(parts.withColumnRenamed("part", "_p"), F.col("part").eqNullSafe(F.col("_p")), "left_semi")
        old = self.spark.createDataFrame(old.collect(), FILE_ACTION)
        if old.isEmpty():
            return
        version = self._version()
        self._commit(self._written(self.read(old), version, version, "compaction", version), old, version)
