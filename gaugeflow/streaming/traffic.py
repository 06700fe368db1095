"""Readings landed once, each with the number of parts that its key is cut in just now.

One query reads and parses the topic and lands its readings; everything else reads what
has landed. For every micro-batch each task keeps a summary of its most frequent keys
(Misra-Gries: a bounded table, in which every key with more than 1/KEPT of the task's rows
is certain to be). The merged summary decides the level of each key: 2**level parts. What
has been decided for the rows that may still meet others is kept from batch to batch, so
that a row knows under which levels its partners are stored. Rows behind the watermark, the
greatest time of the batches before less the allowed delay, are marked late; keys whose
rows are all behind it are forgotten, so the table is as large as the delay's hot keys.
"""

import json
import math

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.times import micros_of
from gaugeflow.schemas import LANDING_MARKS
from gaugeflow.sources.topics import read_record_files
from gaugeflow.streaming.one_pass import MOST_LEVEL

KEPT = 1024
ROWS_PER_PART = 10_000


def frequent(counts: dict, kept=KEPT) -> dict:
    """Misra-Gries: the table is cut back to `kept` keys by taking the same number from all."""
    if len(counts) <= kept:
        return counts
    less = sorted((row[0] for row in counts.values()), reverse=True)[kept]
    return {k: (n - less, *times) for k, (n, *times) in counts.items() if n > less}


def summaries(readings: DataFrame, keys, time, kept=KEPT) -> DataFrame:
    """(keys, n, first, last) of the frequent keys of each task, at most `kept` rows a task."""
    keys = list(keys)
    rows = readings.dropna(subset=[*keys, time]).select(*keys, F.unix_micros(time).alias("t"))

    def summarise(batches):
        counts = {}
        for batch in batches:
            groups = batch.groupby(keys)["t"].agg(["size", "min", "max"])
            for key, *row in groups.itertuples(name=None):
                key = key if isinstance(key, tuple) else (key,)
                n, first, last = counts.get(key, (0, math.inf, -math.inf))
                counts[key] = (n + row[0], min(first, row[1]), max(last, row[2]))
            counts = frequent(counts, kept)
        found = [(*k, *row) for k, row in counts.items()]
        yield pd.DataFrame(found, columns=[*keys, "n", "first", "last"])

    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    parts = rows.mapInPandas(summarise, f"{kinds}, n BIGINT, first BIGINT, last BIGINT")
    merged = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.orderBy(F.desc("n"), *keys).limit(kept)


class Traffic:
    """What is known of the hot keys: the levels of rows that may still meet others.

    `live` maps a key to its levels, and each level to the last time stored under it.
    """

    def __init__(self, reach, delay, rows_per_part=ROWS_PER_PART):
        self.reach, self.delay, self.rows_per_part = reach, delay, rows_per_part
        self.live, self.newest = {}, None

    def level(self, n):
        return min(MOST_LEVEL, max(0, math.ceil(math.log2(max(1, n) / self.rows_per_part))))

    def watermark(self):
        return None if self.newest is None else self.newest - self.delay

    def decide(self, found):
        """{key: (level, other levels)} of one batch, from its summary rows (key, n, first, last).

        Keys that are not in the result have level 0 and no others, now and before. A key
        keeps its level while it would only fall by one, as changes cost visits.
        """
        decided, before = {}, self.newest
        for key, n, first, last in found:
            known, level = self.live.get(key), self.level(n)
            if known is None and level:
                # Rows of earlier batches, if some can be near, are under level 0.
                known = {0: before} if before is not None and first - self.reach <= before else {}
            if known is None:
                continue
            latest = max(known, key=known.get, default=0)
            level = latest if level == latest - 1 else level
            others = [k for k, t in known.items() if k != level and t + self.reach >= first]
            decided[key] = (level, sorted(others))
            self.live[key] = {**known, level: max(last, known.get(level, last))}
        for key in self.live.keys() - decided.keys():
            # Not frequent in this batch: level 0, and visits to what is stored elsewhere.
            known = self.live[key]
            decided[key] = (0, sorted(k for k in known if k))
            self.live[key] = {**known, 0: max(known.values())}
        return decided

    def close(self, newest):
        """Ends a batch with its greatest time; forgets what nothing on time can meet."""
        if newest is not None:
            self.newest = max(newest, self.newest if self.newest is not None else newest)
        if self.newest is not None:
            for key, known in list(self.live.items()):
                alive = {k: t for k, t in known.items() if t + self.reach >= self.watermark()}
                if alive:
                    self.live[key] = alive
                else:
                    del self.live[key]

    def dump(self):
        return json.dumps({"newest": self.newest, "live": [[list(k), list(v.items())] for k, v in self.live.items()]})

    def load(self, text):
        found = json.loads(text)
        self.newest, self.live = found["newest"], {tuple(k): {int(a): b for a, b in v} for k, v in found["live"]}
        return self


class Landing:
    """A `foreachBatch` sink that lands readings under `root`, marked with level, others, late and landed (the batch).

    A batch that is run again finds what it has landed and leaves it; otherwise it starts
    from the table of the batch before, so it decides as it did the first time.
    """

    def __init__(self, root, keys=("obs_key",), time="arrival_ts", lower=-5, upper=5, delay_seconds=600,
                 rows_per_part=ROWS_PER_PART):
        self.root, self.keys, self.time = root, list(keys), time
        self.settings = micros_of(max(abs(lower), abs(upper))), micros_of(delay_seconds), rows_per_part

    def folder(self, kind, batch_id):
        return f"{self.root}/{kind}/batch-{batch_id:09d}"

    def table(self, spark: SparkSession, batch_id):
        """The table as a batch left it; None if that batch has not landed."""
        if batch_id < 0:
            return Traffic(*self.settings)
        try:
            rows = spark.read.option("wholetext", "true").text(self.folder("traffic", batch_id)).collect()
        except AnalysisException:
            return None
        return Traffic(*self.settings).load(rows[0][0]) if rows else None

    def marked(self, readings, decided, watermark, batch_id):
        kinds = ", ".join(f"`{k}` {readings.schema[k].dataType.simpleString()}" for k in self.keys)
        rows = [(*key, level, others) for key, (level, others) in decided.items()]
        levels = readings.sparkSession.createDataFrame(rows, f"{kinds}, level INT, others ARRAY<INT>")
        late = F.lit(False) if watermark is None else F.unix_micros(self.time) < watermark
        return readings.join(levels, self.keys, "left").withColumns(
            {
                "level": F.coalesce("level", F.lit(0)),
                "others": F.coalesce("others", F.array().cast("array<int>")),
                "late": F.coalesce(late, F.lit(False)),
                "landed": F.lit(batch_id).cast("long"),
            }
        )

    def __call__(self, readings, batch_id):
        spark = readings.sparkSession
        if self.table(spark, batch_id) is not None:
            return
        traffic = self.table(spark, batch_id - 1)
        if traffic is None:
            raise RuntimeError(f"batch {batch_id} does not follow what has landed in {self.root}")
        watermark = traffic.watermark()
        readings.persist()
        try:
            on_time = readings if watermark is None else readings.where(F.unix_micros(self.time) >= watermark)
            size = len(self.keys)
            found = [(tuple(r[:size]), *r[size:]) for r in summaries(on_time, self.keys, self.time).collect()]
            decided = traffic.decide(found)
            traffic.close(readings.agg(F.max(F.unix_micros(self.time))).first()[0])
            marked = self.marked(readings, decided, watermark, batch_id)
            marked.write.mode("overwrite").parquet(self.folder("readings", batch_id))
            # The batch has landed once its table is there.
            table = spark.createDataFrame([(traffic.dump(),)], "value string").coalesce(1)
            table.write.mode("overwrite").text(self.folder("traffic", batch_id))
        finally:
            readings.unpersist()


def landed_readings(spark: SparkSession, root, schema, streaming=True, files_per_batch=None) -> DataFrame:
    """What has landed under `root`, in the order of landing; `schema` is that of the readings."""
    whole = T.StructType([*schema.fields, *LANDING_MARKS.fields])
    return read_record_files(spark, f"{root}/readings/batch-*", whole, streaming, files_per_batch)
