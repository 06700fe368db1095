"""Texts as files of token ids in ascending id order, one wavelet matrix per file.

Rows are dealt to tasks by ranges of (id, text hash, place in the input), so that many
rows of one id, or of none, become many tasks. A task encodes its rows in order and
closes a file after SHARD_TOKENS ids; a document is never cut. Spark's own writer
commits the files, so a lost or repeated task leaves nothing behind. The head of a file
has the number of its task and of the file in the task, which put all files in order.
"""

import gc
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import blocks
from gaugeflow.llm.scale import mapped
from gaugeflow.llm.wavelet import Wavelet, encode, read_head
from gaugeflow.llm.word_ids import word_encoder

SHARD_TOKENS = 1 << 21


def write_token_files(docs: DataFrame, path, model, end_id, id_col="doc_id", text_col="text",
                      shard_tokens=SHARD_TOKENS):
    """Writes the ids of every text, followed by `end_id`, in the folder `path`.

    Null texts are empty, so they are `end_id` alone. Rows without an id come first, rows
    of one id in the order of their text hashes; repeated rows are written as often as
    they occur. Other columns are ignored. An empty table gives a folder without shards.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    tasks = max(1, docs.rdd.getNumPartitions())
    dealt = rows.repartitionByRange(tasks, "id", "hash", "place").sortWithinPartitions("id", "hash", "place")

    def shards(batches):
        own, part, number = word_encoder(model), TaskContext.get().partitionId(), 0
        names, parts, lengths, size = [], [], [], 0

        def closed():
            data = encode(np.concatenate(parts), names, lengths, part=part, shard=number)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        # The tables of words hold no cycles, and looking for some takes longer than the words do.
        gc.disable()
        try:
            for block in blocks(batches, "text"):
                for name, text in zip(block.column("name").to_pylist(), block.column("text").to_pylist()):
                    ids = np.append(own.ids(text), np.uint32(end_id)).astype("<u4")
                    if size and size + len(ids) > shard_tokens:
                        yield closed()
                        names, parts, lengths, size, number = [], [], [], 0, number + 1
                    names.append(name)
                    parts.append(ids)
                    lengths.append(len(ids))
                    size += len(ids)
            if size:
                yield closed()
        finally:
            gc.enable()

    made = mapped(dealt.select(F.col("id").cast("string").alias("name"), "text"), shards, "data binary")
    # The text writer puts the bytes down as they are, and one line end behind each file.
    writer = made.select(F.col("data").cast("string").alias("value")).write
    writer.option("maxRecordsPerFile", 1).text(path)


def shard_files(spark, path) -> DataFrame:
    """The contents of the files under `path`."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def shard_starts(spark, path) -> DataFrame:
    """(part, shard, tokens, start): ids in every file and in all files before it.

    Only heads are looked at. One row per file; the running sum over the tasks that wrote
    them has one row per task.
    """

    def heads(batches):
        for batch in batches:
            found = [read_head(c.as_buffer())[0] for c in batch.column("content")]
            yield pa.RecordBatch.from_pylist(
                [{k: h[k] for k in ("part", "shard", "tokens")} for h in found],
                schema=pa.schema([(k, pa.int64()) for k in ("part", "shard", "tokens")]),
            )

    found = mapped(shard_files(spark, path), heads, "part long, shard long, tokens long")
    in_part, so_far = Window.partitionBy("part").orderBy("shard"), Window.orderBy("part")
    parts = found.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(so_far) - F.col("n")).alias("before"))
    inside = F.sum("tokens").over(in_part) - F.col("tokens")
    return found.withColumn("inside", inside).join(before, "part").select(
        "part", "shard", "tokens", (F.col("before") + F.col("inside")).alias("start")
    )


def _with_starts(spark, path, rows):
    starts = shard_starts(spark, path).select("part", "shard", F.col("start").alias("_first"))
    return rows.join(starts, ["part", "shard"]).withColumn("start", F.col("start") + F.col("_first"))


def read_token_files(spark, path, id_type="long", keep_ids=True) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 and its ids.

    `start` is the number of ids of all documents before it, `ids_crc32` the check sum
    of its ids as little-endian unsigned 32-bit numbers, `ids` those bytes.
    """

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                shard = Wavelet(content.as_buffer())
                ids = shard.ids().astype("<u4")
                data = [ids[a : a + n].tobytes() for a, n in zip(shard.starts, shard.lengths)]
                size = len(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.head["part"]] * size, pa.int64()),
                        pa.array([shard.head["shard"]] * size, pa.int64()),
                        pa.array(shard.names, pa.string()),
                        pa.array(shard.starts, pa.int64()),
                        pa.array(shard.lengths, pa.int64()),
                        pa.array([zlib.crc32(d) for d in data], pa.int64()),
                        pa.array(data if keep_ids else [None] * size, pa.binary()),
                    ],
                    names=["part", "shard", "name", "start", "n_tokens", "ids_crc32", "ids"],
                )

    schema = "part long, shard long, name string, start long, n_tokens long, ids_crc32 long, ids binary"
    rows = _with_starts(spark, path, mapped(shard_files(spark, path), read, schema))
    own = ["start", "n_tokens", "ids_crc32", *["ids"] * keep_ids]
    return rows.select(F.col("name").cast(id_type).alias("doc_id"), *own)


def tokens_at(spark, path, positions: DataFrame) -> DataFrame:
    """`positions` (long column `position`, counted over all files) with `token_id`.

    Files are asked for the positions that lie in them, a bounded number at a time;
    positions outside the files are dropped, repeated ones answered as often.
    """
    starts = shard_starts(spark, path)
    bounds = starts.where("tokens > 0").select("part", "shard", "start", "tokens")
    # Positions meet their file in cells as long as the largest file, a key like any other.
    cell = int(bounds.agg(F.coalesce(F.max("tokens"), F.lit(1))).first()[0])
    cells = F.explode(F.sequence(
        F.floor(F.col("start") / cell), F.floor((F.col("start") + F.col("tokens") - 1) / cell)
    ))
    asked = positions.select("position", F.floor(F.col("position") / cell).alias("_cell"))
    inside = F.expr("position >= start AND position < start + tokens")
    found = asked.join(bounds.withColumn("_cell", cells), "_cell").where(inside)
    # At most a file's length of different positions belongs to one file.
    wanted = found.groupBy("part", "shard").agg(
        F.array_sort(F.collect_set(F.col("position") - F.col("start"))).alias("at"),
        F.first("start").alias("start"),
    )
    files = mapped(shard_files(spark, path), _named, "part long, shard long, content binary")

    def answer(batches):
        for batch in batches:
            for content, at, start in zip(*map(batch.column, ("content", "at", "start"))):
                at = np.array(at.as_py(), dtype=np.int64)
                ids = Wavelet(content.as_buffer()).access(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + start.as_py()), pa.array(ids.astype(np.int64))],
                    names=["position", "token_id"],
                )

    joined = files.join(wanted, ["part", "shard"]).select("content", "at", "start")
    return positions.join(mapped(joined, answer, "position long, token_id long"), "position")


def _named(batches):
    for batch in batches:
        heads = [read_head(c.as_buffer())[0] for c in batch.column("content")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h["part"] for h in heads], pa.int64()),
             pa.array([h["shard"] for h in heads], pa.int64()), batch.column("content")],
            names=["part", "shard", "content"],
        )


def token_frequencies(spark, path, tokens) -> DataFrame:
    """(token_id, n): how often each of the `tokens` (a list) occurs, counted by rank alone."""
    tokens = sorted({int(t) for t in tokens})

    def counts(batches):
        for batch in batches:
            for content in batch.column("content"):
                shard = Wavelet(content.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.int64()), pa.array([shard.count(t) for t in tokens], pa.int64())],
                    names=["token_id", "n"],
                )

    found = mapped(shard_files(spark, path), counts, "token_id long, n long")
    return found.groupBy("token_id").agg(F.sum("n").alias("n"))


def token_occurrences(spark, path, tokens, id_type="long") -> DataFrame:
    """(token_id, doc_id, offset, position): every place of the `tokens` (a list).

    `offset` counts from the document's first id, `position` over all files.
    """
    tokens = sorted({int(t) for t in tokens})

    def places(batches):
        for batch in batches:
            for content in batch.column("content"):
                shard = Wavelet(content.as_buffer())
                for token in tokens:
                    at = shard.locate(token)
                    doc = np.searchsorted(shard.starts, at, "right") - 1
                    size = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard.head["part"]] * size, pa.int64()),
                            pa.array([shard.head["shard"]] * size, pa.int64()),
                            pa.array([token] * size, pa.int64()),
                            pa.array([shard.names[d] for d in doc], pa.string()),
                            pa.array(at - shard.starts[doc], pa.int64()),
                            pa.array(at, pa.int64()),
                        ],
                        names=["part", "shard", "token_id", "name", "offset", "start"],
                    )

    schema = "part long, shard long, token_id long, name string, offset long, start long"
    rows = _with_starts(spark, path, mapped(shard_files(spark, path), places, schema))
    return rows.select(
        "token_id", F.col("name").cast(id_type).alias("doc_id"), "offset", F.col("start").alias("position")
    )
