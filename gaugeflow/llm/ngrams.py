"""Hashed character n-grams of whole texts, document frequencies and bounded label samples."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import blocks
from gaugeflow.llm.scale import mapped
from gaugeflow.session import written

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
TEXT_BYTES = 1 << 19
# Rows of all labels together that a classifier may be fitted on, in expectation.
SAMPLE_ROWS = 12_000


class Grams:
    """Feature numbers of the n-grams of texts: one range of 2**bits numbers per order.

    Every text gets a space on either side, so an empty one still has a bigram.
    """

    def __init__(self, orders, bits, lower):
        self.orders, self.bits, self.lower = tuple(orders), bits, lower
        self.size = len(self.orders) << bits

    def codes(self, texts):
        texts = [f" {t.lower() if self.lower else t} " if t else "  " for t in texts]
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def of_order(self, flat, k):
        """Feature number of the n-gram at each position, text ends ignored."""
        n = self.orders[k]
        count = max(0, len(flat) - n + 1)
        out = np.full(count, n, dtype=np.uint32)
        for j in range(n):
            out += flat[j : j + count] * _FACTORS[j]
            out ^= out >> np.uint32(15)
        out *= np.uint32(0x2C1B3C6D)
        out >>= np.uint32(32 - self.bits)
        return out.astype(np.int64) + (k << self.bits)

    def per_text(self, texts):
        """For each text its feature numbers, one per position and order."""
        flat, offsets = self.codes(texts)
        found = [self.of_order(flat, k) for k in range(len(self.orders))]
        for a, b in zip(offsets[:-1], offsets[1:]):
            yield np.concatenate(
                [f[a : max(a, b - n + 1)] for f, n in zip(found, self.orders)]
            )


def held_out(id_col):
    """Whether crc32 of the id as text leaves no remainder by five; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def document_frequencies(docs: DataFrame, grams: Grams, text_col="text"):
    """Number of documents and, for each feature, how many of them hold it; all rows count.

    Each task adds up its own rows first and sends at most one row per feature, so
    what reaches the driver is one number per feature, whatever the input.
    """
    rows = docs.select(F.col(text_col).alias("text"))

    def count(batches):
        total = np.zeros(grams.size + 1, dtype=np.int64)
        seen = np.zeros(grams.size, dtype=bool)
        for block in blocks(batches, "text", TEXT_BYTES):
            for found in grams.per_text(block.column("text").to_pylist()):
                seen[found] = True
                total[:-1] += seen
                seen[:] = False
                total[-1] += 1
        features = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(features), pa.array(total[features])], names=["feature", "docs"]
        )

    sums = mapped(rows, count, "feature bigint, docs bigint").groupBy("feature")
    table = sums.agg(F.sum("docs").alias("docs")).toArrow()
    out = np.zeros(grams.size + 1, dtype=np.int64)
    out[table["feature"].to_numpy()] = table["docs"].to_numpy()
    return int(out[-1]), out[:-1]


def inverse_frequencies(n_docs, frequencies):
    """Smoothed idf; a feature of fewer than two documents counts nothing."""
    idf = np.log((1.0 + n_docs) / (1.0 + frequencies)) + 1.0
    return np.where(frequencies >= min(2, max(1, n_docs)), idf, 0.0)


def bounded_sample(rows: DataFrame, own, label_col, per_label, most=SAMPLE_ROWS) -> DataFrame:
    """About `per_label` different rows of each label, or all of a rare one; `most` rows in all.

    Rows are different if the columns `own` are; of equal ones with one label, one is in
    the sample. A hash of these columns is cut at the quota over the label's different
    rows (estimated within a few hundredths), so the expected size is the bound and a
    re-run draws the same rows. Every label counts: if there are so many that the quotas
    add up to more than `most`, the quota is halved until they do not.
    """
    drawn = rows.withColumn("_own", F.xxhash64(*own))
    counted = drawn.groupBy(label_col).agg(F.approx_count_distinct("_own", 0.02).alias("_rows"))
    counted = written(counted, "label-counts")
    quotas = [per_label / 2**k for k in range(40)]
    sums = counted.agg(*[F.sum(F.least(F.col("_rows"), F.lit(q))) for q in quotas]).first()
    quota = next((q for q, n in zip(quotas, sums) if (n or 0) <= most), quotas[-1])
    draw = F.pmod(F.xxhash64("_own", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    chosen = drawn.join(counted, label_col).where(draw * F.col("_rows") < quota)
    return chosen.dropDuplicates(["_own", label_col]).select(*rows.columns)


def sparse_counts(
    rows: DataFrame, grams: Grams, id_col, label_col, text_col="text", extra=None
) -> DataFrame:
    """id, label, the distinct features of each text with their counts, and what `extra`
    makes of the texts (a matrix with a row each)."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    picked = rows.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(text_col).alias("text")
    )

    def count(batches):
        for block in blocks(batches, "text", TEXT_BYTES):
            texts = block.column("text").to_pylist()
            pairs = [np.unique(found, return_counts=True) for found in grams.per_text(texts)]
            more = extra(texts) if extra else np.zeros((len(texts), 0))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"),
                    block.column("label"),
                    pa.array([p[0] for p in pairs], pa.list_(pa.int64())),
                    pa.array([p[1] for p in pairs], pa.list_(pa.int64())),
                    pa.array(list(more), pa.list_(pa.float64())),
                ],
                names=["id", "label", "features", "counts", "extra"],
            )

    return mapped(
        picked,
        count,
        f"id {kinds[id_col]}, label {kinds[label_col]}, "
        "features array<bigint>, counts array<bigint>, extra array<double>",
    )


class Sampled(NamedTuple):
    id: object
    label: object
    features: np.ndarray
    counts: np.ndarray
    extra: np.ndarray


def gathered(sample: DataFrame) -> list[Sampled]:
    """The rows of `sparse_counts` on the driver, by label, id and features; for bounded samples."""
    found = []
    for batch in sample.toArrow().to_batches():
        columns = [
            np.split(column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy())[:-1])
            for column in map(batch.column, ("features", "counts", "extra"))
        ]
        ids, labels = (batch.column(c).to_pylist() for c in ("id", "label"))
        found += map(Sampled, ids, labels, *columns)
    return sorted(found, key=lambda r: (r.label, r.id, r.features.tobytes()))
