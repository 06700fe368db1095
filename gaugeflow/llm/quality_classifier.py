"""Quality scores by nearest-neighbour voting among labelled texts.

Texts become latent-semantic vectors: hashed character n-grams, sublinear TF-IDF
with document frequencies of the whole corpus, and two terms for words and lines
that repeat, projected on the leading singular directions of a bounded labelled
sample. The sample's vectors are broadcast; every
document meets all of them in blocked products, and its nearest ones vote with
their similarity.
"""

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import blocks
from gaugeflow.llm.ngrams import (
    TEXT_BYTES,
    Grams,
    bounded_sample,
    document_frequencies,
    gathered,
    held_out,
    inverse_frequencies,
    sparse_counts,
)
from gaugeflow.llm.scale import mapped

GRAMS = Grams(orders=(1, 2, 3), bits=12, lower=False)
# Labelled documents per class that the space and the votes are taken from, in expectation.
SAMPLE_PER_CLASS = 1_000
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 4.0
STEP = 1e-5
THRESHOLD = 0.3
BLOCK_ROWS = 256
# Weight of the repetition terms against a row of n-grams, which has length one.
REPETITION = 2.0


@dataclass
class Space:
    idf: np.ndarray
    axes: np.ndarray  # (features, dimensions)
    vectors: np.ndarray  # (labelled documents, dimensions), of length one
    labels: np.ndarray
    prior: float


def repetition(texts):
    """Share of words equal to the word before, and of lines equal to an earlier line."""
    out = np.zeros((len(texts), 2), dtype=np.float32)
    for row, text in zip(out, texts):
        words = text.split() if text else []
        if words:
            row[0] = sum(map(eq, words, words[1:])) / len(words)
            lines = [line for line in text.split("\n") if line and not line.isspace()]
            row[1] = 1 - len(set(lines)) / len(lines) if lines else 0.0
    return out


def weighted(counts, idf, repeats):
    """Sublinear TF-IDF rows of length one (a row of zeros stays zero), then the repetition terms."""
    return np.hstack([unit(np.log1p(counts) * idf), REPETITION * repeats])


def unit(vectors):
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 1e-9)


def latent_axes(rows, dimensions, seed=0):
    """Leading right singular vectors by subspace iteration on random directions."""
    size = min(dimensions + 16, *rows.shape)
    basis = np.random.default_rng(seed).standard_normal((rows.shape[1], size)).astype(rows.dtype)
    for _ in range(4):
        left, _ = np.linalg.qr(rows @ basis)
        basis, _ = np.linalg.qr(rows.T @ left)
    _, _, turned = np.linalg.svd(rows @ basis, full_matrices=False)
    return basis @ turned[:dimensions].T


def fit(docs: DataFrame, labels: DataFrame, grams=GRAMS, per_class=SAMPLE_PER_CLASS) -> Space | None:
    """The space from docs (id, text) and labels (id, label of 0 or 1); None without labelled texts."""
    known = labels.where("id IS NOT NULL AND label IN (0, 1)").where(~held_out("id"))
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    # Both tables are bounded by the sample: at most its ids, and one text of each.
    sample = bounded_sample(known, ["id"], "label", per_class)
    texts = docs.where("id IS NOT NULL AND text IS NOT NULL").join(F.broadcast(sample), "id")
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = gathered(sparse_counts(texts, grams, "id", "label", extra=repetition))
    if not found:
        return None
    idf = inverse_frequencies(*document_frequencies(docs, grams)).astype(np.float32)
    counts = np.zeros((len(found), grams.size), dtype=np.float32)
    for row, r in zip(counts, found):
        row[r.features] = r.counts
    rows = weighted(counts, idf, np.array([r.extra for r in found], dtype=np.float32))
    axes = latent_axes(rows, DIMENSIONS)
    votes = np.array([r.label for r in found], dtype=np.float32)
    # The sample is balanced; the prior is the share of label 1 among all learnable labels.
    prior = known.agg(F.avg("label")).first()[0]
    return Space(idf, axes, unit(rows @ axes), votes, float(prior))


def vote(space: Space, counts, repeats, k=NEIGHBOURS):
    """Share of label 1 among the k most similar labelled texts, weighted by similarity.

    A text without any known feature gets the prior. Similarities count in steps of
    STEP, which are wider than what rounding in a block product changes; of equally
    similar neighbours the first in the sample's order are taken.
    """
    vectors = unit(weighted(counts, space.idf, repeats) @ space.axes)
    steps = np.rint(vectors @ space.vectors.T / STEP).astype(np.int64)
    size = steps.shape[1]
    k = min(k, size)
    # One number for both: the steps, then the place from the end.
    ranked = steps * size + np.arange(size - 1, -1, -1)
    near = np.argpartition(-ranked, k - 1, axis=1)[:, :k]
    near.sort(axis=1)
    similar = np.take_along_axis(steps, near, axis=1) * STEP
    weight = np.maximum(similar, 0.0) ** SHARPNESS
    total = weight.sum(axis=1)
    share = (weight * space.labels[near]).sum(axis=1) / np.where(total > 0, total, 1.0)
    return np.where(total > 0, np.clip(share, 0.0, 1.0), space.prior)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col="doc_id",
    text_col="text",
    label_col="quality",
    threshold=THRESHOLD,
    grams=GRAMS,
) -> DataFrame:
    """id, held_out, score and predicted (1 if score >= threshold, else 0) of every row.

    `labels` has the same id column and `label_col`. Null and empty texts have no
    letters to compare and get the score that blank text gets; without any
    learnable label every score is 0.0. A null id is not held out (null) and
    teaches nothing; of several labels for one id the smallest counts, of several
    texts for one id the one of least hash teaches. Other columns are never inputs.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    space = fit(own, known, grams)
    shared = docs.sparkSession.sparkContext.broadcast(space)
    kind = own.schema["id"].dataType.simpleString()

    def scored(batches):
        model = shared.value
        for block in blocks(batches, "text", TEXT_BYTES):
            texts = block.column("text").to_pylist()
            scores = np.zeros(len(texts))
            for first in range(0, len(texts) if model is not None else 0, BLOCK_ROWS):
                part = texts[first : first + BLOCK_ROWS]
                counts = np.array(
                    [np.bincount(f, minlength=grams.size) for f in grams.per_text(part)],
                    dtype=np.float32,
                )
                scores[first : first + len(part)] = vote(model, counts, repetition(part))
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(scores)], names=["id", "score"]
            )

    return mapped(own, scored, f"id {kind}, score double").select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
