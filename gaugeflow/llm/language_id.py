"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weighted, hashed character bigrams and trigrams. Document
frequencies cover every learnable text. The weights are fitted on a bounded sample
per language with the follow-the-regularised-leader update (elastic-net
penalties), and a temperature fitted on a part of the sample that the weights have
not seen calibrates the scores.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

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

GRAMS = Grams(orders=(2, 3), bits=16, lower=True)
# Documents per language that the weights are fitted on, in expectation.
SAMPLE_PER_LANGUAGE = 600
SCALE = 30.0
UNKNOWN = "und"


@dataclass
class Model:
    languages: list
    weights: np.ndarray  # (features + 1, languages), idf included; the last row is zero
    bias: np.ndarray
    temperature: float


def softmax(logits):
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def fit_ftrl(rows, size, n_classes, alpha=0.3, beta=1.0, l1=0.02, l2=0.02, epochs=4, seed=0):
    """Weights and bias after a few passes; rows are (features, values, class)."""
    z, n = np.zeros((size + 1, n_classes)), np.zeros((size + 1, n_classes))

    def weights(at):
        zs = z[at]
        solved = (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zs) > l1, solved, 0.0)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            features, values, label = rows[r]
            at = np.append(features, size)
            x = np.append(values, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[label] -= 1.0
            g = np.outer(x, p)
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:-1], w[-1]


def fit_temperature(logits, labels):
    """The temperature with the least negative log-likelihood, from a grid of 0.05 to 20."""
    grid = np.geomspace(0.05, 20.0, 121)

    def loss(t):
        p = softmax(logits / t)[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-300)).mean()

    return float(min(grid, key=loss)) if len(labels) else 1.0


def learnable(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Rows with a label, a text and an id whose remainder is not zero."""
    own = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    return own.where("text IS NOT NULL AND lang IS NOT NULL").where(~held_out("id"))


def fit(rows: DataFrame, grams=GRAMS, per_language=SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model from rows (id, text, lang); None if there are none."""
    n_docs, frequencies = document_frequencies(rows, grams)
    if not n_docs:
        return None
    idf = inverse_frequencies(n_docs, frequencies)
    sample = bounded_sample(rows, ["id", "text"], "lang", per_language)
    found = gathered(sparse_counts(sample, grams, "id", "lang"))
    languages = sorted({r.label for r in found})
    if not languages:
        return None
    parts = ([], [])
    for number, r in enumerate(found):
        values = SCALE * r.counts / r.counts.sum() * idf[r.features]
        # Every fifth row of the sorted sample only calibrates.
        parts[number % 5 == 4].append((r.features, values, languages.index(r.label)))
    weights, bias = fit_ftrl(parts[0], grams.size, len(languages))
    logits = np.array([v @ weights[f] + bias for f, v, _ in parts[1]]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, [label for *_, label in parts[1]])
    scaled = np.vstack([weights * (SCALE * idf)[:, None], np.zeros(len(languages))])
    return Model(languages, scaled, bias, temperature)


def has_letter(text):
    return text is not None and any(map(str.isalpha, text))


def probabilities(model: Model, texts, grams=GRAMS):
    """Calibrated probabilities of each text; every position adds its n-grams' weights."""
    flat, offsets = grams.codes(texts)
    total, positions = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for k, n in enumerate(grams.orders):
        found = np.full(len(flat), grams.size, dtype=np.int64)
        part = grams.of_order(flat, k)
        found[: len(part)] = part
        for j in range(1, n):
            found[offsets[1:] - j] = grams.size
        total += np.add.reduceat(model.weights[found], offsets[:-1], axis=0)
        positions += np.diff(offsets) - n + 1
    return softmax((total / positions[:, None] + model.bias) / model.temperature)


def predict(
    docs: DataFrame, model: Model | None, text_col="text", added=("lang_pred", "score"), grams=GRAMS
) -> DataFrame:
    """All columns of `docs` with the language and its score; `und` and 0.0 without a letter or a model.

    `added` names the two columns; those of `docs` with such names are replaced. Ties go
    to the first language in alphabetical order.
    """
    names = [c for c in docs.columns if c not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = names.index(text_col)

    def score(batches):
        own = shared.value
        for block in blocks(batches, text_col, TEXT_BYTES):
            texts = block.column(at).to_pylist()
            known = np.array([own is not None and has_letter(t) for t in texts], dtype=bool)
            labels, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            if known.any():
                p = probabilities(own, [t for t, k in zip(texts, known) if k], grams)
                labels[known] = np.array(own.languages, dtype=object)[p.argmax(axis=1)]
                scores[known] = p.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(labels, pa.string()), pa.array(scores)],
                names=[*names, *added],
            )

    kinds = [T.StructField(c, k) for c, k in zip(added, (T.StringType(), T.DoubleType()))]
    return mapped(rows, score, T.StructType([*rows.schema.fields, *kinds]))


def accepted(
    docs: DataFrame, least_score=0.5, id_col="doc_id", text_col="text", lang_col="lang"
) -> DataFrame:
    """The rows of `docs`, all columns, with a language that scores at least `least_score`.

    The model is learned from the same rows; without any label nothing is accepted.
    """
    model = fit(learnable(docs, id_col, text_col, lang_col))
    scored = predict(docs, model, text_col, ("_lang_pred", "_lang_score"))
    good = (F.col("_lang_pred") != UNKNOWN) & (F.col("_lang_score") >= least_score)
    return scored.where(good).drop("_lang_pred", "_lang_score")


def identify(
    docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", grams=GRAMS
) -> DataFrame:
    """id, held_out, lang_pred and score of every row, by a model learned from the same rows.

    Null and letterless texts are `und` with score 0.0. A null id is not held out
    (null) and teaches nothing. Repeated rows give repeated results, count as often in
    the frequencies and are in the sample once. An empty table gives an empty result.
    """
    model = fit(learnable(docs, id_col, text_col, lang_col), grams)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = predict(own, model, grams=grams)
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "lang_pred", "score"
    )
