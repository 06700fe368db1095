import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from gaugeflow.llm import language_id, ngrams
from gaugeflow.llm.ngrams import Grams
from gaugeflow.llm.queries import QUERIES
from tests.llm.conftest import pairs


def test_held_out_accuracy(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang", "text")
    rows = QUERIES["op9_language_id"](spark, medium).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    # Calibrated: the mean score is about the share of right answers.
    right = np.mean([r.lang == r.lang_pred for r in held])
    assert abs(np.mean([r.score for r in held]) - right) < 0.05


def test_labels_of_held_out_rows_teach_nothing(spark, docs):
    other = docs.withColumn(
        "lang", language_id.F.when(language_id.held_out("doc_id"), "xx").otherwise(docs.lang)
    )
    one, two = (
        sorted(tuple(r) for r in language_id.identify(d).collect()) for d in (docs, other)
    )
    assert [r[:3] for r in one] == [r[:3] for r in two]


def test_hard_rows(hard, empty):
    rows = language_id.identify(hard).collect()
    texts = pairs(hard)
    assert sorted(repr(r.doc_id) for r in rows) == sorted(repr(i) for i, _ in texts)
    letterless = {i for i, t in texts if i is not None and not any(map(str.isalpha, t or ""))}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == letterless
    assert all((r.score == 0.0) == (r.lang_pred == "und") and 0 <= r.score <= 1 for r in rows)
    assert language_id.identify(empty).count() == 0
    unlabelled = hard.withColumn("lang", language_id.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_accepted_keeps_columns(hard):
    out = language_id.accepted(hard)
    assert out.columns == hard.columns
    assert all(any(map(str.isalpha, t or "")) for _, t in pairs(out))


def test_ftrl_gives_sparse_weights_that_separate():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(300):
        label = int(rng.integers(3))
        noise = rng.choice(np.arange(10, 200), 5, replace=False)
        rows.append((np.r_[label, noise], np.ones(6), label))
    weights, bias = language_id.fit_ftrl(rows, 200, 3, l1=1.0)
    assert (weights[:3].argmax(axis=1) == np.arange(3)).all()
    assert (weights == 0).mean() > 0.5


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in language_id.softmax(logits)])
    assert 3.2 < language_id.fit_temperature(4 * logits, labels) < 5


SMALL = Grams(orders=(2, 3), bits=9, lower=True)


def plain_counts(text, grams):
    """Feature to number of occurrences, one n-gram at a time."""
    padded, out = f" {text.lower()} ", Counter()
    for k, n in enumerate(grams.orders):
        for at in range(len(padded) - n + 1):
            codes = np.array([ord(c) for c in padded[at : at + n]], dtype=np.uint32)
            out[int(grams.of_order(codes, k)[0])] += 1
    return out


def plain_softmax(logits):
    top = max(logits)
    powers = [math.exp(x - top) for x in logits]
    return [p / sum(powers) for p in powers]


def brute_model(rows, grams, alpha=0.3, beta=1.0, l1=0.02, l2=0.02, epochs=4):
    """Weights per (feature, language) in dictionaries, one number at a time."""
    counts = {r: plain_counts(r[1], grams) for r in rows}
    frequency = Counter(f for r in rows for f in counts[r])
    idf = {f: math.log((1 + len(rows)) / (1 + n)) + 1 if n >= min(2, len(rows)) else 0.0 for f, n in frequency.items()}
    languages = sorted({r[2] for r in rows})
    sample = sorted(set(rows), key=lambda r: (r[2], r[0], np.array(sorted(counts[r])).tobytes()))
    learned, kept = [], []
    for number, r in enumerate(sample):
        total = sum(counts[r].values())
        values = {f: language_id.SCALE * c / total * idf[f] for f, c in sorted(counts[r].items())}
        (kept if number % 5 == 4 else learned).append((values, languages.index(r[2])))
    z, n = defaultdict(float), defaultdict(float)

    def weight(f, c):
        if abs(z[f, c]) <= l1:
            return 0.0
        return (math.copysign(l1, z[f, c]) - z[f, c]) / ((beta + math.sqrt(n[f, c])) / alpha + l2)

    def logits(values):
        return [sum(x * weight(f, c) for f, x in values.items()) + weight("bias", c) for c in range(len(languages))]

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for at in order.permutation(len(learned)):
            values, label = learned[at]
            p = plain_softmax(logits(values))
            old = {(f, c): weight(f, c) for f in [*values, "bias"] for c in range(len(languages))}
            for (f, c), w in old.items():
                g = (values[f] if f != "bias" else 1.0) * (p[c] - (c == label))
                z[f, c] += g - (math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])) / alpha * w
                n[f, c] += g * g

    def loss(t):
        return -sum(math.log(max(plain_softmax([x / t for x in logits(v)])[label], 1e-300)) for v, label in kept)

    t = min(np.geomspace(0.05, 20.0, 121), key=loss) if kept else 1.0

    def predicted(text):
        if not any(map(str.isalpha, text or "")):
            return "und", 0.0
        found = plain_counts(text, grams)
        total = sum(found.values())
        values = {f: language_id.SCALE * c / total * idf.get(f, 0.0) for f, c in found.items()}
        p = plain_softmax([x / t for x in logits(values)])
        return languages[p.index(max(p))], max(p)

    return predicted


def test_equals_brute_force(spark, docs):
    rows = [(r.doc_id, r.text[:300] if r.text else r.text, r.lang) for r in docs.where("doc_id < 60").collect()]
    rows += [rows[3], rows[3], (1000, "", "en"), (1001, None, "en"), (1002, "123 !?", None), (1003, "wörtlich gesagt", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    teach = [r for r in rows if r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    predicted = brute_model(teach, SMALL)
    texts = {r[0]: r[1] for r in rows}
    out = language_id.identify(df, grams=SMALL).collect()
    assert len(out) == len(rows)
    for r in out:
        label, score = predicted(texts[r.doc_id])
        assert r.lang_pred == label and abs(r.score - score) < 1e-6


def learned_labels(spark, rows, **options):
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    sample = ngrams.bounded_sample(df, ["id", "text"], "lang", **options)
    return Counter(r.lang for r in sample.collect())


def test_repeated_ids_and_rows_are_drawn_as_what_they_are(spark):
    same_id = [(7, f"text {k}", "en") for k in range(4000)] + [(k, f"wort {k}", "de") for k in range(4000)]
    found = learned_labels(spark, same_id, per_label=600)
    assert 480 < found["en"] < 720 and 480 < found["de"] < 720
    same_row = [(7, "one text", "en")] * 4000 + [(k, f"wort {k}", "de") for k in range(50)]
    assert learned_labels(spark, same_row, per_label=600) == {"en": 1, "de": 50}


def test_sample_is_bounded_in_all(spark):
    rows = [(k, f"text {k}", f"l{k % 1200}") for k in range(12_000)]
    assert len(learned_labels(spark, rows, per_label=600)) == 1200
    found = learned_labels(spark, rows, per_label=600, most=3000)
    assert 1000 < sum(found.values()) < 3300 and len(found) > 900


def test_many_languages_are_all_learned(spark):
    """More labels than a fixed list would hold; every language has letters of its own."""
    rng = np.random.default_rng(0)
    rows = []
    for label in range(1200):
        letters = [chr(0x4E00 + 3 * label + j) for j in range(3)]
        for j in range(4):
            text = "".join(rng.choice(letters, 8))
            rows.append((label * 4 + j, text, f"l{label:04}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(language_id.learnable(df), Grams(orders=(2,), bits=12, lower=True))
    teach = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert model.languages == sorted(teach) and len(teach) > 1100
