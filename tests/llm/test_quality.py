import math
import zlib

import numpy as np
import pytest

from gaugeflow.llm import quality_classifier, quality_rules
from gaugeflow.llm.ngrams import Grams
from gaugeflow.llm.oracles import ORACLES
from gaugeflow.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.llm.conftest import as_sorted, pairs


def test_rules_equal_sql_on_hard_rows(spark, hard, tmp_path):
    hard.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    out = QUERIES["op8_quality_rules"](spark, str(tmp_path))
    assert differences(out, con, ORACLES["op8_quality_rules"]) == ""


def test_rules_on_no_rows(empty):
    assert quality_rules.quality_rules(empty).count() == 0


def test_rules_are_expressions(hard):
    plan = quality_rules.quality_rules(hard)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan


def test_rules_sort_good_from_bad(spark, medium):
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    out = QUERIES["op8_quality_rules"](spark, medium).join(labels, "doc_id")
    good = out.where("quality = 1 AND NOT base_failed")
    bad = out.where("quality = 0")
    assert good.where("kept").count() >= 0.98 * good.count()
    assert bad.where("kept").count() <= 0.05 * bad.count()


def test_repeated_words_by_hand(spark):
    text = " ".join("abcdefgh") + " x " + " ".join("abcdefgh") + " y"
    rows = [(1, text), (2, "z " * 9), (3, "z " * 8), (4, "q " * 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.quality_rules(df).collect()}
    assert got == {1: 16, 2: 9, 3: 0, 4: 0}


def test_classifier_on_held_out_rows(spark, medium):
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    out = QUERIES["op5_quality_classifier"](spark, medium)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    found = out.where("held_out").join(labels, "doc_id").select("quality", "score", "predicted").collect()
    right = sum(r.quality == r.predicted for r in found) / len(found)
    good = [r.score for r in found if r.quality == 1]
    bad = [r.score for r in found if r.quality == 0]
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert right > 0.93 and above > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_classifier_ignores_labels_of_held_out_rows(spark, docs, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    turned = labels.withColumn(
        "quality", quality_classifier.F.when(quality_classifier.held_out("doc_id"), 1 - labels.quality).otherwise(labels.quality)
    )
    one, two = (quality_classifier.score(docs, x).collect() for x in (labels, turned))
    assert as_sorted(one) == as_sorted(two)


def test_classifier_on_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i, _ in pairs(hard) if i is not None] + [(None, 1, 0), (9, None, 0), (9, 7, 0), (10**6, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality_classifier.score(hard, labels).collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(repr(i) for i, _ in pairs(hard))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all((r.held_out is None) == (r.doc_id is None) for r in rows)
    same = {r.score for r in rows if r.doc_id == 4}
    assert len(same) == 1
    assert {r.score for r in quality_classifier.score(hard, labels.limit(0)).collect()} == {0.0}
    assert quality_classifier.score(empty, labels).count() == 0


@pytest.mark.parametrize("per_class", [1, 3])
def test_samples_are_bounded(spark, docs, small, per_class):
    labels = spark.read.parquet(f"{small}/labels.parquet").withColumnRenamed("doc_id", "id")
    known = labels.select("id", labels.quality.alias("label"))
    own = docs.select(docs.doc_id.alias("id"), "text")
    space = quality_classifier.fit(own, known, per_class=per_class)
    assert space is None or len(space.labels) <= 8 * per_class


def plain_vote(space, text, grams, k):
    """One text against every labelled vector, in plain numbers; the sample's order breaks ties."""
    found = {}
    padded = f" {text or ''} "
    for order, n in enumerate(grams.orders):
        for at in range(len(padded) - n + 1):
            codes = np.array([ord(c) for c in padded[at : at + n]], dtype=np.uint32)
            f = int(grams.of_order(codes, order)[0])
            found[f] = found.get(f, 0) + 1
    values = {f: math.log1p(c) * float(space.idf[f]) for f, c in found.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    repeats = quality_classifier.repetition([text])[0]
    tail = [quality_classifier.REPETITION * float(r) for r in repeats]
    vector = [
        sum(v / length * float(space.axes[f, j]) for f, v in values.items() if length > 1e-9)
        + sum(t * float(space.axes[grams.size + i, j]) for i, t in enumerate(tail))
        for j in range(space.axes.shape[1])
    ]
    length = math.sqrt(sum(v * v for v in vector))
    if length <= 1e-9:
        return space.prior
    near = []
    for number, other in enumerate(space.vectors):
        similar = sum(a / length * float(b) for a, b in zip(vector, other))
        near.append((-round(similar / quality_classifier.STEP), number))
    weights = [(max(-s * quality_classifier.STEP, 0.0) ** quality_classifier.SHARPNESS, n) for s, n in sorted(near)[:k]]
    total = sum(w for w, _ in weights)
    return sum(w * float(space.labels[n]) for w, n in weights) / total if total else space.prior


def test_votes_equal_brute_force(spark, docs, small):
    grams = Grams(orders=(1, 2), bits=8, lower=False)
    own = docs.where("doc_id < 150").select(docs.doc_id.alias("id"), docs.text.substr(1, 400).alias("text"))
    labels = spark.read.parquet(f"{small}/labels.parquet").selectExpr("doc_id AS id", "quality AS label")
    space = quality_classifier.fit(own, labels, grams)
    texts = [r.text for r in own.limit(60).collect()] + ["", None, "x", " \n", "z z z z", "wow\nwow\nwow"]
    counts = np.array([np.bincount(f, minlength=grams.size) for f in grams.per_text(texts)], dtype=np.float32)
    found = quality_classifier.vote(space, counts, quality_classifier.repetition(texts))
    for text, score in zip(texts, found):
        assert abs(score - plain_vote(space, text, grams, quality_classifier.NEIGHBOURS)) < 2e-3


def test_first_of_equal_neighbours_count():
    """Twenty equal vectors, the first fifteen of label 1: blocks of any size say the same."""
    grams = Grams(orders=(1,), bits=4, lower=False)
    rng = np.random.default_rng(0)
    axes = rng.standard_normal((grams.size + 2, 3)).astype(np.float32)
    one = quality_classifier.unit(rng.standard_normal((1, 3)).astype(np.float32))
    labels = np.array([1.0] * 15 + [0.0] * 5, dtype=np.float32)
    space = quality_classifier.Space(np.ones(grams.size, np.float32), axes, np.repeat(one, 20, axis=0), labels, 0.5)
    counts = rng.integers(0, 3, (50, grams.size)).astype(np.float32)
    repeats = np.zeros((50, 2), np.float32)
    whole = quality_classifier.vote(space, counts, repeats)
    parts = np.concatenate([quality_classifier.vote(space, counts[i : i + 1], repeats[:1]) for i in range(50)])
    assert np.array_equal(whole, parts) and set(whole) <= {0.5, 1.0} and 1.0 in whole


def test_one_text_of_an_id_teaches(spark):
    rows = [(1, f"same id {k}") for k in range(300)] + [(k, f"text {k}") for k in range(2, 60)]
    docs = spark.createDataFrame(rows, "id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 60)], "id long, label int")
    space = quality_classifier.fit(docs, labels, Grams(orders=(1, 2), bits=8, lower=False))
    known = [k for k in range(1, 60) if zlib.crc32(str(k).encode()) % 5]
    assert len(space.labels) == len(known) and space.labels.sum() == sum(k % 2 for k in known)
