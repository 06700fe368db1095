import random

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import decontamination
from tests.llm import brute
from tests.llm.conftest import SCHEMA, make_words, pairs


def found(docs, items):
    out = decontamination.leaked_items(docs, items)
    assert out.columns == ["doc_id", "item_id", "similarity", "start", "n_words"]
    rows = out.collect()
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in rows}
    assert len(got) == len(rows)
    return got


def items_of(df):
    return [(r.item_id, r.text) for r in df.collect()]


def test_equals_brute_force(spark, small, docs):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    assert found(docs, items) == brute.leaks(pairs(docs), items_of(items))


@pytest.fixture(scope="module")
def planted(spark):
    """Items of many sizes in documents, with edits on both sides of the threshold."""
    rng = random.Random(11)
    items = [(k, make_words(rng, size, 5000)) for k, size in enumerate((3, 4, 5, 6, 9, 15, 30, 30, 60, 150))]
    items += [(20, "so so so so so so so so so so so so"), (21, items[5][1].upper() + "!"), (22, None), (23, ""), (24, "?!")]
    rows = []
    for k in range(120):
        words = rng.choice(items[:11])[1].split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["new"], [words[at], "more"], [words[at].upper() + ","]])
        around = [make_words(rng, rng.choice([0, 3, 50]), 5000) for _ in range(2)]
        rows.append((k, f"{around[0]} {' '.join(words)} {around[1]}"))
    rows += [(500, None), (501, ""), (502, "..."), (503, items[0][1]), (503, items[0][1])]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_planted_edits(planted):
    docs, items = planted
    expected = brute.leaks(dict(pairs(docs)).items(), items_of(items))
    assert len(expected) > 40
    assert found(docs, items) == expected


def test_shuffled_joins_change_nothing(planted, monkeypatch):
    docs, items = planted
    expected = found(docs, items)
    monkeypatch.setattr("gaugeflow.llm.scale.BROADCAST_BYTES", -1)
    monkeypatch.setattr(decontamination, "counted_broadcast", lambda table, *_: table)
    assert found(docs, items) == expected


def test_blocks_hold_all_within_the_radius():
    rng = random.Random(5)
    for _ in range(2000):
        flips = rng.sample(range(64), rng.randrange(decontamination.RADIUS + 1))
        mask = sum(1 << b for b in flips)
        blocks = [(mask >> (8 * b)) & 255 for b in range(decontamination.BLOCKS)]
        assert any(b in decontamination._NEIGHBOURS for b in blocks)


def test_fingerprints_are_majorities(spark):
    texts = [(0, ["a", "b"]), (1, [f"w{i}" for i in range(40)])]
    df = spark.createDataFrame(texts, "k int, words array<string>")
    hashes = df.select("k", decontamination.grams_of(F.col("words"), F.xxhash64).alias("h")).collect()
    prints = {r.k: r.print for r in decontamination.fingerprints(df, ["k"]).collect()}
    for r in hashes:
        ones = [sum((h >> b) & 1 for h in r.h) for b in range(64)]
        value = sum(1 << b for b in range(64) if 2 * ones[b] > len(r.h))
        assert prints[r.k] % (1 << 64) == value


def test_rows_without_leaks(spark, hard, empty):
    leak = hard.where("doc_id = 120").first().text
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    out = decontamination.without_leaks(hard, items)
    assert out.columns == hard.columns
    dirty = {d for d, _ in brute.leaks(pairs(hard), [(1, leak)])}
    assert 120 in dirty and len(dirty) > 5
    assert sorted(map(repr, pairs(out))) == sorted(repr(p) for p in pairs(hard) if p[0] not in dirty)
    assert decontamination.without_leaks(empty, items).count() == 0
    assert decontamination.without_leaks(hard, items.limit(0)).count() == hard.count()
    assert empty.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_no_python_in_the_plan(spark, small, docs):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    plan = decontamination.leaked_items(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_short_items_are_found_inside_documents(spark):
    """The first place of the same words in a row, in documents of any length."""
    items = spark.createDataFrame(
        [(1, "alpha beta gamma"), (2, "beta"), (3, "one two three four"), (4, "x y"), (5, "a b c d e f")],
        "item_id long, text string",
    )
    rows = [
        (10, "say alpha beta gamma to the other nine words here"), (11, "Alpha, beta; GAMMA!"), (12, "alpha beta"),
        (13, "beta " * 3000 + "x y x y"), (14, "one two three four"), (15, "zero one two three four five"),
        (16, "alpha gamma beta"), (17, "y x"), (18, "a b c d e f x y"), (None, "x y"), (19, "x"), (20, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(docs, items)
    assert got == brute.leaks(rows, items_of(items))
    assert got[10, 1] == (1.0, 1) and got[13, 4] == (1.0, 3000) and got[13, 2] == (1.0, 0) and (12, 1) not in got
    kept = {r.doc_id for r in decontamination.without_leaks(docs, items).collect()}
    assert kept == {17, 19, 20}
