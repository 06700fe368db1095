import random

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import substring_dedup
from tests.llm import brute
from tests.llm.conftest import as_sorted, pairs


def result(df, n=13, m=4):
    kept = substring_dedup.drop_repeats(df, n=n, m=m)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))


def expected(rows, n=13):
    return [(i, *found) for (i, _), found in zip(rows, brute.kept_words(rows, n))]


@pytest.mark.parametrize("name", ["docs", "hard", "empty"])
def test_equals_brute_force(request, name):
    df = request.getfixturevalue(name)
    assert as_sorted(result(df).collect()) == as_sorted(expected(pairs(df)))


@pytest.mark.parametrize("seed", range(3))
def test_many_repeats_in_small_chunks(spark, monkeypatch, seed):
    """Few words, so windows repeat within and across texts, ids and blocks."""
    monkeypatch.setattr(substring_dedup, "SEND_BYTES", 300)
    monkeypatch.setattr(substring_dedup, "CHUNK_WINDOWS", 20)
    monkeypatch.setattr(substring_dedup, "FLUSH_BYTES", 2000 * seed)
    monkeypatch.setattr(substring_dedup, "REMEMBERED", 5)
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, *range(30)]), " ".join(rng.choices("abc", k=rng.randrange(40))))
        for _ in range(80)
    ]
    split = [w for _, t in rows for w in [t.split()]]
    assert any(len(w) > 13 for w in split)
    batches = [_batch(rows)]
    sent = [b for b in substring_dedup.send(batches, 5, 2, 7) if b.num_rows]
    loads = sorted((r for b in sent for r in b.to_pylist()), key=lambda r: r["sub"])
    found = list(substring_dedup.compare([_loads(loads)], 5))
    ranges = {}
    for b in found:
        for r in b.to_pylist():
            ranges.setdefault((r["owner"], r["row"]), []).append(r)
    keyed = _batch(rows).to_pylist()
    for (_, text), key, (n_words, n_removed, _) in zip(rows, keyed, brute.kept_words(rows, 5)):
        got = substring_dedup.keep_words(text, ranges.get((key["owner"], key["row"])), 5)
        assert got[:2] == (n_words, n_removed)


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(
        [{"owner": brute.number(i), "row": k, "text": t} for k, (i, t) in enumerate(rows)],
        pa.schema([("owner", pa.int64()), ("row", pa.int32()), ("text", pa.string())]),
    )


def _loads(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(
        rows, pa.schema([("sub", pa.int32()), ("settled", pa.bool_()), ("load", pa.binary())])
    )


def test_equal_runs_travel_once_per_task():
    """A passage of a thousand texts reaches its bucket once, with the least id."""
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(i, passage) for i in range(1000, 0, -1)]
    owners = []
    for batch in substring_dedup.send([_batch(rows)], 13, 4, 3):
        for r in batch.to_pylist():
            if not r["settled"]:
                owners += substring_dedup._unpacked(r["load"])[0].tolist()
    assert set(owners) == {1}


def around_a_phrase(count=400):
    """Texts that share four words, each amid words of its own; every tenth text is an edge of the one before."""
    rng, rows = random.Random(9), []
    for i in range(count):
        text = [f"u{rng.randrange(10**9)}" for _ in range(12)] + ["a", "very", "common", "phrase"]
        text += [f"u{rng.randrange(10**9)}" for _ in range(12)]
        if i % 10 == 9:
            text = rows[-1][1].split()[:20] + text[20:]
        rows.append((i, " ".join(text)))
    return rows


def test_windows_of_a_hot_minimiser_are_dealt_by_their_own_words():
    rows = around_a_phrase()
    counts = {}
    for b in substring_dedup.minimiser_counts([_batch(rows)], 13, 4):
        for r in b.to_pylist():
            counts[r["minimiser"]] = counts.get(r["minimiser"], 0) + r["windows"]
    top = max(counts, key=counts.get)
    assert counts[top] > 300 and sorted(counts.values())[-2] < 100
    shares, removed = [], []
    for hot in ([], [top % 2**64]):
        loads = [r for b in substring_dedup.send([_batch(rows)], 13, 4, 16, hot) for r in b.to_pylist()]
        sizes = {r["sub"]: int(substring_dedup._unpacked(r["load"])[3].sum()) for r in loads if not r["settled"]}
        shares.append(max(sizes.values()) / (sum(sizes.values()) / 16))
        found = substring_dedup.compare([_loads(sorted(loads, key=lambda r: r["sub"]))], 13)
        removed.append({(r["owner"], k) for b in found for r in b.to_pylist() for k in range(r["first"], r["first"] + r["windows"])})
    assert shares[1] < 1.3 < shares[0]
    assert removed[0] == removed[1] and removed[0]


def test_hot_minimisers_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 100)
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    rows = around_a_phrase() + [(1000 + k, " ".join(f"p{j}" for j in range(30 + k % 3))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.select(F.col("doc_id").alias("owner"), F.hash("text").alias("row"), "text")
    assert len(substring_dedup.measured(keyed, 13, 4)[1]) > 1
    assert as_sorted(result(df).collect()) == as_sorted(expected(rows))


def test_rows_whose_short_hashes_are_equal_stay_apart(spark):
    """Two texts without an id and with one 32-bit hash: only the one that repeats loses words."""
    tail = " ".join(f"t{k}" for k in range(14))
    texts = spark.range(400_000).selectExpr(f"concat('u', id, ' v', id, ' {tail} x', id) AS text")
    texts = texts.withColumn("h", F.hash("text"))
    pair = texts.groupBy("h").agg(F.collect_list("text").alias("t")).where("size(t) > 1").first().t
    df = spark.createDataFrame([(1, pair[0]), (None, pair[0]), (None, pair[1])], "doc_id long, text string")
    assert as_sorted(result(df).collect()) == as_sorted(expected(pairs(df)))
