import random

import numpy as np
import pyarrow as pa
import pytest

from gaugeflow.llm import near_dedup
from gaugeflow.llm.components import components
from tests.llm import brute
from tests.llm.conftest import as_sorted, make_words, pairs


def expected(rows, percent=85):
    return [(i, *found) for (i, _), found in zip(rows, brute.near_components(rows, percent))]


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("name", ["docs", "hard", "empty"])
def test_equals_brute_force(request, name, percent):
    df = request.getfixturevalue(name)
    out = near_dedup.near_duplicates(df, threshold=percent / 100)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert as_sorted(out.collect()) == as_sorted(expected(pairs(df), percent))


def near_rows(seed, count=300):
    """Chains of edits around a few bases, with similarities on both sides of the threshold."""
    rng = random.Random(seed)
    rows, texts = [], [make_words(rng, rng.randrange(8, 90), 10**6).split() for _ in range(6)]
    for k in range(count):
        text = list(rng.choice(texts))
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        texts.append(text)
        rows.append((rng.randrange(10**6), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_chunks_change_nothing(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dedup, "CHUNK_NODES", 5)
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 300)
    rows = near_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_sorted(near_dedup.near_duplicates(df).collect()) == as_sorted(expected(rows))


def test_one_of_each_keeps_columns_and_one_row(hard):
    out = near_dedup.one_of_each(hard)
    assert out.columns == hard.columns
    rows = pairs(hard)
    groups = {c for (i, t), (n, c, _) in zip(rows, brute.near_components(rows, 85)) if n}
    left = pairs(out)
    assert len([t for _, t in left if brute.shingles(t)]) == len(groups)
    blank = [r for r in rows if not brute.shingles(r[1])]
    assert as_sorted(r for r in left if not brute.shingles(r[1])) == as_sorted(blank)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    for size, shared in ((7, 6), (60, 54), (600, 552), (5000, 4600)):
        matches = []
        for _ in range(60):
            x = rng.integers(1, 1 << 63, size=2 * size - shared).astype(np.uint64)
            a, b = np.sort(x[:size]), np.sort(x[size - shared :])
            equal = (near_dedup.registers(a) == near_dedup.registers(b)).sum()
            matches.append(near_dedup.estimated(equal, size, np.array([size]))[0])
        assert abs(np.mean(matches) - shared / (2 * size - shared)) < 0.04


def test_chance_matches_are_corrected():
    rng = np.random.default_rng(4)
    found = []
    for _ in range(300):
        a, b = (np.sort(rng.integers(1, 1 << 63, size=500).astype(np.uint64)) for _ in range(2))
        equal = (near_dedup.registers(a) == near_dedup.registers(b)).sum()
        found.append(near_dedup.estimated(equal, 500, np.array([500]))[0])
    assert abs(np.mean(found)) < 1e-3


def test_groups_are_never_cut():
    rows = [{"k": k, "v": v} for k in range(20) for v in range(k % 5 + 1)]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 3]) for i in range(0, len(rows), 3)]
    seen = []
    for table, heads in near_dedup.keyed_groups(iter(batches), ("k",), 40):
        keys = table.column("k").to_pylist()
        assert [keys[h] for h in heads] == sorted(set(keys))
        seen.append(set(keys))
    assert sum(map(len, seen)) == 20


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 299), (299, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, **{200 + i: 100 for i in range(50)}, 299: 299, 300: 299}
    assert components(df.limit(0)).count() == 0


def test_constants_follow_the_threshold():
    assert [near_dedup.least_linked(t) for t in (0.8, 0.85, 0.9)] == [4, 6, 9]
    assert 0.54 < near_dedup.least_estimate(0.8) < 0.57 and 0.6 < near_dedup.least_estimate(0.85) <= 0.63
    for threshold in (0.79, 1):
        with pytest.raises(ValueError):
            near_dedup.least_estimate(threshold)


def linked_from(rows, threshold):
    """Least id of each row's component; every pair is compared."""
    sets = [brute.shingles(t) for _, t in rows]
    name = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if len(sets[x] & sets[y]) >= threshold * len(sets[x] | sets[y]) and name[x] != name[y]:
                name = [name[y] if n == name[x] else n for n in name]
    return [min(rows[k][0] for k in range(len(rows)) if name[k] == n) for n in name]


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_links_from_the_threshold_on(spark, threshold):
    words = [f"w{k}" for k in range(100)]
    two_changed = [f"z{k}" if k in (30, 60) else w for k, w in enumerate(words)]
    short = [f"s{k}" for k in range(9)]
    # 86 of 106 shingles and 4 of 5.
    rows = [(1, " ".join(words)), (2, " ".join(two_changed)), (3, " ".join(short)), (4, " ".join(short[:8]))]
    rows += [(10 + i, t) for i, (_, t) in enumerate(near_rows(5, 150))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_dedup.near_duplicates(df, threshold=threshold)
    got = {r.doc_id: r.component_id for r in out.collect()}
    assert got == dict(zip([i for i, _ in rows], linked_from(rows, threshold)))
    assert (got[2], got[4]) == ((1, 3) if threshold == 0.8 else (2, 4))
