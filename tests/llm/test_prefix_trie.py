import hashlib
import random
import zlib

import pytest

from gaugeflow.llm import prefix_trie as module
from gaugeflow.llm.forward import SpillingQueue
from gaugeflow.llm.prefix_trie import prefix_trie
from tests.llm.conftest import as_sorted

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 string, idx long"


def brute(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [s[2:] for s in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c // 100 * 100, [])[:h] + own[h:])
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children, below = {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, own in members.items():
        saved = (len(own) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves, sums = below.get(node[:d], (0, 0))
            below[node[:d]] = (leaves + (node not in children), sums + saved)
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(whole[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
                    children.get(node, 0), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def forest(seed, convs=400, deep=0):
    """Conversations that share first turns with one another, copies among them, and odd rows."""
    rng, rows, known = random.Random(seed), [], [[]]
    for c in rng.sample(range(1000), convs):
        seq = list(rng.choice(known))[: rng.randrange(9)]
        seq += [(rng.choice(["user", "bot", None, ""]), rng.choice(["a", "bb", None, "c😀", "", f"t{c}"]))
                for _ in range(rng.randrange(1 if seq else 0, 4))]
        if rng.random() < 0.3:
            seq = [("user", "hello"), ("bot", "hi")]
        known.append(seq)
        rows += [(c, t if t else None, *turn) for t, turn in enumerate(seq)]
    rows += [(5000, 3, "b", "y"), (5000, 3, "a", "z"), (5000, 3, "a", "z"), (None, 0, "user", "lost")]
    rows += [(7000, t, "user", f"x{t % 3}") for t in range(deep)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "k", 9) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = forest(seed)
    out = prefix_trie(frame(spark, rows))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema][:7] == [
        (c, "bigint") for c in
        ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    ]
    assert as_sorted(out.collect()) == as_sorted(brute(rows))


@pytest.mark.parametrize("least,share,band", [(0, 3, 4), (0, 10**9, 2), (5, 50, 1), (30, 10, 100)])
def test_top_and_bands_change_nothing(spark, monkeypatch, least, share, band):
    """Few, most or all nodes in the top, which has one band or many."""
    monkeypatch.setattr(module, "LEAST_ROWS", least)
    monkeypatch.setattr(module, "TOP_SHARE", share)
    monkeypatch.setattr(module, "BAND", band)
    monkeypatch.setattr(module, "DIGEST_BYTES", 20)
    rows = forest(7, convs=150, deep=9)
    assert as_sorted(prefix_trie(frame(spark, rows)).collect()) == as_sorted(brute(rows))


def test_one_conversation_with_most_turns(spark):
    """Its turns are dealt over ranges, and its prefixes put together from them."""
    rows = forest(3, convs=60, deep=700)
    out = prefix_trie(frame(spark, rows), group_limit=50)
    assert as_sorted(out.collect()) == as_sorted(brute(rows))


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 90_000, 100) for t in range(3)]
    assert as_sorted(prefix_trie(frame(spark, rows)).collect()) == as_sorted(brute(rows))


def test_without_turns(spark):
    assert prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
    # Without conversation 0, its first turns are missing: 3 keeps what is after its own.
    lone = [(c, 0, "user", "x") for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 > 0]
    out = prefix_trie(frame(spark, lone)).collect()
    assert as_sorted(out) == as_sorted(brute(lone)) and len(out) == 1


@pytest.mark.parametrize("limit", [1, 3, 100])
def test_queue_spills(limit):
    rng, queue, held, popped = random.Random(limit), SpillingQueue(limit), [], 0
    for _ in range(3000):
        if held and rng.random() < 0.45:
            assert queue.least() == min(held)
            held.remove(queue.pop())
            popped += 1
        else:
            item = (rng.randrange(50), rng.randrange(3))
            queue.push(item)
            held.append(item)
    assert popped > 1000 and len(queue.heap) <= limit
    assert [queue.pop() for _ in range(len(held))] == sorted(held)
    assert queue.least() is None
