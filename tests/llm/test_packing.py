import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeflow.llm import packing, token_ids
from tests.llm.conftest import as_sorted, pairs

MODEL = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(st.sampled_from("ab eE'st\n\t é中09.<|　\U0001f600"), max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_equal_the_library(text):
    for t in (text, text + "<|endoftext|>" + text):
        own = token_ids.encoder(MODEL).ids(t).tolist()
        assert own == token_ids.encoder(MODEL).library.encode(t, add_special_tokens=False).ids


def test_ranks_are_used_for_this_file_only():
    assert token_ids.encoder(MODEL).fast is not None
    other = token_ids.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None and len(other.ids("Some words")) > 0


def test_every_code_point_has_the_same_ids(library):
    own = token_ids.encoder(MODEL)
    for c in [*range(0xD800), *range(0xE000, 0x20000, 3)]:
        text = f"a{chr(c)}b {chr(c)}1\n"
        assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def check_plan(histogram, capacity):
    ranges, sequences = packing.plan(histogram, capacity)
    space, used = defaultdict(list), Counter()
    for length, first, last, sequence, per, place in ranges:
        assert first == used[length]
        for slot in range(last - first + 1):
            space[sequence + slot // per].append((place + slot % per * length, length))
        used[length] = last + 1
    assert used == Counter(histogram)
    for places in space.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(space) == list(range(sequences))
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), min_size=1, max_size=12))
def test_plans_place_every_piece_once(histogram):
    sequences = check_plan(histogram, 32)
    assert sequences <= 2 * math.ceil(sum(a * n for a, n in histogram.items()) / 32)


def test_plans_are_near_the_bound_and_small():
    rng = random.Random(2)
    lengths = [min(1024, 1 + int(rng.expovariate(1 / 420))) for _ in range(200_000)]
    histogram = dict(Counter(lengths))
    sequences = check_plan(histogram, 1024)
    assert sequences <= 1.002 * sum(lengths) / 1024 + 2
    assert len(packing.plan(histogram)[0]) < 20_000
    assert packing.plan({})[1] == 0


@pytest.mark.parametrize("name", ["docs", "hard", "empty"])
def test_pieces(request, library, name):
    df = request.getfixturevalue(name)
    rows = packing.pack_documents(df, MODEL, 2).collect()
    expected = []
    for i, text in pairs(df):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        count = math.ceil(len(ids) / 1024)
        start = 0
        for piece in range(count):
            length = 1024 if piece else len(ids) - (count - 1) * 1024
            data = np.array(ids[start : start + length], dtype="<u4").tobytes()
            expected.append((i, piece, start, length, zlib.crc32(data)))
            start += length
    assert as_sorted(tuple(r)[:5] for r in rows) == as_sorted(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(places) <= math.ceil(total / 1024) * 1.05 + 1


def test_sequences_hold_their_pieces(spark, hard):
    pieces = packing.token_pieces(hard, MODEL, 2, keep_ids=True)
    packed = packing.pack(pieces).cache()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.assemble(packed).collect()}
    for r in packed.collect():
        part = whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]
        assert part == bytes(r.ids) and zlib.crc32(part) == r.ids_crc32


def counted(lengths, capacity=1024):
    """Pieces by length, as the operator cuts them."""
    return Counter(length for n in lengths for _, length in packing.cut(int(n), capacity))


def test_all_patterns_of_a_full_histogram_are_candidates():
    found = packing.patterns(range(1, 1024), 1024)
    assert set(map(len, found)) == {2, 3} and all(sum(p) == 1024 and list(p) == sorted(p) for p in found)
    # Partitions of n into two parts, and into three: the nearest whole number to n * n / 12.
    assert len(set(found)) == len(found) == 512 + round(1024**2 / 12)


@pytest.mark.parametrize("count,middle,most", [(20_000, 5.5, 8), (300_000, 5.5, 12), (10_000, 6.5, 4)])
def test_fitted_patterns_make_most_sequences(count, middle, most):
    lengths = np.clip(np.random.default_rng(1).lognormal(middle, 1.0, count).astype(int), 1, None)
    histogram = counted(lengths)
    fitted = packing.fit_counts(packing.patterns(sorted(set(histogram) - {1024}), 1024), {a: n for a, n in histogram.items() if a < 1024})
    assert len(fitted) <= len(histogram) and all(n > 0 for _, n in fitted)
    assert len({p for p, _ in fitted}) == len(fitted)
    sequences = packing.plan(histogram)[1]
    rest = sequences - histogram[1024]
    assert sum(int(n) for _, n in fitted) > 0.85 * rest
    assert sequences <= -(-sum(a * n for a, n in histogram.items()) // 1024) + most


@pytest.mark.parametrize("seed", range(4))
def test_fit_has_the_least_misfit(seed):
    """No pattern's count can be changed to a smaller misfit."""
    rng = random.Random(seed)
    histogram = {a: rng.randrange(1, 500) for a in rng.sample(range(1, 40), 20)}
    found = packing.patterns(sorted(histogram), 40)
    fitted = dict(packing.fit_counts(found, histogram))
    left = Counter(histogram)
    for p, n in fitted.items():
        for a in p:
            left[a] -= n
    for p in found:
        slope = sum(left[a] for a in p)
        assert slope <= 2 and (p not in fitted or abs(slope) < 1e-3)
