import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeflow.llm import token_files, wavelet
from gaugeflow.llm.queries import QUERIES
from gaugeflow.llm.wavelet import Damaged, Wavelet, encode
from gaugeflow.llm.word_ids import WordEncoder
from tests.llm.conftest import as_sorted, pairs

MODEL = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(MODEL)


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def expected(rows):
    """(id, start, size, check sum) in id order; rows of one id are told apart by the caller."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library_ids(text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("size,values", [(0, 1), (1, 1), (300, 1), (5000, 2), (5000, 49408), (70_000, 9)])
def test_wavelet_answers(monkeypatch, size, values, seed):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1024)
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, values, size).astype(np.uint32) ** 2 % np.uint32(values)
    file = Wavelet(encode(ids, ["a"], [size], part=3))
    assert file.head["part"] == 3 and file.names == ["a"] and list(file.lengths) == [size]
    assert np.array_equal(file.ids(), ids)
    some = rng.integers(0, size, 50) if size else np.zeros(0, int)
    assert np.array_equal(file.access(some), ids[some])
    for token in {0, 1, values - 1, values, 1 << 20, *map(int, ids[:3])}:
        first, last = sorted(map(int, rng.integers(0, size + 1, 2)))
        assert file.count(token) == (ids == token).sum()
        assert file.count(token, first, last) == (ids[first:last] == token).sum()
        assert np.array_equal(file.locate(token), np.flatnonzero(ids == token))
        assert np.array_equal(file.locate(token, first, last), first + np.flatnonzero(ids[first:last] == token))
    with pytest.raises(IndexError):
        file.access([size])


def test_small_questions_open_few_blocks(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1024)
    opened, block = [], wavelet.Plane.block
    monkeypatch.setattr(wavelet.Plane, "block", lambda self, k: opened.append(k) or block(self, k))
    ids = np.random.default_rng(0).integers(0, 1000, 100_000).astype(np.uint32)
    file = Wavelet(encode(ids, [], []))
    assert file.access([77_777])[0] == ids[77_777] and file.count(5, 10, 90_000) >= 0
    assert len(opened) <= 7 * len(file.planes) and len(file.planes) == 10


def test_damage_is_noticed():
    data = bytearray(encode(np.arange(5000, dtype=np.uint32), ["x"], [5000]))
    for at in (0, 20, len(data) // 2, len(data) - 3):
        bad = bytearray(data)
        bad[at] ^= 255
        with pytest.raises(Damaged):
            Wavelet(bytes(bad)).ids()
    with pytest.raises(Damaged):
        Wavelet(bytes(data[:-4]))


def random_text(rng):
    letters = "abcXYZ  \t\n\x0b\x1c\x85  '’!?.,-019éÉßΣςσİıǅ́‍中文🙂﻿<|"
    words = ["it's", "I'LL", "'re", "--'s", "<|endoftext|>", "<|STARTOFTEXT|>", "ΟΔΟΣ", "don't've"]
    parts = [rng.choice(words) if rng.random() < 0.1 else rng.choice(letters) for _ in range(rng.randrange(60))]
    return "".join(parts)


def test_ids_equal_the_library(docs):
    own, rng = WordEncoder(MODEL), random.Random(5)
    assert own.by_words
    texts = [t for _, t in pairs(docs)] + [random_text(rng) for _ in range(4000)]
    for text in texts:
        assert own.ids(text).tolist() == library_ids(text)[:-1], repr(text)


def test_other_files_go_to_the_library():
    own = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not own.by_words
    assert own.ids("two  words\n").tolist() == other.encode("two  words\n", add_special_tokens=False).ids


def test_query_equals_brute_force(spark, small, docs):
    out = QUERIES["op13_token_files"](spark, small)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert as_sorted(out.collect()) == as_sorted(expected(pairs(docs)))


@pytest.mark.parametrize("shard_tokens", [1, 200, 1 << 21])
def test_hard_rows(spark, tmp_path, hard, shard_tokens):
    path = f"{tmp_path}/files"
    token_files.write_token_files(hard, path, MODEL, 1, shard_tokens=shard_tokens)
    out = token_files.read_token_files(spark, path).collect()
    whole = sorted(out, key=lambda r: r.start)
    ids = [r.doc_id for r in whole]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in whole] == [0, *np.cumsum([r.n_tokens for r in whole])[:-1]]
    read = sorted((str(r.doc_id), list(np.frombuffer(r.ids, "<u4"))) for r in whole)
    assert read == sorted((str(i), library_ids(t)) for i, t in pairs(hard))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in whole)
    if shard_tokens == 200:
        assert len(glob.glob(f"{path}/part-*")) > 20


def test_questions_over_files(spark, tmp_path, hard):
    path = f"{tmp_path}/files"
    token_files.write_token_files(hard, path, MODEL, 1, shard_tokens=500)
    ids = np.concatenate([
        np.frombuffer(r.ids, "<u4")
        for r in sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    ])
    tokens = [1, int(ids[0]), int(ids[-2]), 49_000, 10**9]
    counted = {r.token_id: r.n for r in token_files.token_frequencies(spark, path, tokens).collect()}
    assert counted == {t: int((ids == t).sum()) for t in tokens}
    found = token_files.token_occurrences(spark, path, tokens[:3]).collect()
    assert sorted((r.token_id, r.position) for r in found) == sorted(
        (t, int(p)) for t in set(tokens[:3]) for p in np.flatnonzero(ids == t)
    )
    asked = [0, 0, 5, len(ids) - 1, len(ids), -1, *range(100, 2000, 13)]
    df = spark.createDataFrame([(p,) for p in asked], "position long")
    answers = token_files.tokens_at(spark, path, df).collect()
    assert as_sorted(answers) == as_sorted((p, int(ids[p])) for p in asked if 0 <= p < len(ids))


def test_empty_table(spark, tmp_path, empty):
    path = f"{tmp_path}/files"
    token_files.write_token_files(empty, path, MODEL, 1)
    assert token_files.read_token_files(spark, path).count() == 0
    assert token_files.token_frequencies(spark, path, [1]).count() == 0
