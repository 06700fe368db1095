import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeflow.llm import token_counts
from tests.llm.conftest import as_sorted, pairs

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Ee\n\t▁é中<s>/0.'\U0001f600\x00"), max_size=40), max_size=5))
def test_counts_equal_the_library(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert token_counts.counter(MODEL).counts(texts) == [len(model.encode(t)) for t in texts]


def test_proved_parts_are_single_tokens(library):
    alone = token_counts.counter(MODEL).alone
    assert len(alone) > 20_000
    for part in list(alone)[::500]:
        assert alone[part] == len(library.encode(part[1:] if part[0] == " " else part)) - (part[0] == "\n") or part == " "


def test_small_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    own = token_counts.PartCounter(MODEL)
    texts = [f"zq{i} xv{i % 4}\nkj{i}" for i in range(50)]
    assert [own.counts([t])[0] for t in texts] == [len(library.encode(t)) for t in texts]
    assert own.counts(texts) == [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("name", ["docs", "hard", "empty"])
def test_rows(request, library, name):
    df = request.getfixturevalue(name)
    out = token_counts.token_counts(df, MODEL, limit=100)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for i, t in pairs(df):
        n = len(library.encode(t or ""))
        expected.append((i, len((t or "").encode()), n, n > 100))
    assert as_sorted(out.collect()) == as_sorted(expected)
