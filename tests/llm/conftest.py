import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, owner int, node string, words string"


def make_words(rng, count, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(count))


def hard_rows():
    """Nulls, blanks, repeats, ties, a long text, near copies, shared passages."""
    rng = random.Random(7)
    base = make_words(rng, 120, 10_000).split()
    passage = make_words(rng, 30, 10_000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", "en", None, 7),
        (None, "the only text without an id, and it is not short at all", "en", "a", None),
        (None, "the only text without an id, and it is not short at all", "en", "a", None),
        (4, "one", "de", "a", 3),
        (4, "one", "de", "a", 3),
        (5, "ONE", None, "b", 3),
        (6, "a b c d", "fr", "b", 7),
        (7, "a b c d e", "fr", "b", 9),
        (8, "été \U0001f600 中文 <|endoftext|> ▁x  y\n\n z ", "fr", "b", 30),
        (9, "x " * 300, "en", "b", 600),
        (10, "12345 67890 !!! ###", "en", "b", 19),
        (11, make_words(rng, 20_000), "en", "c", None),
    ]
    for k in range(40):
        copy = list(base)
        for _ in range(k % 6):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
        rows.append((100 + k, " ".join(copy), "en", "hot", None))
    for k in range(40):
        text = f"{make_words(rng, 15, 10**6)} {passage} {make_words(rng, rng.randrange(1, 40), 10**6)}"
        rows.append((200 + k, text, "de", "hot", None))
    rows.append((100, " ".join(base).upper(), "en", "hot", None))
    rng.shuffle(rows)
    return [(*r, 0.5, 1, "n", "w") for r in rows]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def as_sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
