import random

import pytest

from tidemark.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


#: Nulls, empty and blank texts, one word, ties, repeated rows, case, symbols, non-ASCII, a long text.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n \x0b\x0c\r"),
    (4, "one"),
    (5, "One"),
    (6, "a b"),
    (7, "ñandú 中文  x ﬁ 😀 #*$%&|<> a​b"),
    (8, "r s t\nu v w\nx y z\nr s t\nu v w\nx y z\nend"),
    (8, "r s t\nu v w\nx y z\nr s t\nu v w\nx y z\nend"),
    (9, "another text under one id, " * 4),
    (9, "a second text under one id, " * 4),
    (None, "no id here " * 9),
    (None, "no id here " * 9),
    (None, None),
    (10, "long " * 6 + "w" * 30_000 + " tail" * 20),
    (-3, "negative ids are ids as well " * 3),
]

#: Columns an operator may itself use as names, with nulls.
CLASHING = "doc_id long, text string, rank string, hash int, label string, n_words int, start string, seeds int, copy string, first string, cuts int"


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, None, 1, None, 7, None, None, "x", None, 3) for i, t in AWKWARD]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


def invented(n: int, seed: int) -> list[tuple[int, str]]:
    """Documents of few words, with passages and lines that many share, copies and near copies."""
    rng = random.Random(seed)
    words = ["the", "of", "And", "in", *(f"w{i}" for i in range(60))]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))
    shared = [[line() for _ in range(5)] for _ in range(4)]
    rows: list[tuple[int, str]] = []
    for i in rng.sample(range(10 * n), n):
        kind = rng.random()
        lines = [line() for _ in range(rng.randint(1, 9))]
        if kind < 0.4:
            at = rng.randrange(len(lines))
            lines[at:at] = rng.choice(shared)
        text = "\n".join(lines)
        if rows and kind > 0.85:
            text = rng.choice(rows)[1]
        elif rows and kind > 0.7:
            parts = rng.choice(rows)[1].split(" ")
            parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        rows.append((i, text))
    return rows


@pytest.fixture(scope="session")
def corpus():
    return invented(150, 5)


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
