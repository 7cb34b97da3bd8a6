"""Runs of periodic words: brute force, known words, awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import periodic_runs, queries
from tidemark.llm.periodic_runs import Grammar, direct_runs, find_runs, runs_of

WORDS = re.compile("[^\x20\x09-\x0d]+")
COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def invented_words(rng):
    kinds = rng.choice([1, 2, 3, 5, 20])
    words = [rng.randrange(kinds) for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 3)):
        period = [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        at = rng.randint(0, len(words))
        words[at:at] = (period * rng.randint(1, 14))[: rng.randint(1, 60)]
    return words


def laid_out(docs):
    return np.array([w for d in docs for w in d], np.int64), np.repeat(np.arange(len(docs)), [len(d) for d in docs])


def test_runs_as_brute_force(monkeypatch):
    rng = random.Random(1)
    for block in (periodic_runs.BLOCK, 7):
        monkeypatch.setattr(periodic_runs, "BLOCK", block)
        for _ in range(200):
            words, doc = laid_out([invented_words(rng) for _ in range(rng.randint(1, 6))])
            assert np.array_equal(runs_of(words, doc), direct_runs(words, doc))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b


@pytest.mark.parametrize(
    "words",
    [
        fibonacci(1000),
        [bin(i).count("1") % 2 for i in range(1024)],
        [0] * 1000,
        [0, 1] * 700,
        [*range(300)] * 4,
        [0, 0, 1] * 40 + [0] * 30 + [1, 0] * 20,
        [],
        [3],
    ],
)
def test_known_words(words):
    words, doc = laid_out([words])
    assert np.array_equal(runs_of(words, doc), direct_runs(words, doc))


def test_grammar_derives_the_words_and_repeats_no_pair():
    rng = random.Random(3)
    docs = [invented_words(rng) for _ in range(30)]
    words, doc = laid_out(docs)
    grammar = Grammar(words, doc)
    for rule in range(len(grammar.length)):  # all places of a rule hold the same words of one document
        places = grammar.places[grammar.begin[rule] : grammar.begin[rule + 1]]
        n = grammar.length[rule]
        assert len(places) > 1 and len({doc[p] for p in places} | {doc[p + n - 1] for p in places}) == 1
        assert len({tuple(words[p : p + n]) for p in places}) == 1
    assert np.array_equal(np.sort(grammar.start), grammar.start) and set(doc) == set(grammar.doc)


def test_a_meeting_of_hashes_changes_nothing(monkeypatch):
    words, doc = laid_out([[1, 2] * 5 + [3, 1, 2, 2] + [2, 1] * 6 + [5] * 9])
    expected = direct_runs(words, doc)
    monkeypatch.setattr(periodic_runs.Extender, "_same", lambda self, at, step, n: np.ones(len(at), bool))
    assert np.array_equal(runs_of(words, doc), expected)


def expected_row(doc_id, text, planted=True):
    """The contract's row, from its wording."""
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = direct_runs(np.array([number[w] for w in words], np.int64), np.zeros(n, np.int64)).tolist()
    lines = sorted(((s, e - s, q) for s, e, q in found), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in lines for i in range(s + q, s + length)}
    top = min(lines, key=lambda r: (-r[1], r[0], r[2])) if lines else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(lines),
        *top,
        1000 * top[1] // top[2] if lines else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in lines)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_as_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(expected_row(r.doc_id, r.text) for r in rows)
    found = queries.op12_periodic_runs(spark, folder)
    assert found.columns == ["doc_id", *COLUMNS]
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert sum(r[1] > 0 for r in expected) > 10


def test_awkward_rows(spark, awkward, empty):
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    rows = sorted((tuple(r) for r in find_runs(awkward, COLUMNS).collect()), key=key)
    assert rows == sorted((expected_row(r.doc_id, r.text, planted=False) for r in awkward.collect()), key=key)
    planted = queries.with_planted_runs(awkward)
    rows = sorted((tuple(r) for r in find_runs(planted, COLUMNS).collect()), key=key)
    assert rows == sorted((expected_row(r.doc_id, r.text) for r in awkward.collect()), key=key)
    assert find_runs(empty).collect() == []


def test_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "go  on " + "and on " * 5 + "x x x x x x")], "doc_id long, text string")
    (row,) = find_runs(docs).collect()
    assert row.runs == [1, 11, 2, 12, 6, 1] and row.collapsed == "go on and x" and row.n_words == 18
    with pytest.raises(ValueError):
        find_runs(docs, repeats=3)
