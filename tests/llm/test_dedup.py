"""Substring, line and near-duplicate removal against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import common
from tidemark.llm.components import components
from tidemark.llm.line_dedup import remove_repeated_lines
from tidemark.llm.minmax_dedup import drop_near_duplicates, near_duplicates
from tidemark.llm.substring_dedup import remove_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected_repeats(rows, window):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words, gone = WORD.findall(text), set()
        for i in range(len(words) - window + 1):
            part = tuple(words[i : i + window])
            if part in seen:
                gone.update(range(i, i + window))
            seen.add(part)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window, seed", [(20, 6), (5, 2), (3, 3)])
def test_substrings_as_brute_force(docs, corpus, window, seed):
    columns = ("n_words", "n_removed", "kept", "kept_sha256")
    got = {r[0]: tuple(r[1:]) for r in remove_repeats(docs, window, seed, columns).collect()}
    assert got == expected_repeats(corpus, window)
    assert any(x[1] for x in got.values())


def test_substring_spans_are_maximal(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(25))
    docs = spark.createDataFrame([(1, f"{a} {b}"), (2, f"x {a} y {b}")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in remove_repeats(docs).collect()}
    assert got == {1: [], 2: [1, 31, 32, 57]}


def test_substrings_of_awkward_rows(awkward, empty):
    rows = remove_repeats(awkward, 3, 2).collect()
    assert len(rows) == 16
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in rows)
    assert got[(1, 0, 0)] == got[(3, 0, 0)] == got[(4, 1, 0)] == 1
    assert got[(8, 19, 9)] == 2  # rows of one document get one result
    assert got[(None, 27, 24)] == 2
    assert got[(None, 0, 0)] == 1
    assert remove_repeats(empty).collect() == []


def test_substrings_of_texts_that_share_an_id(spark):
    first, own = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    shared = " ".join(f"c{i}" for i in range(25))
    # Under id 2: a copy of id 1; its own text, long, whose repeat starts late; and a short one.
    late = f"{own} {first}"
    short = " ".join(f"d{i}" for i in range(21))
    rows = [(1, first), (2, first), (2, late), (2, short), (2, shared), (3, f"x {shared}"), (3, short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in remove_repeats(docs, columns=("kept", "spans")).collect())
    assert got == sorted(
        [(1, first, []), (2, "", [0, 30]), (2, own, [30, 60]), (2, short, []), (2, shared, [])]
        + [(3, "x", [1, 26]), (3, "", [0, 21])]
    )


def expected_lines(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            part = tuple(lines[i : i + 3])
            if not WORD.search("".join(part)):
                continue
            if part in seen:
                gone.update(range(i, i + 3))
            seen.add(part)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_lines_as_brute_force(docs, corpus):
    found = remove_repeated_lines(docs, lines_col="n", removed_col="gone").collect()
    got = {r.doc_id: (r.text, r.n, r.gone) for r in found}
    assert got == expected_lines(corpus)
    assert any(x[2] for x in got.values())


def test_lines_of_awkward_rows(awkward, empty):
    out = remove_repeated_lines(awkward, removed_col="gone")
    assert out.columns == [*awkward.columns, "gone"]
    rows = out.collect()
    assert len(rows) == 16
    texts = {(r.doc_id, r.text, r.gone) for r in rows}
    assert {(1, None, 0), (2, "", 0), (8, "r s t\nu v w\nx y z\nend", 3)} <= texts
    assert all(r.hash == 1 and r.copy == "x" for r in rows)
    assert remove_repeated_lines(empty).collect() == []


def test_lines_use_no_python(docs):
    plan = remove_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def expected_groups(rows, shingle, percent=80):
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        grams = zip(*(words[k:] for k in range(shingle)))
        sets[doc_id] = frozenset(grams if len(words) >= shingle else [tuple(words)] if words else [])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_as_brute_force(docs, corpus, shingle):
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, shingle).collect()}
    expected = expected_groups(corpus, shingle)
    assert got == expected
    kept = sorted(i for i, x in expected.items() if x[2])
    assert sorted(r.doc_id for r in drop_near_duplicates(docs, shingle).collect()) == kept


def test_links_past_the_leader_are_found(spark, monkeypatch):
    """A chain: neighbours are alike, ends are not; blocks of one row each."""
    from tidemark.llm import minmax_dedup

    monkeypatch.setattr(minmax_dedup, "BLOCK_OUTSIDE", 1)
    monkeypatch.setattr(minmax_dedup, "BLOCK_ALL", 2)
    words = [f"w{i}" for i in range(160)]
    rows = [(50 - k, " ".join(words[6 * k : 6 * k + 60])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, 2).collect()}
    assert got == {i: x[1] for i, x in expected_groups(rows, 2).items()}
    assert set(got.values()) == {39}


def test_near_duplicates_of_awkward_rows(awkward, empty):
    rows = near_duplicates(awkward, 2).collect()
    assert len(rows) == 16
    got = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert {(1, 1, True), (2, 2, True), (4, 4, True), (5, 4, False), (None, None, True)} <= got
    out = drop_near_duplicates(awkward, 2)
    assert out.columns == awkward.columns
    assert sum(r.doc_id == 8 for r in out.collect()) == 1
    assert near_duplicates(empty).collect() == drop_near_duplicates(empty).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 120)] + [(7, 7)]
    got = {r.vertex: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 40 else 100 for i in [*range(41), *range(100, 120)]}


def test_rolling_hashes_and_least_of_runs():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    values[100:130] = values[40:70]
    for length in (1, 2, 6, 15, 20, 199, 200, 201):
        for family in (0, 1):
            runs = common.rolling_hashes(values, length, family)
            assert len(runs) == max(0, 201 - length)
            same = {(i, j) for i in range(len(runs)) for j in range(i) if runs[i] == runs[j]}
            equal = {(i, j) for i in range(len(runs)) for j in range(i) if np.array_equal(values[i : i + length], values[j : j + length])}
            assert same == equal
        least = common.least_of_runs(values, length)
        assert least.tolist() == [int(values[i : i + length].min()) for i in range(max(0, 201 - length))]
