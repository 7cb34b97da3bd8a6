"""Benchmark decontamination: one Aho-Corasick automaton of test windows, texts scanned once.

Texts and items are normalised alike: A-Z to lower case, words of letters, digits and
anything beyond ASCII, one space between. The automaton holds each item's windows with
a space before and after; a match's end names the word it ends with, and words map back
to their place in the original text.

Items are a stated set of limited size, read in blocks of at most ``BLOCK`` characters of
windows, each broadcast as one automaton. More than one block means more passes over the
texts, each adding to what the earlier found; nothing else changes.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_rows, id_and_text, map_rows

WINDOW = 10
#: Characters of windows in one automaton (about 100 bytes of memory each).
BLOCK = 1_500_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

Patterns = dict[str, tuple[int, tuple[str, ...]]]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_NORMAL).split()


def _line(words: list[bytes]) -> str:
    """Words with a space on both sides, a character for each byte."""
    return f" {b' '.join(words).decode('latin-1')} "


def pattern_blocks(items: Iterable[tuple[object, str | None]], window: int, block: int) -> Iterator[Patterns]:
    """Windows of the items: text, length in words, ids; cut into blocks between items."""
    found: dict[str, tuple[int, set[str]]] = {}
    size = 0
    for item, text in items:
        words = words_of(text or "")
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            line = _line(part)
            size += 0 if line in found else len(line)
            found.setdefault(line, (len(part), set()))[1].add("" if item is None else str(item))
        if size >= block:
            yield {k: (n, tuple(sorted(ids))) for k, (n, ids) in found.items()}
            found, size = {}, 0
    if found:
        yield {k: (n, tuple(sorted(ids))) for k, (n, ids) in found.items()}


_built: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, patterns: Patterns) -> ahocorasick.Automaton:
    """Built once per worker; one is kept."""
    if name not in _built:
        _built.clear()
        automaton = ahocorasick.Automaton()
        for line, value in patterns.items():
            automaton.add_word(line, value)
        automaton.make_automaton()
        _built[name] = automaton
    return _built[name]


def scan(automaton: ahocorasick.Automaton, words: list[bytes]) -> tuple[set[int], set[str]]:
    """Indexes of the words inside matches, and ids of the items with matches."""
    hit: set[int] = set()
    items: set[str] = set()
    line = _line(words)
    spaces: list[int] = []
    for end, (n, ids) in automaton.iter(line):
        if not spaces:
            spaces = [i for i, c in enumerate(line) if c == " "]
        last = bisect.bisect_left(spaces, end)
        hit.update(range(last - n, last))
        items.update(ids)
    return hit, items


def _blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list:
    rows = benchmark.select(F.col(f"`{item_col}`"), F.col(f"`{text_col}`").cast("string")).toLocalIterator()
    context = docs.sparkSession.sparkContext
    blocks = pattern_blocks(((r[0], r[1]) for r in rows), window, BLOCK)
    return [(uuid.uuid4().hex, context.broadcast(patterns)) for patterns in blocks]


_FOUND = "hit array<long>, items array<string>"
_REPORT = {
    "n_words": "long",
    "n_hit": "long",
    "n_items": "long",
    "items": "array<string>",
    "items_sha256": "string",
    "spans": "array<long>",
    "contaminated": "boolean",
}


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: tuple[str, ...] = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated"),
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """What each text shares with the benchmark: one row per row of ``docs``.

    A window is ``window`` consecutive words of an item; a shorter item is one window; an
    item without words has none. ``hit`` words stand inside an occurrence of a window.
    ``items`` are the ids found, sorted as strings; ``items_sha256`` their digest, joined
    by commas; ``spans`` the start and end, in characters of the original text, of each
    run of hit words, in turn.

    Null texts have no words; a null id stays null, a null item's id is "". Repeated rows
    give repeated results, repeated items count once; other columns don't matter. No
    shuffle.
    """
    table = id_and_text(docs, id_col, text_col)
    blocks = _blocks(docs, benchmark, item_col, item_text_col, window) or [("none", None)]
    for name, shared in blocks[:-1]:  # more than one block: carry the text along
        table = map_rows(table, _collecting(name, shared), f"doc_id long, text string, {_FOUND}")
    schema = ", ".join(["doc_id long", *(f"{c} {_REPORT[c]}" for c in columns)])
    return map_rows(table, _reporting(*blocks[-1], columns), schema)


def _scanner(name: str, shared):
    automaton = _automaton(name, shared.value) if shared else None
    return lambda words: scan(automaton, words) if automaton and words else (set(), set())


def _collecting(name: str, shared):
    def make():
        found_in = _scanner(name, shared)

        def one(doc_id, text, hit=(), items=()):
            more, others = found_in(words_of(text))
            yield doc_id, text, sorted(more.union(hit)), sorted(others.union(items))

        return one

    return make


def _reporting(name: str, shared, columns: tuple[str, ...]):
    def make():
        found_in = _scanner(name, shared)

        def one(doc_id, text, hit=(), items=()):
            words = words_of(text)
            more, others = found_in(words)
            hits, names = sorted(more.union(hit)), sorted(others.union(items))
            values = {
                "n_words": len(words),
                "n_hit": len(hits),
                "n_items": len(names),
                "items": names,
                "contaminated": bool(hits),
            }
            if "items_sha256" in columns:
                values["items_sha256"] = hashlib.sha256(",".join(names).encode()).hexdigest()
            if "spans" in columns:
                values["spans"] = original_spans(text, hits)
            yield (doc_id, *(values[c] for c in columns))

        return one

    return make


def original_spans(text: str, hits: list[int]) -> list[int]:
    """Starts and ends, in the text's characters, of the runs of hit words."""
    if not hits:
        return []
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]  # bytes stay in place
    edges: list[int] = []
    for at, i in enumerate(hits):
        if at and hits[at - 1] == i - 1:
            edges[-1] = places[i][1]
        else:
            edges += places[i]
    chars, done, spans = 0, 0, []
    for edge in edges:  # bytes to characters, in one walk
        chars += len(raw[done:edge].decode())
        done = edge
        spans.append(chars)
    return spans


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, whole, whose text shares no window with the benchmark.

    Cases are defined as in ``find_leaks``; rows stay where they are.
    """
    for name, shared in _blocks(docs, benchmark, item_col, item_text_col, window):

        def make(name: str = name, shared=shared):
            found_in = _scanner(name, shared)
            return lambda text: not found_in(words_of(text))[0]

        docs = filter_rows(docs, make, text_col)
    return docs
