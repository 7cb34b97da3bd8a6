"""Runs of periodic words, found in a grammar of the text rather than in the text.

A run is a stretch of words that equal the words ``period`` places on, repeats its period
``REPEATS`` times or more, and can't be longer. They come from templates, broken
extraction and looping generators.

1. Re-Pair: word pairs that stand twice in a document become one symbol, the most frequent
   first, until no pair repeats. All documents of a chunk go through each round together;
   in a round a pair gives way to a more frequent one next to it. What is left of a
   document, its start rule, becomes a balanced tree, so every boundary between two
   neighbouring symbols belongs to one node.
2. Every run lies in a lowest node that holds all of it, and crosses that node's middle.
   So each nonterminal is looked at once, at its first place: for each period up to a
   quarter of it, words beside the middle are compared one period apart, and where they
   agree, prefix hashes give how far to both sides the period goes on.
3. What a nonterminal holds is carried to all places it derives, and intervals of one
   period that overlap by a period or more are one: those that end with their node merge
   into the whole run. Each run found is compared word by word in the end.

Work is O(n log n) words. Chunks hold ``CHUNK`` words, or one longer document.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_schema, id_and_text

REPEATS = 4
LENGTH = 6
#: Words of one chunk.
CHUNK = 200_000
#: Pairs of boundary and period looked at together.
BLOCK = 1 << 20

_BASE = np.random.default_rng(12).integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Grammar:
    """Re-Pair of several documents, each for itself, over their words laid head to tail.

    ``left``, ``length`` and ``first`` of a rule: words of its left side, of all of it, and
    where it stands first; ``places`` are all places by rule, from ``begin[rule]`` on.
    ``start`` and ``doc`` are of the symbols in the start rules.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray) -> None:
        symbol, start = words.astype(np.int64), np.arange(len(words))
        size = int(symbol.max(initial=-1)) + 1
        self.terminals = size
        chance = np.random.default_rng(size)
        length = np.ones(size, np.int64)
        left, places, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        live = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
        while True:
            at = np.flatnonzero(live)
            a, b = symbol[at], symbol[at + 1]
            order = np.argsort((doc[at] * size + a) * size + b, kind="stable")
            pair, total = _groups(doc[at][order], a[order], b[order])
            group = np.empty(len(at), np.int64)
            group[order] = pair
            # The same pair at neighbouring places (x x x) counts at every other one.
            joined = np.append(False, (np.diff(at) == 1) & (np.diff(group) == 0)) if len(at) else np.zeros(0, bool)
            head = np.flatnonzero(~joined)
            stretch = np.cumsum(~joined) - 1
            even = (np.arange(len(at)) - head[stretch]) % 2 == 0
            amount = np.bincount(group[even], minlength=total)
            repeated = amount[group] > 1
            live[at[~repeated]] = False
            if not repeated.any():
                break
            # A place is replaced if no neighbouring pair is more frequent. Chance decides ties: an
            # order along the text would let long passages through one place a round.
            rank = np.zeros(len(symbol) + 2, np.int64)
            rank[at + 1] = np.where(repeated, amount[group] * total + chance.permutation(total)[group] + 1, 0)
            tail = np.append(head[1:] - 1, len(at) - 1)
            mine = rank[at[head] + 1]
            peak = (mine > 0) & (rank[at[head]] < mine) & (rank[at[tail] + 2] < mine)
            chosen = even & peak[stretch]
            chosen &= np.bincount(group[chosen], minlength=total)[group] > 1
            place, of = at[chosen], group[chosen]
            rules, first, rule = np.unique(of, return_index=True, return_inverse=True)
            la, lb = length[symbol[place[first]]], length[symbol[place[first] + 1]]
            length, left = np.append(length, la + lb), [*left, la]
            by_rule = np.argsort(rule, kind="stable")
            places.append(start[place[by_rule]])
            counts.append(np.bincount(rule, minlength=len(rules)))
            symbol[place] = size + rule
            size += len(rules)
            live[place] = True
            live[place[place > 0] - 1] = True
            keep = np.ones(len(symbol), bool)
            keep[place + 1] = False
            symbol, start, doc, live = symbol[keep], start[keep], doc[keep], live[keep]
            live[:-1] &= doc[1:] == doc[:-1]
            live[-1] = False
        self.start, self.doc = start, doc
        self.length, self.left = length[self.terminals :], np.concatenate(left)
        self.places = np.concatenate(places)
        self.begin = np.append(0, np.cumsum(np.concatenate(counts)))
        self.first = self.places[self.begin[:-1]]

    def boundaries(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, middle and end of each node's first place: of the rules, then of the trees of start rules."""
        low, middle, high = [self.first], [self.first + self.left], [self.first + self.length]
        start, doc = self.start, self.doc
        while len(start):
            edge = np.append(doc[1:] != doc[:-1], True)
            lasts = np.flatnonzero(edge)
            firsts = np.append(0, lasts[:-1] + 1)
            number = np.arange(len(start)) - np.repeat(firsts, lasts - firsts + 1)
            end = np.append(start[1:], n)  # documents lie head to tail
            pairs = np.flatnonzero((number % 2 == 0) & ~edge)
            if not len(pairs):
                break
            low.append(start[pairs])
            middle.append(start[pairs + 1])
            high.append(end[pairs + 1])
            start, doc = start[number % 2 == 0], doc[number % 2 == 0]
        return np.concatenate(low), np.concatenate(middle), np.concatenate(high)


def _groups(*sorted_keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of the group of equal keys that each place of sorted arrays is in, and how many there are."""
    if not len(sorted_keys[0]):
        return np.zeros(0, np.int64), 0
    new = np.zeros(len(sorted_keys[0]), bool)
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    number = np.cumsum(new)
    return number, int(number[-1]) + 1


class Extender:
    """How far words agree with the words some places on, by prefix hashes."""

    def __init__(self, words: np.ndarray) -> None:
        value = np.random.default_rng(13).integers(0, 1 << 63, int(words.max(initial=0)) + 1, dtype=np.uint64)
        self.power = np.cumprod(np.append(np.uint64(1), np.full(len(words), _BASE)))
        self.sums = np.append(np.uint64(0), np.cumsum(value[words] * self.power[:-1]))

    def _same(self, at: np.ndarray, step: np.ndarray, n: np.ndarray) -> np.ndarray:
        here = self.sums[at + n] - self.sums[at]
        return here * self.power[step] == self.sums[at + step + n] - self.sums[at + step]

    def ahead(self, at: np.ndarray, step: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``at`` on equal those ``step`` places later, ``most`` at most."""
        n = np.zeros(len(at), np.int64)
        for bit in _bits(most):
            more = n + bit
            fits = more <= most
            fits[fits] = self._same(at[fits], step[fits], more[fits])
            n[fits] = more[fits]
        return n

    def back(self, at: np.ndarray, step: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words before ``at``, going back."""
        n = np.zeros(len(at), np.int64)
        for bit in _bits(most):
            more = n + bit
            fits = more <= most
            fits[fits] = self._same(at[fits] - more[fits], step[fits], more[fits])
            n[fits] = more[fits]
        return n


def _bits(most: np.ndarray) -> list[int]:
    return [1 << k for k in reversed(range(int(most.max(initial=0)).bit_length()))]


def _crossing(
    words: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray, repeats: int, shortest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node, start, end and least period of the runs across nodes' middles, cut at the nodes' ends.

    A run of four periods has two of them, or more, on one side of the middle.
    """
    if not len(words):
        return (np.zeros(0, np.int64),) * 4
    extender = Extender(words)
    amount = (high - low) // repeats
    amount[high - low < shortest] = 0
    found = [np.zeros((4, 0), np.int64)]
    ends = np.cumsum(amount)
    node = 0
    while node < len(amount):
        until = max(node + 1, int(np.searchsorted(ends, (ends[node - 1] if node else 0) + BLOCK, "right")))
        part = np.repeat(np.arange(node, until), amount[node:until])
        base = ends[node:until] - amount[node:until]
        period = np.arange(len(part)) - np.repeat(base - base[0], amount[node:until]) + 1
        b = middle[part]
        for ahead in (True, False):
            room = (high[part] - b if ahead else b - low[part]) >= 2 * period
            at, q, mid = part[room], period[room], b[room]
            for offset, periods in ((0, 0), (-1, 0), (-1, 1)) if ahead else ((0, 1), (-1, 1), (0, 2)):
                same = mid + offset + (periods * q if ahead else -periods * q)
                same = words[same] == words[same + q]
                at, q, mid = at[same], q[same], mid[same]
            anchor = mid if ahead else mid - q
            right = anchor + extender.ahead(anchor, q, high[at] - q - anchor)
            left = anchor - extender.back(anchor, q, anchor - low[at])
            stop = right + q
            long = stop - left >= np.maximum(shortest, repeats * q)
            found.append(np.stack([at[long], left[long], stop[long], q[long]]))
        node = until
    at, start, stop, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, stop, start, at))
    at, start, stop, q = at[order], start[order], stop[order], q[order]
    new = np.ones(len(at), bool)  # the least period of an interval; the others are its multiples
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return at[new], start[new], stop[new], q[new]


def runs_of(words: np.ndarray, doc: np.ndarray, repeats: int = REPEATS, shortest: int = LENGTH) -> np.ndarray:
    """Rows (start, end, period) of all runs in documents laid head to tail, by start, then end.

    ``words`` are numbers of words, ``doc`` ascending numbers of their documents.
    """
    grammar = Grammar(words, doc)
    low, middle, high = grammar.boundaries(len(words))
    node, start, stop, q = _crossing(words, low, middle, high, repeats, shortest)
    rule = node < len(grammar.length)
    times = np.ones(len(node), np.int64)
    times[rule] = np.diff(grammar.begin)[node[rule]]
    shift = np.zeros(int(times.sum()), np.int64)
    which = np.repeat(np.arange(len(node)), times)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    derived = rule[which]
    of = node[which[derived]]
    shift[derived] = grammar.places[grammar.begin[of] + nth[derived]] - grammar.first[of]
    merged = _merged(start[which] + shift, stop[which] + shift, q[which])
    for s, e, period in merged.tolist():
        if not np.array_equal(words[s : e - period], words[s + period : e]):
            return direct_runs(words, doc, repeats, shortest)  # two hashes met
    return merged


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Intervals of a period that overlap by the period or more, as one."""
    if not len(start):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    number, _ = _groups(period)
    span = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + number * span) - number * span  # farthest end so far, in its period
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    rows = np.stack([start[heads], reach[np.append(heads[1:], len(start)) - 1], period[heads]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]


def direct_runs(words: np.ndarray, doc: np.ndarray, repeats: int = REPEATS, shortest: int = LENGTH) -> np.ndarray:
    """The same from the definition, in quadratic time: for tests, and should hashes ever meet."""
    least: dict[tuple[int, int], int] = {}
    edges = np.flatnonzero(np.diff(doc)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(words)]):
        w = words[low:high]
        for q in range(1, len(w) // repeats + 1):
            same = np.concatenate(([False], w[:-q] == w[q:], [False]))
            turns = np.flatnonzero(same[1:] != same[:-1])
            for s, e in zip(turns[::2].tolist(), turns[1::2].tolist()):
                if e + q - s >= max(shortest, repeats * q):
                    least.setdefault((low + s, low + e + q), q)
    rows = sorted((s, e, q) for (s, e), q in least.items())
    return np.array(rows, np.int64).reshape(-1, 3)


_KINDS = {
    "n_words": "long",
    "n_runs": "long",
    "runs": "array<long>",
    "start": "long",
    "length": "long",
    "period": "long",
    "exponent_milli": "long",
    "collapsed": "string",
    "runs_sha256": "string",
    "collapsed_sha256": "string",
}


def find_runs(
    docs: DataFrame,
    columns: tuple[str, ...] = ("n_words", "n_runs", "runs", "collapsed"),
    repeats: int = REPEATS,
    shortest: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The runs of each text; one row per row of ``docs``.

    Words are runs of other characters than space and \\t to \\r. A run has at least
    ``shortest`` words and ``repeats`` (4 or more) periods. ``runs`` has start (a word's
    number), length and period of each in turn, by start, then period; ``start`` to
    ``exponent_milli`` are of the longest (of equals the first, then of the least period),
    null without runs. ``collapsed`` is the text, joined by one space, without what repeats
    the first period of a run. Digests are of UTF-8: ``collapsed``, and a line
    ``start,length,period`` of each run.

    Null and empty texts have no words and no runs. A null id stays null; repeated rows give
    repeated results; a very long text is a chunk of its own; an empty table gives an empty
    one; other columns don't matter. No shuffle.
    """
    if repeats < 4:
        raise ValueError("a run must repeat its period four times or more")
    schema = ", ".join(["doc_id long", *(f"{c} {_KINDS[c]}" for c in columns)])
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            rows = _results(texts, columns, repeats, shortest)
            values = [ids, *zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, arrow.types)], schema=arrow)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and word lists of documents with about ``CHUNK`` words together."""
    ids: list = []
    texts: list[list[bytes]] = []
    n = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (text.as_buffer().to_pybytes()).split()
            if n and n + len(words) > CHUNK:
                yield ids, texts
                ids, texts, n = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            n += len(words)
    if ids:
        yield ids, texts


def _results(texts: list[list[bytes]], columns: tuple[str, ...], repeats: int, shortest: int) -> Iterator[tuple]:
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    sizes = [len(words) for words in texts]
    words = np.concatenate([np.fromiter(map(number.__getitem__, ws), np.int64, n) for ws, n in zip(texts, sizes)])
    edges = np.append(0, np.cumsum(sizes))
    found = runs_of(words, np.repeat(np.arange(len(texts)), sizes), repeats, shortest)
    own = np.searchsorted(found[:, 0], edges)
    for i, ws in enumerate(texts):
        runs = found[own[i] : own[i + 1]] - [edges[i], edges[i], 0]
        lines = sorted(((s, e - s, q) for s, e, q in runs.tolist()), key=lambda r: (r[0], r[2]))
        top = max(lines, key=lambda r: (r[1], -r[0], -r[2])) if lines else (None, None, None)
        kept = ws
        if lines:
            steps = np.zeros(len(ws) + 1, np.int64)
            np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
            np.add.at(steps, runs[:, 1], -1)
            kept = [w for w, inside in zip(ws, np.cumsum(steps).tolist()) if not inside]
        text = b" ".join(kept)
        values = {
            "n_words": len(ws),
            "n_runs": len(lines),
            "runs": [x for line in lines for x in line],
            "start": top[0],
            "length": top[1],
            "period": top[2],
            "exponent_milli": 1000 * top[1] // top[2] if lines else None,
        }
        if "collapsed" in columns:
            values["collapsed"] = text.decode()
        if "collapsed_sha256" in columns:
            values["collapsed_sha256"] = hashlib.sha256(text).hexdigest()
        if "runs_sha256" in columns:
            values["runs_sha256"] = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in lines).encode()).hexdigest()
        yield tuple(values[c] for c in columns)
