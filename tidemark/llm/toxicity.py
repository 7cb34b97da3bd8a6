"""Toxicity by a bidirectional gated recurrent network with attention over its states.

Each word is the sum of a learned vector of the word, if training saw it often enough, and
the mean of learned vectors of its character n-grams, so unseen words have inputs as well.
Windows of ``WINDOW`` words, each overlapping the next, pass through a recurrent layer in
both directions; attention weighs its states into one vector, which a linear unit scores.
A document's score is that of its most toxic window, calibrated to the share of toxic
documents. Training follows it: each epoch scores all windows of all sampled documents, and
those that score highest in a document learn its label. Where labels are few, a network
would learn documents by heart. So the first entry of a word's or n-gram's vector starts at
how much more often toxic documents hold it, the less the fewer documents do; vectors are
pulled back to where they started; words are dropped at random; and a fifth of the sample
is kept back, whose loss picks the epoch and whose labels calibrate the scores.

The network is trained in numpy on the driver, on a bounded sample of labelled documents
(``TRAINING_DOCS`` of each label, in the order of a hash of their ids). Its weights, about
a megabyte at any input size, are broadcast; all windows of all texts are scored in tasks.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import id_and_text, kept

WINDOW = 32
STEP = 20
HIDDEN = 8
INPUT = 16
ATTENTION = 8
BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
#: Most labelled documents of each label in the training sample; each counts with all its words.
TRAINING_DOCS = 1500
#: Windows scored at once in training.
SCANNED = 2048
EPOCHS = 10
#: Training documents that must hold a word for it to have a vector of its own.
MENTIONS = 5
#: Pull of word and n-gram vectors back to where they started.
DECAY = 0.2
#: Documents holding a word at which its odds count by 63 percent.
TRUSTED = 5.0
#: Share of words whose own vectors a training step leaves out.
DROPPED = 0.2
#: Epochs without a better fit on the kept-back fifth that end the training.
PATIENCE = 4
#: Distinct words kept with their inputs in a worker; then the memory starts anew.
REMEMBERED = 300_000
#: Words whose inputs are made at once.
CHUNK = 5_000

_WORDS = re.compile(r"\w+").findall


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of the words, and where each word's begin."""
    data = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    buckets, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, np.uint64)
        for k in range(n):
            code = (code ^ data[k : k + len(code)]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        inside = owner[: len(code)] == owner[n - 1 :]
        buckets.append((code[inside] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[: len(code)][inside])
    bucket, belongs = np.concatenate(buckets).astype(np.int32), np.concatenate(owners)
    order = np.argsort(belongs, kind="stable")
    return bucket[order], np.searchsorted(belongs[order], np.arange(len(words)))


def window_starts(n: int) -> list[int]:
    """Starts of the windows over ``n`` words: every ``STEP``, the last one ends the text."""
    return [*range(0, max(1, n - WINDOW), STEP), n - WINDOW] if n > WINDOW else [0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Network:
    """Weights by name, and the two passes through them."""

    def __init__(self, vocabulary: list[str], seed: int = 9) -> None:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.index = {w: i for i, w in enumerate(vocabulary)}
        self.scale, self.shift = 1.0, 0.0
        self.weights = {
            "words": np.zeros((len(vocabulary) + 1, INPUT), np.float32),  # the last: any other word
            "grams": normal(BUCKETS, INPUT, scale=0.05),
            "attend": normal(2 * HIDDEN, ATTENTION, scale=0.3),
            "look": normal(ATTENTION, scale=0.3),
            "out": normal(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for d in "fb":
            self.weights[f"in_{d}"] = normal(INPUT, 3 * HIDDEN, scale=0.4)
            self.weights[f"base_{d}"] = np.zeros(3 * HIDDEN, np.float32)
            self.weights[f"back_{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)

    def inputs(self, words: list[str]) -> np.ndarray:
        """The input vector of each word."""
        bucket, starts = gram_buckets(words)
        counts = np.diff(np.append(starts, len(bucket)))[:, None].astype(np.float32)
        grams = np.add.reduceat(self.weights["grams"][bucket], starts, axis=0) / counts
        other = len(self.index)
        return grams + self.weights["words"][[self.index.get(w, other) for w in words]]

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What the inputs add to the gates of both directions: all a known word needs."""
        w = self.weights
        return np.concatenate([x @ w["in_f"] + w["base_f"], x @ w["in_b"] + w["base_b"]], axis=1)

    def forward(self, gates: np.ndarray, present: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``gates`` (step, window, 6 x hidden), ``present`` (step, window)."""
        w, steps, n = self.weights, gates.shape[0], gates.shape[1]
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        for d, at, order in (("f", 0, range(steps)), ("b", 1, range(steps - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                a = gates[t, :, at * 3 * HIDDEN : (at + 1) * 3 * HIDDEN]
                u = h @ w[f"back_{d}"]
                zr = _sigmoid(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                if keep is not None:
                    keep[d, t] = (h, z, r, new, u[:, 2 * HIDDEN :])
                h = new + z * (h - new)
                states[t, :, at * HIDDEN : (at + 1) * HIDDEN] = h
        looks = np.tanh(states @ w["attend"])
        scores = np.where(present, looks @ w["look"], np.float32(-30))
        share = np.exp(scores - scores.max(axis=0))
        share /= share.sum(axis=0)
        pooled = (share[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep["pool"] = (states, looks, share, pooled)
        return pooled @ w["out"] + w["bias"]

    def backward(self, keep: dict, present: np.ndarray, slope: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights above the inputs, and of the gates."""
        w = self.weights
        states, looks, share, pooled = keep["pool"]
        steps, n = states.shape[:2]
        g = {"out": pooled.T @ slope, "bias": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * w["out"]
        d_share = (states * d_pooled).sum(axis=2)
        d_scores = np.where(present, share * (d_share - (share * d_share).sum(axis=0)), 0)
        g["look"] = np.tensordot(d_scores, looks, ((0, 1), (0, 1)))
        d_looks = d_scores[:, :, None] * w["look"] * (1 - looks**2)
        g["attend"] = np.tensordot(states, d_looks, ((0, 1), (0, 1)))
        d_states = share[:, :, None] * d_pooled + d_looks @ w["attend"].T
        d_gates = np.zeros((steps, n, 6 * HIDDEN), np.float32)
        for d, at, order in (("f", 0, range(steps - 1, -1, -1)), ("b", 1, range(steps))):
            back, g_back = w[f"back_{d}"], np.zeros_like(w[f"back_{d}"])
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                h, z, r, new, u = keep[d, t]
                d_h = d_h + d_states[t, :, at * HIDDEN : (at + 1) * HIDDEN]
                d_new = d_h * (1 - z) * (1 - new**2)
                d_a = np.concatenate([d_h * (h - new) * z * (1 - z), d_new * u * r * (1 - r), d_new], axis=1)
                d_u = np.concatenate([d_a[:, : 2 * HIDDEN], d_new * r], axis=1)
                g_back += h.T @ d_u
                d_gates[t, :, at * 3 * HIDDEN : (at + 1) * 3 * HIDDEN] = d_a
                d_h = d_h * z + d_u @ back.T
            g[f"back_{d}"] = g_back
            g[f"base_{d}"] = d_gates[:, :, at * 3 * HIDDEN : (at + 1) * 3 * HIDDEN].sum(axis=(0, 1))
        return g, d_gates


def fit(texts: list[str], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 9) -> Network:
    """Train on texts and their labels; ``share`` of all documents are toxic.

    Without documents of both labels every document gets the share as its score.
    """
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    numbered = []  # each text's words by number: 4 bytes a word, whatever the length
    for words in map(words_of, texts):
        numbered.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
    distinct = list(number)
    mentions = np.zeros(len(distinct), np.int64)
    for ids in numbered:
        mentions[np.unique(ids)] += 1
    net = Network([w for w, n in zip(distinct, mentions.tolist()) if n >= MENTIONS], seed)
    del number, mentions
    share = min(max(share, 1e-3), 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        net.scale, net.shift = 0.0, prior
        return net
    taught = np.ones(len(texts), bool)
    taught[np.random.default_rng(seed + 1).permutation(len(texts)) < len(texts) // 5] = False
    if any(len(set(labels[part].tolist())) < 2 for part in (taught, ~taught)):
        taught[:] = True  # too few to keep any back
    blank = len(distinct)
    grams = [gram_buckets(distinct[at : at + CHUNK]) for at in range(0, len(distinct), CHUNK)]
    bucket = np.concatenate([g[0] for g in grams] or [np.zeros(0, np.int32)])
    ends = np.cumsum([len(g[0]) for g in grams] or [0])
    starts = np.concatenate([g[1] + end - len(g[0]) for g, end in zip(grams, ends)] or [np.zeros(0, np.int64)])
    counts = np.diff(np.append(starts, len(bucket)))
    word_row = np.array([net.index.get(w, len(net.index)) for w in distinct], np.int64)
    held = np.zeros((2, blank), np.int64)  # by label: training documents that hold a word
    held_grams = np.zeros((2, BUCKETS), np.int64)
    for ids, label, teaches in zip(numbered, labels.astype(int).tolist(), taught.tolist()):
        if teaches and len(ids):
            ids = np.unique(ids)
            held[label, ids] += 1
            sizes = counts[ids]
            of = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[ids], sizes)
            held_grams[label] += np.bincount(bucket[of], minlength=BUCKETS) > 0
    totals = np.array([np.sum(labels[taught] == y) for y in (0, 1)])
    known = word_row < len(net.index)
    net.weights["words"][word_row[known], 0] = _odds(held[:, known], totals)
    net.weights["grams"][:, 0] += _odds(held_grams, totals)
    begins = [np.array(window_starts(len(ids))) for ids in numbered]
    amount = np.array([len(at) for at in begins], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), amount)
    firsts = np.cumsum(amount) - amount
    lengths = np.array([len(ids) for ids in numbered], np.int64)
    begins = np.concatenate(begins) + np.repeat(np.cumsum(lengths) - lengths, amount)
    present_words = np.minimum(lengths, WINDOW).astype(np.int32)[owner]
    stream = np.concatenate([*numbered, np.full(WINDOW, blank, np.int32)])
    del numbered

    start = {name: net.weights[name].copy() for name in ("words", "grams")}

    def windows_at(part: np.ndarray) -> np.ndarray:
        """Numbers of the words in the windows (step, window), blank behind a text's end."""
        step = np.arange(WINDOW)[:, None]
        return np.where(step < present_words[part], stream[begins[part] + step], blank)

    def inputs_of(used: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Inputs of the words, then of a blank; their n-grams, the words these are of, and how many each has.

        ``row`` has the place of each word's own vector.
        """
        sizes = counts[used]
        begin = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(used)), sizes)
        flat = bucket[np.arange(sizes.sum()) - begin[of] + starts[used][of]]
        x = np.zeros((len(used) + 1, INPUT), np.float32)
        if len(used):
            x[:-1] = np.add.reduceat(net.weights["grams"][flat], begin, axis=0) / sizes[:, None]
            x[:-1] += net.weights["words"][row]
        return x, flat, of, sizes

    weight = np.where(labels == 1, 1.0, np.sum(labels == 1) / max(1, np.sum(labels == 0))).astype(np.float32)
    moments: dict[str, tuple[np.ndarray, np.ndarray]] = {
        k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()
    }

    def all_logits() -> np.ndarray:
        logits = np.empty(len(owner), np.float32)
        place = np.empty(blank + 1, np.int32)
        for at in range(0, len(owner), SCANNED):
            ids = windows_at(np.arange(at, min(at + SCANNED, len(owner))))
            used = np.unique(ids[ids != blank])
            place[used], place[blank] = np.arange(len(used)), len(used)
            gates = net.projected(inputs_of(used, word_row[used])[0])
            logits[at : at + SCANNED] = net.forward(gates[place[ids]], ids != blank)
        return logits

    def fit_on_kept_back(logits: np.ndarray) -> float:
        """Loss of documents that were not taught, both labels weighing alike; of all if all were."""
        part = ~taught if not taught.all() else taught
        found, truth, w = np.maximum.reduceat(logits, firsts)[part], labels[part], weight[part]
        return float((w * (np.logaddexp(0, found) - truth * found)).sum() / w.sum())

    steps, since = 0, 0
    logits = all_logits()
    best_fit, best_weights = np.inf, dict(net.weights)
    for epoch in range(epochs):
        order = np.lexsort((-logits, owner))  # of each document, the highest first
        top = order[firsts]
        has_second = np.append(np.diff(firsts), len(owner) - firsts[-1]) > 1
        chosen = np.concatenate([top, order[firsts[has_second] + 1]]) if epoch < epochs // 2 else top
        chosen = chosen[taught[owner[chosen]]]
        rng.shuffle(chosen)
        for part in np.array_split(chosen, max(1, len(chosen) // 64)):
            ids = windows_at(part)
            present = ids != blank
            used = np.unique(ids[present])
            place = np.full(blank + 1, len(used))
            place[used] = np.arange(len(used))
            row = np.where(rng.random(len(used)) < DROPPED, len(net.index), word_row[used])
            x, flat, of, sizes = inputs_of(used, row)
            keep: dict = {}
            logit = net.forward(net.projected(x)[place[ids]], present, keep)
            truth = labels[owner[part]]
            slope = ((_sigmoid(logit) - truth) * weight[owner[part]] / len(part)).astype(np.float32)
            grads, d_gates = net.backward(keep, present, slope)
            d_word = np.zeros((len(used) + 1, 6 * HIDDEN), np.float32)
            which, total = _by_row(place[ids].ravel(), d_gates.reshape(-1, 6 * HIDDEN))
            d_word[which] = total
            half = 3 * HIDDEN
            grads["in_f"], grads["in_b"] = x.T @ d_word[:, :half], x.T @ d_word[:, half:]
            d_x = d_word[:-1, :half] @ net.weights["in_f"].T + d_word[:-1, half:] @ net.weights["in_b"].T
            steps += 1
            rate = 0.01 * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for name, grad in grads.items():
                first, second = moments[name]
                first += 0.1 * (grad - first)
                second += 0.001 * (grad**2 - second)
                net.weights[name] -= (rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
            _step_rows(net.weights["words"], moments["words"], row, d_x, rate, start["words"])
            _step_rows(net.weights["grams"], moments["grams"], flat, d_x[of] / sizes[of][:, None], rate, start["grams"])
        logits = all_logits()
        now = fit_on_kept_back(logits)
        since += 1
        if now < best_fit:
            best_fit, since = now, 0
            best_weights = {name: w.copy() for name, w in net.weights.items()}
            best_logits = logits
        if since >= PATIENCE:
            break
    net.weights = best_weights
    natural = np.where(labels == 1, share / np.mean(labels == 1), (1 - share) / np.mean(labels == 0))
    net.scale, net.shift = _calibrate(np.maximum.reduceat(best_logits, firsts), labels, natural, taught)
    return net


def _odds(held: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log odds that a document holding it is toxic against any other, shrunk where few hold it."""
    share = (held + 0.5) / (totals[:, None] + 1)
    trust = 1 - np.exp(-held.sum(axis=0) / TRUSTED)
    return (trust * np.log(share[1] / share[0]) / 2).astype(np.float32)


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    which, first = np.unique(rows[order], return_index=True)
    return which, np.add.reduceat(values[order], first, axis=0)


def _step_rows(
    weights: np.ndarray, moments: tuple, rows: np.ndarray, grads: np.ndarray, rate: float, start: np.ndarray
) -> None:
    """One step on the rows that have a gradient, pulled back to ``start``."""
    if not len(rows):
        return
    which, total = _by_row(rows, grads)
    first, second = moments
    first[which] += 0.1 * (total - first[which])
    second[which] += 0.001 * (total**2 - second[which])
    weights[which] -= (rate * (first[which] / (np.sqrt(second[which]) + 1e-8) + DECAY * (weights[which] - start[which]))).astype(np.float32)


def _calibrate(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray, taught: np.ndarray) -> tuple[float, float]:
    """Scale, at most 4.5 times either way, and shift: scores of all add up to the labels, and
    fit best those of the documents that were not taught (of all if all were)."""
    logits, judged = logits.astype(float), taught if taught.all() else ~taught
    found = []
    for scale in np.exp(np.linspace(-1.5, 1.5, 31)):
        low, high = -50.0 - scale * logits.max(), 50.0 - scale * logits.min()
        for _ in range(60):
            shift = (low + high) / 2
            above = (weight * (_logistic(scale * logits + shift) - labels)).sum() > 0
            low, high = (low, shift) if above else (shift, high)
        x, y, w = (scale * logits + shift)[judged], labels[judged], weight[judged]
        found.append(((w * (np.logaddexp(0, x) - y * x)).sum() / w.sum() + 1e-3 * np.log(scale) ** 2, scale, shift))
    return tuple(map(float, min(found)[1:]))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Scorer:
    """Scores texts, keeping the gate inputs of words it has seen."""

    def __init__(self, net: Network, remembered: int = REMEMBERED) -> None:
        self.net, self.remembered = net, remembered
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.gates = np.zeros((1024, 6 * HIDDEN), np.float32)
        blank = np.zeros((1, INPUT), np.float32)
        self.gates[0] = self.net.projected(blank)[0]  # row 0: no word

    def _rows(self, words: list[str]) -> list[int]:
        rows = list(map(self.row.get, words))
        if None in rows:
            new = list({w for w, r in zip(words, rows) if r is None})
            if len(self.row) + len(new) > self.remembered and self.row:
                self._forget()
                return self._rows(words)
            first = len(self.row) + 1
            if first + len(new) > len(self.gates):
                more = np.zeros((max(first + len(new), 2 * len(self.gates)), 6 * HIDDEN), np.float32)
                more[: len(self.gates)] = self.gates
                self.gates = more
            for at in range(0, len(new), CHUNK):
                part = new[at : at + CHUNK]
                self.gates[first + at : first + at + len(part)] = self.net.projected(self.net.inputs(part))
            self.row.update(zip(new, range(first, first + len(new))))
            rows = list(map(self.row.get, words))
        return rows

    def scores(self, texts: list[str], block: int = 2048) -> np.ndarray:
        """Score of each text, over all its windows."""
        best = np.full(len(texts), -np.inf, np.float32)
        gates: list[np.ndarray] = []
        owner: list[int] = []
        sizes: list[int] = []

        def flush() -> None:
            if owner:
                present = np.arange(WINDOW)[:, None] < np.array(sizes)[None, :]
                logits = self.net.forward(np.stack(gates, axis=1), present)
                np.maximum.at(best, owner, logits)
                gates.clear(), owner.clear(), sizes.clear()

        for i, text in enumerate(texts):
            words = words_of(text)
            rows = self._rows(words) or [0]
            of_words = self.gates[rows]
            if len(of_words) < WINDOW:
                of_words = np.vstack([of_words, np.repeat(self.gates[:1], WINDOW - len(of_words), axis=0)])
            for s in window_starts(len(words)):
                gates.append(of_words[s : s + WINDOW])
                owner.append(i)
                sizes.append(max(1, min(WINDOW, len(words))))
                if len(owner) >= block:
                    flush()
        flush()
        return _logistic(self.net.scale * best.astype(float) + self.net.shift)


# ── on Spark ─────────────────────────────────────────────────────────────────


def train(
    docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> Network:
    """Fit a network on ``labelled.sample``: at most ``most`` documents of each label, none held out."""
    texts, share = labelled.sample(docs, labels, "toxic", most, id_col, text_col)
    rows = sorted(texts.collect())  # at most 2 x most
    return fit([r["text"] for r in rows], np.array([r["label"] for r in rows], np.float32), share)


def _scorer(name: str, net: Network, remembered: int = REMEMBERED) -> Scorer:
    """One per worker process and network."""
    return kept(("scorer", name, remembered), lambda: Scorer(net, remembered))


def _chunks(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    Only the text is an input. A null or empty text is one window without words, a very long
    one as many as it takes. A null id stays null and isn't held out; repeated rows give
    repeated results; an empty table gives an empty one; other columns don't matter. No shuffle.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, shared.value)
        for batch in batches:
            for part in _chunks(batch):
                values = scorer.scores(part.column("text").to_pylist())
                predicted = pa.array((values >= 0.5).astype(np.int32))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(values), predicted]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    table = id_and_text(docs, id_col, text_col).select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "text")
    return table.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, net: Network, text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """The rows of ``docs``, whole, that score below 0.5; cases as in ``score``."""
    shared, name = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, shared.value, remembered)
        for batch in batches:
            for part in _chunks(batch):
                values = scorer.scores([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(values < 0.5))

    return docs.mapInArrow(run, docs.schema)
