"""Quality by random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every word has an index vector, ``ONES`` entries of +1 or -1 among
``SIZE``, drawn from its hash. A word's own vector is the sum of the index vectors of the
words up to ``REACH`` places to both sides, over all documents. Words share ``BUCKETS``
rows by hash, so the table has one size, two megabytes, however many words there are, and
no word is left out. It is summed in tasks, then by bucket, and broadcast.

A document is the mean of its words' vectors, once plain and once with frequent words
weighing less, their spread, and how alike neighbours are. A network of one hidden layer, trained in numpy on the
driver on a bounded sample of labelled documents (``TRAINING_DOCS`` of each label), gives
the logit; a fifth of the sample stops the training and sets the temperature by which the
logits are divided, so that scores are probabilities at the natural share of labels.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import arrow_schema, id_and_text

SIZE = 32
ONES = 4
REACH = 2
BUCKETS = 1 << 14
#: Documents of each label in the training sample; each counts with all its words.
TRAINING_DOCS = 10_000
HIDDEN = 16
EPOCHS = 200
#: Epochs without a better fit on the kept-back fifth that end the training.
PATIENCE = 20
DECAY = 1e-3
#: Frequency at which a word weighs half.
COMMON = 1e-3
#: Words looked at together.
CHUNK = 200_000
#: Scores from here on count as label 1.
THRESHOLD = 0.3

_WORDS = re.compile(r"\w+|[^\w\s]+").findall


def word_hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and how many words each text has."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    words = list(map(_WORDS, texts))
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    return hashes[ids], sizes


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def index_entries(hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each of the ``ONES`` entries of the words' index vectors: its place and its sign."""
    for k in range(ONES):
        bits = hashes >> np.uint64(16 + 8 * k)
        yield (bits % np.uint64(SIZE)).astype(np.int64), 1 - 2 * ((bits >> np.uint64(7)) & np.uint64(1)).astype(np.int64)


def add_contexts(table: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> None:
    """Add the index vectors of the words around each word to its row of ``table`` (flat)."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    rows = buckets_of(hashes) * SIZE
    for step in range(1, REACH + 1):
        together = np.flatnonzero(doc[step:] == doc[:-step])
        for place, sign in index_entries(hashes):
            np.add.at(table, rows[together] + place[together + step], sign[together + step])
            np.add.at(table, rows[together + step] + place[together], sign[together])


def _chunks(batches: Iterable[pa.RecordBatch], characters: int = 6 * CHUNK) -> Iterator[tuple[list[list], list[str]]]:
    """The other columns and the texts (the last column) of documents of so many characters together."""
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if size and size + len(row[-1]) > characters:
                yield [list(c) for c in zip(*rows)][:-1], [r[-1] for r in rows]
                rows, size = [], 0
            rows.append(row)
            size += len(row[-1])
    if rows:
        yield [list(c) for c in zip(*rows)][:-1], [r[-1] for r in rows]


class Vectors:
    """Word vectors by bucket, and documents as pooled vectors."""

    #: Parts of a pooled vector: plain mean, mean with less of frequent words, spread; number of words,
    #: length of the mean, likeness of neighbours, and shares of words that stand again one and two places on.
    WIDTH = 3 * SIZE + 5

    def __init__(self, sums: np.ndarray, counts: np.ndarray) -> None:
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        self.rows = (sums / np.maximum(length, 1)).astype(np.float32)
        share = counts / max(1, counts.sum())
        self.weight = (COMMON / (COMMON + share)).astype(np.float32)

    def pooled(self, texts: list[str]) -> np.ndarray:
        """A row for each text; texts without words are zeros."""
        hashes, sizes = word_hashes_of(texts)
        out = np.zeros((len(texts), self.WIDTH), np.float32)
        some = np.flatnonzero(sizes)
        if not len(some):
            return out
        bucket = buckets_of(hashes)
        first = (np.cumsum(sizes) - sizes)[some]
        vectors, weight = self.rows[bucket], self.weight[bucket][:, None]
        n = sizes[some][:, None]
        mean = np.add.reduceat(vectors, first, axis=0) / n
        weighed = np.add.reduceat(vectors * weight, first, axis=0) / np.add.reduceat(weight, first, axis=0)
        square = np.add.reduceat(vectors**2, first, axis=0) / n
        spread = np.sqrt(np.maximum(square - mean**2, 0))
        doc = np.repeat(np.arange(len(some)), n[:, 0])
        inside = [doc[step:] == doc[:-step] for step in (1, 2)]
        again = [(hashes[step:] == hashes[:-step]) & here for step, here in zip((1, 2), inside)]
        alike = np.einsum("ij,ij->i", vectors[1:], vectors[:-1]) * inside[0]
        shares = [np.bincount(doc[: len(x)], x, minlength=len(some)) / n[:, 0] for x in (alike, *again)]
        lengths = [np.log1p(n[:, 0]), np.linalg.norm(mean, axis=1), *shares]
        out[some] = np.concatenate([mean, weighed, spread, np.stack(lengths, axis=1)], axis=1)
        return out


def learn_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Vectors:
    """Word vectors from all texts of ``docs``. Runs a job; a task sends one row per bucket it has seen."""
    names = [f"v{i}" for i in range(SIZE)]
    schema = ", ".join(["bucket int", "n long", *(f"{name} long" for name in names)])
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = np.zeros(BUCKETS * SIZE, np.int64), np.zeros(BUCKETS, np.int64)
        for _, texts in _chunks(batches):
            hashes, sizes = word_hashes_of(texts)
            add_contexts(table, hashes, sizes)
            counts += np.bincount(buckets_of(hashes), minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        rows = table.reshape(BUCKETS, SIZE)[seen]
        columns = [pa.array(seen.astype(np.int32)), pa.array(counts[seen]), *(pa.array(c) for c in rows.T.copy())]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    summed = id_and_text(docs, id_col, text_col).select("text").mapInArrow(run, schema)
    total = summed.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in names]).toArrow()
    sums, counts = np.zeros((BUCKETS, SIZE)), np.zeros(BUCKETS)
    bucket = total["bucket"].to_numpy()
    sums[bucket] = np.stack([total[name].to_numpy() for name in names], axis=1) if len(bucket) else 0
    counts[bucket] = total["n"].to_numpy()
    return Vectors(sums, counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Standardised inputs, a hidden layer, a logit; calibrated by a temperature and a shift."""

    def __init__(self, width: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.centre, self.scale = np.zeros(width), np.ones(width)
        self.weights = [rng.standard_normal((width, HIDDEN)) / np.sqrt(width), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / 4, np.zeros(1)]
        self.temperature, self.shift = 1.0, 0.0

    def logits(self, pooled: np.ndarray, keep: dict | None = None) -> np.ndarray:
        x = (pooled - self.centre) / self.scale
        inner, base, outer, bias = self.weights
        hidden = np.tanh(x @ inner + base)
        if keep is not None:
            keep["x"], keep["hidden"] = x, hidden
        return hidden @ outer + bias

    def gradients(self, pooled: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Of a loss whose slope by the logits is ``slope``."""
        keep: dict = {}
        self.logits(pooled, keep)
        back = slope[:, None] * self.weights[2] * (1 - keep["hidden"] ** 2)
        return [keep["x"].T @ back, back.sum(axis=0), keep["hidden"].T @ slope, slope.sum(keepdims=True)]

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(pooled) / self.temperature + self.shift)


def _loss(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * (np.logaddexp(0, logits) - labels * logits)).sum() / weight.sum())


def fit(pooled: np.ndarray, labels: np.ndarray, keys: np.ndarray, share: float, seed: int = 11) -> Network:
    """Train on pooled documents, their labels and ids; ``share`` of all documents have label 1.

    Without documents of both labels every document gets the share as its score.
    """
    net = Network(pooled.shape[1], seed)
    share = min(max(share, 1e-3), 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    order = np.argsort(keys, kind="stable")
    pooled, labels, keys = pooled[order].astype(float), labels[order].astype(float), keys[order]
    kept_back = np.array([xxhash.xxh3_64_intdigest(str(k)) % 5 == 0 for k in keys.tolist()], bool)
    parts = [~kept_back, kept_back]
    if any(len(set(labels[p].tolist())) < 2 for p in parts):
        parts = [np.ones(len(labels), bool)] * 2  # too few to keep any back
    if len(set(labels.tolist())) < 2:
        net.weights = [np.zeros_like(w) for w in net.weights]
        net.shift = prior
        return net
    (x, y), (x_back, y_back) = ((pooled[p], labels[p]) for p in parts)
    net.centre, net.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    # Both labels weigh alike in training; the shift brings their natural shares back.
    even = [np.where(t == 1, 0.5 / (t == 1).mean(), 0.5 / (t == 0).mean()) for t in (y, y_back)]
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights]
    best, best_weights, since, steps = np.inf, net.weights, 0, 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            slope = (_sigmoid(net.logits(x[part])) - y[part]) * even[0][part] / len(part)
            steps += 1
            rate = 0.003 * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            updated = []
            for w, g, (first, second) in zip(net.weights, net.gradients(x[part], slope), moments):
                first += 0.1 * (g - first)
                second += 0.001 * (g**2 - second)
                updated.append(w - rate * (first / (np.sqrt(second) + 1e-8) + DECAY * w))
            net.weights = updated
        now = _loss(net.logits(x_back), y_back, even[1])
        since += 1
        if now < best:
            best, best_weights, since = now, net.weights, 0
        if since >= PATIENCE:
            break
    net.weights = best_weights
    logits = net.logits(x_back)
    heat = np.exp(np.linspace(-0.7, 3, 186))  # no sharper than twice: the fifth may be separable
    net.temperature = float(heat[np.argmin([_loss(logits / t, y_back, even[1]) for t in heat])])
    net.shift = prior
    return net


class Classifier:
    """Word vectors and the network on them, by which tasks score texts."""

    def __init__(self, vectors: Vectors, network: Network) -> None:
        self.vectors, self.network = vectors, network

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.network.scores(self.vectors.pooled(texts))


def train(
    docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> Classifier:
    """Word vectors of all of ``docs``, and a network fitted on ``labelled.sample`` of them.

    The sample is pooled in tasks; the driver gets ``WIDTH`` numbers for each document.
    """
    vectors = learn_vectors(docs, id_col, text_col)
    texts, share = labelled.sample(docs, labels, "quality", most, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    schema = "doc_id long, label int, pooled array<double>"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, marks), part in _chunks(batches):
            rows = shared.value.pooled(part).astype(float)
            pooled = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * Vectors.WIDTH, rows.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int32()), pooled], schema=arrow)

    rows = texts.select("doc_id", "label", "text").mapInArrow(run, schema).toArrow()
    pooled = rows["pooled"].combine_chunks().flatten().to_numpy().reshape(-1, Vectors.WIDTH)
    return Classifier(vectors, fit(pooled, rows["label"].to_numpy(), rows["doc_id"].to_numpy(), share))


_classifiers: dict[str, Classifier] = {}


def score(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    Only the text is an input. Null and empty texts, and texts without words, are all zeros
    to the network. A null id stays null and isn't held out; repeated rows give repeated
    results; long texts count with all their words; an empty table gives an empty one;
    other columns don't matter. No shuffle.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(classifier), uuid.uuid4().hex
    schema = "doc_id long, held_out boolean, score double, predicted int"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _classifiers:
            _classifiers.clear()
            _classifiers[name] = shared.value
        for (ids, kept), texts in _chunks(batches):
            values = _classifiers[name].scores(texts)
            columns = [pa.array(ids, pa.int64()), pa.array(kept, pa.bool_()), pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    table = id_and_text(docs, id_col, text_col)
    return table.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, schema)
