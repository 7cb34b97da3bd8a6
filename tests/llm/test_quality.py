"""Quality classifier: word vectors by brute force, gradients, held-out labels, awkward rows."""

import zlib

import numpy as np
import pytest

from tidemark.llm import labelled, quality_classifier, queries
from tidemark.llm.quality_classifier import BUCKETS, ONES, REACH, SIZE, Network, Vectors, fit, index_entries

SF = "/root/testdata/sf0.01"


def index_vector(hashed):
    vector = np.zeros(SIZE, np.int64)
    for place, sign in index_entries(np.array([hashed], np.uint64)):
        vector[place[0]] += sign[0]
    return vector


def test_word_vectors_as_brute_force(docs, corpus):
    sums, counts = np.zeros((BUCKETS, SIZE)), np.zeros(BUCKETS)
    for _, text in corpus:
        hashes, _ = quality_classifier.word_hashes_of([text])
        for i, h in enumerate(hashes.tolist()):
            counts[h % BUCKETS] += 1
            for j in range(max(0, i - REACH), min(len(hashes), i + REACH + 1)):
                if j != i:
                    sums[h % BUCKETS] += index_vector(hashes[j])
    found = quality_classifier.learn_vectors(docs)
    expected = Vectors(sums, counts)
    assert np.array_equal(found.rows, expected.rows) and np.array_equal(found.weight, expected.weight)
    assert all(np.abs(index_vector(h)).sum() <= ONES for h in range(0, 1 << 40, 1 << 35))


def test_pooling_as_brute_force(corpus):
    rng = np.random.default_rng(0)
    vectors = Vectors(rng.standard_normal((BUCKETS, SIZE)), rng.integers(0, 100, BUCKETS).astype(float))
    texts = ["", " \n", "one", "a a b a", *(t for _, t in corpus[:20])]
    found = vectors.pooled(texts)
    for text, row in zip(texts, found):
        hashes, _ = quality_classifier.word_hashes_of([text])
        if not len(hashes):
            assert not row.any()
            continue
        of, weight = (x[(hashes % np.uint64(BUCKETS)).astype(int)].astype(float) for x in (vectors.rows, vectors.weight))
        h, n = hashes.tolist(), len(hashes)
        expected = [
            *of.mean(axis=0),
            *(of * weight[:, None]).sum(axis=0) / weight.sum(),
            *of.std(axis=0),
            np.log1p(n),
            np.linalg.norm(of.mean(axis=0)),
            sum(a @ b for a, b in zip(of, of[1:])) / n,
            sum(a == b for a, b in zip(h, h[1:])) / n,
            sum(a == b for a, b in zip(h, h[2:])) / n,
        ]
        assert np.allclose(row, expected, atol=2e-3)


def test_gradients_are_the_slopes_of_the_loss():
    rng = np.random.default_rng(1)
    net = Network(5)
    net.weights[2] = rng.standard_normal(len(net.weights[2]))
    pooled, labels = rng.standard_normal((7, 5)), rng.integers(0, 2, 7)
    loss = lambda: float((np.logaddexp(0, net.logits(pooled)) - labels * net.logits(pooled)).sum())
    slope = 1 / (1 + np.exp(-net.logits(pooled))) - labels
    for weights, gradient in zip(net.weights, net.gradients(pooled, slope)):
        for at in list(np.ndindex(weights.shape))[:10]:
            old = weights[at]
            weights[at] = old + 1e-5
            up = loss()
            weights[at] = old - 1e-5
            down = loss()
            weights[at] = old
            assert abs((up - down) / 2e-5 - gradient[at]) < 1e-4


def area_under_curve(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2


def test_held_out_labels(spark):
    rows = queries.op11_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert rows[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    scores, truth = np.array([r.score for r in judged]), np.array([labels[r.doc_id] for r in judged])
    assert area_under_curve(scores, truth) > 0.95
    assert np.mean((scores >= 0.3) == truth) > 0.95


def test_scores_are_probabilities_at_the_natural_share():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6000, 4))
    labels = (rng.random(6000) < 1 / (1 + np.exp(-(x[:, 0] * 2 - 2)))).astype(int)
    net = fit(x[:4000], labels[:4000], np.arange(4000), labels.mean())
    scores = net.scores(x[4000:])
    for low in (0.0, 0.2, 0.4, 0.6):
        part = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[part].mean() - labels[4000:][part].mean()) < 0.08
    alone = fit(x[:5], np.ones(5), np.arange(5), 0.9)
    assert np.allclose(alone.scores(x[:5]), 0.9)


@pytest.mark.parametrize("none", [True, False])
def test_awkward_rows(spark, awkward, empty, none):
    rows = [] if none else [(4, 1), (5, 0), (6, 0), (6, 1), (7, None), (None, 1), (9, 1), (-3, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    classifier = quality_classifier.train(awkward, labels)
    found = quality_classifier.score(awkward, classifier).collect()
    assert len(found) == 16 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
    assert {r.held_out for r in found if r.doc_id is None} == {False}
    assert quality_classifier.score(empty, quality_classifier.train(empty, labels)).collect() == []


def test_sample_is_bounded_and_repeatable(spark, awkward):
    labels = spark.createDataFrame([(i, i % 2) for i in range(-3, 11)] + [(9, 1), (8, 1)], "doc_id long, quality int")
    found = [sorted(labelled.sample(awkward.repartition(n), labels, "quality", 3)[0].collect()) for n in (1, 5)]
    assert found[0] == found[1]
    ids = [r.doc_id for r in found[0]]
    assert len(ids) == len(set(ids)) <= 6 and 8 not in ids  # 8 has both labels
    assert all(zlib.crc32(str(i).encode()) % 5 for i in ids)
