import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from pairloom.llm.factorization import Reader, _forward, _gradient, fit, held_out, score_toxicity


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    at, starts, y = np.array([0, 1, 2, 1, 3]), np.array([0, 3, 3, 5]), np.array([1, 0, 1])
    weight, w, v = np.ones(3), rng.normal(size=4), rng.normal(size=(4, 2))

    def loss(b, w, v):
        raw = _forward(at, starts, b, w, v)[0]
        return float((np.log1p(np.exp(raw)) - y * raw).sum())

    d_b, d_w, d_v = _gradient(at, starts, y, weight, 0.3, w, v)
    step = 1e-6
    assert abs((loss(0.3 + step, w, v) - loss(0.3, w, v)) / step - d_b) < 1e-4
    for i in range(4):
        more = w.copy()
        more[i] += step
        assert abs((loss(0.3, more, v) - loss(0.3, w, v)) / step - d_w[i]) < 1e-4
        for k in range(2):
            more = v.copy()
            more[i, k] += step
            assert abs((loss(0.3, w, more) - loss(0.3, w, v)) / step - d_v[i, k]) < 1e-4


def test_pairs_that_no_single_word_shows(spark, make_docs):
    """Toxic only where an insult meets a group; both words are as common elsewhere."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        words = rng.choices([f"w{c}" * 2 for c in "abcdefghijklmnopqrst"], k=12)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["grubby"] * insult + ["mountainfolk"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    table = spark.createDataFrame(labels + [(None, 1), (10**9, 1)], "doc_id bigint, toxic int")
    docs = make_docs(rows + [(None, None), (5000, ""), (1, rows[1][1])], extra=", score int")
    got = score_toxicity(docs, table).collect()
    assert len(got) == len(rows) + 3
    label = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].score == by_id[5000].score and by_id[None].held_out is False


def test_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in score_toxicity(make_docs([(1, "a")]), none).collect()] == [0.0]
    assert score_toxicity(make_docs([]), none).count() == 0


def test_held_out_rule(spark):
    got = {r.id: r.h for r in spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def _xor(n=1500, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices([f"w{c}" * 2 for c in "abcdefghijklmnopqrst"], k=12)
        first, second = rng.random() < 0.5, rng.random() < 0.5
        words += ["grubby"] * first + ["mountainfolk"] * second
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(first != second)))
    return rows, labels


def test_exactly_one_of_two_words(spark, make_docs):
    """No word, and no sum of words, tells these labels apart."""
    rows, labels = _xor()
    got = score_toxicity(make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    label = dict(labels)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95


def test_scores_equal_a_dense_machine(spark):
    """The same steps on a dense matrix, pair by pair."""
    rows, labels = _xor(120)
    sample = spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(rows, labels)], "text string, _label int")
    machine = fit(sample, steps=12, factors=3)
    reader = Reader(machine.terms)
    x = np.zeros((len(rows), len(machine.terms)))
    for i, (_, text) in enumerate(rows):
        x[i, reader.row(text)] = 1
    y = np.array([v for _, v in labels])
    size, n, bad = x.shape[1], len(y), y.sum()
    assert size > 2
    b, w, v = 0.0, np.zeros(size), np.random.default_rng(7).normal(0, 0.02, (size, 3))
    weight = np.where(y == 1, min(10.0, (n - bad) / bad), 1.0)

    def raw(row):
        at = np.flatnonzero(row)
        return b + w[at].sum() + sum(v[i] @ v[j] for k, i in enumerate(at) for j in at[:k])

    m1 = m2 = np.zeros(1 + size * 4)
    for step in range(1, 13):
        error = weight * (1 / (1 + np.exp(-np.array([raw(r) for r in x]))) - y)
        slope = np.concatenate([[error.sum()], x.T @ error, sum(
            e * np.outer(r, r @ v) - e * r[:, None] * v for e, r in zip(error, x)
        ).ravel()]) / n
        slope += 1e-4 * np.concatenate([[0.0], w, v.ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * slope, 0.99 * m2 + 0.01 * slope * slope
        move = 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        b, w, v = b - move[0], w - move[1 : 1 + size], v - move[1 + size :].reshape(size, 3)
    wanted = 1 / (1 + np.exp(-np.array([raw(r) for r in x])))
    assert np.allclose(machine.score([reader.row(t) for _, t in rows]), wanted, atol=1e-6)
