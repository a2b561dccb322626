"""The classifier chain: no leak between folds, and the chain against plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from rasterloom.llm import toxicity


def auc(y, p):
    """The chance that a positive scores above a negative."""
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    pos = y > 0
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_unseen_predictions_know_nothing_of_random_labels():
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(60)).encode() for _ in range(1200)]
    y = np.random.default_rng(2).integers(0, 2, len(texts)).astype(float)
    held = toxicity.held_features(texts)
    fold = np.array([toxicity.number(t) % 4 for t in texts])
    unseen = toxicity.out_of_fold(held, y, np.ones(len(texts)), np.empty((len(texts), 0)), fold, 1000)
    assert 0.45 < auc(y, unseen) < 0.55


def plain_logistic(rows, y, weight, penalty):
    """Gradient descent in loops, the intercept last and unpenalised."""
    n, w = len(rows), [0.0] * (len(rows[0]) + 1)
    total = sum(weight)
    for _ in range(4000):
        grad = [penalty / n * x for x in w[:-1]] + [0.0]
        for row, label, u in zip(rows, y, weight, strict=True):
            z = w[-1] + sum(a * b for a, b in zip(w, row, strict=False))
            e = u / total * (1 / (1 + math.exp(-z)) - label)
            for i, x in enumerate(row):
                grad[i] += e * x
            grad[-1] += e
        w = [a - 0.5 * g for a, g in zip(w, grad, strict=True)]
    return w


def plain_choice(sets, y, most):
    scored = []
    for f in sorted(set().union(*sets)):
        a, b = (sum(f in s for s, label in zip(sets, y, strict=True) if label == side) for side in (1, 0))
        if a + b < toxicity.LEAST_DOCUMENTS:
            continue
        p, q = a / sum(y), b / (len(y) - sum(y))
        m = (p + q) / 2
        score = abs(p - q) / math.sqrt((m + 1e-4) * (1 - m) + 1e-6)
        if score > 0:
            scored.append((-score, f))
    return sorted(f for _, f in sorted(scored)[:most])


def test_the_chain_equals_plain_loops():
    rng = random.Random(5)
    texts, y = [], []
    for i in range(48):
        first, second = i % 2, int(rng.random() < 0.3 + 0.4 * (i % 2))
        words = [f"w{rng.randrange(12)}" for _ in range(6)] + ["mark"] * (first and rng.random() < 0.8) + ["rude"] * (second and rng.random() < 0.8)
        texts.append(" ".join(words).encode())
        y.append((first, second))
    weight = [1.0 + i % 3 for i in range(len(texts))]
    names, most, folds = ["a", "b"], 6, 3
    sets = [set(f.tolist()) for f in toxicity.held_features(texts)]
    fold = [toxicity.number(t) % folds for t in texts]

    def matrix(some, chosen, earlier):
        return [[float(f in sets[i]) for f in chosen] + [e[i] for e in earlier] for i in some]

    def said(w, row):
        return 1 / (1 + math.exp(-(w[-1] + sum(a * b for a, b in zip(w, row, strict=False)))))

    earlier, shown, want = [], [], []
    for c in range(2):
        label, everyone = [r[c] for r in y], range(len(texts))
        chosen = plain_choice(sets, label, most)
        w = plain_logistic(matrix(everyone, chosen, earlier), label, weight, toxicity.PENALTY)
        want.append([said(w, row) for row in matrix(everyone, chosen, shown)])
        shown.append(want[-1])
        unseen = [0.0] * len(texts)
        for k in range(folds):
            there = [i for i in everyone if fold[i] != k]
            picked = plain_choice([sets[i] for i in there], [label[i] for i in there], most)
            v = plain_logistic(matrix(there, picked, earlier), [label[i] for i in there], [weight[i] for i in there], toxicity.PENALTY)
            for i in everyone:
                if fold[i] == k:
                    unseen[i] = said(v, matrix([i], picked, earlier)[0])
        earlier.append(unseen)
    got = toxicity.fit_chain(texts, np.array(y), np.array(weight), names, features=most, folds=folds).predict(texts)
    assert max(abs(a - b) for g, p in zip(got, want, strict=True) for a, b in zip(g, p, strict=True)) < 0.02


def test_the_sample_is_bounded(spark, docs_of):
    """Repeated rows of one id give one text; the bytes have a bound; a very long text is one text."""
    docs = docs_of([(1, "bad words")] * 500 + [(1, "other text")] * 3 + [(i, f"good words {i}") for i in range(2, 60)] + [(60, "very long " * 50_000)])
    labels = spark.createDataFrame([(i, 1, int(i == 1)) for i in range(1, 61)] + [(1, 1, 1)] * 40, "doc_id long, quality int, toxic int")
    texts, y, weight = toxicity.sample(docs, labels, {"toxic": F.col("toxic")})
    assert len(texts) == 60 and int(y.sum()) == 1 and (weight == 1).all()
    few, _, _ = toxicity.sample(docs, labels, {"toxic": F.col("toxic")}, most_bytes=100)
    assert 1 <= len(few) < 12
    assert toxicity.judge(docs, labels).count() == docs.count()
