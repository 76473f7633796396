"""Ordinal quality against brute force."""

import math
import random

import numpy as np

from lumenfold.llm import quality
from lumenfold.llm.queries import QUERIES
from lumenfold.llm.shingles import WordHash


def brute(rows, grades):
    """The tails by document of the fit over a dense matrix, each probability a plain difference."""
    known, places = WordHash(), {}
    bags = []
    for text in rows:
        (_, _, at, value), = quality.features([text], known)
        bags.append({})
        for a, v in zip(at.tolist(), value.tolist(), strict=True):
            k = places.setdefault(a, len(places))
            bags[-1][k] = bags[-1].get(k, 0.0) + v
    x = np.zeros((len(rows), len(places)))
    for i, b in enumerate(bags):
        for k, v in b.items():
            x[i, k] = v
    s, m = (lambda z: 1 / (1 + np.exp(-z))), len(places)

    def tails(p):
        return s((x @ p[:m])[:, None] - np.cumsum(np.append(p[m], np.exp(p[m + 1 :])))[None])

    def value(p):
        t = np.hstack([np.ones((len(rows), 1)), tails(p), np.zeros((len(rows), 1))])
        own = [math.log(t[i, g] - t[i, g + 1]) for i, gs in enumerate(grades) for g in gs]
        return -sum(own) / len(own) + quality.L2 / 2 * float(p[:m] @ p[:m])

    p, e = np.append(np.zeros(m), [-1.0, 0.0]), 1e-4
    axes = np.eye(len(p)) * e
    slope = lambda p: np.array([(value(p + d) - value(p - d)) / (2 * e) for d in axes])
    for _ in range(40):  # damped Newton steps by differences
        g, h = slope(p), np.array([(slope(p + d) - slope(p - d)) / (2 * e) for d in axes])
        move, t = np.linalg.solve(h + 1e-7 * np.eye(len(p)), -g), 1.0
        while t > 1e-6 and not value(p + t * move) <= value(p):
            t /= 2
        p = p + t * move
    assert np.abs(slope(p)).max() < 1e-6
    return tails(p)


def test_grades_match_brute_force(spark):
    r, texts, ratings = random.Random(3), [], []
    for k in range(60):
        level = r.randrange(3)
        texts.append(" ".join(("bad", "mid", "good")[level if r.random() < 0.6 else r.randrange(3)] + r.choice("ab") for _ in range(12)))
        ratings.append((k, level))
    ratings.append((1, 2))
    docs, labels = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(ratings, "doc_id long, quality int")
    got = sorted(quality.grade(docs, labels, folds=5).collect())
    train = [x.doc_id for x in got if not x.held_out]
    want = brute([texts[k] for k in train], [[q for d, q in ratings if d == k] for k in train])
    assert 0 < len(train) < 60
    for k, t in zip(train, want, strict=True):
        assert np.allclose(got[k].tails, t, atol=5e-3) and abs(got[k].expected - t.sum()) < 1e-2 and got[k].predicted == (np.array(got[k].tails) >= 0.5).sum()
        assert got[k].tails[0] >= got[k].tails[1]


def test_gradient():
    rng = np.random.default_rng(1)
    z, g, cuts, e = rng.normal(size=30), rng.integers(0, 4, 30), np.array([-1.0, 0.2, 0.9]), 1e-6
    _, by_z, by_cut = quality.loss(z, g, cuts)
    for k in range(3):
        d = np.eye(3)[k] * e
        assert abs((quality.loss(z, g, cuts + d)[0] - quality.loss(z, g, cuts - d)[0]) / (2 * e) - by_cut[k]) < 1e-5
    assert abs((quality.loss(z + e, g, cuts)[0] - quality.loss(z - e, g, cuts)[0]) / (2 * e) - by_z.sum()) < 1e-5


def test_grades_odd_rows(spark, odd, nothing, data):
    labels = spark.createDataFrame([(0, 1), (6, 0), (8, 1), (9, None), (None, 1), (11, 0), (99, 3)], "doc_id long, quality int")
    rows = quality.grade(odd, labels).collect()
    assert len(rows) == odd.count() and quality.grade(nothing, labels).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[3].expected == by[4].expected and len({r.expected for r in rows if r.doc_id == 0}) == 1
    assert all(r.expected is None and r.predicted is None and r.tails == [] for r in quality.grade(odd, labels.limit(0)).collect())
    assert QUERIES["op2_ordinal_quality"](spark, data).count() == 200
