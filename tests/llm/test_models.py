import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.llm import quality_classifier, samples, toxicity
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for d in range(900):
        good, toxic = rng.random() < 0.8, rng.random() < 0.15
        words = prose(rng, rng.randint(60, 200)).split()
        if not good:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            for bad in rng.sample(["grumpf", "snarlbit", "vexoid", "mockrat"], 2):
                words.insert(rng.randrange(len(words)), bad)
        docs.append((d, " ".join(words)))
        labels.append((d, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), \
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def accuracy(scored, labels, label, held):
    rows = scored.join(labels, "doc_id").where(held).select("predicted", label).collect()
    return np.mean([r[0] == r[1] for r in rows])


def test_held_out_quality(labelled):
    docs, labels = labelled
    model = quality_classifier.fit_on(docs, labels, samples.fold("doc_id", 5) != 0)
    assert accuracy(quality_classifier.score_quality(docs, model), labels, "quality", samples.fold("doc_id", 5) == 0) > 0.97


def test_held_out_toxicity(labelled):
    docs, labels = labelled
    model = toxicity.fit_on(docs, labels, samples.fold("doc_id", 3) != 1)
    assert accuracy(toxicity.score_toxicity(docs, model), labels, "toxic", samples.fold("doc_id", 3) == 1) > 0.97


def test_odd_rows_and_missing_labels(odd, empty, labelled):
    docs, labels = labelled
    for fit, score in ((quality_classifier.fit_on, quality_classifier.score_quality), (toxicity.fit_on, toxicity.score_toxicity)):
        model = fit(docs, labels, F.lit(True))
        rows = score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert score(empty, model).count() == 0
        none = fit(docs, labels.limit(0), F.lit(True))
        assert len({r.score for r in score(docs.limit(20), none).collect()}) == 1


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality_classifier.fit([np.array([1, 2]), np.array([3])], rng.normal(size=(2, 12)), np.array([0, 1]), buckets=8, steps=3)
    rows, x, starts = m.inputs([np.array([1, 2, 5])], rng.normal(size=(1, 12)))
    pairs = sum(x[i] * x[j] * (m.v[rows[i]] @ m.v[rows[j]]) for i in range(len(rows)) for j in range(i))
    assert m.margins(rows, x, starts)[0][0] == pytest.approx(m.bias + (m.w[rows] * x).sum() + pairs, rel=1e-4)


def test_negative_risk_is_not_followed_below_zero():
    positive = [np.array([7], np.uint32)] * 30
    unlabelled = [np.array([7], np.uint32)] * 3 + [np.array([9], np.uint32)] * 97
    model = toxicity.fit_nnpu(positive, unlabelled, prior=0.1)
    margin = model.bias + sum(model.weights.values())
    assert margin > 0 > model.bias


@pytest.mark.parametrize("shift", [-4.0, 0.0, 2.0])
def test_risk_and_gradient_by_finite_differences(shift):
    """Both risks against sums written out row by row, their gradients against differences; negatives above and below zero."""
    rng = np.random.default_rng(3)
    p, u, prior = rng.integers(0, 2, (20, 4)).astype(float), rng.integers(0, 2, (50, 4)).astype(float), 0.3
    theta = np.append(rng.normal(size=4), shift)

    def risks(theta):
        def loss(x, sign):
            return np.log(1 + np.exp(-sign * (sum(a * b for a, b in zip(x, theta)) + theta[-1])))
        plus = prior * np.mean([loss(x, 1) for x in p])
        minus = np.mean([loss(x, -1) for x in u]) - prior * np.mean([loss(x, -1) for x in p])
        return np.array([plus, minus])

    positive, negative, *gradients = toxicity.nnpu_risk(p, u, theta, prior)
    assert (positive, negative) == pytest.approx(tuple(risks(theta)))
    for i in range(5):
        step = np.zeros(5)
        step[i] = 1e-6
        assert [g[i] for g in gradients] == pytest.approx(list((risks(theta + step) - risks(theta - step)) / 2e-6), abs=1e-6)


def test_a_step_goes_down_the_risk_or_up_when_it_is_negative(monkeypatch):
    """One step of the fit follows the sum of both gradients while the negatives' risk is not negative, else turns back."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 6, 4)).astype(np.uint32) for _ in range(60)]
    positive, unlabelled = rows[:20] + [np.array([77], np.uint32)] * 20, rows[20:]
    real = toxicity.nnpu_risk
    for sign in (1, -1):
        monkeypatch.setattr(toxicity, "nnpu_risk", lambda *a: (0.0, sign, np.zeros(len(a[2])), np.ones(len(a[2]))))
        model = toxicity.fit_nnpu(positive, unlabelled, 0.3, steps=1, rate=0.01, decay=0.0)
        monkeypatch.setattr(toxicity, "nnpu_risk", real)
        assert model.weights and all(np.sign(w) == -sign for w in model.weights.values())


def test_factorisation_machine_equals_a_plain_loop():
    """The fit against the same steps with sums over pairs of features, written out row by row."""
    rng = np.random.default_rng(5)
    buckets, factors, n = 6, 2, 12
    ids = [np.unique(rng.integers(0, buckets, 3)) for _ in range(n)]
    stats, y = rng.normal(size=(n, quality_classifier.STATISTICS)), np.arange(n) % 2
    options = dict(buckets=buckets, factors=factors, steps=4, batch=5, rate=0.05, decay=0.01, seed=11)
    m = quality_classifier.fit(ids, stats, y, **options)

    draw = np.random.default_rng(11)
    prior = (y.sum() + 1) / (n + 2)
    size = buckets + quality_classifier.STATISTICS
    bias, w, v = np.log(prior / (1 - prior)), np.zeros(size), draw.normal(0, 0.02, (size, factors)).astype(np.float32).astype(float)
    inputs = quality_classifier.FactorisationMachine(0.0, np.zeros(size, np.float32), np.zeros((size, factors), np.float32),
                                                     stats.mean(axis=0), stats.std(axis=0) + 1e-3).inputs
    moments = [np.zeros_like(a) for a in (w, w, v, v)]
    for step in range(1, 5):
        pick = draw.choice(n, 5, replace=False)
        gb, gw, gv = 0.0, 0.01 * w, 0.01 * v
        for i in pick:
            rows, x, _ = inputs([ids[i]], stats[[i]])
            margin = bias + sum(w[r] * a for r, a in zip(rows, x))
            margin += sum((v[rows[i]] @ v[rows[j]]) * x[i] * x[j] for i in range(len(rows)) for j in range(i))
            g = (1 / (1 + np.exp(-margin)) - y[i]) / 5
            gb += g
            add_w, add_v = np.zeros_like(w), np.zeros_like(v)
            for r, a in zip(rows, x):
                add_w[r] += g * a
                for s, b in zip(rows, x):
                    if s != r:
                        add_v[r] += g * a * b * v[s]
            gw, gv = gw + add_w, gv + add_v
        bias -= 0.05 * gb
        for k, (value, grad) in enumerate(((w, gw), (v, gv))):
            first, second = moments[2 * k:2 * k + 2]
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            value -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    assert m.bias == pytest.approx(bias, rel=1e-4) and m.w == pytest.approx(w, abs=2e-3) and m.v == pytest.approx(v, abs=2e-3)
