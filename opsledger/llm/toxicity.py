"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from opsledger.llm import samples
from opsledger.llm.arrow import map_documents

WORDS = re.compile(r"\w+").findall
STEMS = (4, 5)
CACHE_ENTRIES = 250_000


def word_features(word: str) -> list[int]:
    """32-bit hashes of a word and of its first letters."""
    return [xxh32_intdigest(word), *(xxh32_intdigest(word[:n], n) for n in STEMS if len(word) >= n)]


def text_features(text: str | None) -> np.ndarray:
    return np.unique(np.fromiter(chain.from_iterable(map(word_features, set(WORDS((text or "").lower())))), np.uint32))


@dataclass
class PresenceModel:
    """Logistic model over the presence of a few selected word features."""
    weights: dict[int, float]
    bias: float

    def scorer(self):
        known = self.weights

        class Hits(dict):
            def __missing__(self, word):
                hits = tuple(f for f in word_features(word) if f in known)
                if len(self) >= CACHE_ENTRIES:
                    self.clear()
                if len(word) <= 64:
                    self[word] = hits
                return hits

        hits = Hits()

        def score(text: str | None) -> float:
            found = set(chain.from_iterable(map(hits.__getitem__, set(WORDS((text or "").lower())))))
            margin = self.bias + sum(sorted(known[f] for f in found))
            return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
        return score


def select_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most: int) -> np.ndarray:
    """Features whose rate among positives is far above their rate in unlabelled text, the most frequent first."""
    ids, up = np.unique(np.concatenate(positive), return_counts=True)
    every, other = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(every, ids), len(every) - 1)
    seen = np.where(every[at] == ids, other[at], 0)
    lift = (up / len(positive)) / ((seen + 1) / (len(unlabelled) + 1))
    good = (up >= 3) & (lift >= max(1.5, 0.6 / prior))
    order = np.argsort(-up[good], kind="stable")[:most]
    return ids[good][order]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def nnpu_risk(p: np.ndarray, u: np.ndarray, theta: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Risk of the positives and of the negatives under logistic loss, with their gradients.

    ``p`` and ``u`` are the features of positive and unlabelled rows, ``theta`` the weights with the bias last. The risk of
    the negatives is that of the unlabelled rows as negatives less the prior times that of the positives as negatives.
    """
    zp, zu = p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1]
    sp, su = _sigmoid(zp), _sigmoid(zu)

    def gradient(x, g):
        return np.append(x.T @ g.astype(x.dtype), g.sum())

    positive = prior * float(np.logaddexp(0, -zp).mean())
    negative = float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())
    return positive, negative, prior * gradient(p, (sp - 1) / len(p)), gradient(u, su / len(u)) - prior * gradient(p, sp / len(p))


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most: int = 1024,
             steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> PresenceModel:
    """Minimise prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)) with logistic loss.

    When the second term falls below zero its gradient is followed upwards, so the classifier does not gain by
    calling the positives hidden in the unlabelled text negative. Without positives, unlabelled text or features the
    score is the prior.
    """
    prior = min(max(prior, 1e-3), 0.5)
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return PresenceModel({}, bias)
    chosen = select_features(positive, unlabelled, prior, most)
    if not len(chosen):
        return PresenceModel({}, bias)
    order = np.sort(chosen)

    def matrix(rows: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(rows), len(order)), np.float32)
        for i, r in enumerate(rows):
            at = np.minimum(np.searchsorted(order, r), len(order) - 1)
            x[i, at[order[at] == r]] = 1
        return x

    p, u = matrix(positive), matrix(unlabelled)
    theta = np.zeros(len(order) + 1)
    theta[-1] = bias
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    for step in range(1, steps + 1):
        _, negative, of_positive, of_negative = nnpu_risk(p, u, theta, prior)
        g = of_positive + of_negative if negative >= 0 else -of_negative
        g[:-1] += decay * prior * theta[:-1]
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return PresenceModel(dict(zip(order.tolist(), theta[:-1].tolist())), float(theta[-1]))


def fit_on(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic", key: str = "doc_id", text: str = "text",
           positive_rows: int = 2500, unlabelled_rows: int = 5000) -> PresenceModel:
    """Fit on at most ``positive_rows`` confirmed positives of the learning folds and ``unlabelled_rows`` texts.

    The unlabelled texts are drawn from all documents without a look at labels. The class prior is the share of
    positives among all labelled rows of the learning folds. Only feature hashes of the sample are collected.

    Rows with a null key or label teach nothing; repeated labels of a key count as one by majority. A chosen key that
    several documents share brings all their texts, null texts as empty ones. Without labels or documents the model
    is a constant.
    """
    known = samples.training_labels(labels, key, label, learn)
    counts = known.agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).first()
    everything = docs.select(F.col(f"`{key}`").cast("bigint").alias("k")).where("k is not null")
    pick = samples.bounded(known.where("y = 1").select("k"), positive_rows).withColumn("p", F.lit(1)) \
        .union(samples.bounded(everything, unlabelled_rows).withColumn("p", F.lit(0)))
    rows = samples.texts_of(docs, pick, key, text).withColumn("kp", F.col("k") * 2 + F.col("p"))

    def start():
        return lambda texts: [[text_features(t).tobytes() for t in texts]]

    made = map_documents(rows, "kp", "t", "kp bigint, ids binary", start).collect()
    made.sort(key=lambda r: (r.kp, bytes(r.ids)))
    sides = [[np.frombuffer(r.ids, np.uint32) for r in made if r.kp % 2 == side] for side in (1, 0)]
    return fit_nnpu(*sides, (counts.p or 0) / max(counts.n, 1))


def score_toxicity(docs: DataFrame, model: PresenceModel, key: str = "doc_id", text: str = "text",
                   threshold: float = 0.7) -> DataFrame:
    """``key``, ``score`` and ``predicted`` (1 from ``threshold`` on) per row of ``docs``.

    Only the text is read. A null text is scored as an empty one, repeated rows get equal scores, a null key stays
    null, very long texts are scored whole, an empty table gives an empty table.
    """
    def start():
        score = model.scorer()
        return lambda texts: [[score(t) for t in texts]]

    return map_documents(docs, key, text, f"`{key}` bigint, score double", start) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
