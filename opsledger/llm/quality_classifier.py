"""Quality scores by a factorisation machine over hashed words, structure statistics and text length."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from opsledger.llm import samples
from opsledger.llm.arrow import map_documents

UPPER, LOWER, DIGITS = (bytes(range(a, b + 1)) for a, b in ((65, 90), (97, 122), (48, 57)))
SYMBOLS, MARKS = b"#*$%&|<>~^_=+@\\/{}[]", b".,;:!?"
STATISTICS = 12


def features(text: str | None, buckets: int) -> tuple[np.ndarray, list[float]]:
    """Hash buckets of the distinct words, and the statistics of the text. Linear in its length."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    distinct = set(words)
    n, size = len(words), max(len(raw), 1)
    each = max(n, 1)
    upper, lower = size - len(raw.translate(None, UPPER)), size - len(raw.translate(None, LOWER))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ids = np.fromiter(map(xxh64_intdigest, distinct), np.uint64, len(distinct)) % np.uint64(buckets)
    return ids.astype(np.int64), [
        np.log1p(n), np.log1p(len(text or "")), min(len(raw) / each, 60.0), len(distinct) / each,
        (size - len(raw.translate(None, SYMBOLS))) / each, upper / max(upper + lower, 1),
        raw.count(b"!!") / each, raw.count(b"|") / each, (size - len(raw.translate(None, DIGITS))) / size,
        (size - len(raw.translate(None, MARKS))) / each, len(lines) / each, 1 - len(set(lines)) / max(len(lines), 1)]


@dataclass
class FactorisationMachine:
    """Weights ``w`` and factors ``v`` of buckets, then of statistics; ``mean`` and ``scale`` standardise those."""
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, ids: list[np.ndarray], stats: np.ndarray):
        """Feature numbers, values and row starts of a batch. Word values have unit length over a text."""
        buckets = len(self.w) - STATISTICS
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        each = np.array([len(i) for i in ids])
        rows = np.empty(int(each.sum()) + z.size, np.int64)
        x = np.empty(len(rows), np.float32)
        starts = np.concatenate([[0], np.cumsum(each + STATISTICS)[:-1]]).astype(np.int64)
        for at, i, s in zip(starts, ids, z):
            rows[at:at + len(i)], x[at:at + len(i)] = i, 1 / np.sqrt(max(len(i), 1))
            rows[at + len(i):at + len(i) + STATISTICS] = np.arange(buckets, buckets + STATISTICS)
            x[at + len(i):at + len(i) + STATISTICS] = s
        return rows, x, starts

    def margins(self, rows, x, starts):
        """Sum of weights plus half of (square of the factor sums less the sum of squares): linear in the features."""
        vx = self.v[rows] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        linear = np.add.reduceat(self.w[rows] * x, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, vx

    def scores(self, texts: list[str | None]) -> np.ndarray:
        made = [features(t, len(self.w) - STATISTICS) for t in texts]
        if not made:
            return np.empty(0)
        rows, x, starts = self.inputs([i for i, _ in made], np.array([s for _, s in made]))
        margin = self.margins(rows, x, starts)[0].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(ids: list[np.ndarray], stats: np.ndarray, y: np.ndarray, buckets: int = 1 << 15, factors: int = 8,
        steps: int = 400, batch: int = 256, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """Logistic loss by Adam on minibatches. Without rows, or with one class only, the machine is a constant."""
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1) / (len(y) + 2)
    m = FactorisationMachine(float(np.log(prior / (1 - prior))), np.zeros(buckets + STATISTICS, np.float32),
                             rng.normal(0, 0.02, (buckets + STATISTICS, factors)).astype(np.float32),
                             np.zeros(STATISTICS), np.ones(STATISTICS))
    if len(set(y.tolist())) < 2:
        m.v[:] = 0
        return m
    m.mean, m.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    moments = [np.zeros_like(a) for a in (m.w, m.w, m.v, m.v)]
    for step in range(1, steps + 1):
        pick = rng.choice(len(y), min(batch, len(y)), replace=False)
        rows, x, starts = m.inputs([ids[i] for i in pick], stats[pick])
        margin, sums, vx = m.margins(rows, x, starts)
        g = ((1 / (1 + np.exp(-margin)) - y[pick]) / len(pick)).astype(np.float32)
        lengths = np.diff(np.append(starts, len(rows)))
        gx = np.repeat(g, lengths) * x
        gw, gv = decay * m.w, decay * m.v
        gw += np.bincount(rows, gx, len(gw)).astype(np.float32)
        pull = gx[:, None] * (np.repeat(sums, lengths, axis=0) - vx)
        for f in range(factors):
            gv[:, f] += np.bincount(rows, pull[:, f], len(gw)).astype(np.float32)
        m.bias -= rate * float(g.sum())
        for value, grad, first, second in ((m.w, gw, *moments[:2]), (m.v, gv, *moments[2:])):
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            value -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return m


def fit_on(docs: DataFrame, labels: DataFrame, learn, label: str = "quality", key: str = "doc_id", text: str = "text",
           train_rows: int = 6000, buckets: int = 1 << 15) -> FactorisationMachine:
    """Fit on at most ``train_rows`` labelled rows of the folds that ``learn`` names; only their features are collected.

    Rows with a null key or label teach nothing; repeated labels of a key count as one by majority. A chosen key that
    several documents share brings all their texts, null texts as empty ones. Without labels, or with one label only,
    the machine is a constant.
    """
    chosen = samples.bounded(samples.training_labels(labels, key, label, learn), train_rows)
    rows = samples.texts_of(docs, chosen, key, text)

    def start():
        def work(texts):
            made = [features(t, buckets) for t in texts]
            return [[i.astype(np.uint32).tobytes() for i, _ in made], [[float(x) for x in s] for _, s in made]]
        return work

    made = map_documents(rows.withColumn("ky", F.col("k") * 2 + F.col("y")), "ky", "t",
                         "ky bigint, ids binary, stats array<double>", start).collect()
    made.sort(key=lambda r: (r.ky, bytes(r.ids)))
    return fit([np.frombuffer(r.ids, np.uint32).astype(np.int64) for r in made],
               np.array([r.stats for r in made]).reshape(len(made), STATISTICS), np.array([r.ky % 2 for r in made]), buckets)


def score_quality(docs: DataFrame, model: FactorisationMachine, key: str = "doc_id", text: str = "text",
                  threshold: float = 0.3) -> DataFrame:
    """``key``, ``score`` and ``predicted`` (1 from ``threshold`` on) per row of ``docs``.

    Only the text is read. A null text is scored as an empty one, repeated rows get equal scores, a null key stays
    null, very long texts are scored whole, an empty table gives an empty table.
    """
    return map_documents(docs, key, text, f"`{key}` bigint, score double", lambda: lambda t: [model.scores(t)]) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
