from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=100, shift=7):
    """All answers from all products, in Python's integers."""
    seen, width = {}, max((len(v) for _, v, _ in rows if v is not None), default=0)
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        x = [int(np.floor(256 * float(c))) for c in v] + [0] * (width - len(v))
        seen[i, tuple(x), (lab + 1) % 10 if i % shift == 0 else lab] = None
    out = Counter()
    for i, x, lab in seen:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, y, other in seen)
        for s, p, _ in [r for r in scored if r[2] == lab and r[1] != i][:5]:
            inside = [r for r in scored if r[2] != lab and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out.update((i, p, k, j, -s, -t) for k, (t, j, _) in enumerate(inside, 1))
    return out


def found(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("tree_rows,anchors", [(20, 2), (8192, 8192)])
def test_odd_vectors(spark, tree_rows, anchors):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(c)) for c in rng.normal(size=4)], int(i) % 3) for i in range(0, 420)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(60)]  # one vector many times
    rows += [(2000, None, 1), (2100, [1.0, None, 1.0, 1.0], 1), (2200, [1.0] * 4, None), (None, [1.0] * 4, 1), (2300, [float("nan")] * 4, 1),
             (2400, [float("inf"), 1.0, 1.0, 1.0], 1), (2500, [], 1), (2600, [1.0, 2.0], 2), (2700, [0.0] * 4, 0), (2800, [-1.0] * 4, 5)]
    rows += [rows[5], rows[100], rows[100]]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as i", "2 as shard", "3 as `odd.name`")
    want = brute(rows)
    assert found(hn.mine(frame, tree_rows=tree_rows, anchors=anchors)) == want and len(want) > 100
    assert hn.mine(frame.limit(0)).count() == 0


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 2e6], i % 2) for i in range(300)]
    assert found(hn.mine(spark.createDataFrame(rows, SCHEMA), tree_rows=100)) == brute(rows)
    rows.append((400, [1e30, 0.0, 0.0], 1))  # no score with this row fits in 64 bits
    assert found(hn.mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows[:-1])


def test_clustered_vectors_leave_nodes_unread():
    """In data with structure the bounds keep most points from being read, and the answer is the same."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 400
    points = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 5).astype(np.int64)
    tree = hn.build_tree(points.astype(np.float64))
    labels, ids = rng.integers(0, 3, 4000)[tree.order], tree.order.copy()
    searcher = hn.Searcher(tree, points[tree.order], labels, ids)
    read = 0

    def wanted(given, _):
        nonlocal read
        read += len(given)
        return given == 1

    for q in points[:20]:
        rows = searcher.search(q, [float(1 << 63)], [-float(1 << 63)], wanted, 5)[0]
        scores = points[tree.order] @ q
        order = np.lexsort((ids, -scores))
        assert rows == [(-scores[i], ids[i]) for i in order if labels[i] == 1][:5]
    assert read < 20 * 4000 / 4


def test_every_point_lies_within_its_nodes():
    rng = np.random.default_rng(4)
    points = np.repeat(np.floor(rng.normal(size=(700, 5)) * 50), 3, axis=0)
    tree = hn.build_tree(points, leaf=8)
    square = (points ** 2).sum(axis=1)
    whole = np.column_stack([points, np.sqrt(square.max() - square)])[tree.order]
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for n in range(len(tree.centre)):
        away = np.sqrt(((whole[tree.begin[n]:tree.end[n]] - whole[tree.centre[n]]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[n] + 1e-6
        if tree.child[n] >= 0:
            inside = range(tree.child[n], tree.child[n] + tree.children[n])
            assert sum(tree.end[c] - tree.begin[c] for c in inside) == tree.end[n] - tree.begin[n]
            assert all(tree.radius[c] <= tree.radius[n] * hn.SHRINK + 1e-6 for c in inside)


def test_one_vector_sends_few_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("i"), (F.col("id") % 2).alias("l"), F.array(F.col("id") % 3).alias("x"))
    assert {r.i for r in hn._first_copies(rows).collect()} == set(range(36))
    plan = hn._first_copies(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
