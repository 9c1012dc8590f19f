"""Hard negatives by inner product: cover trees over norm-augmented vectors, searched best first, leaves verified exactly.

A vector ``x`` is taken as the point ``(x, sqrt(M - |x|^2))`` with ``M`` the largest square of a norm, so all points lie on one
sphere, and the inner product with an anchor ``q`` is the product of the points with ``(q, 0)``. A node with centre ``c`` and
covering radius ``r`` then holds no product outside ``q.c - |q| r`` to ``q.c + |q| r``.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsledger.llm.arrow import frees_memory
from opsledger.session import run_folder, stored

#: Points of one tree, points of a leaf, anchors that are searched for in one pass over the trees.
TREE_ROWS, LEAF, ANCHORS = 8_192, 48, 8_192
#: The scale of a level over that of the level above.
SHRINK = 0.7
#: Positives per anchor and negatives per positive that the search returns.
POSITIVES, NEGATIVES = 5, 5


@dataclass
class CoverTree:
    """Nested nodes over reordered points: node ``i`` covers points ``begin[i]`` to ``end[i]``, its first child is ``child[i]``.

    Children of a node lie next to each other; a leaf has no child (-1). Each level multiplies the scale by ``SHRINK``:
    centres of the children of a node are further apart than its scale, and each point is within the scale of its
    child's centre. ``radius`` is the largest distance that occurs, at most the scale; 0 stands for equal points.
    """
    centre: np.ndarray
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray
    order: np.ndarray


def _distances(whole: np.ndarray, some: np.ndarray, square: float) -> np.ndarray:
    """Distances of all points to some of them. Points on a sphere of moderate size need one product; different points
    are at least 1 apart, as their coordinates are whole numbers."""
    if square < 1 << 40:
        squares = 2 * (square - whole @ some.T)
    else:
        squares = np.stack([((whole - x) ** 2).sum(axis=1) for x in some], axis=1)
    return np.sqrt(np.where(squares < 0.5, 0.0, squares))


def build_tree(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """A tree over the rows of ``points`` (whole numbers as doubles, without the augmented coordinate)."""
    squares = np.einsum("ij,ij->i", points, points)
    square = float(squares.max(initial=0.0))
    whole = np.column_stack([points, np.sqrt(np.maximum(square - squares, 0.0))])
    order = np.arange(len(points))
    centre, radius, begin, end, child, children = [], [], [], [], [], []

    def add(first: int, last: int, middle: int, far: float) -> int:
        for column, value in zip((centre, radius, begin, end, child, children), (middle, far, first, last, -1, 0)):
            column.append(value)
        return len(centre) - 1

    if not len(points):
        none = np.empty(0, np.int64)
        return CoverTree(none, np.empty(0), none, none, none, none, order)
    open_nodes = [add(0, len(points), 0, float(_distances(whole, whole[:1], square).max()))]
    while open_nodes:
        node = open_nodes.pop()
        lo, hi, scale = begin[node], end[node], radius[node] * SHRINK
        if hi - lo <= leaf or radius[node] == 0.0:
            continue
        inside = order[lo:hi]
        rows = whole[inside]
        nearest, home = np.full(hi - lo, np.inf), np.zeros(hi - lo, np.int64)
        centres: list[int] = []
        while len(far := np.flatnonzero(nearest > scale)[:64]):
            # points beyond the scale of all centres so far; of these, the ones beyond each other's become centres
            between = _distances(rows[far], rows[far], square)
            picked: list[int] = []
            for i in range(len(far)):
                if not picked or between[i, picked].min() > scale:
                    picked.append(i)
            away = _distances(rows, rows[far[picked]], square)
            best = away.argmin(axis=1)
            distance = away[np.arange(len(rows)), best]
            closer = distance < nearest
            nearest[closer], home[closer] = distance[closer], best[closer] + len(centres)
            centres += inside[far[picked]].tolist()
        grouped = np.argsort(home, kind="stable")
        order[lo:hi], nearest = inside[grouped], nearest[grouped]
        child[node], children[node] = len(centre), len(centres)
        bounds = np.append(0, np.cumsum(np.bincount(home, minlength=len(centres))))
        for c, a, b in zip(centres, bounds[:-1].tolist(), bounds[1:].tolist()):
            open_nodes.append(add(lo + a, lo + b, c, float(nearest[a:b].max())))
    # centres are points too; they are looked up by their place in the new order
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return CoverTree(place[np.array(centre)], np.array(radius), *(np.array(x, np.int64) for x in (begin, end, child, children)), order)


class _Best:
    """The first ``size`` of the offered rows by score, then by id."""

    def __init__(self, size: int):
        self.size, self.rows, self.least = size, [], -np.inf

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            rows = self.rows + list(zip((-scores[good]).tolist(), ids[good].tolist()))
            self.rows = sorted(rows)[:self.size]
            if len(self.rows) == self.size:
                self.least = -self.rows[-1][0]


class Searcher:
    """One tree with the labels and ids of its points, in the tree's order."""

    def __init__(self, tree: CoverTree, points: np.ndarray, labels: np.ndarray, ids: np.ndarray):
        self.tree, self.points, self.labels, self.ids = tree, points, labels, ids
        self.largest = int(np.abs(points).max(initial=0))
        self.rough = points.astype(np.float64)
        self.centres = self.rough[tree.centre]

    def exact(self, q: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Products with the points from ``lo`` to ``hi``: in doubles where they hold them exactly, else in long integers."""
        if self.largest * int(np.abs(q).max(initial=0)) * len(q) < 1 << 53:
            return (self.rough[lo:hi] @ q.astype(np.float64)).astype(np.int64)
        return self.points[lo:hi] @ q

    def search(self, q: np.ndarray, top: list[float], least: list[float], wanted, size: int) -> list[list[tuple[int, int]]]:
        """Per window ``least[w]`` to ``top[w]`` of scores, the first ``size`` (-score, id) of the points ``wanted(labels, ids)``.

        Nodes are taken in the order of the best score that they may hold inside an open window. A node goes unread
        when its products lie outside every window, or below what each window has already.
        """
        found = [_Best(size) for _ in top]
        tree = self.tree
        if not len(tree.centre) or not top:
            return [[] for _ in top]
        high, low = np.array(top, np.float64), np.array(least, np.float64)
        rough = q.astype(np.float64)
        norm = float(np.sqrt(rough @ rough))

        def worth(first: int, last: int) -> np.ndarray:
            """The best score that each node may hold in a window which still lacks it, minus infinity if none."""
            middle = self.centres[first:last] @ rough
            reach = norm * tree.radius[first:last] + 1e-6 * (1 + np.abs(middle))
            upper, lower = middle + reach, middle - reach
            value = np.full(last - first, -np.inf)
            for h, x, f in zip(high, low, found):
                best = np.minimum(upper, h)
                best[(lower > h) | (best < max(x, f.least))] = -np.inf
                np.maximum(value, best, out=value)
            return value

        def verify(lo: int, hi: int) -> None:
            fits = np.flatnonzero(wanted(self.labels[lo:hi], self.ids[lo:hi]))
            if len(fits):
                scores, ids = self.exact(q, lo, hi)[fits], self.ids[lo:hi][fits]
                for f, t, x in zip(found, top, least):
                    here = (scores <= t) & (scores >= max(x, f.least))
                    if here.any():
                        f.offer(scores[here], ids[here])

        heap = [(-float(worth(0, 1)[0]), 0)]
        while heap:
            best, node = heappop(heap)
            if -best < min(max(f.least, x) for f, x in zip(found, least)):
                break
            if tree.child[node] < 0:
                verify(int(tree.begin[node]), int(tree.end[node]))
                continue
            # leaf children that are worth it and lie next to each other are verified in one go
            first, last = int(tree.child[node]), int(tree.child[node] + tree.children[node])
            value = worth(first, last)
            inner = tree.child[first:last] >= 0
            for i in np.flatnonzero(inner & (value > -np.inf)).tolist():
                heappush(heap, (-float(value[i]), first + i))
            ready = np.concatenate([[False], ~inner & (value > -np.inf), [False]])
            edges = np.flatnonzero(ready[1:] != ready[:-1])
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                verify(int(tree.begin[first + a]), int(tree.end[first + b - 1]))
        return [f.rows for f in found]


def quantised(vectors: DataFrame, key: str, vector: str, label: str, shift_every: int | None) -> DataFrame:
    """``i`` (key), ``l`` (label) and ``x`` (long components) of the rows that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    lab = F.col(f"`{label}`").cast("bigint")
    i = F.col(f"`{key}`").cast("bigint")
    shifted = lab if shift_every is None else F.when(i % shift_every == 0, (lab + 1) % 10).otherwise(lab)
    usable = i.isNotNull() & lab.isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(usable).select(i.alias("i"), shifted.alias("l"), F.transform(x, lambda v: F.floor(256 * v)).alias("x"))


def _first_copies(rows: DataFrame) -> DataFrame:
    """The rows that can be among the first: per vector and label the ones with the smallest keys.

    Equal vectors have equal scores with every anchor, and ties go by key, so no row after the first ``POSITIVES`` + 1 of
    a vector and label is ever returned. The limit by rank applies in each task before the shuffle as well, so a vector
    that a third of all rows share sends a few rows per task.
    """
    first = Window.partitionBy("x", "l").orderBy("i")
    return rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= max(POSITIVES + 1, NEGATIVES)).drop("rank")


def _padded(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    whole = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(whole.offsets.to_numpy())
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


_TREE = {"centre": np.int64, "radius": np.float64, "begin": np.int64, "end": np.int64, "child": np.int64, "children": np.int64}


def _trees(rows: DataFrame, shards: int, width: int) -> DataFrame:
    """One row per shard: the tree and its points, labels and ids in the tree's order. Vectors go to shards by their hash."""
    def build(table: pa.Table) -> pa.Table:
        points = _padded(table.column("x"), width)
        tree = build_tree(points.astype(np.float64))
        labels, ids = (table.column(c).to_numpy()[tree.order] for c in ("l", "i"))
        made = {**{n: getattr(tree, n) for n in _TREE}, "points": points[tree.order], "labels": labels, "ids": ids}
        return pa.table({n: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for n, v in made.items()})

    schema = ", ".join(f"`{n}` binary" for n in [*_TREE, "points", "labels", "ids"])
    return rows.withColumn("shard", F.pmod(F.xxhash64("x"), F.lit(shards))).groupBy("shard").applyInArrow(build, schema)


def _searcher(row: dict[str, bytes], width: int) -> Searcher:
    parts = {n: np.frombuffer(row[n], kind) for n, kind in _TREE.items()}
    points, labels, ids = (np.frombuffer(row[n], np.int64) for n in ("points", "labels", "ids"))
    return Searcher(CoverTree(**parts, order=np.arange(len(ids))), points.reshape(len(ids), width), labels, ids)


def _searched(trees: DataFrame, asked: list, width: int, size: int, other_label: bool) -> DataFrame:
    """``n`` (number of the question), ``w`` (window), ``score`` and ``id``: the first ``size`` of each tree for each question.

    A question is (vector, label, own id, tops, leasts); questions are a block of bounded length.
    """
    shared = trees.sparkSession.sparkContext.broadcast(asked)

    @frees_memory
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                searcher = _searcher({n: batch.column(j)[i].as_buffer() for j, n in enumerate(batch.schema.names)}, width)
                found = []
                for n, (q, label, own, top, least) in enumerate(shared.value):
                    if other_label:
                        rows = searcher.search(q, top, least, lambda labels, ids: labels != label, size)
                    else:
                        rows = searcher.search(q, top, least, lambda labels, ids: (labels == label) & (ids != own), size)
                    found += [(n, w, -int(score), id) for w, part in enumerate(rows) for score, id in part]
                columns = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["n", "w", "score", "id"])

    return trees.mapInArrow(run, "n bigint, w bigint, score bigint, id bigint")


def _first(found: DataFrame, size: int, rank: str) -> DataFrame:
    order = Window.partitionBy("n", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= size)


def mine(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         is_anchor: Column | None = None, shift_every: int | None = 7, tree_rows: int = TREE_ROWS, anchors: int = ANCHORS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Scores are inner products of components ``floor(256 x)``; higher ones come first, ties by smaller key. Anchors are the
    rows with ``is_anchor`` (a condition on column ``i``, the key; unless given, keys divisible by 100). Positives are an
    anchor's first five other rows of the same label. For each, the first five rows of other labels follow whose score
    is at least 80 % of the positive's and not above it. With ``shift_every``, rows whose key it divides first move on to the
    next of ten labels.

    All rows are in a tree; the number of trees follows from the number of rows, so a tree's size does not grow. The
    anchors are the query set: they are searched in blocks of ``anchors``, a first time for positives, then for all
    windows of an anchor in one descent. Each tree returns its first rows per question; a rank over these gives the
    answer.

    Rows with a null key, label or vector, or a null or non-finite component take no part, nor rows with components
    so large that a score might not fit in 64 bits (square root of 2^63 over the number of components). A row that is
    repeated with its key is one row. An empty vector has score 0 with all; a shorter one counts as filled up with
    zeros. An anchor without positives, or a positive without rows in its window, gives no row; an empty table gives
    an empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    folder = run_folder(spark, "hard_negatives")
    rows = quantised(vectors, key, vector, label, shift_every)
    width = max(rows.agg(F.max(F.size("x")).alias("n")).first().n or 0, 1)
    bound = int((2 ** 63 / width) ** 0.5) - 1
    rows = rows.where(F.forall("x", lambda v: F.abs(v) <= bound)).distinct()
    kept = stored(_first_copies(rows), f"{folder}/rows")
    trees = stored(_trees(kept, max(1, -(-kept.count() // tree_rows)), width), f"{folder}/trees")
    asked = stored(rows.where(F.col("i") % 100 == 0 if is_anchor is None else is_anchor), f"{folder}/anchors")
    blocks = max(1, -(-asked.count() // anchors))
    found = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).orderBy("i", "l", "x").collect()
        part = _mined(trees, block, width, f"{folder}/block{b}")
        found = part if found is None else found.union(part)
    return found


def _mined(trees: DataFrame, block: list, width: int, folder: str) -> DataFrame:
    """The answers for one block of anchors."""
    spark = trees.sparkSession
    vectors = []
    for r in block:
        q = np.zeros(width, np.int64)
        q[:len(r.x)] = r.x
        vectors.append(q)
    largest = float(1 << 63)
    first = [(q, r.l, r.i, [largest], [-largest]) for q, r in zip(vectors, block)]
    positives = stored(_first(_searched(trees, first, width, POSITIVES, other_label=False), POSITIVES, "p"), f"{folder}/positives")
    windows: list[list[tuple[int, int]]] = [[] for _ in block]
    for r in positives.orderBy("n", "p").collect():
        windows[r.n].append((r.id, r.score))
    # 80 * positive <= 100 * negative, in whole numbers; a negative positive score leaves no score in its window
    second = [(q, r.l, r.i, [s for _, s in w], [-(-4 * s // 5) for _, s in w]) for q, r, w in zip(vectors, block, windows)]
    best = _first(_searched(trees, second, width, NEGATIVES, other_label=True), NEGATIVES, "rank")
    pairs = spark.createDataFrame([(n, k, r.i, id, score) for n, (r, w) in enumerate(zip(block, windows)) for k, (id, score) in enumerate(w)],
                                  "n bigint, w bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    return best.join(pairs, ["n", "w"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                                               F.col("score").alias("negative_score"))
