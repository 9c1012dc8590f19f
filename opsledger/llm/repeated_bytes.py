"""Removal of every byte covered by a fixed-length string that starts anywhere else in the corpus.

Suffixes are sampled, not sorted as a whole: each window of ``length`` bytes is known by its anchor, the ``GRAM`` bytes
with the smallest hash inside it, so equal windows have equal anchors at equal offsets wherever they stand. Windows
are then told apart top down, only where needed: all windows of an anchor by one digest of their common context,
blocks of ``BLOCK`` windows by one digest, and single windows at the borders of matches.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.llm.arrow import frees_memory, slices
from opsledger.llm.shingles import mixed
from opsledger.session import run_folder, stored

GRAM, BLOCK = 32, 32
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Digests:
    """64-bit digests of all substrings of some bytes, from one running sum of a polynomial."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(21, int(len(data)).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * up[:len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])


def find_anchors(data: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """First and last window, anchor, gram digest and context digest per run of windows with the same anchor.

    ``windows`` marks the positions of ``data`` at which a window may start.
    """
    digests = Digests(data)
    grams = np.arange(len(data) - GRAM + 1)
    gram = mixed((digests.sums[GRAM:] - digests.sums[:-GRAM]) * digests.down[:len(grams)])
    value = (gram & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)
    width = length - GRAM + 1
    padded = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max)
    padded[:len(value)] = value
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.flatnonzero(windows)
    anchor = (np.minimum(behind[starts], ahead[starts + width - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    anchor = anchor[new]
    return first, last, anchor, gram[anchor], digests.of(first, last + length)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """``k``, ``f``, anchor ``a`` with its first window at ``a - off`` and ``len`` more, ``gram``, ``ctx``, row number ``u``."""
    width = length - GRAM + 1

    def rows_of(raws: list[bytes], base: list[int], own: list[int]) -> list[np.ndarray] | None:
        data = np.frombuffer(b"".join(raws), np.uint8)
        ends = np.cumsum([len(r) for r in raws])
        windows = np.zeros(len(data), bool)
        for e, r in zip(ends, raws):
            windows[e - len(r):max(e - length + 1, e - len(r))] = True
        if not windows.any():
            return None
        first, last, anchor, gram, ctx = find_anchors(data, windows, length)
        owner = np.searchsorted(ends, first, side="right")
        shift = (np.array(base) - ends + [len(r) for r in raws])[owner]
        begin = first + shift - np.array(own)[owner]
        here = (begin >= 0) & (begin < CHUNK)
        return [x[here] for x in (owner, anchor + shift, anchor - first, last - first, gram.view(np.int64), ctx.view(np.int64))]

    @frees_memory
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, CHUNK):
                index, raws, base, own = [], [], [], []
                for i, t in enumerate(part.column(2).to_pylist()):
                    raw = (t or "").encode("utf-8")
                    for at in range(0, max(len(raw) - length + 1, 0), CHUNK):
                        # a run of windows belongs to the chunk in which it begins: a chunk sees the window before it and the
                        # longest run after it, so a run over a border is one row
                        index.append(i), own.append(at), base.append(max(at - 1, 0))
                        raws.append(raw[base[-1]:at + CHUNK + width + length - 1])
                at = 0
                while at < len(raws):
                    stop, held = at, 0
                    while stop < len(raws) and (stop == at or held + len(raws[stop]) <= CHUNK):
                        held += len(raws[stop])
                        stop += 1
                    found = rows_of(raws[at:stop], base[at:stop], own[at:stop])
                    if found is not None:
                        rows = pa.array(np.array(index[at:stop])[found[0]])
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(rows), part.column(1).take(rows), pa.array(found[1], pa.int64()),
                             pa.array(found[2], pa.int32()), pa.array(found[3], pa.int32()), pa.array(found[4]), pa.array(found[5])],
                            names=["k", "f", "a", "off", "len", "gram", "ctx"])
                    at = stop

    return docs.mapInArrow(run, "k bigint, f bigint, a bigint, off int, len int, gram bigint, ctx bigint") \
        .withColumn("u", F.xxhash64("k", "f", "a"))


def _same_document(left: str, right: str) -> Column:
    return F.col(f"{left}.k").eqNullSafe(F.col(f"{right}.k")) & (F.col(f"{left}.f") == F.col(f"{right}.f"))


def _spans(intervals: list[tuple[int, int]]) -> list[list[int]]:
    spans: list[list[int]] = []
    for begin, end in sorted(intervals):
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    return spans


def _finished(raw: bytes, intervals: list[tuple[int, int]]) -> tuple[int, list[dict], str]:
    """Removed bytes, spans and the digest of what is left of ``raw`` without ``intervals``."""
    spans, digest, at = _spans(intervals), hashlib.sha256(), 0
    for begin, end in spans:
        digest.update(raw[at:begin])
        at = end
    digest.update(raw[at:])
    return sum(e - b for b, e in spans), [{"begin": b, "end": e} for b, e in spans], digest.hexdigest()


SPAN = "array<struct<begin:bigint,end:bigint>>"
PIECES = "array<struct<a:bigint,off:int,len:int,gram:bigint,role:int>>"
#: Roles of anchors: all windows known to repeat, windows still to be judged, known ones that others are judged by.
WHOLE, OPEN, MODEL = 0, 1, 2


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (begin, end) and ``kept_sha256`` per row of ``docs``.

    A byte is removed when a string of ``length`` bytes that covers it also starts at another place of any text, the
    same text included and overlaps counted. Strings are judged on the input. Matches end at document borders.

    A null or empty text, and one shorter than ``length``, loses nothing (null: 0 bytes). A repeated row is another
    place, so both rows lose all their strings of that length. Rows with a null key are treated like others. Very
    long texts are cut to overlapping chunks. An empty table gives an empty table; other columns are not read.
    """
    folder = run_folder(docs.sparkSession, "repeated_bytes")
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("f"),
                       F.col(f"`{text}`").cast("string").alias("t"))
    anchors = stored(_anchor_rows(slim, length), f"{folder}/anchors")
    # written first, so the join below gets both sides from a shuffle and Spark can split a gram with very many rows
    twice = stored(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), f"{folder}/twice")
    shared = stored(anchors.join(twice, "gram"), f"{folder}/shared")
    alike = stored(shared.groupBy("gram", "ctx", "off", "len").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("model")),
                   f"{folder}/alike")
    undecided = alike.where("n = 1").select("gram").distinct().withColumn("undecided", F.lit(True))
    known = alike.join(undecided, "gram", "left")
    role = F.when(F.col("n") == 1, OPEN).when(F.col("undecided") & (F.col("u") == F.col("model")), MODEL).otherwise(WHOLE)
    pieces = shared.join(known, ["gram", "ctx", "off", "len"]).where("n > 1 or undecided") \
        .select("k", "f", F.struct("a", "off", "len", "gram", role.alias("role")).alias("p")) \
        .groupBy("k", "f").agg(F.collect_list("p").alias("pieces"))
    met = stored(_first_pass(slim.alias("d").join(pieces.alias("p"), _same_document("d", "p"), "left")
                             .select("d.k", "d.f", "d.t", "p.pieces"), length), f"{folder}/first")
    rest = met.where("t is not null")
    blocks = stored(_blocks(rest, length), f"{folder}/blocks")
    full = blocks.where("whole is not null").groupBy("gram", "block", "whole") \
        .agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("model"))
    judged = stored(blocks.join(full, ["gram", "block", "whole"], "left")
                    .withColumn("hit", F.coalesce(F.col("n") > 1, F.lit(False))), f"{folder}/judged")
    cores = judged.groupBy("gram", "block", "core").agg(
        F.count(F.lit(1)).alias("m"), F.max((F.col("open") & ~F.col("hit")).cast("int")).alias("mixed")) \
        .where("m > 1 and mixed = 1").select("gram", "block", "core")
    narrow = judged.where(~F.col("hit") | (F.col("u") == F.col("model"))).join(cores, ["gram", "block", "core"]) \
        .groupBy("k", "f").agg(F.collect_set(F.struct("a", "gram", "lo", "hi", F.expr("open and not hit").alias("open")))
                               .alias("pieces"))
    windows = stored(_windows(rest.alias("d").join(narrow.alias("p"), _same_document("d", "p"))
                              .select("d.k", "d.f", "d.t", "p.pieces"), length), f"{folder}/windows")
    equal = windows.groupBy("gram", "o", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    single = windows.where("open").join(equal, ["gram", "o", "digest"]) \
        .select("k", "f", (F.col("a") - F.col("o")).alias("begin"), (F.col("a") - F.col("o") + length).alias("end"))
    by_block = judged.where("open and hit").select(
        "k", "f", (F.col("a") - F.col("hi")).alias("begin"), (F.col("a") - F.col("lo") + length).alias("end"))
    more = single.union(by_block).groupBy("k", "f").agg(F.collect_set(F.struct("begin", "end")).alias("more"))
    last = _last_pass(rest.alias("d").join(more.alias("p"), _same_document("d", "p"), "left")
                      .select("d.k", "d.f", "d.t", "d.spans", "p.more"))
    plain = met.where("t is null").select("k", "n_bytes", "n_removed", "spans", "kept_sha256")
    return plain.union(last).select(F.col("k").alias(key), "n_bytes", "n_removed",
                                    F.size("spans").cast("bigint").alias("n_spans"), "spans", "kept_sha256")


def _first_pass(joined: DataFrame, length: int) -> DataFrame:
    """Finish texts without open or model anchors; keep text, spans so far and those anchors of the others."""
    names = ["k", "f", "n_bytes", "n_removed", "spans", "kept_sha256", "t", "pieces"]

    @frees_memory
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                sizes, removed, spans, digests, texts, left = [], [], [], [], [], []
                for t, pieces in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    raw, pieces = (t or "").encode("utf-8"), pieces or []
                    done = [(p["a"] - p["off"], p["a"] - p["off"] + p["len"] + length) for p in pieces if p["role"] != OPEN]
                    n, s, d = _finished(raw, done)
                    keep = [p for p in pieces if p["role"] != WHOLE]
                    sizes.append(len(raw)), removed.append(n), spans.append(s), digests.append(d)
                    texts.append(t if keep else None), left.append(keep)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, _arrow(SPAN)), pa.array(digests, pa.string()), pa.array(texts, pa.string()),
                     pa.array(left, _arrow(PIECES))], names=names)

    return joined.mapInArrow(run, f"k bigint, f bigint, n_bytes bigint, n_removed bigint, spans {SPAN}, kept_sha256 string, "
                                  f"t string, pieces {PIECES}")


def _arrow(kind: str) -> pa.DataType:
    fields = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    inside = kind[len("array<struct<"):-2].split(",")
    return pa.list_(pa.struct([(n, fields[k]) for n, k in (x.split(":") for x in inside)]))


def _blocks(rest: DataFrame, length: int) -> DataFrame:
    """One row per anchor and block of windows: digests of the union (``whole``) and the intersection (``core``) of them.

    ``whole`` is null where the union would pass a border of the text. ``lo`` to ``hi`` are the offsets of the windows
    that belong to the anchor.
    """
    @frees_memory
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, CHUNK):
                for i, (t, pieces) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    data = np.frombuffer(t.encode("utf-8"), np.uint8)
                    digests = Digests(data)
                    a, off, n, gram, role = (np.array([p[x] for p in pieces], np.int64) for x in ("a", "off", "len", "gram", "role"))
                    low, high = (off - n) // BLOCK, off // BLOCK
                    each = high - low + 1
                    r = np.repeat(np.arange(len(a)), each)
                    block = low[r] + np.arange(len(r)) - np.repeat(np.cumsum(each) - each, each)
                    near, far = a[r] - block * BLOCK, a[r] - block * BLOCK - BLOCK + 1
                    fits = (far >= 0) & (near + length <= len(data))
                    whole = digests.of(np.maximum(far, 0), np.minimum(near + length, len(data))).view(np.int64)
                    core = digests.of(near, far + length).view(np.int64)
                    rows = pa.array(np.full(len(r), i))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(rows), part.column(1).take(rows), pa.array(a[r]), pa.array(gram[r]), pa.array(block),
                         pa.array(whole, mask=~fits), pa.array(core), pa.array(np.maximum(block * BLOCK, (off - n)[r])),
                         pa.array(np.minimum(block * BLOCK + BLOCK - 1, off[r])), pa.array(role[r] == OPEN)],
                        names=["k", "f", "a", "gram", "block", "whole", "core", "lo", "hi", "open"])

    return rest.select("k", "f", "t", "pieces").mapInArrow(
        run, "k bigint, f bigint, a bigint, gram bigint, block bigint, whole bigint, core bigint, lo bigint, hi bigint, "
             "open boolean").withColumn("u", F.xxhash64("k", "f", "a", "block"))


def _windows(rest: DataFrame, length: int) -> DataFrame:
    """One row per single window of the blocks in ``pieces``: anchor, offset ``o`` and digest."""
    @frees_memory
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, CHUNK):
                for i, (t, pieces) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    digests = Digests(np.frombuffer(t.encode("utf-8"), np.uint8))
                    a, gram, lo, hi, opened = (np.array([p[x] for p in pieces], np.int64) for x in ("a", "gram", "lo", "hi", "open"))
                    each = hi - lo + 1
                    r = np.repeat(np.arange(len(a)), each)
                    o = lo[r] + np.arange(len(r)) - np.repeat(np.cumsum(each) - each, each)
                    digest = digests.of(a[r] - o, a[r] - o + length).view(np.int64)
                    rows = pa.array(np.full(len(r), i))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(rows), part.column(1).take(rows), pa.array(a[r]), pa.array(gram[r]), pa.array(o),
                         pa.array(digest), pa.array(opened[r] == 1)], names=["k", "f", "a", "gram", "o", "digest", "open"])

    return rest.mapInArrow(run, "k bigint, f bigint, a bigint, gram bigint, o bigint, digest bigint, open boolean")


def _last_pass(joined: DataFrame) -> DataFrame:
    """Finish the texts that had open anchors."""
    @frees_memory
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                sizes, removed, spans, digests = [], [], [], []
                for t, old, more in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                    raw = t.encode("utf-8")
                    n, s, d = _finished(raw, [(x["begin"], x["end"]) for x in [*old, *(more or [])]])
                    sizes.append(len(raw)), removed.append(n), spans.append(s), digests.append(d)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, _arrow(SPAN)),
                     pa.array(digests, pa.string())], names=["k", "n_bytes", "n_removed", "spans", "kept_sha256"])

    return joined.mapInArrow(run, f"k bigint, n_bytes bigint, n_removed bigint, spans {SPAN}, kept_sha256 string")
