"""Benchmark passages in documents: latent semantic and rare-word candidates, then subsequence and answer checks."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from opsledger.llm.arrow import frees_memory, slices, with_columns
from opsledger.llm.shingles import ascii_words, mixed

BUCKETS = 1 << 16
BLOCK = 24
SKETCH = 64
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass(frozen=True)
class Item:
    """A benchmark passage: its words and, as ``answer``, those of its given answer or else of its last sentence."""
    id: int
    words: tuple[bytes, ...]
    answer: tuple[bytes, ...]


def item_of(id: int, text: str | None, answer: str | None = None) -> Item:
    if answer is None:
        parts = [p for p in SENTENCE.split((text or "").strip()) if p.strip()]
        answer = parts[-1] if parts else ""
    return Item(id, tuple(ascii_words(text)), tuple(ascii_words(answer)))


def buckets_of(words) -> np.ndarray:
    return (np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(BUCKETS)).astype(np.int64)


def common_subsequence(a, b) -> int:
    """Length of the longest common subsequence, with the matches of all of ``a`` in the bits of one number."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass(frozen=True)
class CorpusCounts:
    """What the latent spaces know of a corpus, counted over every document.

    ``frequencies`` are the documents per bucket with a word in it. ``sums`` has a row per bucket of ``used`` and
    ``SKETCH`` numbers in it: each block of words of each document adds 1 or -1 to one of them, for its distinct words.
    """
    n_docs: int
    frequencies: np.ndarray
    used: np.ndarray
    sums: np.ndarray

    def sketch(self, used: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """``SKETCH`` random combinations of the corpus's passages over the buckets ``used``; nothing for one not counted."""
        at = np.searchsorted(self.used, used)
        known = at < len(self.used)
        known[known] = self.used[at[known]] == used[known]
        rows = np.zeros((SKETCH, len(used)), np.float32)
        rows[:, known] = (self.sums[at[known]] * idf[used[known], None]).T
        return rows


def corpus_counts(docs: DataFrame, used: np.ndarray, key: str = "doc_id", text: str = "text") -> CorpusCounts:
    """Count all of ``docs`` in one pass: documents per bucket, and the sums of its passages for the buckets ``used``.

    A block's place among the sums and its sign come from a hash of key, text and the block's number. All counts are
    whole numbers, so the order of the tasks does not matter. Each task counts in arrays of the size of the bucket
    range and sends at most one row per bucket, a shuffle by bucket adds them up, and one row per bucket reaches the
    driver, whatever the corpus. Null texts have no words; rows with a null key count like others.
    """
    slim = docs.select(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").cast("string").alias("t"))
    used = np.unique(used)
    n = len(used)
    column = np.full(BUCKETS, n, np.int64)
    column[used] = np.arange(n)

    @frees_memory
    def run(batches):
        counts, sums = np.zeros(BUCKETS + 1, np.int64), np.zeros((n + 1) * SKETCH, np.int32)
        for batch in batches:
            for part in slices(batch, 1):
                ids = [buckets_of(ascii_words(t)) for t in part.column(1).to_pylist()]
                counts[BUCKETS] += len(ids)
                sizes = np.array([len(x) for x in ids])
                blocks = -(-sizes // BLOCK)
                if not blocks.sum():
                    continue
                total, first = int(blocks.sum()), np.cumsum(blocks) - blocks
                owner = np.repeat(np.arange(len(ids)), blocks)
                h = part.column(0).to_numpy().view(np.uint64)[owner]
                h = mixed(mixed(h + (np.arange(total) - first[owner]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                lane, sign = (h >> np.uint64(40)).astype(np.int64) % SKETCH, np.where(h & np.uint64(1 << 20), 1, -1).astype(np.int32)
                place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                block = np.repeat(first, sizes) + place // BLOCK
                # sorted by document, bucket and block: one sort tells the distinct words of blocks and of documents
                code = np.sort((owner[block] * BUCKETS + np.concatenate(ids)) * total + block)
                word, block = np.divmod(code[np.append(True, code[1:] != code[:-1])], total)
                counts[:BUCKETS] += np.bincount(word[np.append(True, word[1:] != word[:-1])] % BUCKETS, minlength=BUCKETS)
                np.add.at(sums, column[word % BUCKETS] * SKETCH + lane[block], sign[block])
        sums = sums.reshape(-1, SKETCH)
        seen = np.flatnonzero(counts)
        rows = [sums[c].tobytes() if c < n else None for c in column[seen[seen < BUCKETS]].tolist()] + [None] * int(counts[BUCKETS] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen]), pa.array(rows, pa.binary())], names=["bucket", "n", "v"])

    @frees_memory
    def add(batches):
        counts, sums = np.zeros(BUCKETS + 1, np.int64), np.zeros((n, SKETCH), np.int64)
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            np.add.at(counts, bucket, batch.column(1).to_numpy())
            for b, v in zip(bucket.tolist(), batch.column(2).to_pylist()):
                if v is not None:
                    sums[column[b]] += np.frombuffer(v, np.int32)
        seen = np.flatnonzero(counts)
        rows = [sums[column[b]].tobytes() if b < BUCKETS and column[b] < n else None for b in seen.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen]), pa.array(rows, pa.binary())], names=["bucket", "n", "v"])

    kind = "bucket bigint, n bigint, v binary"
    made = slim.mapInArrow(run, kind).repartition("bucket").mapInArrow(add, kind).collect()
    counts, sums = np.zeros(BUCKETS + 1, np.int64), np.zeros((n, SKETCH), np.int64)
    counts[[r.bucket for r in made]] = [r.n for r in made]
    for r in made:
        if r.v is not None:
            sums[column[r.bucket]] = np.frombuffer(r.v, np.int64)
    return CorpusCounts(int(counts[BUCKETS]), counts[:BUCKETS], used, sums)


def item_buckets(benchmark: DataFrame, item_text: str = "text") -> np.ndarray:
    """The buckets that hold a word of any item of a benchmark table; at most ``BUCKETS`` numbers reach the driver."""
    @frees_memory
    def run(batches):
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen[buckets_of(ascii_words(t))] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], names=["bucket"])

    texts = benchmark.select(F.col(f"`{item_text}`").cast("string").alias("t"))
    return np.array(sorted(r.bucket for r in texts.mapInArrow(run, "bucket bigint").distinct().collect()), np.int64)


class LatentIndex:
    """Projection of word windows to the latent space of a group of items, and the cosine search in it.

    A passage is the sum of its words' inverse document frequencies over hash buckets. Only buckets of item words
    can contribute to a product with an item, so the latent basis spans those; the norm of a window counts all words.
    The basis keeps a share ``kept`` of each item, and a copy of the item has no more of a cosine than that: the
    least cosine of a candidate is taken of what is kept.
    """

    def __init__(self, items: list[Item], n_docs: int, frequencies: np.ndarray):
        self.items = [i for i in items if i.words]
        self.idf = np.append(np.log((n_docs + 2) / (frequencies + 1)), 0.0).astype(np.float32)
        self.host = 2 * float((frequencies * self.idf[:-1] ** 2).sum() / max(frequencies.sum(), 1))
        used = np.unique(np.concatenate([buckets_of(i.words) for i in self.items])) if self.items else np.empty(0, np.int64)
        self.column = np.full(BUCKETS + 1, len(used), np.int32)
        self.column[used] = np.arange(len(used))
        self.used = used

    def item_rows(self) -> np.ndarray:
        rows = np.zeros((len(self.items), len(self.used)), np.float32)
        for i, item in enumerate(self.items):
            b = buckets_of(item.words)
            np.add.at(rows[i], self.column[b], self.idf[b])
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def fit(self, sketch: np.ndarray, rank: int) -> None:
        """Right singular vectors of the item rows stacked on the random combinations of the corpus's passages."""
        rows = self.item_rows()
        size = max(np.linalg.norm(sketch), 1e-9)
        whole = np.vstack([rows, sketch / size * np.sqrt(max(len(rows), 1)) * 0.3])
        width = min(rank + 16, *whole.shape)
        start = np.random.default_rng(11).normal(size=(whole.shape[1], width))
        q = np.linalg.qr(whole @ start)[0]
        for _ in range(2):
            q = np.linalg.qr(whole @ np.linalg.qr(whole.T @ q)[0])[0]
        v = np.linalg.svd(q.T @ whole, full_matrices=False)[2][:rank].T
        self.table = np.vstack([v * self.idf[self.used, None], np.zeros((1, v.shape[1]))]).astype(np.float32)
        latent = rows @ v
        self.kept = np.linalg.norm(latent, axis=1)
        self.latent_items = (latent / np.maximum(self.kept[:, None], 1e-9)).astype(np.float32)
        self.idf_squared = self.idf * self.idf

    def beyond(self, least: float, share: float) -> np.ndarray:
        """Marks the items of which a copy that keeps ``share`` of the words may stay below the candidates' cosine.

        A window holds four fifths of a copy at the worst place between two windows, or its own length of a longer
        one, and is filled up with host words, taken at twice the mean square of the corpus. Items of few or very
        frequent words, long ones, and those of which the basis keeps less than half are marked.
        """
        sizes = np.array([len(i.words) for i in self.items])
        own = np.array([self.idf_squared[buckets_of(i.words)].sum() for i in self.items])
        whole = own + np.maximum(2 * BLOCK - sizes, 0) * self.host
        reach = 0.8 * share * np.sqrt(np.minimum(1, 2 * BLOCK / sizes) * own / np.maximum(whole, 1e-9))
        return (reach < least) | (self.kept < 0.5)

    def candidates(self, texts: list[np.ndarray], least: float) -> list[tuple[int, int, int, float]]:
        """(text, item, first word, cosine) of windows of two blocks whose cosine with an item is at least ``least`` of
        the item's kept share. Texts are given by the buckets of their words.
        """
        found = []
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (stop == start or held < 40_000):
                held += len(texts[stop])
                stop += 1
            found += self._candidates(texts[start:stop], start, least)
            start = stop
        return found

    def _candidates(self, texts, offset, least):
        blocks = np.array([-(-len(t) // BLOCK) for t in texts])
        if not blocks.sum() or not self.items:
            return []
        first = np.concatenate([[0], np.cumsum(blocks)])
        ids = np.full(int(first[-1]) * BLOCK, BUCKETS, np.int64)
        for t, at in zip(texts, first):
            ids[at * BLOCK:at * BLOCK + len(t)] = t
        owner = np.repeat(np.arange(len(texts)), blocks)
        columns = self.column[ids]
        latent = np.empty((len(owner), self.table.shape[1]), np.float32)
        for i in range(0, len(owner), 1000):
            part = columns[i * BLOCK:(i + 1000) * BLOCK]
            latent[i:i + 1000] = self.table[part].reshape(-1, BLOCK, latent.shape[1]).sum(axis=1)
        square = self.idf_squared[ids].reshape(-1, BLOCK).sum(axis=1)
        follows = np.flatnonzero(owner[1:] == owner[:-1])
        windows, squares = latent.copy(), square.copy()
        windows[follows] += latent[follows + 1]
        squares[follows] += square[follows + 1]
        found, floor = [], (least * self.kept).astype(np.float32)
        for i in range(0, len(owner), 4000):
            cosines = windows[i:i + 4000] @ self.latent_items.T / np.sqrt(np.maximum(squares[i:i + 4000], 1e-9))[:, None]
            for w, item in zip(*np.nonzero(cosines >= floor)):
                text = owner[i + w]
                found.append((offset + int(text), int(item), int(i + w - first[text]) * BLOCK, float(cosines[w, item])))
        return found

    def cosine(self, item: np.ndarray, words: np.ndarray) -> float:
        """Cosine of two passages, given by the buckets of their words, without projection."""
        a, b = (np.bincount(x, minlength=BUCKETS) * self.idf[:BUCKETS] for x in (item, words))
        return float(a @ b / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-9))


class RareWords:
    """The rarest words of each item, and the search for places where enough of them stand together.

    A passage that keeps ``c`` of an item's ``N`` words holds at least ``j`` of any ``N - c + j`` of them. The
    rarest ones are looked up, so no passage whose kept words lie within ``reach`` (five quarters of ``N``) is
    missed, whatever the weights of its words and the length of the item.
    """

    def __init__(self, items: list[Item], frequencies: np.ndarray, share: float):
        self.need, self.reach = np.ones(len(items), np.int64), np.ones(len(items), np.int64)
        rare, holders = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, item in enumerate(items):
            n = len(item.words)
            kept = max(1, math.ceil(share * n - 1e-9))
            self.need[i], self.reach[i] = max(1, kept // 3), -(-5 * n // 4)
            b = buckets_of(item.words)
            rare.append(np.unique(b[np.argsort(frequencies[b], kind="stable")[:n - kept + self.need[i]]]))
            holders.append(np.full(len(rare[-1]), i))
        rare, holders = np.concatenate(rare), np.concatenate(holders)
        self.holders = holders[np.argsort(rare, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(rare, minlength=BUCKETS))])

    def candidates(self, texts: list[np.ndarray], most: int = 40_000) -> list[tuple[int, int, int]]:
        """(text, item, place of a rare word) where the item's needed number of rare words stands within its reach."""
        over = int(self.reach.max(initial=1))
        pieces = [(t, at, x[at:at + most + over]) for t, x in enumerate(texts) for at in range(0, len(x), most)]
        found: set[tuple[int, int, int]] = set()
        start = 0
        while start < len(pieces):
            stop, held = start, 0
            while stop < len(pieces) and (stop == start or held < most):
                held += len(pieces[stop][2])
                stop += 1
            found.update(self._candidates(pieces[start:stop]))
            start = stop
        return sorted(found)

    def _candidates(self, pieces):
        ids = np.concatenate([x for _, _, x in pieces])
        ends = np.cumsum([len(x) for _, _, x in pieces])
        each = self.first[ids + 1] - self.first[ids]
        held = int(each.sum())
        place = np.repeat(np.arange(len(ids)), each)
        item = self.holders[np.repeat(self.first[ids] - np.cumsum(each) + each, each) + np.arange(held)]
        order = np.sort(item * len(ids) + place)
        item, place = order // len(ids), order % len(ids)
        owner = np.searchsorted(ends, place, side="right")
        last = np.minimum(np.arange(held) + self.need[item] - 1, held - 1)
        near = (item[last] == item) & (owner[last] == owner) & (place[last] - place < self.reach[item]) \
            & (last - np.arange(held) == self.need[item] - 1)
        for o, i, at in zip(owner[near].tolist(), item[near].tolist(), place[near].tolist()):
            t, base, x = pieces[o]
            yield t, i, base + at - int(ends[o]) + len(x)


def match_rows(docs: DataFrame, items: list[Item], key: str = "doc_id", text: str = "text", rank: int = 128, group: int = 256,
               cosine: float = 0.3, share: float = 0.8, with_answer: float = 0.6, result: str = "matches",
               corpus: CorpusCounts | None = None, rare_words: bool = True) -> DataFrame:
    """``docs`` with an array column ``result``: one struct per item that the row's text holds.

    Fields: ``item_id``, ``item_words``, ``lcs`` (words of the item in order in the best span), ``cosine`` and
    ``answer_found``. A candidate counts when its span keeps ``share`` of the item's words in order, or
    ``with_answer`` of them and four fifths of the answer's. All columns of ``docs`` stay (one named ``result`` is
    replaced). Word frequencies, the latent basis and candidates cover every document. ``corpus`` are the
    ``corpus_counts`` for the buckets of the items' words, counted here unless given.

    Candidates are windows with a latent cosine of at least ``cosine`` of what the basis keeps of an item. Each ``group``
    of items has a basis of ``rank`` directions of its own, all searched in one pass over the texts. Items of which a
    copy may stay below that (``LatentIndex.beyond``) are looked up by their rare words as well, which need no basis and
    no weights; ``rare_words`` can turn that off. ``cosine`` is then that of the words from there on.

    A null or empty text and an item without words match nothing; rows with a null key are searched like others;
    repeated rows give equal results; a very long text is searched in all its windows; an empty table gives an
    empty table.
    """
    given = [i for i in items if i.words]
    if corpus is None:
        corpus = corpus_counts(docs, np.concatenate([np.empty(0, np.int64), *[buckets_of(i.words) for i in given]]), key, text)
    indexes = [LatentIndex(given[at:at + group], corpus.n_docs, corpus.frequencies) for at in range(0, len(given), group)]
    hard: list[int] = []
    for g, index in enumerate(indexes):
        index.fit(corpus.sketch(index.used, index.idf), rank)
        if rare_words:
            hard += (np.flatnonzero(index.beyond(cosine, min(share, with_answer))) + g * group).tolist()
    rare = RareWords([given[i] for i in hard], corpus.frequencies, min(share, with_answer))
    shared = docs.sparkSession.sparkContext.broadcast((given, indexes, hard, rare))

    def start():
        given, indexes, hard, rare = shared.value
        distinct = [frozenset(i.words) for i in given]
        # a span that keeps the asked share of the words lacks no more of the distinct ones than of all
        needed = [len(d) - math.floor((1 - min(share, with_answer)) * len(i.words) + 1e-9) for i, d in zip(given, distinct)]

        def work(texts):
            words = [ascii_words(t) for t in texts]
            buckets = [buckets_of(w) for w in words]
            rows: list[dict[int, dict]] = [{} for _ in texts]

            def match(t, i, span, score):
                item = given[i]
                if len(distinct[i].intersection(span)) < needed[i]:
                    return
                lcs = common_subsequence(item.words, span)
                answer = bool(item.answer) and 5 * common_subsequence(item.answer, span) >= 4 * len(item.answer)
                if lcs >= share * len(item.words) or answer and lcs >= with_answer * len(item.words):
                    rows[t][i] = {"item_id": item.id, "item_words": len(item.words), "lcs": lcs, "cosine": score(),
                                  "answer_found": answer}

            for g, index in enumerate(indexes):
                places: dict[tuple[int, int], list[int]] = {}
                for t, i, at, score in sorted(index.candidates(buckets, cosine), key=lambda c: (c[0], c[1], -c[3])):
                    n, before = len(index.items[i].words), places.setdefault((t, i), [])
                    # a span reaches over its window by more than an item, so windows close by have been covered
                    if i + g * group not in rows[t] and all(abs(at - x) > 3 * n // 4 for x in before):
                        before.append(at)
                        near = 5 * n // 4
                        match(t, i + g * group, words[t][max(at - near, 0):at + 2 * BLOCK + near], lambda: score)
            tried = (-1, -1, 0)
            for t, h, at in rare.candidates(buckets) if hard else ():
                i, near = hard[h], int(rare.reach[h])
                n = len(given[i].words)
                # the span tried last also covers places up to a quarter of the item further on
                if i not in rows[t] and (tried[:2] != (t, i) or at > tried[2] + n // 4):
                    tried = (t, i, at)
                    match(t, i, words[t][max(at - near, 0):at + near + n // 4],
                          lambda: indexes[0].cosine(buckets_of(given[i].words), buckets[t][at:at + n]))
            return [[list(r.values()) for r in rows]]
        return work

    kind = "array<struct<item_id:bigint,item_words:int,lcs:int,cosine:double,answer_found:boolean>>"
    return with_columns(docs, text, {result: kind}, start)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                      item_key: str = "item_id", item_text: str = "text", answer: str | None = None,
                      block_items: int = 2048, **options) -> DataFrame:
    """``key`` and the fields of a match, one row per document row and benchmark item that it holds.

    The benchmark is the query set: it is searched against all rows in blocks of about ``block_items`` items, with the
    corpus counted once. Null, empty, repeated and long texts, null keys, items without words and empty
    tables: as in ``match_rows`` and ``item_blocks``. Other columns are not read.
    """
    found, corpus = None, corpus_counts(docs, item_buckets(benchmark, item_text), key, text)
    slim = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    for items in item_blocks(benchmark, item_key, item_text, answer, block_items):
        rows = match_rows(slim, items, "k", "t", corpus=corpus, **options) \
            .select(F.col("k").alias(key), F.inline("matches"))
        found = rows if found is None else found.union(rows)
    return found


def item_blocks(benchmark: DataFrame, item_key: str = "item_id", item_text: str = "text", answer: str | None = None,
                block_items: int = 2048):
    """The items of a benchmark table in blocks of bounded size; rows without id are left out, repeated ones kept once. A
    null or empty text gives an item without words, an empty table one empty block."""
    given = F.lit(None).cast("string") if answer is None else F.col(f"`{answer}`")
    items = benchmark.select(F.col(f"`{item_key}`").cast("bigint").alias("i"), F.col(f"`{item_text}`").alias("t"),
                             given.alias("a")).where("i is not null").distinct()
    blocks = max(1, -(-items.count() // block_items))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        yield [item_of(r.i, r.t, r.a) for r in part]
