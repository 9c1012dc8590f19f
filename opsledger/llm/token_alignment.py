"""Alignment of two tokenizers' tokens over whole texts, with corpus-wide counts of linked id pairs.

Tokenizer A is a byte-level pair vocabulary and B a piece vocabulary; both split the same bytes. Most tokens of A have a
token of B with the same bytes, its identity: ``identity[a]`` is known beforehand, so links of that kind are counted in
one vector as long as A's vocabulary. Only the other links, from groups that are not one-to-one, are counted as pairs.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm.arrow import frees_memory, slices
from opsledger.llm.bpe import byte_letters, pair_table
from opsledger.session import run_folder, stored

#: Fixed value: the pattern that the byte-level vocabulary splits texts by before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A block's links are held in memory together: it ends with the document that passes this many bytes of text.
BLOCK_BYTES = 8 << 20
#: Texts are aligned in one go up to this many bytes.
STEP_BYTES = 1 << 20


def _byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a vocabulary file without its special tokens; ``path`` ends in .json or .tiktoken."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    else:
        value = {c: i for i, c in enumerate(byte_letters())}
        table = pair_table(path)
        found = {i: bytes(map(value.__getitem__, s)) for s, i in table.ids.items() if s not in table.special}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def _piece_bytes(model: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode("utf-8")


class Aligner:
    """Both tokenizers, the identity array and the alignment of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.bytes_a = _byte_level_tokens(path_a)
        # a rank file states merges by their result: the id order of a byte-level vocabulary is the order of its merges
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={b: i for i, b in enumerate(self.bytes_a) if b},
                                   special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [_piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 ids need wider pairs")
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # the last piece with some bytes: a piece of one byte is written before its fallback byte is needed
        same = {x: i for i, x in enumerate(self.bytes_b) if not (self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([same.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        n, m = len(self.bytes_a), len(self.bytes_b)
        self.at = {"one": 0, "a,": n, "a|": 2 * n, "b,": 3 * n, "b;": 3 * n + m}
        self.names = np.array([b"%d|%d;" % (a, b) for a, b in enumerate(self.identity.tolist())] + [b"%d," % a for a in range(n)]
                              + [b"%d|" % a for a in range(n)] + [b"%d," % b for b in range(m)] + [b"%d;" % b for b in range(m)])

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text; none where the joined bytes of either are not those of a space and the text."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        ids_b = iter(self.b.encode([t for t in texts if t], num_threads=1))
        found = []
        for t in texts:
            if not t:
                found.append(none)
                continue
            b, raw = next(ids_b), b" " + t.encode("utf-8")
            a = self.a.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64)
            whole = int(self.size_a[a].sum()) == len(raw) and b"".join(map(self.bytes_b.__getitem__, b)) == raw \
                and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw
            found.append((a, np.array(b, np.int64)) if whole else none)
        return found

    def align(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers per text, digests per text, and the links as (text, A id, B id), in one pass over all bytes.

        Token ends are marks on the joined bytes; each stretch between neighbouring marks is one link, and marks of
        both kinds end groups.
        """
        tokens = self.tokens(texts)
        n_a, n_b = (np.array([len(t[i]) for t in tokens], np.int64) for i in (0, 1))
        a, b = (np.concatenate([t[i] for t in tokens]) if tokens else np.empty(0, np.int64) for i in (0, 1))
        if not len(a):
            zero = np.zeros(len(texts), np.int64)
            return {"n_a": n_a, "n_b": n_b, "n_groups": zero, "n_links": zero}, [""] * len(texts), (a, a, a)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        marks = np.zeros(int(ends_a[-1]) + 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] |= 2
        ends = np.flatnonzero(marks)
        kind = marks[ends]
        is_a, is_b, last = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64), kind == 3
        link_a, link_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        groups = int(last.sum())
        text_a = np.repeat(np.arange(len(texts)), n_a)
        pair_a, pair_b, text = a[link_a], b[link_b], text_a[link_a]
        links = np.bincount(text, minlength=len(texts))
        text_of_group = text[last]
        numbers = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text_of_group, minlength=len(texts)), "n_links": links}
        # strings of the groups: one for a pair of same bytes, else one for each token
        first_a, first_b = np.append(0, link_a[last] + 1), np.append(0, link_b[last] + 1)
        in_a, in_b = np.diff(first_a), np.diff(first_b)
        one = (in_a == 1) & (in_b == 1) & (self.identity[a[first_a[:-1]]] == b[first_b[:-1]])
        base = np.append(0, np.cumsum(np.where(one, 1, in_a + in_b)))
        codes = np.empty(int(base[-1]), np.int64)
        codes[base[:-1][one]] = a[first_a[:-1][one]] + self.at["one"]
        for ids, first, inside, ahead, more, end in ((a, first_a, in_a, np.zeros(groups, np.int64), "a,", "a|"),
                                                     (b, first_b, in_b, in_a, "b,", "b;")):
            group = np.repeat(np.arange(groups), inside)
            place = np.arange(len(ids)) - first[group]
            kept = ~one[group]
            group, place, ids = group[kept], place[kept], ids[kept]
            codes[base[group] + ahead[group] + place] = ids + np.where(place == inside[group] - 1, self.at[end], self.at[more])
        bounds = base[np.append(0, np.cumsum(numbers["n_groups"]))]
        digests = [hashlib.sha256(self.names[codes[lo:hi]].tobytes().replace(b"\0", b"")[:-1]).hexdigest() if hi > lo else ""
                   for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return numbers, digests, (text, pair_a, pair_b)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _by_text(text: np.ndarray, ids: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each text one after the other, how often each occurs, and where each text ends."""
    both, n = np.unique(text.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), return_counts=True)
    ends = np.cumsum(np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=texts))
    return (both & np.uint64(0xFFFFFFFF)).astype(np.int64), n, ends


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCK = ("block bigint, keys array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
          "digests array<string>, same binary, same_n binary, same_ends binary, pair_at binary, pair_n binary, pair_ends binary, "
          "same_ids array<bigint>, same_docs array<bigint>, pairs array<bigint>, pair_docs array<bigint>")


def _block_rows(docs: DataFrame, path_a: str, path_b: str, block_bytes: int) -> DataFrame:
    """One row per block of documents: their numbers, their links as sparse rows, and the block's counts.

    ``same_ids``/``same_docs`` are the used part of the vocabulary-length count vector, ``pairs``/``pair_docs`` the
    other id pairs (``a << 16 | b``) with the number of the block's documents that hold them.
    """
    @frees_memory
    def run(batches):
        both = aligner(path_a, path_b)
        task, made, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def block():
            nonlocal made, held, size
            keys = pa.concat_arrays([h[0] for h in held])
            numbers = {c: np.concatenate([h[1][c] for h in held]) for c in _NUMBERS}
            digests = [d for h in held for d in h[2]]
            same, same_n, pair, pair_n = (np.concatenate([h[3][i] for h in held]) for i in (0, 1, 3, 4))
            same_ends, pair_ends = (np.concatenate([h[3][i] + before for h, before in zip(
                held, np.cumsum([0, *(len(h[3][i - 2]) for h in held)]))]) for i in (2, 5))
            vector = np.bincount(same, minlength=len(both.identity))
            names, at, docs_of = np.unique(pair, return_inverse=True, return_counts=True)
            used = np.flatnonzero(vector)
            small = [same.astype("<u2"), same_n.astype("<u4"), same_ends.astype("<u4"), at.astype("<u4"), pair_n.astype("<u4"),
                     pair_ends.astype("<u4")]

            def whole(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            row = [pa.array([task << 32 | made], pa.int64()), whole(keys), *(whole(pa.array(numbers[c], pa.int64())) for c in _NUMBERS),
                   whole(pa.array(digests, pa.string())), *(pa.array([x.tobytes()], pa.binary()) for x in small),
                   *(whole(pa.array(x, pa.int64())) for x in (used, vector[used], names, docs_of))]
            made, held, size = made + 1, [], 0
            return pa.RecordBatch.from_arrays(row, names=[f.split(" ")[0] for f in _BLOCK.split(", ")])

        for batch in batches:
            for part in slices(batch, 1, STEP_BYTES):
                texts = part.column(1).to_pylist()
                numbers, digests, (text, a, b) = both.align(texts)
                regular = both.identity[a] == b
                held.append((part.column(0), numbers, digests,
                             (*_by_text(text[regular], a[regular], len(texts)),
                              *_by_text(text[~regular], a[~regular] << 16 | b[~regular], len(texts)))))
                size += part.column(1).nbytes
                if size >= block_bytes or sum(len(h[0]) for h in held) >= 100_000:
                    yield block()
        if held:
            yield block()

    return docs.mapInArrow(run, _BLOCK)


def _vector(sums: DataFrame, size: int) -> np.ndarray:
    """A vocabulary-length vector from rows ``a``, ``n``: one row per id at most reaches the driver."""
    out = np.zeros(size, np.int64)
    for r in sums.collect():
        out[r.a] = r.n
    return out


def align_tokens(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A encodes a space and the text, B the text (it adds the space itself); special strings are plain text. Byte
    offsets at which tokens of both end cut the tokens into groups. A link is a token of A and one of B whose bytes
    overlap; the count of its id pair is the number of rows that hold it linked. ``n_best`` are the links whose count
    is the highest of their A id, ``count_sum`` is the sum of counts over links. ``groups_sha256`` digests
    ``a1,a2|b1;a3|b2,b3``: ids by group, in order.

    Texts are encoded once; blocks of documents keep their links as sparse rows in the shared folder. Links with the
    identity of an A id are counted in a vector, other pairs by their blocks' counts: a pair that one block alone
    holds is known there, the others' counts come back to their blocks by a join. So what is shuffled has the size of
    the blocks' pair tables.

    A null or empty text has no tokens, nor has one whose joined token bytes differ from the space and the text (B's
    marker character is an example): zeros and '' in the digest column. Repeated rows count as documents of their own;
    a null key stays null. A very long text is aligned as a whole. An empty table gives an empty table. Other columns
    are not read.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "token_alignment")
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    blocks = stored(_block_rows(slim, path_a, path_b, block_bytes), f"{folder}/blocks")
    size = len(aligner(path_a, path_b).identity)
    same = blocks.select(F.inline(F.arrays_zip(F.col("same_ids").alias("a"), F.col("same_docs").alias("m")))) \
        .groupBy("a").agg(F.sum("m").alias("n"))
    held = blocks.select("block", F.posexplode(F.arrays_zip(F.col("pairs").alias("p"), F.col("pair_docs").alias("m")))) \
        .select("block", F.col("pos").alias("at"), "col.p", "col.m")
    counts = stored(held.groupBy("p").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("blocks")), f"{folder}/counts")
    same_count = _vector(same, size)
    top = np.maximum(same_count, _vector(counts.groupBy(F.shiftrightunsigned("p", 16).alias("a")).agg(F.max("n").alias("n")), size))
    back = held.select("block", "at", "p").join(counts.where("blocks > 1").select("p", "n"), "p") \
        .groupBy("block").agg(F.collect_list(F.struct("at", "n")).alias("back"))
    known = blocks.drop("same_ids", "same_docs").join(stored(back, f"{folder}/back"), "block", "left")
    shared = spark.sparkContext.broadcast((same_count, top))

    names = ["keys", *_NUMBERS, "digests", "same", "same_n", "same_ends", "pair_at", "pair_n", "pair_ends", "pairs", "pair_docs"]

    @frees_memory
    def finish(batches):
        same_count, top = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                value = {n: batch.column(j)[i] for j, n in enumerate(names)}
                sparse = {n: np.frombuffer(value[n].as_py(), "<u2" if n == "same" else "<u4").astype(np.int64) for n in names[6:12]}
                pairs, count = (value[n].values.to_numpy().copy() for n in ("pairs", "pair_docs"))
                back = batch.column(len(names))[i]
                if back.is_valid and len(back):
                    count[back.values.field("at").to_numpy()] = back.values.field("n").to_numpy()
                best = count == top[pairs >> 16]
                total, hits = (_row_sums(sparse["same_n"] * x[sparse["same"]], sparse["same_ends"])
                               + _row_sums(sparse["pair_n"] * y[sparse["pair_at"]], sparse["pair_ends"])
                               for x, y in ((same_count, count), (same_count == top, best)))
                yield pa.RecordBatch.from_arrays(
                    [value["keys"].values, *(value[n].values for n in _NUMBERS), pa.array(hits), pa.array(total), value["digests"].values],
                    names=["k", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])

    schema = "k bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return known.select(*names, "back").mapInArrow(finish, schema).withColumnRenamed("k", key)


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the given ends, exact in 64 bits."""
    running = np.append(0, np.cumsum(values, dtype=np.int64))
    return np.diff(running[np.append(0, ends)])
