"""Token sequences written to fixed-stride shards in a keyed pseudo-random order."""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.arrow import frees_memory, slices
from opsledger.llm.shingles import mixed
from opsledger.session import remove_folder, run_folder, stored

#: Fixed value: the pattern that splits text before the merges of the rank file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) >= 1 << 16:
        raise ValueError("token ids must fit in 16 bits")
    return tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Permutation:
    """A bijection of 0 .. size - 1: a Feistel network over the next even power of two, walked until it lands inside."""

    def __init__(self, size: int, key: int, rounds: int = 6):
        self.size = size
        self.half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = np.random.default_rng(key).integers(0, 1 << 64, rounds, dtype=np.uint64)

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys:
            left, right = right, left ^ (mixed(right + k) & self.mask)
        return (left << self.half) | right

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        x = self._once(numbers.astype(np.uint64))
        while (out := x >= self.size).any():
            x[out] = self._once(x[out])
        return x.astype(np.int64)


@dataclass(frozen=True)
class Shards:
    """Where the sequences lie: record ``slot % records`` of shard ``slot // records``, ``stride`` bytes per record."""
    folder: str
    sequences: int
    tokens: int
    records: int

    @property
    def stride(self) -> int:
        return 2 * self.tokens + 1


def pack_sequences(docs: DataFrame, vocabulary: str, key: str, text: str, tokens: int) -> DataFrame:
    """``ids`` (16-bit little-endian), ``n_tokens`` and ``doc_ids`` per sequence of ``tokens`` ids, with ``task`` and ``row``.

    The documents of a task stand one after the other, each closed by an end id; the task's last sequence is filled
    up with end ids. ``doc_ids`` are the documents with an id in the sequence, in order. ``row`` counts the sequences of
    a task from 0.
    """
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))

    @frees_memory
    def run(batches):
        model = encoding(vocabulary)
        end = np.array([model.n_vocab], np.uint16)
        held, open_docs, filled = [], [], 0
        task, made = TaskContext.get().partitionId(), 0

        def cut(last: bool):
            """Full sequences of what is held; with ``last`` also the rest, filled up."""
            nonlocal held, open_docs, filled, made
            ids = np.concatenate(held) if held else np.empty(0, np.uint16)
            out = []
            for at in range(0, len(ids), tokens):
                part = ids[at:at + tokens]
                if len(part) < tokens and not last:
                    break
                inside = [k for k, begin, stop in open_docs if begin < at + tokens and stop > at]
                whole = part if len(part) == tokens else np.append(part, np.repeat(end, tokens - len(part)))
                out.append((whole.astype("<u2").tobytes(), len(part), inside))
            used = len(ids) if last else len(ids) // tokens * tokens
            held = [ids[used:]]
            open_docs = [(k, begin - used, stop - used) for k, begin, stop in open_docs if stop > used]
            filled = len(ids) - used
            made += len(out)
            return pa.RecordBatch.from_arrays([
                pa.array([task] * len(out), pa.int32()), pa.array(range(made - len(out), made), pa.int64()),
                pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int32()),
                pa.array([o[2] for o in out], pa.list_(pa.int64()))], names=["task", "row", "ids", "n_tokens", "doc_ids"])

        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(model.encode_to_numpy(t or "", disallowed_special=()).astype(np.uint16), end)
                    held.append(ids)
                    open_docs.append((k, filled, filled + len(ids)))
                    filled += len(ids)
                yield cut(False)
        yield cut(True)

    return slim.mapInArrow(run, "task int, row bigint, ids binary, n_tokens int, doc_ids array<bigint>")


def write_shards(docs: DataFrame, vocabulary: str, folder: str | None = None, key: str = "doc_id", text: str = "text",
                 tokens: int = 2048, records: int = 4096, seed: int = 20240229) -> tuple[DataFrame, Shards]:
    """Write all sequences of ``docs`` in training order; returns the index and the place of the shards.

    The packed sequences are stored once; a sequence's number is its place in its task after those of the tasks before,
    so numbers are dense and a task that runs again changes none. Only the number of sequences per task reaches the
    driver, and tasks get their sums as an array of 8 bytes per packing task: rows learn their numbers where they are.
    The keyed permutation turns numbers to slots. Sequences are shuffled once, to the partition of their shard's range,
    where each shard is sorted and written as one file of equal records, so any slot is found by arithmetic and a
    reader can go on from any slot. The index has one row per sequence: ``slot``, ``shard``, ``byte_offset``, ``n_tokens``
    (without filling) and ``doc_ids``. When both stand, the packed sequences are removed.

    A null or empty text is one end id. Repeated rows are written again, a null key is null in ``doc_ids``, a long
    text fills many sequences. An empty table has no sequences and an empty index.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "training_order")
    pack_sequences(docs, vocabulary, key, text, tokens).write.option("compression", "zstd").parquet(f"{folder}/packed")
    packed = spark.read.parquet(f"{folder}/packed")
    per_task = packed.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(max((r.task for r in per_task), default=-1) + 1, np.int64)
    counts[[r.task for r in per_task]] = [r.n for r in per_task]
    size = int(counts.sum())
    before = spark.sparkContext.broadcast(np.cumsum(counts) - counts)
    shards = Shards(f"{folder}/shards", size, tokens, records)
    order = Permutation(size, seed)

    def placed(columns: list[str], schema: str, change=lambda c: c) -> DataFrame:
        @frees_memory
        def run(batches):
            for batch in batches:
                slot = order.slots(before.value[batch.column(0).to_numpy()] + batch.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(slot), *map(change, batch.columns[2:])], names=["slot", *columns])
        return packed.select("task", "row", *columns).mapInArrow(run, schema)

    count = -(-size // records)
    if count:
        def packed_small(column):
            squeeze = zstandard.ZstdCompressor(level=3).compress
            return pa.array([squeeze(b) for b in column.to_pylist()], pa.binary())

        @frees_memory
        def unpack(batches):
            stretch = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                yield batch.set_column(1, "ids", pa.array([stretch(b) for b in batch.column(1).to_pylist()], pa.binary()))

        rows = placed(["ids"], "slot bigint, ids binary", packed_small)
        shard = F.expr(f"slot div {records}")
        parts = min(count, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
        rows.repartitionById(parts, F.expr(f"cast(slot div {records} * {parts} div {count} as int)")) \
            .mapInArrow(unpack, "slot bigint, ids binary").withColumn("shard", shard) \
            .sortWithinPartitions("shard", "slot").select(F.col("ids").cast("string").alias("value"), "shard") \
            .write.partitionBy("shard").text(shards.folder)
    index = stored(placed(["n_tokens", "doc_ids"], "slot bigint, n_tokens int, doc_ids array<bigint>"), f"{folder}/index")
    remove_folder(spark, f"{folder}/packed")
    return index.select("slot", F.expr(f"slot div {records}").alias("shard"),
                        (F.col("slot") % records * shards.stride).alias("byte_offset"), "n_tokens", "doc_ids"), shards


def read_slots(spark: SparkSession, shards: Shards, first: int = 0) -> DataFrame:
    """``slot`` and ``ids`` of all records from slot ``first`` on, in whole shards read one after the other."""
    begin = first // shards.records
    paths = [f"{shards.folder}/shard={i}" for i in range(begin, -(-shards.sequences // shards.records))]
    if not paths:
        return spark.createDataFrame([], "slot bigint, ids array<int>")
    files = spark.read.format("binaryFile").load(paths).select(
        F.regexp_extract("path", r"shard=(\d+)", 1).cast("bigint").alias("shard"), "content")

    @frees_memory
    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                slots, ids = [], []
                for at in range(0, len(content), shards.stride):
                    slots.append(shard * shards.records + at // shards.stride)
                    ids.append(np.frombuffer(content, "<u2", shards.tokens, at).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["slot", "ids"])

    return files.mapInArrow(run, "slot bigint, ids array<int>").where(F.col("slot") >= first)
