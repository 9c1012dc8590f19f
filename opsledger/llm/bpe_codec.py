"""Encode whole texts to ids of a word-end pair vocabulary and decode ids to text."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm.arrow import frees_memory, map_documents
from opsledger.llm.bpe import WordCodec


def encode_texts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) per row of ``docs``.

    A priority queue of merge ranks works over a doubly linked symbol list for each word and skips stale entries.
    A null, empty or blank text has no ids. Special strings inside a text become their ids. Repeated rows are
    encoded one by one, a null key stays null, an empty table gives an empty table; other columns are not read.
    """
    def start():
        encode = WordCodec(vocabulary).encode
        return lambda texts: [[encode(t) for t in texts]]

    return map_documents(docs, key, text, f"`{key}` bigint, ids array<int>", start)


def decode_ids(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``decoded`` per row: the vocabulary strings of ``ids`` one after the other.

    A null or empty list gives ''. A list with an id that the vocabulary does not have (negative, too large or null)
    has no text: null. Repeated rows are decoded one by one, a null key stays null, an empty table gives an empty
    table; other columns are not read.
    """
    slim = encoded.select(F.col(f"`{key}`").alias("k"), F.col(f"`{ids}`").alias("i"))

    @frees_memory
    def run(batches):
        codec = WordCodec(vocabulary)
        size = len(codec.strings)
        for batch in batches:
            texts = [codec.decode(i or []) if all(x is not None and 0 <= x < size for x in i or []) else None
                     for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["k", "decoded"])

    return slim.mapInArrow(run, f"k {slim.schema[0].dataType.simpleString()}, decoded string").withColumnRenamed("k", key)


def round_trip_digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` per row, encoded and decoded in one pass.

    The ids of a corpus take more room than its texts, so they are digested where they are made. Edge cases as in
    ``encode_texts``; a text without ids has the digests of the empty string.
    """
    def start():
        codec = WordCodec(vocabulary)
        numerals = [str(i) for i in range(len(codec.strings))]

        def sha(s: str) -> str:
            return hashlib.sha256(s.encode("utf-8")).hexdigest()

        def work(texts):
            counts, of_ids, of_text = [], [], []
            for t in texts:
                ids = codec.encode(t)
                counts.append(len(ids))
                of_ids.append(sha(" ".join(map(numerals.__getitem__, ids))))
                of_text.append(sha(codec.decode(ids)))
            return [counts, of_ids, of_text]
        return work

    return map_documents(docs, key, text, f"`{key}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", start)
