"""Token counts of whole texts under a byte-level pair vocabulary, without producing the tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm.arrow import map_documents
from opsledger.llm.bpe import PieceCounter


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row of ``docs``.

    Each word is merged by a heap of pair ranks over a linked symbol list, and counts as its bytes less its merges.
    Special strings inside a text count as one token each. ``vocabulary`` is the path of the vocabulary file, which
    every executor must have.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted one by one; a null key stays null. A
    very long word is merged in time n log n and not cached. An empty table gives an empty table. Other columns
    are not read.
    """
    def start():
        count = PieceCounter(vocabulary).of
        return lambda texts: [[len(t.encode("utf-8")) if t else 0 for t in texts], [count(t) for t in texts]]

    return map_documents(docs, key, text, f"`{key}` bigint, n_bytes bigint, n_tokens bigint", start) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
