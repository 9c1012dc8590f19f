"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % folds


def training_labels(labels: DataFrame, key: str, label: str, learn: Column) -> DataFrame:
    """One row ``k``, ``y`` (0 or 1) per labelled key in the learning folds; repeated labels go by majority, ties to 1."""
    return labels.where(learn).groupBy(F.col(f"`{key}`").cast("bigint").alias("k")) \
        .agg((F.avg(F.col(f"`{label}`")) >= 0.5).cast("int").alias("y")).where("k is not null and y is not null")


def below_share(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of its range."""
    return hashed < F.lit(min(int(-(1 << 63) + share * (1 << 64)), (1 << 63) - 1))


def bounded(keys: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` different rows with a ``k``, chosen by a hash of it: the same ones at each run.

    The number of keys sets a share of the hash range that holds about twice as many, so the tasks together send that
    many rows to the last step, however many tasks there are.
    """
    total = keys.count()
    if total > 2 * rows:
        keys = keys.where(below_share(F.xxhash64("k"), 2 * rows / total))
    return keys.distinct().orderBy(F.xxhash64("k"), "k").limit(rows)


def texts_of(docs: DataFrame, keys: DataFrame, key: str, text: str) -> DataFrame:
    """``k``, ``t`` and the columns of ``keys`` for the documents named there."""
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return slim.join(keys, "k")
