"""Ids that stay with their keys from load to load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.operators.windows import dense_row_id
from opsledger.sources.versions import VersionedTable


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


def lasting_ids(df: DataFrame, keys: list[str], table: VersionedTable, out: str) -> DataFrame:
    """``df`` with the id of its key from a stored table of keys; keys that are new there get the next numbers first.

    New keys are numbered 1, 2, ... in their order after the largest id so far, by range partitions and offsets, so the
    ids are dense and no task sees all of them. A load with keys that are all known writes nothing. A null is a key
    value like others. Two loads at the same time cannot give one id to two keys: the second one raises
    ``TableChanged`` and is run again.
    """
    found = df.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    top = 0
    if table.exists():
        known = table.read().toDF(*[f"_k{i}" for i in range(len(keys))], out)
        top = known.agg(F.max(out)).first()[0] or 0
        found = found.join(known, _same(keys), "left_anti")
    fresh = dense_row_id(found, [F.col(f"`{k}`") for k in keys], out).withColumn(out, F.col(out) + top)
    if not table.exists() or not fresh.isEmpty():
        table.append(fresh)
    ids = table.read().toDF(*[f"_k{i}" for i in range(len(keys))], out)
    return df.join(ids, _same(keys), "left").select(*[F.col(f"`{c}`") for c in df.columns if c != out], out)
