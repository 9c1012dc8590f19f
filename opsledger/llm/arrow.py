"""Small helpers to run a per-document Python function over Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frees_memory(run: Callable) -> Callable:
    """A task function that gives memory back at its end: Python workers outlive tasks and share a machine with joins."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return wrapped


def map_documents(df: DataFrame, key: str, text: str, schema: str,
                  start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """One output row per input row: ``key`` and what ``start()`` makes of the texts.

    ``start`` runs once per task and returns a function from a list of texts (None: no text) to a list of
    value lists, one list per column after the key in ``schema``. Columns of ``df`` other than ``key`` and
    ``text`` are not read, so their names cannot clash with the result's.
    """
    slim = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    fields = slim.sparkSession.createDataFrame([], schema).schema
    names = [f.name for f in fields][1:]

    @frees_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch, 1):
                columns = work(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, type=t) for c, t in zip(columns, types))],
                                                 names=["k", *names])

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in fields][1:]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields[1:])
    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(run, f"k {kind}, {out}").withColumnRenamed("k", fields[0].name)


def with_columns(df: DataFrame, text: str, added: dict[str, str], start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """``df`` with columns made from its texts; ``added`` gives their names and types, ``start`` is as above.

    A column of ``df`` with the name of an added one is replaced, all others pass through.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    kept = [c for c in df.columns if c not in added]
    rows = df.select(F.col(f"`{text}`").cast("string").alias("c0"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)])
    made = [(f"a{i}", kind) for i, kind in enumerate(added.values())]
    plain = df.sparkSession.createDataFrame([], ", ".join(f"{n} {k}" for n, k in made)).schema
    types = [to_arrow_type(f.dataType) for f in plain]
    names = [f"k{i}" for i in range(len(kept))] + [n for n, _ in made]

    @frees_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch, 0):
                columns = work(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *(pa.array(c, type=t) for c, t in zip(columns, types))],
                                                 names=names)

    schema = ", ".join([*(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)),
                        *(f"{n} {k}" for n, k in made)])
    return rows.mapInArrow(run, schema).toDF(*kept, *added)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its text column passes ``most_bytes``, so memory follows bytes and not row counts."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)
