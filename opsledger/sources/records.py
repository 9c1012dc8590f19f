"""Delimited UTF-16 text whose quoted fields may hold line breaks, read in parallel.

A split of a file begins anywhere: inside a quoted field, or even inside a character. So a first pass learns from each
split how it changes the state of a reader, for every state that the reader may be in; composed along a file, these
give the state at the start of each split. A second pass cuts records there. What lies before the first record end of a
split belongs to a record of an earlier split; these pieces, one or two per split, are put together at the end.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Quotes inside a quoted field are doubled; line ends inside it stay as they are.
_OPTIONS = {"escape": '"', "multiLine": "true"}


class _Cutter:
    """Follows the lines of one split from a given state; ``take`` returns after which of some lines a record ends.

    A state is the number of bytes of a character that are still missing (0 or 1), and 2 more inside quotes.

    Lines are bytes between line feeds of the encoding. Such a pair of bytes may also lie across two characters: then
    the line has an odd number of bytes, and it goes on. The lines come as their bytes in a row and the places where
    they begin, with the end of the last, and are judged all at once.
    """

    def __init__(self, state: int, codec: str):
        self.half, self.quoted, self.quote = state % 2, state // 2, '"'.encode(codec)

    def take(self, raw: np.ndarray, places: np.ndarray) -> np.ndarray:
        odd = np.append(self.half, self.half + places[1:] - places[0]) % 2
        found = np.flatnonzero((raw[:-1] == self.quote[0]) & (raw[1:] == self.quote[1]))
        line = np.searchsorted(places, found, side="right") - 1
        # the first byte may end a character, the last one may begin one
        whole = ((found - places[line] - odd[line]) % 2 == 0) & (found + 1 < places[line + 1])
        quotes = np.bincount(line[whole], minlength=len(places) - 1)
        quoted = (self.quoted + np.cumsum(quotes)) % 2
        self.half, self.quoted = int(odd[-1]), int(quoted[-1])
        return (odd[1:] == 0) & (quoted == 0)

    @property
    def state(self) -> int:
        return self.half + 2 * self.quoted


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``file``, ``start`` of the split in it, and ``line`` (bytes), in order within a split."""
    return spark.read.option("encoding", encoding).option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, bool]]:
    """((file, start, further columns), bytes of some lines, their places, whether they are the first of their split)."""
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        line = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        places = np.frombuffer(line.buffers()[1], np.int64)[line.offset:line.offset + len(line) + 1]
        raw = np.frombuffer(line.buffers()[2] or b"", np.uint8)
        file, start = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
        new = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for lo, hi in pairwise([0, *new.tolist(), len(line)]):
            place = tuple(batch.column(i)[lo].as_py() for i in range(batch.num_columns - 1))
            yield place, raw[places[lo]:places[hi]], places[lo:hi + 1] - places[lo], place != last
            last = place


def _changes(lines: DataFrame, codec: str) -> DataFrame:
    """Per split: the state after it for each state before it."""
    def run(batches):
        place, cutters = None, []

        def row():
            # a quote that is open before the split turns what is inside and outside quotes around
            after = [c.state for c in cutters] + [c.state ^ 2 for c in cutters]
            return pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1]], pa.int64()),
                                               pa.array([after], pa.list_(pa.int32()))], names=["file", "start", "after"])

        for here, raw, places, new in _splits(batches):
            if new:
                if place is not None:
                    yield row()
                place, cutters = here, [_Cutter(s, codec) for s in (0, 1)]
            for c in cutters:
                c.take(raw, places)
        if place is not None:
            yield row()

    return lines.mapInArrow(run, "file string, start bigint, after array<int>")


def _starts(changes: DataFrame) -> DataFrame:
    """Per split: the state before it, from the changes of the splits before it in its file (one short row per split)."""
    along = F.array_sort(F.collect_list(F.struct("start", "after")))
    listed = changes.groupBy("file").agg(along.alias("s"))
    begin = F.struct(F.lit(0).alias("state"), F.array().cast("array<struct<start:bigint,state:int>>").alias("out"))
    found = F.aggregate("s", begin, lambda acc, x: F.struct(
        F.get(x["after"], acc["state"]).alias("state"),
        F.concat(acc["out"], F.array(F.struct(x["start"].alias("start"), acc["state"].alias("state")))).alias("out")), lambda acc: acc["out"])
    return listed.select("file", F.inline(found))


def _unsplit(spark: SparkSession, path: str) -> bool:
    """Whether each file at ``path`` is read by one task, since it is compressed in a way that can be read from its start only."""
    from py4j.java_gateway import is_instance_of

    io = spark.sparkContext._jvm.org.apache.hadoop
    codecs = io.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    found = [codecs.getCodec(io.fs.Path(f"/x{end}")) for end in {os.path.splitext(f)[1] for f in spark.read.text(path).inputFiles()}]
    splits = "org.apache.hadoop.io.compress.SplittableCompressionCodec"
    return all(c is not None and not is_instance_of(spark.sparkContext._gateway, c, splits) for c in found)


def _cut(known: DataFrame, codec: str, firsts: bool = False) -> DataFrame:
    """Rows (file, start, part, whole, raw) of lines (file, start, state, line): part 0 is the piece before the first record
    end, the last is the open end. With ``firsts`` only part 0."""
    line_end = np.frombuffer("\n".encode(codec), np.uint8)

    def run(batches):
        place, cutter, piece, part = None, None, [], 0

        def rows(offsets, raw, whole):
            n = len(offsets) - 1
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(place[0], pa.string()), n), pa.repeat(pa.scalar(place[1], pa.int64()), n),
                 pa.array(np.arange(part, part + n)), pa.repeat(pa.scalar(whole), n),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])],
                names=["file", "start", "part", "whole", "raw"])

        def open_end():
            raw = b"".join(piece)
            return rows(np.array([0, len(raw)]), raw, False)

        for here, raw, places, new in _splits(batches):
            if new:
                if place is not None and not (firsts and part):
                    yield open_end()
                place, cutter, piece, part = here, _Cutter(here[2], codec), [], 0
            if firsts and part:
                continue
            ends = np.flatnonzero(cutter.take(raw, places)) + 1
            if firsts:
                ends = ends[:1]
            n = len(places) - 1
            lines = np.insert(raw, np.repeat(places[1:], 2), np.tile(line_end, n))
            if len(ends):
                offsets = np.concatenate([[0], (places + 2 * np.arange(n + 1))[ends]])
                before = b"".join(piece)
                closed, lines = lines[:offsets[-1]], lines[offsets[-1]:]
                offsets[1:] += len(before)
                yield rows(offsets, before + closed.tobytes(), True)
                piece, part = [], part + len(ends)
            piece.append(lines.tobytes())
        if place is not None and not (firsts and part):
            yield open_end()

    return known.mapInArrow(run, "file string, start bigint, part bigint, whole boolean, raw binary")


def _as_text(rows: DataFrame, encoding: str) -> DataFrame:
    """``file``, ``start``, ``place`` and ``record`` of rows (file, start, part, raw)."""
    text = F.regexp_replace(F.decode("raw", encoding), r"\r?\n\z", "")
    whole = rows.withColumn("record", F.when((F.col("start") == 0) & (F.col("part") == 0), F.regexp_replace(text, "\\A\uFEFF", ""))
                            .otherwise(text))
    return whole.where("record <> ''").select("file", "start", F.col("part").alias("place"), "record")


def read_records(spark: SparkSession, path: str, encoding: str = "UTF-16LE", firsts: bool = False) -> DataFrame:
    """``file``, ``start``, ``place`` (order of a record in its file) and ``record`` (text, without its line end) of the files at ``path``.

    A record ends at a line feed outside quotes. One carriage return before it goes, one byte order mark at the start of
    a file too. Empty lines are no records. A quoted field that is never closed makes the rest of its file one record.
    With ``firsts`` only records that a split begins with, or that reach into it. Files that cannot be split, such as
    gzip ones, need neither the first pass nor the last.
    """
    codec = encoding.lower()
    lines = _lines(spark, path, encoding)
    if _unsplit(spark, path):
        return _as_text(_cut(lines.select("file", "start", F.lit(0).alias("state"), "line"), codec, firsts), encoding)
    starts = _starts(_changes(lines, codec))
    # one short row per split, as many as the driver has planned; a join by shuffle would mix up the lines of a split
    known = lines.join(F.broadcast(starts.toDF("f", "s", "state")), (F.col("file") == F.col("f")) & (F.col("start") == F.col("s"))) \
        .select("file", "start", "state", "line")
    cut = _cut(known, codec)
    # records that begin and end in one split are done; the first record end of a split closes what earlier splits left open
    inner = cut.where("whole and part > 0").select("file", "start", "part", "raw")
    edge = cut.where("not whole or part = 0")
    order = Window.partitionBy("file").orderBy("start", "part")
    record = F.coalesce(F.sum(F.col("whole").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = edge.withColumn("record", record).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "part", "raw"))).alias("p")) \
        .select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["part"].alias("part"),
                F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["raw"])).alias("raw"))
    return _as_text(joined if firsts else inner.union(joined), encoding)


def read_delimited_records(spark: SparkSession, path: str, sep: str = "\t", encoding: str = "UTF-16LE", header: bool = True) -> DataFrame:
    """The records of delimited text as columns of strings; an empty field is null.

    The header is the first record of each file; all files must have the same one. A record with another number of
    fields than the header is an error.
    """
    records = read_records(spark, path, encoding)
    first = (F.col("start") == 0) & (F.col("place") == 0)
    heads = [r.record for r in read_records(spark, path, encoding, firsts=True).where(first).select("record").distinct().limit(2).collect()]
    if len(heads) > 1 and header:
        raise ValueError(f"files below {path} have different headers: {heads}")
    if not heads:
        return spark.createDataFrame([], "none string").drop("none")
    names = _fields(spark, heads[0], sep)
    if not header:
        names = [f"_c{i}" for i in range(len(names))]
    kinds = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records.where(~first) if header else records
    parsed = rows.select(F.from_csv("record", F.lit(kinds), {**_OPTIONS, "sep": sep, "mode": "FAILFAST"}).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


def _fields(spark: SparkSession, record: str, sep: str) -> list[str]:
    """The fields of one record, read as Spark reads all of them."""
    most = record.count(sep) + 1
    kinds = ", ".join(f"c{i} string" for i in range(most))
    parsed = F.from_csv("r", F.lit(kinds), {**_OPTIONS, "sep": sep, "mode": "PERMISSIVE"}).alias("x")
    row = spark.createDataFrame([(record,)], "r string").select(parsed).first().x
    values = list(row)
    while len(values) > 1 and values[-1] is None and not record.endswith(sep):
        values.pop()
    return [v if v is not None else f"_c{i}" for i, v in enumerate(values)]
