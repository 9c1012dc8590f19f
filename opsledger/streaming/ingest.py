"""Incremental ingest: a delivered file is processed once, a re-delivered key replaces the old rows."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.session import folder_exists, names_in, read_small_file, remove_folder, stored
from opsledger.sources.versions import LOAD, Part, VersionedTable


def ingest_available_now(spark: SparkSession, source: str, target: str, checkpoint: str, key: str,
                         schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
                         options: dict | None = None, prepare=None, contents: str | None = None, remember: int = 1000):
    """Process every file not seen before and stop. The checkpoint remembers the files.

    All files of a run are one delivery, into however many micro-batches ``files_per_batch`` cuts it: each batch is
    written once, as a data folder of the table that no version names yet, and the last step makes them all one load
    by publishing a version. A run that fails is finished by the next one, which takes the waiting folders along. Rows
    without a key are kept per delivery, under the identity of the stream and its first batch, so neither another
    source nor a new checkpoint overwrites them.

    The checkpoint knows files by name. With ``contents``, the place of a ledger of digests, a file with the rows of a file
    that came under another name, in this delivery or one of the last ``remember`` ones, adds nothing; that takes one more
    pass over the delivered files, and ``prepare`` then works on one batch at a time. Digests are sums of row hashes with the number of rows, so the order of rows does not
    matter.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(source)
    prepared = stream if prepare is None else prepare(stream)
    stream = prepared if contents is None else stream.select("*", F.col("_metadata.file_path").alias(_FILE))
    table = VersionedTable(spark, target)
    before = table.version()
    number = 1 + (before.number if before else 0)

    def stage(batch, batch_id):
        query_id = _stream_id(spark, checkpoint)
        for name, (_, found, _) in _waiting(table, query_id).items():  # what an earlier try of this batch has left
            if found == batch_id:
                remove_folder(spark, f"{table.path}/data/{name}")
        if contents is not None:
            batch = _new_contents(batch, table, contents, query_id, batch_id, before.marks.get(query_id, -1) if before else -1)
            batch = batch if prepare is None else prepare(batch)
        batch.withColumn(LOAD, F.lit(number).cast("bigint")).write.mode("overwrite") \
            .parquet(f"{table.path}/data/{query_id}.{batch_id}.{number}")

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True) \
        .foreachBatch(stage).start()
    query.awaitTermination()
    query_id = _stream_id(spark, checkpoint)
    seen = -1 if before is None else before.marks.get(query_id, -1)
    waiting = {name: found for name, found in _waiting(table, query_id).items() if found[1] > seen}
    if waiting:
        batches = [b for _, b, _ in waiting.values()]
        if contents is not None:  # before the version: what waits has been judged, what comes later must know it
            _remember_contents(table, contents, query_id, batches, number, remember)
        parts = [_renumbered(table, name, n, number, prepared.schema) for name, (_, _, n) in waiting.items()]
        table.adopt(parts, prepared.schema, f"{query_id}-{min(batches)}", key, before, number, {query_id: max(batches)})
    return query


_FILE = "_delivered_file"


def _digests_of(table: VersionedTable, query_id: str, batch_id: int) -> str:
    return f"{table.path}/contents/{query_id}.{batch_id}"


def _new_contents(batch: DataFrame, table: VersionedTable, contents: str, query_id: str, batch_id: int, seen: int) -> DataFrame:
    """The rows of the files of a batch whose contents are new; digests are kept beside the table until the load is made."""
    columns = [c for c in batch.columns if c != _FILE]
    values = [v for c in columns for v in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    sums = [F.sum(F.xxhash64(F.lit(salt), *values).cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    digests = stored(batch.groupBy(_FILE).agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), *sums).alias("digest")),
                     _digests_of(table, query_id, batch_id))
    ledger = VersionedTable(table.spark, contents)
    known = [ledger.read().select("digest")] if ledger.exists() else []
    earlier = [n.rsplit(".", 1) for n in names_in(table.spark, f"{table.path}/contents")]
    known += [table.spark.read.parquet(_digests_of(table, q, int(b))).select("digest") for q, b in earlier
              if q == query_id and seen < int(b) < batch_id]
    first = digests.groupBy("digest").agg(F.min(_FILE).alias("_first"))
    for frame in known:
        first = first.join(frame, "digest", "left_anti")
    # one row per file of the batch, as many as the driver has planned
    return batch.join(F.broadcast(first.select("_first")), F.col(_FILE) == F.col("_first"), "left_semi").drop(_FILE)


def _remember_contents(table: VersionedTable, contents: str, query_id: str, batches: list[int], number: int, remember: int) -> None:
    ledger = VersionedTable(table.spark, contents)
    kept = [b for b in batches if folder_exists(table.spark, _digests_of(table, query_id, b))]
    if not kept:  # an earlier run got as far as the ledger
        return
    rows = reduce(DataFrame.union, [table.spark.read.parquet(_digests_of(table, query_id, b)).select("digest") for b in kept]) \
        .select("digest", F.lit(number).cast("bigint").alias("delivery"))
    if ledger.exists():
        rows = ledger.read().where(F.col("delivery") > number - remember).union(rows)
    ledger.replace(rows.groupBy("digest").agg(F.max("delivery").alias("delivery")))
    for b in kept:
        remove_folder(table.spark, _digests_of(table, query_id, b))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that Spark keeps in its checkpoint."""
    return json.loads(read_small_file(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def _waiting(table: VersionedTable, query_id: str) -> dict[str, tuple[str, int, int]]:
    """Data folders that runs of this stream have written: name to (stream, batch, load number)."""
    parts = {n: n.split(".") for n in names_in(table.spark, f"{table.path}/data")}
    return {n: (p[0], int(p[1]), int(p[2])) for n, p in parts.items() if len(p) == 3 and p[0] == query_id}


def _renumbered(table: VersionedTable, name: str, written: int, number: int, schema: T.StructType) -> Part:
    """The folder as a part of load ``number``; written anew if another writer has taken its number meanwhile."""
    if written == number:
        return Part(f"data/{name}")
    rows = table.spark.read.schema(T.StructType([*schema, T.StructField(LOAD, T.LongType())])).parquet(f"{table.path}/data/{name}")
    again = name.rsplit(".", 1)[0] + f".{number}"
    rows.withColumn(LOAD, F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{table.path}/data/{again}")
    remove_folder(table.spark, f"{table.path}/data/{name}")
    return Part(f"data/{again}")
