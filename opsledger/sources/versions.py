"""Stored tables in versions: whole old states for readers, one rename per change.

A table is a folder with ``data`` (folders of Parquet files) and ``versions`` (one small file per version, which names the
data of that version). A change writes new data beside the old and then puts a new version file in place by a rename,
so a reader sees the state before or the state after, a failed write leaves a folder that no version names, and readers
of earlier versions go on. Data is removed by ``vacuum`` only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.session import folder_exists, names_in, publish_small_file, read_small_file, remove_folder

LOAD = "_load"
#: A keyed table knows the ids of so many loads, the latest ones.
REMEMBERED = 10_000


class TableChanged(RuntimeError):
    """Another writer has made the version that this one was about to make."""


@dataclass(frozen=True)
class Part:
    """A folder of rows that belongs to a version: all of its files, or those in ``files``."""
    folder: str
    files: list[str] | None = None


@dataclass(frozen=True)
class Version:
    """What a version consists of. Keyed tables also have folders of replaced keys and the ids of their loads."""
    number: int
    schema: str
    rows: list[Part]
    key: str | None = None
    keys: list[Part] = field(default_factory=list)
    loads: list[str] = field(default_factory=list)
    marks: dict[str, int] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    """A table at ``path``. Every method that changes it ends with one new version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- versions ---------------------------------------------------------------------------------

    def numbers(self) -> list[int]:
        return [int(n) for n in names_in(self.spark, f"{self.path}/versions") if n.isdigit()]

    def version(self, number: int | None = None) -> Version | None:
        """A version, the latest unless asked for another; None before the first one."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return None
        found = json.loads(read_small_file(self.spark, f"{self.path}/versions/{number:012d}"))
        for name in ("rows", "keys"):
            found[name] = [Part(**p) for p in found[name]]
        return Version(**found)

    def exists(self) -> bool:
        return bool(self.numbers())

    def _publish(self, version: Version) -> Version:
        text = json.dumps(asdict(version))
        if not publish_small_file(self.spark, f"{self.path}/versions/{version.number:012d}", text):
            raise TableChanged(f"version {version.number} of {self.path} is there already")
        return version

    def _new_folder(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def _write(self, df: DataFrame) -> Part:
        part = Part(self._new_folder())
        df.write.mode("errorifexists").parquet(f"{self.path}/{part.folder}")
        return part

    def _paths(self, parts: list[Part]) -> list[str]:
        return [f"{self.path}/{p.folder}{f'/{name}' if name else ''}" for p in parts for name in ([None] if p.files is None else p.files)]

    def _frame(self, parts: list[Part], schema: T.StructType) -> DataFrame:
        paths = self._paths(parts)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # ---- reading ----------------------------------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version. The frame stays on that version whatever is written later."""
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._visible(version, self._stored(version)).select(*[F.col(f"`{f.name}`") for f in version.struct.fields])

    def _stored(self, version: Version) -> DataFrame:
        struct = version.struct
        return self._frame(version.rows, struct if version.key is None else T.StructType([*struct, T.StructField(LOAD, T.LongType())]))

    def _visible(self, version: Version, rows: DataFrame) -> DataFrame:
        """Rows that no later load has replaced. Each key meets its last load only, one row per key."""
        if not version.keys:
            return rows
        kind = version.struct[version.key].dataType
        log = self._frame(version.keys, T.StructType([T.StructField("replaced", kind), T.StructField("by", T.LongType())]))
        last = log.groupBy("replaced").agg(F.max("by").alias("by"))
        return rows.join(last, F.col(f"`{version.key}`") == F.col("replaced"), "left") \
            .where(F.col("by").isNull() | (F.col(LOAD) >= F.col("by")))

    # ---- plain tables -----------------------------------------------------------------------------

    def replace(self, df: DataFrame, refuse_empty: bool = False) -> Version:
        """The table is ``df`` from now on. ``df`` may read this table."""
        before = self.version()
        part = self._write(df)
        if refuse_empty and self._frame([part], df.schema).isEmpty():
            remove_folder(self.spark, f"{self.path}/{part.folder}")
            raise ValueError(f"refusing to replace {self.path} with an empty table")
        return self._publish(Version(1 + (before.number if before else 0), df.schema.json(), [part]))

    def append(self, df: DataFrame) -> Version:
        """Rows are added; their columns must be the table's, in name and type."""
        before = self.version()
        if before is None:
            return self.replace(df)
        if before.key is not None:
            raise ValueError("rows of a keyed table come in by a load")
        kinds = [(f.name, f.dataType) for f in before.struct.fields]
        if sorted(kinds, key=str) != sorted(((f.name, f.dataType) for f in df.schema.fields), key=str):
            raise ValueError(f"columns {df.dtypes} are not those of the table: {kinds}")
        part = self._write(df.select(*[F.col(f"`{n}`") for n, _ in kinds]))
        return self._publish(replace(before, number=before.number + 1, rows=[*before.rows, part]))

    def rewrite(self, change: Callable[[DataFrame], DataFrame], refuse_empty: bool = False) -> Version:
        """The table becomes ``change(table)``, written once."""
        return self.replace(change(self.read()), refuse_empty)

    # ---- keyed tables -----------------------------------------------------------------------------

    def load(self, df: DataFrame, load_id: str, key: str, most_loads: int = 16) -> Version:
        """Keyed replacement: old rows whose key is in ``df`` go, all rows of ``df`` come in.

        The rows are written as they are, and their different keys beside them; nothing old is rewritten. Null keys
        match nothing, so old null rows stay and new ones are added. A load whose id the table knows is in it already
        and changes nothing. After ``most_loads`` the table is compacted, so it has no more folders than that, however
        many values the key has.
        """
        before = self.version()
        if before is not None and load_id in before.loads:
            return before
        if before is not None and [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in before.struct]:
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in before.struct])
        number = 1 + (before.number if before else 0)
        return self.adopt([self._write(df.withColumn(LOAD, F.lit(number).cast("bigint")))], df.schema, load_id, key, before, number,
                          most_loads=most_loads)

    def adopt(self, parts: list[Part], schema: T.StructType, load_id: str, key: str, before: Version | None, number: int,
              marks: dict[str, int] | None = None, most_loads: int = 16) -> Version:
        """Make folders of rows that are written already (with ``LOAD`` = ``number``) one load of version ``number``."""
        if before is None:
            return self._publish(Version(number, schema.json(), parts, key, [], [load_id], marks or {}))
        if before.key != key:
            raise ValueError(f"the table's key is {before.key!r}, not {key!r}")
        rows = self._frame(parts, T.StructType([*before.struct, T.StructField(LOAD, T.LongType())]))
        keys = rows.select(F.col(f"`{key}`").alias("replaced")).where("replaced is not null").distinct()
        log = self._write(keys.withColumn("by", F.lit(number).cast("bigint")))
        version = replace(before, number=number, rows=[*before.rows, *parts], keys=[*before.keys, log],
                          loads=[*before.loads, load_id][-REMEMBERED:], marks={**before.marks, **(marks or {})})
        version = self._publish(version)
        return self.compact() if len(version.keys) >= most_loads else version

    def compact(self) -> Version:
        """The visible rows in one folder without a log of keys. The ids of the loads stay known."""
        before = self.version()
        rows = self.read()
        if before.key is not None:
            rows = rows.withColumn(LOAD, F.lit(before.number + 1).cast("bigint"))
        return self._publish(replace(before, number=before.number + 1, rows=[self._write(rows)], keys=[]))

    # ---- removal ----------------------------------------------------------------------------------

    def remove(self, inside: Column) -> dict[str, int]:
        """Take out the rows for which ``inside`` is true; returns ``rows_before``, ``rows_purged``, ``rows_after``."""
        audit, version = self.removal(inside)
        if version is not None:
            self._publish(version)
        return audit

    def removal(self, inside: Column) -> tuple[dict[str, int], Version | None]:
        """The counts of ``remove`` and the version that would be published, with its data written; None without a change.

        Parquet's footers tell which row groups can hold such rows, so finding them reads those alone. Files without any
        stay as they are; the others are rewritten in one pass that counts what it keeps.
        """
        before = self.version()
        taken = F.coalesce(inside, F.lit(False))
        rows = self._stored(before).withColumn("_file", F.col("_metadata.file_path"))
        seen = self._visible(before, rows)
        hits = seen.where(inside).groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per file to rewrite
        # rows that a later load has replaced lie in the files as well: they are counted with what is visible
        total = seen.count()
        purged = sum(r.n for r in hits)
        audit = {"rows_before": total, "rows_purged": purged, "rows_after": total - purged}
        if not purged:
            return audit, None
        touched = {r["_file"].rsplit("/", 2)[-2] + "/" + r["_file"].rsplit("/", 1)[-1] for r in hits}
        kept, again = [], []
        for part in before.rows:
            folder = part.folder.rsplit("/", 1)[-1]
            names = names_in(self.spark, f"{self.path}/{part.folder}") if part.files is None else part.files
            out = [n for n in names if f"{folder}/{n}" in touched]
            if not out:
                kept.append(part)
                continue
            again.append(Part(part.folder, out))
            if len(out) < len(names):
                kept.append(Part(part.folder, [n for n in names if n not in out]))
        counted = Observation()
        schema = self._stored(before).schema
        rest = self._frame(again, schema).observe(counted, F.count_if(taken).alias("taken")).where(~taken)
        kept.append(self._write(rest))
        if not before.keys and counted.get["taken"] != purged:
            raise RuntimeError(f"{self.path}: {purged} rows were found and {counted.get['taken']} taken out")
        return audit, replace(before, number=before.number + 1, rows=kept)

    def publish(self, version: Version) -> Version:
        """Make a version that ``removal`` prepared the latest one."""
        return self._publish(version)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the latest ``keep`` versions and the data that none of those names; returns the removed folders.

        No writer may be at work: data it has written and not yet published is named by no version.
        """
        numbers = sorted(self.numbers())
        kept = [self.version(n) for n in numbers[-keep:]]
        named = {p.folder.split("/")[1] for v in kept for p in [*v.rows, *v.keys]}
        for n in numbers[:-keep]:
            remove_folder(self.spark, f"{self.path}/versions/{n:012d}")
        gone = [n for n in names_in(self.spark, f"{self.path}/data") if n not in named]
        for n in gone:
            remove_folder(self.spark, f"{self.path}/data/{n}")
        return gone


def store_counted(table: VersionedTable, df: DataFrame, keep: Column, **counts: Column) -> dict[str, int]:
    """Replace a table by the rows of ``df`` with ``keep``, and count over all of its rows in the pass that writes.

    Nothing is shuffled between the counts and the writer, so a task that runs again is counted once.
    """
    seen = Observation()
    table.replace(df.observe(seen, *[c.alias(n) for n, c in counts.items()]).where(keep))
    return {n: seen.get[n] for n in counts}


def is_versioned(spark: SparkSession, path: str) -> bool:
    return folder_exists(spark, f"{path.rstrip('/')}/versions")
