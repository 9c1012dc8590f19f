"""Session helpers: literal tables and the shared folder for written state."""

from __future__ import annotations

import gc
import tempfile
import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A table written out in code, as a ``VALUES`` relation.

    Catalyst knows the size of a ``VALUES`` relation exactly, so joins with it
    go broadcast by the session's size threshold without a hint.
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(columns)
    casts = ", ".join(f"CAST({name} AS {dtype}) AS {name}" for name, dtype in columns.items())
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine, or name a ``file:`` folder; on a
    cluster each machine would have its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if root:
        if not local and root.startswith("file:"):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on a cluster, not {root}")
        return root.rstrip("/")
    if not local:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="opsledger-")
        spark.sparkContext.setCheckpointDir(_LOCAL_FOLDERS[application])
    return _LOCAL_FOLDERS[application]


# The fallback folder of each local application.
_LOCAL_FOLDERS: dict[str, str] = {}


def _place(spark: SparkSession, path: str):
    """The path and the file system of whatever store it names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or file; nothing happens when it is not there."""
    place, store = _place(spark, path)
    store.delete(place, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible entries of a folder, sorted; none when it is not there."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return []
    names = (status.getPath().getName() for status in store.listStatus(place))
    return sorted(n for n in names if not n.startswith((".", "_")))


def read_small_file(spark: SparkSession, path: str) -> str:
    place, store = _place(spark, path)
    stream = store.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_small_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole under a new name, by a rename. False when the name is taken."""
    place, store = _place(spark, path)
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = store.create(own)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not store.exists(place) and store.rename(own, place):
        return True
    store.delete(own, False)
    return False


def remove_run_folders(spark: SparkSession) -> None:
    """Remove all folders that ``run_folder`` gave this application. Frames that read them end to be usable."""
    for path in _RUN_FOLDERS.pop(spark.sparkContext.applicationId, []):
        remove_folder(spark, path)


_RUN_FOLDERS: dict[str, list[str]] = {}


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Give the disk of finished steps back while a long job goes on.

    Spark removes shuffle files when the driver's collector finds that nothing refers to them any more, which may be
    long after a step's result was stored. This asks both collectors to look now.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    own = f"{shared_folder(spark)}/opsledger/{uuid.uuid4().hex}"
    _RUN_FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(own)
    return f"{own}/{name}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so lost executors cannot change it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table and read it back: later plans start from the files, not from its inputs."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
