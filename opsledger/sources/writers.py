"""Sinks. Tables are kept in versions; exports are Parquet folders by partition; databases go through the JDBC writer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions import scalars as X
from opsledger.sources.versions import VersionedTable


def replace_table(df: DataFrame, path: str, refuse_empty: bool = False) -> None:
    """The table at ``path`` is ``df`` from now on; ``df`` may read it. With ``refuse_empty`` an empty frame changes nothing."""
    VersionedTable(df.sparkSession, path).replace(df, refuse_empty)


def append_table(df: DataFrame, path: str) -> None:
    VersionedTable(df.sparkSession, path).append(df)


def rewrite_table(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a table by ``change(table)``: written once, then seen at once."""
    VersionedTable(spark, path).rewrite(change)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest rows of a stored table, or those of an earlier version."""
    return VersionedTable(spark, path).read(version)


def load_by_key(df: DataFrame, load_id: int | str, path: str, key: str) -> None:
    """Keyed replacement: old rows whose key is in ``df`` go, all rows of ``df`` come in.

    Null keys match nothing, so old null rows stay and new ones are added. A load that is run again after a failure
    (same ``load_id``) gives the same table, so the id must name the source as well as the load.
    """
    VersionedTable(df.sparkSession, path).load(df, str(load_id), key)


def write_partitioned(df: DataFrame, path: str, column: str, files_per_partition: int | None = None, in_place: bool = False,
                      compression: str | None = None) -> None:
    """Parquet by ``column``; only the partitions present in ``df`` are replaced.

    Without a file count AQE sizes the output tasks (``REBALANCE`` splits a
    partition value that holds most of the rows). With one, rows are spread
    round by round over that many files instead of going to one task per value.
    With ``in_place`` no row is shuffled: each input task writes its rows itself,
    for frames of which a task holds one value or a few. Without a
    ``compression`` the session's is taken.
    """
    laid_out = df.repartition(files_per_partition) if files_per_partition else df if in_place else df.hint("rebalance", F.col(column))
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(column).parquet(path, compression=compression)


def size_report(df: DataFrame, target_mb: int = 256, fraction: float | None = None, seed: int = 0) -> DataFrame:
    """One row: rows, bytes per row as JSON, size and partitions of ``target_mb`` each.

    ``fraction`` measures the row size on a sample; the count is always exact.
    """
    width = F.avg(X.record_bytes(*df.columns))
    rows = F.count(F.lit(1)).alias("n_rows")
    if fraction:
        sampled = df.sample(False, fraction, seed).agg(width.alias("b")).scalar()
        sized = df.agg(rows).select("n_rows", sampled.alias("avg_row_bytes"))
    else:
        sized = df.agg(rows, width.alias("avg_row_bytes"))
    return sized.select("n_rows", F.coalesce(F.col("avg_row_bytes"), F.lit(0.0)).alias("avg_row_bytes")).withColumn(
        "size_mb", F.round(F.col("n_rows") * F.col("avg_row_bytes") / (1024 * 1024), 2)).withColumn(
        "n_partitions", F.greatest(F.ceil(F.col("size_mb") / target_mb), F.lit(1)).cast("int"))


def size_based_partitions(df: DataFrame, target_mb: int = 256, fraction: float | None = None) -> int:
    """Number of output partitions for ``df`` (a single number comes back to the driver)."""
    return size_report(df, target_mb, fraction).first()["n_partitions"]


def jdbc_write_options(url: str, table: str, user: str, password: str, driver: str = "org.postgresql.Driver",
                       batchsize: int = 10_000, partitions: int | None = None) -> dict[str, str]:
    """Options of a truncating JDBC load. ``partitions`` caps the number of parallel connections."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
               "batchsize": str(batchsize), "truncate": "true"}
    if partitions:
        options["numPartitions"] = str(partitions)
    return options


def write_jdbc(df: DataFrame, url: str, table: str, user: str, password: str, mode: str = "overwrite",
               **kwargs) -> None:
    df.write.format("jdbc").options(**jdbc_write_options(url, table, user, password, **kwargs)).mode(mode).save()

