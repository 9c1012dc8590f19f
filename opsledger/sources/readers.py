"""Scans: delimited text, parquet, JDBC, with guards expressed on the scanned data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.sources.records import read_delimited_records


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", encoding: str = "UTF-8",
                   header: bool = True, **options) -> DataFrame:
    """Delimited text, every column as string.

    UTF-16LE/BE is read in splits by ``records``: quoted fields may hold line breaks, quotes in them are doubled, lines
    end with or without a carriage return, and a record with a wrong number of fields is an error. UTF-16 with a byte
    order mark that alone tells the order of bytes cannot be split, so each file is read by one task. Other encodings
    go through Spark's reader and its ``options``.
    """
    kind = encoding.upper().replace("_", "-")
    if kind in ("UTF-16LE", "UTF-16BE"):
        if options:
            raise ValueError(f"options {sorted(options)} do not apply to {kind}")
        return read_delimited_records(spark, path, sep, kind, header)
    reader = spark.read.options(header=header, sep=sep, encoding=encoding, inferSchema=False, **options)
    if kind == "UTF-16":
        reader = reader.option("multiLine", True)
    df = reader.csv(path)
    return df.withColumnsRenamed({c: c.lstrip("\uFEFF").rstrip("\r") for c in df.columns})


def file_name(path_column: str = "_metadata.file_path"):
    return F.element_at(F.split(F.col(path_column), "/"), -1)


def read_many_with_provenance(spark: SparkSession, path: str, fmt: str, **options) -> DataFrame:
    """All files below ``path`` with the name of the file each row came from."""
    return spark.read.format(fmt).options(**options).load(path).withColumn("source_file", file_name())


def check_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}; found: {df.columns}")
    return df


def read_parquet_checked(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    return check_columns(spark.read.parquet(path), required)


def read_partition(spark: SparkSession, root: str, column: str, value) -> DataFrame:
    """Exactly one partition (pruned at planning); raises when it is absent.

    A text value is compared as text: partition values are then not guessed to be numbers, so '007' is not '7'.
    """
    reader = spark.read
    if isinstance(value, str):
        kept = [f for f in spark.read.parquet(root).schema.fields if f.name != column]
        reader = reader.schema(T.StructType([*kept, T.StructField(column, T.StringType())]))
    df = reader.parquet(root).where(F.col(column) == F.lit(value))
    if df.isEmpty():
        raise FileNotFoundError(f"no rows for {column}={value} below {root}")
    return df


def read_single_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """One CSV file below ``path``; none or several is an error."""
    df = spark.read.options(header=True, **options).csv(path)
    return require_single_input(df, suffix=".csv")


def require_single_input(df: DataFrame, suffix: str | None = None) -> DataFrame:
    """Raise unless the frame is read from exactly one file (of the given suffix)."""
    files = df.inputFiles()
    if len(files) != 1:
        raise ValueError(f"expected one input file, found {len(files)}")
    if suffix and not files[0].lower().endswith(suffix):
        raise ValueError(f"expected a {suffix} file, found {files[0]}")
    return df


def input_audit(df: DataFrame) -> DataFrame:
    """One row: number of source files behind the rows and whether it is exactly one."""
    return df.agg(F.count_distinct(file_name()).alias("n_files")) \
        .withColumn("single_input", F.when(F.col("n_files") == 1, 1).otherwise(0))


def jdbc_url(host: str, port: int, database: str, kind: str = "postgresql") -> str:
    return f"jdbc:{kind}://{host}:{port}/{database}"


def jdbc_read_options(url: str, user: str, password: str, query: str | None = None, table: str | None = None,
                      driver: str = "org.postgresql.Driver", fetchsize: int = 10_000,
                      partition_column: str | None = None, lower: int = 1, upper: int = 10_000_000,
                      partitions: int | None = None) -> dict[str, str]:
    """Options of a JDBC scan. A split scan needs a table (or a parenthesised subquery) and a column."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    if query is not None:
        query = query.strip().rstrip(";").rstrip()  # Spark wraps the text as a subquery
    options = {"url": url, "user": user, "password": password, "driver": driver, "fetchsize": str(fetchsize)}
    split = partition_column is not None and partitions is not None
    if split:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
        options["dbtable"] = table or f"({query}) AS q"
    elif query is not None:
        options["query"] = query
    else:
        options["dbtable"] = table
    return options


def read_jdbc_query(spark: SparkSession, url: str, user: str, password: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, user, password, **kwargs)).load()


def table_scan(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table or view, pruned to ``columns``."""
    df = spark.table(name)
    return df.select(*columns) if columns else df
