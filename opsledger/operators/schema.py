"""Column-shape operators: renames, typed schemas, guards, masks and classes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.functions import scalars as X


def rename_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; other names in the map are ignored."""
    return df.withColumnsRenamed(names)


def conform_schema(df: DataFrame, schema: T.StructType, date_format: str | None = None,
                   clean: list[str] = ()) -> DataFrame:
    """Bring ``df`` to ``schema`` in one projection.

    Missing columns become typed nulls, values that do not parse become null,
    undeclared columns go, and the order is the schema's. Columns in ``clean``
    are stripped of invisible characters before the cast.
    """
    present = set(df.columns)

    def shaped(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(field.name)
        if field.name in clean:
            source = X.clean_text(source)
        if isinstance(field.dataType, T.DateType):
            return X.lenient_date(source, date_format).alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return X.lenient_timestamp(source, date_format).cast(field.dataType).alias(field.name)
        return source.try_cast(field.dataType).alias(field.name)

    return df.select(*[shaped(f) for f in schema.fields])


def select_existing(df: DataFrame, names: list[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*[n for n in names if n in present])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Trim header names, leave out unnamed columns, raise when a required one is absent."""
    kept = [c for c in df.columns if not re.match(r"Unnamed", c.strip())]
    out = df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in kept])
    missing = [n for n in names if n not in out.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}; found: {out.columns}")
    return out


def strict_cast_and_order(df: DataFrame, schema: T.StructType, iso_dates: bool = True) -> DataFrame:
    """Trim and cast; a value that does not parse fails the job. Dates may be kept as ISO text."""
    def shaped(field: T.StructField) -> Column:
        source = F.trim(F.col(field.name).cast("string"))
        if isinstance(field.dataType, T.DateType):
            date = source.cast("date")
            return (X.iso_date(date) if iso_dates else date).alias(field.name)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[shaped(f) for f in schema.fields])


def arrange(df: DataFrame, names: list[str], drop: list[str] = ()) -> DataFrame:
    """Fixed output order without the dropped columns."""
    return df.select(*[n for n in names if n not in set(drop)])


def tag(df: DataFrame, **constants) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def masked_update(df: DataFrame, column: str, mask: Column, value: Column) -> DataFrame:
    """Set ``column`` where ``mask`` holds; a null mask leaves the value."""
    return df.withColumn(column, F.when(mask, value).otherwise(F.col(column)))


def with_flags(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.withColumns({name: X.flag(c) for name, c in conditions.items()})


def with_class(df: DataFrame, out: str, classes: list[tuple[str, Column]], otherwise: str) -> DataFrame:
    """One class column, first match wins: one scan where separate filters would need several."""
    expression = F
    for label, condition in classes:
        expression = expression.when(condition, F.lit(label))
    return df.withColumn(out, expression.otherwise(F.lit(otherwise)))


def weekday_only(df: DataFrame, column: str) -> DataFrame:
    return df.where(X.is_weekday(column))
