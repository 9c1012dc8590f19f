import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.operators import schema as S


def test_rename_ignores_absent(spark):
    assert S.rename_map(spark.range(1), {"id": "x", "gone": "y"}).columns == ["x"]


def test_conform_adds_drops_orders_and_nulls_bad_values(spark):
    df = spark.createDataFrame([("\u200B7", "2024-13-01", "1.239", "x")], "id string, day string, amount string, extra string")
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("id", T.LongType()),
                           T.StructField("amount", T.DecimalType(18, 2)), T.StructField("absent", T.IntegerType())])
    out = S.conform_schema(df, schema, "yyyy-MM-dd", clean=["id"])
    assert out.columns == ["day", "id", "amount", "absent"]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schema.fields]
    assert out.first() == (None, 7, Decimal("1.24"), None)


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` date ` int, target int, `Unnamed: 4` int")
    assert S.require_columns(df, ["date", "target"]).columns == ["date", "target"]
    with pytest.raises(ValueError, match="facility"):
        S.require_columns(df, ["date", "facility"])


def test_strict_cast_raises_on_bad_number(spark):
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.DoubleType())])
    good = spark.createDataFrame([(" 2024-01-02 ", " 1.5 ")], "d string, n string")
    assert S.strict_cast_and_order(good, schema).first() == ("2024-01-02", 1.5)
    assert S.strict_cast_and_order(good, schema, iso_dates=False).first() == (dt.date(2024, 1, 2), 1.5)
    bad = spark.createDataFrame([("2024-01-02", "1,5")], "d string, n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.strict_cast_and_order(bad, schema).collect()


def test_masked_update_leaves_null_mask(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "m int, v string")
    assert [r.v for r in S.masked_update(df, "v", F.col("m") == 1, F.lit("z")).collect()] == ["a", "z", "c"]


def test_classes_first_match_wins(spark):
    out = S.with_class(spark.range(4), "c", [("low", F.col("id") < 1), ("mid", F.col("id") < 3)], "high")
    assert [r.c for r in out.orderBy("id").collect()] == ["low", "mid", "mid", "high"]


def test_weekday_only(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "date date")
    assert S.weekday_only(df, "date").count() == 5
