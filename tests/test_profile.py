from __future__ import annotations

from decimal import Decimal


from tidemark.operators.profile import (
    PROFILE_ROW,
    numeric_columns,
    profile,
    profile_error,
    profile_many,
)


def test_profile(spark):
    df = spark.createDataFrame([(-7, None, "x"), (None, 41, None)], "depth int, weight bigint, note string")
    assert profile(df).first().asDict() == {
        "total_rows": 2,
        "numeric_columns": ["depth", "weight"],
        "sum_depth": -7,
        "sum_weight": 41,
    }


def test_only_four_types_and_three_sums(spark):
    df = spark.createDataFrame(
        [], "a smallint, b float, c decimal(5,2), d int, e bigint, f double, g tinyint, `h.i` int"
    )
    assert numeric_columns(df) == ["b", "d", "e", "f", "h.i"]
    assert profile(df).columns == ["total_rows", "numeric_columns", "sum_b", "sum_d", "sum_e"]
    assert profile(df, limit=None).columns[2:] == ["sum_b", "sum_d", "sum_e", "sum_f", "sum_h.i"]


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1,), (2,)], "`x.y` int")
    assert profile(df).first()["sum_x.y"] == 3


def test_no_numeric_columns_and_no_rows(spark):
    df = spark.createDataFrame([], "name string")
    assert profile(df).first().asDict() == {"total_rows": 0, "numeric_columns": []}
    assert profile(spark.createDataFrame([], "n int")).first()["sum_n"] is None


def test_sums_beyond_bigint(spark):
    df = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "n bigint")
    assert profile(df).first()["sum_n"] == Decimal(3 * 2**62)


def test_many_and_error_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    rows = profile_many({"db.a": df, "db.b": df.where("false")}).unionByName(
        profile_error(spark, "db.c", "it's missing")
    )
    got = {r["table_name"]: (r["status"], r["error"], r["total_rows"], r["sums"]) for r in rows.collect()}
    assert got == {
        "db.a": ("success", None, 2, '{"sum_n":3}'),
        "db.b": ("success", None, 0, '{"sum_n":null}'),
        "db.c": ("error", "it's missing", None, None),
    }
    assert ", ".join(f"{n} {t}" for n, t in rows.dtypes) == PROFILE_ROW
