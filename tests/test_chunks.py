from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import canonical_json, content_hash, number_rows, order_chunk
from tidemark.functions.placed import RANGE, TIE, in_ranges


@pytest.mark.parametrize("kind, width", [("bigint", 7), ("double", 3), ("timestamp", 60), ("timestamp_ntz", 45), ("date", None)])
def test_numbering_equals_one_window(spark, kind, width):
    """Negative and missing order values included; half of the rows share one key."""
    rng = random.Random(3)
    rows = [(0 if i % 2 else rng.randint(1, 5), rng.choice([None, *range(-200, 200)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, o bigint, tie int")
    moment = {"timestamp": F.timestamp_seconds("o"), "timestamp_ntz": F.timestamp_seconds("o").cast("timestamp_ntz")}
    if kind == "date":
        df = df.withColumn("o", F.date_from_unix_date(F.col("o").cast("int")))
    else:
        df = df.withColumn("o", moment.get(kind, F.col("o").cast(kind)))
    plain = Window.partitionBy("k").orderBy(F.col("o").asc_nulls_first(), "tie")
    expected = {r["tie"]: r["n"] for r in df.withColumn("n", F.row_number().over(plain)).collect()}
    numbered = number_rows(df, ["k"], ["o", "tie"], "n")
    assert numbered.columns == ["k", "o", "tie", "n"]
    assert {r["tie"]: r["n"] for r in numbered.collect()} == expected
    assert df.select(order_chunk(df, "o", width).alias("c")).distinct().count() > 5


def test_row_with_null_key_is_kept(spark):
    df = spark.createDataFrame([(None, 1), (1, 1)], "k int, o int")
    assert {(r["k"], r["n"]) for r in number_rows(df, ["k"], ["o"], "n").collect()} == {(None, None), (1, 1)}


def test_text_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="cannot cut chunks"):
        order_chunk(spark.createDataFrame([("a",)], "o string"), "o")


def test_hash_equality(spark):
    rows = [("value", 123), ("value", 123), ("different", 123), (None, 123)]
    df = spark.createDataFrame(rows, "key string, number int")
    first, second, third, fourth = [r[0] for r in df.select(content_hash(df)).collect()]
    assert first == second and len({first, third, fourth}) == 3 and len(first) == 64


def test_hash_ignores_column_order_stamps_and_map_order(spark):
    df = spark.sql(
        "SELECT 1 AS b, map('x', map('p', 1, 'q', 2), 'y', null) AS a, named_struct('n', 1, 'm', 2) AS s, 5 AS version"
    )
    other = spark.sql(
        "SELECT named_struct('m', 2, 'n', 1) AS s, map('y', null, 'x', map('q', 2, 'p', 1)) AS a, 1 AS b, "
        "current_timestamp() AS updated_at"
    )
    assert df.select(content_hash(df)).first() == other.select(content_hash(other)).first()
    text = df.select(canonical_json(df)).first()[0]
    assert text == '{"a":{"x":{"p":1,"q":2},"y":null},"b":1,"s":{"m":2,"n":1}}'


def test_hash_needs_columns(spark):
    df = spark.createDataFrame([(1,)], "version int")
    with pytest.raises(ValueError, match="no columns left"):
        content_hash(df)


def test_nan_comes_last_and_large_numbers_are_exact(spark):
    big = 2**60
    rows = [("a", float("nan"), big + 3), ("a", 5e6, big + 1), ("a", float("-inf"), -big), ("a", None, big + 2), ("a", float("inf"), -1)]
    df = spark.createDataFrame(rows, "k string, x double, n bigint")
    by_x = {str(r["x"]): r["at"] for r in number_rows(df, ["k"], ["x"], "at").collect()}
    assert by_x == {"None": 1, "-inf": 2, "5000000.0": 3, "inf": 4, "nan": 5}
    by_n = [r["n"] for r in number_rows(df, ["k"], ["n"], "at").orderBy("at").collect()]
    assert by_n == [-big, -1, big + 1, big + 2, big + 3]


@pytest.mark.parametrize("order", ["1700000000000000L + id", "timestamp_seconds(1700000000 + id % 86400)", "5"])
def test_ranges_fit_the_data(spark, order):
    """Microseconds, a day that holds all rows, a constant: a key with all rows is dealt evenly and numbered without gaps."""
    df = spark.range(40_000).selectExpr("'hot' AS k", f"{order} AS o", "id")
    dealt = in_ranges(df.withColumn(TIE, F.monotonically_increasing_id()), ["k", "o", TIE]).groupBy(RANGE).count()
    sizes = [r["count"] for r in dealt.collect()]
    target = 40_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert target / 2 <= min(sizes) and max(sizes) <= 2 * target
    numbered = number_rows(df, ["k"], ["o"], "n")
    assert numbered.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (40_000, 1, 40_000)
    later = numbered.selectExpr("o", "lead(o) OVER (ORDER BY n) AS following").where("following < o")
    assert later.count() == 0
