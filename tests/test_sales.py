from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sales as s

ROWS = [
    ("2024-01-05", 10.0, "a"),
    ("2024-01-31", None, "a"),
    ("2024-02-01", 5.0, None),
    ("2024-02-29", 7.5, "b"),
    ("2023-12-31", 100.0, "b"),
    (None, 1.0, "b"),
]


@pytest.fixture(scope="module", params=["string", "date", "timestamp", "timestamp_ntz"])
def sales(request, spark):
    df = spark.createDataFrame(ROWS, "data string, valor double, categoria string")
    return df.withColumn("data", F.col("data").cast(request.param))


def test_columns_by_preference(spark):
    both = spark.createDataFrame([], "date string, data string, amount int, valor int")
    assert s.SalesColumns.of(both) == s.SalesColumns("data", "valor", None)
    second = spark.createDataFrame([], "date string, amount int, categoria string")
    assert s.SalesColumns.of(second) == s.SalesColumns("date", "amount", "categoria")


@pytest.mark.parametrize(
    "period, rows", [("2024", 4), ("2024-01", 2), ("2024-02-29", 1), ("202", 5), ("2024-0", 4), ("", 5), ("2030", 0)]
)
def test_period_filter(sales, period, rows):
    assert s.filter_period(sales, period).count() == rows


def test_period_ranges():
    assert s.period_range("2024") == ("2024-01-01", "2025-01-01")
    assert s.period_range("2024-12") == ("2024-12-01", "2025-01-01")
    assert s.period_range("2024-02-29") == ("2024-02-29", "2024-03-01")
    assert s.period_range("2024-13") is None
    assert s.period_range("2024-1") is None
    assert s.covering_range("2024-1") == ("2024-01-01", "2025-01-01")
    assert s.covering_range("2024-02-3") == ("2024-02-01", "2024-03-01")
    assert s.covering_range("20") is None


def test_no_date_column_means_no_filter(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "id int, valor double, categoria string")
    assert s.filter_period(df, "2024").count() == 1
    rows = {r["periodo"]: r["total_registros"] for r in s.sales_by_period(df, ["2024", "2025"]).collect()}
    assert rows == {"2024": 1, "2025": 1}


def test_mean_counts_rows_without_value(sales):
    row = s.sales_totals(s.filter_period(sales, "2024-01")).first()
    assert (row["total_registros"], row["total_vendas"], row["media_vendas"]) == (2, 10.0, 5.0)


def test_totals_without_rows_values_or_value_column(spark):
    df = spark.createDataFrame([("2024-01-01", None)], "data string, valor double")
    assert s.sales_totals(df).first().asDict() == {"total_registros": 1, "total_vendas": 0.0, "media_vendas": 0.0}
    assert s.sales_totals(df.where("false")).first().asDict() == {
        "total_registros": 0,
        "total_vendas": 0.0,
        "media_vendas": 0.0,
    }
    assert s.sales_totals(df.drop("valor")).columns == ["total_registros"]


def test_categories(sales):
    rows = {r["categoria"]: (r["quantidade"], r["total"]) for r in s.sales_by_category(sales).collect()}
    assert rows == {"a": (2, 10.0), "b": (3, 108.5), None: (1, 5.0)}
    assert {r["total"] for r in s.sales_by_category(sales.drop("valor")).collect()} == {0}


PERIODS = ["2024", "2024-01", "2024-02-29", "2023-1", "2031"]


def test_many_periods_equal_one_by_one(sales):
    together = {r["periodo"]: r.asDict() for r in s.sales_by_period(sales, PERIODS).collect()}
    assert sorted(together) == sorted(PERIODS)
    for period in PERIODS:
        single = s.sales_totals(s.filter_period(sales, period)).first().asDict()
        assert together[period] == {"periodo": period, **single}
    totals, categories = s.analyse_periods(sales, PERIODS)
    assert {r["periodo"]: r.asDict() for r in totals.collect()} == together
    got = {(r["periodo"], r["categoria"]): (r["quantidade"], r["total"]) for r in categories.collect()}
    expected = {}
    for period in PERIODS:
        for r in s.sales_by_category(s.filter_period(sales, period)).collect():
            expected[(period, r["categoria"])] = (r["quantidade"], r["total"])
    assert got == expected
    rows = s.rows_by_period(sales, PERIODS).groupBy("periodo").count().collect()
    assert {r["periodo"]: r["count"] for r in rows} == {
        p: r["total_registros"] for p, r in together.items() if r["total_registros"]
    }


def test_period_list_is_checked(sales):
    with pytest.raises(ValueError):
        s.sales_by_period(sales, [])


def test_large_whole_numbers_do_not_overflow(spark):
    big = 2**62
    df = spark.createDataFrame([("a", big), ("a", big), ("a", big)], "categoria string, valor bigint")
    assert s.sales_by_category(df).first()["total"] == 3 * big
    assert s.sales_totals(df).first()["total_vendas"] == float(3 * big)


def test_text_values(spark):
    df = spark.createDataFrame([("1.5",), ("many",), (None,)], "valor string")
    assert s.sales_totals(df).first()["total_vendas"] == 1.5


def test_period_range_is_pushed_to_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    columns = s.SalesColumns("o_orderdate", "o_totalprice", None)
    plan = s.sales_by_period(orders, ["1996", "1996-03", "1998-1"], columns)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_date_literals_are_dates():
    assert dt.date.fromisoformat(s.period_range("2024-02")[1]) == dt.date(2024, 3, 1)


@pytest.mark.parametrize("count", [5, 500])
@pytest.mark.parametrize("kind", ["date", "string"])
def test_any_number_of_periods_reaches_the_scan(spark, tmp_path, count, kind):
    days = spark.range(0, 1500, 3).selectExpr(f"cast(date_add(date'2019-01-01', cast(id as int)) as {kind}) AS data", "1 AS valor")
    days.write.parquet(f"{tmp_path}/days")
    df = spark.read.parquet(f"{tmp_path}/days")
    periods = [r["p"] for r in spark.sql(f"SELECT cast(date_add(date'2020-01-01', cast(2 * id as int)) as string) AS p FROM range({count})").collect()]
    totals, _ = s.analyse_periods(df, periods)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" not in plan and "GreaterThanOrEqual(data" in plan
    found = {r["periodo"]: r["total_registros"] for r in totals.collect()}
    assert found == {p: df.where(F.col("data").cast("string") == p).count() for p in periods[:3]} | {p: found[p] for p in periods[3:]}
    assert sum(found.values()) == df.where(F.col("data").cast("string").isin(periods)).count()
