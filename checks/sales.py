"""Sales analysis on ``orders``: order date, total price and order priority."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import sales as s

from .registry import plain, query, table

PERIODS = ["1996", "1996-03", "1996-12", "1997-02-14", "1998-1", "2050"]
_PERIOD_ROWS = "(VALUES ('1996'), ('1996-03'), ('1996-12'), ('1997-02-14'), ('1998-1'), ('2050')) AS p(periodo)"
_MONEY = "CAST(o_totalprice AS DECIMAL(18,2))"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under the names a sales table has; money as decimal, so that sums do not depend on row order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("data"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor"),
        F.col("o_orderpriority").alias("categoria"),
    )


def with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No value for open orders, no category for partial ones."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("categoria"),
    )


def _totals(source: str, value: str = _MONEY) -> str:
    return f"""SELECT count(*) AS total_registros,
       COALESCE(CAST(SUM({value}) AS DOUBLE), 0.0) AS total_vendas,
       CASE WHEN count(*) > 0 THEN COALESCE(CAST(SUM({value}) AS DOUBLE), 0.0) / count(*) ELSE 0.0 END
         AS media_vendas
FROM {source}"""


@query(
    "sales_period_filter",
    """SELECT o_orderkey AS id, o_orderdate AS data, o_totalprice AS valor,
       o_orderpriority AS categoria FROM orders WHERE starts_with(CAST(o_orderdate AS VARCHAR), '1996-03')""",
)
def sales_period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(s.filter_period(orders(spark, sf_dir), "1996-03"))


@query(
    "sales_period_filter_text",
    """SELECT o_orderkey AS id, CAST(o_orderdate AS VARCHAR)[1:10] AS data FROM orders
WHERE starts_with(CAST(o_orderdate AS VARCHAR), '1996-1')""",
)
def sales_period_filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text and a prefix that is no whole month."""
    text = orders(spark, sf_dir).select("id", F.date_format("data", "yyyy-MM-dd").alias("data"))
    return s.filter_period(text, "1996-1")


@query("sales_totals", _totals("orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1997-01-01'"))
def sales_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.sales_totals(s.filter_period(orders(spark, sf_dir), "1996"))


@query("sales_totals_empty_period", "SELECT 0::BIGINT AS total_registros, 0.0::DOUBLE AS total_vendas, "
       "0.0::DOUBLE AS media_vendas FROM (SELECT count(*) FROM orders)")
def sales_totals_empty_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.sales_totals(s.filter_period(orders(spark, sf_dir), "2050"))


@query("sales_mean_null_aware", _totals("orders", f"CASE WHEN o_orderstatus <> 'O' THEN {_MONEY} END"))
def sales_mean_null_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.sales_totals(with_gaps(spark, sf_dir))


@query(
    "sales_by_category",
    f"""SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS categoria, count(*) AS quantidade,
       CAST(SUM(CASE WHEN o_orderstatus <> 'O' THEN {_MONEY} END) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(s.sales_by_category(with_gaps(spark, sf_dir)))


@query(
    "sales_by_category_no_value",
    "SELECT o_orderpriority AS categoria, count(*) AS quantidade, 0::BIGINT AS total FROM orders GROUP BY 1",
)
def sales_by_category_no_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.sales_by_category(orders(spark, sf_dir).drop("valor"))


@query(
    "sales_multi_period",
    f"""SELECT periodo, count(o_orderkey) AS total_registros,
       COALESCE(CAST(SUM({_MONEY}) AS DOUBLE), 0.0) AS total_vendas,
       CASE WHEN count(o_orderkey) > 0 THEN CAST(SUM({_MONEY}) AS DOUBLE) / count(o_orderkey) ELSE 0.0 END
         AS media_vendas
FROM {_PERIOD_ROWS} LEFT JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo) GROUP BY periodo""",
)
def sales_multi_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.sales_by_period(orders(spark, sf_dir), PERIODS)


@query(
    "sales_multi_period_categories",
    f"""SELECT periodo, o_orderpriority AS categoria, count(*) AS quantidade, CAST(SUM({_MONEY}) AS DOUBLE) AS total
FROM {_PERIOD_ROWS} JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo) GROUP BY ALL""",
)
def sales_multi_period_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(s.sales_by_period_and_category(orders(spark, sf_dir), PERIODS))


@query(
    "sales_rows_by_period",
    f"""SELECT periodo, o_orderkey AS id, o_orderdate AS data, o_totalprice AS valor, o_orderpriority AS categoria
FROM {_PERIOD_ROWS} JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo)""",
)
def sales_rows_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(s.rows_by_period(orders(spark, sf_dir), PERIODS))


_FORTY = [f"{year}-{month:02d}" for year in (1992, 1993, 1995, 1997) for month in range(1, 11)]
_FORTY_SQL = """SELECT p AS periodo, count(o_orderkey) AS total_registros
FROM (SELECT unnest([{periods}]) AS p) LEFT JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), p) GROUP BY p""".format(
    periods=", ".join(f"'{p}'" for p in _FORTY)
)


@query("sales_forty_periods", _FORTY_SQL)
def sales_forty_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More periods than a filter of single ranges would take, on dates."""
    totals, _ = s.analyse_periods(orders(spark, sf_dir), _FORTY)
    return totals.select("periodo", "total_registros")


@query("sales_forty_periods_text", _FORTY_SQL)
def sales_forty_periods_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on dates as text."""
    text = orders(spark, sf_dir).withColumn("data", F.date_format("data", "yyyy-MM-dd"))
    totals, _ = s.analyse_periods(text, _FORTY)
    return totals.select("periodo", "total_registros")
