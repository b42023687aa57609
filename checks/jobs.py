"""Whole jobs against a store and catalog tables in a scratch database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sales import SalesColumns
from tidemark.operators.store import AggregateStore
from tidemark.plans import jobs
from tidemark.sources.tables import scan_files, scratch_path

from .consolidation import RULE, batch, online, sql
from .registry import query, scratch_database
from .sales import PERIODS, _MONEY, _PERIOD_ROWS


def catalog(spark: SparkSession, sf_dir: str, *names: str) -> str:
    database = scratch_database(spark)
    for name in names:
        spark.catalog.createTable(f"{database}.{name}", path=f"{sf_dir}/{name}.parquet", source="parquet")
    return database


def report(df: DataFrame, database: str, *columns: str) -> DataFrame:
    """The result without what differs between runs: scratch names and paths."""
    return df.select(
        "status",
        "record_count",
        *(columns or ("aggregated_data",)),
        F.replace("congregado_id", F.lit(database), F.lit("db")).alias("congregado_id"),
        "congregado_version",
        "congregado_status",
    )


def _profile_sql(name: str, sums: list[str], listed: list[str]) -> str:
    names = ",".join(f'"{c}"' for c in listed)
    body = " || ".join(f"""',"sum_{c}":' || CAST(SUM({c}) AS VARCHAR)""" for c in sums)
    return f"""SELECT 'success' AS status, count(*) AS record_count, '{{"total_rows":' || count(*) ||
       ',"numeric_columns":[{names}]' || {body} || '}}' AS aggregated_data, 'db_{name}' AS congregado_id,
       1::BIGINT AS congregado_version, 'created' AS congregado_status FROM {name}"""


_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("job_table_profile", _profile_sql("lineitem", _LINEITEM[:3], _LINEITEM))
def job_table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = catalog(spark, sf_dir, "lineitem")
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    return report(jobs.run_profile(spark, store, database, "lineitem"), database)


@query(
    "job_many_profiles",
    _profile_sql("documents", ["doc_id", "n_chars"], ["doc_id", "n_chars"])
    + " UNION ALL "
    + _profile_sql("labels", ["doc_id", "quality", "toxic"], ["doc_id", "quality", "toxic"])
    + " UNION ALL SELECT 'error', NULL, NULL, 'db_absent', NULL, NULL",
)
def job_many_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = catalog(spark, sf_dir, "documents", "labels")
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    tables = [(database, "documents"), (database, "absent"), (database, "labels")]
    output = scratch_path(spark, "profiled")
    return report(jobs.run_profiles(spark, store, tables, output), database)


def deal(spark: SparkSession, view: str, columns: str, path: str, key: str) -> None:
    """A view of a file's rows in other order and splits for each ``key``. Spark sizes the splits by their bytes, so that none
    grows with the file, also where a key has many rows."""
    rows = f"SELECT /*+ REBALANCE({key}) */ * FROM parquet.`{path}`"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM ({rows})")


_ALL_SUMS = [f"CAST(SUM({c}) AS VARCHAR)" for c in _LINEITEM[:4]] + [
    f"CAST(CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) AS VARCHAR)" for c in _LINEITEM[4:]
]


@query(
    "job_profile_rerun",
    "SELECT 'exists' AS congregado_status, 1::BIGINT AS congregado_version, count(*) AS record_count, "
    + ", ".join(f"CAST({v} AS DOUBLE) AS sum_{c}" for c, v in zip(_LINEITEM, _ALL_SUMS))
    + " FROM lineitem",
)
def job_profile_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sums of a table measured three times, with its rows in other order and splits: one version."""
    database = scratch_database(spark)
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    for key in ("l_partkey", "l_suppkey", "l_orderkey"):
        deal(spark, f"{database}.dealt", "*", f"{sf_dir}/lineitem.parquet", key)
        last = jobs.run_profile(spark, store, database, "dealt", limit=None)
    sums = [F.get_json_object("aggregated_data", f"$.sum_{c}").cast("double").alias(f"sum_{c}") for c in _LINEITEM]
    return last.select("congregado_status", "congregado_version", "record_count", *sums)


@query(
    "job_sales_rerun",
    f"""SELECT periodo, NULL::VARCHAR AS categoria, count(*) AS n, CAST(SUM({_MONEY}) AS DOUBLE) AS total, 1::BIGINT AS congregado_version,
       'exists' AS congregado_status
FROM (VALUES ('1996'), ('1996-03'), ('1998-1')) AS p(periodo) JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo)
GROUP BY periodo
UNION ALL
SELECT periodo, o_orderpriority, count(*), CAST(SUM({_MONEY}) AS DOUBLE), 1, 'exists'
FROM (VALUES ('1996'), ('1996-03'), ('1998-1')) AS p(periodo) JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo)
GROUP BY periodo, o_orderpriority""",
)
def job_sales_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of doubles analysed three times, with the rows in other order and splits: one version of each record."""
    database = scratch_database(spark)
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    columns = "o_orderdate AS data, o_orderpriority AS categoria, o_totalprice AS valor"
    for key in ("o_custkey", "o_orderdate", "o_orderkey"):
        deal(spark, f"{database}.sales", columns, f"{sf_dir}/orders.parquet", key)
        last = jobs.run_sales_periods(spark, store, database, "sales", ["1996", "1996-03", "1998-1"])

    def figure(*names: str) -> Column:
        return F.coalesce(*[F.get_json_object("analise", f"$.{n}") for n in names])

    return last.select(
        "periodo",
        F.get_json_object("analise", "$.categoria").alias("categoria"),
        figure("total_registros", "quantidade").cast("bigint").alias("n"),
        figure("total_vendas", "total").cast("double").alias("total"),
        "congregado_version",
        "congregado_status",
    )


ORDER_COLUMNS = SalesColumns(date="o_orderdate", value="o_totalprice", category="o_orderpriority")


@query(
    "job_sales_analysis",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate >= '1996-03-01' AND o_orderdate < '1996-04-01'""",
)
def job_sales_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the job wrote."""
    database = catalog(spark, sf_dir, "orders")
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    output = scratch_path(spark, "sales")
    jobs.run_sales(spark, store, database, "orders", "1996-03", output, ORDER_COLUMNS)
    return scan_files(spark, output)


@query(
    "job_sales_periods",
    f"""SELECT 'vendas_db_orders_' || periodo AS congregado_id, periodo, (SELECT count(*) FROM orders) AS record_count,
       count(o_orderkey) AS total_registros, COALESCE(CAST(SUM({_MONEY}) AS DOUBLE), 0.0) AS total_vendas,
       1::BIGINT AS congregado_version, 'created' AS congregado_status
FROM {_PERIOD_ROWS} LEFT JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo) GROUP BY periodo
UNION ALL
SELECT 'vendas_db_orders_' || periodo || '{{"categoria":"' || o_orderpriority || '"}}', periodo,
       (SELECT count(*) FROM orders), count(*), CAST(SUM({_MONEY}) AS DOUBLE), 1, 'created'
FROM {_PERIOD_ROWS} JOIN orders ON starts_with(CAST(o_orderdate AS VARCHAR), periodo)
GROUP BY periodo, o_orderpriority""",
)
def job_sales_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job saved, read from the JSON it saved."""
    database = catalog(spark, sf_dir, "orders")
    spark.sql(
        f"CREATE VIEW {database}.sales AS SELECT o_orderkey, o_orderdate AS data, o_orderpriority AS categoria, "
        f"cast(o_totalprice AS decimal(18,2)) AS valor FROM {database}.orders"
    )
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    saved = report(
        jobs.run_sales_periods(spark, store, database, "sales", PERIODS), database, "periodo", "analise"
    )

    def number(*names: str) -> Column:
        return F.coalesce(*[F.get_json_object("analise", f"$.{n}") for n in names])

    return saved.select(
        F.replace("congregado_id", F.lit("_sales_"), F.lit("_orders_")).alias("congregado_id"),
        "periodo",
        "record_count",
        number("total_registros", "quantidade").cast("bigint").alias("total_registros"),
        number("total_vendas", "total").cast("double").alias("total_vendas"),
        "congregado_version",
        "congregado_status",
    )


@query(
    "job_consolidation",
    sql(
        """SELECT 'success' AS status, count(*) AS record_count, '{"total_vencedores":' || count(*) ||
       ',"origem_a":"ONLINE","origem_b":"BATCH","status":"sucesso"}' AS aggregated_data,
       'consolidacao_ONLINE_vs_BATCH' AS congregado_id, 1::BIGINT AS congregado_version,
       'created' AS congregado_status FROM w"""
    ),
)
def job_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    store = AggregateStore(spark, database, "aggregates", buckets=4)
    output = scratch_path(spark, "winners")
    saved = jobs.run_consolidation(
        spark, store, online(spark, sf_dir), batch(spark, sf_dir), RULE, output_path=output
    )
    return report(saved, database)
