"""Scans, sinks, schema conformance and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import content_hash
from tidemark.operators.conform import conform, conform_and_write, lost_values
from tidemark.operators.profile import profile, profile_error, profile_many
from tidemark.sources.spec import union_all
from tidemark.sources.tables import (
    row_count,
    scan_catalog,
    scan_files,
    scratch_path,
    write_files,
    write_table,
)

from .registry import plain, query, scratch_database, table


@query("scan_files", "SELECT * FROM lineitem")
def scan_whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_files(spark, f"{sf_dir}/lineitem.parquet")


@query("scan_catalog", "SELECT * FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10'")
def scan_catalog_with_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    spark.catalog.createTable(f"{database}.events", path=f"{sf_dir}/events.parquet", source="parquet")
    predicate = "event_type = 'purchase' AND ts >= timestamp_ntz '2024-01-10'"
    return scan_catalog(spark, database, "events", {"pushdownPredicate": predicate})


@query(
    "sink_partitioned_roundtrip",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus, o_orderdate,
       CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""",
)
def sink_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders")
    write_files(orders, path, partition_columns=["o_orderstatus", "o_year"])
    return scan_files(spark, path)


@query(
    "sink_json_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer")
    write_files(customer, path, format="json")
    return scan_files(spark, path, "json", {"multiline": False}, schema=customer.schema)


@query("sink_catalog_roundtrip", "SELECT * FROM part")
def sink_catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    write_table(table(spark, sf_dir, "part"), database, "part", bucket_columns=["p_partkey"], buckets=4)
    return scan_catalog(spark, database, "part")


TARGET = [
    T.StructField("event_id", T.IntegerType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("kind", T.IntegerType()),
    T.StructField("value", T.DecimalType(10, 2)),
    T.StructField("note", T.StringType()),
    T.StructField("day", T.DateType()),
]


def loose_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with text to cast, text that cannot be cast, one column too many and one too few."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "click", "7").otherwise(F.col("event_type")).alias("kind"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("props").alias("surplus"),
    )


CONFORMED = """SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN event_type = 'click' THEN 7 END::INTEGER AS kind,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS note,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events"""


@query("conform_schema", CONFORMED)
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(conform(loose_events(spark, sf_dir), TARGET))


@query(
    "conform_lost_values",
    """SELECT 0::BIGINT AS event_id, 0::BIGINT AS user_id, 0::BIGINT AS k,
       count(*) FILTER (WHERE event_type <> 'click') AS kind, 0::BIGINT AS value, 0::BIGINT AS day FROM events""",
)
def conform_lost_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lost_values(loose_events(spark, sf_dir), TARGET)


@query("conform_and_write", f"SELECT *, CAST(NULL AS BIGINT) AS seen FROM ({CONFORMED})")
def conform_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a partitioned table that gains a column on the way."""
    database = scratch_database(spark)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TARGET)
    spark.sql(f"CREATE TABLE {database}.target ({columns}) USING parquet PARTITIONED BY (day)")
    seen = T.StructField("seen", T.LongType())
    conform_and_write(spark, loose_events(spark, sf_dir), database, "target", extra_fields=[seen])
    return plain(scan_catalog(spark, database, "target"))


@query(
    "conform_drift",
    """SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS DOUBLE) AS value,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
UNION ALL SELECT event_id, NULL, event_type, CAST(value AS DOUBLE), CAST(CAST(ts AS DATE) AS VARCHAR) FROM events""",
)
def conform_with_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that loses a column and gains two that nobody listed."""
    database = scratch_database(spark)
    events = table(spark, sf_dir, "events").withColumns({"day": F.date_format("ts", "yyyy-MM-dd"), "value": F.col("value").cast("double")})
    write_table(events.select("event_id", "user_id", "day").limit(0), database, "target", partition_columns=["day"])
    for columns in (["event_id", "user_id", "day"], ["event_id", "event_type", "value", "day"]):
        conform_and_write(spark, events.select(*columns), database, "target", evolve=True)
    return scan_catalog(spark, database, "target")


@query("table_row_count", "SELECT count(*) AS record_count FROM lineitem")
def table_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


_LINEITEM_NUMBERS = (
    "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax"
)


def _exact(column: str) -> str:
    return f"CAST(SUM({column}) AS VARCHAR) AS sum_{column}"


def _readable(measured: DataFrame) -> DataFrame:
    """The list of names and the exact sums as text."""
    exact = [f.name for f in measured.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return measured.withColumns(
        {
            "numeric_columns": F.array_join("numeric_columns", ","),
            **{name: F.col(name).cast("string") for name in exact},
        }
    )


@query(
    "profile_numeric",
    f"""SELECT count(*) AS total_rows, '{_LINEITEM_NUMBERS}' AS numeric_columns,
       {_exact('l_orderkey')}, {_exact('l_partkey')}, {_exact('l_suppkey')} FROM lineitem""",
)
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(profile(table(spark, sf_dir, "lineitem")))


_LINEITEM_DOUBLES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "profile_all_numeric",
    f"""SELECT count(*) AS total_rows, '{_LINEITEM_NUMBERS}' AS numeric_columns,
       {_exact('l_orderkey')}, {_exact('l_partkey')}, {_exact('l_suppkey')}, {_exact('l_linenumber')},
       {', '.join(f'ROUND(SUM({c}), 1) AS sum_{c}' for c in _LINEITEM_DOUBLES)} FROM lineitem""",
)
def profile_all_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = _readable(profile(table(spark, sf_dir, "lineitem"), limit=None))
    return measured.withColumns({f"sum_{c}": F.round(f"sum_{c}", 1) for c in _LINEITEM_DOUBLES})


@query(
    "profile_floating",
    """SELECT count(*) AS total_rows, 'c_custkey,c_nationkey,c_acctbal' AS numeric_columns,
       CAST(SUM(c_custkey) AS VARCHAR) AS sum_c_custkey, CAST(SUM(c_nationkey) AS VARCHAR) AS sum_c_nationkey,
       ROUND(SUM(c_acctbal), 2) AS sum_c_acctbal FROM customer""",
)
def profile_floating(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = _readable(profile(table(spark, sf_dir, "customer")))
    return measured.withColumn("sum_c_acctbal", F.round("sum_c_acctbal", 2))


def _profile_sql(name: str, columns: list[str], listed: str) -> str:
    sums = " || ',' || ".join(f"""'"sum_{c}":' || CAST(SUM({c}) AS VARCHAR)""" for c in columns)
    body = f"'{{' || {sums} || '}}'" if columns else "'{}'"
    return (
        f"SELECT '{name}' AS table_name, 'success' AS status, CAST(NULL AS VARCHAR) AS error, "
        f"count(*) AS total_rows, '{listed}' AS numeric_columns, {body} AS sums FROM {name}"
    )


@query(
    "profile_many_tables",
    " UNION ALL ".join(
        [
            _profile_sql("nation", ["n_nationkey", "n_regionkey"], "n_nationkey,n_regionkey"),
            _profile_sql("labels", ["doc_id", "quality", "toxic"], "doc_id,quality,toxic"),
            _profile_sql("documents", ["doc_id", "n_chars"], "doc_id,n_chars"),
            _profile_sql("conversations", ["conv_id", "turn"], "conv_id,turn"),
            _profile_sql("lineitem", ["l_orderkey", "l_partkey", "l_suppkey"], _LINEITEM_NUMBERS),
            "SELECT 'missing', 'error', 'not found', NULL, NULL, NULL",
        ]
    ),
)
def profile_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["nation", "labels", "documents", "conversations", "lineitem"]
    measured = profile_many({n: table(spark, sf_dir, n) for n in names})
    rows = union_all([measured, profile_error(spark, "missing", "not found")])
    return rows.withColumn("numeric_columns", F.array_join("numeric_columns", ","))


@query(
    "content_hash",
    """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey ||
       ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":' ||
       CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}') AS digest
FROM orders""",
)
def hash_of_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL is content; version and time stamps are not."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_orderkey", "o_custkey", F.col("o_orderdate").alias("created_at")
    )
    nulled = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    versioned = nulled.withColumn("version", F.lit(3)).withColumn("updated_at", F.current_timestamp())
    return versioned.select("o_orderkey", content_hash(versioned).alias("digest"))
