"""Consolidation of operation events, on ``events`` (and ``orders`` for ties).

``user_id`` is the operation and ``event_id`` its version. Clicks, views and purchases came online, purchases,
errors and signups by batch; the purchases on both sides are what the origin rule decides.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import consolidate as c
from tidemark.operators.key_filter import KeyFilter
from tidemark.operators.ranking import top_per_key
from tidemark.sources.spec import SourceSpec

from .registry import published, query, table

RULE = c.PositionRule(
    key="num_oper",
    version="version_id",
    event_code="event_type",
    value_time="value_ts",
    priority="priority",
    receipt_time="receipt_ts",
    origin="origin",
    tie_breakers=("version_id",),
    timestamp_type="timestamp_ntz",
)
ONLINE_TYPES = ("click", "view", "purchase")
BATCH_TYPES = ("purchase", "error", "signup")

# Errors have no priority, views rank below everything else.
PRIORITY_SQL = (
    "CASE WHEN event_type IN ('purchase','click','signup') THEN 3 WHEN event_type = 'view' THEN 2 END"
)
DAY = "date_trunc('day', ts)"


def operations(
    spark: SparkSession, sf_dir: str, types: tuple[str, ...] | None = None, receipt: str = DAY
) -> DataFrame:
    """Operation events of all or some types; value dates are whole days, so that they tie."""
    events = table(spark, sf_dir, "events")
    if types is not None:
        events = events.where(F.col("event_type").isin(*types))
    return events.select(
        F.col("user_id").alias("num_oper"),
        F.col("event_id").alias("version_id"),
        F.expr(f"cast({DAY} AS timestamp_ntz)").alias("value_ts"),
        F.expr(PRIORITY_SQL).alias("priority"),
        F.expr(f"cast({receipt} AS timestamp_ntz)").alias("receipt_ts"),
    )


def online(spark: SparkSession, sf_dir: str, receipt: str = DAY) -> DataFrame:
    return operations(spark, sf_dir, ONLINE_TYPES, receipt)


def batch(spark: SparkSession, sf_dir: str, receipt: str = DAY) -> DataFrame:
    return operations(spark, sf_dir, BATCH_TYPES, receipt)


def sql(
    body: str, receipt: str = DAY, latest: str = "receipt_ts, value_ts, priority", nulls: bool = True
) -> str:
    """Oracle text: ``n`` normalised events, ``u`` both sides, ``l`` latest per side, ``w`` winners."""
    priority = f"COALESCE({PRIORITY_SQL}, 1)" if nulls else PRIORITY_SQL
    order = ", ".join(f"{name.strip()} DESC NULLS LAST" for name in latest.split(","))
    return f"""
WITH n AS (SELECT user_id AS num_oper, event_id AS version_id, event_type,
        {DAY}::TIMESTAMP AS value_ts, ({priority})::BIGINT AS priority, {receipt}::TIMESTAMP AS receipt_ts
        FROM events),
u AS (SELECT *, 'ONLINE' AS origin FROM n WHERE event_type IN ('click','view','purchase')
      UNION ALL BY NAME
      SELECT *, 'BATCH' AS origin FROM n WHERE event_type IN ('purchase','error','signup')),
l AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY num_oper, origin
        ORDER BY {order}, version_id DESC) = 1),
w AS (SELECT * FROM l QUALIFY {WINNER} = 1)
{body}"""


WINNER = """row_number() OVER (PARTITION BY num_oper ORDER BY value_ts DESC NULLS LAST,
        priority DESC NULLS LAST, receipt_ts DESC NULLS LAST,
        CASE WHEN origin = 'ONLINE' THEN 1 ELSE 0 END DESC, version_id DESC)"""
COLUMNS = "num_oper, version_id, value_ts, priority, receipt_ts, origin"


def latest_sql(latest: str) -> str:
    """Oracle text: the latest of all events per operation."""
    order = ", ".join(f"{name} DESC NULLS LAST" for name in latest.split(", "))
    return sql(
        f"""SELECT num_oper, version_id, value_ts, priority, receipt_ts FROM n
QUALIFY row_number() OVER (PARTITION BY num_oper ORDER BY {order}, version_id DESC) = 1""",
        receipt="ts",
    )


@query("consolidate_positions", sql(f"SELECT {COLUMNS} FROM w"))
def consolidate_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.consolidate(spark, online(spark, sf_dir), batch(spark, sf_dir), RULE)


@query("consolidate_distinct_receipts", sql(f"SELECT {COLUMNS} FROM w", receipt="ts"))
def consolidate_distinct_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.consolidate(spark, online(spark, sf_dir, "ts"), batch(spark, sf_dir, "ts"), RULE)


@query(
    "consolidate_value_first",
    sql(f"SELECT {COLUMNS} FROM w", receipt="ts", latest="value_ts, priority, receipt_ts"),
)
def consolidate_value_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = replace(RULE, latest_order=RULE.value_first)
    return c.consolidate(spark, online(spark, sf_dir, "ts"), batch(spark, sf_dir, "ts"), rule)


@query(
    "consolidate_priority_first",
    sql(f"SELECT {COLUMNS} FROM w", receipt="ts", latest="priority, receipt_ts"),
)
def consolidate_priority_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = replace(RULE, latest_order=("priority", "receipt_ts"))
    return c.consolidate(spark, online(spark, sf_dir, "ts"), batch(spark, sf_dir, "ts"), rule)


@query("consolidate_no_reduction", sql(f"SELECT {COLUMNS} FROM u QUALIFY {WINNER} = 1", receipt="ts"))
def consolidate_no_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = replace(RULE, reduce_each_side=False)
    return c.consolidate(spark, online(spark, sf_dir, "ts"), batch(spark, sf_dir, "ts"), rule)


@query("consolidate_nulls_kept", sql(f"SELECT {COLUMNS} FROM w", receipt="ts", nulls=False))
def consolidate_nulls_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = replace(RULE, nulls_as_minimum=False)
    return c.consolidate(spark, online(spark, sf_dir, "ts"), batch(spark, sf_dir, "ts"), rule)


@query(
    "consolidate_one_side_empty",
    sql(f"SELECT {COLUMNS} FROM l WHERE origin = 'ONLINE'"),
)
def consolidate_one_side_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.consolidate(spark, online(spark, sf_dir), [], RULE)


@query("consolidate_return_columns", sql("SELECT num_oper, version_id, origin FROM w"))
def consolidate_return_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.consolidate(
        spark,
        online(spark, sf_dir),
        batch(spark, sf_dir),
        RULE,
        return_columns=["num_oper", "version_id"],
    )


@query(
    "consolidate_from_specs",
    """
WITH u AS (
  SELECT o_custkey AS num_oper, o_orderkey AS version_id, o_orderdate AS ts,
         6 - CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
         CASE WHEN o_orderstatus = 'P' THEN 'BATCH' ELSE 'ONLINE' END AS origin FROM orders),
l AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY num_oper, origin
        ORDER BY ts DESC, priority DESC, version_id DESC) = 1)
SELECT num_oper, version_id, ts AS value_ts, priority, ts AS receipt_ts, origin FROM l
QUALIFY row_number() OVER (PARTITION BY num_oper ORDER BY ts DESC, priority DESC,
        CASE WHEN origin = 'BATCH' THEN 1 ELSE 0 END DESC, version_id DESC) = 1""",
)
def consolidate_from_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides as specs on a catalog table, with BATCH preferred."""
    columns = [
        "o_custkey AS num_oper",
        "o_orderkey AS version_id",
        "o_orderdate AS value_ts",
        "string(6 - int(substr(o_orderpriority, 1, 1))) AS priority",
        "string(o_orderdate) AS receipt_ts",
    ]
    orders = published(spark, sf_dir, "orders")

    def side(where: str) -> SourceSpec:
        source = spark.table(orders).where(where).selectExpr(*columns)
        return SourceSpec(tables={"o": source})

    rule = replace(RULE, preferred_origin="BATCH")
    return c.consolidate(spark, side("o_orderstatus <> 'P'"), side("o_orderstatus = 'P'"), rule)


@query("latest_receipt_first", latest_sql("receipt_ts, value_ts, priority"))
def latest_receipt_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = c.nulls_to_minimum(c.normalize_types(operations(spark, sf_dir, receipt="ts"), RULE), RULE)
    return c.latest_per_origin(side, RULE)


@query("latest_value_first", latest_sql("value_ts, priority, receipt_ts"))
def latest_value_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = replace(RULE, latest_order=RULE.value_first)
    side = c.nulls_to_minimum(c.normalize_types(operations(spark, sf_dir, receipt="ts"), rule), rule)
    return c.latest_per_origin(side, rule)


@query("winner_per_operation", sql(f"SELECT {COLUMNS} FROM u QUALIFY {WINNER} = 1"))
def winner_per_operation(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [
        c.tag_origin(c.nulls_to_minimum(c.normalize_types(side, RULE), RULE), name, RULE)
        for side, name in ((online(spark, sf_dir), "ONLINE"), (batch(spark, sf_dir), "BATCH"))
    ]
    return c.winner_per_operation(sides[0].unionByName(sides[1]), RULE)


@query(
    "top1_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""",
)
def top1_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query("winners_by_origin", sql(f"SELECT {COLUMNS} FROM w WHERE origin = 'BATCH'"))
def winners_by_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.winners_of(consolidate_positions(spark, sf_dir), "BATCH", RULE)


@query("tag_origin", "SELECT *, 'ONLINE' AS origin FROM events")
def tag_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.tag_origin(table(spark, sf_dir, "events"), "ONLINE", RULE)


@query("consolidation_summary", sql("SELECT count(*) AS total_vencedores, 'ONLINE' AS origem_a, "
       "'BATCH' AS origem_b, 'sucesso' AS status FROM w"))
def consolidation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.summarize(consolidate_positions(spark, sf_dir))


REHYDRATED = sql(
    """SELECT w.num_oper, w.version_id, w.origin, e.ts, e.event_type, e.value,
       CASE WHEN w.origin = 'ONLINE' THEN e.props END AS online_props,
       CASE WHEN w.origin = 'BATCH' THEN e.event_type || '!' END AS batch_note, w.value_ts, w.priority, w.receipt_ts
FROM w JOIN events e ON e.user_id = w.num_oper AND e.event_id = w.version_id"""
)


def full_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each side's complete table has a column the other one lacks."""
    full = (
        table(spark, sf_dir, "events")
        .withColumnsRenamed({"user_id": "num_oper", "event_id": "version_id"})
    )
    common = ["num_oper", "version_id", "ts", "event_type", "value"]
    full_a = full.where(F.col("event_type").isin(*ONLINE_TYPES)).select(
        *common, F.col("props").alias("online_props")
    )
    full_b = full.where(F.col("event_type").isin(*BATCH_TYPES)).select(
        *common, F.concat("event_type", F.lit("!")).alias("batch_note")
    )
    return full_a, full_b


@query("rehydrate_full_record", REHYDRATED)
def rehydrate_full_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.rehydrate(consolidate_positions(spark, sf_dir), *full_tables(spark, sf_dir), RULE)


@query("rehydrate_pruned", REHYDRATED)
def rehydrate_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full rows of no winner are left behind by a Bloom filter of the winners before the shuffle."""
    winners = consolidate_positions(spark, sf_dir)
    return c.rehydrate(winners, *full_tables(spark, sf_dir), RULE, prune=KeyFilter())


TEXT_EVENTS = """
SELECT event_id AS version_id, user_id AS num_oper,
       CASE WHEN event_type = 'error' THEN 'not a date' ELSE substr(CAST(ts AS VARCHAR), 1, 19) END AS value_text,
       CASE WHEN event_type = 'view' THEN 'high' ELSE CAST(length(event_type) AS VARCHAR) END AS priority_text,
       CASE WHEN event_type <> 'signup' THEN substr(CAST(ts AS VARCHAR), 1, 10) END AS receipt_text
FROM events"""


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and priorities as text, some unreadable, some missing."""
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("version_id"),
        F.col("user_id").alias("num_oper"),
        F.when(kind == "error", "not a date").otherwise(seconds).alias("value_ts"),
        F.when(kind == "view", "high").otherwise(F.length(kind).cast("string")).alias("priority"),
        F.when(kind != "signup", F.substring(seconds, 1, 10)).alias("receipt_ts"),
    )


_READ = f"""SELECT version_id, num_oper, TRY_CAST(value_text AS TIMESTAMP) AS value_ts,
       TRY_CAST(priority_text AS BIGINT) AS priority, TRY_CAST(receipt_text AS TIMESTAMP) AS receipt_ts
FROM ({TEXT_EVENTS})"""


@query("normalize_types", _READ)
def normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.normalize_types(text_events(spark, sf_dir), RULE)


@query(
    "nulls_as_minimum",
    f"""SELECT version_id, num_oper, COALESCE(value_ts, TIMESTAMP '1900-01-01 00:00:00') AS value_ts,
       COALESCE(priority, 1) AS priority, COALESCE(receipt_ts, TIMESTAMP '1900-01-01 00:00:00') AS receipt_ts
FROM ({_READ})""",
)
def nulls_as_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.nulls_to_minimum(c.normalize_types(text_events(spark, sf_dir), RULE), RULE)


@query("nulls_kept", _READ)
def nulls_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = replace(RULE, nulls_as_minimum=False)
    return c.nulls_to_minimum(c.normalize_types(text_events(spark, sf_dir), rule), rule)
