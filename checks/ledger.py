"""Run ledger on ``events``: a run is a user's day.

A signup makes a run pending, a click starts it, an error retries it (or fails it when its value is high), a
purchase completes it. Views are steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ledger as lg
from tidemark.plans.runs import RunLedger
from tidemark.sources.spec import union_all

from .registry import query, scratch_database, table

ORDER = ("ts", "event_id")
STATUS = """CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'click' THEN 'IN_PROGRESS'
  WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN CASE WHEN value > 50 THEN 'FAILED' ELSE 'RETRYING' END END"""
RUN = "user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR)"
LEDGER = f"""
WITH r AS (SELECT {RUN} AS journey_id, 'key-' || user_id AS idempotency_key, {STATUS} AS status,
  CASE WHEN event_type = 'view' THEN 'view' END AS step_name, props AS data,
  CASE WHEN event_type = 'error' THEN 'E' || json_extract_string(props, '$.k') END AS error,
  CASE WHEN event_type = 'purchase' THEN props END AS result, ts, event_id FROM events),
c AS (SELECT journey_id, arg_min(idempotency_key, event_id) AS idempotency_key,
  arg_max(status, event_id) FILTER (WHERE status IS NOT NULL) AS status,
  min(ts) FILTER (WHERE status IS NOT NULL) AS created_at, max(ts) AS updated_at,
  arg_max(error, event_id) FILTER (WHERE error IS NOT NULL) AS error_message,
  arg_max(result, event_id) FILTER (WHERE result IS NOT NULL) AS result,
  arg_min(data, event_id) FILTER (WHERE status IS NOT NULL) AS metadata,
  count(*) FILTER (WHERE status = 'RETRYING') AS retry_count FROM r GROUP BY journey_id HAVING count(status) > 0)
"""


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", "user_id", F.col("ts").cast("date")).alias("journey_id"),
        F.concat(F.lit("key-"), F.col("user_id").cast("string")).alias("idempotency_key"),
        F.expr(STATUS).alias("status"),
        F.when(kind == "view", "view").alias("step_name"),
        F.col("props").alias("data"),
        F.when(kind == "error", F.concat(F.lit("E"), F.get_json_object("props", "$.k"))).alias("error"),
        F.when(kind == "purchase", F.col("props")).alias("result"),
        "ts",
        "event_id",
    )


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.current_state(rows(spark, sf_dir), ORDER)


@query(
    "ledger_current_state",
    LEDGER + "SELECT journey_id, idempotency_key, status, created_at, updated_at, error_message, result, "
    "metadata, retry_count FROM c",
)
def ledger_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(spark, sf_dir)


# Requested: every user's day with a purchase by its id, and every customer by key.
REQUESTED = f"""q AS (SELECT DISTINCT {RUN} AS journey_id, {RUN} AS idempotency_key FROM events
  WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT 'customer-' || c_custkey, 'customer-' || c_custkey FROM customer)
"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").where("event_type IN ('purchase', 'error')")
    by_id = runs.select(F.concat_ws("/", "user_id", F.col("ts").cast("date")).alias("journey_id"))
    key = F.concat(F.lit("customer-"), F.col("c_custkey").cast("string")).alias("idempotency_key")
    by_key = table(spark, sf_dir, "customer").select(key)
    return lg.resolve_requests(union_all([by_id, by_key]))


@query(
    "ledger_plan_requests",
    LEDGER + ", " + REQUESTED + """SELECT q.journey_id, q.idempotency_key, c.status,
       CASE WHEN c.status IS NULL THEN 'create' WHEN c.status = 'COMPLETED' THEN 'skip' ELSE 'resume' END AS action
FROM q LEFT JOIN c ON q.journey_id = c.journey_id""",
)
def ledger_plan_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.plan_requests(requests(spark, sf_dir), state(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str) -> RunLedger:
    """All ledger rows in a ledger table."""
    runs = RunLedger(spark, scratch_database(spark), "runs")
    runs.append(rows(spark, sf_dir))
    return runs


@query(
    "run_table_plan",
    LEDGER + ", " + REQUESTED + """SELECT q.journey_id, q.idempotency_key,
       CASE WHEN c.status IS NULL THEN 'create' WHEN c.status = 'COMPLETED' THEN 'skip' ELSE 'resume' END AS action
FROM q LEFT JOIN c ON q.journey_id = c.journey_id""",
)
def run_table_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir).start(requests(spark, sf_dir)).select("journey_id", "idempotency_key", "action")


@query(
    "run_table_cleanup",
    LEDGER + """SELECT r.journey_id, r.status, r.step_name, r.ts FROM r LEFT JOIN c ON r.journey_id = c.journey_id
WHERE COALESCE(c.created_at, r.ts) >= TIMESTAMP '2024-02-15 12:00:00' - INTERVAL 30 DAY""",
)
def run_table_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _table(spark, sf_dir)
    runs.cleanup(30, F.lit("2024-02-15 12:00:00").cast("timestamp"))
    return runs.rows().select("journey_id", "status", "step_name", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(
    "run_table_state",
    LEDGER + "SELECT journey_id, idempotency_key, status, created_at, updated_at, error_message, result, "
    "metadata, retry_count FROM c",
)
def run_table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows in three appends with a stored state after the second: state is the stored one and the last append."""
    runs, all_rows = RunLedger(spark, scratch_database(spark), "runs"), rows(spark, sf_dir)
    middle = F.col("event_id") % 3
    runs.append(all_rows.where(middle == 0))
    runs.append(all_rows.where(middle == 1))
    runs.checkpoint()
    runs.append(all_rows.where(middle == 2))
    return runs.state().withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})


@query("run_table_replay", "SELECT event_type, count(*) AS n, max(value) AS top FROM events GROUP BY event_type")
def run_table_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second call finds the stored report."""
    runs = RunLedger(spark, scratch_database(spark), "runs")
    report = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("value").alias("top")
    )
    runs.run("totals", lambda: report)
    return runs.run("totals", lambda: report.limit(0))


@query(
    "ledger_pending_work",
    LEDGER + ", " + REQUESTED + """SELECT journey_id, idempotency_key FROM q
WHERE journey_id NOT IN (SELECT journey_id FROM c WHERE status = 'COMPLETED')""",
)
def ledger_pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.pending_work(requests(spark, sf_dir), state(spark, sf_dir))


@query(
    "ledger_replay",
    LEDGER + ", " + REQUESTED + "SELECT q.journey_id, c.result FROM q JOIN c ON q.journey_id = c.journey_id "
    "WHERE c.status = 'COMPLETED'",
)
def ledger_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.replay(requests(spark, sf_dir), state(spark, sf_dir))


@query(
    "ledger_step_history",
    LEDGER + """SELECT r.journey_id, row_number() OVER (PARTITION BY r.journey_id ORDER BY ts, event_id) AS step_no,
       step_name AS name, ts AS timestamp, data
FROM r JOIN c ON r.journey_id = c.journey_id WHERE step_name IS NOT NULL AND ts >= created_at""",
)
def ledger_step_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.step_history(rows(spark, sf_dir), ORDER)


@query(
    "ledger_orphan_steps",
    LEDGER + """SELECT r.journey_id, step_name, ts, event_id FROM r LEFT JOIN c ON r.journey_id = c.journey_id
WHERE step_name IS NOT NULL AND (created_at IS NULL OR ts < created_at)""",
)
def ledger_orphan_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.orphan_steps(rows(spark, sf_dir)).select("journey_id", "step_name", "ts", "event_id")


@query(
    "ledger_retry_count",
    LEDGER + "SELECT journey_id, count(*) FILTER (WHERE status = 'RETRYING') AS retry_count FROM r GROUP BY 1",
)
def ledger_retry_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.retry_counts(rows(spark, sf_dir))


@query(
    "ledger_attempts",
    LEDGER + """SELECT journey_id,
       CASE WHEN bool_or(status = 'IN_PROGRESS') THEN 1 ELSE 0 END + count(*) FILTER (WHERE status = 'RETRYING')
         AS attempts, count(error) AS errors,
       arg_max(error, event_id) FILTER (WHERE error IS NOT NULL) AS last_error,
       COALESCE(arg_max(status, event_id) FILTER (WHERE status IS NOT NULL) = 'FAILED', false) AS failed
FROM r GROUP BY journey_id""",
)
def ledger_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.attempts(rows(spark, sf_dir), ORDER)


@query(
    "ledger_retention",
    LEDGER + "SELECT journey_id, created_at FROM c WHERE created_at >= TIMESTAMP '2024-02-15 12:00:00' - INTERVAL 30 DAY",
)
def ledger_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lg.retain(state(spark, sf_dir), F.lit("2024-02-15 12:00:00").cast("timestamp_ntz"))
    return kept.select("journey_id", "created_at")


@query(
    "ledger_result_roundtrip",
    """SELECT event_id, props AS text, user_id AS number, event_type || '!' AS kind, CAST(NULL AS BIGINT) AS wrong_type
FROM events""",
)
def ledger_result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is JSON stays text; numbers and structs come back as they were."""
    events = table(spark, sf_dir, "events").withColumn("s", F.struct("event_type", "value"))

    def back(column: str, read_as: str | None = None) -> Column:
        encoded = lg.encode_result(F.col(column), events.schema[column].dataType)
        return lg.decode_result(encoded, events.schema[read_as or column].dataType)

    return events.select(
        "event_id",
        back("props").alias("text"),
        back("user_id").alias("number"),
        F.concat(back("s")["event_type"], F.lit("!")).alias("kind"),
        back("props", "user_id").alias("wrong_type"),
    )
