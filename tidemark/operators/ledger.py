"""Run ledger: state, steps, retries and replay of tracked runs, from an append-only table of ledger rows.

A ledger row is ``journey_id, idempotency_key, status, step_name, data, error, result, ts``; unused fields are
NULL. A row with a status changes the state of its run, a row with a step name adds a step to it. A run exists
from its first row with a status on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.placed import number_rows

# The states of a run.
PENDING, IN_PROGRESS, COMPLETED = "PENDING", "IN_PROGRESS", "COMPLETED"
FAILED, RETRYING, CANCELLED = "FAILED", "RETRYING", "CANCELLED"
STATUSES = (PENDING, IN_PROGRESS, COMPLETED, FAILED, RETRYING, CANCELLED)

LEDGER_ROW = (
    "journey_id string, idempotency_key string, status string, step_name string, data string, "
    "error string, result string, ts timestamp"
)

# Fixed value: days a run is kept.
RETENTION_DAYS = 30

CREATE, RESUME, SKIP = "create", "resume", "skip"


def checked_status(status: Column) -> Column:
    """The status, or a failure of the job for a value that is no status."""
    known = status.isNull() | status.isin(*STATUSES)
    return F.when(known, status).otherwise(
        F.raise_error(F.concat(F.lit("unknown run status: "), status.cast("string")))
    )


def _last(column: str, order: Column) -> Column:
    """Latest value that is not NULL."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), order))


def _order(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_by])


#: How each column of a partial state is combined with others of the same run.
MERGED = {
    "first_key": F.min,
    "last_status": F.max,
    "last_error": F.max,
    "last_result": F.max,
    "opening": F.min,
    "created_at": F.min,
    "updated_at": F.max,
    "retries": F.sum,
}


def partial_state(ledger: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """What some rows say about their runs, in a form that can be merged with what other rows say.

    Values stand behind their place in the order, so that the first or last one of several parts is a minimum or maximum.
    """
    order = [F.col(c) for c in order_by]
    status_row = F.col("status").isNotNull()

    def placed(name: str) -> Column:
        value = F.struct(*order, F.col(name).alias("value"))
        return F.when(F.col(name).isNotNull(), value)

    opening = F.when(status_row, F.struct(*order, F.col("data").alias("value")))
    return (
        ledger.withColumn("status", checked_status(F.col("status")))
        .groupBy("journey_id")
        .agg(
            F.min(placed("idempotency_key")).alias("first_key"),
            F.max(placed("status")).alias("last_status"),
            F.max(placed("error")).alias("last_error"),
            F.max(placed("result")).alias("last_result"),
            F.min(opening).alias("opening"),
            F.min(F.when(status_row, F.col("ts"))).alias("created_at"),
            F.max("ts").alias("updated_at"),
            F.count_if(F.col("status") == RETRYING).alias("retries"),
        )
    )


def merged_state(partial: DataFrame) -> DataFrame:
    """One partial state per run from any number of them."""
    return partial.groupBy("journey_id").agg(*[f(c).alias(c) for c, f in MERGED.items()])


def finished_state(partial: DataFrame) -> DataFrame:
    """The state of runs from one partial state each; what never had a status is no run."""
    return partial.where(F.col("last_status").isNotNull()).select(
        "journey_id",
        F.coalesce("first_key.value", "journey_id").alias("idempotency_key"),
        F.col("last_status.value").alias("status"),
        "created_at",
        "updated_at",
        F.col("last_error.value").alias("error_message"),
        F.col("last_result.value").alias("result"),
        F.col("opening.value").alias("metadata"),
        F.col("retries").alias("retry_count"),
    )


def current_state(ledger: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """One row per run: last status, error and result, first and last time, number of retries.

    ``metadata`` is the data of the row that opened the run.

    One aggregation; every task sends at most one row per run to the shuffle.
    """
    return finished_state(partial_state(ledger, order_by))


def retry_counts(ledger: DataFrame) -> DataFrame:
    """``retry_count`` per run: its changes to RETRYING."""
    return ledger.groupBy("journey_id").agg(
        F.count_if(F.col("status") == RETRYING).alias("retry_count")
    )


def attempts(ledger: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Attempts and errors per run, the last error, and whether the run ended as FAILED."""
    order = _order(order_by)
    started, retried = F.col("status") == IN_PROGRESS, F.col("status") == RETRYING
    return (
        ledger.groupBy("journey_id")
        .agg(
            F.coalesce(F.max(F.when(started, 1)), F.lit(0)).alias("__started"),
            F.count_if(retried).alias("__retries"),
            F.count_if(F.col("error").isNotNull()).alias("errors"),
            _last("error", order).alias("last_error"),
            _last("status", order).alias("__status"),
        )
        .select(
            "journey_id",
            (F.col("__started") + F.col("__retries")).cast("bigint").alias("attempts"),
            "errors",
            "last_error",
            F.coalesce(F.col("__status") == FAILED, F.lit(False)).alias("failed"),
        )
    )


def _run_starts(ledger: DataFrame) -> DataFrame:
    return (
        ledger.where(F.col("status").isNotNull())
        .groupBy(F.col("journey_id").alias("__run"))
        .agg(F.min("ts").alias("__start"))
    )


def _known(ts: Column) -> Column:
    return F.coalesce(F.col("__start") <= ts, F.lit(False))


def step_history(
    ledger: DataFrame,
    order_by: Sequence[str] = ("ts",),
) -> DataFrame:
    """Steps of all runs as ``journey_id, step_no, name, timestamp, data``, numbered per run from 1.

    Rows, not one array per run, since a run may have any number of steps. Steps that came before their run
    existed are left out (see :func:`orphan_steps`). Steps and, for the runs' starts, statuses are each read once.
    """
    steps = ledger.where(F.col("step_name").isNotNull())
    known = (
        steps.join(_run_starts(ledger), on=F.col("journey_id") == F.col("__run"), how="inner")
        .where(_known(F.col("ts")))
        .drop("__run", "__start")
    )
    return number_rows(known, ["journey_id"], order_by, "step_no").select(
        "journey_id",
        "step_no",
        F.col("step_name").alias("name"),
        F.col("ts").alias("timestamp"),
        "data",
    )


def orphan_steps(ledger: DataFrame) -> DataFrame:
    """Steps added to a run that did not exist at that time; the reference point is the run's first status."""
    steps = ledger.where(F.col("step_name").isNotNull())
    joined = steps.join(_run_starts(ledger), on=F.col("journey_id") == F.col("__run"), how="left")
    return joined.where(~_known(F.col("ts"))).select(*ledger.columns)


def resolve_requests(requests: DataFrame) -> DataFrame:
    """``journey_id, idempotency_key`` of every distinct request.

    The id is the given one, else the idempotency key, else a new one. Requests for the same run collapse; a
    request that names neither is a run of its own.
    """

    def given(name: str) -> Column:
        column = F.col(name) if name in requests.columns else F.lit(None)
        return F.nullif(column.cast("string"), F.lit(""))

    run, key = given("journey_id"), given("idempotency_key")
    resolved = requests.select(
        F.coalesce(run, key, F.uuid()).alias("journey_id"), key.alias("idempotency_key")
    )
    return resolved.groupBy("journey_id").agg(
        F.coalesce(F.min("idempotency_key"), F.col("journey_id")).alias("idempotency_key")
    )


def plan_requests(requests: DataFrame, state: DataFrame) -> DataFrame:
    """What to do for every resolved request: ``skip`` a completed run, ``resume`` a known one, else ``create``.

    IN_PROGRESS is no lock: such a run is resumed. A failed run is resumed too and keeps its history.
    """
    known = state.select("journey_id", F.col("status").alias("__status"))
    action = (
        F.when(F.col("__status").isNull(), CREATE)
        .when(F.col("__status") == COMPLETED, SKIP)
        .otherwise(RESUME)
    )
    return requests.join(known, on="journey_id", how="left").select(
        "journey_id", "idempotency_key", F.col("__status").alias("status"), action.alias("action")
    )


def pending_work(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Resolved requests whose run has not completed."""
    done = state.where(F.col("status") == COMPLETED).select("journey_id")
    return requests.join(done, on="journey_id", how="left_anti")


def replay(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Stored results of the requests whose run has completed."""
    done = state.where(F.col("status") == COMPLETED).select("journey_id", "result")
    return requests.select("journey_id").join(done, on="journey_id", how="inner")


def retain(
    runs: DataFrame, now: Column | None = None, days: int = RETENTION_DAYS, time_column: str = "created_at"
) -> DataFrame:
    """Runs not older than ``days``; a run without a creation time counts as the oldest."""
    now = F.current_timestamp() if now is None else now
    cutoff = now - F.make_interval(days=F.lit(days))
    return runs.where(F.col(time_column) >= cutoff)


def start_rows(plan: DataFrame, now: Column | None = None) -> DataFrame:
    """Ledger rows that open the runs a plan wants created."""
    return ledger_rows(plan.where(F.col("action") == CREATE), now, status=F.lit(PENDING))


def ledger_rows(runs: DataFrame, now: Column | None = None, **fields: Column) -> DataFrame:
    """Ledger rows to append for ``runs``: the given fields, everything else NULL."""
    fields = {"ts": F.current_timestamp() if now is None else now, **fields}
    schema = T.StructType.fromDDL(LEDGER_ROW)
    unknown = set(fields) - set(schema.names)
    if unknown:
        raise ValueError(f"not a ledger field: {sorted(unknown)}")
    if "status" in fields:
        fields["status"] = checked_status(fields["status"])

    def value(field: T.StructField) -> Column:
        if field.name in fields:
            return fields[field.name]
        return F.col(field.name) if field.name in ("journey_id", "idempotency_key") else F.lit(None)

    return runs.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def encode_result(result: Column, data_type: T.DataType) -> Column:
    """Any result as text that remembers its type, so that text that looks like JSON stays text."""
    return F.to_json(
        F.struct(F.lit(data_type.simpleString()).alias("type"), result.alias("value")),
        {"ignoreNullFields": "false"},
    )


def decode_result(encoded: Column, data_type: T.DataType) -> Column:
    """The value behind :func:`encode_result`; NULL when it was stored with another type."""
    kind = data_type.simpleString()
    parsed = F.from_json(encoded, f"struct<type:string,value:{kind}>")
    return F.when(parsed["type"] == kind, parsed["value"])
