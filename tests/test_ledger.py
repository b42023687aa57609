from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import scratch_database
from tidemark.operators import ledger as lg
from tidemark.plans.runs import RunLedger


def ledger(spark, *rows):
    """Rows of (run, seconds, status, step, error, result)."""
    fields = [
        (run, f"key-{run}", status, step, "data", error, result, dt.datetime(2024, 1, 1, 0, 0, second))
        for run, second, status, step, error, result in rows
    ]
    return spark.createDataFrame(fields, lg.LEDGER_ROW)


def test_state_follows_the_last_status(spark):
    rows = ledger(
        spark,
        ("a", 1, "PENDING", None, None, None),
        ("a", 2, "IN_PROGRESS", None, None, None),
        ("a", 3, "RETRYING", None, "first", None),
        ("a", 4, "RETRYING", None, "second", None),
        ("a", 5, None, "done", None, None),
        ("a", 6, "COMPLETED", None, None, '{"n":1}'),
        ("b", 1, "PENDING", None, None, None),
        ("b", 2, "FAILED", None, "boom", None),
        ("c", 1, None, "orphan", None, None),
    )
    state = {r["journey_id"]: r.asDict() for r in lg.current_state(rows).collect()}
    assert set(state) == {"a", "b"}
    a = state["a"]
    assert (a["status"], a["retry_count"], a["error_message"], a["result"]) == ("COMPLETED", 2, "second", '{"n":1}')
    assert (a["created_at"].second, a["updated_at"].second, a["idempotency_key"]) == (1, 6, "key-a")
    assert (state["b"]["status"], state["b"]["error_message"]) == ("FAILED", "boom")
    attempts = {r["journey_id"]: r.asDict() for r in lg.attempts(rows).collect()}
    assert (attempts["a"]["attempts"], attempts["a"]["errors"], attempts["a"]["failed"]) == (3, 2, False)
    assert (attempts["b"]["attempts"], attempts["b"]["last_error"], attempts["b"]["failed"]) == (0, "boom", True)


def test_unknown_status_fails(spark):
    with pytest.raises(PySparkException, match="unknown run status"):
        lg.current_state(ledger(spark, ("a", 1, "DONE", None, None, None))).collect()


def test_steps_and_orphans(spark):
    rows = ledger(
        spark,
        ("a", 1, None, "early", None, None),
        ("a", 2, "PENDING", None, None, None),
        ("a", 4, None, "second", None, None),
        ("a", 3, None, "first", None, None),
        ("b", 1, None, "lost", None, None),
    )
    steps = [(r["journey_id"], r["step_no"], r["name"]) for r in lg.step_history(rows).collect()]
    assert sorted(steps) == [("a", 1, "first"), ("a", 2, "second")]
    assert {r["step_name"] for r in lg.orphan_steps(rows).collect()} == {"early", "lost"}


def test_requests(spark):
    state = lg.current_state(
        ledger(
            spark,
            ("done", 1, "COMPLETED", None, None, "r"),
            ("busy", 1, "IN_PROGRESS", None, None, None),
            ("failed", 1, "FAILED", None, None, None),
        )
    )
    asked = [(None, "done"), (None, "done"), ("busy", None), ("failed", "k"), (None, "new"), (None, None), ("", "")]
    requests = lg.resolve_requests(spark.createDataFrame(asked, "journey_id string, idempotency_key string"))
    rows = {r["journey_id"]: r.asDict() for r in requests.collect()}
    made_up = [k for k in rows if k not in {"done", "busy", "failed", "new"}]
    assert len(made_up) == 2 and rows["failed"]["idempotency_key"] == "k" and rows["busy"]["idempotency_key"] == "busy"
    named = requests.where(F.col("journey_id").isin("done", "busy", "failed", "new"))
    plan = {r["journey_id"]: r["action"] for r in lg.plan_requests(named, state).collect()}
    assert plan == {"done": "skip", "busy": "resume", "failed": "resume", "new": "create"}
    assert {r["journey_id"] for r in lg.pending_work(named, state).collect()} == {"busy", "failed", "new"}
    assert [tuple(r) for r in lg.replay(named, state).collect()] == [("done", "r")]


def test_retention_is_strict_and_missing_is_oldest(spark):
    runs = spark.sql(
        "SELECT * FROM VALUES ('edge', timestamp '2024-01-01 00:00:00'), ('old', timestamp '2023-12-31 23:59:59'), "
        "('none', null) AS t(journey_id, created_at)"
    )
    kept = lg.retain(runs, F.lit("2024-01-31 00:00:00").cast("timestamp"))
    assert [r["journey_id"] for r in kept.collect()] == ["edge"]


def test_result_keeps_its_type(spark):
    df = spark.sql("SELECT '12' AS text, 12 AS number, named_struct('a', array(1, 2)) AS nested")

    def back(name, as_type=None):
        kind = df.schema[name].dataType
        return df.select(lg.decode_result(lg.encode_result(F.col(name), kind), as_type or kind)).first()[0]

    assert back("text") == "12" and back("number") == 12 and back("nested")["a"] == [1, 2]
    assert back("text", T.IntegerType()) is None


def test_ledger_fields_are_checked(spark):
    runs = spark.createDataFrame([("a", "a")], "journey_id string, idempotency_key string")
    with pytest.raises(ValueError, match="not a ledger field"):
        lg.ledger_rows(runs, note=F.lit(1))


def test_run_table(spark):
    runs = RunLedger(spark, scratch_database(spark), "runs")
    calls = []

    def work():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("not yet")
        return spark.range(2).select("id", F.lit("x").alias("name"))

    with pytest.raises(RuntimeError):
        runs.run("job", work)
    assert runs.get("job").first()["status"] == "FAILED"
    first = sorted(map(tuple, runs.run("job", work).collect()))
    again = sorted(map(tuple, runs.run("job", work).collect()))
    assert first == again == [(0, "x"), (1, "x")] and len(calls) == 2
    assert runs.run("nothing", lambda: spark.range(0)).count() == 0
    steps = [r["name"] for r in lg.step_history(runs.rows()).where("journey_id = 'job'").orderBy("step_no").collect()]
    assert steps == ["execution_started", "execution_error", "execution_started", "execution_completed"]

    asked = spark.createDataFrame([("p",), ("p",), ("job",)], "idempotency_key string")
    plan = runs.start(asked, metadata=F.lit('{"source":"test"}'), now=F.lit("2020-01-01").cast("timestamp"))
    assert {r["journey_id"]: r["action"] for r in plan.collect()} == {"p": "create", "job": "skip"}
    assert runs.get("p").first()["metadata"] == '{"source":"test"}'
    runs.cleanup()
    assert {r["journey_id"] for r in runs.state().collect()} == {"job", "nothing"}


def test_replay_gives_one_report_of_two_callers(spark):
    from checks.registry import scratch_database
    from tidemark.plans.runs import RunLedger

    runs = RunLedger(spark, scratch_database(spark), "runs")
    key = "twice"
    request = spark.range(1).select(F.lit(key).alias("idempotency_key"))
    run = runs.start(request).select("journey_id", "idempotency_key")
    for n in (1, 2):  # two callers that both found the run open
        runs._complete(run, key, spark.createDataFrame([(n,), (n,)], "n int"))
    rows = [r["n"] for r in runs.run(key, lambda: None).collect()]
    assert rows in ([1, 1], [2, 2])


def test_cleanup_keeps_fresh_rows_without_a_run(spark):
    from checks.registry import scratch_database
    from tidemark.plans.runs import RunLedger

    runs = RunLedger(spark, scratch_database(spark), "runs")
    names = spark.createDataFrame([("old", "old"), ("new", "new")], "journey_id string, idempotency_key string")
    old, now = F.lit("2020-01-01").cast("timestamp"), F.lit("2024-01-10").cast("timestamp")
    for name, at in (("old", old), ("new", now)):
        runs.append(lg.ledger_rows(names.where(F.col("journey_id") == name), at, step_name=F.lit("orphan")))
    runs.cleanup(30, F.lit("2024-01-20").cast("timestamp"))
    assert [r["journey_id"] for r in runs.rows().collect()] == ["new"]


def test_unknown_runs_get_no_steps_and_no_status(spark):
    runs = RunLedger(spark, scratch_database(spark), "runs")
    one = spark.createDataFrame([("a",)], "idempotency_key string")
    known = runs.start(one).select("journey_id", "idempotency_key")
    both = known.union(spark.createDataFrame([("b", "b")], "journey_id string, idempotency_key string"))
    with pytest.raises(PySparkException, match="step of an unknown run: b"):
        runs.add_step(both, "x")
    assert lg.step_history(runs.rows()).count() == 0
    runs.add_step(known, "x")
    runs.set_status(both, lg.COMPLETED)
    assert {r["journey_id"]: r["status"] for r in runs.state().collect()} == {"a": "COMPLETED"}
    assert [r["name"] for r in lg.step_history(runs.rows()).collect()] == ["x"]


def opened(spark, runs, *names, at):
    return runs.start(spark.createDataFrame([(n,) for n in names], "idempotency_key string"), now=F.lit(at).cast("timestamp"))


def test_state_is_the_stored_one_and_later_rows(spark):
    runs = RunLedger(spark, scratch_database(spark), "runs", buckets=4)
    known = opened(spark, runs, "a", "b", at="2024-01-05 10:00:00").select("journey_id", "idempotency_key")
    same = F.lit("2024-01-06 00:00:00").cast("timestamp")
    runs.set_status(known, lg.RETRYING, now=same)
    runs.checkpoint()
    assert len(runs._checkpoint_tables()) == 1
    runs.set_status(known.where("journey_id = 'a'"), lg.COMPLETED, now=same)  # of one time: the later append counts
    runs.set_status(known.where("journey_id = 'b'"), lg.RETRYING, now=same)
    found = {r["journey_id"]: (r["status"], r["retry_count"], str(r["created_at"])) for r in runs.state().collect()}
    at = "2024-01-05 10:00:00"
    assert found == {"a": ("COMPLETED", 1, at), "b": ("RETRYING", 2, at)}
    runs.checkpoint()
    assert len(runs._checkpoint_tables()) == 1
    assert {r["journey_id"]: r["retry_count"] for r in runs.state().collect()} == {"a": 1, "b": 2}
    plan = runs.get("a")._jdf.queryExecution().executedPlan().toString()
    bucket = spark.sql("SELECT pmod(hash('a'), 4)").first()[0]
    stored = next(line for line in plan.splitlines() if "FileScan" in line and "__state_" in line)
    assert f"(bucket#" in stored and f"= {bucket})" in stored
    assert runs.get("b").first()["retry_count"] == 2 and runs.get("none").count() == 0
    # All rows of a run lie in the day it was opened.
    assert {day for day, _ in runs._partitions()} == {"2024-01-05"}


def test_cleanup_drops_whole_days_and_rewrites_the_mixed_one(spark):
    runs = RunLedger(spark, scratch_database(spark), "runs")
    for name, at in (("old", "2024-01-01 09:00:00"), ("early", "2024-01-05 09:00:00"), ("late", "2024-01-05 15:00:00"), ("new", "2024-01-09 00:00:00")):
        known = opened(spark, runs, name, at=at).select("journey_id", "idempotency_key")
        runs.add_step(known, "work", now=F.lit("2024-01-20").cast("timestamp"))

    def last_day():
        return sorted(p for p in spark.table(runs.name).inputFiles() if "day=2024-01-09" in p)

    before = last_day()
    runs.cleanup(10, F.lit("2024-01-15 12:00:00").cast("timestamp"))
    assert {r["journey_id"] for r in runs.state().collect()} == {"late", "new"}
    assert sorted(r["journey_id"] for r in runs.rows().collect()) == ["late", "late", "new", "new"]
    assert {d for d, _ in runs._partitions()} == {"2024-01-05", "2024-01-09"}
    assert len(before) == 2 and last_day() == before  # other days are not touched


def test_appends_during_cleanup_survive(spark, monkeypatch):
    runs = RunLedger(spark, scratch_database(spark), "runs")
    opened(spark, runs, "early", at="2024-01-05 09:00:00")
    late = opened(spark, runs, "late", at="2024-01-05 15:00:00").select("journey_id", "idempotency_key")
    overwrite = RunLedger._overwrite

    def with_append(self, rows):
        self.add_step(late, "meanwhile")
        opened(spark, self, "other", at="2024-01-05 16:00:00")
        overwrite(self, rows)

    monkeypatch.setattr(RunLedger, "_overwrite", with_append)
    runs.cleanup(10, F.lit("2024-01-15 12:00:00").cast("timestamp"))
    assert {r["journey_id"] for r in runs.state().collect()} == {"late", "other"}
    assert [r["step_name"] for r in runs.rows().where("journey_id = 'late'").orderBy("seq").collect()] == [None, "meanwhile"]
