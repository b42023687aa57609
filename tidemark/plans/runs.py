"""Tracked runs kept in a ledger table: start, status, steps, replay and clean-up."""

from __future__ import annotations

import json
import random
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ledger as lg
from tidemark.sources.tables import scratch_path

LEDGER_COLUMNS = tuple(field.split()[0] for field in lg.LEDGER_ROW.split(","))
#: Order of a run's rows in the table: by time, then by append; what one append says at one time in a fixed order.
TABLE_ORDER = ("ts", "seq", "status", "step_name")
BUCKET = "bucket"
#: The bucket of the rows that name the appends a stored state covers.
COVERED = -1


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash("journey_id"), F.lit(buckets)).alias(BUCKET)


class RunLedger:
    """Append-only catalog table of ledger rows, partitioned by the day its run was opened and by append.

    Every append has a number of its own and becomes partitions of its own, never changed by another append. Later numbers
    are later: rows of one time are in the order of their appends. :meth:`checkpoint` stores a partial state per run and which
    appends it covers; the state is the stored one merged with the rows of later appends. Rows of runs that were never
    opened lie in the partition of their own day.
    """

    def __init__(self, spark: SparkSession, database: str, table: str, buckets: int = 32):
        # The catalog keeps names in lower case.
        self.spark, self.database, self.table, self.buckets = spark, database, table.lower(), buckets
        self.name = f"`{database}`.`{self.table}`"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({lg.LEDGER_ROW}, day date, seq bigint) USING parquet PARTITIONED BY (day, seq)"
        )

    # --- rows and appends ---------------------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """All ledger rows, with the number of their append."""
        return self.spark.table(self.name).drop("day")

    def _partitions(self) -> list[tuple[str, int]]:
        """Day and number of every append that is complete."""
        found = [r[0].split("/") for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        return [(day.partition("=")[2], int(seq.partition("=")[2])) for day, seq in found]

    def append(self, rows: DataFrame) -> None:
        """Append ledger rows of any runs; each goes to the day its run was opened, now or earlier."""
        rows = self._written(rows.select(*LEDGER_COLUMNS), "run-rows")
        earlier = self._partial(rows.select("journey_id")).select("journey_id", "created_at")
        opened = rows.where(F.col("status").isNotNull()).select("journey_id", F.col("ts").alias("created_at"))
        days = earlier.unionByName(opened).groupBy("journey_id").agg(F.min("created_at").alias("__opened"))
        self._append(rows.join(days, on="journey_id", how="left"), F.col("__opened"))

    def _append(self, rows: DataFrame, opened: Column) -> None:
        """Append rows whose runs were opened at this time, as one numbered append."""
        seq = time.time_ns() // 1000 * 1000 + random.randrange(1000)
        day = F.coalesce(opened.cast("date"), F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
        rows.select(*LEDGER_COLUMNS, day.alias("day"), F.lit(seq).alias("seq")).write.insertInto(self.name)

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # --- state --------------------------------------------------------------------------------------------

    def _checkpoint_tables(self) -> list[str]:
        """Stored states, oldest first; Spark lists a table once it is complete."""
        found = self.spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{self.table}__state_*'").collect()
        pattern = rf"{re.escape(self.table)}__state_\d{{8}}_\d+_[0-9a-f]{{8}}"
        return sorted(r["tableName"] for r in found if re.fullmatch(pattern, r["tableName"]))

    def _stored(self) -> tuple[DataFrame | None, int, set[tuple[str, int]]]:
        """The last stored state, its number of buckets, and the appends that it covers."""
        tables = self._checkpoint_tables()
        if not tables:
            return None, self.buckets, set()
        stored = self.spark.table(f"`{self.database}`.`{tables[-1]}`")
        covered = stored.where(F.col(BUCKET) == COVERED).select("journey_id", "retries").collect()  # a row per append
        return stored.where(F.col(BUCKET) != COVERED), int(tables[-1].split("_")[-2]), {(r[0], r[1]) for r in covered}

    def _partial(self, runs: DataFrame | None = None) -> DataFrame:
        """Partial state per run, of all runs or of those in ``runs``: the stored one and rows of later appends.

        For some runs only the buckets of their ids are read of the stored state.
        """
        stored, buckets, covered = self._stored()
        later = sorted({seq for day, seq in self._partitions() if (day, seq) not in covered})
        tail = self.rows().where(F.col("seq").isin(later)) if later else self.rows().where(F.lit(False))
        if runs is not None:
            runs = runs.select("journey_id").distinct()
            tail = tail.join(runs, on="journey_id", how="left_semi")
        found = lg.partial_state(tail, TABLE_ORDER)
        if stored is None:
            return found
        if runs is not None:
            touched = [r[0] for r in runs.select(_bucket(buckets)).distinct().collect()]
            stored = stored.where(F.col(BUCKET).isin(touched)).join(runs, on="journey_id", how="left_semi")
        return lg.merged_state(stored.select(*found.columns).unionByName(found))

    def state(self) -> DataFrame:
        return lg.finished_state(self._partial())

    def get(self, journey_id: str) -> DataFrame:
        """State of one run: one bucket of the stored state and the later appends are read."""
        return lg.finished_state(self._partial(self.spark.createDataFrame([(journey_id,)], "journey_id string")))

    def checkpoint(self, since: Column | None = None) -> None:
        """Store the state of all runs as of the appends there are; leave out runs opened before ``since``.

        It is a table of its own, which counts from when Spark lists it; appends that come meanwhile are not covered
        and are read beside it.
        """
        parts, earlier = self._partitions(), self._checkpoint_tables()
        stored, _, covered = self._stored()
        later = sorted({seq for day, seq in parts if (day, seq) not in covered})
        state = lg.partial_state(self.rows().where(F.col("seq").isin(later) if later else F.lit(False)), TABLE_ORDER)
        if stored is not None:
            state = lg.merged_state(stored.select(*state.columns).unionByName(state))
        if since is not None:
            state = state.where(F.coalesce("created_at", "updated_at") >= since)
        marks = self.spark.createDataFrame(parts, "journey_id string, retries bigint").withColumn(BUCKET, F.lit(COVERED))
        rows = state.withColumn(BUCKET, _bucket(self.buckets)).unionByName(marks, allowMissingColumns=True)
        number = int(earlier[-1].split("_")[-3]) + 1 if earlier else 1
        name = f"{self.table}__state_{number:08d}_{self.buckets}_{uuid.uuid4().hex[:8]}"
        # One task per bucket, or every task would write a file into each.
        rows.repartition(BUCKET).sortWithinPartitions("journey_id").write.partitionBy(BUCKET).saveAsTable(
            f"`{self.database}`.`{name}`"
        )
        for table in earlier:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{table}`")

    def _looked_up(self, runs: DataFrame) -> DataFrame:
        """``runs`` with ``__opened``, when they were opened, NULL for unknown ones."""
        known = self._partial(runs).where(F.col("last_status").isNotNull())
        known = known.select("journey_id", F.col("created_at").alias("__opened"), F.lit(True).alias("__known"))
        return runs.join(known, on="journey_id", how="left")

    def start(self, requests: DataFrame, metadata: Column | None = None, now: Column | None = None) -> DataFrame:
        """Open the runs that do not exist yet and return the plan of all requests.

        The plan is written out first: ids made up for requests without one must not change between the ledger
        and the caller.
        """
        resolved = self._written(lg.resolve_requests(requests), "run-requests")
        plan = self._written(lg.plan_requests(resolved, lg.finished_state(self._partial(resolved))), "run-plan")
        fields = {} if metadata is None else {"data": metadata}
        created = plan.where(F.col("action") == lg.CREATE)
        self._append(lg.ledger_rows(created, now, status=F.lit(lg.PENDING), **fields), F.col("ts"))
        return plan

    def set_status(
        self, runs: DataFrame, status: str, error: Column | None = None, now: Column | None = None
    ) -> None:
        """Append a status row for every run in ``runs`` (columns ``journey_id, idempotency_key``) that exists.

        Unknown runs are left out: a status does not open a run.
        """
        fields = {} if error is None else {"error": error}
        known = self._written(self._looked_up(runs).where(F.col("__known")), "run-known")
        self._append_for(known, lg.ledger_rows(known, now, status=F.lit(status), **fields))

    def add_step(
        self, runs: DataFrame, name: str, data: Column | None = None, now: Column | None = None
    ) -> None:
        """Append a step for every run in ``runs``; an unknown run fails the job, and nothing is appended."""
        fields = {} if data is None else {"data": data}
        unknown = F.raise_error(F.concat(F.lit("step of an unknown run: "), F.coalesce("journey_id", F.lit("NULL"))))
        checked = F.when(F.col("__known"), F.col("journey_id")).otherwise(unknown)
        known = self._written(self._looked_up(runs).withColumn("journey_id", checked), "run-known")
        self._append_for(known, lg.ledger_rows(known, now, step_name=F.lit(name), **fields))

    def _append_for(self, known: DataFrame, rows: DataFrame) -> None:
        """Append rows of runs that were looked up."""
        opened = known.select("journey_id", "__opened").distinct()
        self._append(rows.join(opened, on="journey_id"), F.col("__opened"))

    def run(self, key: str, work: Callable[[], DataFrame]) -> DataFrame:
        """Do ``work`` once per key: a completed key returns its stored rows without working again.

        ``work`` returns a frame, such as a job report, whose rows are stored in the ledger as JSON. An error is
        recorded and raised again, and the next call resumes the run.
        """
        stored = self._replay(key)
        if stored is not None:
            return stored
        request = self.spark.range(1).select(F.lit(key).alias("idempotency_key"))
        run = self.start(request).select("journey_id", "idempotency_key")
        self.set_status(run, lg.IN_PROGRESS)
        self.add_step(run, "execution_started")
        try:
            self._complete(run, key, work())
        except Exception as error:
            self.add_step(run, "execution_error", F.lit(str(error)))
            self.set_status(run, lg.FAILED, F.lit(str(error)))
            raise
        self.add_step(run, "execution_completed")
        return self._replay(key)

    def _complete(self, run: DataFrame, key: str, report: DataFrame) -> None:
        """One append: a row that completes the run and holds the schema, and a row per result row.

        All carry the number of this completion: two callers may complete one key, and only one report counts.
        """
        number = uuid.uuid4().hex
        mark = json.dumps({"completion": number, "schema": json.loads(report.schema.json())})
        done = {"status": F.lit(lg.COMPLETED), "data": F.lit(mark)}
        part = {"status": F.lit(lg.COMPLETED), "data": F.lit(number)}
        as_json = F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"})
        results = report.select(
            F.lit(key).alias("journey_id"), F.lit(key).alias("idempotency_key"), as_json.alias("__result")
        )
        known = self._written(self._looked_up(run.select("journey_id", "idempotency_key")), "run-known")
        self._append_for(
            known, lg.ledger_rows(run, **done).unionByName(lg.ledger_rows(results, **part, result=F.col("__result")))
        )

    def _replay(self, key: str) -> DataFrame | None:
        """Stored result of a completed run, else None."""
        opened = self.get(key).select(F.col("created_at").cast("date")).first()
        if opened is None:
            return None
        # Only the day of the run is read.
        rows = self.spark.table(self.name).where(F.col("day") == F.lit(opened[0]))
        completed = rows.where((F.col("journey_id") == key) & (F.col("status") == lg.COMPLETED))
        marks = completed.where(F.col("result").isNull()).orderBy(F.desc("ts"), "data")
        mark = marks.select("data").first()
        if mark is None:
            return None
        known = json.loads(mark["data"])
        schema = T.StructType.fromJson(known["schema"])
        rows = completed.where(F.col("result").isNotNull() & (F.col("data") == known["completion"]))
        return rows.select(F.from_json("result", schema).alias("row")).select("row.*")

    # --- retention ----------------------------------------------------------------------------------------

    def cleanup(self, days: int = lg.RETENTION_DAYS, now: Column | None = None) -> None:
        """Drop all rows of runs older than ``days``, and rows without a run that are older themselves.

        The state without these runs is stored first. Whole days are dropped; of the day that the limit falls into, the
        appends seen now are overwritten one by one with what is kept of them. Appends that come meanwhile are partitions of
        their own and stay. A clean-up that dies can be repeated.
        """
        limit = (F.current_timestamp() if now is None else now) - F.make_interval(days=F.lit(days))
        at = self.spark.range(1).select(limit.alias("at"), limit.cast("date").cast("string").alias("day")).first()
        since = F.lit(at["at"])
        self.checkpoint(since)
        parts = self._partitions()
        self._drop([p for p in parts if p[0] < at["day"]])
        mixed = sorted({seq for d, seq in parts if d == at["day"]})
        if mixed:
            self._rewrite(at["day"], mixed, since)

    def _rewrite(self, day: str, appends: list[int], since: Column) -> None:
        """Keep of these appends of a day what is not older; all rows of a run lie in its day."""
        rows = self.spark.table(self.name).where((F.col("day") == F.lit(day).cast("date")) & F.col("seq").isin(appends))
        opened = rows.where(F.col("status").isNotNull()).groupBy("journey_id").agg(F.min("ts").alias("__opened"))
        kept = rows.join(opened, on="journey_id", how="left").where(F.coalesce("__opened", "ts") >= since)
        kept = self._written(kept.select(*rows.columns), "run-kept")
        self._overwrite(kept)
        left = {r["seq"] for r in kept.select("seq").distinct().collect()}
        self._drop([(day, seq) for seq in appends if seq not in left])

    def _drop(self, parts: list[tuple[str, int]]) -> None:
        """Drop whole appends."""
        for i in range(0, len(parts), 1000):
            listed = ", ".join(f"PARTITION (day='{day}', seq={seq})" for day, seq in parts[i : i + 1000])
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {listed}")

    def _overwrite(self, rows: DataFrame) -> None:
        """Put rows in place of the partitions they are of; the setting this takes is that of a session of its own."""
        if rows.isEmpty():
            return
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        session.read.schema(rows.schema).parquet(*rows.inputFiles()).write.mode("overwrite").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
