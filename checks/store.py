"""Versioned store on aggregates of ``events`` per user and event type.

The store holds the totals of the first half of January; the batch brings the whole month, but no errors (those
rows stay untouched), views of the first half only (nothing changes) and signups (new to the store).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import store as st

from .registry import query, scratch_database, table

NOW = "2024-02-01 00:00:00"
THEN = "2024-01-16 00:00:00"
FIRST_HALF = f"ts < timestamp_ntz '{THEN}'"
HASH = """sha256('{"n":' || n || ',"top":' || top || '}')"""
OLD_SQL = f"""SELECT user_id || '/' || event_type AS id, count(*) AS n, CAST(floor(max(value)) AS BIGINT) AS top
  FROM events WHERE ts < TIMESTAMP '{THEN}' AND event_type <> 'signup' GROUP BY user_id, event_type"""
NEW_SQL = f"""SELECT user_id || '/' || event_type AS id, count(*) AS n, CAST(floor(max(value)) AS BIGINT) AS top
  FROM events WHERE event_type <> 'error' AND (event_type <> 'view' OR ts < TIMESTAMP '{THEN}')
  GROUP BY user_id, event_type"""
BOTH = f"""
WITH o AS (SELECT *, {HASH} AS k FROM ({OLD_SQL})), b AS (SELECT *, {HASH} AS k FROM ({NEW_SQL})),
j AS (SELECT COALESCE(o.id, b.id) AS id, o.id AS oid, b.id AS bid, o.n AS on_, b.n AS bn, o.top AS otop,
             b.top AS btop, o.k AS ok, b.k AS bk,
             CASE WHEN o.id IS NULL THEN 'created' WHEN b.id IS NULL OR o.k = b.k THEN 'exists'
                  ELSE 'updated' END AS status
      FROM o FULL JOIN b ON o.id = b.id)
"""


def now(text: str = NOW) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def totals(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(where)
        .groupBy(F.concat_ws("/", "user_id", "event_type").alias("id"))
        .agg(F.count("*").alias("n"), F.floor(F.max("value")).cast("bigint").alias("top"))
    )


def old_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(spark, sf_dir, f"{FIRST_HALF} AND event_type <> 'signup'")


def new_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(spark, sf_dir, f"event_type <> 'error' AND (event_type <> 'view' OR {FIRST_HALF})")


def as_store(df: DataFrame, version: Column | None = None) -> DataFrame:
    """A store filled with ``df`` at the earlier time."""
    prepared = st.prepare_batch(df)
    return prepared.withColumns(
        {
            "version": F.lit(1).cast("bigint") if version is None else version,
            "created_at": now(THEN),
            "updated_at": now(THEN),
        }
    )


def old_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_store(old_totals(spark, sf_dir))


@query(
    "store_upsert_status",
    BOTH
    + """SELECT id, bk AS idempotency_key, status, CASE WHEN status = 'updated' THEN 2 ELSE 1 END::BIGINT AS version
FROM j WHERE bid IS NOT NULL""",
)
def store_upsert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.save_outcomes(old_store(spark, sf_dir), st.prepare_batch(new_totals(spark, sf_dir)))


SNAPSHOT = BOTH + f"""SELECT id, CASE WHEN status = 'exists' THEN on_ ELSE bn END AS n,
       CASE WHEN status = 'exists' THEN otop ELSE btop END AS top,
       CASE WHEN status = 'exists' THEN ok ELSE bk END AS idempotency_key,
       CASE WHEN status = 'updated' THEN 2 ELSE 1 END::BIGINT AS version,
       CASE WHEN status = 'created' THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{THEN}' END AS created_at,
       CASE WHEN status = 'exists' THEN TIMESTAMP '{THEN}' ELSE TIMESTAMP '{NOW}' END AS updated_at FROM j"""


@query("store_upsert_snapshot", SNAPSHOT)
def store_upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = st.prepare_batch(new_totals(spark, sf_dir))
    return st.save(old_store(spark, sf_dir), batch, now()).drop("metadata")


VERSIONED = f"""
WITH o AS (SELECT *, {HASH} AS k, n AS v FROM ({OLD_SQL})),
b AS (SELECT *, {HASH} AS k, top AS v FROM ({NEW_SQL})),
j AS (SELECT b.id, b.k AS bk, o.v AS ov, b.v AS bv,
             CASE WHEN o.id IS NULL THEN 'created' WHEN o.k = b.k THEN 'exists' WHEN b.v <= o.v THEN 'conflict'
                  ELSE 'updated' END AS status
      FROM b LEFT JOIN o ON o.id = b.id)
"""


def _versioned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored version: number of events; offered version: the highest value."""
    store = as_store(old_totals(spark, sf_dir), F.col("n"))
    batch = new_totals(spark, sf_dir).withColumn("version", F.col("top"))
    return store, st.prepare_batch(batch)


@query(
    "store_version_conflict",
    VERSIONED
    + """SELECT id, bk AS idempotency_key, status,
       CASE WHEN status IN ('exists', 'conflict') THEN ov ELSE bv END AS version FROM j""",
)
def store_version_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.save_outcomes(*_versioned(spark, sf_dir))


@query(
    "store_batch_stats",
    VERSIONED
    + """SELECT count(*) FILTER (WHERE status <> 'conflict') AS saved, count(*) AS total,
       count(*) FILTER (WHERE status = 'conflict') AS failed FROM j""",
)
def store_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.batch_stats(st.save_outcomes(*_versioned(spark, sf_dir)))


@query(
    "store_auto_version",
    BOTH + "SELECT id, CASE WHEN status = 'updated' THEN on_ + 1 WHEN oid IS NULL THEN 1 ELSE on_ END AS version FROM j",
)
def store_auto_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = as_store(old_totals(spark, sf_dir), F.col("n"))
    return st.save(store, st.prepare_batch(new_totals(spark, sf_dir)), now()).select("id", "version")


@query(
    "store_caller_key",
    f"""WITH o AS ({OLD_SQL}), b AS ({NEW_SQL})
SELECT b.id, 'top-' || b.top AS idempotency_key, CASE WHEN o.id IS NULL THEN 'created'
       WHEN o.top = b.top THEN 'exists' ELSE 'updated' END AS status,
       CASE WHEN o.top <> b.top THEN 2 ELSE 1 END::BIGINT AS version FROM b LEFT JOIN o ON o.id = b.id""",
)
def store_caller_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The caller's key says that only a new maximum counts; different metadata never does."""
    key = F.concat(F.lit("top-"), F.col("top").cast("string"))
    metadata = F.create_map(F.lit("n"), F.col("n").cast("string"))
    old = old_totals(spark, sf_dir).withColumn("idempotency_key", key)
    new = new_totals(spark, sf_dir).withColumn("idempotency_key", key).withColumn("metadata", metadata)
    return st.save_outcomes(as_store(old), st.prepare_batch(new))


@query(
    "store_hash_keyed",
    f"""WITH o AS (SELECT DISTINCT n, top FROM ({OLD_SQL})), b AS (SELECT DISTINCT n, top FROM ({NEW_SQL}))
SELECT {HASH} AS id, n, top, CASE WHEN o.n IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{THEN}' END AS updated_at
FROM o FULL JOIN b USING (n, top)""",
)
def store_hash_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an id are kept once per content."""
    old = st.prepare_batch(old_totals(spark, sf_dir).select("n", "top"))
    new = new_totals(spark, sf_dir).select("n", "top")
    first = st.save(st.empty_store(old), old, now(THEN))
    first = first.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})
    saved = st.save(first, st.prepare_batch(new), now())
    return saved.select("id", "n", "top", "updated_at")


@query(
    "store_lookup",
    f"""SELECT id, n, top, {HASH} AS idempotency_key FROM ({OLD_SQL})
WHERE id IN (SELECT user_id || '/' || event_type FROM events WHERE value > 200)""",
)
def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "events").where("value > 200")
    ids = wanted.select(F.concat_ws("/", "user_id", "event_type").alias("id"))
    return st.lookup(old_store(spark, sf_dir), ids).select("id", "n", "top", "idempotency_key")


_DOOMED = "SELECT user_id || '/' || event_type FROM events WHERE value > 200"


def _doomed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "events").where("value > 200")
    return wanted.select(F.concat_ws("/", "user_id", "event_type").alias("id"))


@query("store_delete", f"SELECT id, n, top FROM ({OLD_SQL}) WHERE id NOT IN ({_DOOMED})")
def store_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.delete(old_store(spark, sf_dir), _doomed(spark, sf_dir)).select("id", "n", "top")


@query(
    "store_delete_conditional",
    f"SELECT id, n, top FROM ({OLD_SQL}) WHERE NOT (id IN ({_DOOMED}) AND n < 4)",
)
def store_delete_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = st.delete(old_store(spark, sf_dir), _doomed(spark, sf_dir), "n < 4")
    return kept.select("id", "n", "top")


@query(
    "store_delete_outcomes",
    f"""SELECT d.id, COALESCE(o.n < 4, false) AS deleted FROM (SELECT DISTINCT user_id || '/' || event_type AS id
  FROM events WHERE value > 200) d LEFT JOIN ({OLD_SQL}) o ON o.id = d.id""",
)
def store_delete_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.delete_outcomes(old_store(spark, sf_dir), _doomed(spark, sf_dir), "n < 4")


def _saved_twice(spark: SparkSession, sf_dir: str) -> st.AggregateStore:
    """The store table after both halves of the month; the second save meets buckets of the first."""
    store = st.AggregateStore(spark, scratch_database(spark), "totals", buckets=8)
    store.save(old_totals(spark, sf_dir))
    store.save(new_totals(spark, sf_dir))
    return store


_SAVED_TWICE = """SELECT id, CASE WHEN status = 'exists' THEN on_ ELSE bn END AS n,
       CASE WHEN status = 'exists' THEN otop ELSE btop END AS top,
       CASE WHEN status = 'exists' THEN ok ELSE bk END AS idempotency_key,
       CASE WHEN status = 'updated' THEN 2 ELSE 1 END::BIGINT AS version FROM j"""


@query("store_table_two_saves", BOTH + _SAVED_TWICE)
def store_table_two_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved_twice(spark, sf_dir).read().select("id", "n", "top", "idempotency_key", "version")


@query("store_table_delete", BOTH + f"{_SAVED_TWICE} WHERE id NOT IN ({_DOOMED})")
def store_table_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _saved_twice(spark, sf_dir)
    store.delete(_doomed(spark, sf_dir))
    return store.read().select("id", "n", "top", "idempotency_key", "version")


@query("store_table_lookup", BOTH + f"{_SAVED_TWICE} WHERE id IN ({_DOOMED})")
def store_table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _saved_twice(spark, sf_dir).get_all(_doomed(spark, sf_dir))
    return found.select("id", "n", "top", "idempotency_key", "version")


# One row per event: the last event type of a user, applied in event order to a store that knows the users with a
# signup in the first week.
KIND_HASH = """sha256('{"kind":"' || kind || '"}')"""
SEQUENCE = f"""
WITH o AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, 'signup' AS kind FROM events
           WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-08'),
b AS (SELECT CAST(user_id AS VARCHAR) AS id, event_id, event_type AS kind FROM events),
p AS (SELECT b.*, o.kind AS stored, COALESCE(lag(b.kind) OVER (PARTITION BY b.id ORDER BY event_id), o.kind) AS prior
      FROM b LEFT JOIN o ON b.id = o.id),
s AS (SELECT *, CASE WHEN prior IS NULL THEN 'created' WHEN prior = kind THEN 'exists' ELSE 'updated' END AS status
      FROM p),
v AS (SELECT *, (CASE WHEN stored IS NULL THEN 0 ELSE 1 END + sum(CASE WHEN status = 'exists' THEN 0 ELSE 1 END)
        OVER (PARTITION BY id ORDER BY event_id))::BIGINT AS version FROM s)
"""


def _sequence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    known = events.where("event_type = 'signup' AND ts < timestamp_ntz '2024-01-08'")
    store = known.select(F.col("user_id").alias("id"), F.lit("signup").alias("kind")).distinct()
    batch = events.select(F.col("user_id").alias("id"), F.col("event_type").alias("kind"), "event_id")
    return as_store(store), st.prepare_batch(batch, order_by=["event_id"])


@query(
    "store_batch_sequential",
    SEQUENCE + f"SELECT id, event_id, {KIND_HASH} AS idempotency_key, version, status FROM v",
)
def store_batch_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, batch = _sequence(spark, sf_dir)
    return st.outcomes_in_order(store, batch, ["event_id"])


@query(
    "store_sequential_snapshot",
    SEQUENCE
    + f"""SELECT id, arg_max(kind, event_id) AS kind, max(version) AS version,
       CASE WHEN any_value(stored) IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{THEN}' END AS created_at,
       CASE WHEN bool_or(status <> 'exists') THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{THEN}' END AS updated_at
FROM v GROUP BY id""",
)
def store_sequential_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, batch = _sequence(spark, sf_dir)
    saved = st.save_in_order(store, batch, ["event_id"], now())
    return saved.select("id", "kind", "version", "created_at", "updated_at")


# The events of every user in order, each with the version it claims: a third of all rows on one id. A claim is an
# event number, some lag far behind, some rows leave it to be counted. SQL folds each id's rows in a list.
_CLAIMS = """SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS id, event_type AS kind,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 < 2 THEN event_id // 50 ELSE event_id END AS version, event_id FROM events"""
EXPLICIT = f"""
WITH b AS ({_CLAIMS}),
l AS (SELECT id, list({{'k': kind, 'v': version, 'n': event_id, 's': '', 'a': 0::BIGINT}} ORDER BY event_id) AS rows FROM b GROUP BY id),
f AS (SELECT id, list_reduce(list_prepend([{{'k': NULL::VARCHAR, 'v': 0::BIGINT, 'n': 0::BIGINT, 's': '', 'a': 0::BIGINT}}],
        list_transform(rows, lambda r: [r])), lambda done, r: list_append(done, {{
          'k': CASE WHEN done[-1].k IS NULL OR (done[-1].k <> r[1].k AND (r[1].v IS NULL OR r[1].v > done[-1].a)) THEN r[1].k ELSE done[-1].k END,
          'v': r[1].v, 'n': r[1].n,
          's': CASE WHEN done[-1].k IS NULL THEN 'created' WHEN done[-1].k = r[1].k THEN 'exists'
                    WHEN r[1].v <= done[-1].a THEN 'conflict' ELSE 'updated' END,
          'a': CASE WHEN done[-1].k IS NULL OR (done[-1].k <> r[1].k AND (r[1].v IS NULL OR r[1].v > done[-1].a))
                    THEN COALESCE(r[1].v, done[-1].a + 1) ELSE done[-1].a END}})) AS done FROM l)
SELECT id, d.n AS event_id, d.s AS status, d.a AS version FROM (SELECT id, unnest(done[2:]) AS d FROM f)
"""


@query("store_batch_explicit_versions", EXPLICIT)
def store_batch_explicit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string")).alias("id"),
        F.col("event_type").alias("kind"),
        F.when(F.col("event_id") % 5 == 0, None)
        .when(F.col("event_id") % 7 < 2, F.floor(F.col("event_id") / 50))
        .otherwise(F.col("event_id"))
        .cast("bigint")
        .alias("version"),
        "event_id",
    )
    batch = st.prepare_batch(claims, order_by=["event_id"])
    found = st.outcomes_in_order(st.empty_store(batch, ["event_id"]), batch, ["event_id"], explicit=True)
    return found.select("id", "event_id", "status", "version")
