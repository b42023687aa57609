"""Versioned, idempotent store of aggregates as operations on a table.

A store row is ``id``, the payload columns, ``idempotency_key``, ``version``, ``created_at``, ``updated_at`` and
``metadata``. Every operation takes frames and returns a frame; :class:`AggregateStore` keeps the table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.chunks import CHUNK, order_chunk
from tidemark.functions.hashing import content_hash
from tidemark.operators import versions
from tidemark.operators.versions import CONFLICT, CREATED, EXISTS, UPDATED
from tidemark.sources.tables import scratch_path

# The columns of a store row around its payload.
CONTROL_COLUMNS = ("id", "idempotency_key", "version", "created_at", "updated_at", "metadata")

_NO_METADATA = "map<string,string>"
BUCKET = "__bucket"


def _bucket(buckets: int) -> Column:
    """The bucket of a row: the one that Spark's bucketed tables put its id into, so a bucket is one file."""
    return F.pmod(F.hash("id"), F.lit(buckets)).alias(BUCKET)


def payload_columns(df: DataFrame, besides: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in CONTROL_COLUMNS and c not in besides]


def prepare_batch(
    batch: DataFrame,
    id_column: str = "id",
    key_column: str = "idempotency_key",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Rows to save, with their keys filled in.

    ``idempotency_key`` is the caller's or the hash of the payload; ``id`` is the caller's or that key. Optional
    input columns: id, idempotency key, ``version`` and ``metadata``.
    """
    payload = payload_columns(batch, besides=(id_column, key_column, *order_by))

    def given(name: str, as_type: str) -> Column:
        column = F.col(f"`{name}`") if name in batch.columns else F.lit(None)
        return column.cast(as_type)

    # An empty text counts as no key.
    key = F.coalesce(F.nullif(given(key_column, "string"), F.lit("")), content_hash(batch, payload))
    no_metadata = F.create_map().cast(_NO_METADATA)
    return batch.select(
        F.coalesce(F.nullif(given(id_column, "string"), F.lit("")), key).alias("id"),
        *[F.col(f"`{c}`") for c in payload],
        key.alias("idempotency_key"),
        given("version", "bigint").alias("version"),
        F.coalesce(given("metadata", _NO_METADATA), no_metadata).alias("metadata"),
        *[F.col(f"`{c}`") for c in order_by],
    )


def empty_store(batch: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """A store without rows for the payload of a prepared batch."""
    types = {
        "created_at": "timestamp",
        "updated_at": "timestamp",
        **{f.name: f.dataType for f in batch.schema.fields if f.name not in order_by},
    }
    names = ["id", *payload_columns(batch, besides=order_by), *CONTROL_COLUMNS[1:]]
    return batch.sparkSession.range(0).select(*[F.lit(None).cast(types[n]).alias(n) for n in names])


def widened(store: DataFrame, batch: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """The store with the payload columns that are new in the batch, NULL so far."""
    new = [n for n in payload_columns(batch, besides=order_by) if n not in store.columns]
    if not new:
        return store
    added = [F.lit(None).cast(batch.schema[n].dataType).alias(n) for n in new]
    control = [c for c in store.columns if c in CONTROL_COLUMNS[1:]]
    rest = [c for c in store.columns if c not in control]
    return store.select(*[f"`{c}`" for c in rest], *added, *control)


# --- one row per key -------------------------------------------------------------------------------------


def _one_per_key(batch: DataFrame) -> DataFrame:
    """The batch as ``id, new struct``. Equal rows of a key are one; it fails while running when they differ.

    The aggregation leaves the batch partitioned by key, so the join with the store adds no further shuffle,
    and repeated keys collapse before the shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    # The idempotency key stands for the content; a given version must agree as well.
    content = F.struct("idempotency_key", *(["version"] if "version" in batch.columns else []))
    once = batch.groupBy("id").agg(
        F.any_value(row).alias("new"), F.min(content).alias("__least"), F.max(content).alias("__most")
    )
    repeated = F.raise_error(
        F.concat(F.lit("key occurs more than once in the batch with different content, give order_by: "), F.col("id"))
    )
    return once.select("id", F.when(F.col("__least").eqNullSafe(F.col("__most")), F.col("new")).otherwise(repeated).alias("new"))


def _status(old_key: Column, old_version: Column, new: Column) -> Column:
    stored = F.coalesce(old_version, F.lit(0))
    return (
        F.when(old_key.isNull(), CREATED)
        .when(old_key == new["idempotency_key"], EXISTS)
        .when(new["version"] <= stored, CONFLICT)
        .otherwise(UPDATED)
    )


def _next_version(status: Column, old_version: Column, new: Column) -> Column:
    stored = F.coalesce(old_version, F.lit(0))
    return F.when(status.isin(CREATED, UPDATED), F.coalesce(new["version"], stored + 1)).otherwise(stored)


def save_outcomes(
    store: DataFrame,
    batch: DataFrame,
    strict: bool = False,
    carry: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """``id, idempotency_key, version, status`` of every row of a prepared batch with one row per key.

    A version that is not above the stored one gives ``conflict``, or fails the job when ``strict``. ``carry``
    names batch columns to hand through.
    """
    old = store.select(
        "id", F.col("idempotency_key").alias("__key"), F.col("version").alias("__version")
    )
    joined = _by_bucket(_one_per_key(batch), buckets).join(old, on="id", how="left")
    status = _status(F.col("__key"), F.col("__version"), F.col("new"))
    if strict:
        message = F.concat(F.lit("version is not above the stored version: "), F.col("id"))
        status = F.when(status == CONFLICT, F.raise_error(message)).otherwise(status)
    return joined.withColumn("status", status).select(
        "id",
        F.col("new.idempotency_key").alias("idempotency_key"),
        _next_version(F.col("status"), F.col("__version"), F.col("new")).alias("version"),
        "status",
        *[F.col("new")[c].alias(c) for c in carry],
    )


def save(
    store: DataFrame, batch: DataFrame, now: Column | None = None, buckets: int | None = None
) -> DataFrame:
    """The store after saving a prepared batch with one row per key.

    Give the number of ``buckets`` of a store bucketed by ``id``: then only the batch is shuffled, and the result
    lies by bucket again.
    """
    now = F.current_timestamp() if now is None else now
    store = widened(store, batch)
    joined = _old_and_new(store, _one_per_key(batch), buckets)
    o, n = F.col("old"), F.col("new")
    status = F.when(n.isNull(), EXISTS).otherwise(_status(o["idempotency_key"], o["version"], n))
    joined = joined.withColumn("__write", status.isin(CREATED, UPDATED)).withColumn(
        "__next", _next_version(status, o["version"], n)
    )
    return _rows_after(store, joined, now)


def _by_bucket(new: DataFrame, buckets: int | None) -> DataFrame:
    """Rows partitioned like the bucketed store, so that a join moves them and not the store.

    Left to itself Spark shuffles both sides when the store has fewer buckets than there are shuffle partitions.
    """
    return new.repartition(buckets, "id") if buckets else new


def _old_and_new(store: DataFrame, new: DataFrame, buckets: int | None) -> DataFrame:
    """Every stored row as ``old`` with the new columns of its id, and every new id without a stored row.

    One full outer join, which reads the store once; ids are unique on both sides, so there is no skew to split. The
    plan no longer says so, but rows stay in the task of their bucket.
    """
    old = F.struct(*[F.col(f"`{c}`") for c in store.columns])
    return store.select("id", old.alias("old")).join(_by_bucket(new, buckets), on="id", how="full")


def _rows_after(store: DataFrame, joined: DataFrame, now: Column) -> DataFrame:
    """Store rows from ``id, old, new, __write, __next``; the first ``created_at`` is kept."""
    write, new_fields = F.col("__write"), set(joined.schema["new"].dataType.names)
    special = {
        "id": F.col("id"),
        "version": F.when(write, F.col("__next")).otherwise(F.col("old.version")),
        "created_at": F.when(F.col("old").isNull(), now).otherwise(F.col("old.created_at")),
        "updated_at": F.when(write, now).otherwise(F.col("old.updated_at")),
    }

    def after(name: str) -> Column:
        if name in special:
            return special[name]
        replacement = F.col("new")[name] if name in new_fields else F.lit(None)
        return F.when(write, replacement).otherwise(F.col("old")[name])

    return joined.select(*[after(f.name).cast(f.dataType).alias(f.name) for f in store.schema.fields])


# --- several rows per key, applied in order ---------------------------------------------------------------


def _without_versions(batch: DataFrame) -> DataFrame:
    """Rows that count versions up; a given version fails the job."""
    given = F.raise_error(F.concat(F.lit("explicit versions in order need explicit=True: "), F.col("id")))
    return batch.withColumn(
        "idempotency_key", F.when(F.col("version").isNull(), F.col("idempotency_key")).otherwise(given)
    )


def _neighbours(
    batch: DataFrame, order_by: Sequence[str], chunk_width: int | None
) -> DataFrame:
    """Rows with their chunk, the key of the row before in the same chunk, and whether it differs."""
    cut = _without_versions(batch).withColumn(CHUNK, order_chunk(batch, order_by[0], chunk_width))
    place = Window.partitionBy("id", CHUNK).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    before = F.lag("idempotency_key").over(place)
    changed = F.coalesce(F.col("__before") != F.col("idempotency_key"), F.lit(False)).cast("bigint")
    return (
        cut.withColumn("__before", before)
        .withColumn("__changed", changed)
        .withColumn(
            "__run",
            F.sum("__changed").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
    )


def _chunk_marks(rows: DataFrame, order_by: Sequence[str], row: Column | None) -> DataFrame:
    """One row per (id, chunk): first and last key, number of changes inside, and if wanted the rows to keep."""
    order = F.struct(*[F.col(c) for c in order_by])
    is_first, is_change = F.col("__before").isNull(), F.col("__changed") == 1
    marks = [
        F.max(F.when(is_first, F.col("idempotency_key"))).alias("__first_key"),
        F.max_by("idempotency_key", order).alias("__last_key"),
        F.sum("__changed").alias("__inside"),
    ]
    if row is not None:
        marks += [
            F.max_by(row, F.when(is_first, F.lit(1))).alias("__first_row"),
            F.max_by(row, F.when(is_change, order)).alias("__change_row"),
        ]
    by_chunk = Window.partitionBy("id").orderBy(CHUNK)
    return (
        rows.groupBy("id", CHUNK)
        .agg(*marks)
        .withColumn("__last_before", F.lag("__last_key").over(by_chunk))
        .withColumn(
            "__edge",
            F.coalesce(F.col("__last_before") != F.col("__first_key"), F.lit(False)).cast("bigint"),
        )
    )


def save_in_order(
    store: DataFrame,
    batch: DataFrame,
    order_by: Sequence[str],
    now: Column | None = None,
    chunk_width: int | None = None,
    buckets: int | None = None,
    explicit: bool = False,
) -> DataFrame:
    """The store after saving the rows of a prepared batch one after the other.

    A row equal to the one before it in its key changes nothing; every other row raises the version by one.
    ``order_by`` must order the rows of a key fully. Large keys are worked on in chunks along the order.
    With ``explicit`` rows may carry versions; :mod:`tidemark.operators.versions` applies them.
    """
    now = F.current_timestamp() if now is None else now
    store = widened(store, batch, order_by)
    if explicit:
        return rows_after_versions(store, versions.outcomes(store, batch, order_by), batch, order_by, now, buckets)
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns if c not in order_by])
    marks = _chunk_marks(_neighbours(batch, order_by, chunk_width), order_by, row)
    by_chunk = F.col(CHUNK)
    at_edge = F.when(F.col("__edge") == 1, F.col("__first_row"))
    last_change = F.coalesce(F.col("__change_row"), at_edge)
    reduced = marks.groupBy("id").agg(
        F.min_by("__first_row", by_chunk).alias("__first_row"),
        F.max_by(last_change, F.when(last_change.isNotNull(), by_chunk)).alias("__change_row"),
        F.sum(F.col("__inside") + F.col("__edge")).alias("__changes"),
    )
    joined = _old_and_new(store, reduced, buckets)
    first_differs = F.col("old").isNull() | (
        F.col("old.idempotency_key") != F.col("__first_row.idempotency_key")
    )
    starts = F.coalesce(F.col("__first_row").isNotNull() & first_differs, F.lit(False))
    changes = starts.cast("bigint") + F.coalesce(F.col("__changes"), F.lit(0))
    return _rows_after(
        store,
        joined.select(
            "id",
            "old",
            F.coalesce(F.col("__change_row"), F.col("__first_row")).alias("new"),
            (changes > 0).alias("__write"),
            (F.coalesce(F.col("old.version"), F.lit(0)) + changes).alias("__next"),
        ),
        now,
    )


def rows_after_versions(
    store: DataFrame,
    outcomes: DataFrame,
    batch: DataFrame,
    order_by: Sequence[str],
    now: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """The store after the rows of a batch with the given outcomes, which carry their whole ``row``."""
    store = widened(store, batch, order_by)
    done = versions.last_written(outcomes, order_by)
    joined = _old_and_new(store, done, buckets).withColumn("__write", F.col("new").isNotNull())
    return _rows_after(store, joined, F.current_timestamp() if now is None else now)


def outcomes_in_order(
    store: DataFrame,
    batch: DataFrame,
    order_by: Sequence[str],
    chunk_width: int | None = None,
    explicit: bool = False,
) -> DataFrame:
    """``id, order columns, idempotency_key, version, status`` of every row of :func:`save_in_order`."""
    if explicit:
        return versions.outcomes(store, batch, order_by).drop("row")
    rows = _neighbours(batch, order_by, chunk_width)
    so_far = Window.partitionBy("id").orderBy(CHUNK)
    old = store.select("id", F.col("idempotency_key").alias("__key"), F.col("version").alias("__version"))
    earlier = F.sum(F.col("__inside") + F.col("__edge")).over(
        so_far.rowsBetween(Window.unboundedPreceding, -1)
    )
    marks = (
        _chunk_marks(rows, order_by, None)
        .withColumn("__offset", F.coalesce(earlier, F.lit(0)) + F.col("__edge"))
        .withColumn("__very_first", F.first("__first_key").over(so_far))
        .join(old, on="id", how="left")
        .withColumn(
            "__start",
            F.coalesce(F.col("__version"), F.lit(0))
            + F.coalesce(F.col("__key") != F.col("__very_first"), F.lit(True)).cast("bigint")
            + F.col("__offset"),
        )
        .select("id", CHUNK, "__last_before", "__key", "__start")
    )
    prior = F.coalesce(F.col("__before"), F.col("__last_before"), F.col("__key"))
    status = (
        F.when(prior.isNull(), CREATED)
        .when(prior == F.col("idempotency_key"), EXISTS)
        .otherwise(UPDATED)
    )
    return rows.join(marks, on=["id", CHUNK], how="inner").select(
        "id",
        *order_by,
        "idempotency_key",
        (F.col("__start") + F.col("__run")).alias("version"),
        status.alias("status"),
    )


def batch_stats(outcomes: DataFrame) -> DataFrame:
    """``saved``, ``total`` and ``failed`` of a batch, one row."""
    conflict = F.count_if(F.col("status") == CONFLICT)
    return outcomes.agg(
        (F.count("*") - conflict).alias("saved"),
        F.count("*").alias("total"),
        conflict.alias("failed"),
    )


# --- reading and deleting ----------------------------------------------------------------------------------


def lookup(store: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Stored rows of the given ids: a list is pushed to the scan, a frame with column ``id`` is semi-joined."""
    if isinstance(ids, DataFrame):
        return store.join(ids.select("id"), on="id", how="left_semi")
    return store.where(F.col("id").isin(list(ids)))


def delete(
    store: DataFrame, ids: DataFrame, condition: str | None = None, buckets: int | None = None
) -> DataFrame:
    """The store without the rows whose id is in ``ids`` and, if given, for which ``condition`` holds."""
    doomed = _by_bucket(ids.select("id").distinct(), buckets).withColumnRenamed("id", "__doomed")
    match = F.col("id") == F.col("__doomed")
    if condition:
        match = match & F.expr(condition)
    return store.join(doomed, on=match, how="left_anti")


def delete_outcomes(store: DataFrame, ids: DataFrame, condition: str | None = None) -> DataFrame:
    """``id, deleted`` for every requested id: whether it was there and, if given, met ``condition``."""
    met = F.expr(condition) if condition else F.lit(True)
    hits = store.select("id", F.coalesce(met, F.lit(False)).alias("__hit"))
    return (
        ids.select("id")
        .distinct()
        .join(hits, on="id", how="left")
        .select("id", F.coalesce(F.col("__hit"), F.lit(False)).alias("deleted"))
    )


class AggregateStore:
    """A store kept in one catalog table, partitioned by a bucket of the id and bucketed and sorted by the id.

    A save or delete reads and writes only the buckets that it touches. Their new content is first written as a table of
    its own, ``<name>__next_<random>``, which Spark's catalog lists once it is complete, and then put in place of the
    old by dynamic partition overwrite, which can be repeated. So the listed table is the intent: a save that dies
    before it is listed changed nothing, and one that dies later is finished when the store is next opened or written to.

    One writer at a time. Frames read before a save must be read again after it. The number of ``buckets`` is fixed by
    the first save; by default it is the number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, buckets: int | None = None):
        # The catalog keeps names in lower case.
        self.spark, self.database, self.name = spark, database, name.lower()
        self._first_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.recover()

    def _table(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def _rows(self) -> DataFrame | None:
        """The table as it is, with its bucket column, or None before the first save."""
        table = self._table(self.name)
        return self.spark.table(table) if self.spark.catalog.tableExists(table) else None

    @property
    def buckets(self) -> int:
        """Buckets of the store, or of the first save to come."""
        if self._rows() is None:
            return self._first_buckets
        described = self.spark.sql(f"DESCRIBE FORMATTED {self._table(self.name)}")
        return int(described.where("col_name = 'Num Buckets'").first()["data_type"])

    def read(self) -> DataFrame | None:
        """Current content, or None before the first save."""
        rows = self._rows()
        return None if rows is None else self._content(rows)

    def _content(self, rows: DataFrame) -> DataFrame:
        """Columns in their usual order; without the marks of buckets that a delete has emptied."""
        payload = payload_columns(rows, besides=[BUCKET])
        return rows.where(F.col("id").isNotNull()).select("id", *[f"`{c}`" for c in payload], *CONTROL_COLUMNS[1:])

    def _buckets_of(self, ids: DataFrame, buckets: int) -> list[int]:
        """Buckets of the ids: at most all of the store's."""
        return sorted(r[0] for r in ids.select(_bucket(buckets)).distinct().collect())

    def _part(self, touched: Sequence[int]) -> DataFrame:
        """Stored rows of some buckets; the others are not read."""
        return self._content(self._rows().where(F.col(BUCKET).isin(list(touched))))

    # --- writing ------------------------------------------------------------------------------------------

    def _write(self, content: DataFrame, name: str, buckets: int) -> None:
        """``content`` as a table like the store's.

        Its rows are not gathered again: they come from the bucketed table or were partitioned by bucket for the join.
        """
        writer = content.withColumn(BUCKET, _bucket(buckets)).write.format("parquet")
        writer.partitionBy(BUCKET).bucketBy(buckets, "id").sortBy("id").saveAsTable(self._table(name))

    def _publish(self, content: DataFrame, buckets: int, emptied: Sequence[int] = ()) -> None:
        """Write the new rows of the touched buckets and put them in place.

        Overwriting leaves partitions without new rows alone, so a bucket that may become empty gets a row without id.
        """
        if self._rows() is None:
            self._write(content.where(F.lit(False)), self.name, buckets)
        upcoming = f"{self.name}__next_{uuid.uuid4().hex[:12]}"
        if emptied:
            # Bucket numbers as they are, since these rows have no id to compute them from.
            marks = self.spark.createDataFrame([(b,) for b in emptied], f"`{BUCKET}` int")
            rows = content.withColumn(BUCKET, _bucket(buckets)).unionByName(marks, allowMissingColumns=True)
            rows.write.format("parquet").partitionBy(BUCKET).bucketBy(buckets, "id").sortBy("id").saveAsTable(
                self._table(upcoming)
            )
        else:
            self._write(content, upcoming, buckets)
        self._put_in_place(upcoming)

    def _put_in_place(self, upcoming: str) -> None:
        """Overwrite the buckets of a complete table of new content; as often as needed."""
        fresh, table = self.spark.table(self._table(upcoming)), self._table(self.name)
        known = self._rows().columns
        new = [f for f in fresh.schema.fields if f.name not in known]
        if new:
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
        # A session of its own: how partitions are overwritten is a setting, and the caller's stays as it is.
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        columns = [f"`{c}`" for c in session.table(table).columns]
        session.table(self._table(upcoming)).select(*columns).write.mode("overwrite").insertInto(table)
        self.spark.catalog.refreshTable(table)
        self.spark.sql(f"DROP TABLE {self._table(upcoming)}")

    def recover(self) -> None:
        """Finish a save that died after its new content was complete."""
        if not self.spark.catalog.databaseExists(self.database):
            return
        found = self.spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{self.name}__next_*'").collect()
        for row in found:
            if re.fullmatch(rf"{re.escape(self.name)}__next_[0-9a-f]{{12}}", row["tableName"]):
                self._put_in_place(row["tableName"])

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{label}")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def save(
        self,
        batch: DataFrame,
        order_by: Sequence[str] = (),
        now: Column | None = None,
        carry: Sequence[str] = (),
        replacing: Sequence[str] = (),
    ) -> DataFrame:
        """Save ``batch`` and return its outcomes (with the ``carry`` columns when there is no ``order_by``).

        The prepared batch is written out first, so that a costly aggregation behind it runs once, and outcomes
        and content are computed from the same rows. Stored rows whose id starts with a text of ``replacing`` and is not
        in the batch are removed in the same publication.
        """
        if order_by and carry:
            raise ValueError("outcomes in order carry no other columns")
        self.recover()
        prepared = self._written(prepare_batch(batch, order_by=order_by), "batch")
        buckets, stale, gone = self.buckets, None, []
        if replacing and self._rows() is not None:
            left = self.find(*replacing).select("id").join(prepared.select("id"), on="id", how="left_anti")
            stale = self._written(left, "stale")
            gone = self._buckets_of(stale, buckets)
        touched = sorted({*self._buckets_of(prepared, buckets), *gone})
        store = empty_store(prepared, order_by) if self._rows() is None else self._part(touched)
        if stale is not None:
            store = delete(store, stale, buckets=buckets)
        if order_by:
            explicit = not prepared.where(F.col("version").isNotNull()).isEmpty()
            if explicit:
                done = self._written(versions.outcomes(store, prepared, order_by), "outcomes")
                outcomes = done.drop("row")
                content = rows_after_versions(store, done, prepared, order_by, now, buckets)
            else:
                outcomes = self._written(outcomes_in_order(store, prepared, order_by), "outcomes")
                content = save_in_order(store, prepared, order_by, now, buckets=buckets)
        else:
            outcomes = self._written(save_outcomes(store, prepared, carry=carry, buckets=buckets), "outcomes")
            content = save(store, prepared, now, buckets)
        if touched or self._rows() is None:
            self._publish(content, buckets, emptied=gone)
        return outcomes

    def delete(self, ids: DataFrame, condition: str | None = None) -> DataFrame:
        """Delete rows and return which of the requested ids were removed."""
        self.recover()
        if self._rows() is None:
            return ids.select("id").distinct().withColumn("deleted", F.lit(False))
        ids, buckets = self._written(ids.select("id").distinct(), "doomed"), self.buckets
        touched = self._buckets_of(ids, buckets)
        store = self._part(touched)
        outcomes = self._written(delete_outcomes(store, ids, condition), "deleted")
        if touched:
            self._publish(delete(store, ids, condition, buckets), buckets, emptied=touched)
        return outcomes

    # --- lookups ------------------------------------------------------------------------------------------

    def get(self, *ids: str) -> DataFrame | None:
        """Stored rows of the ids: only their buckets are read, and in these what the order by id leaves."""
        if self._rows() is None:
            return None
        asked = self.spark.createDataFrame([(i,) for i in ids], "id string")
        return lookup(self._part(self._buckets_of(asked, self.buckets)), ids)

    def get_all(self, ids: DataFrame) -> DataFrame | None:
        """Stored rows of a frame of ids (column ``id``): only their buckets are read."""
        if self._rows() is None:
            return None
        return lookup(self._part(self._buckets_of(ids, self.buckets)), ids)

    def find(self, *starts: str) -> DataFrame | None:
        """Stored rows whose id starts with one of the texts; files are sorted by id, so little of each is read."""
        current = self.read()
        if current is None:
            return None
        wanted = F.lit(False)
        for start in starts:
            wanted = wanted | F.col("id").startswith(start)
        return current.where(wanted)
