"""Rows with explicit versions, saved one after the other.

What a row does depends on the key and version before it: it may find its own content (``exists``, which does not raise
the version), be too old (``conflict``), or be written. So the rows of a key are a chain of transition functions, and one
key may hold a large part of all rows.

A key is cut into pieces of a bounded number of rows. Every piece is run, at first from a guess of what comes in: the last
content before it and the highest version so far. What comes out is either fixed, when the piece accepted an explicit
version, or relative to what came in. Fixed and relative results are chained by window functions over one row per piece, which
gives every piece what really comes in; pieces for which that differs are run again until none does. After n rounds at
least the first n pieces of each key are right, so it ends; since different histories of a key soon meet, two or three
rounds are usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.placed import PIECE, PLACE, RANGE, in_pieces
from tidemark.sources.tables import scratch_path

# The outcomes of a save.
EXISTS, CREATED, UPDATED, CONFLICT = "exists", "created", "updated", "conflict"

#: Rows of a key that are run as one array.
PIECE_ROWS = 1000

STATE = "struct<key:string,version:bigint>"


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _outcome(key: Column, version: Column, row: Column) -> Column:
    """What a row does to a record with this key (NULL: none) and version."""
    return (
        F.when(key.isNull(), CREATED)
        .when(key == row["idempotency_key"], EXISTS)
        .when(row["version"] <= version, CONFLICT)
        .otherwise(UPDATED)
    )


def _run(rows: Column, key: Column, version: Column) -> Column:
    """The state after all rows of a piece, and whether a version in it is fixed."""
    start = F.struct(key.alias("key"), F.coalesce(version, F.lit(0)).alias("version"), F.lit(False).alias("fixed"))

    def step(state: Column, row: Column) -> Column:
        writes = _outcome(state["key"], state["version"], row).isin(CREATED, UPDATED)
        return F.struct(
            F.when(writes, row["idempotency_key"]).otherwise(state["key"]).alias("key"),
            F.when(writes, F.coalesce(row["version"], state["version"] + 1)).otherwise(state["version"]).alias("version"),
            (state["fixed"] | (writes & row["version"].isNotNull())).alias("fixed"),
        )

    return F.aggregate(rows, start, step)


def _trace(rows: Column, key: Column, version: Column) -> Column:
    """Outcome and version of every row of a piece; arrays are short, so that copying them is cheap."""
    none = F.array().cast("array<struct<status:string,version:bigint>>")
    start = F.struct(key.alias("key"), F.coalesce(version, F.lit(0)).alias("version"), none.alias("done"))

    def step(state: Column, row: Column) -> Column:
        status = _outcome(state["key"], state["version"], row)
        writes = status.isin(CREATED, UPDATED)
        after = F.when(writes, F.coalesce(row["version"], state["version"] + 1)).otherwise(state["version"])
        done = F.struct(status.alias("status"), after.alias("version"))
        return F.struct(
            F.when(writes, row["idempotency_key"]).otherwise(state["key"]).alias("key"),
            after.alias("version"),
            F.array_append(state["done"], done).alias("done"),
        )

    return F.aggregate(rows, start, step, lambda s: s["done"])


def _guess(marks: DataFrame, old: DataFrame) -> DataFrame:
    """What may come into each piece: the stored record for the first one, else the content and versions before it."""
    before = Window.partitionBy("id").orderBy(RANGE, PIECE).rowsBetween(Window.unboundedPreceding, -1)
    highest = F.max("__highest").over(before)
    return marks.join(old, on="id", how="left").select(
        "id", RANGE, PIECE, "__counted", "__key", "__version",
        F.coalesce(F.last("__last").over(before), "__key").alias("__in_key"),
        F.greatest(highest, "__version", F.lit(0)).alias("__in_version"),
    )


def _chained(run: DataFrame) -> DataFrame:
    """Every piece with what the results of the pieces before it say comes in."""
    before = Window.partitionBy("id").orderBy(RANGE, PIECE).rowsBetween(Window.unboundedPreceding, -1)
    out = F.col("__out")
    # Without counted rows and without a fixed version the content that came in goes out.
    passes = ~out["fixed"] & ~F.col("__counted") & F.col("__in_key").isNotNull()
    step = F.when(out["fixed"], F.lit(0)).otherwise(out["version"] - F.col("__in_version"))
    upto = F.sum("__step").over(Window.partitionBy("id").orderBy(RANGE, PIECE))
    marked = run.withColumn("__step", step).withColumn("__upto", upto)
    fixed_at = F.when(out["fixed"], F.struct(out["version"].alias("version"), F.col("__upto").alias("upto")))
    last_fixed = F.last(fixed_at, ignorenulls=True).over(before)
    steps = F.coalesce(F.lag("__upto").over(Window.partitionBy("id").orderBy(RANGE, PIECE)), F.lit(0))
    return marked.select(
        *run.columns,
        F.coalesce(F.last(F.when(~passes, out["key"]), ignorenulls=True).over(before), "__key").alias("__next_key"),
        (
            F.coalesce(last_fixed["version"], "__version", F.lit(0)) + steps - F.coalesce(last_fixed["upto"], F.lit(0))
        ).alias("__next_version"),
    )


def outcomes(store: DataFrame, batch: DataFrame, order_by: Sequence[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``id, order columns, idempotency_key, version, status`` and ``row``, the whole row, of every row of a prepared batch.

    Rows are applied to the store in the order of ``order_by``, which must order the rows of a key fully. Each row may
    carry a version or leave it to be counted.
    """
    content = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    placed = in_pieces(batch, "id", order_by, piece_rows)
    rows = F.array_sort(F.collect_list(F.struct(F.col(PLACE).alias("at"), content.alias("row"))), lambda a, b: a["at"] - b["at"])
    pieces = _written(placed.groupBy("id", RANGE, PIECE).agg(rows.alias("__rows")), "pieces")
    given = F.transform("__rows", lambda r: r["row"])
    old = store.select("id", F.col("idempotency_key").alias("__key"), F.col("version").alias("__version"))
    last = F.element_at(given, -1)
    marks = pieces.select(
        "id", RANGE, PIECE,
        last["idempotency_key"].alias("__last"),
        F.array_max(F.transform(given, lambda r: r["version"])).alias("__highest"),
        F.exists(given, lambda r: r["version"].isNull()).alias("__counted"),
    )
    at = ["id", RANGE, PIECE]
    states, known, todo = _written(_guess(marks, old), "states"), None, None
    while True:
        todo = states if todo is None else todo
        run = pieces.join(todo, on=at).select(
            *states.columns, _run(given, F.col("__in_key"), F.col("__in_version")).alias("__out")
        )
        if known is not None:
            run = known.unionByName(run)
        chained = _written(_chained(run), "chained")
        right = F.col("__in_key").eqNullSafe(F.col("__next_key")) & (F.col("__in_version") == F.col("__next_version"))
        again = chained.where(~right)
        if again.isEmpty():
            break
        known = chained.where(right).select(*states.columns, "__out")
        todo = again.withColumns({"__in_key": F.col("__next_key"), "__in_version": F.col("__next_version")}).select(*states.columns)
    done = pieces.join(chained.select(*at, "__in_key", "__in_version"), on=at).select(
        F.inline(F.arrays_zip(given.alias("row"), _trace(given, F.col("__in_key"), F.col("__in_version")).alias("done")))
    )
    return done.select(
        "row.id",
        *[F.col("row")[c].alias(c) for c in order_by],
        "row.idempotency_key",
        F.col("done.version").alias("version"),
        F.col("done.status").alias("status"),
        "row",
    )


def last_written(outcomes_of_rows: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Per id the row that was written last, as ``new``, and its version, as ``__next``; ids without one are left out."""
    order = F.struct(*[F.col(c) for c in order_by])
    written = outcomes_of_rows.where(F.col("status").isin(CREATED, UPDATED))
    return written.groupBy("id").agg(F.max_by("row", order).alias("new"), F.max_by("version", order).alias("__next"))
