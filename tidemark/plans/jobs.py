"""User-level jobs: read, summarise, save the summary in a store, write rows out.

Each job returns a small frame, one row per saved summary. Summaries are saved as JSON text in the column
``payload``, so that one store holds summaries of all kinds.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.consolidate import PositionRule, consolidate, summarize
from tidemark.operators.profile import SUMMED_COLUMNS, profile
from tidemark.operators.sales import SalesColumns, analyse_periods, filter_period, rows_by_period
from tidemark.operators.store import AggregateStore
from tidemark.sources.spec import Source, union_all
from tidemark.sources.tables import row_count, scan_catalog, scan_files, scratch_path, write_files

_CARRIED = ("payload", "metadata")


def _metadata(**entries: str | Column) -> Column:
    pairs: list[Column] = []
    for key, value in entries.items():
        pairs += [F.lit(key), (value if isinstance(value, Column) else F.lit(value)).cast("string")]
    return F.create_map(*pairs)


def _record(df: DataFrame, record_id: Column, metadata: Column) -> DataFrame:
    """Store batch with all columns of ``df`` as payload."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(record_id.alias("id"), body.alias("payload"), metadata.alias("metadata"))


def _report(outcomes: DataFrame, output_path: Column, *extra: Column, payload: str = "aggregated_data") -> DataFrame:
    return outcomes.select(
        F.lit("success").alias("status"),
        *extra,
        F.col("metadata")["record_count"].cast("bigint").alias("record_count"),
        F.col("payload").alias(payload),
        F.col("id").alias("congregado_id"),
        F.col("version").alias("congregado_version"),
        F.col("status").alias("congregado_status"),
        output_path.cast("string").alias("output_path"),
        F.lit(None).cast("string").alias("error"),
    )


def _sales_report(outcomes: DataFrame, output_path: Column) -> DataFrame:
    period = F.col("metadata")["periodo"].alias("periodo")
    return _report(outcomes, output_path, period, payload="analise")


def _failure(spark: SparkSession, record_id: str, error: Exception) -> DataFrame:
    def missing(kind: str) -> Column:
        return F.lit(None).cast(kind)

    return spark.range(1).select(
        F.lit("error").alias("status"),
        missing("bigint").alias("record_count"),
        missing("string").alias("aggregated_data"),
        F.lit(record_id).alias("congregado_id"),
        missing("bigint").alias("congregado_version"),
        missing("string").alias("congregado_status"),
        missing("string").alias("output_path"),
        F.lit(str(error)).alias("error"),
    )


# --- table profile ------------------------------------------------------------------------------------------


def profile_record(
    database: str, table: str, df: DataFrame, limit: int | None = SUMMED_COLUMNS
) -> DataFrame:
    """The profile of one table as store record ``{database}_{table}``; a rerun with other splits gives the same."""
    measured = profile(df, limit)
    metadata = _metadata(database=database, table_name=table, record_count=F.col("total_rows"))
    return _record(measured, F.lit(f"{database}_{table}"), metadata)


def run_profile(
    spark: SparkSession,
    store: AggregateStore,
    database: str,
    table: str,
    output_path: str | None = None,
    now: Column | None = None,
    limit: int | None = SUMMED_COLUMNS,
) -> DataFrame:
    """Profile a catalog table, save the profile, and write the table's rows to ``output_path`` if given.

    The first ``limit`` numeric columns are summed, all of them with None.
    """
    df = scan_catalog(spark, database, table)
    outcomes = store.save(profile_record(database, table, df, limit), now=now, carry=_CARRIED)
    if output_path:
        write_files(df, output_path)
    return _report(outcomes, F.lit(output_path))


def run_profiles(
    spark: SparkSession,
    store: AggregateStore,
    tables: Sequence[tuple[str, str]],
    output_base_path: str | None = None,
    now: Column | None = None,
    limit: int | None = SUMMED_COLUMNS,
    width: int = 4,
) -> DataFrame:
    """:func:`run_profile` for many tables; a table that fails is reported and does not stop the others.

    Each table is measured once, its profile written to the scratch folder, and all profiles are saved in one go. At most
    ``width`` tables are measured at a time, so that small ones fill the cores that the last tasks of large ones leave; each is
    in a scheduler pool of its own, which get equal shares where ``spark.scheduler.mode`` is FAIR. A table that is named
    twice counts once; one whose record id a table before it has is reported as failed.
    """

    def measured(database: str, table: str, record_id: str) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"profile-{record_id}")  # of this thread
        df = scan_catalog(spark, database, table)
        path = scratch_path(spark, "profile")
        record = profile_record(database, table, df, limit)
        record.write.parquet(path)
        if output_base_path:
            write_files(df, f"{output_base_path}/{database}/{table}")
        return spark.read.schema(record.schema).parquet(path)

    reports: list[DataFrame] = []
    named: dict[str, tuple[str, str]] = {}
    for database, table in dict.fromkeys(tables):
        record_id = f"{database}_{table}"
        if record_id in named:
            reports.append(_failure(spark, record_id, ValueError(f"another table has the record '{record_id}'")))
        else:
            named[record_id] = (database, table)
    records: list[DataFrame] = []
    with ThreadPoolExecutor(max_workers=max(1, width)) as pool:
        # Every thread starts with this one's properties and tags, such as its job group.
        pending = {i: pool.submit(inheritable_thread_target(spark)(measured), *at, i) for i, at in named.items()}
        for record_id, result in pending.items():
            try:
                records.append(result.result())
            except Exception as error:  # whatever it is, it concerns this table only
                reports.append(_failure(spark, record_id, error))
    if records:
        outcomes = store.save(union_all(records), now=now, carry=_CARRIED)
        about = F.col("metadata")
        # NULL without a base path, as is every text joined with it.
        path = F.concat(F.lit(output_base_path), F.lit("/"), about["database"], F.lit("/"), about["table_name"])
        reports.append(_report(outcomes, path))
    return union_all(reports)


# --- sales analysis -----------------------------------------------------------------------------------------


def sales_records(
    database: str,
    table: str,
    df: DataFrame,
    periods: Sequence[str],
    columns: SalesColumns | None = None,
) -> DataFrame:
    """Sales analysis of every period as store records.

    ``vendas_{database}_{table}_{period}`` holds the totals. Categories, of which there may be any number, are
    records of their own with the category appended to that id.
    """
    columns = columns or SalesColumns.of(df)
    totals, categories = analyse_periods(df, periods, columns)
    base = F.concat(F.lit(f"vendas_{database}_{table}_"), F.col("periodo"))
    common = {
        "database": database,
        "table_name": table,
        "periodo": F.col("periodo"),
        "record_count": row_count(df).scalar(),
    }
    records = [_record(totals, base, _metadata(**common, tipo="analise_vendas"))]
    if categories is not None:
        named = categories.withColumnRenamed(columns.category, "categoria")
        suffix = F.to_json(F.struct("categoria"), {"ignoreNullFields": "false"})
        category_id = F.concat(base, suffix)
        records.append(
            _record(named, category_id, _metadata(**common, tipo="analise_vendas_categoria"))
        )
    return union_all(records)


def _category_ids(database: str, table: str, periods: Sequence[str]) -> list[str]:
    """What the ids of all categories of these analyses start with; those no longer found are removed with the save."""
    return [f'vendas_{database}_{table}_{period}{{"categoria":' for period in periods]


def run_sales(
    spark: SparkSession,
    store: AggregateStore,
    database: str,
    table: str,
    period: str,
    output_path: str | None = None,
    columns: SalesColumns | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Analyse one period of a sales table, save the analysis, and write the period's rows if a path is given."""
    df = scan_catalog(spark, database, table)
    columns = columns or SalesColumns.of(df)
    records = sales_records(database, table, df, [period], columns)
    outcomes = store.save(records, now=now, carry=_CARRIED, replacing=_category_ids(database, table, [period]))
    if output_path:
        write_files(filter_period(df, period, columns), output_path)
    return _sales_report(outcomes, F.lit(output_path))


def run_sales_periods(
    spark: SparkSession,
    store: AggregateStore,
    database: str,
    table: str,
    periods: Sequence[str],
    output_base_path: str | None = None,
    columns: SalesColumns | None = None,
    now: Column | None = None,
) -> DataFrame:
    """:func:`run_sales` for many periods in one pass; rows are written below ``periodo=<period>``."""
    df = scan_catalog(spark, database, table)
    columns = columns or SalesColumns.of(df)
    records = sales_records(database, table, df, periods, columns)
    outcomes = store.save(records, now=now, carry=_CARRIED, replacing=_category_ids(database, table, periods))
    path = F.lit(None)
    if output_base_path:
        write_files(rows_by_period(df, periods, columns), output_base_path, partition_columns=["periodo"])
        path = F.concat(F.lit(f"{output_base_path}/periodo="), F.col("metadata")["periodo"])
    return _sales_report(outcomes, path)


# --- consolidation ------------------------------------------------------------------------------------------


def consolidation_record(winners: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """The summary of a consolidation as store record ``consolidacao_{A}_vs_{B}``."""
    metadata = _metadata(
        origem_a=name_a, origem_b=name_b, record_count=F.col("total_vencedores"), tipo="consolidacao"
    )
    summary = summarize(winners, name_a, name_b)
    return _record(summary, F.lit(f"consolidacao_{name_a}_vs_{name_b}"), metadata)


def run_consolidation(
    spark: SparkSession,
    store: AggregateStore,
    origin_a: Source | None,
    origin_b: Source | None,
    rule: PositionRule = PositionRule(),
    name_a: str = "ONLINE",
    name_b: str = "BATCH",
    return_columns: Sequence[str] | None = None,
    output_path: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Consolidate two origins, save the summary, and write the winners if a path is given.

    The winners are computed once: with an output path they are written first and counted from there.
    """
    if origin_a is None or origin_b is None:
        raise ValueError("both origins are needed for a consolidation")
    winners = consolidate(spark, origin_a, origin_b, rule, name_a, name_b, return_columns)
    if output_path:
        write_files(winners, output_path)
        winners = scan_files(spark, output_path)
    outcomes = store.save(consolidation_record(winners, name_a, name_b), now=now, carry=_CARRIED)
    return _report(outcomes, F.lit(output_path))
