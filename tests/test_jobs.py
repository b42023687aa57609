from __future__ import annotations

import json
import threading

import pytest
from pyspark.sql import functions as F

from checks import jobs as job_queries
from checks.registry import scratch_database
from tidemark.operators.consolidate import PositionRule
from tidemark.operators.store import AggregateStore
from tidemark.plans import jobs
from tidemark.sources import scan_files, scratch_path, write_table


@pytest.fixture(scope="module")
def database(spark):
    name = scratch_database(spark)
    probes = spark.createDataFrame(
        [("k-7", -12, 400), ("k-8", None, -150), (None, 3, 9_000_000_000)], "station string, depth bigint, flow bigint"
    )
    write_table(probes, name, "probes")
    sales = spark.createDataFrame(
        [("2024-01-05", 10.0, "a"), ("2024-01-06", 5.0, None), ("2024-02-01", 7.0, "a")],
        "data string, valor double, categoria string",
    )
    write_table(sales, name, "vendas")
    return name


@pytest.fixture
def store(spark, database, request):
    return AggregateStore(spark, database, f"store_{abs(hash(request.node.name))}", buckets=2)


def test_profile_job_is_idempotent(spark, database, store):
    path = scratch_path(spark, "probes")
    row = jobs.run_profile(spark, store, database, "probes", path).first()
    assert (row["status"], row["record_count"], row["congregado_status"]) == ("success", 3, "created")
    assert json.loads(row["aggregated_data"]) == {
        "total_rows": 3,
        "numeric_columns": ["depth", "flow"],
        "sum_depth": -9,
        "sum_flow": 9_000_000_250,
    }
    assert scan_files(spark, path).count() == 3
    again = jobs.run_profile(spark, store, database, "probes").first()
    assert (again["congregado_status"], again["congregado_version"]) == ("exists", 1)


def test_failing_table_does_not_stop_the_others(spark, database, store):
    broken = scratch_path(spark, "broken")
    spark.range(1).write.parquet(broken)
    spark.sql(f"CREATE TABLE {database}.broken (id bigint) USING parquet LOCATION '{broken}'")
    spark.createDataFrame([("x",)], "id string").write.mode("overwrite").parquet(broken)
    spark.sql(f"REFRESH TABLE {database}.broken")
    tables = [(database, "probes"), (database, "absent"), (database, "broken"), (database, "vendas")]
    rows = {r["congregado_id"]: r for r in jobs.run_profiles(spark, store, tables).collect()}
    status = {k.replace(f"{database}_", ""): r["status"] for k, r in rows.items()}
    assert status == {"probes": "success", "absent": "error", "broken": "error", "vendas": "success"}
    assert all(r["error"] for r in rows.values() if r["status"] == "error")
    assert store.read().count() == 2


def test_each_profile_is_measured_once_with_one_broken_table(spark, database, store, monkeypatch):
    measured = []

    def counted(database, table, df, limit=3):
        measured.append(table)
        return profile_record(database, table, df, limit)

    profile_record = jobs.profile_record
    monkeypatch.setattr(jobs, "profile_record", counted)
    tables = [(database, "probes"), (database, "absent"), (database, "vendas"), (database, "probes")]
    base = scratch_path(spark, "profiles")
    rows = jobs.run_profiles(spark, store, tables, base).collect()
    assert measured == ["probes", "vendas"]
    assert {r["congregado_id"].removeprefix(f"{database}_"): r["output_path"] for r in rows} == {
        "probes": f"{base}/{database}/probes", "vendas": f"{base}/{database}/vendas", "absent": None,
    }


def test_sales_job(spark, database, store):
    path = scratch_path(spark, "sales")
    rows = {r["congregado_id"]: r for r in jobs.run_sales(spark, store, database, "vendas", "2024-01", path).collect()}
    base = f"vendas_{database}_vendas_2024-01"
    assert set(rows) == {base, base + '{"categoria":"a"}', base + '{"categoria":null}'}
    assert json.loads(rows[base]["analise"]) == {
        "periodo": "2024-01",
        "total_registros": 2,
        "total_vendas": 15.0,
        "media_vendas": 7.5,
    }
    assert (rows[base]["record_count"], rows[base]["periodo"]) == (3, "2024-01")
    assert scan_files(spark, path).count() == 2


def test_sales_job_for_many_periods(spark, database, store):
    path = scratch_path(spark, "periods")
    report = jobs.run_sales_periods(spark, store, database, "vendas", ["2024-01", "2024", "2030"], path)
    totals = {
        r["periodo"]: r["total_registros"]
        for r in (json.loads(x["analise"]) for x in report.collect())
        if "total_registros" in r
    }
    assert totals == {"2024-01": 2, "2024": 3, "2030": 0}
    written = scan_files(spark, path, options={}).groupBy(F.col("periodo").cast("string").alias("p")).count()
    assert {r["p"]: r["count"] for r in written.collect()} == {"2024-01": 2, "2024": 3}
    assert {r["output_path"] for r in report.collect()} >= {f"{path}/periodo=2024"}


def test_consolidation_job(spark, store):
    rule = PositionRule(tie_breakers=("cod_idef_vers_oper",))
    side = spark.createDataFrame(
        [(1, 1, "2024-01-01", "1", "2024-01-01"), (2, 1, "2024-01-01", "1", "2024-01-01")],
        "num_oper bigint, cod_idef_vers_oper bigint, dat_vlr_even_oper string, num_prio_even_oper string, "
        "dat_recm_even_oper string",
    )
    path = scratch_path(spark, "winners")
    row = jobs.run_consolidation(spark, store, side, [side.where("num_oper = 2")], rule, output_path=path).first()
    assert row["congregado_id"] == "consolidacao_ONLINE_vs_BATCH"
    assert json.loads(row["aggregated_data"])["total_vencedores"] == 2
    assert scan_files(spark, path).count() == 2
    with pytest.raises(ValueError, match="both origins"):
        jobs.run_consolidation(spark, store, side, None)


def test_categories_that_went_away_are_removed(spark):
    database = scratch_database(spark)
    store = AggregateStore(spark, database, "rerun", buckets=2)
    rows = [("2024-01-05", 10, "a"), ("2024-01-06", 5, "b"), ("2024-02-01", 1, "b")]
    for kept in (rows, rows[:1] + rows[2:]):
        write_table(spark.createDataFrame(kept, "data string, valor int, categoria string"), database, "v")
        jobs.run_sales_periods(spark, store, database, "v", ["2024-01", "2024-02"]).collect()
    ids = [r["id"] for r in store.read().where("metadata.tipo = 'analise_vendas_categoria'").orderBy("id").collect()]
    assert ids == [f'vendas_{database}_v_2024-01{{"categoria":"a"}}', f'vendas_{database}_v_2024-02{{"categoria":"b"}}']


def test_profile_of_doubles_is_idempotent(spark):
    database = scratch_database(spark)
    store = AggregateStore(spark, database, "doubles", buckets=2)
    customer = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    for parts in (1, 3, 7):
        write_table(customer.repartition(parts), database, "customer")
        row = jobs.run_profile(spark, store, database, "customer").first()
    assert (row["congregado_status"], row["congregado_version"]) == ("exists", 1)


def test_tables_are_measured_at_the_same_time(spark, database, store, monkeypatch):
    """Both threads have to be in a scan before either goes on; one that fails leaves the others alone."""
    met, scan = threading.Barrier(2, timeout=60), jobs.scan_catalog

    def slow(spark, database, table):
        met.wait()
        return scan(spark, database, table)

    monkeypatch.setattr(jobs, "scan_catalog", slow)
    tables = [(database, t) for t in ("probes", "vendas", "absent", "probes", "nowhere")]
    rows = {r["congregado_id"]: r["status"] for r in jobs.run_profiles(spark, store, tables, width=2).collect()}
    assert rows == {f"{database}_{t}": s for t, s in (("probes", "success"), ("vendas", "success"), ("absent", "error"), ("nowhere", "error"))}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_two_tables_with_one_record_id(spark, store):
    rows = jobs.run_profiles(spark, store, [("no_such", "base_x"), ("no_such_base", "x")]).collect()
    assert sorted(r["error"].startswith("another table") for r in rows) == [False, True]


@pytest.mark.parametrize("name,job,view", [("job_profile_rerun", "run_profile", "dealt"), ("job_sales_rerun", "run_sales_periods", "sales")])
def test_reruns_never_deal_a_table_into_one_task(spark, monkeypatch, name, job, view):
    largest, run = [], getattr(jobs, job)

    def watched(spark, store, database, *args, **options):
        parts = spark.table(f"{database}.{view}").groupBy(F.spark_partition_id().alias("part")).count()
        sizes = [r["count"] for r in parts.collect()]
        largest.append(max(sizes) / sum(sizes))
        return run(spark, store, database, *args, **options)

    monkeypatch.setattr(jobs, job, watched)
    monkeypatch.setattr(job_queries.jobs, job, watched)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        getattr(job_queries, name)(spark, "/root/testdata/sf0.001").collect()
    finally:
        for key in small:
            spark.conf.unset(key)
    assert len(largest) == 3 and max(largest) < 0.5
