from __future__ import annotations

import threading

import pytest
from pyspark.sql import types as T

from tidemark.operators.conform import conform, conform_and_write, lost_values, schema_drift, widened
from tidemark.sources import (
    JoinSpec,
    SourceSpec,
    build_source,
    materialize,
    scan_catalog,
    scan_files,
    scratch_path,
    target_fields,
    union_all,
    write_files,
    write_table,
)
from checks.registry import scratch_database


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "oper": spark.createDataFrame([(1, 10, "open"), (2, 20, "shut")], "num bigint, ver bigint, status string"),
        "pos": spark.createDataFrame([(1, 5.0, "ok"), (3, 7.0, "bad")], "num bigint, amount double, status string"),
        "evt": spark.createDataFrame([(10, "e1"), (20, "e2")], "version bigint, event string"),
    }


def test_chain_with_renamed_key_and_collision(spark, tables):
    spec = SourceSpec(
        tables=tables,
        joins=[
            JoinSpec("oper", "pos", "left", [("num", "num")]),
            JoinSpec("pos", "evt", "inner", [("ver", "version")]),
        ],
    )
    df = build_source(spark, spec)
    assert df.columns == ["ver", "num", "status", "amount", "pos__status", "event"]
    assert {(r["num"], r["pos__status"], r["event"]) for r in df.collect()} == {(1, "ok", "e1"), (2, None, "e2")}


def test_collision_prefix_and_switch(spark, tables):
    step = JoinSpec("oper", "pos", "inner", [("num", "num")], collision_prefix="p_")
    assert "p_status" in build_source(spark, SourceSpec(tables, [step])).columns
    bare = JoinSpec("oper", "pos", "inner", [("num", "num")], rename_collisions=False)
    assert build_source(spark, SourceSpec(tables, [bare])).columns.count("status") == 2


@pytest.mark.parametrize("how", ["left", "right", "full", "inner", "left_semi"])
def test_skewed_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r"), (None, "m")], "k int, y string")

    def rows(skewed):
        step = JoinSpec("l", "r", how, [("k", "k")], skewed=skewed)
        df = build_source(spark, SourceSpec({"l": left, "r": right}, [step]))
        return sorted(map(str, (r.asDict() for r in df.collect())))

    assert rows(True) == rows(False)


def test_bad_specs(spark, tables):
    with pytest.raises(ValueError, match="no key pairs"):
        build_source(spark, SourceSpec(tables, [JoinSpec("oper", "pos")]))
    with pytest.raises(ValueError, match="exactly one table"):
        build_source(spark, SourceSpec(tables))
    with pytest.raises(ValueError, match="unknown alias"):
        build_source(spark, SourceSpec(tables, [JoinSpec("oper", "nope", on=[("num", "num")])]))
    clash = {**tables, "evt": tables["evt"].selectExpr("version", "event", "1 AS ver")}
    with pytest.raises(ValueError, match="already has a column 'ver'"):
        build_source(spark, SourceSpec(clash, [JoinSpec("oper", "evt", on=[("ver", "version")])]))
    with pytest.raises(ValueError, match="paired twice"):
        twice = [("num", "version"), ("ver", "version")]
        build_source(spark, SourceSpec(tables, [JoinSpec("oper", "evt", on=twice)]))


def test_materialize(spark, tables):
    assert materialize(spark, tables["oper"]) is tables["oper"]
    both = materialize(spark, [tables["oper"], tables["pos"]])
    assert both.columns == ["num", "ver", "status", "amount"] and both.count() == 4
    assert materialize(spark, [], "a bigint, b string").dtypes == [("a", "bigint"), ("b", "string")]
    with pytest.raises(ValueError, match="needs a schema"):
        materialize(spark, [])
    with pytest.raises(ValueError, match="unsupported source"):
        materialize(spark, "db.table")
    with pytest.raises(ValueError, match="nothing to union"):
        union_all([])


def test_partition_overwrite_replaces_all_or_only_given_partitions(spark):
    path = scratch_path(spark, "parts")
    write_files(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, month int"), path, partition_columns=["year", "month"])
    changed = spark.createDataFrame([(9, 2024, 2)], "v int, year int, month int")
    write_files(changed, path, partition_columns=["year", "month"], only_touched=True)
    assert sorted(r["v"] for r in scan_files(spark, path).collect()) == [1, 9]
    write_files(spark.createDataFrame([(5, 2024, 2)], "v int, year int, month int"), path, mode="append", partition_columns=["year", "month"])
    assert scan_files(spark, path).where("month = 2").count() == 2
    write_files(changed, path, partition_columns=["year", "month"])
    assert [r["v"] for r in scan_files(spark, path).collect()] == [9]


def test_json_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1,\n "b": "x"}')
    assert scan_files(spark, str(tmp_path), "json", {"multiline": True}).first().asDict() == {"a": 1, "b": "x"}


def test_csv_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;x\n")
    df = scan_files(spark, str(tmp_path), "csv", {"withHeader": True, "separator": ";"})
    assert df.first().asDict() == {"a": "1", "b": "x"}


def test_catalog_predicate_reaches_the_scan(spark):
    database = scratch_database(spark)
    write_table(spark.range(10), database, "numbers")
    df = scan_catalog(spark, database, "numbers", {"pushdownPredicate": "id > 7"})
    assert df.count() == 2
    assert "GreaterThan(id,7)" in df._jdf.queryExecution().executedPlan().toString()


def test_conform_and_write(spark):
    database = scratch_database(spark)
    spark.sql(
        f"CREATE TABLE {database}.readings (id int, sensor string, place string, remark string, day date) "
        "USING parquet PARTITIONED BY (day)"
    )
    fields, partitions = target_fields(spark, database, "readings")
    assert [f.name for f in fields] == ["id", "sensor", "place", "remark", "day"]
    assert partitions == ["day"]
    source = spark.createDataFrame(
        [("1", "t-1", "north", "2024-01-01", 7), ("x", "t-2", "south", "2024-01-02", 8)],
        "id string, sensor string, place string, day string, surplus int",
    )
    assert lost_values(source, fields).first().asDict() == {"id": 1, "sensor": 0, "place": 0, "day": 0}
    conform_and_write(spark, source, database, "readings")
    rows = {r["sensor"]: (r["id"], r["remark"], str(r["day"])) for r in spark.table(f"{database}.readings").collect()}
    assert rows == {"t-1": (1, None, "2024-01-01"), "t-2": (None, None, "2024-01-02")}
    conform_and_write(spark, source.where("id = '1'"), database, "readings", mode="overwrite")
    assert spark.table(f"{database}.readings").count() == 2


def test_conform_resolves_names_like_spark(spark):
    target = spark.createDataFrame([], "Id int, name string").schema.fields
    df = spark.createDataFrame([("1", "a")], "ID string, NAME string")
    assert conform(df, target).first().asDict() == {"Id": 1, "name": "a"}
    assert lost_values(df, target).columns == ["Id", "name"]


def test_filter_and_projection_by_alias(spark, tables):
    spec = SourceSpec(
        tables=tables,
        joins=[JoinSpec("oper", "pos", "inner", [("num", "num")])],
        where="oper.status = 'open' AND pos.amount > 1",
        select_columns=["oper.num", "pos.amount"],
    )
    assert build_source(spark, spec).first().asDict() == {"num": 1, "amount": 5.0}
    single = SourceSpec({"o": tables["oper"]}, where="o.num = 2", select_columns=["o.status"])
    assert build_source(spark, single).first().asDict() == {"status": "shut"}


def test_same_table_under_two_aliases(spark, tables):
    spec = SourceSpec(
        tables={"a": tables["oper"], "b": tables["oper"]},
        joins=[JoinSpec("a", "b", "inner", [("num", "num")])],
        where="a.status = 'open'",
    )
    row = build_source(spark, spec).first().asDict()
    assert row == {"num": 1, "ver": 10, "status": "open", "b__ver": 10, "b__status": "open"}


def test_overwrite_keeps_other_partitions_without_session_settings(spark):
    """Two threads write to two tables at once; neither changes a setting the other reads."""
    database, setting = scratch_database(spark), "spark.sql.sources.partitionOverwriteMode"
    before, errors = spark.conf.get(setting), []
    for name in ("one", "two"):
        spark.sql(f"CREATE TABLE {database}.{name} (v int, day string) USING parquet PARTITIONED BY (day)")
        spark.sql(f"INSERT INTO {database}.{name} VALUES (1, 'a'), (2, 'b')")

    def write(name, value):
        try:
            for _ in range(3):
                rows = spark.createDataFrame([(value, "b")], "v int, day string")
                conform_and_write(spark, rows, database, name, mode="overwrite")
                assert spark.conf.get(setting) == before
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=a) for a in (("one", 8), ("two", 9))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    for name, value in (("one", 8), ("two", 9)):
        assert sorted(tuple(r) for r in spark.table(f"{database}.{name}").collect()) == [(1, "a"), (value, "b")]


def test_widened():
    def wider(a, b):
        a, b = (T.StructType.fromDDL(f"x {t}")["x"].dataType for t in (a, b))
        found = {None if w is None else w.simpleString() for w in (widened(a, b), widened(b, a))}
        assert len(found) == 1
        return found.pop()

    assert wider("int", "bigint") == "bigint"
    assert wider("tinyint", "float") == "float"
    assert wider("int", "float") == "double"
    assert wider("bigint", "double") is None
    assert wider("decimal(10,2)", "int") == "decimal(12,2)"
    assert wider("decimal(5,4)", "decimal(10,0)") == "decimal(14,4)"
    assert wider("decimal(38,0)", "decimal(38,10)") is None
    assert wider("decimal(5,0)", "double") is None
    assert wider("date", "timestamp") == "timestamp"
    assert wider("date", "int") is None
    assert wider("string", "int") is None
    assert wider("array<int>", "array<bigint>") == "array<bigint>"
    assert wider("map<string,float>", "map<string,double>") == "map<string,double>"
    assert wider("struct<a:int>", "struct<a:date>") is None
    kinds = [T.StructType.fromDDL(f"x {t}")["x"].dataType for t in ("struct<a:int,b:date>", "struct<a:bigint,c:string>")]
    assert widened(*kinds).simpleString() == "struct<a:bigint,b:date,c:string>"


def test_drift_is_found_added_and_refused(spark):
    database = scratch_database(spark)
    spark.sql(f"CREATE TABLE {database}.gauges (Id int, level float, spot struct<x:int>, day string) USING parquet PARTITIONED BY (day)")
    fields = spark.table(f"{database}.gauges").schema.fields
    first = spark.sql("SELECT 1S AS ID, 2Y AS level, '2024' AS day, 5L AS seen, named_struct('t', 'x') AS tag, NULL AS nothing")
    drift = schema_drift(first, fields)
    assert [f.simpleString() for f in drift.new] == ["seen:bigint", "tag:struct<t:string>"]
    assert (drift.missing, drift.narrow) == (("spot",), {})
    assert conform_and_write(spark, first, database, "gauges", evolve=True) == drift
    assert spark.table(f"{database}.gauges").columns == ["Id", "level", "spot", "seen", "tag", "day"]
    wide = spark.sql("SELECT 1L AS id, 1D AS level, named_struct('x', 1, 'y', 2) AS spot, current_date() AS seen, '2024' AS day, 1 AS late")
    with pytest.raises(ValueError, match=r"Id \(bigint\), level \(double\), spot \(struct<x:int,y:int>\), seen \(no common type\)"):
        conform_and_write(spark, wide, database, "gauges", evolve=True)
    table = spark.table(f"{database}.gauges")
    assert "late" not in table.columns and table.count() == 1
    assert schema_drift(first, spark.table(f"{database}.gauges").schema.fields).new == ()
    extra = [T.StructField("SEEN", T.LongType()), T.StructField("more", T.IntegerType())]
    conform_and_write(spark, first, database, "gauges", extra_fields=extra)
    assert spark.table(f"{database}.gauges").columns == ["Id", "level", "spot", "seen", "tag", "more", "day"]
