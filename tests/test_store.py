from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.registry import scratch_database
from tidemark.operators import store as st

def now():
    return F.lit("2024-02-01").cast("timestamp")


BATCH = "id string, total int, version bigint"


def batch(spark, *rows):
    return st.prepare_batch(spark.createDataFrame(rows, BATCH))


def saved(spark, *rows, into=None):
    b = batch(spark, *rows)
    return st.save(st.empty_store(b) if into is None else into, b, now())


def content(store):
    return {r["id"]: (r["total"], r["version"]) for r in store.collect()}


def outcomes(store, b):
    return {r["id"]: (r["status"], r["version"]) for r in st.save_outcomes(store, b).collect()}


def test_rule_table(spark):
    store = saved(spark, ("same", 1, 5), ("low", 1, 5), ("high", 1, 5), ("next", 1, 5), ("idle", 1, 5))
    b = batch(
        spark,
        ("same", 1, 9),
        ("low", 2, 5),
        ("high", 2, 7),
        ("next", 2, None),
        ("new", 2, 4),
        ("auto", 2, None),
    )
    assert outcomes(store, b) == {
        "same": ("exists", 5),
        "low": ("conflict", 5),
        "high": ("updated", 7),
        "next": ("updated", 6),
        "new": ("created", 4),
        "auto": ("created", 1),
    }
    assert content(st.save(store, b, now())) == {
        "same": (1, 5),
        "low": (1, 5),
        "high": (2, 7),
        "next": (2, 6),
        "new": (2, 4),
        "auto": (2, 1),
        "idle": (1, 5),
    }
    assert st.batch_stats(st.save_outcomes(store, b)).first().asDict() == {"saved": 5, "total": 6, "failed": 1}


def test_missing_stored_version_counts_as_zero(spark):
    store = saved(spark, ("a", 1, 1)).withColumn("version", F.lit(None).cast("bigint"))
    assert outcomes(store, batch(spark, ("a", 2, 0))) == {"a": ("conflict", 0)}
    assert outcomes(store, batch(spark, ("a", 2, 1))) == {"a": ("updated", 1)}
    assert outcomes(store, batch(spark, ("a", 2, None))) == {"a": ("updated", 1)}


def test_strict_conflict_fails(spark):
    store = saved(spark, ("a", 1, 5))
    with pytest.raises(PySparkException, match="version is not above"):
        st.save_outcomes(store, batch(spark, ("a", 2, 3)), strict=True).collect()


def test_repeated_key_fails(spark):
    b = batch(spark, ("a", 1, None), ("a", 2, None))
    with pytest.raises(PySparkException, match="more than once"):
        st.save(st.empty_store(b), b, now()).collect()


def test_equal_rows_of_a_key_are_one(spark):
    b = batch(spark, ("a", 1, None), ("a", 1, None), ("b", 2, None))
    assert st.save(st.empty_store(b), b, now()).count() == 2
    keyless = st.prepare_batch(spark.sql("SELECT 1 AS total UNION ALL SELECT 1 UNION ALL SELECT 2"))
    assert st.save(st.empty_store(keyless), keyless, now()).count() == 2


def files_of(store):
    """Files of the store by bucket."""
    found = {}
    for path in store._rows().inputFiles():
        found.setdefault(int(path.split(f"{st.BUCKET}=")[1].split("/")[0]), []).append(path)
    return found


def test_names_with_capitals_leave_one_table(spark):
    database = scratch_database(spark)
    store = st.AggregateStore(spark, database, "Totals", buckets=2)
    for total in range(3):
        store.save(spark.createDataFrame([("a", total)], "id string, total int"))
    assert [t.name for t in spark.catalog.listTables(database)] == ["totals"]
    assert store.read().first()["total"] == 2


def test_a_small_save_writes_only_the_buckets_it_touches(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "t", buckets=16)
    rows = spark.range(500).select(F.col("id").cast("string"), F.lit(1).alias("total"))
    store.save(rows)
    before = files_of(store)
    assert sorted(before) == list(range(16)) and all(len(f) == 1 for f in before.values())
    store.save(spark.createDataFrame([("7", 2, "x")], "id string, total int, note string"))
    bucket = spark.sql("SELECT pmod(hash('7'), 16)").first()[0]
    after = files_of(store)
    assert [b for b in range(16) if before[b] != after[b]] == [bucket]
    assert store.read().columns == ["id", "total", "note", *st.CONTROL_COLUMNS[1:]]
    got = {r["id"]: (r["total"], r["note"], r["version"]) for r in store.read().collect()}
    assert len(got) == 500 and got.pop("7") == (2, "x", 2) and set(got.values()) == {(1, None, 1)}
    store.delete(spark.createDataFrame([("8",), ("none",)], "id string"))
    assert store.read().count() == 499 and content(store.get("7", "8")) == {"7": (2, 2)}
    assert store.save(rows.limit(0)).count() == 0 and store.read().count() == 499


def test_a_bucket_can_be_emptied(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "t", buckets=4)
    rows = spark.range(40).select(F.col("id").cast("string"), F.lit(1).alias("total"))
    store.save(rows)
    doomed = rows.where("pmod(hash(id), 4) = 2")
    store.delete(doomed)
    assert store.read().where("pmod(hash(id), 4) = 2").count() == 0
    assert store.read().count() == 40 - doomed.count() > 0
    assert {r["status"] for r in store.save(doomed).collect()} == {"created"}
    assert store.read().count() == 40


def test_a_lookup_reads_only_the_buckets_of_its_ids(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "t", buckets=8)
    store.save(spark.range(100).select(F.concat(F.lit("k"), F.col("id")).alias("id"), F.lit(1).alias("total")))
    bucket = spark.sql("SELECT pmod(hash('k7'), 8)").first()[0]
    plan = store.get("k7")._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({st.BUCKET}" in plan and f"= {bucket})]" in plan and "EqualTo(id,k7)" in plan
    assert content(store.get("k7", "zz")) == {"k7": (1, 1)}
    asked = spark.createDataFrame([("k8",), ("zz",), ("k8",)], "id string")
    assert content(store.get_all(asked)) == {"k8": (1, 1)}
    assert sorted(content(store.find("k1", "k99"))) == sorted(f"k{i}" for i in range(100) if str(i).startswith("1") or i == 99)
    assert "StringStartsWith(id,k1)" in store.find("k1")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("dies", ["before", "within", "after"])
def test_a_save_that_died_is_finished_when_the_store_is_opened(spark, monkeypatch, dies):
    database = scratch_database(spark)
    store = st.AggregateStore(spark, database, "t", buckets=4)
    rows = spark.range(40).select(F.col("id").cast("string"), F.lit(1).alias("total"))
    store.save(rows)

    def put(self, upcoming):
        table = self._table(self.name)
        if dies != "before":
            session = self.spark.newSession()
            session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            new = session.table(self._table(upcoming)).select(*session.table(table).columns)
            (new.where(f"{st.BUCKET} = 1") if dies == "within" else new).write.mode("overwrite").insertInto(table)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(st.AggregateStore, "_put_in_place", put)
        with pytest.raises(RuntimeError, match="lost"):
            store.save(rows.withColumn("total", F.lit(2)))
    again = st.AggregateStore(spark, database, "t")
    assert set(content(again.read()).values()) == {(2, 2)} and again.read().count() == 40
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_rows_are_replaced_in_one_publication(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "t", buckets=4)
    rows = [("a/1", 1), ("a/2", 1), ("a/3", 1), ("b/1", 1)]
    store.save(spark.createDataFrame(rows, "id string, total int"), replacing=["a/"])
    store.save(spark.createDataFrame([("a/2", 2), ("a/9", 1)], "id string, total int"), replacing=["a/"])
    assert content(store.read()) == {"a/2": (2, 2), "a/9": (1, 1), "b/1": (1, 1)}


def test_explicit_versions_in_order_in_a_table(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "t", buckets=2)
    rows = [(1, "a", 1, 5), (2, "a", 2, 4), (3, "a", 3, None), (4, "b", 1, None)]
    frame = spark.createDataFrame(rows, "seq bigint, id string, total int, version bigint")
    found = {r["seq"]: (r["status"], r["version"]) for r in store.save(frame, order_by=["seq"]).collect()}
    assert found == {1: ("created", 5), 2: ("conflict", 5), 3: ("updated", 6), 4: ("created", 1)}
    assert content(store.read()) == {"a": (3, 6), "b": (1, 1)}


def test_a_save_reads_the_store_once(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "aggregates", buckets=4)
    store.save(spark.createDataFrame([("a", 1), ("b", 2)], "id string, total int"))
    after = st.save(store.read(), batch(spark, ("a", 5, None)), buckets=4)
    assert after._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_outcomes_in_order_carry_nothing(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "t", buckets=2)
    with pytest.raises(ValueError, match="carry"):
        store.save(spark.createDataFrame([("a", 1)], "id string, at int"), order_by=["at"], carry=["x"])


def test_times_and_metadata(spark):
    first = st.prepare_batch(spark.sql("SELECT 'a' AS id, 1 AS total, map('source', 'x') AS metadata"))
    store = st.save(st.empty_store(first), first, F.lit("2024-01-01").cast("timestamp"))
    again = st.prepare_batch(spark.sql("SELECT 'a' AS id, 1 AS total, map('source', 'y') AS metadata"))
    row = st.save(store, again, now()).first()
    assert row["metadata"] == {"source": "x"} and str(row["updated_at"])[:10] == "2024-01-01"
    other = st.prepare_batch(spark.sql("SELECT 'a' AS id, 2 AS total, map('source', 'y') AS metadata"))
    row = st.save(store, other, now()).first()
    assert row["metadata"] == {"source": "y"}
    assert (str(row["created_at"])[:10], str(row["updated_at"])[:10]) == ("2024-01-01", "2024-02-01")


def test_without_id_the_hash_is_the_key(spark):
    b = batch(spark, (None, 1, None), ("", 2, None))
    rows = st.save(st.empty_store(b), b, now()).collect()
    assert all(r["id"] == r["idempotency_key"] and len(r["id"]) == 64 for r in rows)
    assert {s for s, _ in outcomes(st.save(st.empty_store(b), b, now()), b).values()} == {"exists"}


def test_lookup_and_delete(spark):
    store = saved(spark, ("a", 1, None), ("b", 2, None), ("c", 3, None))
    ids = spark.createDataFrame([("a",), ("c",), ("x",), ("a",)], "id string")
    assert content(st.lookup(store, ["a", "x"])) == {"a": (1, 1)}
    assert content(st.lookup(store, ids)) == {"a": (1, 1), "c": (3, 1)}
    assert content(st.delete(store, ids)) == {"b": (2, 1)}
    assert content(st.delete(store, ids, "total > 1")) == {"a": (1, 1), "b": (2, 1)}
    gone = {r["id"]: r["deleted"] for r in st.delete_outcomes(store, ids, "total > 1").collect()}
    assert gone == {"a": False, "c": True, "x": False}


def apply_one_by_one(store, rows):
    """Brute force: id -> (total, version), and the outcome of each row."""
    state, results = dict(store), {}
    for seq, (key, total) in sorted(rows.items()):
        if key in state and state[key][0] == total:
            results[seq] = ("exists", state[key][1])
            continue
        version = state[key][1] + 1 if key in state else 1
        results[seq] = ("updated" if key in state else "created", version)
        state[key] = (total, version)
    return state, results


def check_sequence(spark, stored, rows, width):
    base = batch(spark, *[(k, t, v) for k, (t, v) in stored.items()]) if stored else batch(spark, ("zz", 0, 1))
    store = st.save(st.empty_store(base), base, now())
    if not stored:
        stored = {"zz": (0, 1)}
    frame = spark.createDataFrame([(s, k, t) for s, (k, t) in rows.items()], "seq bigint, id string, total int")
    b = st.prepare_batch(frame.repartition(3), order_by=["seq"])
    state, results = apply_one_by_one(stored, rows)
    assert content(st.save_in_order(store, b, ["seq"], now(), width)) == state
    got = st.outcomes_in_order(store, b, ["seq"], width).collect()
    assert {r["seq"]: (r["status"], r["version"]) for r in got} == results


def test_hash_sequence(spark):
    """a, a, b, a for one key, new and stored."""
    values = [1, 1, 2, 1]
    rows = {i * 2 + j: (key, v) for i, v in enumerate(values) for j, key in enumerate(("new", "old"))}
    for width in (None, 1, 3):
        check_sequence(spark, {"old": (1, 4), "idle": (8, 1)}, rows, width)


def test_hot_key_over_many_chunks(spark):
    rng = random.Random(5)
    rows = {i: ("hot" if i % 3 else f"k{rng.randint(0, 20)}", rng.randint(0, 2)) for i in range(900)}
    check_sequence(spark, {"hot": (1, 10), "k3": (0, 2)}, rows, 25)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=hs.lists(hs.tuples(hs.sampled_from("ab"), hs.integers(0, 1)), min_size=1, max_size=12),
    stored=hs.dictionaries(hs.sampled_from("ab"), hs.tuples(hs.integers(0, 1), hs.integers(1, 9))),
    width=hs.integers(1, 5),
)
def test_any_sequence(spark, rows, stored, width):
    check_sequence(spark, stored, dict(enumerate(rows)), width)


def test_explicit_version_in_a_sequence_fails(spark):
    frame = spark.createDataFrame([(1, "a", 1, 7)], "seq bigint, id string, total int, version bigint")
    b = st.prepare_batch(frame, order_by=["seq"])
    with pytest.raises(PySparkException, match="explicit versions"):
        st.save_in_order(st.empty_store(b, ["seq"]), b, ["seq"], now()).collect()


def test_saving_twice_changes_nothing(spark):
    store = saved(spark, ("a", 1, None), ("b", 2, 6))
    b = batch(spark, ("a", 5, None), ("c", 2, None))
    once = st.save(store, b, now())
    assert content(st.save(once, b, now())) == content(once)


def test_table(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "aggregates", buckets=4)
    assert store.read() is None and store.get("a") is None
    first = spark.createDataFrame([("a", 1), ("b", 1)], "id string, total int")
    assert {r["status"] for r in store.save(first).collect()} == {"created"}
    second = spark.createDataFrame([("a", 2), ("b", 1)], "id string, total int")
    report = {r["id"]: (r["status"], r["version"], r["total"]) for r in store.save(second, carry=["total"]).collect()}
    assert report == {"a": ("updated", 2, 2), "b": ("exists", 1, 1)}
    steps = spark.createDataFrame([(1, "a", 2), (2, "a", 3), (3, "c", 3)], "seq bigint, id string, total int")
    assert {r["seq"]: r["status"] for r in store.save(steps, order_by=["seq"]).collect()} == {
        1: "exists",
        2: "updated",
        3: "created",
    }
    assert content(store.read()) == {"a": (3, 3), "b": (1, 1), "c": (3, 1)}
    ids = spark.createDataFrame([("a",), ("x",)], "id string")
    assert {r["id"]: r["deleted"] for r in store.delete(ids).collect()} == {"a": True, "x": False}
    assert content(store.read()) == {"b": (1, 1), "c": (3, 1)}
    assert content(store.get("c")) == {"c": (3, 1)}


def test_failed_save_leaves_the_table_as_it_was(spark):
    store = st.AggregateStore(spark, scratch_database(spark), "aggregates", buckets=4)
    store.save(spark.createDataFrame([("a", 1)], "id string, total int"))
    with pytest.raises(PySparkException):
        store.save(spark.createDataFrame([("a", 2), ("a", 3)], "id string, total int"))
    assert content(store.read()) == {"a": (1, 1)}


@pytest.mark.parametrize("buckets", [4, 8, 16])
def test_bucketed_store_is_not_shuffled(spark, buckets):
    store = st.AggregateStore(spark, scratch_database(spark), "aggregates", buckets=buckets)
    rows = spark.range(1000).select(F.col("id").cast("string"), F.lit(1).alias("total"))
    store.save(rows)
    b = st.prepare_batch(rows.withColumn("total", F.lit(2)))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            st.save(store.read(), b, buckets=buckets),
            st.save_outcomes(store.read(), b, buckets=buckets),
            st.delete(store.read(), b.select("id"), buckets=buckets),
        ):
            assert not shuffled_scans(df, "aggregates")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def shuffled_scans(df, table):
    """Scans of the table that have an exchange above them in their own branch of the plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(lines):
        if "FileScan" not in line or table not in line:
            continue
        depth, above = line.index("FileScan"), []
        for other in reversed(lines[:i]):
            indent = len(other) - len(other.lstrip(" :+-"))
            if indent < depth:
                depth = indent
                above.append(other)
        found += [a for a in above if "Exchange" in a]
    return found


def test_buckets_are_fixed_by_the_first_save(spark):
    database = scratch_database(spark)
    rows = spark.createDataFrame([("a", 1)], "id string, total int")
    st.AggregateStore(spark, database, "aggregates", buckets=3).save(rows)
    later = st.AggregateStore(spark, database, "aggregates", buckets=5)
    later.save(rows.withColumn("total", F.lit(2)))
    assert later.buckets == 3
    assert content(later.read()) == {"a": (2, 2)}


@pytest.mark.parametrize("in_order", [False, True])
def test_new_payload_columns_are_kept(spark, in_order):
    store = saved(spark, ("a", 1, None), ("b", 1, None))
    order = ["seq"] if in_order else []
    frame = spark.createDataFrame([(1, "a", 1, "x"), (2, "c", 2, "y")], "seq bigint, id string, total int, note string")
    b = st.prepare_batch(frame if in_order else frame.drop("seq"), order_by=order)
    after = st.save_in_order(store, b, order, now()) if in_order else st.save(store, b, now())
    assert after.columns == ["id", "total", "note", *st.CONTROL_COLUMNS[1:]]
    got = {r["id"]: (r["total"], r["note"], r["version"]) for r in after.collect()}
    assert got == {"a": (1, "x", 2), "b": (1, None, 1), "c": (2, "y", 1)}
    fewer = batch(spark, ("a", 3, None))
    assert {r["id"]: r["note"] for r in st.save(after, fewer, now()).collect()} == {"a": None, "b": None, "c": "y"}
