"""The Bloom filter of keys and the join that uses it."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import consolidate as c
from tidemark.operators import key_filter as kf

RULE = c.PositionRule(tie_breakers=("cod_idef_vers_oper",))


def winners_and_full(spark, winners: int = 500, versions: int = 40):
    """One winner per operation; the full table has many versions of each."""
    won = spark.range(winners).select(
        F.col("id").alias("num_oper"), (F.col("id") % versions).alias("cod_idef_vers_oper"), F.lit("ONLINE").alias("origem_registro")
    )
    full = spark.range(winners * versions).select(
        (F.col("id") % winners).alias("num_oper"),
        F.floor(F.col("id") / winners).cast("int").alias("cod_idef_vers_oper"),
        F.col("id").alias("payload"),
    )
    return won, full


def test_no_partner_is_lost_and_few_others_stay(spark):
    won, full = winners_and_full(spark)
    tagged = c.tag_origin(full, "ONLINE", RULE)
    keys = ["num_oper", "cod_idef_vers_oper", "origem_registro"]
    columns, shape = kf.filter_columns(won, tagged, keys), kf.KeyFilter()
    assert columns == {"num_oper": "bigint", "cod_idef_vers_oper": "bigint", "origem_registro": "string"}
    blocks = shape.blocks(500)
    kept = kf.pruned(tagged, kf.build(won, columns, blocks, shape), columns, blocks, shape)
    assert kept.columns == tagged.columns
    assert kept.join(won, keys).count() == tagged.join(won, keys).count() == 500
    assert 500 <= kept.count() < 500 + 0.02 * tagged.count()  # of 20,000 rows


def test_pruned_rehydration_equals_the_plain_one(spark):
    won, full = winners_and_full(spark)
    full_b = full.where("num_oper = 3").withColumn("other", F.lit("b"))
    plain = c.rehydrate(won, full, full_b, RULE)
    for shape in (kf.KeyFilter(), kf.KeyFilter(most_bytes=1)):  # the second filter would be too large
        found = c.rehydrate(won, full, full_b, RULE, prune=shape)
        assert found.columns == plain.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))


def test_filter_stands_below_the_exchange(spark):
    won, full = winners_and_full(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = c.rehydrate(won, full, full.where("false"), RULE, prune=kf.KeyFilter())._jdf.queryExecution().executedPlan().toString()
        without = c.rehydrate(won, full, full.where("false"), RULE, prune=kf.KeyFilter(most_bytes=1))
        assert "BroadcastHashJoin" not in without._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    depth = {n: re.search(r"\w", line).start() for n, line in enumerate(lines)}
    probe = next(n for n, line in enumerate(lines) if "BroadcastHashJoin" in line)
    above = [n for n in range(probe) if depth[n] < depth[probe] and "Exchange hashpartitioning(num_oper" in lines[n]]
    assert above and any("SortMergeJoin" in line for line in lines[: above[0]])


def test_unlike_types_take_no_part(spark):
    a = spark.createDataFrame([], "k int, d double, s string, t timestamp")
    b = spark.createDataFrame([], "k bigint, d double, s string, t date")
    assert kf.filter_columns(a, b, ["k", "d", "s", "t"]) == {"k": "bigint", "s": "string"}


def test_null_keys_and_an_empty_filter(spark):
    keys = spark.createDataFrame([(None,), (1,)], "k int")
    columns, shape = {"k": "bigint"}, kf.KeyFilter()
    rows = spark.createDataFrame([(None, "n"), (1, "x"), (1, "y"), (2, "z")], "k bigint, v string")
    kept = kf.pruned(rows, kf.build(keys, columns, 1, shape), columns, 1, shape)
    assert {"x", "y"} <= {r["v"] for r in kept.collect()}
    assert kf.pruned(rows, kf.build(keys.where("false"), columns, 1, shape), columns, 1, shape).count() == 0


def test_size_is_checked():
    shape = kf.KeyFilter(most_bytes=1 << 20)
    assert shape.fits(500_000) and not shape.fits(1_000_000)
    with pytest.raises(ValueError, match="hashes"):
        kf.build(None, {}, 1, kf.KeyFilter(hashes=6))
