from __future__ import annotations

import datetime as dt
import random
from dataclasses import FrozenInstanceError, replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import consolidate as c

RULE = c.PositionRule(tie_breakers=("cod_idef_vers_oper",))
SCHEMA = (
    "num_oper bigint, cod_idef_vers_oper bigint, cod_idef_even_prcs bigint, dat_vlr_even_oper string, "
    "num_prio_even_oper string, dat_recm_even_oper string"
)
MINIMUM = dt.datetime(1900, 1, 1)


def frame(spark, *rows):
    """Rows of (key, version, value date, priority, receipt)."""
    return spark.createDataFrame([(k, v, 9, value, prio, receipt) for k, v, value, prio, receipt in rows], SCHEMA)


def winners(spark, a, b, rule=RULE, **more):
    rows = c.consolidate(spark, frame(spark, *a), frame(spark, *b), rule, **more).collect()
    return {r["num_oper"]: (r["cod_idef_vers_oper"], r["origem_registro"]) for r in rows}


def test_each_rule_decides(spark):
    a = [
        (1, 10, "2024-01-02", "1", "2024-01-01"),  # later value date
        (2, 11, "2024-01-01", "5", "2024-01-01"),  # priority
        (3, 12, "2024-01-01", "5", "2024-01-01"),  # receipt
        (4, 13, "2024-01-01", "5", "2024-01-01"),  # full tie
        (5, 14, "2024-01-01", "5", "2024-01-01"),  # only here
    ]
    b = [
        (1, 20, "2024-01-01", "9", "2024-01-09"),
        (2, 21, "2024-01-01", "4", "2024-01-09"),
        (3, 22, "2024-01-01", "5", "2024-01-02"),
        (4, 99, "2024-01-01", "5", "2024-01-01"),
        (6, 25, "2024-01-01", "5", "2024-01-01"),  # only there
    ]
    assert winners(spark, a, b) == {
        1: (10, "ONLINE"),
        2: (11, "ONLINE"),
        3: (22, "BATCH"),
        4: (13, "ONLINE"),
        5: (14, "ONLINE"),
        6: (25, "BATCH"),
    }
    assert winners(spark, a, b, replace(RULE, preferred_origin="BATCH"))[4] == (99, "BATCH")


def test_reduction_by_receipt_changes_the_winner(spark):
    """The side's latest receipt is kept although another row of it has the later value date."""
    a = [(1, 10, "2024-01-09", "1", "2024-01-01"), (1, 11, "2024-01-01", "1", "2024-01-05")]
    b = [(1, 20, "2024-01-03", "1", "2024-01-02")]
    assert winners(spark, a, b)[1] == (20, "BATCH")
    assert winners(spark, a, b, replace(RULE, reduce_each_side=False))[1] == (10, "ONLINE")
    assert winners(spark, a, b, replace(RULE, latest_order=RULE.value_first))[1] == (10, "ONLINE")


def test_nulls_count_as_minimum_and_are_replaced(spark):
    a = [(1, 10, None, None, None), (2, 11, "no date", "many", "2024-01-01")]
    rows = {
        r["num_oper"]: r for r in c.consolidate(spark, frame(spark, *a), frame(spark), RULE).collect()
    }
    assert rows[1]["dat_vlr_even_oper"] == MINIMUM and rows[1]["num_prio_even_oper"] == 1
    assert rows[2]["dat_vlr_even_oper"] == MINIMUM and rows[2]["num_prio_even_oper"] == 1
    kept = c.consolidate(
        spark, frame(spark, *a), frame(spark), replace(RULE, nulls_as_minimum=False)
    ).collect()
    assert all(r["dat_vlr_even_oper"] is None and r["num_prio_even_oper"] is None for r in kept)


def test_null_priority_beats_zero_and_null_date_beats_older_than_minimum(spark):
    a = [(1, 10, "2024-01-01", None, "2024-01-01"), (2, 11, None, "1", "2024-01-01")]
    b = [(1, 20, "2024-01-01", "0", "2024-01-01"), (2, 21, "1850-01-01", "1", "2024-01-01")]
    assert winners(spark, a, b) == {1: (10, "ONLINE"), 2: (11, "ONLINE")}
    kept = winners(spark, a, b, replace(RULE, nulls_as_minimum=False))
    assert kept == {1: (20, "BATCH"), 2: (21, "BATCH")}


def test_priority_text_with_decimals_is_truncated(spark):
    a = [(1, 10, "2024-01-01", "3.7", "2024-01-01")]
    b = [(1, 20, "2024-01-01", "2", "2024-01-01")]
    assert winners(spark, a, b)[1] == (10, "ONLINE")


def test_extra_column_on_one_side_and_return_columns(spark):
    a = frame(spark, (1, 10, "2024-01-02", "1", "2024-01-01")).withColumn("note", F.lit("x"))
    b = frame(spark, (2, 20, "2024-01-02", "1", "2024-01-01"))
    rows = c.consolidate(spark, a, b, RULE, return_columns=["num_oper", "note"]).collect()
    assert {(r["num_oper"], r["note"], r["origem_registro"]) for r in rows} == {
        (1, "x", "ONLINE"),
        (2, None, "BATCH"),
    }
    listed = c.consolidate(spark, a, b, RULE, return_columns=["origem_registro", "num_oper"])
    assert listed.columns == ["origem_registro", "num_oper"]


def test_map_columns_survive(spark):
    a = frame(spark, (1, 10, "2024-01-02", "1", "2024-01-01")).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    row = c.consolidate(spark, a, [], RULE).first()
    assert row["m"] == {"k": 1}


def test_missing_rule_column_is_named(spark):
    with pytest.raises(ValueError, match="num_prio_even_oper.*not found"):
        c.consolidate(spark, spark.range(1), [], RULE)


def test_rule_is_immutable():
    with pytest.raises(FrozenInstanceError):
        RULE.key = "other"


def test_same_name_for_both_origins(spark):
    a = [(1, 10, "2024-01-01", "1", "2024-01-05")]
    b = [(1, 20, "2024-01-03", "1", "2024-01-02")]
    assert winners(spark, a, b, name_a="X", name_b="X")[1] == (20, "X")


def brute_force(a, b, reduce_each_side, latest_by_value):
    def value_first(r, origin):
        return (r[2] or "1900-01-01", int(r[3] or 1), r[4] or "1900-01-01", origin == "ONLINE", r[1])

    def side_order(r):
        v, p, rec, _, version = value_first(r, "")
        return (v, p, rec, version) if latest_by_value else (rec, v, p, version)

    pool = []
    for rows, origin in ((a, "ONLINE"), (b, "BATCH")):
        by_key = {}
        for r in rows:
            by_key.setdefault(r[0], []).append(r)
        for group in by_key.values():
            kept = [max(group, key=side_order)] if reduce_each_side else group
            pool += [(r, origin) for r in kept]
    best = {}
    for r, origin in pool:
        held = best.get(r[0])
        if held is None or value_first(r, origin) > value_first(*held):
            best[r[0]] = (r, origin)
    return {k: (r[1], origin) for k, (r, origin) in best.items()}


@pytest.mark.parametrize("reduce_each_side", [True, False])
@pytest.mark.parametrize("latest_by_value", [True, False])
def test_against_brute_force_with_a_hot_key(spark, reduce_each_side, latest_by_value):
    """Random rows, a third of them of one operation, in two row orders."""
    rng = random.Random(7)

    def rows(start):
        days = [None, "2024-01-01", "2024-01-02", "2024-01-03"]
        return [
            (
                0 if i % 3 == 0 else rng.randint(1, 40),
                start + i,
                rng.choice(days),
                rng.choice([None, "0", "1", "2"]),
                rng.choice(days),
            )
            for i in range(600)
        ]

    a, b = rows(0), rows(10_000)
    rule = replace(
        RULE, reduce_each_side=reduce_each_side, latest_order=RULE.value_first if latest_by_value else None
    )
    expected = brute_force(a, b, reduce_each_side, latest_by_value)
    assert winners(spark, a, b, rule) == expected
    rng.shuffle(a)
    rng.shuffle(b)
    assert winners(spark, a, b, rule) == expected


def test_consolidation_shuffles_once(spark):
    a = frame(spark, (1, 10, "2024-01-02", "1", "2024-01-01"))
    plan = c.consolidate(spark, a, a, RULE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan


def test_rehydrate(spark):
    won = c.consolidate(
        spark,
        frame(spark, (1, 10, "2024-01-02", "1", "2024-01-01"), (2, 11, "2024-01-02", "1", "2024-01-01")),
        frame(spark, (3, 12, "2024-01-02", "1", "2024-01-01")),
        RULE,
    )
    full_a = spark.createDataFrame(
        [(1, 10, "2024-01-02", "a1"), (1, 10, "2024-01-02", "a2"), (1, 99, "x", "other version")],
        "num_oper bigint, cod_idef_vers_oper bigint, dat_vlr_even_oper string, only_a string",
    )
    full_b = spark.createDataFrame(
        [(3, 12, "b"), (1, 10, "other side")], "num_oper bigint, cod_idef_vers_oper bigint, only_b string"
    )
    rows = c.rehydrate(won, full_a, full_b, RULE)
    got = {(r["num_oper"], r["origem_registro"], r["only_a"], r["only_b"]) for r in rows.collect()}
    assert got == {(1, "ONLINE", "a1", None), (1, "ONLINE", "a2", None), (3, "BATCH", None, "b")}


def test_summary(spark):
    won = c.consolidate(spark, frame(spark, (1, 1, None, None, None)), [], RULE)
    assert c.summarize(won).first().asDict() == {
        "total_vencedores": 1,
        "origem_a": "ONLINE",
        "origem_b": "BATCH",
        "status": "sucesso",
    }


def test_return_columns_prune_the_scan(spark, tmp_path):
    frame(spark, (1, 10, "2024-01-02", "1", "2024-01-01")).withColumn("wide", F.lit("x")).write.parquet(
        str(tmp_path / "a")
    )
    a = spark.read.parquet(str(tmp_path / "a"))
    for rule in (RULE, replace(RULE, latest_order=RULE.value_first)):
        won = c.consolidate(spark, a, [], rule, return_columns=["num_oper"])
        plan = won._jdf.queryExecution().executedPlan().toString()
        assert "wide" not in plan and "cod_idef_even_prcs" not in plan
        assert won.first().asDict() == {"num_oper": 1, "origem_registro": "ONLINE"}


def test_return_columns_are_resolved_like_a_select(spark):
    a = frame(spark, (1, 10, "2024-01-02", "1", "2024-01-01")).withColumn("s", F.struct(F.lit(5).alias("n")))
    row = c.consolidate(spark, a, [], RULE, return_columns=["NUM_OPER", "s.n"]).first()
    assert tuple(row) == (1, 5, "ONLINE")
