"""Rows with explicit versions in order, against one row after the other."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import store as st
from tidemark.operators import versions as vs

BATCH = "id string, total int, version bigint, n bigint"


def one_by_one(store: dict, rows: list[tuple]) -> dict:
    """Outcome per (id, n); ``store``: id -> (content, version)."""
    found = {}
    for key, total, version, n in sorted(rows, key=lambda r: r[3]):
        old = store.get(key)
        if old is None:
            status, after = "created", (total, version if version is not None else 1)
        elif old[0] == total:
            status, after = "exists", old
        elif version is not None and version <= old[1]:
            status, after = "conflict", old
        else:
            status, after = "updated", (total, version if version is not None else old[1] + 1)
        store[key] = after
        found[key, n] = (status, after[1])
    return found


def random_rows(draw: random.Random, kind: str) -> list[tuple]:
    rows = []
    for n in range(900):
        key = "hot" if draw.random() < 0.35 else draw.choice("abcdefgh")
        if kind == "rising":  # of one content, so that the bar is what the first accepted row set
            rows.append((key, 1 if draw.random() < 0.98 else 2, n, n))
        elif kind == "counted":
            rows.append((key, draw.randrange(3), None, n))
        else:
            rows.append((key, draw.randrange(3), draw.choice([None, draw.randrange(40), n // 20, draw.randrange(2000)]), n))
    return rows


@pytest.mark.parametrize("kind", ["rising", "counted", "mixed"])
@pytest.mark.parametrize("stored", [False, True])
def test_equals_one_by_one(spark, kind, stored):
    draw = random.Random(f"{kind}{stored}")
    known = {k: (draw.randrange(3), draw.randrange(1, 30)) for k in ("hot", "a", "b", "idle")} if stored else {}
    old = st.prepare_batch(spark.createDataFrame([(k, t, v) for k, (t, v) in known.items()], "id string, total int, version bigint"))
    store = st.save(st.empty_store(old), old, F.lit("2024-02-01").cast("timestamp"))
    rows = random_rows(draw, kind)
    batch = st.prepare_batch(spark.createDataFrame(rows, BATCH).repartition(5), order_by=["n"])
    found = vs.outcomes(store, batch, ["n"], piece_rows=10).collect()
    after = dict(known)
    wanted = one_by_one(after, rows)
    assert len(found) == len(rows)
    assert {(r["id"], r["n"]): (r["status"], r["version"]) for r in found} == wanted
    if kind == "mixed":
        saved = st.save_in_order(store, batch, ["n"], F.lit("2024-03-01").cast("timestamp"), explicit=True)
        assert {r["id"]: (r["total"], r["version"]) for r in saved.collect()} == after


def test_exists_does_not_raise_the_bar(spark):
    rows = [("k", 1, 3, 0), ("k", 1, 10, 1), ("k", 2, 5, 2), ("k", 3, None, 3), ("k", 4, 6, 4)]
    batch = st.prepare_batch(spark.createDataFrame(rows, BATCH), order_by=["n"])
    found = st.outcomes_in_order(st.empty_store(batch, ["n"]), batch, ["n"], explicit=True).orderBy("n").collect()
    assert [(r["status"], r["version"]) for r in found] == [
        ("created", 3), ("exists", 3), ("updated", 5), ("updated", 6), ("conflict", 6),
    ]


def test_empty_batch(spark):
    batch = st.prepare_batch(spark.createDataFrame([], BATCH), order_by=["n"])
    assert vs.outcomes(st.empty_store(batch, ["n"]), batch, ["n"]).count() == 0
