"""Sums of doubles against exact fractions, with rows in any order and splits."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.operators import profile as p
from tidemark.operators import sales as s


def any_double(draw: random.Random) -> float:
    while True:
        value = struct.unpack("d", struct.pack("Q", draw.getrandbits(64)))[0]
        if math.isfinite(value):
            return value / 4096  # so that no sum leaves the doubles


def groups() -> dict[str, list[float | None]]:
    draw = random.Random(1)
    return {
        "any": [any_double(draw) for _ in range(2000)],
        "middle": [draw.uniform(-1e6, 1e6) * 10 ** draw.randrange(-8, 8) for _ in range(3000)],
        "money": [round(draw.uniform(1, 5e5), 2) for _ in range(3000)],
        "powers": [2.0**k for k in range(-1074, 1023)] + [-(2.0**k) for k in range(-1074, 1000)],
        "beside": [math.nextafter(2.0**k, 0) for k in range(-1000, 1000)],
        "tiny": [5e-324 * draw.randrange(1, 1000) for _ in range(100)],
        "cancel": [1e16, 1.0, -1e16] * 100,
        "zeros": [0.0, -0.0],
        "some": [None, 1.5, None],
        "none": [None, None],
        "infinite": [1.0, math.inf],
        "both": [math.inf, -math.inf],
        "nan": [math.nan, 1.0],
    }


def exact_total(values: list[float | None]) -> float | None:
    known = [v for v in values if v is not None]
    if all(map(math.isfinite, known)):
        return float(sum(map(Fraction, known))) if known else None
    return sum(known)


def test_sums_equal_exact_fractions_in_any_order(spark):
    given = groups()
    rows = [(k, v) for k, values in given.items() for v in values]
    for parts in (1, 7):
        random.Random(parts).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        partial = exact.partial_sums(df, ["k"], F.col("v"))
        found = {r["k"]: (r[exact.ROWS], r[exact.SUM]) for r in exact.totals(exact.summed_again(partial, ["k"]), ["k"]).collect()}
        for k, values in given.items():
            wanted = exact_total(values)
            assert found[k][0] == len(values)
            assert found[k][1] == wanted or (wanted != wanted and math.isnan(found[k][1])), k


def test_profile_and_sales_of_doubles_do_not_depend_on_splits(spark):
    draw = random.Random(2)
    rows = [(draw.choice("ab"), draw.uniform(-1, 1) * 10 ** draw.randrange(12), draw.randrange(9), None) for _ in range(2000)]
    seen = set()
    for parts in (1, 5, 16):
        df = spark.createDataFrame(rows, "categoria string, valor double, n bigint, w float").repartition(parts)
        measured = p.profile(df, None).first()
        totals = s.sales_totals(df).first()
        by_category = sorted(tuple(r) for r in s.sales_by_category(df).collect())
        seen.add(repr((tuple(measured), tuple(totals), by_category)))
    assert len(seen) == 1
    measured, totals = tuple(measured), tuple(totals)
    wanted = exact_total([r[1] for r in rows])
    assert measured == (2000, ["valor", "n", "w"], wanted, sum(r[2] for r in rows), None)
    assert totals == (2000, wanted, wanted / 2000)
    assert [r[2] for r in by_category] == [exact_total([r[1] for r in rows if r[0] == c]) for c in "ab"]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "categoria string, valor double, n bigint")
    assert tuple(p.profile(df).first()) == (0, ["valor", "n"], None, None)
    assert tuple(s.sales_totals(df).first()) == (0, 0.0, 0.0)
    assert s.sales_by_category(df).count() == 0
