"""Declarative sources: joins, filters, projections and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.spec import JoinSpec, SourceSpec, build_source, materialize, union_all

from .registry import published, query, table


def daily(spark: SparkSession, sf_dir: str, later: int = 0) -> DataFrame:
    """Events per user and day, the day counted ``later`` days after they happened."""
    day = F.date_format(F.date_add(F.col("ts").cast("date"), later), "yyyy-MM-dd")
    return table(spark, sf_dir, "events").groupBy("user_id", day.alias("day")).agg(F.count("*").alias("n"))


def _daily_sql(later: int = 0) -> str:
    return (
        f"(SELECT user_id, strftime(CAST(ts AS DATE) + {later}, '%Y-%m-%d') AS day, count(*) AS n "
        "FROM events GROUP BY ALL)"
    )


TODAY, DAY_BEFORE = _daily_sql(), _daily_sql(1)
USER_DAY = (("user_id", "user_id"), ("day", "day"))


@query(
    "spec_join_single_key",
    "SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def spec_join_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(
        spark,
        SourceSpec(
            tables={"d": published(spark, sf_dir, "documents"), "l": published(spark, sf_dir, "labels")},
            joins=[JoinSpec("d", "l", on=[("doc_id", "doc_id")])],
            select_columns=["doc_id", "lang", "source", "n_chars", "quality", "toxic"],
        ),
    )


@query(
    "spec_join_multi_key",
    f"SELECT user_id, day, c.n AS n, e.n AS e__n FROM {TODAY} c JOIN {DAY_BEFORE} e USING (user_id, day)",
)
def spec_join_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _days(spark, sf_dir, "inner"))


def _days(spark: SparkSession, sf_dir: str, how: str, skewed: bool = False) -> SourceSpec:
    return SourceSpec(
        tables={"c": daily(spark, sf_dir), "e": daily(spark, sf_dir, 1)},
        joins=[JoinSpec("c", "e", how=how, on=USER_DAY, skewed=skewed)],
    )


@query(
    "spec_join_renamed_key",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       c_name, c_nationkey, c_acctbal, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def spec_join_renamed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(
        spark,
        SourceSpec(
            tables={"o": published(spark, sf_dir, "orders"), "c": published(spark, sf_dir, "customer")},
            joins=[JoinSpec("o", "c", on=[("o_custkey", "c_custkey")])],
        ),
    )


@query(
    "spec_join_chain",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, c_name, n_name, r_name, p_brand
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey""",
)
def spec_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = {"l": "lineitem", "o": "orders", "c": "customer", "n": "nation", "r": "region", "p": "part"}
    return build_source(
        spark,
        SourceSpec(
            tables={a: published(spark, sf_dir, t) for a, t in aliases.items()},
            joins=[
                JoinSpec("l", "o", on=[("l_orderkey", "o_orderkey")]),
                JoinSpec("o", "c", on=[("o_custkey", "c_custkey")]),
                JoinSpec("c", "n", on=[("c_nationkey", "n_nationkey")]),
                JoinSpec("n", "r", on=[("n_regionkey", "r_regionkey")]),
                JoinSpec("l", "p", on=[("l_partkey", "p_partkey")]),
            ],
            select_columns=[
                "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "c_name", "n_name", "r_name", "p_brand",
            ],
        ),
    )


def _orders_and_lines(spark: SparkSession, sf_dir: str, how: str, skewed: bool = False) -> SourceSpec:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    if how == "left":
        columns += ["l_partkey", "l_linenumber"]
    return SourceSpec(
        tables={"o": published(spark, sf_dir, "orders"), "l": published(spark, sf_dir, "lineitem")},
        joins=[JoinSpec("o", "l", how=how, on=[("o_orderkey", "l_orderkey")], skewed=skewed)],
        select_columns=columns,
    )


@query(
    "spec_join_left",
    """SELECT o_orderkey, o_custkey, o_orderstatus, l_partkey, l_linenumber
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def spec_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _orders_and_lines(spark, sf_dir, "left"))


@query(
    "spec_join_semi",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def spec_join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _orders_and_lines(spark, sf_dir, "left_semi"))


@query(
    "spec_join_anti",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def spec_join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _orders_and_lines(spark, sf_dir, "left_anti"))


@query(
    "spec_join_full",
    f"SELECT user_id, day, c.n AS n, e.n AS e__n FROM {TODAY} c FULL JOIN {DAY_BEFORE} e USING (user_id, day)",
)
def spec_join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _days(spark, sf_dir, "full"))


@query(
    "spec_join_full_skewed",
    f"SELECT user_id, day, c.n AS n, e.n AS e__n FROM {TODAY} c FULL JOIN {DAY_BEFORE} e USING (user_id, day)",
)
def spec_join_full_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _days(spark, sf_dir, "full", skewed=True))


@query(
    "spec_join_left_skewed",
    """SELECT o_orderkey, o_custkey, o_orderstatus, l_partkey, l_linenumber
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def spec_join_left_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _orders_and_lines(spark, sf_dir, "left", skewed=True))


@query(
    "spec_join_right",
    f"SELECT user_id, day, c.n AS n, e.n AS e__n FROM {TODAY} c RIGHT JOIN {DAY_BEFORE} e USING (user_id, day)",
)
def spec_join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(spark, _days(spark, sf_dir, "right"))


@query(
    "join_collision_prefix",
    """SELECT n.n_nationkey AS nationkey, n.n_name AS name, n.n_regionkey AS regionkey,
       s.s_suppkey AS suppkey, s.s_name AS sup_name, s.s_acctbal AS acctbal,
       c.c_custkey AS custkey, c.c_name AS c__name, c.c_acctbal AS c__acctbal, c.c_mktsegment AS mktsegment
FROM nation n JOIN supplier s ON n.n_nationkey = s.s_nationkey
JOIN customer c ON n.n_nationkey = c.c_nationkey AND s.s_suppkey = c.c_custkey""",
)
def join_collision_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Once with a given prefix, once with the alias as prefix."""

    def bare(name: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        return df.toDF(*[c.split("_", 1)[1] for c in df.columns])

    return build_source(
        spark,
        SourceSpec(
            tables={"n": bare("nation"), "s": bare("supplier"), "c": bare("customer")},
            joins=[
                JoinSpec("n", "s", on=[("nationkey", "nationkey")], collision_prefix="sup_"),
                JoinSpec("s", "c", on=[("nationkey", "nationkey"), ("suppkey", "custkey")]),
            ],
        ),
    ).withColumn("custkey", F.col("suppkey"))


@query(
    "spec_where_select",
    """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' AND c_mktsegment = 'BUILDING' AND o_orderdate >= TIMESTAMP '1996-01-01'""",
)
def spec_where_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_source(
        spark,
        SourceSpec(
            tables={"o": published(spark, sf_dir, "orders"), "c": published(spark, sf_dir, "customer")},
            joins=[JoinSpec("o", "c", on=[("o_custkey", "c_custkey")])],
            where=(
                "o_orderstatus = 'F' AND c_mktsegment = 'BUILDING' "
                "AND o_orderdate >= timestamp_ntz '1996-01-01'"
            ),
            select_columns=["o_orderkey", "c_name", "o_totalprice"],
        ),
    )


@query("spec_single_table", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size >= 25")
def spec_single_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(
        tables={"p": published(spark, sf_dir, "part")},
        where="p_size >= 25",
        select_columns=["p_partkey", "p_brand", "p_size"],
    )
    return build_source(spark, spec)


@query(
    "materialize_input",
    """SELECT 'frame' AS kind, count(*) AS n FROM customer UNION ALL
SELECT 'list', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) UNION ALL
SELECT 'spec', count(*) FROM customer WHERE c_acctbal > 0 UNION ALL
SELECT 'empty list', 0""",
)
def materialize_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted kind of source, counted."""
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    spec = SourceSpec(tables={"c": published(spark, sf_dir, "customer")}, where="c_acctbal > 0")
    sources = {"frame": customer, "list": [customer, supplier], "spec": spec, "empty list": []}
    return union_all(
        [
            materialize(spark, source, empty_schema="c_custkey bigint")
            .agg(F.count("*").alias("n"))
            .select(F.lit(kind).alias("kind"), "n")
            for kind, source in sources.items()
        ]
    )


@query(
    "union_by_name",
    """SELECT user_id, event_id, value, CAST(NULL AS VARCHAR) AS props FROM events
UNION ALL SELECT user_id, event_id, NULL, props FROM events""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return union_all([events.select("user_id", "event_id", "value"), events.select("props", "event_id", "user_id")])


@query(
    "union_many",
    """SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, NULL AS size FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part""",
)
def union_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [
            table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_nationkey AS nation"),
            table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS key", "s_name AS name"),
            table(spark, sf_dir, "part").selectExpr("p_partkey AS key", "p_name AS name", "p_size AS size"),
        ]
    )
