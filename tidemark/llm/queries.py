"""Registered queries of this subpackage: each operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    differencing,
    fill_in_middle,
    html_text,
    importance,
    language_id,
    packing,
    quality_classifier,
    quality_rules,
    sentence_piece,
    simhash,
    token_files,
    topk,
    warc,
)
from .common import WORD, table

Query = Callable[[SparkSession, str], DataFrame]


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.measure(documents).select("doc_id", "quality.*").drop("failed")


def classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(documents, table(spark, sf_dir, "labels"))
    scored = quality_classifier.scored(model, F.col("text"), F.col("lang"), F.col("source"))
    return documents.select("doc_id", scored.alias("q")).select("doc_id", "q.*")


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_every(table(spark, sf_dir, "embeddings"))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = sentence_piece.decode(sentence_piece.encode(table(spark, sf_dir, "documents"), model), model)
    return found.select("doc_id", "n_pieces", "ids_crc32", F.crc32("text").alias("text_crc32"), F.length("text").cast("long").alias("n_chars"))


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predicted(model, F.col("text"))
    return documents.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), found.alias("p")
    ).select("doc_id", "held_out", "p.*")


def near_equal_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transform(table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50)
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    digests = {"output_sha256": F.sha2(F.col("output").cast("binary"), 256), "restored_sha256": F.sha2(text.cast("binary"), 256)}
    return found.withColumns(digests).drop("output")


def importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": best_fit_packing,
    "op2_simhash": near_copies,
    "op3_warc": archives,
    "op4_html_text": main_text,
    "op5_quality_rules": rules,
    "op6_quality_classifier": classifier,
    "op7_exact_top_k": top_k,
    "op8_sentence_piece": pieces,
    "op9_token_files": token_ids,
    "op10_language_id": languages,
    "op11_window_packing": near_equal_windows,
    "op12_fill_in_middle": middles,
    "op13_importance_resampling": importance_draw,
}

STOPS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
#: Lists of rules as SQL conditions, all of which must hold.
VERDICT = " AND ".join(rule.sql() for rule in quality_rules.RULES)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE: dict[str, str] = {
    "op3_warc": """
        WITH bytes AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
        ), hashed AS (
            SELECT page_id, payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS head FROM bytes
        ), bits AS (
            SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda d: right(bin(16 + strpos('0123456789abcdef', d) - 1), 4)), '') AS b
            FROM hashed
        )
        SELECT page_id, payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT + 4 * substr(b, 5 * i + 3, 1)::INT
                + 2 * substr(b, 5 * i + 4, 1)::INT + substr(b, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
            CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
        FROM bits
    """,
    "op5_quality_rules": rf"""
        WITH words AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) > 2
        ), seen AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM seen WHERE n > 1) GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM words
        ), figures AS (
            SELECT doc_id, len(w) AS n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                len(list_filter(w, lambda x: lower(x) IN ({STOPS}))) AS n_stop_words, len(l) AS n_lines
            FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
        ), base AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
        )
        SELECT *, NOT base_failed AND {VERDICT} AS kept FROM base
    """,
    "op7_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS place FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scored AS (
            SELECT q.place, q.vec_id AS query_id, v.vec_id, list_dot_product(q.v, v.v)::BIGINT AS score
            FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.place <> v.place
        ), ranked AS (
            SELECT query_id, (row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_fill_in_middle": r"""
        WITH lines AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
                sha256('7:' || doc_id) AS d
            FROM documents
        ), draws AS (
            SELECT *, len(l) AS n, ('0x' || d[1:8])::UBIGINT AS h1, ('0x' || d[9:16])::UBIGINT AS h2,
                ('0x' || d[17:24])::UBIGINT AS h3, ('0x' || d[25:32])::UBIGINT AS h4
            FROM lines
        ), cuts AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
                CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 100 THEN 'plain'
                    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM draws
        ), parts AS (
            SELECT *, array_to_string(list_slice(l, 1, a), '') AS p, array_to_string(list_slice(l, a + 1, b), '') AS m,
                array_to_string(list_slice(l, b + 1, n), '') AS s
            FROM cuts
        )
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM parts
    """,
    "op13_importance_resampling": rf"""
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
                lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
        ), texts AS (
            SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
        ), words AS (
            SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{importance.WORD}') AS w FROM texts
        ), places AS (
            SELECT side, doc_id, unnest(w) AS w FROM words
        ), counted AS (
            SELECT side, doc_id, w, count(*) AS c FROM places GROUP BY ALL
        ), spelled AS (
            SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM counted)
        ), hashed AS (
            SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)),
                lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) % 10000 AS bucket
            FROM spelled, crc_table
        ), buckets AS (
            SELECT bucket, coalesce(sum(c) FILTER (side = 0), 0) AS s, coalesce(sum(c) FILTER (side = 1), 0) AS t
            FROM counted JOIN hashed USING (w) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
            FROM buckets
        ), weights AS (
            SELECT doc_id, sum(c * gain)::BIGINT AS weight FROM counted JOIN hashed USING (w) JOIN gains USING (bucket)
            WHERE side = 0 GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
                + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM words LEFT JOIN weights USING (doc_id) WHERE side = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
                count(*) OVER (PARTITION BY n_features >= 20) AS n
            FROM scored
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
            CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank
        FROM ranked
    """,
}
