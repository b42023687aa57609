"""Registered queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidemark.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op2_": {"doc_id", "fingerprint", "component_id"},
    "op3_": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op4_": {"page_id", "url", "text", "n_chars"},
    "op5_": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op6_": {"doc_id", "score", "kept"},
    "op7_": {"query_id", "rank", "vec_id", "score"},
    "op8_": {"doc_id", "n_pieces", "ids_crc32"},
    "op9_": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op10_": {"doc_id", "held_out", "lang_pred", "score"},
    "op11_": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op12_": {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"},
    "op13_": {"doc_id", "n_features", "weight", "score", "rank"},
}


def test_every_operator_is_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(n.partition("_")[0] + "_" for n in names) == sorted(COLUMNS)
    assert {"op3_warc", "op5_quality_rules", "op7_exact_top_k", "op12_fill_in_middle", "op13_importance_resampling"} <= set(oracle_sql())


def test_queries_return_a_row_per_row_and_the_agreed_columns(spark):
    count = {t: table(spark, SF_DIR, t).count() for t in ("documents", "pages")}
    for name, query in queries().items():
        prefix = name.partition("_")[0] + "_"
        if prefix in COLUMNS:
            df = query(spark, SF_DIR)
            assert COLUMNS[prefix] <= set(df.columns)
            if prefix not in ("op1_", "op7_", "op11_"):
                assert df.count() == count["pages" if "page_id" in df.columns else "documents"], name


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = table(spark, SF_DIR, "documents").cache()
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SF_DIR).cache()
        assert after.columns == docs.columns, name
        assert 0.75 * now.count() <= after.count() <= now.count(), name
        now = after
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR)
    assert packed.select("doc_id").distinct().count() == now.count()
