"""Quality rules, quality classifier and language identification."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, quality_classifier, quality_rules

WORDS = {
    "en": "the of and that with was thing other under seven morning water house".split(),
    "de": "der die und nicht mit war eine dinge andere unter sieben wasser häuser".split(),
}


def prose(language: str, n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS[language]) + draw.choice(["", "s", "e", "en"]) for _ in range(n))


def expected(text: str | None) -> dict:
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def test_rules_measure_like_brute_force(documents):
    draw = random.Random(5)
    texts = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "x\ny\nx\n\n \nx", "é è # * <>", "a a a a a a"]
    texts += [" ".join(draw.choice("ab c d\n# é") for _ in range(draw.randrange(200))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, "")]
    df = documents(*rows)
    quality = "quality_"
    found = quality_rules.measure(df)
    assert found.columns == [*df.columns, quality]
    for row in found.select("text", f"{quality}.*").collect():
        wanted = expected(row["text"])
        assert {k: row[k] for k in wanted} == wanted, row["text"]
        assert not (row["base_failed"] and row["kept"])


def test_rules_compare_windows_whole_where_places_do_not_fit(documents, monkeypatch):
    monkeypatch.setattr(quality_rules, "PLACE_BITS", 3)
    text = "a b c d e f a b c " + prose("en", 30, 1) + " a b c"
    row = quality_rules.measure(documents((1, text))).select("quality_.*").first()
    assert row["n_repeat_words"] == expected(text)["n_repeat_words"]


def test_rules_use_no_python(documents):
    plan = quality_rules.measure(documents((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_languages_are_told_apart_and_strange_text_is_rejected(documents):
    rows = [(i, prose(lang, 60, i), lang, "s") for i in range(60) for lang in ("en", "de")]
    model = language_id.fit(documents(*rows, (900, None, "en"), (901, "x", None)))
    assert model.languages == ["de", "en"]
    df = documents((1, prose("en", 9, 77)), (2, prose("de", 9, 78)), (3, None), (4, "12 ..."), (5, "Ωμέγα ψυχή ξένος"), (6, ""))
    found = {r["doc_id"]: r["p"] for r in df.select("doc_id", language_id.predicted(model, F.col("text")).alias("p")).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 4, 6)] == ["en", "de", "und", "und", "und"]
    assert [found[i]["rejected"] for i in (1, 2, 3, 4, 5, 6)] == [False, False, True, True, True, True]
    assert all(0 <= p["score"] <= 1 for p in found.values())


def test_languages_without_any_to_learn_from(documents):
    model = language_id.fit(documents((1, "abc")))
    row = documents((1, "abc")).select(language_id.predicted(model, F.col("text")).alias("p")).first()["p"]
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_grams_of_long_texts_are_counted_whole(monkeypatch):
    text = prose("de", 500, 3)
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "SLICE", 64)
    assert (language_id.gram_counts(text) == whole).all()


def test_classifier_learns_and_keeps_good_documents(spark, documents):
    good = [(i, prose("en", 80, i), "en", "s1") for i in range(120)]
    bad = [(1000 + i, " ".join(f"{w}***" for w in prose("en", 80, i).split()), "en", "s2") for i in range(120)]
    df = documents(*good, *bad, (5000, None), (5001, "", None, None))
    labels = spark.createDataFrame(
        [(r[0], 1) for r in good[:60]] + [(r[0], 0) for r in bad[:60]] + [(good[0][0], None)], "doc_id long, quality int"
    )
    model = quality_classifier.fit(df, labels)
    scored = df.select("doc_id", quality_classifier.scored(model, F.col("text"), F.col("lang"), F.col("source")).alias("q"))
    found = {r["doc_id"]: r["q"] for r in scored.collect()}
    assert len(found) == 242
    assert sum(found[r[0]]["kept"] for r in good) >= 119
    assert sum(found[r[0]]["kept"] for r in bad) <= 1
    assert all(0 <= q["score"] <= 1 for q in found.values())


def test_classifier_with_one_kind_of_label_keeps_all(spark, documents):
    df = documents((1, "a"), (2, None))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    model = quality_classifier.fit(df, labels)
    scored = df.select(quality_classifier.scored(model, F.col("text"), F.col("lang"), F.col("source")).alias("q"))
    assert [r["q"]["kept"] for r in scored.collect()] == [True, True]


def test_copies_and_missing_ids_do_not_fill_the_samples(spark):
    rows = [(1, prose("en", 40, 0), "en")] * 300
    rows += [(i, prose(lang, 40, i), lang) for i in range(2, 60) for lang in ("en", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("a"))
    model = language_id.fit(df, per_language=20)
    assert model.languages == ["de", "en"]
    assert [p[0] for p in model.predict([prose("de", 40, 99), prose("en", 40, 98)])] == ["de", "en"]
    nameless = df.withColumn("doc_id", F.lit(None).cast("long"))
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    assert quality_classifier.fit(df.union(nameless), labels).learned
    assert not quality_classifier.fit(nameless, labels).learned


def test_noise_and_unlearned_languages_are_rejected(documents):
    docs = documents(*[(i, prose(lang, 40 + i, i), lang, None) for i, lang in enumerate(sorted(WORDS) * 30)])
    model = language_id.fit(docs)
    draw = random.Random(1)
    noise = " ".join("".join(draw.choice("bcdfghjklmnpqrstvwxyz") for _ in range(draw.randrange(2, 9))) for _ in range(300))
    rows = [(1, noise), (2, "Наступного місяця набудуть чинності нові правила " * 5), (3, prose(sorted(WORDS)[0], 300, 99)), (4, None), (5, "12 34")]
    found = documents(*rows).select("doc_id", language_id.predicted(model, F.col("text")).alias("p")).collect()
    assert {r["doc_id"]: r["p"]["rejected"] for r in found} == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_every_language_is_learned_or_the_job_fails(documents):
    docs = documents(*[(i, f"text of language {i}", f"l{i}", None) for i in range(30)])
    assert len(language_id.fit(docs, most_languages=30).languages) == 30
    with pytest.raises(ValueError, match="more than 29 languages"):
        language_id.fit(docs, most_languages=29)


def test_document_frequencies_cover_all_rows(documents):
    texts = ["abc abc", "abd", None, "", "12", "x" * 3000, "abc"]
    n, seen = language_id.document_frequencies(documents(*enumerate(texts)))
    assert n == 4
    assert (seen == sum((language_id.gram_counts(t) > 0).astype(int) for t in texts if language_id.has_letter(t))).all()
