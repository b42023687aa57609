"""Near-equal windows, fill-in-middle and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import differencing, fill_in_middle, importance

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# Packing


def test_differencing_gives_near_equal_windows():
    draw = np.random.default_rng(5)
    lengths = [int(x) for x in draw.integers(1, 1024, 800)] + [1, 2, 4, 8] * 50
    sums, window = differencing.difference(lengths, 97)
    found = np.bincount(window, weights=lengths, minlength=97)
    assert sorted(found.astype(int), reverse=True) == sums.tolist() and sum(sums) == sum(lengths)
    assert sums[0] - sums[-1] <= 8  # windows of about 4100


def test_more_windows_when_the_capacity_is_exceeded():
    window = differencing.windows_of([6, 6, 6], 10)  # two windows could hold 18
    assert sorted(window.tolist()) == [0, 1, 2]
    assert np.bincount(differencing.windows_of([8, 7, 6, 5, 4], 16), weights=[8, 7, 6, 5, 4]).tolist() == [16, 14]


@given(st.lists(st.integers(1, 64), min_size=1, max_size=60), st.integers(64, 200))
@settings(max_examples=60, deadline=None)
def test_windows_hold_every_piece_within_the_capacity(lengths, capacity):
    window = differencing.windows_of(lengths, capacity)
    assert len(window) == len(lengths)
    assert np.bincount(window, weights=lengths).max() <= capacity


@given(st.integers(1, 30_000), st.sampled_from([4, 100, 4096]), st.booleans())
@settings(max_examples=100, deadline=None)
def test_piece_lengths_add_up(count, capacity, fine):
    found = differencing.piece_lengths(count, capacity, fine)
    assert sum(found) == count and max(found) <= capacity and min(found) > 0


def check_windows(rows, found, capacity, end_id):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(list)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        wanted[doc_id].append(np.array(ids, "<u4").tobytes())
    assert set(pieces) == set(wanted)
    for doc_id, texts in wanted.items():
        ids, got = texts[0], pieces[doc_id]  # rows of one id have one text here
        assert {r.doc_tokens for r in got} == {len(ids) // 4}
        assert sum(r.length for r in got) == len(texts) * len(ids) // 4
        spans = Counter((r.start, r.length) for r in got)
        assert set(spans.values()) == {len(texts)}
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert all(zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for r in got)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_windows_hold_all_ids_once(documents):
    draw = random.Random(2)
    rows = [(1, None), (2, ""), (3, " \n "), (None, "null id"), (5, "x" * 30_000), (6, "long text " * 9000)]
    rows += [(100 + i, " ".join("word" + str(draw.randrange(99)) for _ in range(draw.randrange(1, 400)))) for i in range(150)]
    rows += [(7, "the same row " * 30)] * 40
    found = differencing.pack(documents(*rows), WORD_BPE).collect()
    check_windows(rows, found, 4096, 2)
    sums = Counter()
    for r in found:
        sums[r.sequence_id] += r.length
    assert 4096 * len(sums) - sum(sums.values()) < 2 * 4096


def test_windows_in_many_shards(documents, monkeypatch):
    monkeypatch.setattr(differencing, "SHARD_PIECES", 40)
    rows = [(i, "some words " * (i % 50)) for i in range(300)]
    check_windows(rows, differencing.pack(documents(*rows), WORD_BPE, capacity=256, end_id=9).collect(), 256, 9)


def test_windows_of_an_empty_table(documents):
    found = differencing.pack(documents(), WORD_BPE)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() == 0


# Fill in middle


@given(st.sets(st.one_of(st.integers(0, 400), st.integers(0, 300_000), st.integers(65_000, 66_000)), max_size=300), st.booleans())
@settings(max_examples=100, deadline=None)
def test_boundary_set_selects(values, dense):
    if dense:  # a bitmap and runs
        values = values | set(range(70_000, 70_500)) | set(range(140_000, 160_000, 2))
    order = sorted(values)
    found = fill_in_middle.BoundarySet(np.array(order, np.int64))
    assert len(found) == len(order)
    assert [found.select(k) for k in range(len(order))] == order
    with pytest.raises(IndexError):
        found.select(len(order))


def test_containers_are_the_smallest():
    kinds = [np.array([1, 5, 9]), np.arange(0, 60_000, 2), np.arange(50_000)]
    found = [type(fill_in_middle.container(k.astype(np.uint16))).__name__ for k in kinds]
    assert found == ["ArrayContainer", "BitmapContainer", "RunContainer"]


def brute_middle(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, len(lines), "plain", None, None, text)
    form = "spm" if h4 % 100 < spm else "psm"
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (doc_id, len(lines), form, len(prefix), len(middle), output)


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0)])
def test_middles_equal_brute_force(documents, rate, spm):
    draw = random.Random(4)
    rows = [(1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "no feed"), (6, "a<P>b\nc"), (7, "<M>"), (None, "x\ny\nz")]
    rows += [(8, "é😀\n" * 30_000 + "end"), (9, "y\n" * 100_000), (10, "z" * 2_000_000), (11, "<\nS>\nP><\n" * 5)]
    rows += [(12, "twice\nthe\nsame\nrow")] * 3
    for i in range(200):
        rows.append((100 + i, "".join(draw.choice(["\n", "é", "a", " ", "<", "S>", "😀", "\r\n", " "]) for _ in range(i))))
    df = fill_in_middle.transform(documents(*rows), 7, rate, spm)
    text = fill_in_middle.restored(df["output"], df["form"])
    found = df.withColumn("text", text).collect()
    assert sorted(map(repr, (tuple(r)[:-1] for r in found))) == sorted(map(repr, (brute_middle(*r, 7, rate, spm) for r in rows)))
    assert Counter((r.doc_id, r.text) for r in found) == Counter((i, t or "") for i, t in rows)


def test_middles_of_an_empty_table(documents):
    assert fill_in_middle.transform(documents(), 7).count() == 0


# Importance


def brute_draw(rows, target, n, buckets=10_000, percent=10, least=20, seed=2024):
    def runs(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        out = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in out]

    mine = [(doc_id, *runs(t)) for doc_id, t in rows]
    s, t = Counter(b for r in mine for b in r[2]), Counter(b for x in target for b in runs(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for doc_id, n_words, found in mine:
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in found
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, n_words])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(order[: percent * len(order) // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("n", [1, 3])
def test_draw_equals_brute_force(spark, documents, n):
    draw = random.Random(6)
    vocabulary = ["Straße", "THE", "the", "ünï", "x1", "日本", "İ", "a-b", "don't", "99"] + [f"w{i}" for i in range(200)]
    rows = [(1, None), (2, ""), (3, " \n,.;"), (4, "one"), (None, "word " * 25), (5, "long text " * 100_000)]
    rows += [(6, "the same row many times over " * 5)] * 50
    for i in range(400):
        rows.append((1000 - i, draw.choice([" ", ", ", "\n\n", "\x00"]).join(draw.choices(vocabulary, k=draw.randrange(60)))))
    target = [None, "", *(" ".join(draw.choices(vocabulary[:40], k=30)) for _ in range(30))]
    wanted = spark.createDataFrame([(t, 1.0) for t in target], "text string, weight double")
    found = importance.resample(documents(*rows), wanted, n=n, percent=30)
    assert Counter(map(tuple, found.collect())) == brute_draw(rows, target, n, percent=30)


@pytest.mark.parametrize("texts", [["One two", "THREE four", "Five six", "\xc9t\xe9 7"], ["One", None, "Two\x00a", None, "\U0001f600 Z"]])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_slices(texts, kind):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, kind)], names=["text"])
    word = re.compile(importance.WORD)
    wanted = [word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    found, sizes = [], []
    for part in importance.slices([batch], "text", most_bytes=9):
        encoded, counts = importance.words(part.column("text"))
        found += encoded.to_pylist()
        sizes += counts.tolist()
    assert found == [w for some in wanted for w in some] and sizes == [len(some) for some in wanted]


def test_draw_of_empty_tables(spark, documents):
    empty = spark.createDataFrame([], "text string")
    assert importance.resample(documents(), empty).count() == 0
    rows = [(i, "some words in a row that are more than twenty " * 3) for i in range(20)]
    found = importance.resample(documents(*rows), empty).collect()
    assert Counter(map(tuple, found)) == brute_draw(rows, [], 1)
    assert sorted(r.rank for r in found if r.rank) == [1, 2]
