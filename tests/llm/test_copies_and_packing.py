"""Near copies, components and packing."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, simhash
from tidemark.llm.graph import components
from tidemark.llm.tokens import TextEncoder


def union(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_fingerprint(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_copies_equal_brute_force(documents):
    draw = random.Random(3)
    base = [draw.choice(["Wort", "thing", "été", "A", "b"]) + str(draw.randrange(50)) for _ in range(300)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two")]
    for i in range(40):
        words = list(base)
        for _ in range(i // 4):
            words[draw.randrange(300)] = "new"
        rows.append((100 - i, " ".join(words)))
    found = simhash.near_copies(documents(*rows)).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    links = [(i, k) for i in range(len(rows)) for k in range(i) if (prints[i] ^ prints[k]).bit_count() <= 3]
    groups = defaultdict(list)
    for i, root in union(links, range(len(rows))).items():
        groups[root].append(i)
    wanted = sorted((rows[i][0], f"{prints[i]:016x}", min(rows[k][0] for k in g)) for g in groups.values() for i in g)
    assert sorted(map(tuple, found)) == wanted


def test_large_cells_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    draw = np.random.default_rng(1)
    values = {int(x) for x in draw.integers(0, 1 << 12, 200)}  # three quarters of the bits alike: cells of all rows
    rows = [(v.to_bytes(8, "big"),) for v in sorted(values)]
    links = simhash.near_links(spark.createDataFrame(rows, "f binary"), 3, 64).collect()
    found = union([(bytes(a), bytes(b)) for a, b in links], [r[0] for r in rows])
    near = [(a[0], b[0]) for i, a in enumerate(rows) for b in rows[:i] if (int.from_bytes(a[0], "big") ^ int.from_bytes(b[0], "big")).bit_count() <= 3]
    assert found == union(near, [r[0] for r in rows])


def test_one_row_of_each_group_stays(documents):
    words = [f"w{i}" for i in range(400)]
    near = words[:200] + ["other"] + words[201:]
    df = documents((7, " ".join(words)), (3, " ".join(near)), (9, "clean text alone here now"), (9, "clean text alone here now"), (5, None), (6, ""), (None, "no id"))
    kept = simhash.without_copies(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["3", "5", "9", "None"]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(1, i) for i in range(2, 60)] + [(70, 70), (None, 3)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(101, 131)}, **{i: 1 for i in range(2, 60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_parts_give_the_ids_of_the_whole():
    texts = ["a\tb  c\n\n d", "  x  ", "İstanbul Σας", "it's I'LL we'd 12 ½", "́a x ́y", "日本 語\n한국", "a\r\nb", "\n", "a \n b", "<|endoftext|>", "x*** y!!", "a\x1cb \x85c", "q" * 200]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        plain = Tokenizer.from_file(path)
        plain.encode_special_tokens = True
        encoder = TextEncoder(path, spaced)
        for text, ids in zip(texts * 2, encoder.encode(texts * 2)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packing_is_whole_gapless_and_tight(documents):
    draw = random.Random(8)
    texts = [" ".join(["word"] * draw.randrange(1, 60)) for _ in range(300)] + [" ".join(["word"] * 250), None, ""]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    found = packing.pack(documents(*rows), public_tokenizers.path("word_bpe_49k.json"), capacity=100, search=packing.Search(shard_items=64)).collect()
    wanted = sorted((d, len((t or "").split()) + 1) for d, t in rows)
    total = defaultdict(int)
    for r in found:
        total[r["doc_id"]] += r["length"]
    assert total[300] == 251 and [r["start"] for r in sorted(found, key=lambda r: r["piece"]) if r["doc_id"] == 300] == [0, 100, 200]
    assert sum(total.values()) == sum(n for _, n in wanted)
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 100
    assert len(places) <= -(-sum(total.values()) // 100) + 2


def test_crossover_keeps_every_item_once():
    draw = np.random.default_rng(4)
    lengths = draw.integers(1, 60, 80).tolist()
    people = packing.evolve(lengths, 100, [], packing.Search(), 1)
    child = packing.crossover(people[0], people[-1], lengths, 100, draw)
    for bins in (child, packing.mutated(child, lengths, 100, draw)):
        assert sorted(i for b in bins for i in b) == list(range(80))
        assert max(sum(lengths[i] for i in b) for b in bins) <= 100
    assert packing.decoded(packing.encoded(child, 80)) == [sorted(b) for b in child]


def test_no_documents(documents):
    df = documents()
    assert packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert simhash.near_copies(df).count() == 0
    assert simhash.without_copies(df).count() == 0


def shingles(text: str) -> set:
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def kept_by_brute_force(rows) -> list:
    sets = [shingles(t) for _, t in rows]
    links = [(i, k) for i in range(len(rows)) for k in range(i) if 5 * len(sets[i] & sets[k]) >= 4 * len(sets[i] | sets[k])]
    groups = defaultdict(list)
    for i, root in union(links, range(len(rows))).items():
        groups[root].append(rows[i][0])
    return sorted(min(g) for g in groups.values())


def test_texts_less_alike_than_the_contract_stay(documents):
    draw = random.Random(11)
    rows = []
    for i in range(60):  # pairs from 0.60 to 0.79 alike: a passage in common, the rest their own
        common = [f"c{i}x{j}" for j in range(200)]
        share = 0.60 + 0.19 * i / 59
        own = round((200 - 4) * (1 / share - 1) / 2)
        rows += [(2 * i + k, " ".join(common + [f"o{i}y{k}z{draw.random()}" for _ in range(own)])) for k in range(2)]
    rows += [(900, "a b c d e " * 9 + "f g"), (901, "a b c d e " * 40)]  # equal fingerprints, sets of 7 and 5
    kept = sorted(r["doc_id"] for r in simhash.without_copies(documents(*rows)).collect())
    assert kept == kept_by_brute_force(rows)
    assert len(kept) >= 120


def test_no_pair_as_alike_as_the_contract_stays(documents, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    draw = random.Random(12)
    rows = []
    for i in range(80):  # 4 and 5 shingles, and longer texts from 0.76 to 0.95 alike
        words = [f"s{i}x{j}" for j in range(9)]
        rows += [(1000 + 2 * i, " ".join(words[:8])), (1001 + 2 * i, " ".join(words))]
        own = round(96 * (1 / (0.76 + 0.19 * i / 79) - 1) / 2)
        common = [f"c{i}x{j}" for j in range(100)]
        rows += [(2000 + 2 * i + k, " ".join(common + [f"o{i}y{k}z{draw.random()}" for _ in range(own)])) for k in range(2)]
    template = [f"t{j}" for j in range(60)]  # a hot passage: texts too different, but for some pairs
    rows += [(3000 + i, " ".join(template + [f"v{i // 2 if i < 10 else i}w{j}" for j in range(30)] + ["end"] * (i % 2))) for i in range(40)]
    kept = sorted(r["doc_id"] for r in simhash.without_copies(documents(*rows)).collect())
    assert kept == kept_by_brute_force(rows)


def test_wide_parity_never_exceeds_the_difference():
    draw = np.random.default_rng(3)
    for n, m, common in ((3000, 3000, 2700), (3000, 2500, 2400), (5000, 4000, 0), (100, 90, 80), (2100, 2000, 2000), (0, 5, 0)):
        pool = np.unique(draw.integers(0, 1 << 63, n + m, dtype=np.uint64))
        x, y = pool[:n], pool[n - common : n - common + m]
        bits = [np.frombuffer(simhash.wide_parity(v), np.uint8) for v in (x, y)]
        distance = simhash.parity_distance(*bits)
        assert distance == simhash.parity_distance(*bits[::-1]) <= n + m - 2 * common
        if not common and n:
            assert distance > (n + m) / 6  # unlike sets of any size are told apart, a ninth is allowed


def test_columns_that_clash_and_many_texts_of_one_template(documents):
    draw = random.Random(4)
    template = [f"t{i}" for i in range(160)]
    rows = []
    for i in range(60):  # each shares about 0.66 of its shingles with every other
        own = [f"o{i}x{k}" for k in range(40)]
        rows.append((i, " ".join(template + own)))
    rows.append((100, rows[7][1] + " tail"))
    df = documents(*rows).withColumns({"gone_id": F.lit("g"), "gone_key": F.lit(1), "copy_id": F.lit(2)})
    kept = simhash.without_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60))


def test_cells_of_the_same_sets_are_one_and_unlike_pairs_need_no_whole_sets(documents, monkeypatch):
    kept = {}

    def stored(df, label, write=simhash.stored):
        kept.setdefault(label, []).append(write(df, label))
        return kept[label][-1]

    monkeypatch.setattr(simhash, "stored", stored)
    passage = " ".join(f"p{i}" for i in range(400))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(200)) + " " + passage) for i in range(4)]
    assert simhash.without_copies(documents(*rows)).count() == 4
    cells = {}
    for row in kept["mixed-members"][-1].collect():
        cells.setdefault(row["cell"], set()).add(bytes(row["key"]))
    assert cells and len(cells) == len({frozenset(c) for c in cells.values()})
    assert [df.count() for df in kept["members-to-check"]] == [0, 0]


def test_texts_in_no_pair_are_not_shuffled(documents, monkeypatch):
    plans, passed = [], []

    def stored(df, label, write=simhash.stored):
        if label in ("parities-to-check", "members-to-check"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    def asked_only(texts, asked, keep=simhash.asked_only):
        found = keep(texts, asked)
        passed.append((asked.count(), {(r["id"], r["h"]) for r in asked.selectExpr("doc_id id", "of_h h").collect()}, [(r["id"], r["h"]) for r in found.collect()]))
        return found

    monkeypatch.setattr(simhash, "stored", stored)
    monkeypatch.setattr(simhash, "asked_only", asked_only)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(100))) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(5)] + [(None, rows[7][1] + " end"), (2, rows[2][1])]
    kept = simhash.without_copies(documents(*rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(400))
    assert any(n for n, _, _ in passed)
    for n, wanted, found in passed:
        assert wanted <= set(found) and len(found) <= n + 3  # a repeated row, and hardly any by chance of so many bits
    assert len(plans) == 4 and all("SortMergeJoin" in p for p in plans)  # not left to how many are asked for
