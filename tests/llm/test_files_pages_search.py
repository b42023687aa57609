"""Archives, token files, page text, exact search and pieces."""

from __future__ import annotations

import gzip
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.errors import PySparkException
from tokenizers import Tokenizer

from tidemark.llm import html_text, sentence_piece, token_files, tokens, topk, warc
from tidemark.llm.files import chunks
from tidemark.sources.tables import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_archives_come_back_whole(spark):
    rows = [(1, "http://a/", "x"), (5, None, "x"), (3, "http://b\n/", "x"), (4, "u", None), (2, "u", ""), (7, "ü", "é" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in found.items()} == {
        1: ("revisit", 5), 3: ("revisit", 5), 5: ("response", None), 4: ("response", None), 2: ("revisit", 4), 7: ("response", None),
    }
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert (found[page_id]["payload_bytes"], found[page_id]["payload_digest"]) == (len(data), warc.digest(data))
        assert found[page_id]["payload"] in (None, data)
    assert {r["record_type"] for r in warc.round_trip(pages, least_bytes=2).collect()} == {"response"}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archive_is_one_member_per_record_and_is_verified(spark):
    pages = spark.createDataFrame([(1, "u", "first"), (2, "u", "second")], "page_id long, url string, html string")
    files = warc.write(pages.coalesce(1), scratch_path(spark, "warc")).collect()
    assert sum(f["records"] for f in files) == 2
    data = b"".join(chunks(files[0]["file"]))
    assert gzip.decompress(data).startswith(b"WARC/1.0\r\n")
    one_by_one = [data[i : i + 1] for i in range(len(data))]
    assert [r.payload for r in warc.records(one_by_one)] == [r.payload for r in warc.records([data])]
    with pytest.raises(warc.WarcError):
        list(warc.records([data[:-9]]))
    record = warc.record(1, "u", b"payload", None)
    for broken in (record.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"), record.replace(b"WARC/1.0", b"WARC/9.9"), record[:-2]):
        with pytest.raises(warc.WarcError):
            warc.parsed(broken)


def test_token_files_come_back_in_order(spark, documents):
    rows = [(9, "nine words \n\n of text"), (2, None), (5, ""), (7, "ünï " * 500), (7, "ünï " * 500), (1, "a")]
    plain = Tokenizer.from_file(BYTES)
    start = 0
    wanted = []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_files.round_trip(documents(*rows), BYTES).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == wanted
    assert token_files.round_trip(documents(), BYTES).count() == 0


def test_one_document_is_read_alone(spark, documents):
    df = documents(*[(i, f"document number {i} " * 20) for i in range(300)])
    files, dictionary = token_files.write(df, scratch_path(spark, "tokens"), BYTES, file_bytes=4000)
    assert dictionary
    listed = files.orderBy("part", "seq").collect()
    assert sum(f["docs"] for f in listed) == 300
    file = token_files.TokenFile(listed[0]["file"], dictionary)
    assert [file.ids(k) for k in range(len(file.index))] == [ids for _, ids in file.all()]
    with pytest.raises(ValueError):
        token_files.TokenFile(listed[0]["file"], b"another")


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>'
    '<nav><a href="/">Home</a></nav><div id="cookie-bar">We use cookies</div><div class="post-{n} content"><h1>A &amp; B{n}</h1>'
    "<p>First   paragraph that is long enough &#233;t&eacute;.<br>still it <p>Second <b>bold</b>text<script>x('</p>')</script>"
    "<ul><li>one<li>two</ul></div><div class=sidebar>Side</div><form>Search <input></form>"
    '<section class="comments"><p>A comment that is longer than the article itself, on and on and on, for ever and ever, amen, amen, amen.</p>'
    "</section><footer>&copy;</footer></body></html>"
)
TEXT = "A & B{n}\n\nFirst paragraph that is long enough été. still it\n\nSecond boldtext\n\none\n\ntwo"


def test_pages_give_their_article_alone(spark):
    rows = [(i, f"http://H.example/{i}", PAGE.replace("{n}", str(i))) for i in range(4)] + [(8, None, None), (9, "x", "")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = {r["page_id"]: r for r in html_text.main_text(pages).collect()}
    assert {i: found[i]["text"] for i in range(4)} == {i: TEXT.replace("{n}", str(i)) for i in range(4)}
    assert (found[8]["text"], found[9]["n_chars"]) == ("", 0)
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_a_page_follows_its_host(spark):
    odd = "<html><body><div class='content'><p>The article, short.</p></div><div class='x'><p>A long aside, longer than the article.</p></div></body></html>"
    path = "html/body/div.content"
    assert html_text.extract(odd, []) == "A long aside, longer than the article."
    assert html_text.extract(odd, [path]) == "The article, short."
    pages = [(i, "http://h/", "<html><body><div class='content'><p>Some article text of a page.</p></div></body></html>") for i in range(3)]
    winners = html_text.winning_paths(spark.createDataFrame(pages, "page_id long, url string, html string")).first()
    assert (winners["host"], winners["paths"][0]) == ("h", path)


def test_an_article_is_whole():
    def text(n: int) -> str:
        return ("word " * n)[: n - 1] + "."

    title, lead, body, more = text(50), text(80), text(2000), text(300)
    lead_and_body = f"<div class=lead><p>{lead}</p></div><div class=body><p>{body}</p></div>"
    links = "<ul><li><a href=x>A link</a><li><a href=y>Another</a></ul>"
    pages = {
        f"<body><article><h1>{title}</h1>{lead_and_body}</article><div><p>{more}</p></div></body>": [title, lead, body],
        f"<body><article><section><p>{body}</p></section><section><p>{more}</p></section></article></body>": [body, more],
        f"<body><div id=a>{links}<div class=x><p>{body}</p></div><div class=y><p>{more}</p></div></div></body>": [body, more],
        f"<body><section><p>{body}</p></section><section><p>{more}</p></section></body>": [body, more],
        f"<body><form><div class=widget><article><h1>{title}</h1>{lead_and_body}</article></div></form></body>": [title, lead, body],
    }
    for page, wanted in pages.items():
        assert html_text.extract(page, []) == "\n\n".join(wanted), page
        for path, _ in html_text.votes(page, 1):
            assert html_text.extract(page, [path]) == "\n\n".join(wanted), (path, page)


@pytest.mark.parametrize("page", ["<", "<p", "<a href='x", "</", "<!--", "<p><p></b></i>", "<script>", "a < b > c &amp", "<table><td>x<tr><td>y"])
def test_broken_pages_do_not_fail(page):
    html_text.extract(page, [])


def test_search_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(400, 12)).astype(np.float32)
    vectors[50:80] = vectors[0]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, [float("nan")] * 12), (1100, []), (50, vectors[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in topk.search_every(df).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(256 * vectors.astype(np.float64)).astype(int)
    ids = np.array([*range(400), 50])
    whole = np.vstack([whole, whole[50:51]])
    wanted = {}
    for at in [*range(0, 400, 50), 400]:  # the row that repeats 50 asks as well, and both are candidates of the other
        scores = whole @ whole[at]
        order = [i for i in np.lexsort((ids, -scores)) if i != at][:5]
        wanted.setdefault(int(ids[at]), []).extend((n + 1, int(ids[i]), int(scores[i])) for n, i in enumerate(order))
    assert {q: sorted(rows) for q, rows in found.items()} == {q: sorted(rows) for q, rows in wanted.items()}
    assert topk.search_every(df.limit(0)).count() == 0


def test_rows_of_one_id_ask_each_and_large_products_are_exact(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [3.0, 2.0]), (2, [0.5, 4.0])]
    found = topk.search_every(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in found.collect()) == sorted(
        [(50, 1, 3 << 16), (50, 2, 1 << 15), (50, 50, 0), (50, 2, 4 << 16), (50, 1, 2 << 16), (50, 50, 0)]
    )
    draw = random.Random(2)
    big = [(i, [draw.randrange(-(2**30), 2**30) for _ in range(3)]) for i in range(40)]
    vectors = spark.createDataFrame(big, "vec_id long, v array<long>")
    best = topk.search(vectors, vectors.withColumnRenamed("vec_id", "query_id"), 1).collect()
    for r in best:
        v = dict(big)[r["query_id"]]
        assert r["score"] == max(sum(x * y for x, y in zip(v, w)) for _, w in big)
    huge = spark.createDataFrame([(0, [2**40, 2**40]), (1, [2**30, 1])], "vec_id long, v array<long>")
    with pytest.raises(PySparkException, match="may not fit 64 bits"):
        topk.search(huge, huge.withColumnRenamed("vec_id", "query_id"), 1).collect()


def test_ids_that_do_not_fit_are_refused():
    assert token_files.id_width(BYTES) == 2
    assert token_files.packed(np.array([70_000], "<u4").tobytes(), 4) == np.array([70_000], "<u4").tobytes()
    with pytest.raises(ValueError, match="70000 does not fit"):
        token_files.packed(np.array([1, 70_000], "<u4").tobytes(), 2)


PARAGRAPHS = "".join(f"<p>{'word ' * 60}</p>" for _ in range(5))


@pytest.mark.parametrize(
    "page",
    [
        f'<body><div class="elementor-widget elementor-widget-text-editor">{PARAGRAPHS}</div><div>Copyright 2024</div></body>',
        f"<body><div id=main class=section-comment>{PARAGRAPHS}</div>tail</body>",
        f"<body><article><h1>T</h1><section id=related-work>{PARAGRAPHS}</section></article></body>",
    ],
)
def test_an_article_is_not_lost_for_the_name_around_it(page):
    assert html_text.extract(page, []).count("word") == 300


@pytest.mark.parametrize("tag", ["div", "b", "blockquote", "ul", "article"])
def test_deep_pages(tag):
    deep = f"<{tag}>" * 100_000
    assert html_text.extract(f"{deep}deep text {'word ' * 40}", []).count("word") == 40
    ended = f"{deep}<p>{'word ' * 40}</p>{f'</{tag}>' * 100_000}<p>tail"
    assert html_text.extract(ended, []).count("word") == 40
    html_text.votes(ended)  # no crash; inline elements alone are no containers


def test_search_in_many_blocks_equals_one(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.integers(-99, 99, 8).tolist()) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    queries = vectors.where("vec_id < 40").withColumnRenamed("vec_id", "query_id")
    one = topk.search(vectors, queries, 3)
    many = topk.search(vectors, queries, 3, block_rows=50, block_queries=16)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_pieces_equal_the_library(documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["  Hello  wörld \n x\t☃ ", "   ", "日本語 한국어 😀😀", "a" * 300, "▁x ▁", "    def f(x):\n        return", "1234 +1 (168)", "ﷺ\x00z", "---===####****"]
    rows = [*enumerate(texts), (90, None), (91, ""), (0, texts[0])]
    encoded = sentence_piece.encode(documents(*rows), PIECES)
    decoded = {r["doc_id"]: r for r in sentence_piece.decode(encoded, PIECES).collect()}
    for r in encoded.collect():
        wanted = library.encode(dict(rows)[r["doc_id"]] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == wanted
        assert decoded[r["doc_id"]]["text"] == library.decode(wanted)


def test_parts_of_a_slice_are_looked_up_once(monkeypatch):
    encode = tokens.TextEncoder(BYTES, True)
    asked, whole = Counter(), encode.tokenizer.encode

    def made(parts, part, made=tokens.Parts.made):
        asked[parts.before + part] += 1
        return made(parts, part)

    monkeypatch.setattr(tokens.Parts, "made", made)
    monkeypatch.setattr(tokens, "LONGEST_KEPT", -1)  # nothing is kept
    texts = ["the dog\nthe cat", None, "", "the the dog", " the", "dog\n\nthe", "a\rb", "\n", "the", "été \U0001f600\nx"] * 20
    wanted = [np.array(whole(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode.encode(texts) == wanted and max(asked.values()) == 1
