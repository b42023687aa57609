"""Main text of web pages by paths that the pages of a host agree on.

Every page scores its containers by the running text in them and votes for its best ones under a generalised path of
tags and classes. Spark counts the votes per host and path. Each page is then extracted again from all containers on the
best winning path that it has; a page without any uses its own best path. A container is widened to the article that it
lies in, or else to parents that add running text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored, text_batches

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^<>"']*(?:(?:"[^"]*"|'[^']*')[^<>"']*)*)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S)
NAME_PART = re.compile(r"[a-z]+")

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
DROPPED = frozenset(
    "script style textarea title xmp noembed noframes iframe head nav footer aside form noscript template svg math canvas "
    "object embed video audio map dialog menu button select option input label fieldset datalist applet".split()
)
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CONTAINERS = frozenset("article main section div td body html center blockquote table tbody tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "li", "dd", "dt", "tbody", "thead", "tfoot", "caption"}
# An element of the first kind ends open ones of the second, up to one of the third.
IMPLIED = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
SCOPES = frozenset("html body table td th article section div main aside nav header footer form ul ol blockquote button".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notification alert popup modal overlay sidebar widget menu nav navbar navigation breadcrumb breadcrumbs topbar "
    "toolbar footer masthead comment comments commentlist disqus respond reply replies share sharing social related "
    "recommended recommendations newsletter subscribe subscription signup login search pagination pager copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Dropped elements that may hold a page's article all the same.
WRAPPERS = frozenset("form fieldset dialog".split())
WIDER = frozenset("article main section div center blockquote".split())
#: Words beside which those above say nothing.
UNLESS = frozenset("has with without no work works".split())


@dataclass(slots=True)
class Node:
    tag: str
    names: str
    parent: Node | None
    dropped: bool = False
    wrapper: bool = False
    children: list = field(default_factory=list)
    score: float = 0.0


#: Elements nested deeper than this are taken apart: their content belongs to the element at that depth.
DEEPEST = 250
#: Share of a page's running text.
NEARLY_ALL = 0.8


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), double or single or bare)
    return out


def is_hidden(found: dict[str, str]) -> bool:
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    return "display:none" in found.get("style", "").replace(" ", "").lower()


def is_boilerplate(tag: str, found: dict[str, str]) -> bool:
    if tag in ("html", "body", "main"):
        return False
    if found.get("role", "").lower() in ROLES or is_hidden(found):
        return True
    for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
        parts = NAME_PART.findall(name)
        if BOILERPLATE.intersection(parts) and not UNLESS.intersection(parts):
            return True
    return False


def class_path(found: dict[str, str]) -> str:
    """Classes without their digits, in order of the alphabet."""
    names = sorted({re.sub(r"\d+", "0", name) for name in found.get("class", "").lower().split()})
    return "".join(f".{name}" for name in names[:3])


def parse(page: str) -> Node:
    """The tree of a page, missing end tags implied; text is left as it is."""
    root = Node("", "", None)
    top, at, scanner = root, 0, TAG.finditer(page)
    skip_to = 0
    depth, flat = {id(root): 0}, Counter()
    for match in scanner:
        start = match.start()
        if start < skip_to:
            continue
        if start > at:
            top.children.append(page[at:start])
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        tag, closing, rest = name.lower(), match[1] or match[4], match[3] if match[2] else match[6]
        if closing:
            if flat[tag]:  # the end of an element too deep to be kept
                flat[tag] -= 1
                continue
            node = top
            while node.parent is not None and node.tag != tag:
                if node.tag in SCOPES and tag not in SCOPES:
                    node = root
                    break
                node = node.parent
            if node.parent is not None:
                top = node.parent
            continue
        if tag in CLOSES_P:
            node = top
            while node.parent is not None and node.tag not in SCOPES and node.tag != "p":
                node = node.parent
            if node.tag == "p":
                top = node.parent
        if tag in IMPLIED:
            ended, until = IMPLIED[tag]
            node, found = top, None
            while node.parent is not None and node.tag not in until:
                if node.tag in ended:
                    found = node
                node = node.parent
            if found is not None:
                top = found.parent
        if depth[id(top)] >= DEEPEST and tag not in RAW and tag not in VOID:
            if not rest.endswith("/"):
                flat[tag] += 1
            if tag in BLOCKS:
                top.children.append(Node("hr", "hr", top))  # what follows is a block of its own
            continue
        own = attributes(rest) if rest.strip(" /\n\t") else {}
        node = Node(tag, tag + class_path(own), top, tag in DROPPED or bool(own) and is_boilerplate(tag, own))
        node.wrapper = node.dropped and (tag in WRAPPERS or tag not in DROPPED) and not is_hidden(own)
        top.children.append(node)
        depth[id(node)] = depth[id(top)] + 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = skip_to = end.start() if end else len(page)
            top = node
        elif tag not in VOID and not rest.endswith("/"):
            top = node
    if at < len(page):
        top.children.append(page[at:])
    keep_article(root)
    return root


def keep_article(root: Node) -> None:
    """Dropped elements around the page's main element or its longest article with a title are no boilerplate.

    Without such an element, neither is one that was dropped for its name alone though it holds nearly all running text.
    """
    found: list[tuple[bool, int, Node]] = []
    named: list[tuple[int, Node]] = []

    def walk(node: Node, linked: bool) -> tuple[int, int]:
        """Characters of text, and of running text outside of anything dropped."""
        chars = running = 0
        for child in node.children:
            if isinstance(child, str):
                n = len(child.strip())
                chars, running = chars + n, running + n * (not linked)
            elif not child.dropped or child.wrapper:
                inner, own = walk(child, linked or child.tag == "a")
                if child.tag in ("article", "main") and not child.dropped and (child.tag == "main" or has_heading(child)):
                    found.append((child.tag == "main", inner, child))
                chars += inner
                if child.dropped:
                    named.append((own, child))
                else:
                    running += own
        return chars, running

    kept = walk(root, False)[1]
    node = max(found, key=lambda x: x[:2])[2] if found else None
    if node is None and named:
        most, node = max(named, key=lambda x: x[0])
        if node.tag in DROPPED or most < NEARLY_ALL * (kept + most):
            node = None
    while node is not None:
        node.dropped = False
        node = node.parent


def has_heading(node: Node) -> bool:
    return any(not isinstance(c, str) and (c.tag == "h1" or has_heading(c)) for c in node.children)


def article_header(node: Node) -> bool:
    """Does a header belong to an article, so that its headings are text? One on top of the page does not."""
    above = node.parent
    while above is not None:
        if above.tag in ("article", "main"):
            return True
        above = above.parent
    return node.parent.tag not in ("", "html", "body") and has_heading(node)


def blocks(node: Node, only_headings: bool = False) -> list[str]:
    """Texts of the blocks below a node in page order, white space as one space, without dropped elements."""
    out: list[str] = []
    parts: list[str] = []

    def end() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append(text)

    def walk(n: Node, headings: bool, within: bool) -> None:
        for child in n.children:
            if isinstance(child, str):
                if not headings or within:
                    parts.append(child)
            elif child.tag == "br":
                parts.append(" ")
            elif child.dropped:
                parts.append(" ")
            else:
                inner = headings
                if child.tag == "header":
                    if not article_header(child):
                        continue
                    inner = True
                if child.tag in BLOCKS:
                    end()
                    walk(child, inner, within or child.tag in HEADINGS)
                    end()
                else:
                    walk(child, inner, within)

    walk(node, only_headings, False)
    end()
    return out


def scored(root: Node) -> list[Node]:
    """Containers by how much running text is in them, best first; text in links counts against it."""
    found: list[Node] = []

    def running(node: Node, linked: bool) -> float:
        total = 0.0
        for child in node.children:
            if isinstance(child, str):
                total += (-0.5 if linked else 1.0) * len(child.strip())
            elif not child.dropped and child.tag not in BLOCKS:
                total += running(child, linked or child.tag == "a")
        return total

    def walk(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str) or child.dropped or child.tag == "header" and not article_header(child):
                continue
            if child.tag in BLOCKS:
                text = running(child, False)
                if text > 0:
                    target = child if child.tag in CONTAINERS else child.parent
                    share = 1.0
                    while target is not None and share > 0.2:
                        if target.tag in CONTAINERS:
                            target.score += share * text
                            share /= 2
                        target = target.parent
                if child.tag in CONTAINERS:
                    found.append(child)
            walk(child)

    walk(root)
    for node in found:
        if node.tag in ("article", "main"):
            node.score *= 1.5
    return sorted((n for n in found if n.score > 0), key=lambda n: -n.score)


def path_of(node: Node) -> str:
    names = []
    while node is not None and node.tag:
        names.append(node.names)
        node = node.parent
    return "/".join(reversed(names))


def votes(page: str | None, most: int = 3) -> list[tuple[str, int]]:
    """The paths of the page's best containers with their shares of the score in thousandths."""
    best = scored(parse(page or ""))[:most]
    total = sum(n.score for n in best)
    return [(path_of(n), round(1000 * n.score / total)) for n in best]


def amounts(root: Node) -> dict[int, tuple[int, int]]:
    """Of each element that is not dropped the letters of its text, and how many of them are in links."""
    found: dict[int, tuple[int, int]] = {}

    def walk(node: Node, linked: bool) -> tuple[int, int]:
        chars = links = 0
        for child in node.children:
            if isinstance(child, str):
                n = len(child.strip())
                chars, links = chars + n, links + n * linked
            elif not child.dropped:
                c, k = walk(child, linked or child.tag == "a")
                chars, links = chars + c, links + k
        found[id(node)] = chars, links
        return chars, links

    walk(root, False)
    return found


def widened(node: Node, amount: dict[int, tuple[int, int]], seen: set[int]) -> Node:
    """The article or main element around a container, else its farthest parent below the body that adds running text.

    Outside of articles, blocks beside the way up whose text is mostly links are dropped. ``seen`` holds the parents that are already wide.
    """
    article = node
    while article is not None and article.tag not in ("article", "main"):
        article = article.parent
    if article is not None:
        return article
    best = at = node
    while at.parent.tag in WIDER:
        up, added = at.parent, id(at.parent) in seen
        for child in () if added else up.children:
            if isinstance(child, str):
                added = added or bool(child.strip())
            elif child is not at and not child.dropped:
                chars, links = amount[id(child)]
                if child.tag in BLOCKS and 2 * links >= chars > 0:
                    child.dropped = True
                elif chars:
                    added = True
        if added:
            seen.add(id(up))
            best = up
        at = up
    return best


def extract(page: str | None, paths: list[str]) -> str:
    """The text from the containers on the first of the paths that the page has, else on the path of its best one."""
    root = parse(page or "")
    ranked = scored(root)
    if not ranked:
        return "\n\n".join(blocks(root))
    by_path: dict[str, list[Node]] = {}
    for node in ranked:
        by_path.setdefault(path_of(node), []).append(node)
    least = 0.25 * ranked[0].score
    path = next((p for p in paths if p in by_path and by_path[p][0].score >= least), path_of(ranked[0]))
    amount, seen = amounts(root), set()
    chosen = {id(widened(n, amount, seen)) for n in by_path[path]}
    out: list[str] = []

    def walk(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str) or child.dropped:
                continue
            if id(child) in chosen:
                out.extend(blocks(child))
            else:
                walk(child)

    walk(root)
    return "\n\n".join(out)


def host(url):
    """The host of a url column in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def winning_paths(pages: DataFrame, most: int = 4, least_share: float = 0.1) -> DataFrame:
    """Per host the paths with the most votes, best first: host, paths.

    Votes are summed per host and path before the shuffle, so a host with a third of all pages costs one row per path
    and task. Paths with less than ``least_share`` of a host's votes win nothing.
    """
    ship(pages.sparkSession)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_batches(batches, "html", most_rows=256):
            hosts = batch.column("host").to_pylist()
            rows = [(h, p, n) for h, page in zip(hosts, values) for p, n in votes(page)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                names=["host", "path", "votes"],
            )

    rows = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(voted, "host string, path string, votes long")
    summed = stored(rows.groupBy("host", "path").agg(F.sum("votes").alias("votes")), "path-votes")
    of_host = Window.partitionBy("host")
    ranked = summed.withColumns(
        {
            "rank": F.row_number().over(of_host.orderBy(F.desc("votes"), "path")),
            "share": F.col("votes") / F.sum("votes").over(of_host),
        }
    ).where((F.col("rank") <= most) & ((F.col("share") >= least_share) | (F.col("rank") == 1)))
    paths = F.transform(F.sort_array(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"])
    return stored(ranked.groupBy("host").agg(paths.alias("paths")), "winning-paths")


def main_text(pages: DataFrame, most: int = 4, least_share: float = 0.1) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text and n_chars.

    Null html counts as empty, which gives an empty text; pages without a host share one vote. Repeated rows come back
    each. The winning paths are a few rows per host; Spark decides by their size how they reach the pages.
    """
    winners = winning_paths(pages, most, least_share)
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), "html")
    rows = rows.join(winners, "host", "left").select("page_id", "url", "html", "paths")
    kind = pages.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_batches(batches, "html", most_rows=256):
            texts = [extract(page, paths or []) for page, paths in zip(values, batch.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(extracted, f"page_id {kind}, url string, text string, n_chars long")
