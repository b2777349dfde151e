"""Main text of web pages: site templates are found by counting element subtrees per host, and removed.

Every element is hashed with all that is below it. Spark counts on how many pages of a host each subtree stands; those on a large
share of its pages are the site's template and go. Page furniture that stands on one page only goes by its element or its class.
Prose blocks of the article, and whatever holds them, stay even when they recur: copied articles and quoted passages are text,
not template.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.cluster import saved, small

TEMPLATE_PAGES = 3  # pages of a host with the same links that make them template, and at least TEMPLATE_PERCENT of its pages
TEMPLATE_PERCENT = 10
PROSE_PAGES = 5  # for anything with text outside links, also at least half of the host's pages

# HTML element names by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd td th caption figcaption li".split())
BLOCK = PROSE | set(
    "html body main article section div header footer nav aside address ul ol dl table thead tbody tfoot tr figure form "
    "fieldset details summary hgroup hr dialog center menu search".split()
)
JUNK = set(
    "head script style noscript template iframe nav header footer aside form button select option input textarea label "
    "menu dialog svg canvas audio video object embed map math search title datalist fieldset".split()
)
JUNK_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
JUNK_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side-bar widget footer header masthead notice notices cookie cookies consent gdpr "
    "popup modal overlay alert newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments reply replies respond disqus pagination pager tags toolbar copyright legal skip-link "
    "skip hidden".split()
)
CLOSES_P = BLOCK - {"dt", "dd", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "summary", "html", "body"}
# an opening element ends an open one of these, up to the element in which both stand
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # Node or str
    hash: int = 0


def parse(page: str) -> Node:
    """A tree of elements; unclosed elements end where their parents do, an unfinished last tag is dropped."""
    root = Node("#root")
    stack = [root]
    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            tail = page[at:]
            cut = re.search(r"</?[a-zA-Z][^>]*\Z", tail)  # a tag with a broken quote at the end
            stack[-1].children.append(tail[: cut.start()] if cut else tail)
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        name = m.group(1)
        if name is None or not m.group(3):
            continue
        name = name.lower()
        if page[m.start() + 1] == "/":
            if name == "p" and not any(n.tag == "p" for n in stack):
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    del stack[depth:]
                    break
                # an inline end tag does not close the block around it
                if name not in BLOCK and stack[depth].tag in BLOCK:
                    break
            continue
        if name in CLOSES_P:
            _end(stack, {"p"}, {"td", "th", "li", "blockquote", "article", "section", "div", "table"})
        if name in SIBLINGS:
            _end(stack, *SIBLINGS[name])
        node = Node(name)
        if m.group(2).strip(" \t\r\n\f/"):
            for a in ATTRIBUTE.finditer(m.group(2)):
                node.attributes.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif name not in VOID and not m.group(2).rstrip().endswith("/") or name in BLOCK - {"hr"}:
            stack.append(node)
    return root


def _end(stack: list[Node], which: set[str], within: set[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in which:
            del stack[depth:]
            return
        if stack[depth].tag in within:
            return


def hashed(root: Node) -> list[Node]:
    """All elements, children first, each with its subtree hash."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    order.reverse()
    for node in order:
        parts = [node.tag, node.attributes.get("class", ""), node.attributes.get("id", ""), node.attributes.get("href", "")]
        parts += [f"<{c.hash}" if isinstance(c, Node) else " ".join(c.split()) for c in node.children]
        node.hash = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)
    return order


def _words(node: Node) -> set[str]:
    text = (node.attributes.get("class", "") + " " + node.attributes.get("id", "")).lower()
    return set(re.split(r"[\s_]+", text)) | set(re.split(r"[\s_-]+", text)) if text.strip() else set()


def is_junk(node: Node, in_article: bool) -> bool:
    if node.tag in JUNK:
        return not (in_article and node.tag == "header")
    if node.attributes.get("role", "").lower() in JUNK_ROLES or "hidden" in node.attributes:
        return True
    return node.tag not in ("html", "body", "main", "#root") and bool(_words(node) & JUNK_WORDS)


def roots(tree: Node) -> list[Node]:
    """Outermost main or article elements that are not furniture; without any, the whole page."""
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        if node.tag in ("main", "article") and not is_junk(node, False):
            out.append(node)
        elif node.tag == "#root" or not is_junk(node, False):
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out or [tree]


def candidates(tree: Node) -> dict[int, bool]:
    """Subtrees that may be template: hash, and whether it has text outside links. None that holds prose of the article."""
    said, prose = set(), set()  # nodes with text outside links; of these, those that are or hold prose elements
    for node in hashed(tree):
        if node.tag != "a" and node.tag not in RAW:
            if any(id(c) in said if isinstance(c, Node) else c.strip() for c in node.children):
                said.add(id(node))
                if node.tag in PROSE or any(id(c) in prose for c in node.children):
                    prose.add(id(node))
    inside = set()
    for r in roots(tree):
        if r is not tree:
            inside.update(id(n) for n in hashed(r))
    out: dict[int, bool] = {}
    stack = [tree]
    while stack:
        node = stack.pop()
        stack += [c for c in node.children if isinstance(c, Node)]
        if node.tag in ("#root", "html", "body", "main", "article"):
            continue
        if id(node) in inside and (node.tag not in BLOCK or node.tag in PROSE or id(node) in prose):
            continue
        # an inline element is part of a sentence, even if all of it is a link
        out[node.hash] = out.get(node.hash, False) or id(node) in said or node.tag in PROSE or node.tag not in BLOCK
    return out


def extract(tree: Node, template: set[int]) -> str:
    """Text of the page's blocks, one per line, without furniture and without the template subtrees."""
    hashed(tree)
    blocks: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(piece)).split())
        if text:
            blocks.append(text)
        piece.clear()

    stack: list = []
    for r in reversed(roots(tree)):
        stack.append((r, True))
    in_article = tree not in roots(tree)
    while stack:
        item, opening = stack.pop()
        if isinstance(item, str):
            piece.append(item)
        elif not opening:
            flush()
        elif item.tag in ("br", "hr", "wbr", "img") or item.hash in template or is_junk(item, in_article):
            if item.tag == "br":
                piece.append(" ")
            elif item.tag != "wbr":
                flush() if item.tag in BLOCK else None
        else:
            block = item.tag in BLOCK or item.tag == "#root"
            if block:
                flush()
                stack.append((item, False))
            stack += [(c, True) for c in reversed(item.children)]
    flush()
    return "\n".join(blocks)


def host(url: Column) -> Column:
    """Lower-case host name; null or other urls share the empty one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _page_key() -> Column:
    return F.xxhash64("_url", "_html")


def templates(pages: DataFrame) -> DataFrame:
    """(page, hashes): for every distinct page the subtrees that its host repeats on many distinct pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [candidates(parse(x.as_py() or "")) for x in batch.column("_html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page"),
                    batch.column("site"),
                    pa.array([list(f) for f in found], pa.list_(pa.int64())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.bool_())),
                ],
                ["page", "site", "hashes", "prose"],
            )

    source = pages.select(_page_key().alias("page"), F.xxhash64(host(F.col("_url"))).alias("site"), "_html")
    trees = saved(source.mapInArrow(run, "page bigint, site bigint, hashes array<bigint>, prose array<boolean>"))
    trees = trees.dropDuplicates(["page"])
    both = trees.select("page", "site", F.explode(F.arrays_zip("hashes", "prose")).alias("e"))
    parts = saved(both.select("page", "site", F.col("e.hashes").alias("hash"), F.col("e.prose").alias("prose")))
    counts = parts.groupBy("site", "hash").agg(F.count("*").alias("n"), F.max("prose").alias("prose"))
    sizes = trees.groupBy("site").agg(F.count("*").alias("total"))
    counts = counts.where(F.col("n") >= TEMPLATE_PAGES).join(sizes, "site")
    links = ~F.col("prose") & (100 * F.col("n") >= TEMPLATE_PERCENT * F.col("total"))
    often = counts.where(links | ((F.col("n") >= PROSE_PAGES) & (2 * F.col("n") >= F.col("total"))))
    hits = parts.join(small(saved(often.select("site", "hash"))), ["site", "hash"])
    return hits.groupBy("page").agg(F.collect_set("hash").alias("hashes"))  # bounded by the page's own elements


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row: the article's text, blocks joined by ``\\n``.

    Null or empty html gives an empty text; a null url belongs to the nameless host. Equal pages (url and html) count once as
    evidence and get equal texts. An empty table gives no rows. Other columns are ignored.
    """
    plain = pages.select("page_id", F.col("url").alias("_url"), F.col("html").alias("_html"))
    found = saved(templates(plain))
    joined = plain.withColumn("page", _page_key()).join(small(found), "page", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                extract(parse(x.as_py() or ""), set(h.as_py() or ())) for x, h in zip(batch.column("_html"), batch.column("hashes"))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("_url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "_url", "_html", "hashes").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint"
    )
