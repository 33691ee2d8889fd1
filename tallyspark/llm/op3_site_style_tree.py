"""Operator 3, HTML extraction with a site style tree.

The pages of a host are merged into one tree: an element is addressed by its
style path (tags with class and id from the root), so all elements of one
style at one place share a tree node. For every node the different pages of
the host give two distributions: its presentation (the row of child styles)
and its content (the text below it). With m pages,

    presentation importance  = entropy of the presentations, to base m
    content importance       = entropy of the contents, to base m
    importance               = 1 - (1 - presentation) * (1 - content)

A branch whose importance is at or below ``threshold`` is removed from each
page of the host, if at least ``min_pages`` different pages have it. Pages of
one main text count once, whatever stands around it, so copied articles aren't
taken for a template. The tree never removes an ``article`` or ``main``, an element
around one, or a heading, paragraph, list or table inside one: inside
it takes containers (div, section, ins) alone. Elements
whose tag or ARIA role is furniture (navigation, footer, form, ...) have
importance 0 on every page: their texts may differ from page to page, as
adverts and link lists do. So have elements whose class or id merely has a
word for it ("ad", "comments", "sidebar"), but not if the element

- holds an ``article`` or ``main`` whose own class and id have no such word
  (``<div class="container has-sidebar">`` around the article),
- is a heading, heading group, header or paragraph inside one
  (``<h1 class="entry-header">``), or
- has more than half of the text outside furniture tags and roles, on a page
  without such an ``article`` or ``main``.

A high content entropy alone doesn't keep it: adverts differ from page to
page. What is left is cut to the outermost ``article``
or ``main`` elements with text, if the page has any.

Statistics are counts by (host, style path, value), combined before each
shuffle; the list of removable paths per host is written, and joined to the
pages by the planner (broadcast only under its size limit).

Text: block elements make blocks; character references are decoded; white
space inside a block (``br`` included) becomes one space; blocks are trimmed,
empty ones go, and the rest are joined by one newline.

Defined cases: null or empty html, or html without text, gives an empty
text; a null or malformed url has the host ""; unclosed, misnested and
truncated markup is read as far as it goes, in linear time; a quote that opens an
attribute value and never ends takes the rest of the page, as in browsers; repeated rows are extracted each;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import map_texts, table, written

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"option", "optgroup", "tbody", "tfoot", "thead", "tr", "td", "th", "body", "html", "legend"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol menu dl table tbody thead tfoot tr select article section div main body td th".split())

# Furniture: roles that are never main text, by tag, ARIA role, or a word of class or id.
FURNITURE_TAGS = frozenset(
    "head nav footer aside form button select input textarea script style noscript template iframe object svg "
    "canvas dialog menu title noembed noframes".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                            "menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs pagination pager sidebar sidebars footer header masthead cookie cookies consent gdpr "
    "notice notices alert popup modal overlay comment comments reply replies disqus share sharing social related "
    "recommended newsletter subscribe subscription signup login search widget".split())
_WORDS = re.compile(r"[a-z]+")
# A quote is special right after the "=" of an attribute only; elsewhere it is a character.
_VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s"'>][^\s>]*+)"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:{_VALUE})?+)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>]++)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s"'>][^\s>]*+)))?""")


# Elements of an article that a word of class or id doesn't make furniture.
OWN_TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup header p".split())
# Elements of an article that the tree may remove: containers without a meaning of their own.
CONTAINERS = frozenset("div section ins".split())


class Node:
    """``worded``: a word of class or id names a furniture role."""
    __slots__ = ("tag", "style", "furniture", "worded", "children")

    def __init__(self, tag: str, style: str, furniture: bool, worded: bool):
        self.tag, self.style, self.furniture, self.worded, self.children = tag, style, furniture, worded, []


def _element(tag: str, attrs: str, inside_article: bool) -> Node:
    furniture = tag in FURNITURE_TAGS or tag == "header" and not inside_article
    style, worded = tag, False
    if attrs.strip(" /\t\r\n"):
        named = {}
        for m in _ATTR.finditer(attrs):
            named.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
        label = f"{named.get('class', '')} {named.get('id', '')}".lower()
        if label != " ":
            style += "." + ".".join(label.split())
            worded = not FURNITURE_WORDS.isdisjoint(_WORDS.findall(label))
        furniture |= named.get("role", "").lower() in FURNITURE_ROLES
        furniture |= "hidden" in named or named.get("aria-hidden", "").lower() == "true"
        furniture |= "display:none" in named.get("style", "").lower().replace(" ", "")
    return Node(tag, style, furniture, worded)


def parse(html: str) -> Node:
    """A tolerant DOM: elements and raw text pieces in page order. Of every tag
    the places of its open elements are known, so an end tag costs no search."""
    root = Node("", "", False, False)
    stack = [root]
    places: defaultdict[str, list[int]] = defaultdict(list)
    at = 0

    def innermost(names) -> int:
        return max((places[t][-1] for t in names if places[t]), default=0)

    def close(names, until) -> None:
        i = innermost(names)
        if i > innermost(until):
            for node in stack[i:]:
                places[node.tag].pop()
            del stack[i:]

    end = len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag != "br" and tag not in VOID:
                close((tag,), ())
            elif tag == "br":
                stack[-1].children.append(" ")
            continue
        if tag in CLOSES_P:
            close(("p",), HOLDS)
        if tag in SIBLINGS:
            close(SIBLINGS[tag], HOLDS - SIBLINGS[tag])
        node = _element(tag, m[3], bool(places["article"] or places["main"]))
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            shut = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(html, at)
            node.children.append(html[at:shut.start() if shut else end])
            at = shut.end() if shut else end
        else:
            places[tag].append(len(stack))
            stack.append(node)
    return root


def _paths(root: Node) -> dict[int, tuple[int, int]]:
    """Style path -> (presentation, content) of the page, all elements of one
    path together. Hashes are signed 64-bit. Iterative: markup nests freely."""
    found: dict[int, list] = {}
    below: dict[int, list] = {}
    order: list[tuple[Node, int, Node | None]] = []
    todo = [(c, 0, None) for c in root.children if isinstance(c, Node)]
    while todo:
        node, above, parent = todo.pop()
        path = xxhash.xxh64_intdigest(node.style, above)
        order.append((node, path, parent))
        todo += [(c, path, node) for c in node.children if isinstance(c, Node)]
    text: dict[int, list] = {}
    for node, path, parent in reversed(order):  # children before their parents
        own = [c if isinstance(c, str) else None for c in node.children]
        kept = iter(text.pop(id(node), [])[::-1])
        content = xxhash.xxh64_intdigest("\x1f".join(
            " ".join(c.split()) if c is not None else format(next(kept), "x") for c in own))
        if parent is not None:
            text.setdefault(id(parent), []).append(content)
        found.setdefault(path, []).append(content)
        styles = []
        for c in node.children:  # repeated child styles count as one
            if isinstance(c, Node) and (not styles or styles[-1] != c.style):
                styles.append(c.style)
        below.setdefault(path, []).append(",".join(styles))
    sign = lambda h: h - (1 << 64) if h >> 63 else h
    return {p: (sign(xxhash.xxh64_intdigest("|".join(sorted(set(below[p]))))),
                sign(xxhash.xxh64_intdigest(",".join(format(x, "x") for x in c)))) for p, c in found.items()}


def _spared(root: Node) -> set[int]:
    """ids of the worded elements that hold the page's main text. Iterative,
    children before their parents; branches of furniture tags and roles hold none."""
    order: list[tuple[Node, Node]] = []
    todo = [(c, root) for c in root.children if isinstance(c, Node)]
    worded = False
    while todo:
        node, parent = todo.pop()
        if node.furniture:
            continue
        order.append((node, parent))
        worded |= node.worded
        todo += [(c, node) for c in node.children if isinstance(c, Node)]
    if not worded:
        return set()
    size, holds = {id(root): sum(len(c.split()) for c in root.children if isinstance(c, str))}, set()
    for node, parent in reversed(order):
        own = size.get(id(node), 0) + sum(len(c.split()) for c in node.children if isinstance(c, str))
        size[id(node)] = own
        size[id(parent)] = size.get(id(parent), 0) + own
        if id(node) in holds or node.tag in ("article", "main") and not node.worded:
            holds.add(id(parent))
    if holds:
        return holds
    return {id(node) for node, _ in order if 2 * size[id(node)] > size[id(root)]}


def _around_articles(root: Node) -> set[int]:
    """ids of the articles and mains that aren't worded, and of all elements around them."""
    parents: dict[int, Node] = {}
    found: set[int] = set()
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main") and not node.worded:
            up: Node | None = node
            while up is not None and id(up) not in found:
                found.add(id(up))
                up = parents.get(id(up))
        for c in node.children:
            if isinstance(c, Node) and not c.furniture:
                parents[id(c)] = node
                todo.append(c)
    return found


def main_text(html: str, removable: frozenset[int] = frozenset()) -> str:
    """Blocks of the page's main text, without furniture and without the
    branches at ``removable`` style paths (unsigned hashes)."""
    return text_of(parse(html), removable)


def text_of(root: Node, removable: frozenset[int] = frozenset()) -> str:
    spared = _spared(root)
    guarded = _around_articles(root) if removable else set()
    whole: list[list[str]] = [[]]
    articles: list[list[str]] = [[]]
    # (node, path above, inside an article) or the end of a block
    todo: list = [(c, 0, False) for c in reversed(root.children)]
    while todo:
        item, above, inside = todo.pop()
        if item is None:  # a block ends
            whole.append([])
            articles.append([])
            continue
        if isinstance(item, str):
            whole[-1].append(item)
            if inside:
                articles[-1].append(item)
            continue
        if item.tag == "br":
            whole[-1].append(" ")
            articles[-1].append(" ")
            continue
        path = xxhash.xxh64_intdigest(item.style, above)
        block = item.tag in BLOCK
        if block:
            whole.append([])
            articles.append([])
        if item.furniture or path in removable and id(item) not in guarded and (not inside or item.tag in CONTAINERS):
            continue
        if (item.worded and item.tag not in ("html", "body", "article", "main") and id(item) not in spared
                and not (inside and item.tag in OWN_TEXT)):
            continue
        inside = inside or item.tag in ("article", "main")
        if block:
            todo.append((None, 0, False))
        todo += [(c, path, inside) for c in reversed(item.children)]

    def joined(blocks: list[list[str]]) -> str:
        clean = (" ".join(entities.unescape("".join(b)).split()) for b in blocks if b)
        return "\n".join(b for b in clean if b)

    return joined(articles) or joined(whole)


# ------------------------------------------------------------------- Spark side

PATHS = "host string, page long, path long, presentation long, content long"


def host_of(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _collect_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: list[list] = [[], [], [], [], []]
        for host, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            root = parse(text)
            # Pages of one text count once, whatever adverts stand around it.
            page = xxhash.xxh64_intdigest(text_of(root) or text) - (1 << 63)
            for path, (presentation, content) in _paths(root).items():
                for c, v in zip(cols, (host, page, path - (1 << 64) if path >> 63 else path, presentation, content)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                         names=["host", "page", "path", "presentation", "content"])


def removable_paths(pages: DataFrame, threshold: float = 0.2, min_pages: int = 8) -> DataFrame:
    """(host, paths): the low-importance style paths of each host's tree, from
    ``pages`` (host, html not null)."""
    seen = (map_texts(pages, _collect_paths, PATHS)
            .groupBy("host", "path", "page").agg(F.min("presentation").alias("presentation"),
                                                 F.min("content").alias("content")))

    # Both distributions in one pass over the pages.
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("presentation", "content")])
    counts = (seen.select("host", "path", F.inline(kinds)).groupBy("host", "path", "kind", "value").agg(F.count("*").cast("double").alias("n")))

    def nlogn(kind: str) -> F.Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n") * F.log("n")))

    m = F.col("m")
    stats = (counts.groupBy("host", "path").agg(F.sum(F.when(F.col("kind") == "content", F.col("n"))).alias("m"),
                                                nlogn("presentation").alias("p"), nlogn("content").alias("c"))
             .filter(m >= max(min_pages, 2)))
    presentation, content = ((F.log("m") - F.col(x) / m) / F.log("m") for x in "pc")
    return (stats.filter(1 - (1 - presentation) * (1 - content) <= threshold)
            .groupBy("host").agg(F.collect_set("path").alias("paths")))


def extract(pages: DataFrame, threshold: float = 0.2, min_pages: int = 8) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html)."""
    whole = pages.select("page_id", "url", host_of(F.col("url")).alias("host"),
                         F.coalesce(F.col("html"), F.lit("")).alias("html"))
    low = written(removable_paths(whole.select("host", "html"), threshold, min_pages), "style-tree")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(h, frozenset(x & 0xFFFFFFFFFFFFFFFF for x in p or ()))
                   for h, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    schema = StructType(pages.select("page_id", "url").schema.fields + StructType.fromDDL("text string").fields)
    return map_texts(whole.join(low, "host", "left").select("page_id", "url", "html", "paths"), texts, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every row of ``pages``."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), "url", "html")
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))
