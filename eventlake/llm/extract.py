"""Main text of web pages by wrapper induction.

Pages of a host with the same outline are a layout. One of them stands for it,
and every page of the layout is aligned with it by simple tree matching: two
nodes match if tag and class agree, and children match in order, as many as can
be, equal texts before others. All pages are counted, copies once: a node whose
text is the same in most pages of the layout is template, nodes whose text
varies are its slots. Every page is then aligned again, and the constants it
shares with the template are left out, inside an article too.

What a page says of itself comes with it: navigation, footers, forms, adverts,
comments and the like go by tag, class or role, whether their text varies or
not; an ``article`` or ``main`` bounds the text, and a page with several has
them all, in page order. Where nothing would be left, names don't count, and
constants alone decide.
"""

from __future__ import annotations

import html
import json
import math
import re

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, rest_struct, stored
from .urls import url_parts

#: A constant has the same text in so many different pages of its layout, and
#: in more than half of them.
AGREE = 3
#: Levels of a page whose blocks are its outline.
OUTLINE = 4
#: Above so many pairs of children the table of an alignment is made by arrays,
#: a row at a time: for speed and memory only, the result is the same.
PAIRS = 4096
#: Weights of pairs of subtrees that such a table keeps at hand.
WEIGHED = 4_000_000
#: Templates a task keeps at hand.
KEPT = 64
#: Deeper nesting is read as if at this depth.
DEPTH = 100

# HTML's elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
NOT_TEXT = set("aside audio button canvas datalist dialog fieldset footer form head iframe input label menu meter nav noembed noframes noscript object progress script select style svg template textarea title video".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption caption".split())
NOT_TEXT_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tooltip".split())
# Words of class names and ids that mark what isn't the article.
NOT_TEXT_NAMES = set(
    "ad ads advert advertisement adverts advertising adsense banner breadcrumb breadcrumbs byline captcha comment comments consent cookie cookies disqus disclaimer footer gdpr hidden login masthead menu menus meta modal nav navbar navigation navi newsletter notice notices overlay pager pagination popup promo promoted promotion register related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
#: Opening one of these ends an open element of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table article section div body main td th blockquote form aside nav header footer".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    __slots__ = ("tag", "name", "attributes", "kids", "constant", "mark", "number", "whole", "kind", "elements")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.name = " ".join(sorted(attributes.get("class", "").lower().split()))
        self.kids: list[Node | str] = []
        self.constant = False
        self.mark = self.number = self.whole = 0
        self.kind = f"{tag}.{self.name}"
        self.elements: list[Node] = []

    def text(self) -> str:
        """Its own text, without its children's."""
        return " ".join(" ".join(k for k in self.kids if isinstance(k, str)).split())


def parse(source: str) -> Node:
    """A tree from any text: unclosed and stray tags are put right as browsers
    mostly do."""
    root = Node("#", {})
    stack, at = [root], 0

    def close(index: int) -> None:
        del stack[index:]

    def put(text: str) -> None:
        if text:
            stack[-1].kids.append(text)

    while True:
        m = TOKEN.search(source, at)
        if not m:
            put(html.unescape(source[at:]))
            return root
        put(html.unescape(source[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag in BLOCK and tag != "html":  # ends an open paragraph
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    close(i)
                    break
                if stack[i].tag in SCOPES and not (tag == "tr" and stack[i].tag in ("td", "th")):
                    break
        node = Node(tag, {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(m[3])} if m[3] else {})
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(source, at)
            node.kids.append(source[at : end.start() if end else len(source)])
            at = end.end() if end else len(source)
        elif tag not in VOID and not m[3].endswith("/") and len(stack) < DEPTH:
            stack.append(node)


def numbered(node: Node) -> Node:
    """The tree with its nodes numbered in page order, and hashes of each node's
    own text (0 for none) and of all there is under it."""
    stack, number, order = [node], 0, []
    while stack:
        n = stack.pop()
        n.number, number = number, number + 1
        text = n.text()
        n.mark = xxhash.xxh64_intdigest(text) >> 1 | 1 if text else 0
        n.elements = [k for k in n.kids if isinstance(k, Node)]
        stack += reversed(n.elements)
        order.append(n)
    for n in reversed(order):
        n.whole = whole(n)
    return node


def whole(n: Node) -> int:
    """The hash of a subtree, from those of its children."""
    return hash((n.kind, n.mark, *[k.whole for k in n.elements]))


def outline(node: Node) -> int:
    """A layout: the different blocks of the first levels, each by the tags and
    classes above it, outside articles."""
    paths = set()

    def walk(n: Node, path: str, level: int) -> None:
        for k in n.kids:
            if isinstance(k, Node) and k.tag in BLOCK and k.tag not in PROSE:
                here = f"{path}/{k.tag}.{k.name}"
                paths.add(here)
                if level < OUTLINE and k.tag not in ("article", "main"):
                    walk(k, here, level + 1)

    walk(node, "", 1)
    return xxhash.xxh64_intdigest("\n".join(sorted(paths))) >> 1


def slots(template: Node, constants: dict[int, int]) -> Node:
    """A template in which a subtree without a constant is a slot: one node
    that takes whatever a page has there."""

    def cut(n: Node) -> bool:
        if not any([cut(k) for k in n.elements]):
            n.elements = []
            return n.number in constants
        return True

    cut(template)
    return template


def align(x: list[Node], y: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
    """Children in order: equal subtrees from both ends first, which no better
    matching avoids, then the pairs that weigh most."""
    a = 0
    while a < min(len(x), len(y)) and x[a].whole == y[a].whole:
        a += 1
    z = 0
    while z < min(len(x), len(y)) - a and x[-1 - z].whole == y[-1 - z].whole:
        z += 1
    found = [match(u, v) for u, v in [*zip(x[:a], y[:a], strict=True), *zip(x[len(x) - z :], y[len(y) - z :], strict=True)]]
    weight, pairs = sum(w for w, _ in found), [p for _, ps in found for p in ps]
    x, y = x[a : len(x) - z], y[a : len(y) - z]
    if not x or not y:
        return weight, pairs
    if len(x) * len(y) > PAIRS:
        long_weight, long_pairs = align_long(x, y)
        return weight + long_weight, pairs + long_pairs
    inner: dict[tuple[int, int], tuple[int, list]] = {}
    best = [[0] * (len(y) + 1)]
    for i, p in enumerate(x):
        above, row, left = best[-1], [0], 0
        for j, q in enumerate(y):
            if above[j + 1] > left:
                left = above[j + 1]
            if p.kind == q.kind:
                if p.elements and q.elements:
                    inner[i, j] = match(p, q)
                    w = inner[i, j][0]
                else:
                    w = 2 if p.mark == q.mark != 0 else 1
                if above[j] + w > left:
                    left = above[j] + w
            row.append(left)
        best.append(row)
    i, j = len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += inner[i, j][1] if (i, j) in inner else [(x[i], y[j])]
    return weight + best[-1][-1], pairs


def classes(x: list[Node], y: list[Node]) -> tuple[list[int], list[int]]:
    """Numbers for the subtrees of either list, equal for those that weigh the
    same against all of the other list: texts count only if both lists have
    them."""

    def marks(nodes: list[Node]) -> set[int]:
        found, stack = set(), list(nodes)
        while stack:
            n = stack.pop()
            found.add(n.mark)
            stack += n.elements
        return found

    both = marks(x) & marks(y)
    numbers: dict[tuple, int] = {}

    def number(n: Node) -> int:
        key = (n.kind, n.mark if n.mark in both else 0, *[number(k) for k in n.elements])
        return numbers.setdefault(key, len(numbers))

    return [number(n) for n in x], [number(n) for n in y]


def align_long(x: list[Node], y: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
    """``align``'s table for long lists, with the same result: rows by whole
    arrays, each two classes of subtrees weighed once. Of the table some rows
    are kept, and those between are made again on the way back, so memory grows
    with the longer list's length times the root of the shorter's, not with all
    pairs."""
    one, other = classes(x, y)
    # a class of both lists may hide texts that only one of them has
    left, right = dict(zip(one, x, strict=True)), dict(zip(other, y, strict=True))
    place = {c: k for k, c in enumerate(right)}
    column = np.array([place[c] for c in other])
    weights: dict[int, np.ndarray] = {}

    def row(i: int, above: np.ndarray) -> np.ndarray:
        if one[i] not in weights:
            if len(weights) * len(right) > WEIGHED:
                weights.clear()
            weights[one[i]] = np.array([match(left[one[i]], n)[0] for n in right.values()], np.int64)
        found = np.maximum(above[1:], above[:-1] + weights[one[i]][column[: len(above) - 1]])
        return np.maximum.accumulate(np.concatenate([above[:1], found]))

    step = math.isqrt(len(x)) + 1
    kept, above = {}, np.zeros(len(y) + 1, np.int64)
    for i in range(len(x)):
        if i % step == 0:
            kept[i] = above
        above = row(i, above)
    weight, pairs, i, j = int(above[-1]), [], len(x), len(y)
    while i and j:
        first = (i - 1) // step * step
        best = [kept[first][: j + 1]]
        for k in range(first, i):
            best.append(row(k, best[-1]))
        while i > first and j:
            here, up = best[i - first], best[i - first - 1]
            if here[j] == up[j]:
                i -= 1
            elif here[j] == here[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs += match(x[i], y[j])[1]
    return weight, pairs


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the most node pairs that agree in tag and class,
    keep the order of siblings and lie under matched parents; a pair with equal
    text weighs two."""
    if a.kind != b.kind:
        return 0, []
    weight, pairs = align(a.elements, b.elements) if a.elements and b.elements else (0, [])
    return 1 + (a.mark == b.mark != 0) + weight, [(a, b), *pairs]


def dump(tree: Node) -> str:
    """A numbered tree without its texts."""

    def item(node: Node) -> list:
        return [node.tag, node.name, node.mark, [item(k) for k in node.elements]]

    return json.dumps(item(tree), separators=(",", ":"))


def load(template: str) -> Node:
    count = 0

    def build(item: list) -> Node:
        nonlocal count
        tag, name, mark, kids = item
        node = Node(tag, {"class": name})
        node.mark, node.number, count = mark, count, count + 1
        node.kids = node.elements = [build(k) for k in kids]
        node.whole = whole(node)
        return node

    return build(json.loads(template))


def boilerplate(node: Node, inside: bool) -> bool:
    """Does a node's own markup say that it isn't part of the article?"""
    if node.tag in NOT_TEXT or node.tag == "header" and not inside:
        return True
    a = node.attributes
    if not a or node.tag in ("html", "body", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in NOT_TEXT_ROLES:
        return True
    return bool(NOT_TEXT_NAMES & set(re.split(r"[^a-z]+", (a.get("class", "") + " " + a.get("id", "")).lower())))


def bounds(node: Node, inside: bool, found: list[Node]) -> None:
    """The outermost articles and main elements that aren't boilerplate."""
    if boilerplate(node, inside):
        return
    if node.tag in ("article", "main") or node.attributes.get("role", "").lower() in ("article", "main"):
        found.append(node)
        return
    for k in node.kids:
        if isinstance(k, Node):
            bounds(k, inside, found)


def regions(tree: Node) -> tuple[list[Node], bool]:
    """The nodes that hold the article, and whether the page names them."""
    found: list[Node] = []
    bounds(tree, False, found)
    return (found, True) if found else ([tree], False)


def never_shown(node: Node, inside: bool) -> bool:
    """What is no text by its tag, whatever the page is like."""
    return node.tag in RAW or node.tag in ("head", "svg", "canvas", "object", "audio", "video") or "hidden" in node.attributes


def blocks(nodes: list[Node], named: bool, left_out=boilerplate) -> list[str]:
    """Text of each block in the regions."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    def walk(n: Node, top: bool) -> None:
        if not top and left_out(n, named):
            if n.tag in BLOCK:
                end()
            return
        keep = not n.constant
        if n.tag in BLOCK:
            end()
        elif n.tag == "br":
            line.append(" ")
        for k in n.kids:
            if isinstance(k, Node):
                walk(k, False)
            elif keep:
                line.append(k)
        if n.tag in BLOCK:
            end()

    for node in nodes:
        walk(node, True)
        end()
    return out


def main_text(source: str, template: Node | None, constants: dict[int, int] | None = None, names: bool = True) -> str:
    """``constants``: the hash of the text that a node of the template has;
    without ``names`` tags, classes and roles don't tell boilerplate."""
    tree = parse(source)
    if template is not None:
        for u, v in match(numbered(tree), template)[1]:
            u.constant = u.mark != 0 and constants.get(v.number) == u.mark
    found = blocks(*regions(tree)) or blocks([tree], False) if names else []
    return "\n".join(found or blocks([tree], False, never_shown))


def tree_rows(batches):
    """Each page's layout and tree."""
    for batch in batches:
        trees = [numbered(parse(x)) for x in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["host"], pa.array([outline(t) for t in trees], pa.int64()), batch["draw"], pa.array([dump(t) for t in trees], pa.string())], names=["host", "layout", "draw", "tree"]
        )


def text_counts(batches):
    """How many pages have a text at a node of their layout's template."""
    held: dict[str, Node] = {}
    for batch in batches:
        count: Counter = Counter()
        for host, layout, tree, template in zip(*(batch[c].to_pylist() for c in ("host", "layout", "tree", "template")), strict=True):
            if template not in held:
                if len(held) >= KEPT:
                    held.clear()
                held[template] = load(template)
            for u, v in match(load(tree), held[template])[1]:
                if u.mark:
                    count[host, layout, v.number, u.mark] += 1
        keys = list(count)
        columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(count.values()), pa.int64())], names=["host", "layout", "node", "mark", "n"])


def layout_rows(batches):
    for batch in batches:
        known = batch["known"].to_pylist()
        layouts = [outline(parse(x)) if x and k else None for x, k in zip(batch["html"].to_pylist(), known, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(layouts, pa.int64())], names=[*batch.schema.names, "layout"])


def extract_rows(names: bool):
    def run(batches):
        held: dict[tuple, tuple[Node, dict[int, int]]] = {}
        for batch in batches:
            texts = []
            for source, host, layout, template, constants in zip(*(batch[c].to_pylist() for c in ("html", "host", "layout", "template", "constants")), strict=True):
                if template is None:
                    texts.append(main_text(source or "", None, names=names))
                    continue
                if (host, layout) not in held:
                    if len(held) >= KEPT:
                        held.clear()
                    marks = {c["node"]: c["mark"] for c in constants}
                    held[host, layout] = slots(load(template), marks), marks
                texts.append(main_text(source, *held[host, layout], names=names))
            columns = ["id", "url", "rest", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else batch[n] for n in columns], names=columns)

    return run


def induce(pages: DataFrame) -> DataFrame:
    """``host``, ``layout``, ``template`` (a tree) and ``constants`` (array of
    ``node`` and ``mark``) of all pages (``host``, ``html``). Equal pages of a
    host count once."""
    different = pages.where(F.length("html") > 0).withColumn("draw", F.xxhash64("html")).groupBy("host", "draw").agg(F.first("html").alias("html"))
    trees = stored(different.mapInArrow(tree_rows, "host string, layout long, draw long, tree string"), "page-trees")
    size = trees.groupBy("host", "layout").agg(F.count("*").alias("pages"), F.min_by("tree", "draw").alias("template")).where(F.col("pages") >= AGREE)
    size = stored(size, "layouts")
    on = (trees["host"].eqNullSafe(size["host"])) & (trees["layout"] == size["layout"])
    matched = trees.join(size, on).select(trees["host"], trees["layout"], "tree", "template")
    counts = matched.mapInArrow(text_counts, "host string, layout long, node long, mark long, n long").groupBy("host", "layout", "node", "mark").agg(F.sum("n").alias("n"))
    same = counts["host"].eqNullSafe(size["host"]) & (counts["layout"] == size["layout"])
    # at most one text of a node is in more than half of the pages
    constant = counts.where(F.col("n") >= AGREE).join(size.drop("template"), same).where(2 * F.col("n") > F.col("pages")).select(counts["host"], counts["layout"], "node", "mark")
    constant = constant.groupBy("host", "layout").agg(F.collect_list(F.struct("node", "mark")).alias("constants"))
    last = constant["host"].eqNullSafe(size["host"]) & (constant["layout"] == size["layout"])
    return stored(size.join(constant, last).select(size["host"], size["layout"], "template", "constants"), "templates")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", names: bool = True) -> DataFrame:
    """The main text of every page.

    Returns ``id``, ``url``, ``text`` (blocks in page order, a line each; empty
    if there are none) and ``rest`` (a struct of the other columns), a row for
    each input row. Without ``names`` only a host's constants, and what is never
    shown, are left out.

    NULL or empty HTML gives empty text; text without markup is one block. Very
    long pages are read whole; nesting beyond DEPTH is read as if at DEPTH.
    Pages without a host form a host of their own. Equal pages of a host count
    once for its templates; a layout with fewer than AGREE different pages has
    no constants. Repeated rows get equal results. An empty table gives an empty
    result.

    Trees of all different pages are stored once; a page's tree meets its
    layout's in a join, and what is counted (nodes of a layout, by text) is
    added up map-side, so a host with most of the pages is no group of its own.
    """
    host, _, _ = url_parts(quoted(url_col))
    rows = pages.select(quoted(id_col).alias("id"), quoted(url_col).alias("url"), quoted(html_col).alias("html"), rest_struct(pages, id_col, url_col, html_col).alias("rest"), host.alias("host"))
    templates = induce(rows.select("host", "html"))
    # layouts matter on hosts with a template only
    hosts = templates.select(F.coalesce("host", F.lit("")).alias("__host"), F.lit(True).alias("known")).distinct()
    rows = rows.join(hosts, F.coalesce("host", F.lit("")) == F.col("__host"), "left").drop("__host")
    keyed = rows.mapInArrow(layout_rows, T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], T.StructField("layout", T.LongType())]))
    on = keyed["host"].eqNullSafe(templates["host"]) & (keyed["layout"] == templates["layout"])
    out = keyed.join(templates, on, "left").select("id", "url", "html", "rest", keyed["host"], keyed["layout"], "template", "constants")
    schema = T.StructType([T.StructField(c, out.schema[c].dataType) for c in ("id", "url", "rest")]).add("text", T.StringType())
    return out.mapInArrow(extract_rows(names), schema)
