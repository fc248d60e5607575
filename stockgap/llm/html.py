"""HTML extraction by wrapper induction.

Every page is parsed once.  In its DOM tree, runs of like sibling text blocks
and inline elements are folded into one node; pages of a host with equal folded
trees have one shape.  Shapes of like outline (the labels of the upper levels)
form a layout.  Its commonest shape is the layout's frame, and every other
shape is aligned to it by simple tree matching: the largest matching of nodes
that keeps labels, parents and the order of siblings.  Nodes matched to the same
node of the frame are one place, whatever their shape.

Over all different pages of a host (equal pages once), what stands at each
place is counted.  A place where most pages say the same, and at least ``LEAST``
of them, is template there; where they differ it is a slot.  Nodes that the
frame has no partner for, and those of layouts with fewer than ``LEAST`` pages,
are placed by their path of labels instead, over all pages of the host.

The text of a page is that of all its article and main elements in page order
(else of what is named main, else of the body), without the parts that by
their tag or name are menus, ads, comments and the like, and without template
nodes: outside article and main all of them, inside only those that are no text
blocks by themselves, so that a paragraph that a host's articles share stays.
Inside an article a name takes out only containers, and only if all of its
words say so: a heading, paragraph, list item or cell stays, and so does a
section whose id is a slug of its title.  Character references are decoded,
white space inside a block becomes one space, blocks are joined by one space in
page order.

Edge cases: null and empty html give the empty text; null urls are one host;
repeated rows get a row each and count once; of two equally common shapes the
smaller hash is the frame; broken markup is read as far as it goes; texts of any
length are read whole; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_batches

LEAST = 3  # pages that must say the same before it can be template

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption".split())
FOLDED = TEXT_BLOCKS | INLINE | VOID | {"tr", "option"}
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: an opening tag that ends an open element of these names, up to a container
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select", "datalist"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"})}
DROPPED = frozenset("head nav footer aside form script style template noscript textarea select button input dialog menu svg math iframe object embed audio video canvas map title noembed noframes datalist fieldset".split())
#: words of class, id or role that name parts which are not the article
NAMES = frozenset("nav navigation navbar menu menus breadcrumb breadcrumbs footer sidebar aside ad ads adv advert adverts advertisement advertisements adsense banner sponsor "
                  "sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
                  "related recommended recommendations comment comments commentlist disqus reply replies respond responses discussion pagination pager widget toolbar masthead copyright "
                  "disclaimer search toc skip complementary contentinfo banner".split())
#: words that may stand beside them in a name of such a part
BESIDE = frozenset("area bar block body bottom box btn button buttons col column container content footer form foot group head header holder icon icons inline inner item items js "
                   "large left link links list main message module outer page panel post posts right row section slot small stories story tools top unit wrap wrapper".split())
#: ids that name such a part and are no slug of a title
PART_IDS = frozenset("comments commentlist comment-list respond disqus_thread nav navigation sidebar footer menu breadcrumbs cookie-banner newsletter".split())
_TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Node:
    tag: str
    names: frozenset[str] = frozenset()
    hidden: bool = False
    tokens: frozenset[str] = frozenset()  # the class and role tokens, whole
    ident: str = ""
    parts: list = field(default_factory=list)  # str or Node, in page order

    def children(self) -> list[Node]:
        return [x for x in self.parts if not isinstance(x, str)]


def _attributes(source: str) -> dict:
    names, tokens, hidden, ident = set(), set(), False, ""
    for m in _ATTR.finditer(source):
        key, value = m[1].lower(), next((x for x in m.groups()[1:] if x is not None), "")
        if key in ("class", "id", "role"):
            names.update(_WORD.findall(value.lower()))
            if key == "id":
                ident = value.strip().lower()
            else:
                tokens.update(value.lower().split())
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    return {"names": frozenset(names), "hidden": hidden, "tokens": frozenset(tokens), "ident": ident}


def parse(source: str) -> Node:
    """The DOM of a page; tolerant of unclosed, misnested and stray tags."""
    root = Node("#page")
    stack, at = [root], 0

    def close(upto: int) -> None:
        del stack[upto:]

    while m := _TAG.search(source, at):
        if m.start() > at:
            stack[-1].parts.append(source[at: m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                stack[-1].parts.append(entities.escape(m[0][9:-3]))
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag; an inline one does not end blocks around it
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE or tag == "p" and stack[i].tag not in INLINE:
                    break
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        if tag in IMPLIED:
            ends, within = IMPLIED[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in within:
                    break
                if stack[i].tag in ends:
                    close(i)
                    if tag not in ("tr", "tbody"):
                        break
        node = Node(tag, **(_attributes(m[3]) if m[3] and not m[3].isspace() else {}))
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            node.parts.append(source[at: end.start() if end else len(source)])
            at = end.end() if end else len(source)
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    if at < len(source):
        stack[-1].parts.append(source[at:])
    return root


def _named_away(node: Node, in_article: bool) -> bool:
    """Whether the names of an element say that it is no part of an article."""
    if not in_article:
        return not node.names.isdisjoint(NAMES) or "header" in node.names
    if node.tag in TEXT_BLOCKS:
        return False
    said = [set(_WORD.findall(t)) for t in node.tokens]
    return node.ident in PART_IDS or bool(said) and all(w <= NAMES | BESIDE for w in said) and any(w & NAMES for w in said)


def dropped(node: Node, in_article: bool) -> bool:
    """Whether the element is no part of an article, by its tag or names."""
    if node.tag in DROPPED or node.hidden or node.tag == "header" and not in_article:
        return True
    return node.tag not in ("html", "body", "main", "article") and _named_away(node, in_article)


def _removable(node: Node, in_article: bool) -> bool:
    """Whether the element goes if it is template."""
    return not in_article or node.tag not in TEXT_BLOCKS and node.tag not in INLINE and not any(y.tag in TEXT_BLOCKS for y in node.children())


Piece = tuple[tuple[int, ...], str]


def _walk(node: Node, in_article: bool, chain: tuple[int, ...], out: list[Piece]) -> list[Piece]:
    """The pieces of text below ``node`` in page order, each with the chain of
    elements (by id) that take it along if they are template."""
    for x in node.parts:
        if isinstance(x, str):
            out.append((chain, entities.unescape(x)))
        elif x.tag in ("br", "hr"):
            out.append((chain, " "))
        elif dropped(x, in_article) or in_article and _aside(x):
            if x.tag in CLOSES_P:  # what stands around a block stays apart without it
                out.append((chain, "\n"))
        else:
            own = (*chain, id(x)) if _removable(x, in_article) else chain
            if x.tag in INLINE:
                _walk(x, in_article, own, out)
            else:
                out.append((chain, "\n"))
                _walk(x, in_article, own, out)
                out.append((chain, "\n"))
    return out


def _spaced(pieces: Iterable[str]) -> str:
    """Blocks are set apart by white space already: one space between words."""
    return " ".join("".join(pieces).split())


def text_in(node: Node, in_article: bool = True) -> str:
    """The text of ``node``: its blocks, each with single spaces, joined by one."""
    return _spaced(x for _, x in _walk(node, in_article, (), []))


def _find(node: Node, tags: tuple[str, ...], named: str, found: list[Node]) -> list[Node]:
    """The topmost elements of these tags or with this name."""
    for x in node.children():
        if not dropped(x, False) or x.tag in tags:
            if x.tag in tags or named in x.names:
                found.append(x)
            else:
                _find(x, tags, named, found)
    return found


def _aside(node: Node) -> bool:
    """Whether an article element is a comment, a teaser or the like by its names."""
    return node.tag == "article" and not node.names.isdisjoint(NAMES)


# ---- wrappers -------------------------------------------------------------

@dataclass
class Folded:
    """A DOM as a list of nodes in preorder: label, children, the hash-like
    text of each, and the DOM nodes that were folded into it."""
    labels: list[str]
    kids: list[list[int]]
    texts: list[str]
    members: list[list[Node]]


def fold(root: Node) -> Folded:
    """The element tree; runs of siblings of one label as one node, if FOLDED."""
    out = Folded([], [], [], [])

    def add(nodes: list[Node]) -> int:
        i = len(out.labels)
        first = nodes[0]
        out.labels.append(first.tag + "." + " ".join(sorted(first.names)))
        out.kids.append([])
        out.members.append(nodes)
        own = " ".join(entities.unescape(x) for n in nodes for x in n.parts if isinstance(x, str)) if first.tag not in RAW else ""
        out.texts.append(" ".join(own.split()))
        runs: list[list[Node]] = []
        for n in nodes:
            for c in n.children():
                if c.tag in FOLDED and runs and runs[-1][0].tag == c.tag and runs[-1][0].names == c.names:
                    runs[-1].append(c)
                else:
                    runs.append([c])
        out.kids[i] = [add(r) for r in runs]
        return i

    add([root])
    return out


Tree = tuple[list[str], list[list[int]]]


def tree_match(a: Tree, b: Tree, says: tuple[list, list] | None = None) -> list[tuple[int, int]]:
    """Simple tree matching: the pairs of a largest matching that keeps labels,
    parents and the order of siblings; of several, with ``says``, one with the
    most nodes that say the same."""
    (la, ka), (lb, kb) = a, b
    unit = min(len(la), len(lb)) + 1  # a node outweighs any number of equal texts
    size: dict[tuple[int, int], int] = {}
    trace: dict[tuple[int, int], list[list[int]]] = {}

    def best(i: int, j: int) -> int:
        if la[i] != lb[j]:
            return 0
        if (i, j) not in size:
            x, y = ka[i], kb[j]
            m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for r, c in enumerate(x, 1):
                for s, d in enumerate(y, 1):
                    m[r][s] = max(m[r - 1][s], m[r][s - 1], m[r - 1][s - 1] + best(c, d))
            size[i, j], trace[i, j] = unit + (says is not None and says[0][i] == says[1][j]) + m[-1][-1], m
        return size[i, j]

    # deepest first, so that no recursion goes below the next level
    depth = [0] * len(la)
    for i, kids in enumerate(ka):
        for c in kids:
            depth[c] = depth[i] + 1
    below = [0] * len(lb)
    for j, kids in enumerate(kb):
        for d in kids:
            below[d] = below[j] + 1
    level: dict[int, list[int]] = {}
    for j, d in enumerate(below):
        level.setdefault(d, []).append(j)
    for i in sorted(range(len(la)), key=lambda i: -depth[i]):
        for j in level.get(depth[i], ()):
            best(i, j)

    pairs: list[tuple[int, int]] = []
    todo = [(0, 0)] if best(0, 0) else []
    while todo:
        i, j = todo.pop()
        pairs.append((i, j))
        x, y, m = ka[i], kb[j], trace[i, j]
        r, s = len(x), len(y)
        while r and s:
            if m[r][s] == m[r - 1][s]:
                r -= 1
            elif m[r][s] == m[r][s - 1]:
                s -= 1
            else:
                todo.append((x[r - 1], y[s - 1]))
                r, s = r - 1, s - 1
    return pairs


def _hash(*parts: str | int) -> int:
    return int.from_bytes(hashlib.blake2b(json.dumps(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _paths(labels: list[str], kids: list[list[int]]) -> list[int]:
    """A hash of the labels from the root down to each node."""
    path = [0] * len(labels)
    for i, label in enumerate(labels):  # parents come before their children
        path[i] = _hash(path[i], label)
        for c in kids[i]:
            path[c] = path[i]
    return path


def _says(page: Folded) -> list[int]:
    """A hash of what each node says, all the way down."""
    says = [0] * len(page.labels)
    for i in range(len(page.labels) - 1, -1, -1):
        says[i] = _hash(page.labels[i], page.texts[i], *(says[c] for c in page.kids[i]))
    return says


def _outline(labels: list[str], kids: list[list[int]], depth: int = 3) -> int:
    """What layouts are told apart by: the labels of the upper levels."""
    seen, row = [], [0]
    for _ in range(depth + 1):
        seen.append(sorted({labels[i] for i in row}))
        row = [c for i in row for c in kids[i]]
    return _hash(*map(json.dumps, seen))


def pieces(root: Node) -> list[Piece]:
    """The pieces of the article's text, see :func:`_walk`."""
    articles = [x for x in _find(root, ("article", "main"), "", []) if not _aside(x)] or _find(root, ("main",), "main", [])
    if not articles:
        return _walk(root, False, (), [])
    out: list[Piece] = []
    for x in articles:
        out = [*_walk(x, True, (), out), ((), "\n")]
    return out


def main_text(source: str) -> str:
    """The article's text of a page by tags and names alone ("" if there is none)."""
    return _spaced(x for _, x in pieces(parse(source)))


def digest(source: str) -> tuple:
    """What extraction needs of a page: (layout, shape, tree, says, texts,
    chains): the folded tree as JSON, and the pieces of text, merged, with the
    folded nodes that take them along."""
    root = parse(source)
    page = fold(root)
    node = {id(n): i for i, nodes in enumerate(page.members) for n in nodes}
    texts: list[list[str]] = []
    chains: list[tuple[int, ...]] = []
    for chain, x in pieces(root):
        if not chains or chain != chains[-1]:
            chains.append(chain)
            texts.append([])
        texts[-1].append(x)
    tree = json.dumps([page.labels, page.kids])
    says = _says(page) if any(chains) else [0] * len(page.labels)  # nothing to take along, nothing to compare
    return (_outline(page.labels, page.kids), _hash(tree), tree, says, ["".join(x) for x in texts], [[node[i] for i in c] for c in chains])


_DIGEST = T.StructType([T.StructField("layout", T.LongType()), T.StructField("shape", T.LongType()), T.StructField("tree", T.StringType()),
                        T.StructField("says", T.ArrayType(T.LongType())), T.StructField("texts", T.ArrayType(T.StringType())),
                        T.StructField("chains", T.ArrayType(T.ArrayType(T.IntegerType())))])


@F.pandas_udf(_DIGEST)
def _digest(sources: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([digest(x) for x in sources], columns=_DIGEST.names)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _placed(tree: pd.Series, says: pd.Series, frame: pd.Series, frame_says: pd.Series, layout: pd.Series, aligned: pd.Series) -> pd.Series:
    """The place of each node of a shape: its partner in the frame, else its path."""
    def one(t, s, f, g, which, by_frame):
        labels, kids = json.loads(t)
        place = _paths(labels, kids)
        if by_frame:
            for i, j in tree_match((labels, kids), tuple(json.loads(f)), (s.tolist(), g.tolist())):
                place[i] = _hash("frame", which, j)
        return place
    return pd.Series([one(*x) for x in zip(tree, says, frame, frame_says, layout.tolist(), aligned)], dtype=object)


@F.pandas_udf(T.StringType())
def _kept(texts: pd.Series, chains: pd.Series, says: pd.Series, template: pd.Series) -> pd.Series:
    def one(texts, chains, says, template):
        gone = set() if template is None else {t["node"] for t in template if says[t["node"]] == t["says"]}
        return _spaced(x for x, c in zip(texts, chains) if gone.isdisjoint(c))
    return pd.Series([one(*x) for x in zip(texts, chains, says, template)], dtype=object)


def host(url: Column) -> Column:
    """The host of a url in lower case ("" for null and what has none)."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, shape, template): for each shape the nodes that are template and
    what they then say, from the digests of all different pages of a host
    (host, layout, shape, tree, says, chains).

    Only nodes that take text along are counted, by shape first; a shape has
    one row per node afterwards, and a place one template.
    """
    key = ["host", "shape"]
    nodes = F.array_distinct(F.flatten("chains"))
    shapes = staged(pages.groupBy(*key).agg(F.count(F.lit(1)).alias("pages"), F.first("layout").alias("layout"),
                                            F.min(F.struct("page", "tree", "says")).alias("one")).select(*key, "pages", "layout", "one.tree", "one.says"))
    layouts = shapes.groupBy("host", "layout").agg(F.sum("pages").alias("all"), F.max(F.struct("pages", "shape", "tree", "says")).alias("frame"))
    place = _placed("tree", "says", "frame.tree", "frame.says", "layout", F.col("all") >= least)
    places = staged(shapes.join(layouts, ["host", "layout"]).select(*key, "pages", F.posexplode(place).alias("node", "place")))
    said = pages.select(*key, "says", F.explode(nodes).alias("node")).select(*key, "node", F.element_at("says", F.col("node") + 1).alias("says")).groupBy(
        *key, "node", "says").agg(F.count(F.lit(1)).alias("n"))
    # like siblings of an unaligned shape share a path: the page counts once
    at = staged(said).join(places.drop("pages"), [*key, "node"]).groupBy(*key, "place", "says").agg(F.max("n").alias("n"))
    constant = at.groupBy("host", "place", "says").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    total = places.select(*key, "place", "pages").distinct().groupBy("host", "place").agg(F.sum("pages").alias("all"))
    template = constant.join(total, ["host", "place"]).where("2 * n > all").select("host", "place", "says")
    return places.select(*key, "node", "place").join(template, ["host", "place"]).groupBy(*key).agg(F.collect_list(F.struct("node", "says")).alias("template"))


def extract(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, text) per row of ``pages``; null html: the empty text.

    A host with fewer than ``least`` different pages has no wrapper; its
    pages are judged by tags and names alone.
    """
    html = F.coalesce(pages["html"], F.lit(""))
    rows = staged(text_batches(pages).select(pages["page_id"].alias("page_id"), pages["url"].alias("url"), host(pages["url"]).alias("host"),
                                             F.xxhash64(html).alias("page"), _digest(html).alias("x")).select("page_id", "url", "host", "page", "x.*"))
    different = rows.select("host", "page", "layout", "shape", "tree", "says", "chains").dropDuplicates(["host", "page"])
    found = rows.drop("tree").join(staged(wrappers(different, least)), ["host", "shape"], "left")
    return found.select("page_id", "url", _kept("texts", "chains", "says", "template").alias("text"))
