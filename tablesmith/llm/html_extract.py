"""Main text of web pages by boosted trees over DOM nodes.

A page is parsed to a tree of its block elements. Each node has features: its
tag and attribute tokens and those of its ancestors, depth, the amount and
density of text, links and tags in its subtree, and its place among its
siblings. Gradient-boosted trees give each node the log-odds of belonging to
the article. Decoding is hierarchical: a node is *article* (with all of its
subtree), *rest* (with all of its subtree) or *mixed* (its children decide),
and a dynamic program over the tree takes the assignment of the largest total
log-odds, so an ancestor and a descendant never contradict each other.

The model is trained on ``TRAINING_PAGES`` pages (by the hash of their id).
Their article and other parts are taken apart by the meaning of their elements,
and put together again in ``VARIANTS`` layouts with known truth: with other
elements and attributes for the same parts, without telling names, and with the
kinds of parts that a page may have (menus, headers, sidebars, notices,
adverts, forms, comments). So the trees learn what both names and shape of a
part say, not the layout of the pages they were trained on. The training size
is bounded; each page is extracted whole, in one pass without a shuffle.

Text: character references are decoded, white space in a block becomes one
space, blocks are joined in page order by an empty line.

Defined results: null and empty pages give an empty text; pages without any
article text as well; broken markup is read as far as it goes (an open element
ends with its parent, an open comment or script with the page, a tag with an open
quote at its first ``>``); very long and broken pages take time in proportion to
their length; repeated rows are extracted each; an empty table gives an empty
result; only the kept columns, ``page_id`` and ``html`` are read, so other
columns may have any name.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.llm.boosting import BoostedTrees
from tablesmith.llm.common import hash_sample

TRAINING_PAGES = 240
VARIANTS = 4
CHUNK_ROWS = 256
MIXED_COST = 0.5

# Elements of HTML by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math".split())
#: What a head may hold; anything else ends it, also without its end tag.
HEAD_TAGS = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
HIDDEN = frozenset("script style title textarea noscript iframe template svg math head select option button object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
REST_TAGS = frozenset("nav header footer aside form menu dialog fieldset button select label".split())
ARTICLE_TAGS = frozenset("article main".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt td th".split())
REST_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary contentinfo consent cookie cookies "
    "copyright dialog disclaimer discussion disqus footer form gdpr header links login masthead menu menubar meta modal nav navbar "
    "navigation newsletter notice notification pager pagination popup privacy promo promoted related replies reply respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar widget widgets alert aside".split()
)
ARTICLE_WORDS = frozenset("article articlebody body content entry main maincontent post postbody prose story text page".split())

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_COMMENT_END = re.compile(r"--\s*>")
#: The end of a tag, or a name and, after an equals sign, a quote that opens a value or a value without quotes.
_IN_TAG = re.compile(r"""[\s/]*(?:(>)|[^\s/>][^\s/>=]*(?:\s*=\s*(?:(["'])|[^\s>"'][^\s>]*)?)?)""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_NAME = re.compile(r"[a-z]+", re.I)


class Node:
    __slots__ = ("tag", "words", "parent", "children", "items", "own", "text", "links", "tags", "parts", "depth", "place")

    def __init__(self, tag: str, words: frozenset, parent: "Node | None"):
        self.tag, self.words, self.parent = tag, words, parent
        self.children: list[Node] = []
        self.items: list = []  # texts and child nodes in page order
        self.own = self.text = self.links = self.tags = self.parts = self.place = 0
        self.depth = parent.depth + 1 if parent else 0


class _Tokens:
    """Markup of a page from left to right, each character a bounded number of
    times. Quotes count only where they open a value. A tag whose quotes are
    still open at the end of the page ends at its first ``>``, and so do all
    tags after it; a ``<`` without any ``>`` behind it is text."""

    def __init__(self, page: str):
        self.page, self.quoted = page, True
        self.last = {c: page.rfind(c) for c in "<>\"'"}

    def _end_of_tag(self, at: int) -> int:
        """The place of the tag's ``>``."""
        page, start = self.page, at
        while self.quoted:
            m = _IN_TAG.match(page, at)
            if not m:
                break
            if m[1]:
                return m.start(1)
            at = m.end()
            if m[2]:
                if self.last[m[2]] < at:
                    break
                at = page.index(m[2], at) + 1
        self.quoted = False
        return page.index(">", start)

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start and end of the next markup, tag (empty: none), whether it is an
        end tag, attributes."""
        page = self.page
        while at <= self.last["<"]:
            m = _OPEN.search(page, at)
            if not m:
                return None
            if m[1]:
                end = _COMMENT_END.search(page, m.end())
                return m.start(), end.end() if end else len(page), "", False, ""
            if m[2]:
                end = page.find("]]>", m.end())
                return m.start(), end + 3 if end >= 0 else len(page), "", False, ""
            if self.last[">"] < m.end():
                return None
            if m[3]:
                return m.start(), page.index(">", m.end()) + 1, "", False, ""
            end = self._end_of_tag(m.end())
            return m.start(), end + 1, m[5], bool(m[4]), page[m.end() : end]
        return None


def _attribute_words(attributes: str) -> frozenset:
    if "=" not in attributes:
        return frozenset()
    out: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2])
        out.update(w.lower() for w in _NAME.findall(value))
    return frozenset(out)


def parse(page: str) -> Node:
    """The tree of block elements; texts of inline elements belong to the block around them."""
    root = Node("html", frozenset(), None)
    stack: list[tuple[str, Node | None]] = []  # open elements; inline ones have no node
    count: Counter[str] = Counter()  # of the open elements
    tokens = _Tokens(page)
    here, links, run, at, n = root, 0, [], 0, len(page)
    hidden = 0  # open hidden elements

    def flush() -> None:
        nonlocal run
        if run:
            text = " ".join("".join(run).split())
            run = []
            if text:
                here.items.append(text)
                here.own += len(text)

    def close(to: int) -> None:
        nonlocal here, links, hidden
        while len(stack) > to:
            tag, node = stack.pop()
            count[tag] -= 1
            if tag == "a":
                links -= 1
            elif tag in HIDDEN:
                hidden -= 1
            if node is not None:
                flush()
                here = node.parent

    def push(tag: str, node: "Node | None") -> None:
        stack.append((tag, node))
        count[tag] += 1

    def find(tags, stop=frozenset()) -> int:
        if not any(count[t] for t in tags):
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stop:
                return -1
        return -1

    while at < n:
        found = tokens.next(at)
        text = page[at : found[0]] if found else page[at:]
        if hidden and stack[-1][0] == "head" and text.strip():
            close(len(stack) - 1)
        if text and not hidden:
            if "&" in text:
                text = html.unescape(text)
            run.append(text)
            if links:
                here.links += len(text.strip())
        if not found:
            break
        _, at, tag, closing, attributes = found
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "p" and find({"p"}) < 0:
                flush()
                continue
            i = find({tag}, CLOSES_P - {tag} if tag in INLINE or tag == "p" else frozenset())
            if i >= 0:
                close(i)
            continue
        if hidden and tag not in HEAD_TAGS and (i := find({"head"})) >= 0:
            close(i)
        if tag in ("svg", "math") and attributes.rstrip().endswith("/"):
            here.tags += 1
            continue
        if tag in RAW:  # up to its end tag nothing is markup
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            here.tags += 1
            continue
        if tag in CLOSES_P:
            i = find({"p"}, {"article", "aside", "body", "button", "div", "footer", "header", "main", "nav", "section", "table", "td"})
            if i >= 0:
                close(i)
        if tag in SAME_KIND:
            i = find(SAME_KIND[tag], SCOPE[tag])
            if i >= 0:
                close(i)
        here.tags += 1
        if tag in ("html", "body"):
            continue
        if tag == "br":
            run.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            if tag == "a":
                i = find({"a"}, CLOSES_P)
                if i >= 0:
                    close(i)
                links += 1
            push(tag, None)
            continue
        if tag in HIDDEN:
            hidden += 1
            push(tag, None)
            continue
        flush()
        node = Node(tag, _attribute_words(attributes), here)
        here.children.append(node)
        here.items.append(node)
        push(tag, node)
        here = node
    close(0)
    flush()
    return root


def preorder(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node.children))
    return out


def features(nodes: list[Node]) -> list[list[float]]:
    """Of each node of a tree in preorder."""
    total = 0
    for node in nodes:
        node.place = total
        total += node.own
        node.text = node.own
        node.parts = 1 if node.tag in TEXT_TAGS and node.own else 0
    for node in reversed(nodes):
        if p := node.parent:
            p.text += node.text
            p.links += node.links
            p.tags += node.tags
            p.parts += node.parts
    total = max(1, total)
    seen: dict[int, tuple[int, int]] = {}
    place = {id(c): k for node in nodes for k, c in enumerate(node.children)}
    out = []
    for node in nodes:
        p = node.parent
        above = seen[id(p)] if p else (0, 0)
        rest = int(node.tag in REST_TAGS) + int(not REST_WORDS.isdisjoint(node.words))
        good = int(node.tag in ARTICLE_TAGS) + int(not ARTICLE_WORDS.isdisjoint(node.words))
        seen[id(node)] = (above[0] + rest, above[1] + good)
        siblings = p.children if p else [node]
        at = place.get(id(node), 0)
        before = siblings[at - 1] if at else None
        after = siblings[at + 1] if at + 1 < len(siblings) else None
        out.append(
            [
                rest, good, above[0], above[1],
                float(node.tag == "p"), float(node.tag[0] == "h" and node.tag[1:].isdigit()), float(node.tag == "li"),
                float(node.tag in ("ul", "ol", "menu", "dl")), float(node.tag in ("div", "section")), float(bool(node.words)),
                float(node.depth), math.log1p(node.own), math.log1p(node.text), node.text / total,
                node.links / max(1, node.text), math.log1p(node.text / max(1, node.tags)), node.own / max(1, node.text),
                float(node.parts), math.log1p(len(node.children)),
                node.text / max(1, p.text) if p else 1.0, (p.links / max(1, p.text)) if p else 0.0, math.log1p(p.text) if p else 0.0,
                float(p.parts) if p else 0.0, float(len(siblings)), at / len(siblings),
                math.log1p(before.text) if before else -1.0, math.log1p(after.text) if after else -1.0,
                node.place / total, 1 - (node.place + node.text) / total,
            ]
        )
    return out


def chosen_texts(root: Node, nodes: list[Node], margins: np.ndarray) -> list[str]:
    """Texts of the article part, decoded over the tree."""
    odds = dict(zip(map(id, nodes), margins.tolist()))
    article, best = {}, {}
    for node in reversed(nodes):
        # log-odds against "rest" for the whole subtree; nodes without text have no say
        own = odds[id(node)] if node.own else 0.0
        article[id(node)] = own + sum(article[id(c)] for c in node.children)
        mixed = max(own, 0.0) + sum(best[id(c)][0] for c in node.children) - MIXED_COST if node.children else -math.inf
        options = [(article[id(node)] + 0.25 * odds[id(node)] * (not node.own), "article"), (0.0, "rest"), (mixed, "mixed")]
        best[id(node)] = max(options)
    out: list[str] = []
    todo: list = [(root, "")]
    while todo:
        item, state = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        state = state or best[id(item)][1]
        if state == "rest":
            continue
        own = state == "article" or odds[id(item)] > 0
        todo.extend((x, "article" if state == "article" else "") for x in reversed(item.items) if own or not isinstance(x, str))
    return out


# ---------------------------------------------------------------- training
def _meaning(root: Node) -> tuple[list[Node], list[Node]]:
    """Article nodes and other parts, by the meaning of elements and attributes."""
    article, rest, todo = [], [], [root]
    while todo:
        node = todo.pop()
        if node.tag in REST_TAGS or not REST_WORDS.isdisjoint(node.words):
            rest.append(node)
        elif node.tag in ARTICLE_TAGS or not ARTICLE_WORDS.isdisjoint(node.words):
            article.append(node)
        else:
            todo.extend(reversed(node.children))
    return article, rest


def _strings(node: Node) -> list[tuple[str, str]]:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, Node):
            todo.extend((t if isinstance(t, Node) else (x.tag, t)) for t in reversed(x.items))
        else:
            out.append(x)
    return out


class _Layouts:
    """Pages put together from parts, with the truth of each node."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, options: str) -> str:
        options = options.split()
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, pool: list[str], low: int, high: int) -> str:
        n, at = int(self.rng.integers(low, high)), int(self.rng.integers(max(1, len(pool) - high)))
        return html.escape(" ".join(pool[at : at + n]) or "x")

    def wrap(self, tags: str, names: str, inside: str, plain: float) -> str:
        """An element for a part: by tag, by attribute, or without a telling name."""
        if self.chance(plain):
            return f"<div>{inside}</div>"
        tag = self.pick(tags)
        if tag in ("div", "section", "ul") or self.chance(0.4):
            return f'<{tag} {self.pick("class id")}="{self.pick(names)}">{inside}</{tag}>'
        return f"<{tag}>{inside}</{tag}>"

    def links(self, pool: list[str], low: int, high: int) -> str:
        items = "".join(f'<li><a href="#">{self.words(pool, 1, 4)}</a></li>' for _ in range(int(self.rng.integers(low, high))))
        return f"<ul>{items}</ul>"

    def page(self, article: list[tuple[str, str]], pool: list[str]) -> str:
        """``x-in`` elements mark the article's blocks for the truth."""
        body, r = [], self.rng
        for tag, text in article:
            tag = tag if tag in TEXT_TAGS else "p"
            body.append(f"<{tag}>{html.escape(text)}</{tag}>")
        if self.chance(0.3) and len(body) > 3:
            at = int(r.integers(1, len(body)))
            items = "".join(f"<li>{self.words(pool, 6, 30)}</li>" for _ in range(int(r.integers(2, 6))))
            body.insert(at, f"<ul>{items}</ul>" if self.chance(0.6) else f"<blockquote><p>{self.words(pool, 10, 50)}</p></blockquote>")
        if self.chance(0.25):
            rows = "".join(f"<tr>{''.join(f'<td>{self.words(pool, 1, 8)}</td>' for _ in range(int(r.integers(2, 4))))}</tr>" for _ in range(int(r.integers(1, 5))))
            body.insert(int(r.integers(1, len(body) + 1)), f"<table>{rows}</table>")
        if self.chance(0.15):  # a few words only
            body = [f"<{t}>{self.words(pool, 1, 8)}</{t}>" for t in ["h1", "p", "p"][: int(r.integers(1, 4))]]
        if self.chance(0.15):  # text without elements of its own
            body = [re.sub(r"</?p>", "<br>", b) for b in body]
        inner = [f"<x-in>{b}</x-in>" for b in body]
        if self.chance(0.4):  # a part inside the article that is none of it
            part = self.wrap("div aside section", "ad share related advert newsletter promo", self.words(pool, 3, 40), 0.0)
            inner.insert(int(r.integers(1, len(inner) + 1)), part)
        main = "".join(inner)
        style = r.random()
        if style < 0.45:
            main = f"<article>{main}</article>"
        elif style < 0.6:
            main = f"<main>{main}</main>"
        elif style < 0.85:
            main = f'<div {self.pick("class id")}="{self.pick("content post entry article-body story main-content post-content")}">{main}</div>'
        else:
            main = f"<div>{main}</div>"
        plain = 0.0 if style < 0.85 and self.chance(0.7) else 0.25
        top, end = [], []
        if self.chance(0.8):
            top.append(self.wrap("nav div ul", "menu nav navbar main-menu navigation", self.links(pool, 3, 10), plain))
        if self.chance(0.5):
            top.insert(0, self.wrap("header div", "header site-header masthead topbar", f"<p>{self.words(pool, 1, 8)}</p>", plain))
        if self.chance(0.5):
            top.append(self.wrap("div section", "cookie-notice notice consent banner alert", f"<p>{self.words(pool, 5, 40)}</p><button>OK</button>", plain))
        if self.chance(0.7):
            (top if self.chance(0.5) else end).append(self.wrap("div aside section", "ad ads advert sponsored promo-banner", self.words(pool, 3, 60), 0.0))
        if self.chance(0.5):
            side = f"<h3>{self.words(pool, 1, 4)}</h3>" + (self.links(pool, 3, 8) if self.chance(0.6) else f"<p>{self.words(pool, 5, 60)}</p>")
            (top if self.chance(0.3) else end).append(self.wrap("aside div", "sidebar widget side-bar related", side, plain))
        if self.chance(0.4):
            fields = f'<label>{self.words(pool, 1, 4)}</label><input type="text"><p>{self.words(pool, 2, 12)}</p>'
            end.append(f'<form action="#">{fields}</form>' if self.chance(0.7) else self.wrap("div section", "newsletter subscribe search login", f"<form>{fields}</form>", 0.0))
        if self.chance(0.5):
            each = "".join(f'<{t}><p>{self.words(pool, 5, 70)}</p></{t}>' for t in ["div" if self.chance(0.5) else "li"] * int(r.integers(1, 6)))
            end.append(self.wrap("section div", "comments comment-list discussion replies", f"<h3>{self.words(pool, 1, 3)}</h3>{each}", 0.0))
        if self.chance(0.8):
            end.append(self.wrap("footer div", "footer site-footer copyright", f"{'<p>' if self.chance(0.5) else ''}&copy; {self.words(pool, 2, 30)}", plain))
        if self.chance(0.08):
            top, end = [], []
        inside = "".join(top) + main + "".join(end)
        if self.chance(0.5):
            inside = f'<div {self.pick("class id")}="{self.pick("page wrapper container site layout")}">{inside}</div>'
        return f"<html><body>{inside}</body></html>"


def _truth(root: Node) -> tuple[list[Node], list[float]]:
    """The layout's tree without its marks: nodes in preorder and their labels."""
    labels: dict[int, float] = {}

    def strip(node: Node, inside: bool) -> None:
        children, items = [], []
        for x in node.items:
            if isinstance(x, Node) and x.tag == "x-in":
                strip(x, True)
                for y in x.items:
                    if isinstance(y, Node):
                        y.parent = node
                        children.append(y)
                    items.append(y)
                node.tags += x.tags
                node.own += x.own
                inside = inside or x.own > 0
                continue
            if isinstance(x, Node):
                strip(x, inside)
                children.append(x)
            items.append(x)
        node.children, node.items = children, items
        labels[id(node)] = float(inside)

    strip(root, False)
    nodes = preorder(root)
    for node in nodes:
        node.depth = node.parent.depth + 1 if node.parent else 0
    return nodes, [labels[id(n)] for n in nodes]


def train(pages: list[str]) -> BoostedTrees | None:
    x, y = [], []
    for number, page in enumerate(pages):
        root = parse(page)
        article, rest = _meaning(root)
        texts = [s for a in article for s in _strings(a)]
        pool = [w for part in [*rest, *article] for _, s in _strings(part) for w in s.split()]
        if not texts or not pool:
            continue
        layouts = _Layouts(number)
        for v in range(VARIANTS):
            texts_v = texts if v % 2 == 0 else texts[: max(1, len(texts) // 3)]
            nodes, labels = _truth(parse(layouts.page(texts_v, pool)))
            for f, label, node in zip(features(nodes), labels, nodes):
                # nodes with text, and blocks of one kind only, have a truth
                if node.own or label:
                    x.append(f)
                    y.append(label)
                elif node.text and not any(labels[i] for i, m in enumerate(nodes) if _inside(m, node)):
                    x.append(f)
                    y.append(0.0)
                elif node.text and node.tag in ("article", "main", "div") and node.parent is not None:
                    inner = [(labels[i], m.own) for i, m in enumerate(nodes) if m is not node and _inside(m, node)]
                    share = sum(label * own for label, own in inner) / max(1, sum(own for _, own in inner))
                    if share > 0.9:
                        x.append(f)
                        y.append(1.0)
    if not x or len(set(y)) < 2:
        return None
    return BoostedTrees().fit(np.array(x), np.array(y))


def _inside(node: Node | None, ancestor: Node) -> bool:
    while node is not None:
        if node is ancestor:
            return True
        node = node.parent
    return False


def fit(pages: DataFrame) -> BoostedTrees | None:
    """Trained on a bounded sample of the table."""
    sample = hash_sample(pages.where("html is not null").select("page_id", "html"), TRAINING_PAGES, "page_id", "html")
    return train([r["html"] for r in sample.collect()])


def extract_texts(pages: list[str | None], model: BoostedTrees | None) -> list[str]:
    trees = [parse(p or "") for p in pages]
    all_nodes = [preorder(t) for t in trees]
    rows = [f for nodes in all_nodes for f in features(nodes)]
    margins = model.margin(np.array(rows)) if model and rows else np.array([f[3] + f[1] - 2.0 * (f[0] + f[2]) for f in rows])
    out, at = [], 0
    for tree, nodes in zip(trees, all_nodes):
        out.append("\n\n".join(chosen_texts(tree, nodes, margins[at : at + len(nodes)])))
        at += len(nodes)
    return out


def extract(pages: DataFrame, model: BoostedTrees | None, keep: list[str]) -> DataFrame:
    """``keep`` columns and the main ``text``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a fixed number of trees
    fields = [pages.schema[c] for c in keep] + [T.StructField("text", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                texts = extract_texts(part.column(len(keep)).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[f.name for f in fields])

    return pages.select(*keep, F.col("html").alias("page_html")).mapInArrow(run, T.StructType(fields))
