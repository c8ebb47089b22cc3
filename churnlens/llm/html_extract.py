"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

A page is parsed into block elements and text runs (inline markup is
flattened).  Every node has features: size and density of its subtree, link
share, tokens of tag and attributes (its own, of its ancestors and of its
descendants), depth and sibling statistics.  Boosted trees give the log-odds
that the node's subtree holds main text.  Decoding picks the most likely
labelling in which a node without main text has no descendant with it: bottom
up, a subtree is either dropped whole or kept with each child's best choice.

The model is trained on ``TRAIN_PAGES`` pages of the table (smallest hash of
page_id).  A page's article is told by its markup (article, main); each
training page is also varied: the article's element gets another name and
blocks of other pages' text are put into and around it as sidebars, notices,
adverts, forms, menus and comments, so that the trees learn the tokens and
shapes of such blocks and not the place of one template.

Defined cases: null or empty html gives the empty text; markup without closing
tags is closed as browsers do for p, li, td and the like; a button, select,
svg or the like without its end tag ends at the first block or at the end of
the element around it; repeated pages give
equal rows; a table without trainable pages uses the built-in variations of
``SEED_PAGE`` alone; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from bisect import bisect_right
from collections.abc import Container, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from churnlens.llm import boosting
from churnlens.llm.common import bounded_batches, bounded_sample

TRAIN_PAGES = 150
VARIANTS = 2

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S
)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style|data-truth)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Begin of a tag, or (with a mark) of a declaration; comments and CDATA end anyway.
_BEGIN = re.compile(r"<(?!!--|!\[CDATA\[)(?:([!?])|/?[a-zA-Z])")
_depth = attrgetter("depth")

#: Elements of raw text, up to their end tag, and others whose content is never text of the page.
_RAW = frozenset("script style title textarea iframe".split())
_SKIP = frozenset("template noscript svg object select button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
_CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
}
#: An implied end never reaches past these.
_SCOPE = frozenset("html body table ul ol dl div section article main nav aside header footer form td th blockquote".split())

_BOILER = frozenset(
    "nav menu navbar navigation header masthead footer sidebar aside ad ads adv advert advertisement advertising banner promo promotion sponsor sponsored "
    "cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommend recommended "
    "comment comments reply replies disqus respond breadcrumb breadcrumbs pagination pager login search form widget toolbar copyright legal disclaimer "
    "tags author meta byline trending popular outbrain taboola skip hidden none complementary contentinfo navigation dialog gdpr privacy paywall toc".split()
)
_CONTENT = frozenset("article content contents main post entry story body text prose page news blog document paragraph".split())

_HEAD, _PARA, _ITEM, _CELL, _BOX = (frozenset(x.split()) for x in ("h1 h2 h3 h4 h5 h6", "p pre blockquote", "li dt dd", "td th caption", "div section"))
_BLOCK = _SCOPE | _HEAD | _PARA | _ITEM | _CELL | frozenset("tr fieldset figure address details dialog".split())
_NAVISH, _MAINISH = frozenset("nav header footer aside form menu fieldset dialog".split()), frozenset("article main".split())


class Node:
    __slots__ = ("tag", "parent", "kids", "text", "link", "own", "good", "truth", "chars", "links", "count", "paras", "items", "marks", "bad_below", "good_below", "depth")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent = tag, parent
        self.kids: list[Node] = []
        self.text, self.link = "", 0
        self.own = self.good = 0
        self.truth: bool | None = None
        self.depth = parent.depth + 1 if parent else 0


def _describe(node: Node, attrs: str) -> None:
    words = [node.tag]
    for m in _ATTR.finditer(attrs) if attrs else ():
        name = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            words += _WORD.findall(value)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            words.append("hidden")
        elif name == "data-truth":
            node.truth = value == "1"
    node.own = sum(w in _BOILER for w in words)
    node.good = sum(w in _CONTENT for w in words)


def _raw_end(page: str, at: int, tag: str) -> int:
    end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def _skip_end(page: str, at: int, tag: str, around: Container[str], last: int) -> int:
    """Where an element of _SKIP ends: behind its end tag (the page's last one is at ``last``).

    One without an end tag, before the end of an element around it or the next
    button or select, ends at the first block in it.
    """
    inside, block = [tag], None
    while m := _TOKEN.search(page, at):
        a, at = m.start(), m.end()
        if m[2] is None:
            continue
        t = m[2].lower()
        if m[1]:
            if t in inside:
                while inside.pop() != t:
                    pass
                if not inside:
                    return at
            elif t in around:
                return a if block is None else block
        elif t == tag and tag in ("button", "select"):
            return a if block is None else block
        elif t in _RAW:
            at = _raw_end(page, at, t)
        elif t not in _VOID and not m[3].endswith("/"):
            inside.append(t)
            if t in _BLOCK and block is None:
                block = a
        if block is not None and a > last:
            return block
    return len(page) if block is None else block


def _closable(page: str) -> str:
    """The page, each < whose tag or declaration never ends written as &lt;, so that no search for an end runs in vain."""
    marks = [(m.start(), m[0]) for m in re.finditer("""[>"']""", page)]
    # whether a tag that goes on at a mark, outside quotes, comes to its end; right to left
    ends = [False] * (len(marks) + 1)
    later: dict[str, int] = {}
    for k in range(len(marks) - 1, -1, -1):
        c = marks[k][1]
        ends[k] = c == ">" or (c in later and ends[later[c] + 1])
        later[c] = k
    final, k, out, done = page.rfind(">"), 0, [], 0
    for m in _BEGIN.finditer(page):
        while k < len(marks) and marks[k][0] < m.start():
            k += 1
        if m.start() > final or not (m[1] or ends[k]):
            out += [page[done : m.start()], "&lt;"]
            done = m.start() + 1
    return "".join(out) + page[done:] if out else page


def parse(page: str) -> Node:
    """The page's block elements and text runs (tag #text)."""
    page = _closable(page)
    root = cur = Node("#root", None)
    run: list[str] = []
    link = in_link = 0
    last: dict[str, int] = {}
    #: open elements by tag, outermost first; tags without any are left out
    opened: dict[str, list[Node]] = {}

    def close(node: Node) -> None:
        """End the open elements up to ``node``."""
        nonlocal cur
        up = cur
        while True:
            same = opened[up.tag]
            same.pop()
            if not same:
                del opened[up.tag]
            if up is node:
                break
            up = up.parent
        cur = node.parent

    def end_run() -> None:
        nonlocal link
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                leaf = Node("#text", cur)
                leaf.text, leaf.link = text, min(link, len(text))
                cur.kids.append(leaf)
            run.clear()
        link = 0

    def piece(a: int, b: int) -> None:
        nonlocal link
        if b > a:
            run.append(page[a:b])
            if in_link:
                link += b - a

    at = 0
    while m := _TOKEN.search(page, at):
        piece(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # end tag
            if tag == "a":
                in_link = 0
            if tag in _INLINE or tag in _VOID:
                continue
            if tag in opened:
                end_run()
                close(opened[tag][-1])
            continue
        if tag in _RAW:
            at = _raw_end(page, at, tag)
            continue
        if tag in _SKIP:
            if tag == "svg" and m[3].endswith("/"):
                continue
            if tag not in last:
                last[tag] = max((e.start() for e in re.finditer(f"</{tag}\\b", page, re.I)), default=-1)
            at = _skip_end(page, at, tag, opened, last[tag])
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in _INLINE or tag in _VOID:
            if tag == "a":
                in_link = 1
            elif tag == "hr":
                end_run()
            continue
        end_run()
        in_link = 0
        # an open p ends at any block; li, td and the like end their own kind
        closes = _CLOSES.get(tag)
        if closes:
            scope = max((opened[t][-1].depth for t in _SCOPE if t in opened and t not in closes), default=0)
            inside = [(x := opened[t])[k] for t in (*closes, "p") if t in opened and (k := bisect_right(opened[t], scope, key=_depth)) < len(opened[t])]
            if inside:
                close(min(inside, key=_depth))
        else:
            while cur.tag == "p":
                close(cur)
        node = Node(tag, cur)
        _describe(node, m[3])
        cur.kids.append(node)
        opened.setdefault(tag, []).append(node)
        cur = node
    piece(at, len(page))
    end_run()
    return root


def preorder(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(reversed(n.kids))
    return out


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node, in preorder."""
    for n in reversed(nodes):  # children before parents
        if n.tag == "#text":
            n.chars, n.links = len(n.text), n.link
            n.marks = sum(map(n.text.count, ".,!?"))
            n.count = n.paras = n.items = n.bad_below = n.good_below = 0
        else:
            k = n.kids
            n.chars, n.links, n.marks = sum(c.chars for c in k), sum(c.links for c in k), sum(c.marks for c in k)
            n.count = sum(c.count + 1 for c in k)
            n.paras = sum(c.paras for c in k) + (n.tag == "p")
            n.items = sum(c.items for c in k) + (n.tag == "li")
            n.bad_below = sum(c.bad_below + (c.own > 0) for c in k)
            n.good_below = sum(c.good_below + (c.good > 0) for c in k)
    total = max(1, nodes[0].chars)
    place: dict[int, tuple[int, int, int]] = {id(nodes[0]): (0, 1, 0)}
    above: dict[int, tuple[int, int]] = {id(nodes[0]): (0, 0)}
    rows, before = [], 0
    for n in nodes:
        i, of, sib = place[id(n)]
        bad, good = above[id(n)]
        for j, c in enumerate(n.kids):
            place[id(c)] = (j, len(n.kids), n.chars - c.chars)
            above[id(c)] = (bad + n.own, good + n.good)
        t = n.tag
        chars = n.chars
        rows.append(
            (
                math.log1p(chars),
                n.links / chars if chars else 0.0,
                chars / (n.count + 1),
                n.depth,
                of,
                i / of,
                chars / total,
                chars / max(1, n.parent.chars) if n.parent else 1.0,
                math.log1p(sib / max(1, of - 1)),
                n.own,
                n.good,
                bad,
                good,
                n.marks / chars if chars else 0.0,
                math.log1p(n.paras),
                math.log1p(n.items),
                t in _NAVISH,
                t in _MAINISH,
                t in _HEAD,
                t in _PARA,
                t in _ITEM,
                t in _CELL,
                t in _BOX,
                t == "#text",
                n.bad_below / (n.count + 1),
                n.good_below > 0,
                before / total,
            )
        )
        if t == "#text":
            before += chars
    return np.array(rows, np.float64)


def decode(nodes: list[Node], odds: np.ndarray) -> list[Node]:
    """Text runs that are kept by the most likely consistent labelling."""
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    drop = {id(n): float(v) for n, v in zip(nodes, no)}
    keep = {id(n): float(v) for n, v in zip(nodes, yes)}
    for n in reversed(nodes):
        for c in n.kids:
            drop[id(n)] += drop[id(c)]
            keep[id(n)] += max(keep[id(c)], drop[id(c)])
    out, todo = [], [nodes[0]]
    while todo:
        n = todo.pop()
        if keep[id(n)] > drop[id(n)] or n.tag == "#root":  # the root is no element: each of its parts decides
            if n.tag == "#text":
                out.append(n)
            todo.extend(reversed(n.kids))
    return out


# ---------------------------------------------------------------- training

SEED_PAGE = (
    "<html><head><title>T</title></head><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
    "<article><h1>A title of the page</h1><p>The first paragraph has some words, and a second part.</p><p>Another one follows. It ends here.</p></article>"
    "<footer>Copyright by the owner, all rights reserved.</footer></body></html>"
)
_WRAPS = ("<article>", "<main>", '<div class="content">', '<div id="post-body">', '<section class="story">', '<div class="entry-content">', '<div role="main">', "<div>")
_BLOCKS = (
    '<aside class="sidebar"><p>{}</p><p>{}</p></aside>',
    '<aside><h2>{}</h2><p>{}</p></aside>',
    '<div class="sidebar">{}</div>',
    '<div class="cookie-notice"><p>{}</p></div>',
    '<div id="cookie-banner">{}</div>',
    '<div class="notice">{}</div>',
    '<div class="alert">{}</div>',
    '<div class="ad">{}</div>',
    '<div class="advert"><p>{}</p></div>',
    '<div class="sponsored"><p>{}</p></div>',
    '<section class="comments"><h2>{}</h2><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></section>',
    '<div id="comments"><p>{}</p><p>{}</p></div>',
    '<form action="/s"><label>{}</label><input name="q"><p>{}</p></form>',
    '<form>{}</form>',
    '<div class="newsletter"><p>{}</p><form><input></form></div>',
    '<div class="related"><ul><li><a href="/x">{}</a></li><li><a href="/y">{}</a></li></ul></div>',
    '<ul class="menu"><li><a href="/x">{}</a></li><li><a href="/y">{}</a></li></ul>',
    '<div><ul><li><a href="/x">{}</a></li><li><a href="/y">{}</a></li><li><a href="/z">{}</a></li></ul></div>',
    '<header><p>{}</p></header>',
    '<header><h1>{}</h1><p>{}</p></header>',
    '<footer><p>{}</p></footer>',
    '<div class="footer">{}</div>',
    '<div class="share-bar"><a href="/t">{}</a> <a href="/f">{}</a></div>',
    '<nav class="breadcrumb"><a href="/">{}</a></nav>',
    '<nav>{}</nav>',
)
_OPEN, _SHUT = re.compile(r"<(article|main)\b[^>]*>", re.I), re.compile(r"</(article|main)\s*>", re.I)


def _varied(page: str, texts: list[str], rng: random.Random) -> str | None:
    """A labelled variation: data-truth on the article (1) and on added blocks (0)."""
    a, z = _OPEN.search(page), None
    if a:
        z = next(iter(reversed(list(_SHUT.finditer(page)))), None)
    if not a or not z or z.start() < a.end():
        return None
    wrap = rng.choice(_WRAPS) if rng.random() < 0.6 else a[0]
    name = re.match(r"<(\w+)", wrap)[1]

    def block() -> str:
        b = rng.choice(_BLOCKS)
        b = re.sub(r"\{\}", lambda _: entities.escape(rng.choice(texts)), b)
        return re.sub(r"^<(\w+)", r'<\1 data-truth="0"', b)

    inner = page[a.end() : z.start()]
    cuts = [m.start() for m in re.finditer(r"<(?:p|h2|ul)\b", inner)][1:]
    for c in sorted(rng.sample(cuts, min(len(cuts), rng.randint(0, 2))), reverse=True):
        inner = inner[:c] + block() + inner[c:]
    if rng.random() < 0.4:
        inner += block()
    if rng.random() < 0.4:  # lists, tables and quotes belong to an article too
        inner += rng.choice(("<ul><li>{0}</li><li>{1}</li></ul>", "<blockquote><p>{0}</p></blockquote>", "<table><tr><td>{0}</td><td>{1}</td></tr></table>", "<h2>{0}</h2><p>{1}</p>", "<div><p>{0}</p></div>")).format(
            *[entities.escape(rng.choice(texts)) for _ in range(2)]
        )
    before, after = "".join(block() for _ in range(rng.randint(0, 2))), "".join(block() for _ in range(rng.randint(0, 3)))
    return page[: a.start()] + before + re.sub(r"^<(\w+)", r'<\1 data-truth="1"', wrap) + inner + f"</{name}>" + after + page[z.end() :]


def _labels(nodes: list[Node]) -> np.ndarray:
    """1 where the subtree holds text of the article; added blocks and all they hold are 0."""
    inside: dict[int, bool] = {}
    holds: dict[int, bool] = {}
    for n in nodes:
        up = inside[id(n.parent)] if n.parent else False
        inside[id(n)] = up if n.truth is None else n.truth
    for n in reversed(nodes):
        holds[id(n)] = inside[id(n)] if n.tag == "#text" else any(holds[id(c)] for c in n.kids)
    return np.array([holds[id(n)] for n in nodes], float)


def train(pages: list[str], seed: int = 3):
    """The boosted model from pages and their labelled variations."""
    rng = random.Random(seed)
    pages = [p for p in pages if p] + [SEED_PAGE] * 3
    texts = [t[:400] for p in pages for t in (n.text for n in preorder(parse(p)) if n.tag == "#text") if t][: 50 * len(pages)]
    texts += [" ".join(t.split()[: rng.randint(1, 8)]) for t in texts]
    xs, ys, ws = [], [], []
    for p in pages:
        for _ in range(VARIANTS):
            v = _varied(p, texts, rng)
            if v is not None:
                nodes = preorder(parse(v))
                y = _labels(nodes)
                xs.append(features(nodes))
                ys.append(y)
                ws.append(np.full(len(y), 1.0))
    return boosting.fit(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


def extract(page: str | None, model) -> str:
    """Main text of one page."""
    if not page:
        return ""
    nodes = preorder(parse(page))
    return "\n".join(n.text for n in decode(nodes, boosting.margin(model, features(nodes))))


def extract_pages(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    bounded_batches(pages.sparkSession)
    sample = bounded_sample(pages.where("html IS NOT NULL").select("page_id", "html"), "page_id", train_pages)
    model = train([r["html"] for r in sample.collect()])  # bounded by train_pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            trees = [preorder(parse(p)) if p else [] for p in b["html"].to_pylist()]
            full = [t for t in trees if t]
            odds = boosting.margin(model, np.concatenate([features(t) for t in full])) if full else np.empty(0)
            texts, at = [], 0
            for t in trees:
                texts.append("\n".join(n.text for n in decode(t, odds[at : at + len(t)])) if t else "")
                at += len(t)
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    kinds = pages.select("page_id", "url").schema.simpleString()[7:-1]
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kinds}, text string, n_chars bigint")
