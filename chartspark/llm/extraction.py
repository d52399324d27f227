"""Main text of web pages by composite text density."""

import bisect
import heapq
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chartspark.llm.common import in_arrow, whole

# Element names of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe", "noscript", "template"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var",
}
#: Elements that never hold main text.
DROPPED = {
    "head", "script", "style", "title", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio",
    "video", "map", "nav", "aside", "footer", "form", "button", "select", "option", "textarea", "input", "fieldset",
    "dialog", "menu", "xmp", "noembed", "noframes",
}
#: Words in class, id or role that mark what is not main text.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo",
    "promotion", "nav", "navbar", "navigation", "menu", "toc", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer",
    "foot", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "notice", "notices",
    "notification", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "widget",
    "toolbar", "pagination", "pager", "copyright", "disclaimer", "search", "complementary", "contentinfo", "alert",
    "dialog", "paywall",
}
#: Words that mark an article as another one than the page's.
OTHER_ARTICLES = {
    "ad", "advert", "sponsored", "promo", "comment", "comments", "reply", "related", "recommended", "teaser", "card",
}
#: How an element is marked: for good, by a part of a name that a wrapper of the main text may bear too, by a whole
#: name or one of another article.
FOR_GOOD, BY_WORD, BY_OTHER = 1, 2, 3
FAR_MORE = 4
#: Words and an element that mark the head of a page, but may stand in an article around its title.
HEADS = {"header", "masthead", "banner", "topbar"}
ARTICLES = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An opening tag that ends an open element, up to the given limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that end an open paragraph.
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figure",
    "figcaption", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
    "pre", "section", "table", "ul",
}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: The rest of a tag. Nothing of it is tried twice: a quote without an end is a character like others.
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+""")
_ATTRIBUTES = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMING = {"class", "id", "role"}
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
_SPACES = re.compile(r"\s+")


class Node:
    """An element; its children are nodes and texts in page order."""

    __slots__ = ("name", "parent", "children", "marked", "depth", "block", "article", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: "Node | None", marked: int = 0):
        self.name, self.parent, self.children, self.marked = name, parent, [], marked
        self.depth = parent.depth + 1 if parent else 0
        # the innermost block and article around the node, or the node itself
        self.block = parent.block if parent and name in INLINE else self
        self.article = self if name in ARTICLES else parent.article if parent else None
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _marked(name: str, attributes: str, parent: Node) -> int:
    if name == "form":
        return FOR_GOOD if attributes and _HIDDEN.search(attributes) else BY_WORD
    if name in DROPPED or (name == "header" and parent.article is None):
        return FOR_GOOD
    if not attributes:
        return 0
    if _HIDDEN.search(attributes):
        return FOR_GOOD
    if name in ("html", "body", "main"):
        return 0
    marks, heads = (OTHER_ARTICLES, set()) if name == "article" else (MARKS, HEADS)
    marked = 0
    for attribute, *value in _ATTRIBUTES.findall(attributes):
        if attribute.lower() not in _NAMING:
            continue
        for token in "".join(value).split():
            parts = [p.lower() for p in _PARTS.findall(token)]
            found = {*parts, *map("".join, zip(parts, parts[1:]))}
            if not OTHER_ARTICLES.isdisjoint(found) or token.lower() in marks:
                return BY_OTHER
            if not marks.isdisjoint(found) or not (heads.isdisjoint(found) or parent.article is not None):
                marked = BY_WORD
    return marked


def _restore(root: Node) -> None:
    """Take the marks from elements that hold the main text after all, the largest first, and look into them again.

    Those are elements with a main element, with more text outside links than all that is not marked, or with an article
    where there is none that is not marked. A mark that is a whole name, or a word of another article as of comments, stays
    unless no article is without marks and the element has a main element or ``FAR_MORE`` times the text. What the density makes of the elements is left to it.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node) and c.marked != FOR_GOOD)
    facts: dict[int, tuple] = {}  # text, text and articles without marks, holds an article, holds a main element
    for node in reversed(order):
        text = open_text = articles = 0
        article, main = node.name == "article" and not node.marked, node.name == "main"
        for child in node.children:
            if isinstance(child, str):
                size = len(_SPACES.sub(" ", child).strip())
                text, open_text = text + size, open_text + size
            elif child.marked != FOR_GOOD:
                inner = facts[id(child)]
                text, article, main = text + inner[0], article or inner[3], main or inner[4]
                if not child.marked:
                    open_text, articles = open_text + inner[1], articles + inner[2]
        if node.name == "a":
            text = open_text = 0
        articles += node.name in ARTICLES and open_text > 0
        facts[id(node)] = text, open_text, articles, article and text > 0, main and text > 0
    _, seen, articles, _, _ = facts[id(root)]
    heap, opened, n = [], [root], 0
    while True:
        while opened:
            for child in opened.pop().children:
                if isinstance(child, Node) and child.marked not in (0, FOR_GOOD):
                    n += 1
                    heapq.heappush(heap, (-facts[id(child)][0], n, child))
                elif isinstance(child, Node) and not child.marked:
                    opened.append(child)
        if not heap:
            return
        _, _, node = heapq.heappop(heap)
        text, open_text, inner, article, main = facts[id(node)]
        if node.marked == BY_WORD:
            held = main or text > seen or (article and not articles)
        else:
            held = not articles and (main or text > FAR_MORE * seen)
        if held:
            node.marked = 0
            seen, articles = seen + open_text, articles + inner
            opened.append(node)


def _whole_article(node: Node) -> Node | None:
    """The innermost article around a node; the main element around that if it holds no other article."""
    article = node.article
    main = article
    while main is not None and main.name != "main":
        main = main.parent
    if main is None or main is article:
        return article
    articles = [n for n in _nodes(main) if n.name == "article" and not n.marked]
    return main if articles == [article] else article


class _Open:
    """The open elements of a page, from the root to ``node``, and those of each name."""

    def __init__(self, root: Node):
        self.node, self.named = root, {}

    def open(self, child: Node) -> None:
        self.named.setdefault(child.name, []).append(child)
        self.node = child

    def close_to(self, node: Node) -> None:
        """Close all elements inside ``node``."""
        while self.node is not node:
            self.named[self.node.name].pop()
            self.node = self.node.parent

    def end(self, name: str) -> None:
        """An end tag. One without a beginning is ignored; inside a block it does not reach beyond it for inline elements
        and paragraphs."""
        found = self.named.get(name)
        if not found:
            return
        block = self.node.block
        if found[-1].depth < block.depth and (name in INLINE or name == "p"):
            return
        self.close_to(found[-1].parent)

    def before(self, name: str) -> None:
        """Close what an opening tag ends."""
        if name in ENDS_P:
            block = self.node.block
            if block.name == "p":
                self.close_to(block.parent)
            elif block is not self.node:
                self.close_to(block)  # a block does not stand in inline elements left open in an earlier block
        if name in ENDS:
            names, limits = ENDS[name]
            limit = max((self.named[n][-1].depth for n in limits if self.named.get(n)), default=0)
            ended = [found[i] for n in names if (found := self.named.get(n)) and (i := _beyond(found, limit)) < len(found)]
            if ended:
                self.close_to(min(ended, key=lambda n: n.depth).parent)


def _beyond(nodes: list[Node], depth: int) -> int:
    """The place of the first of the nodes, one inside another, that is deeper than ``depth``."""
    return bisect.bisect_right(nodes, depth, key=lambda n: n.depth)


def parse(page: str) -> Node:
    """The page's tree, in one pass. Missing ends are supplied, ends without a beginning ignored, raw elements kept as one
    text, and a tag that the page ends in is left out."""
    root = Node("#page", None)
    at, lowered, state = 0, None, _Open(root)
    last = page.rfind(">")
    while True:
        match = _MARKUP.search(page, at)
        text = page[at : match.start()] if match else page[at:]
        if text:
            state.node.children.append(text)
        if not match:
            return root
        at = match.end()
        name = match[2]
        if name is None:
            if match[0].startswith("<![CDATA["):
                state.node.children.append(html.escape(match[0][9:].removesuffix("]]>"), quote=False))
            continue
        rest = _REST.match(page, at)
        if rest.end() == len(page):  # the page ends in the tag, unless a quote without an end has taken it so far
            if at > last:
                return root
            end = page.find(">", at)
        else:
            end = rest.end()
        attributes, at, name = page[at:end], end + 1, name.lower()
        if match[1]:
            state.end(name)
            continue
        state.before(name)
        child = Node(name, state.node, _marked(name, attributes, state.node))
        state.node.children.append(child)
        if name in VOID or (attributes.endswith("/") and name not in INLINE and name not in ENDS_P and name not in RAW):
            continue
        if name in RAW:
            lowered = lowered if lowered is not None else page.lower()
            end = lowered.find(f"</{name}", at) if len(lowered) == len(page) else _find_end(page, name, at)
            at = len(page) if end < 0 else end
            close = page.find(">", at)
            at = len(page) if close < 0 else close + 1
            continue
        state.open(child)


def _find_end(page: str, name: str, at: int) -> int:
    match = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
    return match.start() if match else -1


def _measured(root: Node) -> list[Node]:
    """All nodes that count, parents first, with characters, tags and those of links. Marked ones are left out."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node) and not c.marked)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(_SPACES.sub(" ", child).strip())
            elif not child.marked:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    return order


def _density(node: Node, ratio: float) -> float:
    """Characters per tag, lowered by the share of links: the logarithm's base grows with it and with that of the page."""
    chars, tags = node.chars, max(1, node.tags)
    if not chars:
        return 0.0
    link, link_tags = max(1, node.link_chars), max(1, node.link_tags)
    text = max(1, chars - node.link_chars)
    base = math.log(chars / text * node.link_chars + ratio * chars + math.e)
    inside = chars / link * tags / link_tags
    return chars / tags * max(0.0, math.log(inside) / math.log(base) if base > 1 else math.log(inside))


def _menu(node: Node) -> bool:
    """A block of several links and little else."""
    return node.link_tags >= 3 and node.link_chars > 0.8 * node.chars and node.name not in INLINE


def main_text(page: str) -> str:
    """The page's main text.

    Every element's characters per tag are lowered by the links in it; the sum over an element's children says how much
    dense text stands together there, and the element with the largest sum is the main one. The smallest density on the
    path from it to the body is the threshold: other blocks next to that path which reach it, and headings before the main
    element, belong to the main text too. If the main element is part of an article element, that is the main text.
    Elements that are marked as something else, by name or class, are left out throughout, and blocks of links outside an
    article; a wrapper of the main text that bears such a class is not (see :func:`_restore`).
    """
    root = parse(page)
    _restore(root)
    body = next((n for n in _nodes(root) if n.name == "body"), root)
    order = _measured(body)
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        node.density = _density(node, ratio)
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node) and not c.marked and c.name not in INLINE and c.name not in VOID]
        node.total = sum(c.density for c in inner) if inner else node.density
    blocks = [n for n in order if n.name not in INLINE]
    best = max(blocks, key=lambda n: n.total)
    if not best.chars:
        return ""
    article = _whole_article(best)
    if article is not None:
        chosen = {id(article)}
    else:
        threshold, at = best.density, best
        while at is not body:
            at = at.parent
            if at is not body:
                threshold = min(threshold, at.density)
        chosen = {id(best)}
        _choose(body, threshold, best, chosen)
    out: list[str] = []
    _write(body, False, chosen, article, out)
    joined = (_SPACES.sub(" ", part).strip() for part in "".join(out).split("\0"))
    return " ".join(part for part in joined if part)


def _nodes(root: Node):
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.marked)


def _choose(body: Node, threshold: float, best: Node, chosen: set[int]) -> None:
    """Mark, next to the path to the main element, the blocks that are as dense as its least dense part."""
    path, at = {id(best)}, best
    while at is not body:
        at = at.parent
        path.add(id(at))
    stack = [body]
    while stack:
        node = stack.pop()
        before = True
        for child in node.children:
            if isinstance(child, str) or child.marked:
                continue
            if id(child) in path:
                before = False
                if child is not best:
                    stack.append(child)
            elif child.name in HEADINGS and before and not child.link_chars:
                chosen.add(id(child))
            elif child.name not in INLINE and child.density >= threshold > 0 and not _menu(child):
                chosen.add(id(child))


def _write(root: Node, inside: bool, chosen: set[int], article: Node | None, out: list[str]) -> None:
    """The texts of the chosen elements in page order; blocks are set apart by a NUL, which no page text has. Blocks of
    links are left out but in an article, where lists of links are part of the text."""
    stack: list = [(root, inside, False)]
    while stack:
        item, inside, ended = stack.pop()
        if isinstance(item, str):
            if inside:
                out.append(html.unescape(item).replace("\0", " "))
            continue
        block = item.name not in INLINE
        if ended:
            out.append("\0")
            continue
        if item.marked or (item.name != "body" and block and not (inside and article is not None) and _menu(item)):
            if block:
                out.append("\0")
            continue
        if item.name == "br":
            out.append(" ")
            continue
        inside = inside or id(item) in chosen
        if block:
            out.append("\0")
            stack.append((item, inside, True))
        stack.extend((c, inside, False) for c in reversed(item.children))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text, n_chars for every row of ``pages``, by :func:`main_text` of the whole page.

    NULL counts as an empty page. A page without main text gives an empty text and 0 characters. Broken markup gives
    what can be read of it. Equal pages give equal texts. An empty table gives an empty result.
    """

    def read(batches):
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column("page")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["key", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), whole(F.col(page)).alias("page"))
    schema = rows.drop("page").schema.add("text", "string").add("n_chars", "long")
    return in_arrow(rows, read, schema)
