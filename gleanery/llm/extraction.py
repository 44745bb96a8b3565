"""Main text of HTML pages by tree scoring.

A page is read into a tree of its block elements; runs of inline text are its blocks of text. Each block passes points for its
length and its commas to the elements above it, the nearest most, less what is link text. If the best container lies in an article
or main element, that element is kept whole; else the container grows to its parent as long as all that stands beside it is text,
and is kept with those of its siblings that are text.

Elements that can't be the article (menus, footers, scripts, hidden parts, ...) are left out. What a class or id says is a hint.
Names of adverts, comments, menus and the like leave an element out, unless the article is inside it. Names that articles have
as well (legal, search, responses, ...) only lower its points, and leave it out only if it is short or little but links. If nothing
is left, names don't count.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by what they mean here, words of class and id names, and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
LEFT_OUT = frozenset("nav footer aside menu dialog button select option optgroup head datalist output progress meter applet map".split())
FORMS = frozenset(("form", "fieldset"))
LEAVES = frozenset("p pre li td th dd dt blockquote h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLES = frozenset(("article", "main"))
CLOSED_BY = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th"))}
BOUNDS = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("tr", "table")), "th": frozenset(("tr", "table"))}
_NAME = r"(?:^|[\s_-])(?:%s)(?=$|[\s_-])"
# Of these an element has nothing of the article, however long.
NEVER_NAMES = re.compile(_NAME % (
    r"ads?|advert\w*|adbox|adslot|sponsor\w*|promo\w*|comments?|comment-?list|commentlist|disqus\w*|share|sharing|social\w*|newsletter|subscribe|subscription|"
    r"signup|sign-up|login|cookies?|consent|gdpr|popup|pagination|pager|breadcrumbs?|skip-?link|print-?only|more-?stories|"
    r"related(?:[_-](?:posts?|articles?|stories|links?|content|topics?|items?|pages?|reading|news))?$|related[_-](?:posts?|articles?|stories|links?|content|topics?|items?|pages?|reading|news)"
), re.I)
# These name parts of the layout; what has the article inside it isn't one.
LAYOUT_NAMES = re.compile(_NAME % (
    r"banners?|nav\w*|menus?|side-?bar\w*|aside|foot(?:er)?|footnav|masthead|(?:site|page|top|global)-?header|header|topbar|toolbar|modal|overlay|widgets?|hidden"
), re.I)
# Articles have these names as well.
WEAK_NAMES = re.compile(_NAME % (
    r"replies|respond|responses|discussion|related|recommend\w*|search\w*|notices?|alerts?|tags?|tag-?list|taglist|copyright|legal|disclaimer"
), re.I)
LAYOUT = re.compile(r"(?<![\w-])(?:has|with|without|no)-[\w-]+", re.I)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|content|main\w*|post|entry|story|text|body|page-?content)(?=$|[\s_-])", re.I)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*)))?(?=[\s/]|$|[\"'])", re.I | re.S)
UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

ARTICLE_POINTS = 25.0
NAME_POINTS = 10.0
LINKED = 0.6
#: Part of its text from which a block is link text; characters of a block that is short, of a line that is no byline, and the
#: part of a page's text that a layout element holds only if the article is in it.
LINK_DENSE = 0.25
SHORT = 200
LINE = 80
MOST = 0.6
NAMED_SHARE = 0.3
OUT, NEVER, LAYOUT_PART, WEAK = 1, 2, 3, 4


class Node:
    """A block element: its children are nodes and blocks of text ``[text, characters in links]``."""

    __slots__ = ("tag", "up", "kind", "out", "items", "points", "anchors", "links", "size", "linked", "holds")

    def __init__(self, tag: str, up: Node | None, kind: int):
        self.tag, self.up, self.kind = tag, up, kind
        self.out, self.holds = kind == OUT or up is not None and up.out, False
        self.items: list = []
        self.points, self.anchors, self.links, self.size, self.linked = 0.0, 0, 0, 0, 0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _kind(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """What an element's tag and attributes say of it; 0 for nothing."""
    if tag in LEFT_OUT or tag == "header" and not in_article:
        return OUT
    found = LAYOUT_PART if tag in FORMS else 0
    if not attributes or tag in ("html", "body"):
        return found
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or UNSHOWN.search(attributes.get("style", "")):
        return OUT
    if attributes.get("role", "").lower() in OTHER_ROLES:
        return OUT
    names = LAYOUT.sub("", f"{attributes.get('class', '')} {attributes.get('id', '')}")
    if NEVER_NAMES.search(names):
        return 0 if tag in ARTICLES and GOOD_NAMES.search(names) else NEVER
    if tag in ARTICLES:
        return found
    if any(m[0].strip(" _-").lower() != "header" or not in_article for m in LAYOUT_NAMES.finditer(names)):
        return LAYOUT_PART
    return WEAK if WEAK_NAMES.search(names) else found


def parse(page: str) -> Node:
    """The tree of a page. Unclosed elements end with the block around them; a text ends at any block element."""
    root = node = Node("body", None, 0)
    inline: list[tuple[str, bool]] = []  # open inline elements of the block, and whether they are left out
    run: list[str] = []
    linked = at = depth_a = unshown = 0

    def close_run() -> None:
        nonlocal linked
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                node.items.append([text, min(linked, len(text))])
            run.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not unshown and not node.out:
            run.append(text)
            if depth_a:
                linked += len(text)

    def end_inline() -> None:
        nonlocal depth_a, unshown
        inline.clear()
        depth_a = unshown = 0

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if tag == "br":
            add(" ")
        elif tag in RAW:
            if not closing and not rest.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = stop.end() if stop else end
        elif tag in VOID:
            if tag == "hr":
                close_run()
                end_inline()
        elif tag in INLINE:
            if closing:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        was = inline.pop(k)
                        depth_a -= tag == "a"
                        unshown -= was[1]
                        break
            else:
                gone = _kind(tag, _attributes(rest), True) in (OUT, NEVER)
                inline.append((tag, gone))
                depth_a += tag == "a"
                unshown += gone
                if tag == "a":
                    node.anchors += 1
        elif closing:
            here = node
            while here is not None and here.tag != tag:
                here = here.up
            if here is not None and here is not root:
                close_run()
                end_inline()
                node = here.up
        else:
            close_run()
            end_inline()
            if node.tag == "p" or node.tag in HEADINGS and tag in HEADINGS:
                node = node.up or node
            closers = CLOSED_BY.get(tag)
            if closers:
                here, bounds = node, BOUNDS[tag]
                while here is not None and here.tag not in bounds:
                    if here.tag in closers and here is not root:
                        node = here.up
                        break
                    here = here.up
            if tag in ("html", "body"):
                continue
            inside = node
            while inside is not None and inside.tag not in ARTICLES:
                inside = inside.up
            child = Node(tag, node, _kind(tag, _attributes(rest), inside is not None))
            node.items.append(child)
            node = child
    close_run()
    return root


def _nodes(root: Node) -> list[Node]:
    """All nodes that aren't left out, each after its parent."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.out:
            found.append(node)
            todo += [x for x in node.items if isinstance(x, Node)]
    return found


def _measure(found: list[Node]) -> None:
    """Sizes and links of nodes with all below them, and whether an article is in them."""
    for node in found:
        texts = [x for x in node.items if not isinstance(x, Node)]
        node.size, node.linked = sum(len(x[0]) for x in texts), sum(x[1] for x in texts)
        node.links, node.holds = node.anchors, False
    for node in reversed(found):
        up = node.up
        if up is not None:
            up.size += node.size
            up.linked += node.linked
            up.links += node.links
            up.holds = up.holds or node.holds or node.tag in ARTICLES and node.kind != NEVER and node.size > 0


def _leave_out(found: list[Node]) -> None:
    """Leave out what names say isn't the article, where nothing speaks against it."""
    whole = found[0].size
    for node in found:
        if node.up is not None and node.up.out:
            node.out = True
        elif node.kind == NEVER:
            node.out = not node.holds
        elif node.kind == LAYOUT_PART:
            node.out = not node.holds and node.size <= MOST * whole
        elif node.kind == WEAK:
            node.out = node.size < SHORT or node.linked > LINK_DENSE * node.size


def _score(found: list[Node]) -> None:
    """Points of nodes from the blocks of text below them."""
    for node in found:
        for item in node.items:
            if isinstance(item, Node):
                continue
            size = len(item[0])
            points = (1 + item[0].count(",") + size / 100) * (1 - item[1] / size)
            up, share = node.up if node.tag in LEAVES and node.up else node, 1.0
            while up is not None and share > 0.1:
                up.points += points * share
                up, share = up.up, share / 2


def _is_menu(node: Node) -> bool:
    """Lists and boxes that are little but links."""
    return node.links >= 3 and node.linked > LINKED * max(node.size, 1)


def _is_text(item: Node | list) -> bool:
    """Whether something beside the best container reads as text: not a menu, not named as something else, not mere links or notes."""
    if not isinstance(item, Node):
        return item[1] <= LINK_DENSE * len(item[0])
    if item.kind or _is_menu(item) or item.linked > LINK_DENSE * item.size:
        return False
    blocks, todo = [], [item]
    while todo:
        node = todo.pop()
        for x in node.items:
            if isinstance(x, Node):
                if not x.out:
                    todo.append(x)
            else:
                blocks.append((node.tag, x[0]))
    if all(len(t) < SHORT and (t.startswith("\u00a9") or "rights reserved" in t.lower()) for _, t in blocks):
        return False
    return item.size >= LINE or any(tag in HEADINGS or tag in ("p", "pre", "blockquote", "li", "td") for tag, _ in blocks)


def _chosen(found: list[Node]) -> tuple[Node, list]:
    """The container of the article, and what is kept: itself and what stands beside it and is text."""
    nodes = [n for n in found if n.size and n.tag not in LEAVES] or [found[0]]

    def value(node: Node) -> float:
        prior = ARTICLE_POINTS if node.tag in ARTICLES else 0.0
        named = NAMED_SHARE if node.kind == WEAK else 1.0
        return named * (node.points + prior) * (1 - node.linked / node.size) if node.size else 0.0

    best = max(nodes, key=value)  # of equals the first found
    here = around = best
    while here is not None:
        if here.tag in ARTICLES:
            around = here
            if here.tag == "article":
                break
        here = here.up
    best = around
    there = lambda x: not isinstance(x, Node) or not x.out and x.size
    if best.tag not in ARTICLES:
        while best.up is not None and all(_is_text(x) for x in best.up.items if x is not best and there(x)):
            best = best.up
    if best.up is None:
        return best, [best]
    alike = lambda x: isinstance(x, Node) and x.tag == best.tag and x.tag in ARTICLES and not x.kind
    if best.tag in ARTICLES:
        title = lambda x: isinstance(x, Node) and x.tag in ("p", *HEADINGS) and x.linked <= LINK_DENSE * x.size or not isinstance(x, Node) and _is_text(x)
        return best, [x for x in best.up.items if x is best or there(x) and (alike(x) or title(x))]
    return best, [x for x in best.up.items if x is best or there(x) and _is_text(x)]


def _blocks(best: Node, kept: list) -> list[str]:
    """Texts of what is kept, in page order. Lists of links are kept in an article, and where a heading or a paragraph is before them."""
    blocks: list[str] = []
    in_article = best.tag in ARTICLES
    todo = [(x, True) for x in kept[::-1]]
    while todo:
        item, led = todo.pop()
        if not isinstance(item, Node):
            blocks.append(item[0])
            continue
        if item.out or not in_article and not led and item is not best and _is_menu(item) and item.tag not in ("p", *HEADINGS):
            continue
        parts = item.items
        if item.tag == "header":
            parts = [x for x in parts if isinstance(x, Node) and (x.tag in HEADINGS or x.tag not in LEAVES or x.size >= LINE)]
        before = [None, *parts[:-1]]
        todo += [(x, not isinstance(b, Node) and b is not None or isinstance(b, Node) and not b.out and b.tag in ("p", *HEADINGS)) for b, x in zip(before, parts)][::-1]
    return blocks


def extract(page: str) -> str:
    """The blocks of the main text, in page order, joined by an empty line."""
    root = parse(page)
    found = _nodes(root)
    _measure(found)
    whole = root.size
    _leave_out(found)
    left = _nodes(root)
    _measure(left)
    if whole and not root.size:  # names have left nothing
        for node in found:
            node.out = False
        left = found
        _measure(left)
    _score(left)
    return "\n\n".join(_blocks(*_chosen(left)))


def main_text(html: str | Column) -> Column:
    """Main text of a column of pages; null and pages without text give the empty text."""

    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([extract(p) if p else "" for p in pages.to_pylist()], pa.string())

    return of(html)


def op10(pages: DataFrame) -> DataFrame:
    """Main text of every page; the row keeps its id and address, whatever they are."""
    return pages.select("page_id", "url", main_text("html").alias("text")).select("*", F.length("text").cast("long").alias("n_chars"))
