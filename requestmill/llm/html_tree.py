"""Main text of web pages by tree scoring.

Each paragraph-like block passes points for its length and its commas to its ancestors, less with
each level; a container's points are discounted by the share of its text that lies in links and by
names of menus, adverts and the like. The best container is kept, with those siblings that look like
text as well.

Menus, footers and other elements with a meaning of their own are left out. An element that only
has such a name is left out if the article is elsewhere: see ``_cut_by_name``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import sliced

# Fixed values of HTML: elements without an end tag, elements that break a line of text,
# elements that a new paragraph-like one closes.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
CLOSED_BY_SAME = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
    "option": ("select", "datalist"),
}
HIDDEN = frozenset(
    "script style noscript template head title iframe object svg math canvas select textarea "
    "audio video datalist".split()
)
IN_HEAD = frozenset("base link meta noscript script style template title".split())
FURNITURE = frozenset("nav footer aside button dialog menu".split())
IN_FORMS = frozenset("label legend".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu "
    "menubar".split()
)
COMMENT_WORDS = frozenset("comment comments disqus replies reply responses".split())
OWN_HEADER_WORDS = frozenset("header masthead".split())  # an article may have a header of its own
FURNITURE_WORDS = (
    COMMENT_WORDS
    | OWN_HEADER_WORDS
    | frozenset(
        "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie "
        "cookies footer menu modal nav navbar navigation newsletter notice notices pager pagination "
        "popup promo promotion related recommended share sharing sidebar signup social sponsor "
        "sponsored subscribe toolbar widget".split()
    )
)
NAMED = 0.3  # what a name leaves of a container's score
# Shares of a page's points with which a named element stays: with a part of a name beside an article or a
# title, with one where the page has neither, and with a whole name or comments there.
MOST_BESIDE, MOST, NEARLY_ALL = 0.75, 0.5, 0.9
TEXT_BLOCKS = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption".split())
SPACE = re.compile(r"\s+")
NAME_PART, CAMEL = re.compile(r"[a-z]+"), re.compile(r"([a-z])([A-Z])")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = (
        "tag", "parent", "children", "names", "inside", "points", "worth", "chars", "link_chars",
        "total", "articles", "titles", "cut",
    )

    def __init__(self, tag: str, parent: Node | None, names: tuple[str, ...] = (), inside: bool = False):
        self.tag, self.parent, self.names, self.inside = tag, parent, names, inside
        self.children: list[Node | str] = []
        self.points, self.worth, self.chars, self.link_chars = 0.0, 0.0, 0, 0
        self.total, self.articles, self.titles, self.cut = 0.0, 0, 0, False

    def ends_in(self, words: frozenset[str]) -> bool:
        """Whether a class or the id is one of the words or has one as its last part."""
        return any(n.rpartition("-")[2] in words for n in self.names)

    def named(self, words: frozenset[str]) -> bool:
        return not words.isdisjoint(self.names)

    def mentions(self, words: frozenset[str]) -> bool:
        return any(not words.isdisjoint(n.split("-")) for n in self.names)


def _names(attrs: list) -> tuple[str, ...]:
    """Classes and id in lower case, their parts joined by hyphens: ``sideBar_left`` is side-bar-left."""
    said = [w for name, value in attrs if name in ("class", "id") and value for w in value.split()]
    return tuple("-".join(NAME_PART.findall(CAMEL.sub(r"\1-\2", w).lower())) for w in said)


def _hidden(tag: str, attrs: list) -> bool:
    if tag in HIDDEN:
        return True
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and HIDING.search(value.lower()):
            return True
    return False


class Builder(HTMLParser):
    """Forgiving tree of elements without hidden ones.

    Open elements are a stack, with the depths of each tag's beside it, so what is open is looked up,
    not searched. Inside a hidden element nothing closes what was open before it but an end tag.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", None)
        self.stack = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.hidden = 0  # depth of the outermost hidden element

    def _deepest(self, tags: tuple[str, ...]) -> int:
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def _close(self, depth: int) -> None:
        """Close the element at this depth and all in it."""
        while len(self.stack) > depth:
            self.depths[self.stack.pop().tag].pop()
        if self.hidden >= depth:
            self.hidden = 0

    def _close_open(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        depth = self._deepest(tags)
        if depth > max(self._deepest(stop), self.hidden - 1):
            self._close(depth)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.stack[-1].tag == "head" and tag not in IN_HEAD:
            self._close(len(self.stack) - 1)  # the end tag of a head may be missing
        at = self.stack[-1]
        if tag in VOID:
            if not self.hidden:
                at.children.append(Node(tag, at) if tag in BLOCKS else " ")
            return
        if tag in BLOCKS:
            self._close_open(("p",), ("table", "button"))
        if tag in CLOSED_BY_SAME:
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            self._close_open(same, CLOSED_BY_SAME[tag])
        at = self.stack[-1]
        inside = bool(self.depths.get("article") or self.depths.get("main"))
        node = Node(tag, at, _names(attrs) if attrs else (), inside)
        node.cut = (
            tag in FURNITURE
            or (tag == "header" and not inside)
            or any(k == "role" and (v or "").lower() in FURNITURE_ROLES for k, v in attrs)
        )
        if not self.hidden:
            if _hidden(tag, attrs):
                self.hidden = len(self.stack)
            else:
                at.children.append(node)
        self.depths.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in ("svg", "math"):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        depth = self._deepest((tag,))
        if depth and (depth >= self.hidden or tag in BLOCKS - {"p", "li", "option"}):
            self._close(depth)
        elif tag in ("p", "br") and not self.hidden:
            self.stack[-1].children.append(" ")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.stack[-1].children.append(data)


def _walk(root: Node) -> list[Node]:
    """Parents before children; what is cut is left out."""
    found = [root]
    for node in found:
        found.extend(c for c in node.children if isinstance(c, Node) and not c.cut)
    return found


def _measure(nodes: list[Node]) -> None:
    """Lengths of text and of link text, what each paragraph is worth, and what lies below each node."""
    for node in nodes:
        node.points = node.worth = node.total = 0.0
        node.chars = node.link_chars = node.titles = node.articles = 0
    for node in reversed(nodes):
        text = "".join(c for c in node.children if isinstance(c, str))
        own = text.strip()
        node.chars += len(SPACE.sub(" ", own))
        if node.tag == "a":
            node.link_chars = node.chars
        above = node.parent
        if above is not None:
            above.chars += node.chars
            above.link_chars += node.link_chars
        commas = text.count(",") + text.count("،") + text.count("、")
        for c in node.children:
            if isinstance(c, Node) and c.tag not in BLOCKS and not c.cut:
                commas += int(c.points)  # commas of inline children wait there
        if node.tag not in BLOCKS:
            node.points = commas
        elif (node.tag in TEXT_BLOCKS or own) and node.chars and above is not None:
            worth = (node.chars >= 25) + commas + min(node.chars / 100, 3)
            node.worth = worth * (1 - node.link_chars / node.chars)
        node.total += node.worth
        node.titles += node.tag == "h1"
        node.articles += node.tag in ("article", "main")
        if above is not None:
            above.total += node.total
            above.titles += node.titles
            above.articles += node.articles


def _pass_points(nodes: list[Node]) -> None:
    """Paragraphs' points to four containers above them, less with each level."""
    for node in nodes:
        if node.tag in BLOCKS:
            node.points = 0.0
    for node in nodes:
        if not node.worth:
            continue
        # text straight in a container counts for it
        above, share = (node.parent if node.tag in TEXT_BLOCKS else node), 1.0
        for level in range(4):
            if above is None:
                break
            if above.tag in BLOCKS or above.parent is None:
                above.points += node.worth * share
                share = 0.5 if level == 0 else share / 1.5
            above = above.parent


def _cut_by_name(node: Node, page: Node) -> bool:
    """Whether an element is left out for a class or id that is, or ends in, a word of the list.

    It stays if it holds an article or main part, or all titles of a page without those, or is a
    header inside an article. Else its share of the page's points decides, and one whose whole name is
    on the list never stays beside an article or a title. A form is treated like a part of a name.
    """
    if node.tag in ("body", "html", "main", "#root"):
        return False
    comments = node.ends_in(COMMENT_WORDS)
    if node.tag == "article":
        return comments
    if node.inside and node.ends_in(OWN_HEADER_WORDS) and not comments:
        return False
    if not (node.tag == "form" or node.ends_in(FURNITURE_WORDS)):
        return False
    own, all_marks = node.articles + node.titles, page.articles + page.titles
    if node.articles or (own and own == all_marks):
        return False
    clear = comments or node.named(FURNITURE_WORDS)
    if all_marks > own:
        return clear or node.total <= MOST_BESIDE * page.total
    return node.total <= (NEARLY_ALL if clear else MOST) * page.total


def _cut(root: Node) -> None:
    nodes = _walk(root)
    for node in nodes:  # replies are articles by tag alone
        node.cut = node.tag == "article" and node.ends_in(COMMENT_WORDS)
    nodes = _walk(root)
    _measure(nodes)
    forms = {id(n) for n in nodes if n.tag == "form"}
    for node in nodes:
        above = node.parent
        if above is not None and id(above) in forms and node.tag != "form":
            forms.add(id(node))
        node.cut = (
            (above is not None and above.cut)
            or _cut_by_name(node, root)
            or (node.tag in IN_FORMS and id(node) in forms)
        )


def _score(node: Node) -> float:
    named = node.tag not in ("body", "html", "article", "main") and node.mentions(FURNITURE_WORDS)
    return node.points * (1 - node.link_chars / max(1, node.chars)) * (NAMED if named else 1.0)


def _fits(other: Node, best: Node, least: float) -> bool:
    """Whether a sibling of the best container belongs to the text."""
    if not other.chars:
        return False
    links = other.link_chars / other.chars
    if best.tag in ("article", "main"):
        return other.tag in ("article", "main") and _score(other) >= least
    if other.tag in TEXT_BLOCKS:
        return links < 0.25
    return _score(other) >= least and links < 0.5


def _title(nodes: list[Node], best: Node) -> Node | None:
    """The page's only title where it stands before the text, in a container without links."""
    found = [n for n in nodes if n.tag == "h1" and n.chars]
    if len(found) != 1 or best.titles:
        return None
    title, above = found[0], found[0]
    while above is not None and above is not best:
        if above.parent is not None and above.chars > 4 * title.chars + 200:
            break  # a container with much else beside the title
        if above.link_chars > 0.25 * above.chars or above.mentions(FURNITURE_WORDS):
            return None
        above = above.parent
    return title


def _kept(nodes: list[Node]) -> list[Node]:
    """The best container and its siblings, in page order, and the title before them."""
    holders = [n for n in nodes if n.tag in BLOCKS and n.tag not in TEXT_BLOCKS or n.parent is None]
    best = max(holders, key=_score, default=None)
    if best is None or best.chars == 0:
        return []
    above, article = best, None
    while above is not None:  # sections of one article belong together
        if above.tag == "article" or (above.tag == "main" and article is None):
            article = above
        above = above.parent
    best = article or best
    if best.parent is None:
        return [best]
    least = max(1.0, 0.2 * _score(best))
    siblings = [c for c in best.parent.children if isinstance(c, Node) and not c.cut]
    kept = [c for c in siblings if c is best or _fits(c, best, least)]
    title = _title(nodes, best)
    if title is not None and not any(k.titles for k in kept):
        order = {id(n): k for k, n in enumerate(_in_order(nodes[0]))}
        if order[id(title)] < order[id(kept[0])]:
            kept.insert(0, title)
    return kept


def _in_order(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.cut)


def _blocks(nodes: list[Node]) -> list[str]:
    lines: list[str] = []
    open_line: list[str] = []

    def flush() -> None:
        line = SPACE.sub(" ", "".join(open_line)).strip()
        open_line.clear()
        if line:
            lines.append(line)

    stack: list = [x for n in reversed(nodes) for x in (None, n, None)]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            open_line.append(item)
        elif item.cut:
            continue
        elif item.tag in BLOCKS:
            stack.append(None)
            stack.extend(reversed(item.children))
            flush()
        else:
            stack.extend(reversed(item.children))
    flush()
    return lines


def main_text(html: str | None) -> str:
    """Blocks of the main text joined by line feeds; empty if there are none."""
    if not html:
        return ""
    builder = Builder()
    builder.feed(html)
    builder.close()
    _cut(builder.root)
    nodes = _walk(builder.root)
    _measure(nodes)
    _pass_points(nodes)
    return "\n".join(_blocks(_kept(nodes)))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``.

    Null, empty and textless pages give an empty text. Equal pages give equal rows, cut-off
    pages what they have, an empty table no rows. Other columns are not read.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    found = rows.mapInArrow(_batches, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
