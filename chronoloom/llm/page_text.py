"""Main text of web pages by tree scoring.

A page is cut into tags and text in one pass of a regular expression; open
elements form a stack.  Paragraphs (runs of text between block tags) give points
for length and commas to their parent, half to the grandparent, less further up;
text inside links counts against.  The container with most points after the link
discount is the article; siblings that score well or read like paragraphs of it
are kept.  Menus, headers, footers, forms, adverts, comments and the like take no
part, unless they are wrapped around a main element or most of the paragraphs.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import slices

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>|<[!?][^>]*>|</[^>]*>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLANK = re.compile(r"\s+")
#: Names of HTML.
RAW = frozenset("script style textarea title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
NOT_TEXT = frozenset("script style textarea title xmp head noscript template iframe svg math object nav header footer aside form button select "
                     "menu dialog audio video canvas option datalist".split())
#: Of these, what may still be wrapped around an article.
WRAPS = frozenset("form header footer aside nav menu dialog".split())
#: Of these and of the roles, what is seldom wrapped around a whole page.
BESIDES = frozenset("footer aside nav menu dialog".split())
#: An open element of the set ends when the tag starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|respond|reply|replies|disqus|cookies?|consent|gdpr|notice|alert|disclaimer|"
    r"footer|header|masthead|menu|nav|navbar|navigation|newsletter|pager|pagination|popup|modal|promo\w*|related|recommended|share|sharing|"
    r"sidebar|side|skip|social|sponsor\w*|subscribe|signup|tags|toolbar|topbar|widget)(?:$|[\s_-])", re.I)
#: What a main element may be named that is not the article.
OTHERS = re.compile(r"(?:^|[\s_-])(?:ads?|comments?|reply|replies|related|recommended|promo\w*|sponsor\w*|teasers?)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
MAIN = frozenset(("article", "main"))


class Node:
    __slots__ = ("tag", "up", "aside", "doubt", "runs", "down", "points", "size", "linked", "link", "main", "paragraphs", "holds", "less")

    def __init__(self, tag: str, up: "Node | None", aside: bool, link: bool, main: bool, doubt: int = 0):
        self.tag, self.up, self.aside, self.link, self.main, self.doubt = tag, up, aside, link, main, doubt
        self.down: list[Node] = []
        self.points, self.size, self.linked = 0.0, 0, 0
        self.paragraphs, self.holds, self.less = 0, False, False


def _is_aside(tag: str, attributes: str) -> tuple[bool, int, bool]:
    """Whether the element is never text; whether its tag or name looks like page furniture (2: of the kind that is seldom
    wrapped around a page); whether it names itself as the main part."""
    if tag in NOT_TEXT and tag not in WRAPS:
        return True, 0, False
    furniture = 2 if tag in BESIDES else int(tag in WRAPS)
    if not attributes or attributes.isspace() or tag in ("html", "body"):
        return False, furniture, tag in MAIN
    own = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(attributes)}
    role = own.get("role", "").lower()
    hidden = ("hidden" in own or own.get("aria-hidden", "").lower() == "true"
              or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style", ""), re.I) is not None)
    main = tag in MAIN or role in ("main", "article") or own.get("itemprop", "").lower() == "articlebody"
    names = " ".join(own[k] for k in ("class", "id") if k in own)
    named = 2 if OTHERS.search(names) else int(not main and ASIDE.search(names) is not None)
    return hidden, max(furniture, named, (1 if role == "form" else 2) if role in ROLES else 0), main


def blocks_of(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree, and its text runs (element that holds the run, text) in page order."""
    root = Node("", None, False, False, False)
    node, runs, held, holder, links = root, [], [], root, []
    at = 0

    def end_run():
        nonlocal held
        if held:
            text = BLANK.sub(" ", "".join(held)).strip()
            if text:
                runs.append((holder, text))
            held = []

    def add(text: str):
        nonlocal holder
        if not text or node.aside:
            return
        if "&" in text:
            text = html.unescape(text)
        if not held:
            holder = node
            while holder.tag in INLINE and holder.up is not None:
                holder = holder.up
        held.append(text)
        if node.link:
            links.append((node, len(text.strip())))

    match = TAG.search(page)
    while match:
        add(page[at:match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            pass
        elif match[1]:
            if tag == "p" or tag not in INLINE:
                end_run()
            x = node
            while x is not None and x.tag != tag:
                x = None if tag in INLINE and x.tag not in INLINE else x.up
            if x is not None and x.up is not None:
                node = x.up
        elif tag in VOID:
            if tag not in INLINE:
                end_run()
        else:
            if tag not in INLINE:
                end_run()
                x = node
                while x.tag in INLINE and x.up is not None:  # formatting left open ends with its block
                    x = x.up
                if x.tag == "p":
                    node = x.up
                for name, stop in ((ENDS.get(tag), KEEPS.get(tag)),) if tag in ENDS else ():
                    x = node
                    while x is not None and x.tag not in name and x.tag not in stop:
                        x = x.up
                    if x is not None and x.tag in name:
                        node = x.up
            aside, doubt, main = _is_aside(tag, match[3] or "")
            if not match[0].endswith("/>") or tag in ("p", "div", "a", "b", "i", "span"):
                child = Node(tag, node, node.aside or aside, node.link or tag == "a", main, doubt)
                node.down.append(child)
                node = child
            if tag in RAW:  # text up to the end tag, whatever it holds
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
                node = node.up
        match = TAG.search(page, at)
    add(page[at:])
    end_run()
    _doubts(root, runs)
    for node, n in links:
        if not node.aside:
            while node is not None:
                node.linked += n
                node = node.up
    return root, [(node, text) for node, text in runs if not node.aside]


def _doubts(root: Node, runs: list[tuple[Node, str]]) -> None:
    """Decide on elements that look like page furniture.

    One that holds most of the page's paragraphs is none (comments, adverts and
    the like: only if no paragraph lies elsewhere).  Of others that hold a main
    element the points are discounted and the main element is not taken at its
    word; the rest is no text.
    """
    total = 0
    for node, text in runs:
        # paragraphs by length: a list of many short entries is not most of a page
        long = len(text) if node.tag in ("p", "pre", "blockquote") else 0
        total += 0 if node.aside else long
        x, inner = node, False
        while x is not None:
            x.paragraphs += long
            x.holds = x.holds or inner
            inner = inner or (x.main and not x.doubt)
            x = x.up
    todo = [root]
    while todo:
        x = todo.pop()
        if x.doubt and not (2 * x.paragraphs > total if x.doubt == 1 else x.paragraphs == total > 0):
            x.aside, x.less = x.aside or not x.holds, True
        x.main = x.main and not x.less
        for child in x.down:
            child.aside, child.less = child.aside or x.aside, child.less or x.less
            todo.append(child)


def main_text(page: str | None) -> str:
    """Text of the article: blocks in page order, joined by one space."""
    root, runs = blocks_of(page or "")
    if not runs:
        return ""
    scored: dict[int, Node] = {}
    for node, text in runs:
        points = 1.0 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100.0, 3.0)
        # a paragraph is an element of its own; text right inside a container is its own paragraph
        x = node.up if node.tag in ("p", "pre", "blockquote", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "dd", "dt") and node.up is not None else node
        level = 0
        while x is not None:
            x.points += points / (1 if level == 0 else 2 if level == 1 else level * 3)
            scored[id(x)] = x
            x, level = x.up, level + 1
        x = node
        while x is not None:
            x.size += len(text)
            x = x.up
    final = {i: n.points * (1 - min(n.linked / n.size, 1.0) if n.size else 0.0) * (0.5 if n.less else 1) for i, n in scored.items()}
    # an element that calls itself the article is taken at its word
    best = max([n for n in scored.values() if n.main] or scored.values(), key=lambda n: final[id(n)])
    keep = {id(best)}
    # beside an element that calls itself the article only what lies in the same main element, or does so too, may belong to it
    around = best.up
    while around is not None and not around.main:
        around = around.up
    if best.up is not None:
        for other in best.up.down:
            share = other.linked / other.size if other.size else 1.0
            if best.main and around is None and not other.main:
                continue
            if other is not best and (final.get(id(other), 0.0) >= 0.2 * final[id(best)] or other.tag in ("p", "h1", "h2", "h3", "pre", "blockquote", "ul", "ol", "table")
                                      and share < 0.3):
                keep.add(id(other))
    out = []
    for node, text in runs:
        x = node
        while x is not None and id(x) not in keep:
            x = x.up
        if x is not None:
            out.append(text)
    return " ".join(out)


def extracted(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null, empty and text-free pages give an empty text.  Pages are independent:
    repeated rows give repeated results, an empty table none.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, "html"):
            texts = [main_text(t) for t in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(batches, "page_id long, url string, text string, n_chars long")
