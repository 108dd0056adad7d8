"""Main text of web pages by composite text density."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div"
    " dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr"
    " html legend li main menu nav ol optgroup option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
# Elements that hold no elements; an ``svg`` may end in its own tag.
RAW = frozenset(
    "script style textarea title noscript template iframe xmp noframes svg".split()
)
# Opening one of these ends an open element of the set, up to a container.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
LIMITS = frozenset("ul ol dl table body html div section article select".split())
# Elements that never are main text.
APART = frozenset(
    "aside button dialog footer form head header input menu nav script select style"
    " noscript template iframe textarea title svg object canvas audio video".split()
)
# A class, id or role of an element that is not main text.
NOISE = frozenset(
    "ad ads adv ad-slot ad-container ad-banner advert adverts advertisement advertising banner breadcrumb breadcrumbs"
    " comment comments complementary contentinfo cookie cookies consent dialog"
    " disclaimer discussion disqus footer gdpr masthead menu modal nav navbar"
    " navigation newsletter notice notices pagination popup promo promoted promotion"
    " related reply replies respond search share sharing sidebar side-bar social"
    " social-links social-share share-buttons related-posts related-articles"
    " cookie-banner cookie-bar cookie-consent cookie-notice gdpr-banner"
    " newsletter-signup comment-list comments-area comment-section site-footer"
    " site-header page-footer page-header main-nav main-menu site-nav nav-menu"
    " sponsor sponsored subscribe tags toolbar widget widgets".split()
)

TAG_NAME = re.compile(r"</?[a-z][^\s/>]*", re.IGNORECASE)
ATTRIBUTES = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
NAMING = re.compile(
    r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE
)
HIDDEN = re.compile(
    r"(?:^|\s)hidden(?=\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none",
    re.IGNORECASE,
)
# White space of HTML.
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = (
        "tag", "parent", "items", "apart", "doubtful", "chars", "tags", "linked", "links"
    )

    def __init__(self, tag: str, parent: Node | None, doubtful: bool) -> None:
        self.tag, self.parent, self.doubtful = tag, parent, doubtful
        self.apart = False
        self.items: list[Node | str] = []  # children and texts in page order
        self.chars = self.tags = self.linked = self.links = 0


def _is_doubtful(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is not main text by its tag or by a whole name."""
    if tag in APART:
        # an article may have a header of its own, with its headline
        return not (tag == "header" and in_article)
    if not attrs:
        return False
    if HIDDEN.search(attrs):
        return True
    return any(
        name in NOISE
        for values in NAMING.findall(attrs)
        for name in "".join(values).lower().split()
    )


def tokens(html: str) -> Iterator[tuple[str, str]]:
    """Texts as ``("", text)`` and tags as ``(name, attributes)``, end tags with a
    slash before the name. Comments and the content of raw elements are left out.

    A quote that is never closed would hide the rest of the page: once one is met,
    tags end at the next ``>``. So is what a page lacks looked for only once, and
    the time grows with the length of the page.
    """
    at, length, quoted = 0, len(html), True
    no_end: set[str] = set()
    while at < length:
        start = html.find("<", at)
        if start < 0:
            yield "", html[at:]
            return
        if start > at:
            yield "", html[at:start]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = length if end < 0 else end + 3
            continue
        name = TAG_NAME.match(html, start)
        if name is None:
            end = html.find(">", start) if html[start + 1 : start + 2] in ("!", "?", "/") else -1
            if end < 0:
                yield "", "<"
            at = start + 1 if end < 0 else end + 1
            continue
        rest = ATTRIBUTES.match(html, name.end()) if quoted else None
        if rest is not None:
            attrs, at = rest[1], rest.end()
        else:
            quoted = False
            end = html.find(">", name.end())
            if end < 0:
                yield "", html[start:]
                return
            attrs, at = html[name.end() : end], end + 1
        tag = name[0][1:].lower()
        if tag in RAW and not (tag == "svg" and attrs.endswith("/")):
            close = None if tag in no_end else RAW_END[tag].search(html, at)
            if close is not None:
                at = close.end()
            elif tag == "svg":
                no_end.add(tag)
            else:
                at = length
            continue
        yield tag, attrs


def parse(html: str) -> Node:
    """The elements and texts of a page, with the end tags it leaves out."""
    root = Node("body", None, False)
    at = root
    is_open: Counter[str] = Counter()

    def leave(node: Node) -> None:
        """Ends a node and all that is open in it."""
        nonlocal at
        while at is not node:
            is_open[at.tag] -= 1
            at = at.parent
        is_open[node.tag] -= 1
        at = node.parent

    def close_to(names: set[str], limits: frozenset[str]) -> None:
        if not any(is_open[name] for name in names):
            return
        node = at
        while node is not root and node.tag not in limits:
            if node.tag in names:
                leave(node)
                return
            node = node.parent

    for tag, attrs in tokens(html):
        if not tag:
            at.items.append(attrs)
            continue
        if tag in ("html", "body", "/html", "/body"):
            continue
        if tag[0] == "/":
            if is_open[tag[1:]]:
                node = at
                while node.tag != tag[1:]:
                    node = node.parent
                leave(node)
            continue
        if tag in BLOCKS:
            close_to({"p"}, LIMITS)
        if tag in ENDS:
            close_to(ENDS[tag], LIMITS - ENDS[tag])
        new = Node(tag, at, _is_doubtful(tag, attrs, is_open["article"] > 0))
        at.items.append(new)
        if tag not in VOID and not attrs.endswith("/"):
            at = new
            is_open[tag] += 1
    _set_apart(root)
    return root


def _set_apart(root: Node) -> None:
    """Sets doubtful elements apart, but none that holds most of the page: a form
    around the whole page, or an article with an unlucky name, is the page."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(i for i in node.items if isinstance(i, Node))
    held: dict[int, int] = {}
    for node in reversed(order):
        held[id(node)] = sum(
            len(i.strip()) if isinstance(i, str) else held[id(i)] for i in node.items
        )
    most = held[id(root)] / 2
    for node in order:
        node.apart = node.doubtful and held[id(node)] <= most


def _walk(root: Node) -> list[Node]:
    """Nodes that may hold main text, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(
            i for i in reversed(node.items) if isinstance(i, Node) and not i.apart
        )
    return order


def _measure(order: list[Node]) -> None:
    for node in reversed(order):
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(SPACE.sub(" ", item).strip())
            elif not item.apart:
                node.chars += item.chars
                node.tags += item.tags + 1
                node.linked += item.linked
                node.links += item.links
        if node.tag == "a":
            node.linked, node.links = node.chars, node.links + 1


def density(node: Node, page: Node) -> float:
    """Composite text density: characters per tag, lower the more of the
    characters and tags are links, measured against the links of the page."""
    if not node.chars:
        return 0.0
    plain = max(node.chars - node.linked, 1)
    base = log(
        node.chars / plain * node.linked
        + page.linked / max(page.chars, 1) * node.chars
        + e
    )
    tags = max(node.tags, 1)
    ratio = node.chars / max(node.linked, 1) * tags / max(node.links, 1)
    return node.chars / tags * log(max(ratio, 1.0)) / base


def main_node(root: Node) -> Node:
    """The subtree with the largest sum of its children's densities.

    The way to it from the body sets the threshold: an element on it that is
    denser than the body stands for the subtree, so that its other children are
    not cut off.
    """
    order = _walk(root)
    _measure(order)
    own = {id(node): density(node, root) for node in order}
    best, most = root, -1.0
    for node in order:
        total = sum(
            own[id(i)] for i in node.items if isinstance(i, Node) and not i.apart
        )
        if total > most:
            best, most = node, total
    threshold = own[id(root)]
    chosen, node = best, best
    while node is not root:
        if node.tag in ("article", "main") or own[id(node)] > threshold:
            chosen = node
        node = node.parent
    while chosen is not root and chosen.tag not in BLOCKS:
        chosen = chosen.parent
    return chosen


def block_texts(top: Node) -> list[str]:
    """Texts of the blocks of a subtree in page order, white space collapsed."""
    blocks: list[list[str]] = [[]]
    todo: list[Node | str | None] = [top]
    while todo:
        item = todo.pop()
        if item is None:  # a block starts or ends
            blocks.append([])
        elif isinstance(item, str):
            blocks[-1].append(item)
        elif item.tag == "br":
            blocks[-1].append(" ")
        elif not item.apart:
            around = [None] if item.tag in BLOCKS else []
            todo.extend([*around, *reversed(item.items), *around])
    texts = (SPACE.sub(" ", unescape("".join(b))) for b in blocks)
    return [t for t in (re.sub(r"\s+", " ", t).strip() for t in texts) if t]


def main_text(html: str) -> str:
    """The main text of a page, a line per block; empty if it has none."""
    return "\n".join(block_texts(main_node(parse(html))))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    Tags and whole class names on lists set elements apart, unless an element
    holds most of the characters of its page; what is left is decided by density.
    NULL or empty ``html`` and pages without text give an empty text. Repeated
    rows are extracted each. NULL ``page_id`` and ``url`` are passed on. No rows
    give no rows; further columns are not read. ``n_chars`` counts code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.col("html").cast("string"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        run,
        f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint",
    )
