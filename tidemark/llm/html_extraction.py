"""Main text of web pages by scoring a tree of the page.

Each paragraph earns points for length and commas and passes them to its ancestors, in
full to the parent and ever less above. A container's points are discounted by its link
density; the best container is the article, and siblings that score alike are kept with
it, and so is what stands between them. Elements that are no article by tag, role
or name (menus, sidebars, notices, adverts, forms, comments) are left out before; they end
where any element ends. Inside what is an article by tag or name, only names that are nothing
else count. No rule looks at the size of a page or an element alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

# ── fixed values: kinds of elements ──────────────────────────────────────────

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = RAW | frozenset(
    "head nav footer aside form button select option noscript template svg canvas object audio video map dialog menu".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
PARAGRAPH = frozenset("p pre blockquote li dd td".split())
CONTAINER = frozenset("article main section div body td blockquote".split())
#: Elements in the head; any other ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements past which an item ends no other.
_BOUNDS = "article main section nav header footer aside form blockquote table td th button object template noscript"
#: A start tag of the key ends an open element of the set, up to an element that bounds it.
ENDS = {
    "li": ("li", f"ul ol menu {_BOUNDS}"),
    "dt": ("dt dd", f"dl {_BOUNDS}"),
    "dd": ("dt dd", f"dl {_BOUNDS}"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("thead tbody tfoot tr td th", "table"),
    "option": ("option", "select"),
}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}

#: Parts of names (class, id) and roles of what is no article; and of what is one.
UNLIKELY = re.compile(
    r"(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side|widget\w*|comment\w*|disqus|respond|"
    r"reply|replies|discussion|reactions|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter|subscribe|"
    r"subscription|signup|login|share|sharing|social|related|recommend\w*|breadcrumb\w*|pagination|pager|menu\w*|nav\w*|"
    r"footer|foot|masthead|header|topbar|toolbar|search|skip|legal|copyright|tags?|toc)",
    re.IGNORECASE,
)
LIKELY = re.compile(r"article|body|content|entry|main|post|story|text", re.IGNORECASE)
#: Parts of a name that alone mark an article; and first and last parts of names that tell a state.
LIKELY_HEADS = frozenset("article content entry main post story".split())
STATE = frozenset("has with without no not is tag category format type status show hide".split())
STATE_ENDS = frozenset("open closed enabled disabled active on off".split())
#: Parts that add nothing to a name: with others than these, it names a subject (related-work, table-header).
GENERIC = frozenset(
    "area articles bar block blog bottom box button buttons container entries form global group icons inner items left"
    " links list outer page panel pane posts primary right row secondary section site slot stories top wrap wrapper zone".split()
)
#: Whole names that are no article wherever they stand.
NEVER_NAMED = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo|comments?|comments?[_-](list|section|area|form)|disqus\w*|respond|"
    r"(social[_-])?(share|sharing)([_-](bar|box|buttons?|links|list))?|sidebar|navigation|navbar|breadcrumbs?|"
    r"pagination|newsletter|cookie[_-]\w+",
    re.IGNORECASE,
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</[^a-zA-Z][^>]*>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    """An element; ``parts`` holds its texts and elements in page order."""

    __slots__ = ("tag", "name", "parent", "parts", "points", "chars", "linked", "links", "inside", "cut")

    def __init__(self, tag: str, name: str, parent: Node | None) -> None:
        self.tag, self.name, self.parent = tag, name, parent
        self.parts: list[Node | str] = []
        self.inside: bool = tag in ("article", "main") or parent is not None and parent.inside
        self.cut = False
        self.points = 0.0
        self.chars = self.linked = self.links = 0

    def link_density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


def _attributes(text: str) -> tuple[str, bool]:
    """Class and id of a start tag, and whether it is cut off for what its attributes say."""
    names, away = [], False
    for key, *values in _ATTRIBUTE.findall(text):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id"):
            names.append(html.unescape(value))
        elif key == "role":
            away |= value.strip().lower() in ROLES
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            away = True
    return " ".join(names), away


def parse(page: str) -> Node:
    """The page's tree; what is no article by tag or role is marked as cut, with all below it."""
    root = Node("body", "", None)
    here, at = root, 0
    while True:
        match = _TOKEN.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            if here.tag == "head" and here.parent and text.strip():
                here = here.parent
            if not here.cut:
                here.parts.append(html.unescape(text))
        if not match:
            return root
        at = match.end()
        closing, tag, attributes = match[1], (match[2] or "").lower(), match[3] or ""
        if here.tag == "head" and here.parent and tag and not closing and tag not in IN_HEAD:
            here = here.parent  # its end tag is optional
        if not tag or tag in ("html", "body"):
            continue
        if closing:
            node = here
            while node.parent and node.tag != tag:
                node = node.parent
            if node.parent:
                here = node.parent
            continue
        if tag not in INLINE and tag != "br":
            here = _before_block(here, tag)
        if tag in VOID:
            if tag in ("br", "hr"):
                here.parts.append(" ")
            continue
        name, away = _attributes(attributes) if attributes and not here.cut else ("", False)
        child = Node(tag, name, here)
        child.cut = here.cut or away or tag in NEVER or tag == "header" and not here.inside
        here.parts.append(child)
        if tag in RAW:
            child.cut = True
            at = _after_raw(page, tag, at)
        elif not attributes.endswith("/") or tag != "svg":
            here = child


def _unlikely(name: str) -> tuple[bool, bool]:
    """Whether a word of class or id says that this is no article; or that it is one.

    ``has-sidebar``, ``comments-open`` and ``tag-politics`` tell the state of what they stand
    on, ``related-work`` and ``table-header`` a subject.
    """
    against = rescued = False
    for token in name.lower().split():
        parts = [x for x in re.split("[_-]+", token) if x]
        if not parts or len(parts) > 1 and (parts[0] in STATE or parts[-1] in STATE_ENDS):
            continue
        telling = [x for x in parts if x not in GENERIC and not x.isdigit()]
        if telling and all(map(UNLIKELY.fullmatch, telling)):
            against = True
        elif parts[0] in LIKELY_HEADS or parts[-1] in LIKELY_HEADS:
            rescued = True
    return against, rescued


def _cut_by_name(root: Node, order: list[Node]) -> bool:
    """Mark what is no article by name; whether anything was marked.

    What also bears an article's name and has few links is left to the points, and what is in
    it counts as inside an article. Where nothing would be left, the outermost elements stay.
    """
    marked = []
    for node in reversed(order):  # parents first
        above = node.parent
        node.inside |= above is not None and above.inside
        if not node.name or node.tag in ("article", "main") or node.tag in HEADING:
            continue
        against, rescued = _unlikely(node.name)
        if node.inside and not (above and above.inside and against):
            continue
        if above and above.inside:
            against = any(map(NEVER_NAMED.fullmatch, node.name.split()))
        if node.tag in CONTAINER and rescued and node.link_density() < 0.5:
            node.inside = True
        elif against:
            node.cut = True
            marked.append(node)
    if marked and not _measure(root)[-1].chars:
        for node in reversed(marked):  # the outermost last, so that those inside see them cut
            above = node.parent
            while above and not above.cut:
                above = above.parent
            node.cut = above is not None or node.tag not in CONTAINER
    return bool(marked)


def _after_raw(page: str, tag: str, at: int) -> int:
    end = re.compile(f"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(page, at)
    return end.end() if end else len(page)


def _before_block(here: Node, tag: str) -> Node:
    """Where a block starts: open paragraphs end, and the items that ``tag`` ends."""
    ended, bounds = ENDS.get(tag, (frozenset(), frozenset()))
    node, to = here, here
    while node.parent and node.tag not in bounds:
        if node.tag == "p" or node.tag in ended:
            to = node.parent
        elif node.tag not in INLINE and node.tag not in ended and not ended:
            break
        node = node.parent
    return to


def _measure(root: Node) -> list[Node]:
    """Fill in characters and links of every element; the elements, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [p for p in node.parts if isinstance(p, Node) and not p.cut]
    order.reverse()
    for node in order:
        node.chars = node.linked = node.links = 0
        for part in node.parts:
            if isinstance(part, Node):
                if not part.cut:
                    node.chars += part.chars
                    node.linked += part.linked
                    node.links += part.links
            else:
                node.chars += len("".join(part.split()))
        if node.tag == "a":
            node.linked, node.links = node.chars, 1
    return order


def _own_text(node: Node) -> str:
    """Text of the element and of the inline elements in it."""
    out, stack = [], list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag in INLINE:
            stack += [" "] if part.cut else reversed(part.parts)
    return " ".join("".join(out).split())


def _score(order: list[Node]) -> None:
    for node in order:
        if node.tag not in PARAGRAPH and node.tag not in CONTAINER or node.tag in ("td", "li") and node.link_density() > 0.5:
            continue
        text = _own_text(node)
        if len(text) < 2:
            continue
        points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        if node.tag in CONTAINER and node.tag not in PARAGRAPH:
            node.points += points
        share, above = 1.0, node.parent
        while above and share > 1e-6:
            above.points += points * share
            share, above = share / 2, above.parent
    for node in order:
        if node.tag in ("article", "main"):
            node.points = node.points * 1.5 + 5
        elif node.name and LIKELY.search(node.name) and node.tag in CONTAINER:
            node.points += min(5, node.points / 4)
        node.points *= 1 - node.link_density()


def main_text(page: str) -> str:
    """The article's blocks in page order, joined by one space."""
    root = parse(page)
    order = _measure(root)
    if _cut_by_name(root, order):
        order = _measure(root)
    _score(order)
    candidates = [n for n in order if n.tag in CONTAINER and n.points > 0]
    if not candidates:
        return " ".join(_blocks([root]))
    best = max(reversed(candidates), key=lambda n: n.points)  # of equals the outermost
    return " ".join(_blocks(_with_siblings(best)))


def _with_siblings(best: Node) -> list[Node | str]:
    """The best container and what around it is of the article.

    Between the first and the last part that score alike all stays but what is mostly links.
    Next to them stay loose text, lists, tables, figures and paragraphs, unless the container
    is an article by tag, whose end says where it ends.
    """
    if not best.parent:
        return [best]
    parts = [p for p in best.parent.parts if isinstance(p, str) or not p.cut]
    enough = max(2.0, best.points * 0.2)
    alike = [i for i, p in enumerate(parts) if p is best or isinstance(p, Node) and _alike(p, best, enough)]
    first, last = alike[0], alike[-1]
    if best.tag not in ("article", "main"):
        while first and _adjoins(parts[first - 1]):
            first -= 1
        while last + 1 < len(parts) and _adjoins(parts[last + 1]):
            last += 1
    return [p for i, p in enumerate(parts[first : last + 1], first) if i in alike or isinstance(p, str) or p.tag in INLINE or p.link_density() < 0.5]


def _alike(node: Node, best: Node, enough: float) -> bool:
    """Whether a container scores like the best; a common name counts for a part of the score."""
    return node.tag in CONTAINER and node.points + (best.points * 0.2 if node.name and node.name == best.name else 0) >= enough


def _adjoins(part: Node | str) -> bool:
    if isinstance(part, str) or part.tag in INLINE or part.tag in VOID:
        return True
    return (part.tag in PARAGRAPH or part.tag not in CONTAINER) and part.link_density() < 0.3


def _blocks(nodes: list[Node]) -> Iterator[str]:
    """Trimmed texts of the blocks below, empty ones left out."""
    run: list[str] = []
    stack: list[Node | str | None] = list(reversed(nodes))
    while stack or run:
        part = stack.pop() if stack else None
        if isinstance(part, str):
            run.append(part)
        elif part is not None and part.tag in INLINE:
            stack += [" "] if part.cut else reversed(part.parts)
        else:
            block = " ".join("".join(run).split())
            run = []
            if block:
                yield block
            if part is not None and not part.cut:
                stack += [None, *reversed(part.parts)]


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of ``pages``.

    Character references are decoded, white space inside a block is one space, blocks are
    trimmed and joined by one space. A null or empty page, or one without text, gives "".
    Broken markup is read as far as it goes: open elements end with the page, stray end tags
    and lone "<" change nothing. Null ids and urls stay null; repeated rows give repeated
    results; a very long page is read whole; an empty table gives an empty one; other columns
    don't matter. No shuffle.
    """

    def one(page_id: int | None, url: str | None, page: str) -> Iterator[tuple]:
        text = main_text(page)
        yield page_id, url, text, len(text)

    table = pages.select(
        pages[id_col].cast("long"), pages[url_col].cast("string"), F.coalesce(pages[html_col].cast("string"), F.lit(""))
    )
    return map_rows(table, lambda: one, "page_id long, url string, text string, n_chars long", rows=500)
