"""Web pages as trees of blocks, and the alignment of two such trees."""

import html
import re
from dataclasses import dataclass, field

import xxhash

# The elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary "
    "table ul".split()
)
# What an element of this name ends, and what it looks no further than.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
# Of elements nested deeper only the text is read, as that of the last one above.
MAX_DEPTH = 256
# Never part of an article.
DROPPED = frozenset(
    "head nav footer aside form script style noscript iframe template button select option "
    "textarea dialog menu svg canvas object audio video map title input search datalist "
    "xmp noembed noframes".split()
)
# Names in a class, id or role of something beside the article. Names count whole.
ASIDE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored "
    "promo promotion promoted banner cookie cookies consent gdpr notice notices popup modal overlay "
    "sidebar sidenav aside complementary menu submenu nav navbar navigation breadcrumb breadcrumbs "
    "masthead topbar footer contentinfo comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended newsletter subscribe subscription signup login "
    "pagination pager toolbar widget widgets skip".split()
)
# Or two of them, or one with a word of place or form before or after: cookie-notice, top-menu, comment-list.
_PLACES = "top bottom left right upper lower inner outer site page".split()
_FORMS = "list item items box block bar area section wrap wrapper container form links".split()
ASIDE |= {
    f"{before}{mark}{after}"
    for name in ASIDE
    for before, after in [*((p, name) for p in _PLACES), *((name, x) for x in [*_FORMS, *ASIDE])]
    for mark in "-_"
}
# An article of this name is a reader's. No other names are taken of elements that hold the article.
READERS = frozenset(("comment", "comments", "reply", "replies"))
HOLDERS = frozenset(("html", "body", "main"))
# Names that a piece of writing may have as its topic: they say nothing within an article.
TOPICS = frozenset("menu social banner".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# Quotes delimit a value directly after "=" only. One that is never closed is read as an
# unquoted value, so that the tag ends at the next ">".
_TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|[^>=])*+)>"""
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Node:
    """An element other than an inline one. parts are texts and nodes in page order."""

    tag: str
    names: tuple[str, ...] = ()
    parts: list = field(default_factory=list)
    # Its class, id and role names as they stand, and whether it has an article or main below it,
    # or above it.
    tokens: frozenset[str] = frozenset()
    holds_article: bool = False
    in_article: bool = False
    # Set where the host's wrapper, or lack of anything else, says that this is content.
    is_content: bool = False

    @property
    def label(self) -> str:
        return ".".join((self.tag, *self.names))

    @property
    def beside_article(self) -> bool:
        if self.is_content:
            return False
        if self.tag in DROPPED:
            # Some frameworks put a whole page into one form.
            return not (self.tag == "form" and self.holds_article)
        if self.tag in HOLDERS or self.holds_article:
            return False
        tokens = self.tokens - TOPICS if self.in_article else self.tokens
        return not (READERS if self.tag == "article" else ASIDE).isdisjoint(tokens)


def _tokens(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    values = [value.strip("\"'").lower() for _, value in _ATTRIBUTE.findall(attributes)]
    return frozenset(token for value in values for token in value.split())


def _names(tokens: frozenset[str]) -> tuple[str, ...]:
    """The letter runs of names: numbers in them differ from page to page."""
    return tuple(sorted({part for token in tokens for part in _NAME_PARTS.split(token)} - {""}))


def parse(page: str) -> Node:
    """The tree of a page, well formed or not. Character references are decoded."""
    root = Node("#root")
    # Names of open elements; inline ones are open but have no node.
    opened = ["#root"]
    nodes = [root]

    def close(index: int) -> None:
        del opened[index:], nodes[index:]

    def end_paragraph() -> None:
        for i in range(len(opened) - 1, 0, -1):
            if opened[i] == "p":
                return close(i)
            if opened[i] in ("table", "td", "th", "button", "object", "caption"):
                return

    def add_text(text: str) -> None:
        if text:
            nodes[-1].parts.append(html.unescape(text) if "&" in text else text)

    at, size = 0, len(page)
    while at < size:
        less = page.find("<", at)
        if less < 0:
            add_text(page[at:])
            break
        add_text(page[at:less])
        following = page[less + 1 : less + 2]
        if following in ("!", "?"):
            if page.startswith("<!--", less):
                end = page.find("-->", less + 4) if page[less + 4 : less + 5] != ">" else less + 2
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", less)
                at = size if end < 0 else end + 1
            continue
        match = _TAG.match(page, less)
        if not match:
            if following.isascii() and (following.isalpha() or following == "/"):
                if page.find(">", less) < 0 or following != "/":
                    break  # the page ends within a tag
                at = page.find(">", less) + 1
            else:
                add_text("<")
                at = less + 1
            continue
        at = match.end()
        closing, name, attributes = match.groups()
        name = name.lower()
        if closing:
            if name == "br":
                nodes[-1].parts.append(" ")
            for i in range(len(opened) - 1, 0, -1):
                if opened[i] == name:
                    close(i)
                    break
                if name in INLINE and opened[i] not in INLINE:
                    break
                if name == "p" and opened[i] in ("table", "td", "th", "article", "div", "section"):
                    break
            continue
        if name in CLOSES_PARAGRAPH:
            end_paragraph()
        if name in CLOSES:
            ends, limits = CLOSES[name]
            lowest = 0
            for i in range(len(opened) - 1, 0, -1):
                if opened[i] in limits:
                    break
                if opened[i] in ends:
                    lowest = i
            if lowest:
                close(lowest)
        if name in ("html", "body") and name in opened:
            continue
        if name in VOID:
            if name == "hr":
                nodes[-1].parts.append(Node("hr"))
            elif name == "br":
                nodes[-1].parts.append(" ")
            continue
        tokens = _tokens(attributes)
        if name in INLINE and ASIDE.isdisjoint(tokens):
            node = nodes[-1]
        else:
            above = nodes[-1]
            inside = above.in_article or above.tag in ("article", "main")
            node = Node(name, _names(tokens), tokens=tokens, in_article=inside)
            nodes[-1].parts.append(node)
            if name in ("article", "main") and not node.beside_article:
                for above in nodes:
                    above.holds_article = True
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if end is None:
                break
            close_at = page.find(">", end.end())
            at = size if close_at < 0 else close_at + 1
            continue
        if attributes.endswith("/") and name in ("svg", "path", "circle", "rect", "use"):
            continue
        if len(opened) < MAX_DEPTH:
            opened.append(name)
            nodes.append(node)
    return root


def blocks_of(node: Node) -> list[str | Node]:
    """The node's own runs of text, white space made single, and its child nodes."""
    found: list[str | Node] = []
    run: list[str] = []
    for part in [*node.parts, None]:
        if isinstance(part, str):
            run.append(part)
            continue
        text = " ".join("".join(run).split())
        if text:
            found.append(text)
        run = []
        if part is not None:
            found.append(part)
    return found


def hash_text(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
    return value - (1 << 64) if value >> 63 else value


@dataclass
class Shape:
    """A node of a folded tree: siblings of equal structure are one node.

    texts are the hashes of the text runs of all the nodes it stands for, sizes their code points.
    """

    label: str
    children: list["Shape"] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)

    def signature(self) -> tuple:
        return self.label, tuple(child.signature() for child in self.children)


def fold(node: Node) -> Shape:
    """The folded tree below a node: all of it, menus and adverts too."""
    shape = Shape(node.label, nodes=[node])
    by_structure: dict[tuple, Shape] = {}
    for part in blocks_of(node):
        if isinstance(part, str):
            shape.texts.append(hash_text(part))
            shape.sizes.append(len(part))
        else:
            child = fold(part)
            same = by_structure.setdefault(child.signature(), child)
            if same is child:
                shape.children.append(child)
            else:
                _merge(same, child)
    return shape


def _merge(shape: Shape, other: Shape) -> None:
    shape.texts += other.texts
    shape.sizes += other.sizes
    shape.nodes += other.nodes
    for child, more in zip(shape.children, other.children):
        _merge(child, more)


def dump(shape: Shape) -> list:
    """Labels only, as nested lists."""
    return [shape.label, [dump(child) for child in shape.children]]


def load(dumped: list) -> Shape:
    return Shape(dumped[0], [load(child) for child in dumped[1]])


def _score(a: Shape, b: Shape, known: dict) -> int:
    """Simple tree matching: the most pairs of nodes that keep order and parents."""
    if a.label != b.label:
        return 0
    key = id(a), id(b)
    if key not in known:
        known[key] = 1 + _table(a.children, b.children, known)[-1][-1]
    return known[key]


def _table(left: list[Shape], right: list[Shape], known: dict) -> list[list[int]]:
    table = [[0] * (len(right) + 1)]
    for i, a in enumerate(left):
        row, above = [0], table[i]
        for j, b in enumerate(right):
            row.append(max(above[j + 1], row[j], above[j] + _score(a, b, known)))
        table.append(row)
    return table


def align(reference: Shape, page: Shape) -> list[tuple[int, Shape]]:
    """(number of the reference's node, matched node of the page) pairs.

    Nodes of the reference are numbered from 0 in page order.
    """
    numbers: dict[int, int] = {}

    def number(shape: Shape) -> None:
        numbers[id(shape)] = len(numbers)
        for child in shape.children:
            number(child)

    number(reference)
    known: dict = {}
    found: list[tuple[int, Shape]] = []

    def pair(a: Shape, b: Shape) -> None:
        found.append((numbers[id(a)], b))
        left, right = a.children, b.children
        # Pairing equal first or last children is always part of a best alignment, so
        # only what differs between them takes a table.
        first, last = 0, 0
        shorter = min(len(left), len(right))
        while first < shorter and left[first].signature() == right[first].signature():
            first += 1
        while last < shorter - first and left[-1 - last].signature() == right[-1 - last].signature():
            last += 1
        for x, y in zip(left[:first], right[:first]):
            pair(x, y)
        ends = list(zip(left[len(left) - last :], right[len(right) - last :]))
        left, right = left[first : len(left) - last], right[first : len(right) - last]
        table = _table(left, right, known)
        i, j = len(left), len(right)
        pairs = []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
        for x, y in [*reversed(pairs), *ends]:
            pair(x, y)

    if reference.label == page.label:
        pair(reference, page)
    return found
