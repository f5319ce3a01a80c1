"""A forgiving HTML reader: block elements as nodes, with their text runs in page order."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from html import unescape

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp noembed noframes iframe".split())
NEVER_TEXT = frozenset(
    "script style noscript template head title meta link svg math iframe object canvas audio video map select option button "
    "textarea input datalist noembed noframes dialog".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br img nobr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
# An opening tag ends open elements of these names, as far as the nearest of the second ones.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
# A paragraph is not closed across these.
_SCOPE = frozenset("table td th caption button object template".split())

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass
class Node:
    """A block element. `runs` are its own texts; a child's place among them is kept in the page's order of runs."""

    name: str
    attributes: dict[str, str]
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)
    own: int = 0  # characters of its own text
    linked: int = 0  # of which in links


@dataclass
class Page:
    """Nodes in page order, and the pieces of text: (node, block, text, whether in a link). A new block begins with a block element's tag."""

    nodes: list[Node]
    runs: list[tuple[int, int, str, bool]]


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def parse(html: str) -> Page:
    """Nodes and texts of a page. Never fails: what is no markup is text, what isn't closed ends with its parent."""
    nodes = [Node("#page", {}, -1, 0)]
    runs: list[tuple[int, int, str, bool]] = []
    open_: list[tuple[str, int]] = [("#page", 0)]  # all open elements, each with the block node it is in
    at_name: dict[str, list[int]] = defaultdict(list)  # where in it the open elements of each name are
    outer = [0]  # and where those are that aren't inline
    links = hidden = block = at = 0

    def text(piece: str) -> None:
        if piece and not hidden:
            node = open_[-1][1]
            decoded = unescape(piece)
            size = len("".join(decoded.split()))
            nodes[node].own += size
            if links:
                nodes[node].linked += size
            runs.append((node, block, decoded, links > 0))

    def opened(name: str, inside: int) -> None:
        at_name[name].append(len(open_))
        if name not in INLINE:
            outer.append(len(open_))
        open_.append((name, inside))

    def close_from(place: int) -> None:
        nonlocal links, hidden, block
        while len(open_) > place:
            name, _ = open_.pop()
            if name:
                at_name[name].pop()
                links -= name == "a"
                hidden -= name in NEVER_TEXT
                if name not in INLINE:
                    outer.pop()
                    block += 1
        ended()

    def ended() -> None:
        while not open_[-1][0]:  # a link that another one has ended
            open_.pop()

    def innermost(names: frozenset[str]) -> int:
        return max((at_name[n][-1] for n in names if at_name.get(n)), default=0)

    def close_until(names: frozenset[str], stop: frozenset[str]) -> None:
        while (place := innermost(names)) and place >= innermost(stop):
            close_from(place)

    while True:
        m = _MARKUP.search(html, at)
        if m is None:
            text(html[at:])
            return Page(nodes, runs)
        text(html[at : m.start()])
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if name == "br":
                runs.append((open_[-1][1], block, " ", False))
            place = innermost(frozenset([name]))
            if place and not (name in INLINE and outer[-1] > place):  # a stray end of an inline element closes no block
                close_from(place)
        elif m[2]:
            name = m[2].lower()
            if not m[4]:
                continue  # the page ends within the tag
            if name in CLOSES_PARAGRAPH:
                close_until(frozenset(["p"]), _SCOPE)
            if name in IMPLIED:
                close_until(*IMPLIED[name])
            if re.fullmatch("h[1-6]", name) and re.fullmatch("h[1-6]", open_[-1][0]):
                close_from(len(open_) - 1)
            if name == "a" and at_name["a"] and at_name["a"][-1] > outer[-1]:
                place = at_name["a"].pop()
                open_[place] = ("", open_[place][1])
                links -= 1
                ended()
            if name in VOID:
                if name in ("br", "hr"):
                    block += name == "hr"
                    runs.append((open_[-1][1], block, " ", False))
                continue
            inside = open_[-1][1]
            if name not in INLINE:
                block += 1
                nodes.append(Node(name, _attributes(m[3]), inside, nodes[inside].depth + 1))
                nodes[inside].children.append(len(nodes) - 1)
                inside = len(nodes) - 1
            opened(name, inside)
            links += name == "a"
            hidden += name in NEVER_TEXT
            if name in RAW_TEXT:
                end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(html, at)
                if end is None:
                    return Page(nodes, runs)
                at = end.start()


def blocks(page: Page, kept: list[bool]) -> str:
    """The text of kept nodes: a line a block, white space as one space, no empty lines."""
    lines: list[str] = []
    parts: list[str] = []
    current = None
    for node, block, piece, _ in page.runs:
        if block != current:
            lines.append(" ".join("".join(parts).split()))
            parts, current = [], block
        if kept[node]:
            parts.append(piece)
    lines.append(" ".join("".join(parts).split()))
    return "\n".join(line for line in lines if line)
