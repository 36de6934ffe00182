"""Web pages as trees of block elements with text leaves.

A lenient reader: tags close what they imply, stray ends are ignored, unclosed elements end with the page.  Inline
elements make no nodes; their text joins the leaf of the block around them.  What scripts, styles, the head, comments
and embedded objects hold is never text.  Time grows with a page's length alone, however its tags are nested.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Element names of HTML by how they are treated here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rt rp s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg math object audio video canvas select".split())
# never closed, these hold the rest of the page; of other RAW elements only the tag is passed over then.  Only svg and
# math end where they begin if their tag ends in a slash
TO_THE_END = frozenset("script style template textarea title iframe xmp noembed noframes".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an element begun closes open ones of these names, as far up as the names after them
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, set()),
}

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_PLAIN = re.compile(r"[^>]*>")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
# what follows a raw element's tag: its end, or, for those that don't nest, another's beginning
_NEXT = {t: re.compile(rf"</{t}\b" if t in TO_THE_END or t == "svg" else rf"<(/?){t}\b", re.I) for t in RAW}
_CHOICES = re.compile(r"(?:[^<]++|<(?=/?(?:option|optgroup|hr)\b|[^a-zA-Z/]))*+(?:</select\b[^>]*+>)?", re.I)
#: Blocks open at a time; those deeper are read as if their tags weren't there, as browsers do at this depth.
DEEPEST = 512


@dataclass
class Tree:
    """Nodes in page order; parents come before their children.  A leaf has its text, an element None."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters of a leaf inside links

    def add(self, parent: int, tag: str, attributes: str, text: str | None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attributes.append(attributes)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def attribute_map(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


class _Open:
    """The open elements, outermost first, with counts that tell at once whether a name is among them."""

    def __init__(self, root: int) -> None:
        self.names, self.nodes = ["#root"], [root]  # an inline element's node is that of the block around it
        self.blocks = [0]  # where the blocks lie among them
        self.count = Counter()  # of blocks, by name
        self.inline = [Counter()]  # of inline elements inside each open block
        self.deeper = Counter()  # blocks beyond DEEPEST

    def push(self, name: str, node: int) -> None:
        self.names.append(name)
        self.nodes.append(node)
        if name in INLINE:
            self.inline[-1][name] += 1
        else:
            self.blocks.append(len(self.names) - 1)
            self.count[name] += 1
            self.inline.append(Counter())

    def pop(self) -> str:
        name = self.names.pop()
        self.nodes.pop()
        if name in INLINE:
            self.inline[-1][name] -= 1
        else:
            self.blocks.pop()
            self.count[name] -= 1
            self.inline.pop()
        return name

    def ended_by(self, name: str) -> int | None:
        """Where the element lies that an end tag of this name closes."""
        if not (self.inline[-1] if name in INLINE else self.count)[name]:
            return None  # an inline end doesn't close blocks
        return next(i for i in range(len(self.names) - 1, 0, -1) if self.names[i] == name)

    def implied(self, names: set[str], bounds: set[str]) -> int | None:
        """The outermost of these names inside the innermost of the bounds."""
        left, lowest = sum(self.count[x] for x in names), None
        for i in reversed(self.blocks):
            if not left or self.names[i] in bounds:
                break
            if self.names[i] in names:
                lowest, left = i, left - 1
        return lowest


def _beyond(page: str, tag: str, at: int, unclosed: set[str]) -> int:
    """Where to read on after the tag of a raw element."""
    if tag == "select":  # holds nothing but choices
        return _CHOICES.match(page, at).end()
    found = None if tag in unclosed else _NEXT[tag].search(page, at)
    if found is None:
        unclosed.add(tag)  # nor is any later one
        return len(page) if tag in TO_THE_END else at
    if not found[0].startswith("</"):
        return at  # another begins before this one ends
    end = page.find(">", found.end())
    return len(page) if end < 0 else end + 1


def read(page: str) -> Tree:
    """The tree of a page; an empty page gives only the root."""
    tree = Tree()
    open_ = _Open(tree.add(-1, "#root", "", None))
    parts: list[str] = []
    links, linked, broken = 0, 0, False
    unclosed: set[str] = set()
    n, at = len(page), 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tree.add(open_.nodes[-1], "#text", "", text, linked)
            parts.clear()
        linked = 0

    def close(index: int) -> None:
        """End the elements from this place on."""
        nonlocal links
        while len(open_.names) > index:
            name = open_.names[-1]
            if name == "a":
                links -= 1
            if name not in INLINE:
                flush()
            open_.pop()

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        nxt = page[lt + 1 : lt + 2]
        if nxt in ("!", "?"):
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        name = _NAME.match(page, lt + 1)
        if not name:
            parts.append("<")
            at = lt + 1
            continue
        rest = None if broken else _REST.match(page, name.end())
        if rest is None:  # a quote that never ends: from here on tags end at the first bracket
            broken = True
            rest = _PLAIN.match(page, name.end())
        if rest is None:  # the page was cut inside a tag
            break
        at = rest.end()
        tag = name[1].lower()
        if nxt == "/":
            if tag == "br":
                parts.append(" ")
            if open_.deeper[tag]:
                open_.deeper[tag] -= 1
                continue
            where = open_.ended_by(tag)
            if where is not None:
                close(where)
            continue
        raw = page[name.end() : rest.end() - 1]
        if tag in RAW:
            if tag not in ("svg", "math") or not raw.endswith("/"):
                at = _beyond(page, tag, at, unclosed)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                parts.append(" " if tag == "br" else "")
            continue
        if tag in INLINE:
            if tag == "a":
                links += 1
            open_.push(tag, open_.nodes[-1])
            continue
        flush()
        if tag in CLOSES_P and open_.names[open_.blocks[-1]] == "p":
            close(open_.blocks[-1])
        if tag in IMPLIED:
            where = open_.implied(*IMPLIED[tag])
            if where is not None:
                close(where)
        if tag == "html" or raw.endswith("/") and tag not in ("p", "div", "section", "article", "body", "main"):
            continue
        if len(open_.blocks) >= DEEPEST:
            open_.deeper[tag] += 1
            continue
        open_.push(tag, tree.add(open_.nodes[-1], tag, raw, None))
    flush()
    return tree
