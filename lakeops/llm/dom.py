"""A tolerant reader of HTML into the blocks of a page and the tree above them.

Nodes are block-level elements and, as leaves, runs of text: what lies between two block
boundaries. Inline elements join the text around them. Reading is linear in the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym area b base bdi bdo big br cite code data del dfn em embed font i img input ins kbd label link "
    "mark meta nobr param q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split()
)
# Everything up to the end tag is the element's own, also what looks like markup.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
# Controls, drawings and fallbacks: no text of the page.
UNREAD = frozenset("audio button canvas noscript object select svg template video".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
# A start tag of the key closes an open element of the first set, seen through the second.
LOOSE = frozenset({"p", "div", "address"})
CLOSES = {
    "li": (frozenset({"li"}), LOOSE),
    "dt": (frozenset({"dt", "dd"}), LOOSE),
    "dd": (frozenset({"dt", "dd"}), LOOSE),
    "tr": (frozenset({"tr"}), LOOSE | {"td", "th"}),
    "td": (frozenset({"td", "th"}), LOOSE),
    "th": (frozenset({"td", "th"}), LOOSE),
}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[^=>])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in RAW | UNREAD}
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")


@dataclass
class Page:
    """Nodes in page order: a parent precedes its children, node 0 is the root."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["body"])
    attributes: list[str] = field(default_factory=lambda: [""])
    text: list[str | None] = field(default_factory=lambda: [None])
    linked: list[int] = field(default_factory=lambda: [0])


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class _Reader:
    def __init__(self) -> None:
        self.page = Page()
        self.open: list[tuple[int, str]] = [(0, "body")]
        self.counts: dict[str, int] = {"body": 1}
        self.pieces: list[str] = []
        self.linked = 0
        self.link_depth = 0

    def add(self, tag: str, source: str, text: str | None, linked: int) -> int:
        page = self.page
        page.parent.append(self.open[-1][0])
        page.depth.append(len(self.open))
        page.tag.append(tag)
        page.attributes.append(source)
        page.text.append(text)
        page.linked.append(linked)
        return len(page.parent) - 1

    def words(self, source: str) -> None:
        if "&" in source:
            source = html.unescape(source)
        if self.open[-1][1] == "head":
            if not source.strip():
                return
            self.shut(len(self.open) - 1)
        self.pieces.append(source)
        if self.link_depth:
            self.linked += len(source)

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.add("#text", "", text, min(self.linked, len(text)))
            self.pieces = []
        self.linked = 0

    def shut(self, level: int) -> None:
        """Close the open elements from ``level`` on."""
        self.flush()
        while len(self.open) > level:
            self.counts[self.open.pop()[1]] -= 1
        if self.link_depth > len(self.open):
            self.link_depth = 0

    def start(self, tag: str, source: str) -> None:
        if tag == "a":
            self.link_depth = len(self.open)
        elif tag == "br":
            self.pieces.append(" ")
        if tag == "html" or (tag in INLINE and tag not in HEAD_ONLY):
            return
        if self.open[-1][1] == "head" and tag not in HEAD_ONLY:
            self.shut(len(self.open) - 1)
        if tag in INLINE:
            return
        if tag == "body":
            self.shut(1)
            self.page.attributes[0] = self.page.attributes[0] or source
            return
        self.flush()
        if tag == "hr":
            return
        if self.open[-1][1] == "p":
            self.shut(len(self.open) - 1)
        if tag in CLOSES:
            targets, through = CLOSES[tag]
            level = len(self.open) - 1
            while level and self.open[level][1] in through:
                level -= 1
            if level and self.open[level][1] in targets:
                self.shut(level)
        self.open.append((self.add(tag, source, None, 0), tag))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link_depth = 0
        if tag in INLINE or tag in ("body", "html"):
            return
        self.flush()
        if self.counts.get(tag):
            level = len(self.open) - 1
            while self.open[level][1] != tag:
                level -= 1
            self.shut(level)


def read(source: str) -> Page:
    """The tree of a page; anything is accepted, no text outside unread elements is lost."""
    reader = _Reader()
    at, last = 0, source.rfind(">")
    endless: set[str] = set()
    while at <= last:
        token = TOKEN.search(source, at)
        if token is None:
            break
        if token.start() > at:
            reader.words(source[at : token.start()])
        at = token.end()
        name = token.group(2)
        if not name:
            continue
        name = name.lower()
        if token.group(1):
            reader.end(name)
            continue
        if name in END_OF:
            close = END_OF[name].search(source, at) if name not in endless else None
            if close is not None:
                at = close.start()
                if name in ("textarea", "iframe", "script", "style") or name in UNREAD:
                    reader.pieces.append(" " if name not in ("script", "style") else "")
                # The end tag itself closes nothing: the element was not opened.
                skip = source.find(">", at)
                at = skip + 1 if skip >= 0 else len(source)
                continue
            endless.add(name)
            if name in RAW:
                at = len(source)
                break
            continue
        reader.start(name, token.group(3))
    tail = source[at:]
    unended = re.search(r"<(?:[a-zA-Z]|[!/?]).*", tail, re.S)
    reader.words(tail[: unended.start()] if unended else tail)
    reader.shut(1)
    reader.flush()
    return reader.page
