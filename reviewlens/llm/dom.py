"""A small HTML reader: a tree of elements with their direct text, enough to find the main text of a page."""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

#: Fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements that nest like others, but whose end tag reaches out of blocks and whose inside leaves the outside alone.
NESTED = frozenset("svg math noscript template".split())
FOREIGN = frozenset({"svg", "math"})
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4"
    " h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag closes: elements of the named kinds, up to the nearest element of the fence.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot"}), frozenset({"table"})),
}
P_FENCE = NESTED | frozenset("td th caption button object table body html".split())
NO_P = BLOCK - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "frameset"}

_NAME_END, _STOP = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None
    #: Child nodes and pieces of text in page order.
    items: list[Node | str] = field(default_factory=list)

    def children(self) -> list[Node]:
        return [x for x in self.items if not isinstance(x, str)]


def _attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")) if value else "")
    return out


class _Tags:
    """Finds where tags end in one page. Every answer is remembered as far as it holds, so a page of unclosed tags is read once."""

    def __init__(self, page: str):
        self.page, self.last = page, {c: page.rfind(c) for c in ">\"'"}
        self.name_from, self.name_to, self.stop_from, self.stop_to = 0, -1, 0, -1
        self.dead: set[int] = set()  # quotes from which no end of a tag is reached

    def name_end(self, at: int) -> int:
        if not self.name_from <= at <= self.name_to:
            m = _NAME_END.search(self.page, at)
            self.name_from, self.name_to = at, m.start() if m else len(self.page)
        return self.name_to

    def _stop(self, at: int) -> int:
        if not self.stop_from <= at <= self.stop_to:
            m = _STOP.search(self.page, at)
            self.stop_from, self.stop_to = at, m.start() if m else len(self.page)
        return self.stop_to

    def end(self, at: int) -> int:
        """Position of the ">" that ends the tag whose attributes begin at ``at``, or -1. A ">" in quotes is part of a value."""
        tried = []
        while at <= self.last[">"]:
            stop = self._stop(at)
            quote = self.page[stop]
            if quote == ">":
                return stop
            if stop in self.dead or stop >= self.last[quote]:
                break
            tried.append(stop)
            at = self.page.find(quote, stop + 1) + 1
        self.dead.update(tried)
        return -1


class _Open:
    """The open elements, innermost last, and by name: what a tag closes is found without walking up the tree."""

    def __init__(self, root: Node):
        self.chain = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # depths of open blocks other than p

    @property
    def here(self) -> Node:
        return self.chain[-1]

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.chain))
        if node.tag in BLOCK and node.tag != "p":
            self.blocks.append(len(self.chain))
        self.chain.append(node)

    def cut(self, depth: int) -> None:
        """Close the element at ``depth`` and all inside it."""
        while len(self.chain) > depth:
            node = self.chain.pop()
            self.depths[node.tag].pop()
            if self.blocks and self.blocks[-1] == len(self.chain):
                self.blocks.pop()

    def last(self, names: Iterable[str]) -> int:
        """Depth of the innermost open element with one of the names; 0 if there is none."""
        return max((d[-1] for n in names if (d := self.depths.get(n))), default=0)

    def make_room(self, name: str) -> None:
        """Close what an opening tag closes: a paragraph before a block, and the kinds named in ``CLOSES``."""
        if name in NO_P and (p := self.last(("p",))) > self.last(P_FENCE):
            self.cut(p)
        if name in CLOSES:
            kinds, fence = CLOSES[name]
            inside = self.last(fence | NESTED)
            found = [d[k] for n in kinds if (d := self.depths.get(n)) and (k := bisect.bisect_right(d, inside)) < len(d)]
            if found:
                self.cut(min(found))

    def close(self, name: str) -> Node | None:
        """Close the innermost element of that name. An inline end tag does not reach out of the block it is in."""
        at = self.last((name,))
        if not at or (name not in BLOCK and name not in NESTED and self.blocks and self.blocks[-1] > at):
            return None
        node = self.chain[at]
        self.cut(at)
        return node


def parse(page: str) -> Node:
    """The tree of a page, in time that grows with its length however it is broken.

    Broken markup never fails: open elements end with their parent, stray end tags are ignored, and a "<" that opens no tag
    is text. An element that is not ended, where only its end would tell what it holds (``NESTED``), holds nothing special.
    """
    root = Node("#page", {}, None)
    tags, open_ = _Tags(page), _Open(root)
    nested: list[Node] = []
    ended: set[int] = set()
    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            open_.here.items.append(html.unescape(page[at:lt]))
        if lt == end:
            break
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = close + 3 if close >= 0 else end
            continue
        slash = page.startswith("/", lt + 1)
        begin = lt + 1 + slash
        letter = page[begin : begin + 1]
        gt = -1
        if letter.isascii() and letter.isalpha() and lt < tags.last[">"]:
            stop = tags.name_end(begin)
            gt = tags.end(stop)
        if gt < 0:
            if slash or page[lt + 1 : lt + 2] in ("!", "?"):
                close = page.find(">", lt) if lt < tags.last[">"] else -1
                at = close + 1 if close >= 0 else end
            else:
                open_.here.items.append("<")
                at = lt + 1
            continue
        name, attrs, at = page[begin:stop].lower(), page[stop:gt], gt + 1
        if slash:
            node = open_.close(name)
            if node is not None and name in NESTED:
                ended.add(id(node))
            continue
        if name in BLOCK:
            open_.make_room(name)
        node = Node(name, _attributes(attrs), open_.here)
        open_.here.items.append(node)
        empty = attrs.endswith("/")
        if name in NESTED and not (empty and name in FOREIGN):
            nested.append(node)
        if name in RAW and not (empty and open_.last(FOREIGN)):
            closing = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            node.items.append(page[at : closing.start()] if closing else page[at:])
            if closing is None:
                break
            gt = page.find(">", closing.start())
            at = gt + 1 if gt >= 0 else end
        elif name not in VOID and (not empty or name in ("noscript", "template") or name in BLOCK):
            open_.push(node)  # a slash in the tag of a non-void element has no meaning in HTML
    for node in nested:
        if id(node) not in ended and node.tag != "math":
            node.tag = "span"  # never ended: what follows it is the page's own text
    return root
