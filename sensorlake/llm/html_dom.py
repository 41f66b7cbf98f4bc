"""A tolerant reader of HTML: structural elements and text blocks as a flat tree in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that show no text of the page.
UNSEEN = frozenset("head script style noscript template title svg math iframe object canvas audio video textarea select".split())
RAW = frozenset("script style title textarea iframe noscript".split())
#: A start tag ends an open element of the second kind, unless one of the third stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: A comment, another declaration, or a tag whose quoted values hold no angle bracket.
PLAIN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"<>]*\"|'[^'<>]*')*+)>)")
START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
QUOTE_OR_END = re.compile(r"[>\"']")
#: Numbers beyond the last code point, and zeros before a number.
TOO_LARGE = re.compile(r"&#(?:[1-9][0-9]{7,}|[xX][1-9a-fA-F][0-9a-fA-F]{6,});?")
ZEROS = re.compile(r"(&#[xX]?)0+(?=[0-9a-fA-F])")
NAMES = re.compile(r"\b(class|id|role|itemprop|aria-label|data-role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LEAF = "#text"


@dataclass
class Dom:
    """Nodes in page order, each after its parent; leaves (``LEAF``) have the text of a block."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    names: list[frozenset[str]] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, names: frozenset[str] = frozenset(), hidden: bool = False,
            text: str = "", links: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.hidden.append(hidden)
        self.text.append(text)
        self.links.append(links)
        return len(self.tag) - 1


def attribute_words(attrs: str) -> frozenset[str]:
    """Lower-case words of the naming attributes."""
    found = [a or b or c for _, a, b, c in NAMES.findall(attrs)]
    return frozenset(w.lower() for v in found for w in WORD.findall(v))


def unescaped(text: str) -> str:
    """Character references decoded, numbers of any length too."""
    if "&#" in text:
        text = TOO_LARGE.sub("\ufffd", ZEROS.sub(r"\1", text))
    return html.unescape(text)


class _Tags:
    """The tags of a page, found in one pass: time grows with the page, whatever is broken in it."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = page.rfind(">")
        self.dead: set[int] = set()  # quotes from which no tag's end is reached

    def next(self, at: int) -> tuple[int, int, tuple] | None:
        """Start, end and (comment, declaration, slash, name, attributes) of the next tag."""
        page = self.page
        at = page.find("<", at)
        while at >= 0:
            m = PLAIN.match(page, at) if at < self.last or page.startswith(("<!", "<?"), at) else None
            if m:
                return at, m.end(), m.groups()
            m = START.match(page, at) if at < self.last else None
            if m:
                end = self._end(m.end())
                return at, end + 1, (None, None, m.group(1), m.group(2), page[m.end():end])
            at = page.find("<", at + 1)
        return None

    def _end(self, start: int) -> int:
        """The first ``>`` outside quotes, or the first of all where quotes aren't closed."""
        page, at = self.page, start
        met: list[int] = []
        while True:
            m = QUOTE_OR_END.search(page, at)
            if m and m.group() == ">":
                return m.start()
            if not m or m.start() in self.dead:
                break
            met.append(m.start())
            at = page.find(m.group(), m.end()) + 1
            if not at:
                break
        self.dead.update(met)
        return page.find(">", start)


class _Open:
    """Open elements with their nodes (inline ones have their block's), and where each kind lies."""

    def __init__(self, root: int) -> None:
        self.nodes = [root]
        self.tags = ["#root"]
        self.blocks = [0]
        self.where: dict[str, list[int]] = {}

    def push(self, tag: str, node: int) -> None:
        k = len(self.tags)
        self.where.setdefault(tag, []).append(k)
        if tag not in INLINE:
            self.blocks.append(k)
        self.tags.append(tag)
        self.nodes.append(node)

    def last(self, tags) -> int:
        """The place of the innermost open element of these kinds, -1 if none."""
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=-1)

    def cut(self, depth: int) -> None:
        while len(self.tags) > depth:
            self.where[self.tags.pop()].pop()
            self.nodes.pop()
        while self.blocks[-1] >= depth:
            self.blocks.pop()


def parse(page: str) -> Dom:
    dom = Dom()
    stack = _Open(dom.add("#root", -1))
    anchors = stack.where.setdefault("a", [])
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescaped("".join(pieces)).split())
            pieces.clear()
            if text:
                dom.add(LEAF, stack.nodes[-1], text=text, links=min(linked, len(text)))
        linked = 0

    def close_to(depth: int) -> None:
        if stack.blocks[-1] >= depth:
            flush()
        stack.cut(depth)

    tags = _Tags(page)
    at, n = 0, len(page)
    while at < n:
        found = tags.next(at)
        stop = found[0] if found else n
        if stop > at:
            chunk = page[at:stop]
            pieces.append(chunk)
            if anchors:
                linked += len(chunk.strip())
        if not found:
            break
        _, at, (comment, bang, end, tag, attrs) = found
        if comment:
            k = page.find("-->", at)
            at = n if k < 0 else k + 3
            continue
        if bang:
            continue
        tag = tag.lower()
        if end:
            if tag == "br":
                pieces.append(" ")
            elif tag == "p" and not stack.where.get("p"):
                flush()
            else:
                k = stack.last((tag,))
                if k > (stack.blocks[-1] if tag in INLINE else 0):
                    close_to(k)
            continue
        if tag in UNSEEN:
            if tag in RAW:
                close = re.compile(rf"</{tag}\b", re.I).search(page, at)
                at = page.find(">", close.end()) + 1 if close else 0
                at = at or n
            elif not attrs.endswith("/"):
                at = _after(page, at, tag, tags.last + 1)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            stack.push(tag, stack.nodes[-1])
            continue
        flush()
        if tag in ENDS:
            what, until = ENDS[tag]
            k = stack.last(what)
            if k > stack.last(until):
                close_to(k)
        elif stack.tags[stack.blocks[-1]] == "p":
            # a block ends an open paragraph
            close_to(stack.blocks[-1])
        node = dom.add(tag, stack.nodes[-1], attribute_words(attrs) if "=" in attrs else frozenset(),
                       bool(attrs) and HIDDEN.search(attrs) is not None)
        if not attrs.endswith("/"):
            stack.push(tag, node)
    flush()
    return dom


def _after(page: str, at: int, tag: str, stop: int) -> int:
    """The end of an element that may hold others of its kind; an unclosed head ends at body. No tag ends after ``stop``."""
    depth = 1
    for m in re.compile(rf"<(/?){tag}\b[^>]*>|<body\b" if tag == "head" else rf"<(/?){tag}\b[^>]*>", re.I).finditer(page, at, stop):
        if m.group().lower().startswith("<body"):
            return m.start()
        depth += -1 if m.group(1) else 1
        if not depth:
            return m.end()
    return len(page)
