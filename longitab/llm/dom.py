"""Web pages as leaf blocks: runs of text between block-level tags, with what stands around them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

#: Every part of the attributes is possessive, so a failure reads the rest of the page once.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>")
_BARE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTR = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
#: Elements of the HTML standard by what they do to the text around them.
BLOCK = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea noscript template iframe svg math object audio video canvas".split())
_SKIPPED_END = {name: re.compile(rf"</{name}\b", re.I) for name in SKIPPED}
SPACE = frozenset("br wbr img input".split())
CLOSES = {  # a start tag that ends an open element, up to the element that holds both
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}


@dataclass
class Block:
    text: str
    linked: float  # share of its characters inside links
    tag: str
    around: frozenset[str]  # tags, and words of class, id and role, of all open elements
    section: int  # which sectioning element it stands in, by order of opening


SECTIONS = frozenset("article aside body div fieldset footer form header main nav section table ul ol dl".split())


@lru_cache(maxsize=4096)
def _names(attrs: str) -> tuple[str, ...]:
    """Words of class, id and role; ``hidden`` for what is not shown."""
    out = set()
    for name, *values in _ATTR.findall(attrs):
        value, name = "".join(values), name.lower()
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            out.update(w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", value))
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) or name == "aria-hidden" and value == "true":
            out.add("hidden")
    if re.search(r"(?:^|\s)hidden(?:\s|$)", _ATTR.sub(" ", attrs)):
        out.add("hidden")
    return tuple(f".{w}" for w in out)


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``(start, end, name, closing, attributes)`` of each piece of markup; comments and declarations have no name.

    A tag ends at the first ``>`` outside quotes.  Where quotes leave none up
    to the page's end, they mean nothing from there on.  What looks like
    markup but has no ``>`` after it is text.  Each character is read a fixed
    number of times, however broken the page.
    """
    pos, quotes = 0, True
    while (start := page.find("<", pos)) >= 0:
        close = name = attrs = ""
        if quotes and (m := _TAG.match(page, start)):
            close, name, attrs = m.groups()
            pos = m.end()
        elif page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            pos = stop + 3 if stop >= 0 else len(page)
        else:
            m = _BARE.match(page, start)
            if not m and page[start + 1:start + 2] not in ("!", "?", "/"):
                pos = start + 1
                continue
            stop = page.find(">", start)
            if stop < 0:
                return
            if m:
                quotes = False
                (close, name), attrs = m.groups(), page[m.end():stop]
            pos = stop + 1
        name = name.lower()
        if name in SKIPPED and not close and not attrs.endswith("/"):
            found = _SKIPPED_END[name].search(page, pos)
            stop = page.find(">", found.end()) if found else -1
            pos = stop + 1 if stop >= 0 else len(page)
        yield start, pos, name, bool(close), attrs


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that hold text, in page order.

    Character references are decoded, within a run of text only, and white
    space becomes one space.  Unclosed and stray tags are taken as browsers do:
    a block ends an open paragraph, an item the item before it, and an end tag
    without its start is dropped.  A page that is cut off ends there.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int]] = []
    places: dict[str, list[int]] = {}  # where in the stack each name stands
    solid: list[int] = []  # where its blocks stand
    sections: list[int] = [0]  # the open sections, by order of opening
    around: dict[str, int] = {}
    text: list[str] = []
    linked = links = at = opened = 0

    def flush() -> None:
        nonlocal linked
        if text:
            said = " ".join("".join(text).split())
            if said:
                tag = stack[solid[-1]][0] if solid else ""
                out.append(Block(said, min(1.0, linked / max(1, sum(map(len, text)))), tag, frozenset(around), sections[-1]))
            text.clear()
        linked = 0

    def push(name: str, attrs: str) -> None:
        nonlocal links, opened
        opened += 1
        marks = (name, *_names(attrs))
        places.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            solid.append(len(stack))
        if name in SECTIONS:
            sections.append(opened)
        stack.append((name, marks, opened))
        for m in marks:
            around[m] = around.get(m, 0) + 1
        links += name == "a"

    def pop() -> None:
        nonlocal links
        name, marks, _ = stack.pop()
        places[name].pop()
        if name in BLOCK:
            solid.pop()
        if name in SECTIONS:
            sections.pop()
        for m in marks:
            around[m] -= 1
            if not around[m]:
                del around[m]
        links -= name == "a"

    def last(names: set[str]) -> int:
        at = -1
        for n in names:
            if (places.get(n) or (-1,))[-1] > at:
                at = places[n][-1]
        return at

    def end(names: set[str], limit: int) -> None:
        """Close the nearest open element of these names, unless it stands before ``limit``."""
        k = last(names)
        if 0 <= k >= limit:
            while len(stack) > k:
                pop()

    def block() -> int:
        return solid[-1] if solid else -1

    def say(piece: str) -> None:
        nonlocal linked
        if piece:
            if "&" in piece:
                piece = html.unescape(piece)
            text.append(piece)
            if links:
                linked += len(piece)

    for start, stop, name, closing, attrs in tokens(page):
        say(page[at:start])
        at = stop
        if not name or name in SKIPPED and not closing:
            continue
        if name in BLOCK:
            flush()
        if name in SPACE:
            say(" ")
        if closing:
            end({name}, -1 if name in BLOCK else block())
        elif name not in VOID:
            if name in CLOSES:
                mine, holders = CLOSES[name]
                end(mine, last(holders))
            elif name in BLOCK:
                end({"p"}, block())
            if name == "a":
                end({"a"}, block())
            push(name, attrs)
    say(page[at:])
    flush()
    return out
