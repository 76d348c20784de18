"""Leaf blocks of a page: stretches of text between block-level tags, with what encloses them."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|[^<]+|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACES = re.compile(r"[\x20\x09-\x0D]+")

#: Fixed values from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style".split())
TEXT_ONLY = frozenset("title textarea".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li link main menu meta nav noscript ol optgroup option p pre script "
    "search section select style summary svg table tbody td template textarea tfoot th thead title tr ul".split()
)
ENDS_P = BLOCKS - frozenset("button label legend td th tr tbody thead tfoot caption option optgroup script style template noscript svg iframe link meta".split())
#: What a start tag closes, and the elements beyond which it doesn't look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_SCOPE = {"td", "th", "caption", "button", "table"}
#: The same by number: what is looked for, and beyond what not.
_SOUGHT = [({"p"}, _P_SCOPE), *dict.fromkeys((frozenset(a), frozenset(b)) for a, b in CLOSES.values())]
_SEEKS = {t: _SOUGHT.index((frozenset(a), frozenset(b))) for t, (a, b) in CLOSES.items()}
_NOWHERE = (0,) * len(_SOUGHT)


@dataclass
class Block:
    """``text`` with white space collapsed; ``linked``: characters inside links; ``around``: what the names of
    the enclosing tags and of words in their classes, ids and roles stand for; ``tag``: the nearest block tag."""

    text: str
    linked: int
    around: frozenset[str]
    tag: str
    depth: int


@dataclass
class _Open:
    tag: str
    around: frozenset[str]
    block: str
    near: tuple[int, ...]


def _names(tag: str, attributes: str) -> set[str]:
    found = {"<" + tag}
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                found.update(w.lower() for w in _NAME.findall(value))
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                found.add("*hidden")
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found.add("*hidden")
    return found


def _nearest(tag: str, at: int, above: tuple[int, ...]) -> tuple[int, ...]:
    """Per entry of _SOUGHT the place of the nearest open element that is looked for, 0 if there is none in reach."""
    if tag not in _MATTERS:
        return above
    return tuple(at if tag in tags else 0 if tag in scope else k for (tags, scope), k in zip(_SOUGHT, above))


_MATTERS = frozenset().union(*(a | b for a, b in _SOUGHT))


def blocks(page: str, stands_for: Callable[[str], str | None] = lambda name: name) -> Iterator[Block]:
    """The blocks with text, in page order.  Comments, scripts and styles have none.

    ``stands_for`` maps a name to what is kept of it (None: nothing).  With a bounded set of values the work
    is linear in the page, however deep it is nested: every open element knows the nearest ones that a
    start tag may close, and an end tag without an open element costs one look.
    """
    stack = [_Open("", frozenset(), "", _NOWHERE)]
    opened_now: Counter[str] = Counter()
    text: list[str] = []
    linked = links = 0
    place = stack[0]
    at, end = 0, len(page)

    def flush() -> Block | None:
        nonlocal text, linked
        whole = _SPACES.sub(" ", "".join(text)).strip("\x20\x09\x0a\x0b\x0c\x0d") if text else ""
        got = Block(whole, linked, place.around, place.block, len(stack)) if whole else None
        text, linked = [], 0
        return got

    def drop(to: int) -> None:
        nonlocal links
        for o in stack[to:]:
            links -= o.tag == "a"
            opened_now[o.tag] -= 1
        del stack[to:]

    def close(sought: int) -> None:
        if at_ := stack[-1].near[sought]:
            drop(at_)

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                piece = html.unescape(piece)
                if not text:
                    place = stack[-1]
                text.append(piece)
                if links:
                    linked += len(piece)
            continue
        tag, closing = tag.lower(), bool(m[1] or m[4])
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS and (b := flush()):
            yield b
        if closing:
            if opened_now[tag] > 0:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                drop(i)
            continue
        if tag in ENDS_P:
            close(0)
        if tag in _SEEKS:
            close(_SEEKS[tag])
        attributes = m[3] if m[2] else m[6]
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        top = stack[-1]
        names = {x for x in map(stands_for, _names(tag, attributes)) if x is not None}
        around = top.around if names <= top.around else top.around | names
        opened = _Open(tag, around, tag if tag in BLOCKS else top.block, _nearest(tag, len(stack), top.near))
        if tag in RAW or tag in TEXT_ONLY:
            stop = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            inner, at = (page[at : stop.start()], stop.start()) if stop else (page[at:], end)
            if tag in TEXT_ONLY:
                whole = _SPACES.sub(" ", html.unescape(inner)).strip(" ")
                if whole:
                    yield Block(whole, 0, around, tag, len(stack) + 1)
            if stop:
                at = page.find(">", at) + 1 or end
            continue
        stack.append(opened)
        opened_now[tag] += 1
        links += tag == "a"
    if b := flush():
        yield b
