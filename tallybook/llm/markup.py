"""A page as a run of tags and text blocks, tolerant of unclosed and stray tags."""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from typing import NamedTuple

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select option xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSED_BY = {  # an open tag that a new one ends
    "p": frozenset(
        "p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside nav header footer form fieldset pre blockquote "
        "figure hr main address details".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
BLANKS = re.compile(r"\s+")


class Block(NamedTuple):
    element: int  # the element around it
    text: str
    begun: tuple[int, ...] = ()  # the elements around it that hold no earlier block


class Page(NamedTuple):
    """Blocks of text, and the elements around them, those of one path as one.

    An element is a place in ``steps`` (tag, #id, .class and [role]) and
    ``parents``; the parent comes first, and element 0 is the whole page.
    """

    parents: list[int]
    steps: list[str]
    blocks: list[Block]

    def path(self, element: int) -> str:
        """The steps from the root, as text."""
        steps = []
        while element:
            steps.append(self.steps[element])
            element = self.parents[element]
        return ">".join(reversed(steps))


def _step(tag: str, attrs: str) -> str:
    if not attrs.strip():
        return tag
    named = {k.lower(): html.unescape((v or "").strip("\"'")) for k, v in ATTRIBUTE.findall(attrs)}
    step = tag
    if named.get("id"):
        step += "#" + "-".join(re.sub(r"\d+", "0", CAMEL.sub("-", named["id"])).split())
    for name in sorted(set(named.get("class", "").split())):
        step += "." + re.sub(r"\d{2,}", "0", CAMEL.sub("-", name))
    if named.get("role"):
        step += "[" + named["role"].strip().lower() + "]"
    if "hidden" in named or named.get("aria-hidden") == "true":
        step += "[hidden]"
    return step.replace(">", "-").lower()


def names(step: str) -> set[str]:
    """The words of an element's id, classes and role."""
    return set(re.split(r"[^a-z]+", step[len(tag_of(step)) :])) - {""}


def tag_of(step: str) -> str:
    return re.split(r"[#.\[]", step, maxsplit=1)[0]


def parsed(page: str, apart: Callable[[set[str]], bool] = lambda names: False) -> Page:
    """The text blocks of a page in order.

    A block ends where a tag that is not inline begins or ends, also at <br>;
    an inline element is a block of its own if ``apart`` says so of its names.
    Its white space is collapsed and its character references are decoded.
    Comments, scripts, styles and other raw elements are no text.
    """
    reader = _Reader(apart)
    at = 0
    while token := TOKEN.search(page, at):
        reader.parts.append(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["close"]:
            reader.close(tag)
        elif tag in RAW:
            if not token["attrs"].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag in VOID:
            if tag not in INLINE:
                reader.flush()
        else:
            reader.open(tag, token["attrs"])
    reader.parts.append(page[at:])
    reader.flush()
    return reader.page


class _Open(NamedTuple):
    tag: str
    element: int  # that of the one around it if inline and without a name
    block: int  # place of the innermost open element that is not inline, up to this one; -1 if there is none


class _Reader:
    """Open elements while a page is read; each tag costs the same however deep it stands."""

    def __init__(self, apart: Callable[[set[str]], bool]):
        self.page, self.parts = Page([-1], [""], []), []
        self._apart = apart
        self._stack: list[_Open] = []
        self._places: dict[str, list[int]] = {}  # of the open elements by tag
        self._known: dict[tuple[int, str], int] = {}
        self._done = 0  # so many of the open elements hold a block

    def flush(self) -> None:
        text = BLANKS.sub(" ", html.unescape("".join(self.parts))).strip()
        self.parts.clear()
        if text:
            stack = self._stack
            begun = [x.element for k, x in enumerate(stack[self._done :], self._done) if x.element != (stack[k - 1].element if k else 0)]
            self.page.blocks.append(Block(stack[-1].element if stack else 0, text, tuple(begun)))
            self._done = len(stack)

    def open(self, tag: str, attrs: str) -> None:
        step, inline, around = _step(tag, attrs), tag in INLINE, self._stack[-1] if self._stack else _Open("", 0, -1)
        if inline and not self._apart(names(step)):
            self._push(tag, around.element, around.block)
            return
        self.flush()
        if not inline:
            if around.block >= 0 and tag in CLOSED_BY.get(self._stack[around.block].tag, ()):
                self._cut(around.block)
                around = self._stack[-1] if self._stack else _Open("", 0, -1)
        key = around.element, step
        if key not in self._known:
            self._known[key] = len(self.page.steps)
            self.page.parents.append(around.element)
            self.page.steps.append(step)
        self._push(tag, self._known[key], around.block if inline else len(self._stack))
        self._done = min(self._done, len(self._stack) - 1)

    def close(self, tag: str) -> None:
        places = self._places.get(tag)
        if not places:
            return
        k, inline = places[-1], tag in INLINE
        if inline and self._stack[-1].block > k:
            return  # an inline element does not end the block it stands around
        if not inline or self._stack[k].element != (self._stack[k - 1].element if k else 0):
            self.flush()
        self._cut(k)

    def _push(self, tag: str, element: int, block: int) -> None:
        self._places.setdefault(tag, []).append(len(self._stack))
        self._stack.append(_Open(tag, element, block))

    def _cut(self, k: int) -> None:
        for x in self._stack[k:]:
            self._places[x.tag].pop()
        del self._stack[k:]
        self._done = min(self._done, k)
