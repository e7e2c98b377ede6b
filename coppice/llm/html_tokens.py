"""Tokens of an HTML page: tags and text nodes with the path of the elements around them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_DIGITS = re.compile(r"\d+")
_NAME_PART = re.compile(r"[a-z]+|\d+")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset("nav footer aside form button select option dialog menu head".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice notices "
    "popup promo related share sharing sidebar social sponsor sponsored subscribe toolbar "
    "widget".split()
)
BOILERPLATE_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu navigation search".split()
)
CONTENT = frozenset(["article", "main"])


class Token(NamedTuple):
    """``kind`` is ``open``, ``close`` or ``text``; ``block`` numbers the blocks of the page."""

    kind: str
    path: str
    text: str
    block: int
    boilerplate: bool
    linked: bool


class _Element(NamedTuple):
    name: str
    label: str
    boilerplate: bool
    linked: bool


def _element(name: str, attributes: str, inside: list[_Element]) -> _Element:
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    # Ids that count pages or paragraphs would make every path a path of its own.
    shown = f"{found.get('class', '')} {_DIGITS.sub('#', found.get('id', ''))}".lower()
    label = ".".join([name, *sorted(set(shown.split()))])
    in_content = any(e.name in CONTENT for e in inside)
    boilerplate = (
        name in BOILERPLATE
        or (name == "header" and not in_content)
        or (name not in ("html", "body", *CONTENT) and named_boilerplate(names))
        or found.get("role", "").lower() in BOILERPLATE_ROLES
        or "hidden" in found
    )
    outer = inside[-1] if inside else None
    return _Element(
        name,
        label.replace("/", "|"),
        boilerplate or (outer.boilerplate if outer else False),
        name == "a" or (outer.linked if outer else False),
    )


def named_boilerplate(names: str) -> bool:
    return not BOILERPLATE_NAMES.isdisjoint(_NAME_PART.findall(names))


def squeezed(text: str) -> str:
    return _SPACE.sub(" ", text).strip(" ")


def tokens(html: str) -> Iterator[Token]:
    """All tags and text nodes in page order; scripts, styles and comments give none.

    Unclosed elements end with the element around them; a block ends an open paragraph. Text of one
    block may come in several nodes, white space as it stands, character references decoded.
    """
    stack: list[_Element] = []
    path, block, at = "", 0, 0
    paths = [""]

    def pop_to(index: int) -> None:
        del stack[index:], paths[index + 1 :]

    def text_token(raw: str) -> Token:
        top = stack[-1] if stack else None
        return Token(
            "text",
            paths[-1],
            unescape(raw),
            block,
            top.boilerplate if top else False,
            top.linked if top else False,
        )

    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            yield text_token(html[at:])
            return
        if m.start() > at:
            yield text_token(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            index = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if index is None:
                continue
            path = paths[index + 1]
            pop_to(index)
            block += name in BLOCKS
            yield Token("close", path, "", block, False, False)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in BLOCKS:
            block += 1
            if stack and any(e.name == "p" for e in stack):
                inner = max(i for i, e in enumerate(stack) if e.name == "p")
                if not any(e.name in BLOCKS for e in stack[inner + 1 :]):
                    pop_to(inner)
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack:
                _close_alike(stack, name, pop_to)
        element = _element(name, m[3], stack)
        path = f"{paths[-1]}/{element.label}"
        yield Token("open", path, "", block, element.boilerplate, element.linked)
        if name == "br":
            yield text_token(" ")
        if name not in VOID and not m[3].endswith("/"):
            stack.append(element)
            paths.append(path)


def _close_alike(stack: list[_Element], name: str, pop_to) -> None:
    """End an open element of the same name in the same list or row."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].name == name:
            pop_to(i)
            return
        if stack[i].name in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot"):
            return
