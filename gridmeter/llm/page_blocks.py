"""Leaf blocks of an HTML page: runs of text between the borders of block elements.

The reader keeps to the rules of HTML that decide where text belongs: comments,
elements whose content is no text of the page, void elements, omitted end tags, end
tags without a start.  It never fails, and its time grows with the page's length.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Names of HTML elements.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section select summary table tbody td tfoot th thead tr ul""".split())
NO_TEXT = frozenset("head script style title textarea noscript iframe noembed noframes xmp template svg math object audio video canvas".split())
#: Elements that say what they hold.
MEANING = frozenset("article aside dialog figure footer form header main menu nav search select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that a start tag ends, and where the look for them stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_OTHER = re.compile(r"<[!?/][^>]*>")
_VALUE = re.compile(r"=\s*([\"'])")
_NAMING = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in NO_TEXT}


class Block(NamedTuple):
    text: str             # decoded, white space runs as one space, trimmed
    tag: str              # the innermost block element
    around: frozenset     # names of what lies around it: elements, and words of their class, id and role;
    #                       those of the innermost element that says what it holds once more, as `near`
    linked: int           # characters inside links
    marked: int           # characters inside bold, italic and the like


def _naming(attributes: str) -> set[str]:
    out = set()
    for m in _NAMING.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "style":
            if "display:none" in value.replace(" ", "").lower():
                out.add("hidden")
        elif kind == "hidden" or kind == "aria-hidden":
            if kind == "hidden" or value.lower() == "true":
                out.add("hidden")
        else:
            out.update("named " + w.lower() for w in _PARTS.findall(value))
    return out


def _quoted(page: str, start: int, end: int) -> int:
    """The end of a tag whose attributes begin at `start`, if the `>` at `end` may lie in a quoted value."""
    at = start
    while m := _VALUE.search(page, at, end):
        close = page.find(m[1], m.end())
        if close < 0:
            return end
        at = close + 1
        if close > end:
            end = page.find(">", close)
            if end < 0:
                return close
    return end


def read(page: str, known: dict | None = None) -> tuple[list[Block], str]:
    """The blocks of a page that have text, and the text of its title.

    `known` (a dict by name) limits the names of `Block.around` to those that a model
    knows, so that deeply nested pages do not carry long sets of names.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset, frozenset]] = []  # name, names around, these and those near
    open_: dict[str, int] = {}
    nothing: frozenset = frozenset()
    pieces: list[str] = []
    title, links, marks, linked, marked = "", 0, 0, 0, 0

    def close() -> None:
        nonlocal linked, marked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                tag, _, around = stack[-1] if stack else ("", nothing, nothing)
                blocks.append(Block(text, tag, around, linked, marked))
            pieces.clear()
        linked = marked = 0

    def pop(until: int) -> None:
        while len(stack) > until:
            open_[stack.pop()[0]] -= 1

    def put(text: str) -> None:
        nonlocal linked, marked
        pieces.append(text)
        if links:
            linked += len(text)
        if marks:
            marked += len(text)

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            put(page[at:])
            break
        if lt > at:
            put(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        m = _TAG.match(page, lt)
        if not m:
            other = _OTHER.match(page, lt)
            if other:
                at = other.end()
            elif page.find(">", lt) < 0 and re.match(r"</?[A-Za-z]", page[lt:lt + 3]):
                at = size  # the page ends inside a tag
            else:
                put("<")
                at = lt + 1
            continue
        ending, name, attributes = m[1], m[2].lower(), m[3]
        at = m.end()
        if "=" in attributes and ('"' in attributes or "'" in attributes):
            end = _quoted(page, m.start(3), at - 1)
            if end != at - 1:
                attributes, at = page[m.start(3):end], end + 1
        if name == "br" or name == "wbr":
            put(" " if name == "br" else "")
        elif ending:
            if name in BLOCKS:
                close()
                if open_.get(name):
                    k = len(stack) - 1
                    while stack[k][0] != name:
                        k -= 1
                    pop(k)
                if name in ("p", "div", "td"):
                    links = marks = 0
            elif name == "a":
                links = 0
            elif name in ("b", "strong", "i", "em", "u"):
                marks = max(0, marks - 1)
        elif name in NO_TEXT and name != "head":
            if not attributes.endswith("/"):
                m = _END[name].search(page, at)
                if name == "title" and not title:
                    title = " ".join(unescape(page[at:m.start() if m else size]).split())
                at = m.end() if m else size
            put(" ")
        elif name in BLOCKS:
            close()
            links = marks = 0
            if open_.get("p") and name not in ("button", "option", "select"):
                k = len(stack) - 1
                while stack[k][0] != "p":
                    k -= 1
                # A cell or a button inside the paragraph keeps it open.
                if not any(s[0] in ("td", "th", "button", "caption") for s in stack[k + 1:]):
                    pop(k)
            if name in ENDS:
                done, stop = ENDS[name]
                k = len(stack) - 1
                last = None
                while k >= 0 and stack[k][0] not in stop:
                    if stack[k][0] in done:
                        last = k
                    k -= 1
                if last is not None:
                    pop(last)
            if name not in VOID and not (name == "body" and open_.get("body")):
                above, both = stack[-1][1:] if stack else (nothing, nothing)
                own = _naming(attributes) if attributes else set()
                near = {w.replace("named", "near") for w in own}
                own.add("in " + name)
                if name in MEANING:
                    near.add("near " + name)
                if known is not None:
                    own, near = own.intersection(known), near.intersection(known)
                around = above if own <= above else above | own
                # An element that says nothing leaves what is near as it is.
                both = around | (near or both - above) if near or around is not above else both
                stack.append((name, around, both))
                open_[name] = open_.get(name, 0) + 1
        elif name == "a":
            links = 1
        elif name in ("b", "strong", "i", "em", "u"):
            marks += 1
    close()
    return blocks, title
