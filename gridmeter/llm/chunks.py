"""Cutting text where a byte-level tokenizer's pattern always cuts.

The pattern's pieces are either white space or (an optional space and) other
characters, so a piece never has white space after something else.  Between a
character that is not white space and one that is, there is always a border,
and what stands on either side is encoded alike with or without the other
side.  So texts may be cut there, and equal chunks encoded once.
"""

from __future__ import annotations

import regex

_RUN = regex.compile(r"\s*\S+|\s+")
_BLANKS = [chr(c) + " " for c in (10, 9, 13, 32, 11, 12, 28, 29, 30, 31)]
_WIDE = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def chunks(text: str) -> list[str]:
    """Chunks whose concatenation is `text` and which may be encoded one by one."""
    for blanks in _BLANKS:
        if blanks in text:
            return _RUN.findall(text)
    if not text.isascii() and any(c in text for c in _WIDE):
        return _RUN.findall(text)
    # Every space stands alone between other characters: cutting before each is the same cut.
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + r for r in rest]


def keys(text: str) -> list[str]:
    """`chunks` by names that need no copying for most: a chunk of one space and what follows
    goes by what follows, any other by a space and itself (`chunk` undoes it)."""
    for blanks in _BLANKS:
        if blanks in text:
            return list(map(_key, _RUN.findall(text)))
    if not text.isascii() and any(c in text for c in _WIDE):
        return list(map(_key, _RUN.findall(text)))
    parts = text.split(" ")
    if parts[0]:
        parts[0] = " " + parts[0]
    else:
        del parts[0]
    return parts


def _key(chunk: str) -> str:
    return chunk[1:] if chunk[0] == " " and chunk[1:2] != " " else " " + chunk


def chunk(key: str) -> str:
    return key[1:] if key[:1] == " " else " " + key
