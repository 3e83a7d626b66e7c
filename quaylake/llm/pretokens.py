"""Splitting a text into pieces that a byte-level BPE encodes one by one.

The public pattern cuts a text into pre-tokens.  Applying it to every whole text is slow, so
texts whose white space is only single blanks and line feeds are first cut in front of each
blank and each line feed.  Such a cut is always an edge of the pattern too: every alternative
either holds no white space but a leading blank, or is white space alone, and a single white
space character followed by a visible one can only open a match.  The pieces repeat, so their
results are memoised; any other text goes through the pattern as a whole.
"""

from __future__ import annotations

import sys

import regex

_OTHER_SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n"]
_ASCII_SPACES = [c for c in _OTHER_SPACES if c.isascii()]
_IN_A_ROW = ("  ", "\n\n", " \n", "\n ")


def _irregular(text: str) -> bool:
    """Whether it has white space but blanks and line feeds, or two of these in a row."""
    spaces = _ASCII_SPACES if text.isascii() else _OTHER_SPACES
    return any(s in text for s in _IN_A_ROW) or any(s in text for s in spaces)


def cut(text: str) -> list[str] | None:
    """Pieces of a text with regular white space, else None.  The pieces joined are the text.

    A leading blank is left off: a piece not starting with a line feed has one, but for the
    first, which is marked by a leading tab (a text with tabs is irregular)."""
    if _irregular(text):
        return None
    pieces = text.replace("\n", " \n").split(" ")
    if pieces[0]:
        pieces[0] = "\t" + pieces[0]
    else:
        del pieces[0]
    return pieces


def uncut(piece: str) -> str:
    """The text that a piece of `cut` stands for."""
    if piece.startswith("\t"):
        return piece[1:]
    return piece if piece.startswith("\n") else " " + piece


def compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def byte_of_character() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the other
    bytes, in order, for the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
