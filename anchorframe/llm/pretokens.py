"""The byte-level pre-token split that the tokenizer operators share, and what they keep in a Python worker."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import accumulate

import regex

#: The byte-level pre-token pattern (fixed value of the public vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same matches, with the commonest alternatives first: words and numbers never start with an apostrophe.
_ANY = r""" ?\p{L}+| ?\p{N}+|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ASCII = r""" ?[A-Za-z]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
#: How many characters after its end a match can depend on, one more than the pattern reads.
AHEAD = 3
BLOCK_CHARS = 1 << 20


def once(shared: dict, make: Callable[[dict], object]) -> object:
    """make(shared), made once in a Python worker: a broadcast value outlives the tasks of a worker, sent modules do not."""
    if "made" not in shared:
        shared["made"] = make(shared)
    return shared["made"]


def unknown_letters() -> list[str]:
    """Letters and numbers of the regex library that Python's own, older Unicode table does not know."""
    known = regex.compile(r"[\p{L}\p{N}]")
    return [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and known.match(c)]


def as_class(characters: list[str]) -> str:
    """A character class of sorted characters, as ranges: every worker compiles it, and tests texts against it."""
    first = [c for i, c in enumerate(characters) if not i or ord(characters[i - 1]) != ord(c) - 1]
    last = [c for i, c in enumerate(characters) if i + 1 == len(characters) or ord(characters[i + 1]) != ord(c) + 1]
    return "[" + "".join(f"{a}-{b}" for a, b in zip(first, last)) + "]" if characters else ""


def word_splitter(newer: str = "") -> Callable[[str], list[str]]:
    """A function from a text to its matches of PATTERN.  newer: a class of characters that count as neither letter, number nor space."""
    ascii_words, any_words = re.compile(_ASCII, re.ASCII).findall, regex.compile(_ANY).findall
    is_newer, first = regex.compile(newer or r"(?!)"), newer[1:2]

    def words(text: str) -> list[str]:
        if text.isascii():
            return ascii_words(text)
        # the class lies beyond what most texts hold, and their largest character is found faster
        if not newer or max(text) < first or not is_newer.search(text):
            return any_words(text)
        ends = list(accumulate(map(len, any_words(is_newer.sub("", text)))))
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    return words


def word_blocks(split: Callable[[str], list[str]], text: str, block: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """The words of a text in lists, so that a very long text never has all of them in memory.

    A block's last matches, which could read on, are split again with the next block; a block that is one match grows.
    """
    at, size = 0, block
    while len(text) - at > size:
        part = text[at : at + size]
        words = split(part)
        end, keep = len(part), len(words)
        while keep and end > len(part) - AHEAD:
            keep -= 1
            end -= len(words[keep])
        if keep:
            yield words[:keep]
            at, size = at + end, block
        else:
            size *= 2
    if at < len(text):
        yield split(text[at:] if at else text)
