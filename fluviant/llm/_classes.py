"""Pre-token patterns with the character classes of the merge library.

Engines know different versions of Unicode, so ``\\p{L}`` does not mean the same
characters everywhere. The library's own classes are asked of the library: with
single bytes as its only tokens and a class as its pattern, what it encodes of all
code points is the class.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple


class Split(NamedTuple):
    """A pattern as given; the same with classes spelled out; the characters over which the two part ways."""

    plain: str
    exact: str
    differ: str


def _ranges(points: list[int]) -> str:
    """Sorted code points as the inside of a character class."""
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


@lru_cache(maxsize=8)
def library_split(pattern: str) -> Split:
    """``pattern`` for the ``regex`` module, so that it splits as the library does.

    Classes that occur inside brackets and outside are both replaced. Where the two
    engines agree on all classes, nothing differs and ``differ`` is empty."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    spelled, differ = {}, set()
    for name in set(re.findall(r"\\p\{\w+\}|\\s", pattern)):
        library = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        held = library.decode_bytes(library.encode_ordinary(every)).decode()
        spelled[name] = _ranges(sorted(map(ord, held)))
        differ |= set(held) ^ set(regex.findall(name, every))

    def spell(part: re.Match) -> str:
        if part[0] in spelled:
            return f"[{spelled[part[0]]}]"
        return re.sub(r"\\p\{\w+\}|\\s", lambda m: spelled[m[0]], part[0]) if part[0][0] == "[" else part[0]

    exact = re.sub(r"\[\^?(?:\\.|[^\]\\])*\]|\\p\{\w+\}|\\S|\\.|[^\[\\]", spell, pattern)
    if r"\S" in exact and r"\s" in pattern:
        exact = exact.replace(r"\S", f"[^{spelled[chr(92) + 's']}]")
    return Split(pattern, exact, _ranges(sorted(map(ord, differ))))


def splitter(split: Split) -> Callable[[str], list[str]]:
    """Pre-tokens of a text. Only texts that hold a character on which the engines
    disagree are split by the longer pattern."""
    import regex

    plain = regex.compile(split.plain).findall
    if not split.differ:
        return plain
    exact = regex.compile(split.exact).findall
    odd = re.compile(f"[{split.differ}]").search

    def pre_tokens(text: str) -> list[str]:
        return plain(text) if text.isascii() or not odd(text) else exact(text)

    return pre_tokens
