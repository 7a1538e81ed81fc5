"""Splitting text by the usual byte-level BPE pattern, with array operations.

The pattern takes runs of one kind (letters, numbers, spaces, others), so piece starts follow from
comparing neighbouring characters' kinds; what is left are two rules on spaces and the
contractions. About three times as fast as the regex, with equal pieces (tested against it).
"""

import functools
import re

import numpy as np
import regex

# Fixed value: the split pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

OTHER, SPACE, LETTER, NUMBER = range(4)
_CONTRACTION = re.compile("'(?:s|t|re|ve|m|ll|d)")


@functools.cache
def _kinds() -> np.ndarray:
    """Kind of every code point, as the regex classes have it."""
    points = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32)
    every = points.tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, group in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(group, every):
            kinds[points[m.start() : m.end()]] = kind
    return kinds


def split(text: str) -> list[str]:
    """``regex.findall(PATTERN, text)``"""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = _kinds()[codes]
    n = len(codes)
    starts = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:n])
    # A run of spaces gives its last one away: a blank joins the piece behind it, any other space
    # stands alone.
    spaces = kind == SPACE
    last = np.flatnonzero(spaces[:-1] & ~spaces[1:])
    starts[last] = True
    starts[last[codes[last] == 32] + 1] = False
    if "'" in text:
        for at in np.flatnonzero((codes == 39) & starts[:-1]).tolist():
            if m := _CONTRACTION.match(text, at):
                starts[at + 1] = False
                starts[m.end()] = True
    cuts = np.flatnonzero(starts).tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def splitter(pattern: str):
    """A function from text to pieces."""
    if pattern == PATTERN:
        return split
    return regex.compile(pattern).findall
