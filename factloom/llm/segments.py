"""Whole texts through a tokenizer by way of their distinct space-separated segments.

A single space between two non-blank characters is a boundary of every pre-tokenizer used here, so a text's
tokens are those of its segments one after another. Segments repeat a lot; each worker keeps what it has
computed, in a table of bounded size, and encodes in a batch only those it has not met.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: A single space between non-blank characters; Python's idea of blank covers that of the libraries.
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def distinct(texts: list[str]) -> tuple[set[str], set[str], set[int]]:
    """First segments, later segments (to be read with a space before them), and which texts have spaces that
    are no safe boundary; cut(text, True) splits those."""

    def gather(odd: set[int]) -> tuple[set[str], set[str]]:
        heads, tails = set(), set()
        for i, text in enumerate(texts):
            parts = cut(text, i in odd)
            heads.add(parts[0])
            tails.update(parts[1:])
        return heads, tails

    heads, tails = gather(set())
    blank = {x for x in heads | tails if not x or x[0].isspace() or x[-1].isspace()}
    odd = {i for i, t in enumerate(texts) if not blank.isdisjoint(t.split(" "))} if blank else set()
    return *(gather(odd) if odd else (heads, tails)), odd


def cut(text: str, odd: bool) -> list[str]:
    return SAFE_SPACE.split(text) if odd else text.split(" ")


class SegmentTable:
    """Values of segments, made in batches and kept for later texts; at most `most` are kept at once."""

    def __init__(self, encode: Callable[[list[str]], list], most: int = 400_000):
        self.encode, self.most, self.known = encode, most, {}

    def learn(self, segments: set[str]) -> None:
        """Make the values of all given segments present; older ones go when the table would grow too large."""
        new = [x for x in segments if x not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known = {x: self.known[x] for x in segments if x in self.known}
        self.known.update(zip(new, self.encode(new), strict=True))
