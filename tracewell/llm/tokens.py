"""Byte-level BPE ids of whole texts, with a memory for the pieces between single spaces.

The pattern that splits a text before the merges always starts a new piece at a single space between two characters
that are no white space.  So a text may be cut there, and each part encoded by itself with its space in front; parts
repeat, so most come from memory.  A text with any other run of white space round a space is encoded whole.
"""

from __future__ import annotations

import array
import sys
from collections.abc import Callable, Iterable


class Generations:
    """A bounded memory that forgets what has not been asked for lately: when the young half is full it becomes the
    old one, and what is asked for from there on moves back."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that are not remembered.  All others are in `young` until the next call."""
        if 2 * len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old, new = self.young, self.old, []
        for k in keys.difference(young):
            if k in old:
                young[k] = old[k]
            else:
                new.append(k)
        return new


class PartCache:
    """Values of the parts of texts; `encode` makes those of unseen parts, many at a time.

    `prepare` a slice of texts, then ask for each.  Parts over `longest` characters, and texts that cannot be cut, are
    remembered for the slice only.
    """

    def __init__(self, encode: Callable[[list[str]], list], most: int = 400_000, longest: int = 64):
        self.encode, self.longest = encode, longest
        self.firsts, self.rest = Generations(most // 8), Generations(most)
        self.passing: list[str] = []
        self.whole: dict[str, object] = {}

    @property
    def later(self) -> dict[str, object]:
        return self.rest.young

    def prepare(self, texts: list[str]) -> None:
        for part in self.passing:
            self.rest.young.pop(part, None)
            self.firsts.young.pop(part, None)
        heads, seen = set(), set()
        for text in texts:
            parts = text.split(" ")
            heads.add(parts[0])
            seen.update(parts[1:])
        first, later = self.firsts.missing(heads), self.rest.missing(seen)
        # Rough parts are never remembered, so they are among the new ones.
        rough, rough_heads = _rough(later), _rough(heads)
        uncut = [t for t in dict.fromkeys(texts) if self._uncut(t, rough, rough_heads)] if rough or rough_heads else []
        later = [x for x in later if x not in rough]
        values = iter(self.encode([*first, *(" " + part for part in later), *uncut]))
        self.firsts.young.update(zip(first, values))
        self.rest.young.update(zip(later, values))
        self.whole = dict(zip(uncut, values))
        self.passing = [part for part in (*first, *later) if len(part) > self.longest]

    @staticmethod
    def _uncut(text: str, rough: set[str], rough_heads: set[str]) -> bool:
        head, *rest = text.split(" ")
        return bool(rest) and (head in rough_heads or not rough.isdisjoint(rest))

    def of(self, text: str) -> list:
        """The values of the parts of a prepared text, in order."""
        if text in self.whole:
            return [self.whole[text]]
        head, *rest = text.split(" ")
        return [self.firsts.young[head], *map(self.rest.young.__getitem__, rest)]


def _rough(parts: Iterable[str]) -> set[str]:
    """The parts between spaces that are empty or begin or end with white space."""
    return {x for x in parts if not x or x[0].isspace() or x[-1].isspace()}


def id_bytes(ids: Iterable[int]) -> bytes:
    """Ids as unsigned 32-bit little-endian numbers."""
    packed = array.array("I", ids)
    if packed.itemsize != 4:
        raise TypeError("an unsigned int is not 4 bytes here")
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()
