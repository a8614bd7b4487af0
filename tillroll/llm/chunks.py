"""Texts cut at single spaces, and encodings of the parts remembered while a Python worker lives.

The public byte-level pattern never matches across a space that stands between
two characters that are no white space: a match may begin with that space, but
none ends in it or runs over it. A text may therefore be cut before each such
space and its parts encoded apart. Most parts are words that occur again, so a
part met before costs one look-up.
"""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Callable, Iterable, Iterator

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")

#: Parts remembered by a worker in each of two generations, some 400 bytes each at most, and the length of the longest.
MOST_REMEMBERED = 300_000
LONGEST_REMEMBERED = 40
#: Characters of texts that are encoded together.
SLICE_CHARS = 4_000_000


def cut(text: str) -> list[str]:
    """Parts of a text, cut at spaces that stand alone; each but the first has lost the space before it."""
    return _SINGLE_SPACE.split(text)


def uneven(part: str) -> bool:
    """Whether a text that was cut at every space shows here that some space doesn't stand alone."""
    return not part or part[0].isspace() or part[-1].isspace()


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts of about SLICE_CHARS characters together."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


class RememberedEncoder:
    """Encodes texts by their parts. encode gets distinct strings and gives the ids of each as bytes.

    What is met again moves to the newer of two generations; when that is full,
    the older one goes.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self._encode = encode
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _learn(self, parts: set[str]) -> None:
        if len(self._new) > MOST_REMEMBERED:
            self._old, self._new = self._new, {}
        missing = parts.difference(self._new)
        again = missing.intersection(self._old)
        self._new.update((part, self._old[part]) for part in again)
        unknown = list(missing.difference(again))
        self._new.update(zip(unknown, self._encode([" " + part for part in unknown]), strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; an empty text has none."""
        out: list[bytes] = []
        for part in slices(texts):
            cuts = [text.split(" ") for text in part]
            met = set()
            for pieces in cuts:
                met.update(pieces)
            bad = {x for x in met.difference(self._new) if uneven(x)}
            if bad:
                cuts = [cuts[i] if bad.isdisjoint(cuts[i]) else cut(text) for i, text in enumerate(part)]
                met = {x for pieces in cuts for x in pieces[1:]}
            long = [x for x in met if len(x) > LONGEST_REMEMBERED]
            self._learn(met.difference(long))
            firsts = list({pieces[0] for pieces in cuts})
            first = dict(zip(firsts, self._encode(firsts), strict=True))
            look = self._new.__getitem__
            if long:
                own = dict(zip(long, self._encode([" " + x for x in long]), strict=True))
                look = ChainMap(self._new, own).__getitem__
            out.extend(first[pieces[0]] + b"".join(map(look, pieces[1:])) for pieces in cuts)
        return out
