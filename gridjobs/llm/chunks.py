"""Byte-pair encoding of whole texts by way of their space-separated chunks, each of which is encoded once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: A single space between two characters that aren't white space: no match of a byte-level pattern spans it.
SAFE = re.compile(r"(?<=\S) (?=\S)")


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The space before a word always opens a new match of the byte-level pattern, so a text's ids are those of its chunks,
    each with its space. encode_many gets the chunks that aren't known yet. Texts in which a space touches other white space are
    split at SAFE places only. About `most` chunks stay known; forgetting one costs time, never results.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], most: int = 600_000):
        self.encode_many, self.half, self.old, self.new = encode_many, most // 2, {}, {}

    def learn(self, chunks: set[str], heads: list[str]) -> list[bytes]:
        """Make the ids of the chunks, with their spaces, known; returns those of the heads."""
        if len(self.new) > self.half:
            self.old, self.new = self.new, {}
        missing = chunks - self.new.keys()
        again = missing & self.old.keys()
        self.new.update(zip(again, map(self.old.__getitem__, again), strict=True))
        missing = list(missing - again)
        ids = self.encode_many([*heads, *[" " + w for w in missing]])
        self.new.update(zip(missing, ids[len(heads) :], strict=True))
        return ids[: len(heads)]

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [text.split(" ") for text in texts]
        chunks = set().union(*split)
        odd = {w for w in chunks if not w or w[0] in ODD or w[-1] in ODD}
        for i, parts in enumerate(split):
            if len(parts) > 1 and not odd.isdisjoint(parts):
                split[i] = SAFE.split(texts[i])
        heads = self.learn(set().union(*(p[1:] for p in split)), [p[0] for p in split])
        get = self.new.__getitem__
        return [head + b"".join(map(get, p[1:])) for head, p in zip(heads, split, strict=True)]


#: White space but for the space itself.
ODD = frozenset(chr(c) for c in range(0x3001) if chr(c).isspace()) - {" "}


def slices(texts: list[str], chars: int = 1_500_000) -> Iterator[slice]:
    """Runs of texts of about so many characters each."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
