"""Whole texts to token ids, with the ids of recurring words kept per Python worker.

The pre-tokeniser's pattern never lets a match run across a single space that
stands between two non-space characters, and the match after such a space
starts with it.  So a text cut at those spaces gives the same ids cut by cut,
and a cut's ids can be looked up.  A text with any other space (runs, space
beside a line break, at either end) is encoded whole by the backend.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Ids of one part are kept as little-endian uint32 bytes.
ID = np.dtype("<u4")
#: Parts kept per worker; the table is renewed when full.  Bounds memory only, never the result.
MAX_PARTS = 500_000
#: First words kept per worker.
MAX_HEADS = 100_000
#: Longer parts are encoded but not kept.
MAX_KEPT = 64


class PartEncoder:
    """``encode(texts) -> bytes of ids`` of each text.

    ``together(parts)`` gives the id bytes of strings that each start at a safe
    space, so that it may join them; ``apart(texts)`` those of any strings.
    All parts of a batch that are not known yet are encoded in one call.  When
    the table is full it becomes the old one, from which parts still in use
    are taken over.
    """

    def __init__(self, together, apart, max_parts: int = MAX_PARTS):
        self.together, self.apart, self.max_parts = together, apart, max_parts
        self.rest: dict[str, bytes | None] = {}  # parts after a space, without it; None: encode the text whole
        self.old: dict[str, bytes | None] = {}
        self.heads: dict[str, bytes] = {}  # what stands before the first space

    def _fill(self, parts: set[str]) -> list[str]:
        """Make all ``parts`` known; returns those that are too long to be kept."""
        new = parts.difference(self.rest)  # looks each part up; a difference of views would walk the whole table
        if len(self.rest) + len(new) > self.max_parts:
            self.old, self.rest = self.rest, {}
            new = parts
        if self.old:
            self.rest.update([(p, self.old[p]) for p in new if p in self.old])
            new = new.difference(self.rest)
        cut = [p for p in new if p and len(p.strip()) == len(p)]
        self.rest.update(zip(cut, self.together([" " + p for p in cut])))
        if len(cut) < len(new):
            self.rest.update(dict.fromkeys(new.difference(cut)))
        return [p for p in new if len(p) > MAX_KEPT]

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        split = [t.split(" ") if t else () for t in texts]
        parts: set[str] = set()
        for own in split:
            parts.update(own[1:])
        long = self._fill(parts)
        heads = {own[0] for own in split if len(own) > 1}.difference(self.heads)
        if len(self.heads) + len(heads) > MAX_HEADS:
            self.heads.clear()
            heads = {own[0] for own in split if len(own) > 1}
        heads = [h for h in heads if h and not h[-1].isspace()]
        self.heads.update(zip(heads, self.apart(heads)))
        left = []
        for i, own in enumerate(split):
            if len(own) > 1 and own[0] in self.heads:
                try:
                    out[i] = self.heads[own[0]] + b"".join(map(self.rest.__getitem__, own[1:]))
                    continue
                except TypeError:
                    pass
            if own:
                left.append(i)
        for i, ids in zip(left, self.apart([texts[i] for i in left])):
            out[i] = ids
        for p in long:
            del self.rest[p]
        for p in [p for p in heads if len(p) > MAX_KEPT]:
            del self.heads[p]
        return out


def id_lists(encoded: list[bytes]) -> pa.Array:
    """One list<int32> per text from the bytes of its ids."""
    ends = np.cumsum([0] + [len(e) // 4 for e in encoded], dtype=np.int64)
    values = np.frombuffer(b"".join(encoded), dtype=ID).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))
