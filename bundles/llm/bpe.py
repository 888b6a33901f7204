"""Byte-level BPE by longest matches with backtracking (operator 1).

The token bytes are mapped to Latin-1 characters and held, reversed, in an
Aho-Corasick automaton; one pass over the reversed input gives the longest
token that starts at every byte.  Encoding walks left to right, takes the
longest token that ends at a byte not known to be a dead end and that is
*compatible* with the token before it, shortens it to its longest proper
prefix token if not, and steps back if no prefix is left.  Two tokens are
compatible if merging their joined bytes gives exactly these two again; the
answer is memoised.  A sequence whose neighbours are all compatible is the
sequence that the merges give, and each byte becomes a dead end at most once,
so the time is linear in the input.
"""

from __future__ import annotations

import base64
from itertools import chain
import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns, kept
from .tokens import ID, PartEncoder, id_lists

#: Pairs and words kept per worker; bounds memory only.
MAX_PARTS, MAX_PAIRS, MAX_WORDS = 450_000, 300_000, 200_000


class BacktrackingBpe:
    """Encoder over a rank file (``base64-token rank`` lines) for one piece of bytes at a time."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.token = {i: t for t, i in self.rank.items()}
        self.bytes = pa.array([self.token.get(i) for i in range(max(self.token) + 1)], pa.binary())
        self.size = [len(self.token.get(i, b"")) for i in range(max(self.token) + 1)]
        # the longest token that is a proper prefix of a token; -1 if there is none
        self.shorter = [next((self.rank[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.rank), -1)
                        for b in (self.token.get(i, b"") for i in range(len(self.size)))]
        self.starts = ahocorasick.Automaton()
        for t, i in self.rank.items():
            self.starts.add_word(t[::-1].decode("latin-1"), len(t) << 32 | i)  # compares by length
        self.starts.make_automaton()
        self.fits: dict[int, bool] = {}  # by first id * 2**32 + second id

    def merged(self, piece: bytes) -> list[int]:
        """The definition: merge the adjacent pair of lowest rank until none is a token."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            at, best = -1, None
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    at, best = i, r
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        got = self.fits.get(a << 32 | b)
        if got is None:
            if len(self.fits) >= MAX_PAIRS:
                self.fits.clear()
            got = self.fits[a << 32 | b] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return got

    def encode(self, piece: bytes) -> list[int]:
        return self.encode_all([piece])[0]

    def encode_all(self, pieces: list[bytes]) -> list[list[int]]:
        """The automaton runs once over all pieces, reversed and parted by a character that no token holds."""
        text = "\u0100".join([p[::-1].decode("latin-1") for p in reversed(pieces)])
        found = np.fromiter(chain.from_iterable(self.starts.iter(text)), np.int64).reshape(-1, 2)
        longest = [-1] * (len(text) + 1)
        if len(found):
            end, match = found.T
            first = np.flatnonzero(np.diff(end, prepend=-1))  # a place's matches come together
            best = np.full(len(text) + 1, -1, np.int64)
            best[end[first]] = np.maximum.reduceat(match, first) & 0xFFFFFFFF
            longest = best[-2::-1].tolist()  # by place in the pieces themselves
        out, base = [], 0
        for p in pieces:
            out.append(self._walk(len(p), base, longest))
            base += len(p) + 1
        return out

    def _walk(self, n: int, base: int, longest: list[int]) -> list[int]:
        """Ids of the piece of ``n`` bytes whose longest tokens stand from ``base`` on."""
        out: list[int] = []
        dead: set[int] = set()
        size, shorter, fits, compatible = self.size, self.shorter, self.fits, self.compatible
        at, last, t = 0, -1, longest[base] if n else -1  # last << 32 | t is below 0 for a first token
        while at < n:
            if at + size[t] not in dead:
                fit = last < 0 or fits.get(last << 32 | t)
                if fit is None:
                    fit = compatible(last, t)
                if fit:
                    out.append(t)
                    at += size[t]
                    last = t
                    if at < n:
                        t = longest[base + at]
                    continue
            t = shorter[t]
            while t < 0:
                dead.add(at)
                t = out.pop()  # exists: the merges give one valid sequence
                at -= size[t]
                t = shorter[t]
                last = out[-1] if out else -1
        return out


def _coder(path: str, pattern: str) -> tuple[BacktrackingBpe, PartEncoder]:
    return kept("bpe", (path, pattern), lambda: _new_coder(path, pattern))


def _new_coder(path: str, pattern: str) -> tuple[BacktrackingBpe, PartEncoder]:
    bpe, split = BacktrackingBpe(path), regex.compile(pattern)
    words: dict[str, bytes] = {}

    def ids(pieces: list[str]) -> list[bytes]:
        new = list(set(pieces).difference(words))
        if len(words) + len(new) > MAX_WORDS:
            words.clear()
            new = list(set(pieces))
        made = bpe.encode_all([w.encode() for w in new])
        data = np.fromiter(chain.from_iterable(made), ID).tobytes()
        ends = (np.cumsum([len(x) for x in made]) * ID.itemsize).tolist()
        words.update(zip(new, [data[a:b] for a, b in zip([0] + ends, ends)]))
        return list(map(words.__getitem__, pieces))

    def together(parts: list[str]) -> list[bytes]:
        pieces = split.findall("".join(parts))
        found = ids(pieces)
        first = [i for i, p in enumerate(pieces) if p[0] == " "]  # a part begins with its only space
        return [found[a] if b - a == 1 else b"".join(found[a:b]) for a, b in zip(first, first[1:] + [len(found)])]

    def apart(texts: list[str]) -> list[bytes]:
        own = [split.findall(t) for t in texts]
        found = ids([p for pieces in own for p in pieces])
        ends = np.cumsum([len(pieces) for pieces in own]).tolist()
        return [b"".join(found[a:b]) for a, b in zip([0] + ends, ends)]

    return bpe, PartEncoder(together, apart, MAX_PARTS)


def encode_bpe(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", names: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``names``) plus ``ids`` array<int>: each match of ``pattern`` in the whole text encoded separately.

    Null and empty texts give an empty array; no special tokens are known, so
    their strings are ordinary text.  Row-wise without a shuffle: repeated
    rows get equal ids, an empty table gives an empty table, all other columns
    pass through (one already named ``ids`` is replaced).  Memory is bounded by
    the batch and by the per-worker tables.
    """
    def run(texts: pa.Array) -> list[pa.Array]:
        return [id_lists(_coder(path, pattern)[1].encode([t or "" for t in texts.to_pylist()]))]

    return append_columns(df, [text], [T.StructField(ids, T.ArrayType(T.IntegerType(), False))], run, names)


def decode_bpe(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded", names: list[str] | None = None) -> DataFrame:
    """``df`` plus ``out`` binary: the bytes of the ids, joined.  A null list gives empty bytes."""
    def run(lists: pa.Array) -> list[pa.Array]:
        bpe, ends = _coder(path, pattern)[0], lists.offsets.to_numpy()
        tokens = bpe.bytes.take(lists.values[int(ends[0]):int(ends[-1])])
        starts = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset:][ends - ends[0]]  # a list's bytes are consecutive
        return [pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(starts.tobytes()), tokens.buffers()[2]])]

    return append_columns(df, [ids], [T.StructField(out, T.BinaryType())], run, names)
