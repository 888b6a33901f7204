"""Token counts by a compiled finite-state tokenizer (operator 13).

The tokenizer file (lower-casing, white space dropped, byte-level BPE with word
ends) is compiled into two machines.  A symbol classifier turns a text into
bytes, the last byte of every word marked.  A deterministic transducer reads
these and annotates every transition with the tokens it adds: after each byte,
the count of the word so far.

A state of the transducer holds what later bytes can depend on: for every place
in the word at which a token that is not finished yet may have started, its
node in the trie of tokens, the token that ends at that place, and the count
there.  Of the tokens that end at the next byte exactly one is *compatible*
with the token before it (merging the bytes of both gives the two again), and
that one ends the merges' own result for the longer prefix, so the machine is
deterministic and exact.  States are made when first met, and transitions are
kept in one open-addressed table per worker.

A batch of texts is one string of symbols, cut into chunks of equal length that
are read side by side, one array lookup per symbol column.  Reading a chunk from
the start state gives its state map: a chunk with a word end maps every start
state to the same end state, so only the symbols before its first word end
depend on what comes before.  A prefix scan composes the maps: every chunk's
true start state is the end state of the composition so far; heads that were
read from another state are read again until they meet the earlier path, and a
chunk without a word end passes its new end state on, until nothing changes.
Prefix sums of the annotations at the document borders are the counts.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept

#: Characters read together; longer texts are cut at white space.  Bounds memory only.
BATCH_CHARS = 1_000_000
#: Symbols in a chunk.
CHUNK = 192
#: Transitions kept per worker; all are dropped when there are more.  Bounds memory only.
MAX_TRANSITIONS = 4_000_000
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 255


class Merges:
    """The merges of the file over symbols: a byte, or 256 + a byte at a word's end."""

    def __init__(self, model: dict):
        byte = {c: b for b, c in byte_characters().items()}
        suffix = model["end_of_word_suffix"]

        def symbols(token: str) -> tuple[int, ...]:
            ends = token.endswith(suffix) and len(token) > len(suffix)
            found = [byte[c] for c in (token[:-len(suffix)] if ends else token)]
            return (*found[:-1], found[-1] + 256) if ends else tuple(found)

        self.token = {i: symbols(t) for t, i in model["vocab"].items()}
        self.single = {s[0]: i for i, s in self.token.items() if len(s) == 1}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank[model["vocab"][a], model["vocab"][b]] = rank, model["vocab"][a + b]

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """The definition: merge the leftmost adjacent pair of lowest rank until there is none."""
        parts, rank = [self.single[s] for s in symbols], self.rank
        while len(parts) > 1:
            best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
            if best is None:
                break
            (_, made), i = best
            parts[i:i + 2] = [made]
        return parts


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Transducer:
    """States made on demand; ``read`` steps many chunks at once."""

    START = 0

    def __init__(self, merges: Merges, max_transitions: int = MAX_TRANSITIONS):
        self.merges, self.max_transitions = merges, max_transitions
        self.child: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]  # the token that a node stands for
        for token, symbols in merges.token.items():
            node = 0
            for s in symbols:
                if s not in self.child[node]:
                    self.child[node][s] = len(self.child)
                    self.child.append({})
                    self.ends.append(-1)
                node = self.child[node][s]
            self.ends[node] = token
        self.fit: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        start = ((0, -1, 0),)
        self.state, self.number = [start], {start: 0}
        self.fit.clear()
        self._resize(1 << 16)
        self.used = 0

    def _resize(self, size: int) -> None:
        self.keys, self.to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        self.adds, self.shift = np.zeros(size, np.int16), np.uint64(64 - size.bit_length() + 1)

    def fits(self, before: int, token: int) -> bool:
        got = self.fit.get((before, token))
        if got is None:
            symbols = self.merges.token[token]
            if before < 0:
                got = self.merges.merged(symbols) == [token]
            else:
                got = self.merges.merged(self.merges.token[before] + symbols) == [before, token]
            self.fit[before, token] = got
        return got

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """Next state and tokens added; a word's last symbol leads back to the start."""
        live, last, adds = [], -1, 0
        for node, before, count in self.state[state]:  # places from left to right
            node = self.child[node].get(symbol)
            if node is None:
                continue
            if last < 0 and self.ends[node] >= 0 and self.fits(before, self.ends[node]):
                last, adds = self.ends[node], count + 1
            if self.child[node]:
                live.append((node, before, count))
        if symbol >= 256:
            return self.START, adds
        key = (*((node, before, count - adds) for node, before, count in live), (0, last, 0))
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.state)
            self.state.append(key)
        return number, adds

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _learn(self, keys: np.ndarray) -> None:
        made = [self.step(k >> 9, k & 511) for k in keys.tolist()]
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            held = self.keys[old], self.to[old], self.adds[old]
            size = len(self.keys)
            while size < 4 * (self.used + len(keys)):
                size *= 2
            self._resize(size)
            self._put(*held)
        self._put(keys, np.array([m[0] for m in made], np.int32), np.array([m[1] for m in made], np.int16))
        self.used += len(keys)

    def _put(self, keys: np.ndarray, to: np.ndarray, adds: np.ndarray) -> None:
        at, mask = self._slots(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several at one place the last stays
            done = self.keys[at] == keys
            self.to[at[done]], self.adds[at[done]] = to[done], adds[done]
            keys, to, adds, at = keys[~done], to[~done], adds[~done], (at[~done] + 1) & mask

    def look_up(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and added tokens of many (state, symbol) pairs."""
        keys = (state.astype(np.int64) << 9) | symbol
        while True:
            at, mask = self._slots(keys), len(self.keys) - 1
            there = self.keys[at]
            off = np.flatnonzero(there != keys)
            missing = []
            while len(off):
                absent = there[off] < 0
                missing.append(off[absent])
                off = off[~absent]
                at[off] = (at[off] + 1) & mask
                there[off] = self.keys[at[off]]
                off = off[there[off] != keys[off]]
            missing = np.concatenate(missing) if missing else off
            if not len(missing):
                return self.to[at], self.adds[at]
            self._learn(np.unique(keys[missing]))

    def counts(self, symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Tokens added by each symbol of a string that begins at a word's start."""
        if self.used > self.max_transitions:
            self.clear()
        n = len(symbols)
        if not n:
            return np.zeros(0, np.int16)
        rows = -(-n // chunk)
        # the last chunk is filled up with words of one byte
        grid = np.full(rows * chunk, 256 + 97, np.int16)
        grid[:n] = symbols
        grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
        adds, path = np.empty((chunk, rows), np.int16), np.empty((chunk, rows), np.int32)
        state = np.zeros(rows, np.int32)
        for j in range(chunk):  # every chunk's map, read from the start state
            state, adds[j] = self.look_up(state, grid[j])
            path[j] = state
        begin = np.zeros(rows, np.int32)
        while True:  # composition: heads read from another state than the one that reaches them
            reach = np.concatenate([[0], path[-1, :-1]]).astype(np.int32)
            again = np.flatnonzero(reach != begin)
            if not len(again):
                break
            begin, state = reach, reach[again]
            for j in range(chunk):
                state, adds[j, again] = self.look_up(state, grid[j, again])
                apart = state != path[j, again]
                again, state = again[apart], state[apart]
                if not len(again):
                    break
                path[j, again] = state
        return adds.T.reshape(-1)[:n]


class Symbols:
    """Normaliser and pre-tokeniser of the file, as tables over code points filled by asking the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.kind = np.full(0x110000, UNKNOWN, np.uint8)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def segments(self, text: str) -> tuple[list[str], int]:
        """The text's normalised stretches between added tokens, and the number of these tokens."""
        parts = self.specials.split(text) if any(t in text for t in self.special) else [text]
        return [self.normalised(p) for p in parts], len(parts) - 1

    def normalised(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # lower() differs from a character's own lower case for a final capital sigma only
        if unicodedata.is_normalized("NFC", text) and not any(unicodedata.category(c) == "Cn" for c in set(text)):
            return text.replace("Σ", "σ").lower()
        return self.library.normalizer.normalize_str(text)

    def _kind(self, c: str) -> int:
        split = self.library.pre_tokenizer.pre_tokenize_str
        if self.library.normalizer.normalize_str(c) == " " or not split(c):
            return SPACE
        if len(split(c + c)) == 2:
            return NUMBER
        return LETTER if len(split("a" + c)) == 1 else OTHER

    def kinds(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kind[points]
        unknown = kinds == UNKNOWN
        if unknown.any():
            for p in np.unique(points[unknown]).tolist():
                self.kind[p] = self._kind(chr(p))
            kinds = self.kind[points]
        return kinds

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of a normalised text, and for each of its bytes the number of symbols before it (one more at the end)."""
        data = np.frombuffer(text.encode(), np.uint8)
        if text.isascii():
            points, last = data, None
        else:
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            first = np.flatnonzero((data & 0xC0) != 0x80)
            last = np.append(first[1:], len(data)) - 1
        kinds = self.kinds(points)
        joined = np.zeros(len(points) + 3, bool)  # with the next character in one word
        joined[:len(points) - 1] = (kinds[:-1] == kinds[1:]) & ((kinds[:-1] == LETTER) | (kinds[:-1] == OTHER))
        # fixed values: the contractions 's 't 're 've 'm 'll 'd are words if the apostrophe begins a run of signs
        at = np.flatnonzero(points == ord("'"))
        at = at[(at == 0) | (kinds[at - 1] != OTHER)]
        one, two = np.append(points, [0, 0]).astype(np.uint32)[at + 1], np.append(points, [0, 0, 0]).astype(np.uint32)[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        joined[at[short]], joined[at[short] + 1] = True, False
        joined[at[long]], joined[at[long] + 2] = True, False
        ends = ~joined[:len(points)] & (kinds != SPACE)
        symbols = data.astype(np.int16)
        if last is None:
            symbols += ends.astype(np.int16) << 8
            kept = kinds != SPACE
        else:
            symbols[last] += ends.astype(np.int16) << 8
            kept = np.repeat(kinds != SPACE, np.diff(last, prepend=-1))
        return symbols[kept], np.append([0], np.cumsum(kept))


class Counter:
    """Token counts of texts by the compiled tokenizer of one file."""

    def __init__(self, path: str):
        self.symbols = Symbols(path)
        with open(path) as file:
            self.machine = Transducer(Merges(json.load(file)["model"]))

    def count(self, texts: list[str], batch_chars: int = BATCH_CHARS) -> list[int]:
        totals, owners, parts, held = [0] * len(texts), [], [], 0

        def flush():
            nonlocal held
            if parts:
                symbols, before = self.symbols.read(" ".join(parts))
                total = np.append([0], np.cumsum(self.machine.counts(symbols), dtype=np.int64))
                starts = np.cumsum([0] + [len(p.encode()) + 1 for p in parts])  # in bytes; a space in between
                at = total[before[np.minimum(starts, len(before) - 1)]]
                for owner, n in zip(owners, np.diff(at).tolist()):
                    totals[owner] += n
            owners.clear()
            parts.clear()
            held = 0

        for i, text in enumerate(texts):
            segments, totals[i] = self.symbols.segments(text)
            for segment in segments:
                at = 0
                while at < len(segment):
                    end = segment.find(" ", at + batch_chars)
                    end = len(segment) if end < 0 else end
                    owners.append(i)
                    parts.append(segment[at:end])
                    held += end - at
                    at = end
                    if held >= batch_chars:
                        flush()
        flush()
        return totals


def _counter(path: str) -> Counter:
    return kept("counts", path, lambda: Counter(path))


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) plus ``out`` long: tokens of every whole text by the tokenizer file at ``path``.

    As the library counts without added begin and end tokens, truncation or
    padding; strings of added tokens inside texts count as one token each.
    Null and empty texts have 0 tokens.  Row-wise without a shuffle: repeated
    rows get equal counts, an empty table gives an empty table, all other
    columns pass through (one already named ``out`` is replaced).  A very long
    text is read in stretches cut at spaces, so memory is bounded by its
    longest stretch without one.  The file's normaliser, pre-tokeniser and
    model must be of the kind named above; its contents are free.
    """
    names = [c for c in (keep if keep is not None else df.columns) if c != out]
    source = df.select(*[f"`{c}`" for c in names], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text to count"))
    schema = T.StructType([source.schema[c] for c in names] + [T.StructField(out, T.LongType(), False)])

    def run(batches):
        for b in batches:
            n = pa.array(_counter(path).count(b.column(len(names)).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=schema.names)

    return source.mapInArrow(run, schema)
