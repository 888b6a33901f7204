"""Packing of tokenised documents into fixed-length sequences (operator 2).

A document longer than a sequence is cut into full sequences; what is left of
it, and every shorter document, goes whole into a shared sequence by first-fit
decreasing.  First fit is answered by a tournament tree over the free space of
the open bins: descend to the leftmost bin whose space is enough, O(log bins)
per piece.  It runs independently in groups of randomly chosen pieces, so its
memory is bounded by the group size and groups run in parallel.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, release, slices
from .tokens import ID, PartEncoder

#: Parts that the library gets as one text.
TOGETHER = 256
#: Pieces per first-fit group, on average; a parameter of ``pack``.
GROUP_PIECES = 4096

PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


class _Encoder:
    """Ids of whole texts by the library at ``path``, its added tokens' strings taken for these tokens (its default).

    An added token parts a text into stretches that the library encodes one by
    one, so the stretches go through the table of parts and the token's id in
    between.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        self.added = {x.content: np.array([i], dtype=ID).tobytes() for i, x in library.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")" if self.added else "((?!))")
        library.encode_special_tokens = True
        library.model._resize_cache(0)  # recurring words are in the table of parts
        size = np.array([len(library.id_to_token(i)) for i in range(library.get_vocab_size())])  # a character stands for a byte

        def apart(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, dtype=ID).tobytes() for e in library.encode_batch_fast(texts, add_special_tokens=False)]

        def together(parts: list[str]) -> list[bytes]:
            """Some hundred parts as one text; their ids are told apart by the bytes they cover."""
            data = b"".join(apart(["".join(parts[at:at + TOGETHER]) for at in range(0, len(parts), TOGETHER)]))
            ends = np.searchsorted(np.cumsum(size[np.frombuffer(data, ID)]), np.cumsum([len(x.encode()) for x in parts]), side="left") + 1
            ends = (ends * ID.itemsize).tolist()
            return [data[a:b] for a, b in zip([0] + ends, ends)]

        self.parts = PartEncoder(together, apart)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not any(s in t for s in self.added for t in texts):
            return self.parts.encode(texts)
        split = [self.cut.split(t) for t in texts]  # stretches at even places
        ids = iter(self.parts.encode([x for own in split for x in own[::2]]))
        return [b"".join(self.added[x] if i % 2 else next(ids) for i, x in enumerate(own)) for own in split]


def _encoder(path: str) -> _Encoder:
    return kept("packing", path, lambda: _Encoder(path))


def token_pieces(df: DataFrame, tokenizer: str, seq_len: int = 2048, end_id: int = 1,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, start, length, doc_tokens, ids)``, ids as little-endian uint32 bytes.

    Every document is its ids followed by ``end_id`` (so a null or empty text is
    one piece of one id), cut every ``seq_len`` ids.  Each id lies in exactly
    one piece.  Repeated rows give repeated pieces; a null key stays null.
    """
    end = np.array([end_id], dtype=ID).tobytes()

    def run(batches):
        encode, step = _encoder(tokenizer).encode, seq_len * 4
        for b in (b for whole in batches for b in slices(whole)):
            keys, start, total, ids = [], [], [], []
            for k, own in zip(b.column(0).to_pylist(), encode([t or "" for t in b.column(1).to_pylist()])):
                own += end
                for at in range(0, len(own), step):
                    keys.append(k)
                    start.append(at // 4)
                    total.append(len(own) // 4)
                    ids.append(own[at:at + step])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(start, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, PIECE)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first, ties in input order; each into the leftmost bin with room."""
    n = len(lengths)
    leaves = 1 << max(0, int(n - 1).bit_length())
    tree = [capacity] * (2 * leaves)  # tree[i]: the largest free space below node i; an unused bin is a whole one
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


def pack(pieces: DataFrame, n_groups: int, seq_len: int = 2048, seed: int = 7,
         start: str = "start", length: str = "length", row: str = "piece_row") -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``.

    ``row`` is a unique, stable long below 2**40 * 2**22 that the caller has
    written (see ``row_number_column``).  Full pieces are sequences of their
    own with odd ids; the rest are dealt to ``n_groups`` random groups by a
    hash of ``row`` (so copies of one document spread out) and packed there,
    under even ids.  Zero-length pieces do not occur.
    """
    full = pieces.where(F.col(length) >= seq_len).select(
        "*", (F.col(row) * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col(length) < seq_len).withColumn(
        "pack_group", F.pmod(F.xxhash64(F.col(row), F.lit(seed)), F.lit(n_groups)))
    schema = T.StructType(full.schema.fields[:-2] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        release()  # the tokenizer and its table of parts are used no more
        group = group.sort_values(row, ignore_index=True)  # the same bins in every attempt
        bins, offsets = first_fit_decreasing(group[length].to_numpy(), seq_len)
        group["sequence_id"] = (group["pack_group"] * 2**24 + bins) * 2
        group["offset"] = offsets
        return group.drop(columns="pack_group")

    return full.unionByName(rest.groupBy("pack_group").applyInPandas(run, schema))


def row_number_column(df: DataFrame, name: str = "piece_row") -> DataFrame:
    """``df`` plus a unique long; stable only once written."""
    return df.withColumn(name, F.monotonically_increasing_id())


def group_count(rows: int, group_pieces: int = GROUP_PIECES) -> int:
    return max(1, -(-rows // group_pieces))
