"""Language identification with segmentation-marginalised unigrams (operator 7).

Every language has a probability for each piece of a fixed public vocabulary.
A text's likelihood is the sum, over all ways to cut it into pieces, of the
product of their probabilities; a forward pass over the characters computes
that sum.  Pieces never cross white space, so a text's log-likelihood is the
sum of its words', and a word's forward pass is kept for reuse.

Training is one aggregation: piece counts per language over all labelled
training texts, with add-one smoothing.  Its result is bounded by vocabulary x
languages, whatever the size of the corpus, and goes to the workers whole.
"""

from __future__ import annotations


import uuid
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, kept

#: The mark of a word's start in the vocabulary.
MARK = "▁"
UNKNOWN = "und"
#: Words and characters kept per worker (bounds memory only), and the length from which a word is summed alone.
MAX_WORDS, MAX_CHARS, LONG = 400_000, 8_000_000, 48
#: Words summed in one pass.
AT_ONCE = 4_000
#: A word's sums are multiplied by this per character, so that they stay in range.
LIFT = 1e4
#: Sums below this are scaled up.
TINY = 1e-100


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    known = {model.id_to_piece(i): i for i in range(n)
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    of_byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return model, known, of_byte, max(map(len, known)), n


@dataclass(frozen=True)
class LanguageModel:
    """Log-probabilities, one row per piece of the vocabulary at ``path``, one column per language."""
    path: str
    languages: tuple
    log_p: np.ndarray
    mark: str = field(default_factory=lambda: uuid.uuid4().hex)


def train(df: DataFrame, path: str, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fit on all rows with a non-null language and text; the caller leaves out what is held out.

    The vocabulary's own segmentation of every distinct word is counted per
    language in each partition, then summed over partitions.
    """
    def count(batches):
        totals: dict[str, Counter] = {}
        known: dict[str, tuple[int, ...]] = kept("langid words", path, dict)
        model, ids = _pieces(path)[0], list(range(_pieces(path)[4]))  # one object per id, whatever the number of words
        for b in batches:
            words: dict[str, Counter] = {}
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words.setdefault(name, Counter()).update(t.split())
            for name, own in words.items():
                total = totals.setdefault(name, Counter())
                new = [w for w in own if w not in known]
                if len(known) + len(new) > MAX_WORDS:
                    known.clear()
                    new = list(own)
                known.update((w, tuple(map(ids.__getitem__, own_ids))) for w, own_ids in zip(new, model.encode(new, num_threads=1)))
                for w, n in own.items():
                    for piece in known[w]:
                        total[piece] += n
        for name, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(total), pa.string()), pa.array(list(total), pa.int32()),
                                              pa.array(list(total.values()), pa.int64())], names=["lang", "piece", "n"])

    rows = (df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("text is not null and lang is not null")
            .mapInArrow(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect())
    languages = tuple(sorted({r.lang for r in rows}))
    counts = np.ones((_pieces(path)[4], len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    for r in rows:
        counts[r.piece, at[r.lang]] += r.n
    return LanguageModel(path, languages, np.log(counts) - np.log(counts.sum(axis=0)))


class Scorer:
    """Forward sums of words under every language at once."""

    def __init__(self, model: LanguageModel):
        import ahocorasick
        _, self.known, self.of_byte, self.longest, _ = _pieces(model.path)
        self.log_p, self.p = model.log_p, np.exp(model.log_p)
        rows = [tuple(r) for r in self.p.tolist()]
        # every prefix of a piece, with the piece's probabilities if it is one itself, so that a walk can stop early
        self.walk: dict[str, tuple] = {piece[:n]: () for piece in self.known for n in range(1, len(piece))}
        self.walk.update((piece, rows[i]) for piece, i in self.known.items())
        self.finder = ahocorasick.Automaton()  # a piece's value: its id and its length
        for piece, i in self.known.items():
            self.finder.add_word(piece, i * 256 + len(piece))
        self.finder.make_automaton()
        self.row: dict[str, int] = {}  # word -> its row of ``table``
        self.table, self.chars = np.zeros((0, self.p.shape[1])), 0

    def word(self, w: str) -> np.ndarray:
        self.learn({w})
        return self.table[self.row[w]]

    def learn(self, words: set[str]) -> None:
        """Compute the words that are not kept yet, all in one pass."""
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > MAX_WORDS or self.chars > MAX_CHARS:
            self.row, self.table, self.chars, new = {}, self.table[:0], 0, list(words)
        if new:
            self.chars += sum(map(len, new))
            self.row.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table] + [self.together(new[at:at + AT_ONCE]) for at in range(0, len(new), AT_ONCE)])

    def together(self, words: list[str]) -> np.ndarray:
        """``forward`` of many words: their characters stand in one string, and all words advance by a place at a time.

        Sums are multiplied by ``LIFT`` per character; words that are long, hold a character
        that is no piece, or leave the range of doubles all the same go through ``forward``.
        """
        out = np.zeros((len(words), self.p.shape[1]))
        short = [i for i, w in enumerate(words) if len(w) < LONG and self.known.keys() >= set(w)]
        if short:
            marked = [MARK + words[i] for i in short]
            lengths = np.array([len(w) for w in marked])
            first = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
            place = np.arange(first[-1] + lengths[-1] + 1) - np.repeat(first, lengths + 1)  # 0 before a word, n after n characters
            # words are parted by a line break, which no piece holds; sums at x are those before character x
            found = np.fromiter(chain.from_iterable(self.finder.iter("\n".join(marked))), np.int64).reshape(-1, 2)
            end, piece, size = found[:, 0] + 1, found[:, 1] >> 8, found[:, 1] & 255
            order = np.argsort(place[end].astype(np.int16), kind="stable")  # matches come by their ends
            end, piece, start = end[order], piece[order], (end - size)[order]
            factor = self.p[piece] * np.power(LIFT, size[order])[:, None]
            alpha = np.zeros((len(place) + 1, self.p.shape[1]))
            alpha[first] = 1.0
            steps = np.searchsorted(place[end], np.arange(1, lengths.max() + 2))
            for lo, hi in zip(steps, steps[1:]):
                if lo < hi:
                    heads = np.flatnonzero(np.diff(end[lo:hi], prepend=-1))
                    alpha[end[lo:hi][heads]] = np.add.reduceat(alpha[start[lo:hi]] * factor[lo:hi], heads)
            last = alpha[first + lengths]
            good = ((last > 1e-290) & (last < 1e290)).all(axis=1)
            with np.errstate(divide="ignore"):
                out[short] = np.log(last) - (lengths * np.log(LIFT))[:, None]
            short = [i for i, ok in zip(short, good) if ok]
        for i in set(range(len(words))) - set(short):
            out[i] = self.forward(MARK + words[i])
        return out

    def forward(self, s: str) -> np.ndarray:
        """log of the sum over all segmentations of ``s``, per language; a character may fall back to its bytes."""
        n, walk, langs = len(s), self.walk, range(self.p.shape[1])
        alpha: list = [None] * (n + 1)  # the sum up to each position, times TINY**-scale
        alpha[0], scale = [1.0] * len(langs), [0] * len(langs)
        for start in range(n):
            here, alpha[start] = alpha[start], None
            for i in langs:
                if here[i] < TINY:  # rescale the positions ahead long before anything underflows
                    scale[i] += 1
                    here[i] /= TINY
                    for ahead in alpha[start + 1:start + self.longest + 1]:
                        if ahead is not None:
                            ahead[i] /= TINY
            if not walk.get(s[start]):
                bytes_p = np.exp(sum(self.log_p[self.of_byte[b]] for b in s[start].encode("utf-8", "replace"))).tolist()
                add = [h * p for h, p in zip(here, bytes_p)]
                alpha[start + 1] = add if alpha[start + 1] is None else [x + y for x, y in zip(alpha[start + 1], add)]
            for end in range(start + 1, min(n, start + self.longest) + 1):
                p = walk.get(s[start:end])
                if p is None:
                    break
                if p:
                    old = alpha[end]
                    alpha[end] = [h * q for h, q in zip(here, p)] if old is None else [x + h * q for x, h, q in zip(old, here, p)]
        return np.log(alpha[n]) + np.array(scale) * np.log(TINY)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """One vector of log-likelihoods per text; the words that are new to all of them are computed together."""
        words = [Counter(t.split()) for t in texts]
        self.learn({w for own in words for w in own})
        return [np.fromiter(own.values(), float, len(own)) @ self.table[list(map(self.row.__getitem__, own))] for own in words]


def scorer(model: LanguageModel) -> Scorer:
    return kept("langid", model.mark, lambda: Scorer(model))


def predict(df: DataFrame, model: LanguageModel, text: str = "text", lang_out: str = "lang_pred", score_out: str = "lang_score",
            names: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``names``) plus the likeliest language and its posterior probability under equal priors.

    Whole texts.  Null texts, texts without a letter, and any text when no
    language could be learned get ``und`` and 0.0.  Ties go to the language
    that sorts first.  Row-wise: repeated rows get equal results, an empty
    table stays empty, other columns pass through, columns of the outputs'
    names are replaced.
    """
    def run(texts: pa.Array, letters: pa.Array) -> list[pa.Array]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        asked = [i for i, has in enumerate(letters.to_pylist()) if has and model.languages]
        for s, i in zip(scorer(model).texts([texts[i].as_py() for i in asked]) if asked else [], asked):
            best = int(s.argmax())
            names[i] = model.languages[best]
            scores[i] = 1.0 / float(np.exp(np.maximum(s - s[best], -700.0)).sum())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    made = df.withColumn("has_letter__", F.coalesce(F.rlike(F.col(f"`{text}`"), F.lit(r"\p{L}")), F.lit(False)))
    return append_columns(made, [text, "has_letter__"], [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())],
                          run, [c for c in df.columns if c != "has_letter__" and (names is None or c in names)])


def held_out(key: str = "doc_id"):
    """The fold that is never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % 5 == 0, F.lit(False))
