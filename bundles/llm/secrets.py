"""Secret scan over whole texts, DataFrame functions only (operator 3).

Base spans are the matches of three fixed patterns.  The method adds spans of
high randomness: candidate strings of a character class are scanned with a
sliding window whose character counts are kept incrementally (one count up,
one count down per step); the window's Shannon entropy follows from the sum of
c*log2(c) over the counts, which each step changes by one table difference.
Windows over the class's threshold are merged into spans.  Placeholder words
and runs of one character suppress only the windows that overlap them: a
candidate ends where one begins and the next may start where it ends.  What is
left of a candidate is suppressed as a whole only if it is a checksum of a known
length or plain words throughout; base spans never are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: kind, pattern, checked group, least length of that group.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"(?-i)AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)


@dataclass(frozen=True)
class CharClass:
    """A character class to scan: matches of ``pattern``, runs of ``alphabet`` of ``window`` characters or more."""
    kind: str
    alphabet: str
    pattern: str
    window: int
    bits: float        # a window counts from this entropy on
    needs: tuple = ()  # patterns that a candidate must match as well


#: Words that mark a placeholder, and rows of characters that only look random; in any case.
PLACEHOLDERS = ("example", "sample", "placeholder", "changeme", "dummy", "redacted", "abcdefghijklm", "nopqrstuvwxyz", "0123456789", "0123456789abcdef")


def candidates(chars: str, window: int, alphabet: str) -> str:
    """Pattern of the runs of ``chars``, ``window`` or more, that overlap no placeholder and no run of 8 equal characters."""
    words = [w for w in PLACEHOLDERS if set(w) <= set(alphabet)]
    inside = "|".join(f"{w[j:]}(?<={w})" for w in words for j in range(1, len(w)))
    after = "|".join(f"(?<={w})" for w in words)
    # a character equal to the one before starts a candidate only after a word: elsewhere it is the rest of a run
    starts = rf"(?={chars}{{{window}}})(?!(?i:{inside}))(?i:{after}|(?!(?<=(.))\1))"
    return rf"{starts}(?:(?!(?i:{'|'.join(words)}|(.)\2{{7}})){chars}){{{window},}}+"


_BASE64, _HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", "0123456789abcdefABCDEF"
CLASSES = (
    CharClass("entropy_base64", _BASE64, candidates("[A-Za-z0-9+/_=-]", 24, _BASE64), 24, 4.0, (r"[0-9]", r"[A-Za-z]")),
    CharClass("entropy_hex", _HEX, candidates("[0-9a-fA-F]", 32, _HEX), 32, 3.3, (r"[0-9]", r"[A-Fa-f]")),
)
#: Whole candidates that look random but are no secrets: checksums (base64 or hex) and words with a short number at the
#: end.  A word is of one case, but for a capital at its start, so that the random tail of a prefixed key is none.
ALLOW = (
    r"^sha(?:1-(?:.{27}|.{40})|256-(?:.{43}|.{64})|384-(?:.{64}|.{96})|512-(?:.{86}|.{128}))={0,2}$",
    r"^(?:(?:[A-Z]?[a-z]+|[A-Z]+)[/_=-])++(?:[A-Z]?[a-z]*|[A-Z]*)[0-9]{0,4}$",
)
#: c*log2(c) is held as an integer, so that the running sum stays exact.
UNIT = 1 << 20

SPAN = "struct<kind:string,start:int,end:int>"


def _scaled(c: int) -> int:
    return round(c * math.log2(c) * UNIT) if c > 1 else 0


def let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), lambda v: fn(v)), 1)


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, group's text) of the leftmost non-overlapping matches, in code points.

    The texts between the matches (split) and the matches themselves have the
    lengths that the positions are summed from.
    """
    found = F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                     (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.lit(None)).alias("kept"))
    steps = let(found, lambda f: F.transform(f["whole"], lambda m, i: F.struct(
        F.char_length(F.get(f["gap"], i)).alias("gap"), F.char_length(m).alias("size"), (F.get(f["kept"], i) if group else m).alias("kept"))))
    spans = F.array().cast("array<struct<start:int,end:int,kept:string>>")
    return F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), spans.alias("spans")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["size"]).alias("at"),
            F.concat(s["spans"], F.array(F.struct((s["at"] + m["gap"]).alias("start"), (s["at"] + m["gap"] + m["size"]).alias("end"), m["kept"].alias("kept")))).alias("spans")),
        lambda s: s["spans"])


def base_spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    spans = F.transform(F.filter(located(text, pattern, group), lambda m: F.char_length(m["kept"]) >= least),
                        lambda m: F.struct(F.lit(kind).alias("kind"), m["start"], m["end"]))
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def high_windows(candidate: Column, c: CharClass) -> Column:
    """Merged (start, end) of the candidate's windows with at least ``c.bits`` of entropy."""
    w, size = c.window, len(c.alphabet)
    table = F.array(*[F.lit(_scaled(i)) for i in range(w + 2)])
    limit = math.floor(w * (math.log2(w) - c.bits) * UNIT)  # entropy = log2(w) - sum / w
    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(c.alphabet), ch))
    # per position: the character that leaves the window, then the one that enters
    steps = let(codes, lambda cs: F.transform(cs, lambda code, i: F.array(
        F.struct(F.when(i >= w, F.get(cs, i - w)).otherwise(0).alias("code"), F.lit(-1).alias("by"), i.alias("i")),
        F.struct(code.alias("code"), F.lit(1).alias("by"), i.alias("i")))))
    steps = F.filter(F.flatten(steps), lambda e: e["code"] > 0)
    none = F.array().cast("array<struct<a:int,b:int>>")
    start = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0).cast("long").alias("sum"),
                     F.lit(-1).alias("a"), F.lit(-1).alias("b"), none.alias("spans"))

    def step(s: Column, e: Column) -> Column:
        return let(F.element_at(s["counts"], e["code"]), lambda count: let(
            s["sum"] + F.element_at(table, count + e["by"] + 1) - F.element_at(table, count + 1),
            lambda total: moved(s, e, count, total)))

    def moved(s: Column, e: Column, count: Column, total: Column) -> Column:
        counts = F.concat(F.slice(s["counts"], F.lit(1), e["code"] - 1), F.array(count + e["by"]),
                          F.slice(s["counts"], e["code"] + 1, F.lit(size)))
        first, end = e["i"] - (w - 1), e["i"] + 1
        high = (e["by"] == 1) & (first >= 0) & (total <= limit)
        opens = high & (first > s["b"])
        return F.struct(counts.alias("counts"), total.alias("sum"),
                        F.when(opens, first).otherwise(s["a"]).alias("a"), F.when(high, end).otherwise(s["b"]).alias("b"),
                        F.when(opens & (s["a"] >= 0), F.concat(s["spans"], F.array(F.struct(s["a"].alias("a"), s["b"].alias("b")))))
                        .otherwise(s["spans"]).alias("spans"))

    return F.aggregate(steps, start, step, lambda s: F.when(
        s["a"] >= 0, F.concat(s["spans"], F.array(F.struct(s["a"].alias("a"), s["b"].alias("b"))))).otherwise(s["spans"]))


def entropy_spans(text: Column, c: CharClass, allow: tuple = ALLOW) -> Column:
    def secretive(m: Column) -> Column:
        ok = F.lit(True)
        for p in c.needs:
            ok = ok & F.rlike(m["kept"], F.lit(p))
        for p in allow:
            ok = ok & ~F.rlike(m["kept"], F.lit(p))
        return ok

    spans = F.flatten(F.transform(F.filter(located(text, c.pattern), secretive), lambda m: F.transform(
        high_windows(m["kept"], c), lambda h: F.struct(F.lit(c.kind).alias("kind"), (m["start"] + h["a"]).alias("start"), (m["start"] + h["b"]).alias("end")))))
    return F.when(F.rlike(text, F.lit(c.pattern)), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan_secrets(df: DataFrame, text: str = "text", base_out: str = "base_spans", all_out: str = "secret_spans",
                 classes: tuple = CLASSES, allow: tuple = ALLOW) -> DataFrame:
    """``df`` plus two arrays of ``struct(kind, start, end)``: the base spans, and these with the method's.

    Whole texts; null and empty texts have no spans.  Positions are code
    points, end exclusive, ordered by start, then by kind as listed (base kinds
    first).  Spans of different kinds may overlap.  Row-wise without a shuffle,
    so repeated rows give equal rows and an empty table stays empty; other
    columns pass through, columns of the outputs' names are replaced.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kinds = [k[0] for k in BASE] + [c.kind for c in classes]
    order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])

    def ordered(spans: Column) -> Column:
        keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    found = df.withColumn(base_out, F.concat(*[base_spans(whole, *k) for k in BASE]))
    found = found.withColumn(all_out, F.concat(F.col(base_out), *[entropy_spans(whole, c, allow) for c in classes]))
    return found.withColumns({base_out: ordered(F.col(base_out)), all_out: ordered(F.col(all_out))})


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask_spans(text: Column, spans: Column, mask: str = "<SECRET>") -> Column:
    """The text with every span, overlapping ones merged, replaced by ``mask``; spans ordered by start."""
    state = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda s, m: F.struct(
            F.greatest(s["at"], m["end"]).alias("at"),
            F.when((m["start"] < s["at"]) & (s["at"] > 0), s["out"])
            .otherwise(F.concat(s["out"], F.array(F.substring(text, s["at"] + 1, m["start"] - s["at"]), F.lit(mask)))).alias("out")),
        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.char_length(text) - s["at"])))
    return F.when(F.size(spans) > 0, state).otherwise(text)
