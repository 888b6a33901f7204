"""Scalar column expressions (all JVM-side, inside whole-stage codegen).

Each function takes and returns a ``Column``.  Python callbacks of the
reference (``.apply`` per row) become these expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's -------------------------
# Text that counts as "no value" after trim + lower (smart cleaner).
NULL_LIKE = ["none", "", " ", "[]"]
# Empty-list markers for the usable-percentage report.
EMPTY_LIST_MARKERS = ["[]", "none", ""]
# Leading / trailing characters removed by the basic text cleaner.
CLEAN_EDGE_PATTERN = r'^[\[\{"]+|[\]\}"]+$'


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# The whitespace class stripped at both ends (Java regex ``\s``).
WHITESPACE = " \t\n\u000b\f\r"


def strip(c) -> Column:
    """Python ``str.strip()``: drop surrounding whitespace (not only blanks)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def norm(c) -> Column:
    """trim + lower; null stays null."""
    return F.lower(strip(c))


# ---- numbers ---------------------------------------------------------------
def to_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')`` / ``float(x)`` or null: bad text and NaN -> null."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d), None).otherwise(d)


def clean_price(c) -> Column:
    """Price text or number -> double; '' / '—' / '$12.99' / 'nan' -> null; ' 1.5 ' -> 1.5."""
    return to_double(_c(c).cast("string"))


def rating_int(c) -> Column:
    """coerce -> fillna(0) -> int (truncates)."""
    return F.coalesce(to_double(_c(c).cast("string")), F.lit(0.0)).cast("int")


def binary(c) -> Column:
    """``(x > 0).astype(int)``; null -> 0."""
    return F.coalesce((_c(c) > 0).cast("int"), F.lit(0))


def flag_true(c) -> Column:
    """1 if the value is boolean true, else 0 (null -> 0)."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False)).cast("int")


def flag_eq(c, value) -> Column:
    return F.coalesce((_c(c) == F.lit(value)).cast("int"), F.lit(0))


def interaction_label(verified, helpful) -> Column:
    """Implicit label: verified purchase or at least one helpful vote."""
    v = F.coalesce(_c(verified).cast("int"), F.lit(0))
    return ((v == 1) | (F.coalesce(_c(helpful), F.lit(0)) > 0)).cast("float")


def confidence(helpful) -> Column:
    return F.coalesce(_c(helpful), F.lit(0)).cast("float")


def log1p(c) -> Column:
    return F.log1p(_c(c))


def clip(c, lower=None, upper=None) -> Column:
    """pandas ``clip``: null stays null (``least`` would turn it into the bound)."""
    x = _c(c)
    if upper is not None:
        x = F.when(x > upper, F.lit(upper)).otherwise(x)
    if lower is not None:
        x = F.when(x < lower, F.lit(lower)).otherwise(x)
    return x


def millis_to_ts(c) -> Column:
    return F.timestamp_millis(_c(c).cast("bigint"))


# ---- text ------------------------------------------------------------------
def clean_text(c) -> Column:
    """strip -> lower -> strip leading ``[ { "`` and trailing ``] } "``."""
    return F.regexp_replace(norm(c), CLEAN_EDGE_PATTERN, "")


def null_like(c) -> Column:
    """Null when the text is an empty-list marker after trim/lower."""
    return F.when(norm(c).isin(*EMPTY_LIST_MARKERS), None).otherwise(_c(c))


def smart_clean(c, kind: str = "text") -> Column:
    """Three families: ``id`` trim only; ``bracket`` and ``text`` trim + lower;
    null-like values become null in every family."""
    raw = _c(c)
    base = strip(raw) if kind == "id" else norm(raw)
    return F.when(norm(raw).isin(*NULL_LIKE), None).otherwise(base)


def smart_clean_array(c) -> Column:
    """Arrays: trim + lower each element; an empty array becomes null."""
    t = F.transform(_c(c), lambda x: F.lower(strip(x)))
    return F.when(F.size(_c(c)) == 0, None).otherwise(t)


def title_head(c) -> Column:
    """Text before the first comma."""
    return F.split(_c(c), ",", 2).getItem(0)


def truncate(c, n: int) -> Column:
    """Display form: first ``n`` characters + '...' when longer."""
    x = _c(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def category_label(cat1, cat2) -> Column:
    a = _c(cat1)
    return F.when(a.isNotNull() & (a != ""), F.concat(a, F.lit(" > "), F.coalesce(_c(cat2), F.lit(""))))


def format_price(c) -> Column:
    return F.format_string("%.2f", _c(c))


# ---- list text -------------------------------------------------------------
STRING_LIST = "array<string>"


#: Fixed pattern: a complete quoted string, a stretch without quotes, or a quote that nothing closes.
QUOTED_OR_NOT = r"""(?s)'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|[^'"]++|['"]"""


def none_to_null(x: Column) -> Column:
    """Bare ``None`` tokens as ``null``; the word inside a quoted string stays.

    One pass: the text is cut into quoted strings and the rest, and only the
    rest is rewritten.
    """
    pieces = F.regexp_extract_all(x, F.lit(QUOTED_OR_NOT), F.lit(0))
    quoted = lambda p: p.startswith("'") | p.startswith('"')
    rest = F.transform(pieces, lambda p: F.when(quoted(p) | ~p.contains("None"), p).otherwise(F.regexp_replace(p, r"\bNone\b", "null")))
    return F.when(x.contains("None"), F.array_join(rest, "")).otherwise(x)


def parse_json_list(c) -> Column:
    """Strict JSON list of strings, else empty array (single quotes rejected)."""
    x = strip(c)
    parsed = F.from_json(x, STRING_LIST, {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    return F.when(x.startswith("["), F.coalesce(parsed, F.array().cast(STRING_LIST))) \
        .otherwise(F.array().cast(STRING_LIST))


def parse_py_list(c) -> Column:
    """Python-literal list (single or double quotes), else empty array.
    A bare ``None`` is rewritten to ``null`` first."""
    x = none_to_null(strip(c))
    parsed = F.from_json(x, STRING_LIST, {"allowSingleQuotes": "true",
                                          "allowBackslashEscapingAnyCharacter": "true"})
    return F.when(x.startswith("["), F.coalesce(parsed, F.array().cast(STRING_LIST))) \
        .otherwise(F.array().cast(STRING_LIST))


def list_text(c) -> Column:
    """Parsed list joined by blanks; unparsable text -> trimmed text; null -> ''."""
    x = strip(c)
    parsed = F.from_json(none_to_null(x), STRING_LIST, {"allowSingleQuotes": "true"})
    joined = F.array_join(F.transform(parsed, lambda e: strip(e)), " ")
    return F.coalesce(F.when(x.startswith("["), joined), x, F.lit(""))


def level(arr, i: int) -> Column:
    """i-th level (0-based) trimmed + lowered, null when absent (no ANSI error)."""
    return F.lower(strip(F.get(_c(arr), i)))


def leaf(arr) -> Column:
    return F.lower(strip(F.try_element_at(_c(arr), F.lit(-1))))


def depth(arr) -> Column:
    return F.coalesce(F.size(_c(arr)), F.lit(0))


# ---- images ----------------------------------------------------------------
IMAGE_LIST = "array<struct<variant:string,hi_res:string,large:string,thumb:string>>"


def parse_images(c) -> Column:
    x = none_to_null(strip(c))
    return F.from_json(x, IMAGE_LIST, {"allowSingleQuotes": "true"})


def main_image(imgs) -> Column:
    """URL of the ``main`` variant, else the first image; hi_res -> large -> thumb."""
    a = _c(imgs)
    pick = F.coalesce(F.get(F.filter(a, lambda x: F.lower(x["variant"]) == "main"), 0), F.get(a, 0))
    return F.coalesce(F.nullif(pick["hi_res"], F.lit("")), F.nullif(pick["large"], F.lit("")),
                      F.nullif(pick["thumb"], F.lit("")))


def image_count(imgs) -> Column:
    return F.coalesce(F.size(_c(imgs)), F.lit(0))


def hi_res_list(imgs) -> Column:
    return F.transform(_c(imgs), lambda x: F.coalesce(F.nullif(x["hi_res"], F.lit("")), x["large"]))


# ---- null fill -------------------------------------------------------------
def fill_chain(cat2, cat3, cat4):
    """Net effect of the two fill passes: cat_3 <- cat_2, cat_4 <- cat_3 <- cat_2."""
    c3 = F.coalesce(_c(cat3), _c(cat2))
    c4 = F.coalesce(_c(cat4), _c(cat3), _c(cat2))
    return c3, c4
