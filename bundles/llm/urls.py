"""URL filters: rules first, then word segmentation and naive Bayes (operator 10).

Host labels such as ``cheappills`` are concatenated words.  A Viterbi pass over
unigram word probabilities splits each label; the host's words and the path's
tokens are then scored by multinomial naive Bayes.  Words are counted over the
visible text of all pages; the classifier learns from all urls, weakly
labelled by a short list of seed words among the host's words, and its
per-class token counts generalise them to the words that go with them.

Everything after the first scan works on distinct hosts and distinct (host,
path shape) pairs, so copies and hot hosts are reduced before any shuffle.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Fixed values of the contract: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Words that mark a host as unwanted when training labels are made.
SEEDS = ("adult", "ads", "bet", "bets", "casino", "pills", "poker", "porn", "track", "xxx")
#: A seed word is at least this share of all words, and a string that is no word counts as this share; so that a
#: verdict follows from the words' shares, whatever the number of pages.
SEED_SHARE, UNSEEN_SHARE = 0.01, 1e-7
LONGEST_WORD = 20
#: A label longer than the 63 characters that DNS allows is one token.
LONGEST_LABEL = 63


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_match(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, both null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, f"{h}{p}").otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def shape_of(path: Column) -> Column:
    """The path with digit runs made one token, so that equal shapes are scored once."""
    return F.regexp_replace(F.lower(path), r"[0-9]+", "0")


def word_counts(pages: DataFrame, html: str, wanted: DataFrame) -> DataFrame:
    """Counts of the ``wanted`` words in the visible text of all pages; longer words are none."""
    visible = F.regexp_replace(F.coalesce(F.col(f"`{html}`"), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    words = pages.select(F.explode(F.regexp_extract_all(F.lower(visible), F.lit(rf"(?<![a-z])[a-z]{{1,{LONGEST_WORD}}}(?![a-z])"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(wanted, "word")


def viterbi(label: str, log_p: dict[str, float], unseen: float) -> list[str]:
    """The likeliest split; an unseen string costs ``unseen`` plus ln(30) a character.  Ties: the longer last word."""
    best, back = [0.0], [0]
    for end in range(1, len(label) + 1):
        top, at = -math.inf, end - 1
        for start in range(max(0, end - LONGEST_WORD), end):
            w = label[start:end]
            p = best[start] + word_cost(w, log_p, unseen)
            if p > top:
                top, at = p, start
        best.append(top)
        back.append(at)
    words, end = [], len(label)
    while end:
        words.append(label[back[end]:end])
        end = back[end]
    return words[::-1]


def word_cost(word: str, log_p: dict[str, float], unseen: float) -> float:
    return log_p.get(word, unseen - math.log(30) * len(word))


def seeds_whole(log_p: dict[str, float], seeds, unseen: float) -> dict[str, float]:
    """``log_p`` with every seed word at least as likely as its own best split, so that no text of the pages takes it apart."""
    out = dict(log_p)
    for seed in sorted(set(seeds) & log_p.keys(), key=len):
        rest = {w: p for w, p in out.items() if w != seed}
        own = sum(word_cost(w, rest, unseen) for w in viterbi(seed, rest, unseen))
        out[seed] = max(out[seed], own + 1e-9)
    return out


def segment_labels(labels: DataFrame, pages: DataFrame, html: str, seeds=SEEDS) -> DataFrame:
    """``(label, words)`` for distinct labels, split with the counts of just the words that occur in them."""
    subs = F.expr(f"""flatten(transform(sequence(1, length(label)), i ->
        transform(sequence(1, least({LONGEST_WORD}, length(label) - i + 1)), n -> substring(label, i, n))))""")
    held = labels.select("label", F.explode(F.array_distinct(subs)).alias("word"))
    counts = word_counts(pages, html, held.select("word").distinct())
    seed = F.col("word").isin(list(seeds))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    known = held.join(counts, "word", "left").where(F.col("n").isNotNull() | seed).join(F.broadcast(total), F.lit(True))  # one row
    share = F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0))
    known = known.withColumn("p", F.when(seed, F.greatest(share, F.lit(SEED_SHARE))).otherwise(share))
    grouped = known.groupBy("label").agg(F.collect_list(F.struct("word", "p")).alias("known"))  # at most 63 * 20 words
    joined = labels.join(grouped, "label", "left")

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for text, words in zip(label, known):
            unseen = math.log(UNSEEN_SHARE)
            log_p = {} if words is None else seeds_whole({w["word"]: math.log(w["p"]) for w in words}, seeds, unseen)
            out.append(viterbi(text, log_p, unseen))
        return pd.Series(out)

    return joined.select("label", split("label", "known").alias("words"))


def filter_urls(df: DataFrame, rules=RULES, seeds=SEEDS, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict)``, one per input row.

    The verdict is that of the longest fitting rule, else the classifier's
    (``block`` only if its posterior is above one half; a url without host or
    path tokens gets ``allow``).  Null urls and urls without ``://`` have an
    empty host and path.  Repeated rows get equal rows; the key is only
    carried, so it may be null; other columns are ignored; an empty table
    gives an empty result.  A host's label longer than the 63 characters that
    DNS allows is one token, whatever it holds; words of the pages longer than
    20 letters are no words; a token counts as often as it occurs in its url.
    """
    scratch = Scratch(df.sparkSession, "urls")
    pages = df.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"))
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    shaped = pages.withColumn("shape", shape_of(F.col("path")))
    shapes = scratch.write(shaped.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n")), "shapes")

    names = shapes.select("host").distinct().select("host", F.split("host", r"[^a-z]+").alias("labels"))
    names = scratch.write(names.select("host", F.explode(F.array_distinct(F.filter("labels", lambda x: x != ""))).alias("label")), "names")
    short = names.select("label").distinct().where(F.length("label") <= LONGEST_LABEL)
    words = scratch.write(segment_labels(short, df, html, seeds), "words")
    hosts = names.join(words, "label", "left").groupBy("host").agg(
        F.flatten(F.array_sort(F.collect_list(F.coalesce("words", F.array("label"))))).alias("words"))
    hosts = hosts.select("host", "words", F.arrays_overlap("words", F.array(*map(F.lit, seeds))).alias("bad"))
    scored = scratch.write(shapes.join(hosts, "host", "left").select(
        "host", "shape", "n", F.coalesce("bad", F.lit(False)).alias("bad"),
        F.concat(F.coalesce("words", F.array().cast("array<string>")),
                 F.transform(F.filter(F.split("shape", r"[^a-z0-9]+"), lambda x: x != ""), lambda x: F.concat(F.lit("/"), x))).alias("tokens")), "tokens")

    tokens = scored.select("host", "shape", "n", "bad", F.explode("tokens").alias("token"))
    by_class = [F.sum(F.when(F.col("bad") == c, F.col("n")).otherwise(0)).alias(k) for k, c in (("ok", False), ("no", True))]
    counts = scratch.write(tokens.groupBy("token").agg(*by_class), "counts")
    sums = counts.agg(F.sum("ok").alias("ok_all"), F.sum("no").alias("no_all"), F.count(F.lit(1)).alias("v"))
    docs = scored.agg(*by_class).select(F.col("ok").alias("ok_docs"), F.col("no").alias("no_docs"))
    weight = counts.join(F.broadcast(sums), F.lit(True)).select(  # one row
        "token", (F.log((F.col("no") + 1.0) / (F.col("no_all") + F.col("v"))) - F.log((F.col("ok") + 1.0) / (F.col("ok_all") + F.col("v")))).alias("w"))
    weight = scratch.write(weight, "weights")
    odds = tokens.select("host", "shape", "token").join(weight, "token").groupBy("host", "shape").agg(F.sum("w").alias("odds"))
    odds = scratch.write(odds.join(F.broadcast(docs), F.lit(True)).select(  # one row
        "host", "shape", (F.col("odds") + F.log(F.col("no_docs") + 1.0) - F.log(F.col("ok_docs") + 1.0)).alias("odds")), "odds")

    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    method = F.when(F.coalesce("odds", F.lit(-1.0)) > 0, "block").otherwise("allow")
    return shaped.join(odds, ["host", "shape"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
