"""Operator 8 against brute force over all pairs."""

import random
import re
from collections import defaultdict

from bundles.llm import jaccard, queries

SF = "/root/testdata/sf0.001"


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ids = [k for k, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if ids[i] is None or ids[j] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = defaultdict(lambda: 1 << 60)
    for i, k in enumerate(ids):
        if k is not None:
            low[find(i)] = min(low[find(i)], k)
    return sorted(((k, len(s), None if k is None else low[find(i)]) for i, (k, s) in enumerate(zip(ids, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_op8_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(queries.QUERIES["op8_ngram_jaccard"](spark, SF)) == brute(rows, 3, 90)


def test_near_copies_chains_and_edges(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, text))
        n += 1

    for _ in range(40):  # families with edits, so that some links exist only between members
        base = [rng.choice(vocab) for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 6)):
            add(" ".join(base))
            for _ in range(rng.randint(1, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
    for _ in range(60):  # a passage that unlike documents share
        add(" ".join(rng.choice(vocab) for _ in range(rng.randint(2, 80))) + " " + passage + " " + rng.choice(vocab))
    for t in (None, "", " \n\t ", "one", "One", "one two", "ONE  two\x0b", "one two three", "Ünder one", "ünder one", " ", "x " * 20_000, "x y " * 9000):
        add(t)
    rows += [(3, rows[3][1]), (None, rows[0][1]), (None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    for width, percent in ((3, 90), (5, 80)):
        assert got(jaccard.jaccard_components(df, width, percent)) == brute(rows, width, percent)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_common_tokens_only_change_the_order(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdef") * rng.randint(1, 2) for _ in range(rng.randint(3, 40)))) for i in range(250)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2, 80)
    monkeypatch.setattr(jaccard, "LEADER_KEYS", 1)
    monkeypatch.setattr(jaccard, "PART_TOKENS", 20)
    assert got(jaccard.jaccard_components(df, 2, 80)) == want


def test_pairs_in_different_groups_meet_by_their_rarer_tokens(spark, monkeypatch):
    """Texts long enough to share several prefix tokens, with edits on both sides of the limit; a common passage in all."""
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    common = [rng.choice(vocab) for _ in range(25)]
    rows = []
    for family in range(12):
        words = [rng.choice(vocab) for _ in range(rng.randint(40, 260))] + common
        for copy in range(6):
            near = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 50))):
                near[rng.randrange(len(near))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(near[:len(near) - rng.randint(0, 6)])))
    told, write = {}, jaccard.Scratch.write

    def kept(self, df, name):
        out = write(self, df, name)
        if name == "index":
            told[name] = (out.count(), out.where("rare").count())
        return out

    monkeypatch.setattr(jaccard.Scratch, "write", kept)
    monkeypatch.setattr(jaccard, "LEADER_KEYS", 1)  # more pairs are left to the groups
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 90):
        assert got(jaccard.jaccard_components(df, 3, percent)) == brute(rows, 3, percent)
        assert 0 < told["index"][1] < told["index"][0]


def test_families_without_links_meet_by_few_tokens(spark, monkeypatch):
    rng, rows = random.Random(11), []
    for f in range(4):  # edited copies of one text, most pairs of which are just not close enough; some are, some are shorter
        base = [f"f{f}w{i}" for i in range(400)]
        for i in range(24):
            words = [f"x{rng.random()}" if rng.random() < 0.03 else w for w in base[rng.choice([0, 0, 0, 60]):]]
            rows.append((len(rows), " ".join(words)))
            if i % 8 == 0:
                rows.append((len(rows), " ".join(words[:-rng.randint(1, 90)])))
    rng.shuffle(rows)
    made, pairs = [], jaccard._meetings

    def counted(*args):
        out = pairs(*args)
        made.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(jaccard, "_meetings", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.jaccard_components(docs, 5, 78)) == brute(rows, 5, 78)
    (n, m), = made
    assert m > 100 and n <= 12 * m, made


def test_links_between_groups_of_all_sizes(spark):
    rng, rows = random.Random(12), []
    for f in range(60):
        base = [f"f{f}w{i}" for i in range(rng.randint(5, 200))]
        for i in range(6):
            words = [rng.choice(["a", "b", f"x{rng.random()}"]) if rng.random() < 0.02 else w for w in base]
            rows.append((len(rows), " ".join(words[rng.randint(0, len(words) // 8):])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((1, 15), (2, 60), (3, 90)):
        assert got(jaccard.jaccard_components(docs, width, percent)) == brute(rows, width, percent), (width, percent)
