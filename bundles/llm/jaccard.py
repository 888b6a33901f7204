"""N-gram Jaccard join through a token-group matrix (operator 8).

Documents become sets of word shingles (64-bit hashes).  Equal sets fold into
one class.  Similar classes are first gathered into groups: each class is
compared with one leader per key, the keys being some of the prefix tokens that
it shares and the leader a class with few tokens of its own, and verified links
make the groups.  What is left
are pairs of classes in different groups.  For these, a group's token union
stands for its members: a class meets another group only by a prefix token that is
not among the most frequent of either and whose place allows the sizes found
there, and only by one of the tokens that the same classes have.  The overlap with
the union of each (bounded) part of the group bounds the similarity to every
member, and only parts that the bound lets through are opened and compared
member by member.

Sets and unions travel as bitmaps of their hashed tokens.  A bit that only one
of two bitmaps has stands for at least one token that only that set has, so
bitmaps bound the overlap from above and never lose a link; texts are fetched
only for the pairs that the bitmaps let through, and decide.

Prefixes: in any global token order, two sets with Jaccard >= t share at least
k of their first n - ceil(t*n) + k tokens.  The order is by frequency, rare
tokens first, as a count sketch of fixed size tells it (any order is exact), so
prefixes meet on what few documents have.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, components, kept, releasing, slices

#: A class's first leaders are those of so many of its first and of its last shared tokens.
LEADER_KEYS = 4
#: Bits of a counter's place in the sketch, its sections, and tables that are added together.
SKETCH_BITS, SECTIONS, FAN_IN = 24, 16, 64
#: Asked classes that are compared with a group part in one task.
ASKED = 512
#: Tokens of a group part, on average; bounds the union that stands for it.
PART_TOKENS = 16_384
#: Hashed words kept per worker; bounds memory only.
MAX_WORDS = 250_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; one for the whole sequence if it has fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return np.zeros(0, np.uint64)
    known = kept("jaccard", "words", dict)
    if len(known) > MAX_WORDS:
        known.clear()
    try:
        h = list(map(known.__getitem__, words))
    except KeyError:
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = list(map(known.__getitem__, words))
    h = np.array(h, np.uint64)
    span = min(width, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        out = mix(out + h[i:i + len(out)])
    return np.unique(out)


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart (with the size)."""
    a, b = np.add.reduce(mix(s + _M2)), np.bitwise_xor.reduce(mix(s ^ _M1))
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def least_overlap(n: int, percent: int) -> int:
    return (percent * n + 99) // 100


def shared_least(n: int, percent: int) -> int:
    """k: the tokens that the prefixes of a linked pair share at least, by the smaller set's size."""
    return 1 + n * (100 - percent) // 400


def prefix_size(n: int, percent: int) -> int:
    return n - least_overlap(n, percent) + shared_least(n, percent) if n else 0


def among(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which values of ``a`` are in the sorted ``b``."""
    if not len(b):
        return np.zeros(len(a), bool)
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def bitmap(s: np.ndarray) -> bytes:
    """Presence bits by the tokens' low bits; two to four bits a token, a power of two."""
    size = 1 << max(6, (2 * len(s) - 1).bit_length())
    flags = np.zeros(size, bool)
    flags[(s & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def narrowed(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap (as 64-bit words) that the same tokens have with only ``size`` words."""
    return bits if len(bits) == size else np.bitwise_or.reduce(bits.reshape(-1, size))


def only_in(a: bytes, b: bytes) -> tuple[int, int]:
    """Least numbers of tokens that only the first and only the second set has."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    x, y = narrowed(x, size), narrowed(y, size)
    both = x & y
    return int(np.bitwise_count(x ^ both).sum()), int(np.bitwise_count(y ^ both).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = int(among(a, b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _cells(s: np.ndarray) -> np.ndarray:
    """A token's counter in the sketch."""
    return (mix(s + _M2) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    """Counters of hashed tokens over all documents, of a fixed size; counts stop at 65,535.

    A task counts into a table of its own and hands it on in compressed
    sections; sections are added in rounds of bounded fan-in.  A counter is at
    least the number of documents that hold any of its tokens.
    """
    section = (1 << SKETCH_BITS) // SECTIONS

    def count(batches):
        table = np.zeros(1 << SKETCH_BITS, np.uint16)
        for b in (b for whole in batches for b in slices(whole)):
            cells = np.concatenate([_cells(shingle_set(t, width)) for t in b.column(0).to_pylist()] or [np.zeros(0, np.int64)])
            cell, n = np.unique(cells, return_counts=True)
            table[cell] = np.minimum(table[cell] + n, 65_535).astype(np.uint16)
        if table.any():
            own = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(SECTIONS, own, np.int32)), pa.array(np.arange(SECTIONS, dtype=np.int32)),
                 pa.array([zlib.compress(table[i * section:(i + 1) * section].tobytes(), 1) for i in range(SECTIONS)], pa.binary())], names=["source", "section", "data"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(section, np.int64)
        for data in rows.column("data"):
            total += np.frombuffer(zlib.decompress(data.as_py()), np.uint16)
        data = zlib.compress(np.minimum(total, 65_535).astype(np.uint16).tobytes(), 1)
        return pa.table({"source": rows.column("source").combine_chunks()[:1], "section": rows.column("section").combine_chunks()[:1], "data": pa.array([data], pa.binary())})

    shape = "source int, section int, data binary"
    tables, sources = docs.select("text").mapInArrow(releasing(count), shape), docs.rdd.getNumPartitions()
    while sources > 1:
        sources = -(-sources // FAN_IN)
        tables = tables.withColumn("source", F.pmod("source", F.lit(sources))).groupBy("source", "section").applyInArrow(add, shape)
    out = np.zeros(1 << SKETCH_BITS, np.uint16)
    for r in tables.select("section", "data").collect():  # the sketch itself, of a fixed size
        out[r.section * section:(r.section + 1) * section] = np.frombuffer(zlib.decompress(bytes(r.data)), np.uint16)
    return out


def ordered(s: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The sorted tokens in the global order: rare ones first, by powers of two of their counters, then by hash."""
    if not len(s):
        return s
    level = np.frexp(sketch[_cells(s)].astype(np.float32))[1]
    return s[np.argsort(level, kind="stable")]


def _signatures(docs: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """Per document: set size, signature, its prefix in the global order, and its bitmap."""
    held = docs.sparkSession.sparkContext.broadcast(sketch)  # of a fixed size

    def run(batches):
        for b in (b for whole in batches for b in slices(whole)):
            keys, n, s1, s2, prefix, bits = [], [], [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingle_set(t, width)
                x, y = signature(s) if len(s) else (0, 0)
                bits.append(bitmap(s))
                s = ordered(s, held.value)
                take = prefix_size(len(s), percent)
                keys.append(k)
                n.append(len(s))
                s1.append(x)
                s2.append(y)
                prefix.append(s[:take].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names=["doc_id", "n", "s1", "s2", "prefix", "bits"])

    return docs.select("doc_id", "text").mapInArrow(releasing(run), "doc_id long, n long, s1 long, s2 long, prefix array<long>, bits binary")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs(a, b)`` that may be linked by the sizes and bitmaps in ``sets(cls, n, bits)``."""
    def run(batches):
        for batch in (b for whole in batches for b in slices(whole)):
            keep = []
            for i, (n, m, x, y) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(2, 6)])):
                p, q = only_in(x, y)
                both = min(n - p, m - q)
                if 100 * both >= percent * (n + m - both):
                    keep.append(i)
            keep = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    left = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    return (pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .select("a", "b", "na", "nb", "xa", "xb").mapInArrow(releasing(run), "a long, b long"))


def _verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose texts are linked; both texts come by plain joins, which split hot keys."""
    def run(batches):
        last, last_set, seen = None, None, {}
        for whole in batches:
            for batch in slices(whole):
                keep = []
                for i, (x, y, t, u) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(4)])):
                    if x != last:
                        last, last_set = x, shingle_set(t, width)
                    if y not in seen:
                        if len(seen) >= 64:
                            seen.clear()
                        seen[y] = shingle_set(u, width)
                    if linked(last_set, seen[y], percent):
                        keep.append(i)
                keep = pa.array(keep, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(releasing(run), "a long, b long")


def overlaps(own: np.ndarray, tokens: np.ndarray, owner: np.ndarray, sets: int) -> np.ndarray:
    """Tokens that ``own`` shares with each of ``sets`` sets, whose sorted ``tokens`` have the given owners."""
    low, many = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
    many -= low
    at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
    return np.bincount(owner[at], minlength=sets)


def _first_links(scratch: Scratch, opened: DataFrame, member: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """At most one linked pair ``(a, b)`` for every row of ``opened(cls, component, part)``, b a member of that part.

    A part is a piece of one component, so one link joins a class to all of it;
    pairs are compared inside the part and never made.  Classes that ask for
    one part are dealt out in bounded chunks.
    """
    chunks = opened.groupBy("component", "part").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("chunks"))
    chunks = scratch.write(chunks, "chunks")
    asked = opened.join(chunks, ["component", "part"]).withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    held = member.join(chunks, ["component", "part"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    both = scratch.write(asked.select("cls", "component", "part", "chunk", F.lit(True).alias("asks")).unionByName(
        held.select("cls", "component", "part", "chunk", F.lit(False).alias("asks"))), "asked")
    # written, so that Spark knows its size and deals out all texts only where it is too large to broadcast
    ids = scratch.write(both.select(F.col("cls").alias("doc_id")).distinct(), "ids")
    texts = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    told = both.join(texts.withColumnRenamed("doc_id", "cls"), "cls")

    def find(rows: pa.Table) -> pa.Table:
        names, asks, sets = rows.column("cls").to_pylist(), rows.column("asks").to_pylist(), [shingle_set(t, width) for t in rows.column("text").to_pylist()]
        inside = [i for i, x in enumerate(asks) if not x]
        tokens = np.concatenate([sets[i] for i in inside] or [np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(inside)), [len(sets[i]) for i in inside])
        order = np.argsort(tokens, kind="stable")
        tokens, owner, sizes = tokens[order], owner[order], np.array([len(sets[i]) for i in inside], np.int64)
        a, b = [], []
        for i in (i for i, x in enumerate(asks) if x):
            both = overlaps(sets[i], tokens, owner, len(inside))
            found = np.flatnonzero(100 * both >= percent * (len(sets[i]) + sizes - both))
            if len(found):
                a.append(names[i])
                b.append(names[inside[found[0]]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return told.select("component", "part", "chunk", "cls", "asks", "text").groupBy("component", "part", "chunk").applyInArrow(find, "a long, b long")


def _meetings(scratch: Scratch, index: DataFrame, percent: int) -> DataFrame:
    """Rows ``(cls, other)``: classes and groups of other classes that may link, once per token by which they meet.

    ``index`` holds, per class and prefix token that classes of different
    groups share, the token's place among those of the class, frequent ones
    first, and whether it is ``rare``.  Of the tokens that the prefixes of a
    pair share, the rarest has a place of their number at least in both
    classes, and is rare in both.
    """
    # tokens that the same classes would meet by bring the same pairs together: they meet by the rarest of these only,
    # which has the last place with all of them; the bounds below hold at any token that a pair shares
    same = index.where("rare").groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.max("held").alias("held"), F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("cls")).alias("s1"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("s2"))
    same = same.where("low < high").groupBy("m", "s1", "s2").agg(F.max(F.struct(-F.col("held"), "token"))["token"].alias("token")).select("token")
    meeting = scratch.write(index.where("rare").drop("rare", "held").join(same, "token", "left_semi"), "meeting")
    groups = scratch.write(meeting.groupBy("token", F.col("component").alias("other")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("largest").alias("reach"), F.max("place").alias("last"),
        F.max("nth").alias("most"), F.max("rest").alias("left")), "matrix")
    # a pair shares no more than its tokens up to this one and those after it allow
    overlap = F.least("nth", "most") + F.least("rest", "left")
    # the prefix that ends first is shared whole but for tokens that only one has, which are no more than sizes allow;
    # so prefixes share this many tokens at least, by the sizes in the group
    part, less = percent / (100 + percent), (5 * percent - 100) / 400
    shared = F.least(part * (F.col("n") + F.col("low")) - less * F.col("n"), part * F.col("n") + (part - less) * F.col("low"),
                     part * F.col("n") + (part - less) * F.col("high")) - 1
    return meeting.join(groups, "token").where(
        (F.col("component") > F.col("other")) & (F.least("place", "last") >= shared)
        & (100 * F.col("n") >= percent * F.col("low")) & (percent * F.col("n") <= 100 * F.col("high"))
        & (F.col("low") <= F.col("largest")) & (F.col("n") <= F.col("reach"))
        & ((100 + percent) * overlap >= percent * (F.col("n") + F.col("low")))).select("cls", "other")


def jaccard_components(df: DataFrame, width: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id)``, one per input row.

    Two documents link when 100 * |A & B| >= percent * |A | B| over their sets
    of shingles; component_id is the smallest doc_id reachable by links, itself
    included.  Words are the runs of bytes other than ASCII white space, with
    A-Z lower-cased.  Null, empty and white-space texts have an empty set, link
    with nothing and are their own component.  Equal texts (copies, repeated
    rows) link; if rows with one key differ in text, any one of them stands
    for the key.  Rows with a null key are returned with a null component and
    link nothing.  Other columns are ignored.  An empty table gives no rows.
    Sets are compared as 64-bit hashes of their shingles.
    """
    scratch = Scratch(df.sparkSession, "jaccard")
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = scratch.write(_signatures(docs, width, percent, _sketch(docs, width)), "signed")
    one = signed.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("cls"))
    one = scratch.write(one, "classes")
    # a class's prefix, from its representative row (repeated rows of it are equal or another class)
    sets = signed.where("n > 0").join(one.select(F.col("cls").alias("doc_id"), "n", "s1", "s2"), ["doc_id", "n", "s1", "s2"])
    sets = scratch.write(sets.dropDuplicates(["doc_id", "n", "s1", "s2"]).select(F.col("doc_id").alias("cls"), "n", "prefix", "bits"), "sets")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """The linked rows of ``pairs(a, b)``; only texts of pairs that the bitmaps let through are dealt out."""
        close = scratch.write(_possible(pairs, sets, percent), name + "_close")
        # written, so that Spark knows its size and deals out all texts only where it is too large to broadcast
        ids = scratch.write(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), name + "_ids")
        texts = scratch.write(docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), name + "_texts")
        out = scratch.write(_verify(close, texts, width, percent), name)
        scratch.drop(close, ids, texts)
        return out

    # Prefix tokens that classes share.  A partner shares k of them at least, so its last one is not before the k-th that
    # any class has; the tokens passed over until there are not the partner's.  That bounds overlap and partner's size.
    index = sets.select("cls", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = scratch.write(index.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token"), "tokens")
    own = Window.partitionBy("cls")
    k = 1 + F.floor(F.ceil(F.col("n") * percent / 100) * (100 - percent) / 400)
    index = (index.join(shared, "token", "left_semi").withColumns({"nth": F.row_number().over(own.orderBy("pos")), "m": F.count(F.lit(1)).over(own)})
             .withColumn("overlap", F.max(F.when(F.col("nth") == k, k - 1 + F.col("n") - F.col("pos"))).over(own))
             .withColumn("largest", F.expr(f"overlap * {100 + percent} div {percent} - n")).where(100 * F.col("largest") >= percent * F.col("n")))
    key = (F.col("nth") <= LEADER_KEYS) | (F.col("nth") > F.col("m") - LEADER_KEYS)
    index = index.withColumn("rest", F.col("n") - F.col("pos") - 1)
    index = scratch.write(index.select("cls", "n", "largest", "token", "nth", "rest", (F.col("n") - F.col("overlap")).alias("passed"), key.alias("key")), "sharing")

    # groups: links with a leader per key, the class that passed the fewest tokens over and so can be close to most
    keys = index.where("key").select("cls", "token", "passed")
    leaders = keys.groupBy("token").agg(F.min(F.struct("passed", F.xxhash64("cls", "token").alias("h"), F.col("cls").alias("leader"))).alias("x"),
                                        F.count(F.lit(1)).alias("m")).where("m > 1").select("token", F.col("x.leader").alias("leader"))
    leaders = scratch.write(leaders, "leaders")
    star = links(keys.join(leaders, "token").where("cls <> leader").select(F.col("cls").alias("a"), F.col("leader").alias("b")).distinct(), "star")
    grouped = components(scratch, star)
    sharing = index
    index = (index.drop("passed", "key").join(grouped.select(F.col("node").alias("cls"), "component"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")))

    # tokens that classes of different groups share, and the groups that a class meets by them
    shared = scratch.write(index.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("held"))
                           .where("low < high").select("token", "held"), "shared")
    index = scratch.write(index.join(shared, "token").withColumn("place", F.row_number().over(own.orderBy(F.desc("held"), "token")))
                          .withColumn("rare", F.col("place") >= k), "index")
    met = scratch.write(_meetings(scratch, index, percent).distinct(), "met")
    able = scratch.write(index.select("cls", "n", "component").distinct(), "able")
    scratch.drop(index, sharing, shared)

    # parts of the groups that are met, their unions, the bound, and the members of what it lets through
    wanted = met.select(F.col("other").alias("component")).distinct()
    inner = able.join(wanted, "component", "left_semi")
    parts = scratch.write(inner.groupBy("component").agg(F.ceil(F.sum("n") / PART_TOKENS).alias("parts")), "parts")
    member = scratch.write(inner.join(parts, "component").select(
        "cls", "component", F.pmod(F.xxhash64("cls"), F.col("parts")).alias("part")), "members")

    def union(rows: pa.Table) -> pa.Table:
        maps = [np.frombuffer(x, np.uint64) for x in rows.column("bits").to_pylist()]
        size = min(map(len, maps))
        out = np.bitwise_or.reduce([narrowed(x, size) for x in maps])
        return rows.slice(0, 1).select(["component", "part"]).append_column("tokens", pa.array([out.tobytes()], pa.binary()))

    bits = sets.select("cls", "n", "bits")
    unions = scratch.write(member.join(bits, "cls").select("component", "part", "bits").groupBy("component", "part")
                           .applyInArrow(union, "component long, part long, tokens binary"), "unions")

    def bound(batches):
        for b in (b for whole in batches for b in slices(whole)):
            keep = [i for i, (n, x, u) in enumerate(zip(*[b.column(c).to_pylist() for c in range(3, 6)]))
                    if n - only_in(x, u)[0] >= least_overlap(n, percent)]
            yield pa.RecordBatch.from_arrays([b.column(i).take(pa.array(keep, pa.int32())) for i in range(3)], names=["cls", "component", "part"])

    asked = met.withColumnRenamed("other", "component").join(unions, "component").join(bits, "cls")
    opened = scratch.write(asked.select("cls", "component", "part", "n", "bits", "tokens").mapInArrow(releasing(bound), "cls long, component long, part long"), "opened")
    more = scratch.write(_first_links(scratch, opened, member, docs, width, percent), "more")
    scratch.drop(unions, opened, sets, leaders, member, met, parts, able)

    whole = components(scratch, star.unionByName(more)).select(F.col("node").alias("cls"), "component")
    final = scratch.write(one.join(whole, "cls", "left").select("n", "s1", "s2", F.coalesce("component", "cls").alias("component_id")), "final")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return signed.select("doc_id", "n", "s1", "s2").join(final, ["n", "s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
