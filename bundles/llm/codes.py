"""Vector codes by exact Lloyd rounds over metric trees (operator 12).

Vectors of integers are cut into equal parts; each part position has a codebook
of a few entries.  Rows are held in blocks of bounded size, and each block has,
for every part position, a metric tree built once by the anchors hierarchy:
anchors are grown by taking the point farthest from its anchor as the next one,
which steals points from others (only points farther from their anchor than
half the distance between the two anchors can be stolen); the balls of the
anchors are then merged pair by pair into their common parents (middle-out),
and each anchor's own points are split the same way.  Every ball caches the sum
and the count of its points.

A round sends the codebooks down each tree with a list of candidate entries
that a ball inherits from its parent and shrinks: an entry is struck off when
another one is nearer for every point of the ball.  A ball with one candidate
left is owned: its cached sum and count go to that entry and nothing below is
visited.  Only leaves with several candidates compare points, in exact integer
arithmetic.  A round's output is one row per task, part and entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .whitening import entries

#: Rows of a block and points of a leaf; neither changes a result.
BLOCK, LEAF = 4096, 24
#: Components are cut to this, so that squared distances are exact in 64 bits.
LIMIT = 2.0**27
#: Relative slack on the bounds of a ball, above all rounding.
SLACK = 1e-9


def anchors(x: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
    """``own`` (positions in ``x``) dealt to about sqrt(n) anchors by farthest points and stealing."""
    points = x[own]
    pivot = [points[0]]
    owner = np.zeros(len(own), np.int64)
    far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    for k in range(1, max(2, int(len(own) ** 0.5))):
        at = int(far.argmax())
        if far[at] == 0:
            break
        new = points[at]
        between = np.sqrt(((np.array(pivot) - new) ** 2).sum(axis=1))
        maybe = np.flatnonzero(far > between[owner] / 2 * (1 - SLACK))
        near = np.sqrt(((points[maybe] - new) ** 2).sum(axis=1))
        stolen = near < far[maybe]
        owner[maybe[stolen]], far[maybe[stolen]] = k, near[stolen]
        pivot.append(new)
    return [own[owner == k] for k in range(len(pivot)) if (owner == k).any()]


class Tree:
    """Flat arrays: a node's points are ``order[start:end]``; children are -1 at a leaf."""

    FIELDS = (("order", "<i4"), ("start", "<i4"), ("end", "<i4"), ("left", "<i4"), ("right", "<i4"), ("radius", "<f8"), ("centre", "<f8"), ("sums", "<i8"))

    @classmethod
    def build(cls, q: np.ndarray) -> Tree:
        """The tree over the rows of ``q`` (integers)."""
        x = q.astype(np.float64)
        below: list = []  # per node: its points, or its two children

        def middle_out(balls: list[int], of: list[np.ndarray]) -> int:
            n = np.array([len(o) for o in of], np.float64)
            c = np.array([x[o].mean(axis=0) for o in of])
            r = np.array([np.sqrt(((x[o] - m) ** 2).sum(axis=1).max()) for o, m in zip(of, c)])

            def wide(i: int) -> np.ndarray:  # radius of the ball that holds ball i and each other one
                middle = (c * n[:, None] + c[i] * n[i]) / (n + n[i])[:, None]
                out = np.maximum(np.sqrt(((c - middle) ** 2).sum(axis=1)) + r, np.sqrt(((c[i] - middle) ** 2).sum(axis=1)) + r[i])
                out[i] = np.inf
                return out

            node, gone = list(balls), np.zeros(len(balls), bool)
            cost = np.array([wide(i) for i in range(len(balls))])
            for _ in range(len(balls) - 1):
                i, j = divmod(int(cost.argmin()), len(balls))
                r[i], c[i] = cost[i, j], (c[i] * n[i] + c[j] * n[j]) / (n[i] + n[j])
                n[i] += n[j]
                below.append((node[i], node[j]))
                node[i], gone[j] = len(below) - 1, True
                cost[j], cost[:, j] = np.inf, np.inf
                cost[i] = cost[:, i] = np.where(gone, np.inf, wide(i))
            return len(below) - 1

        def grow(own: np.ndarray) -> int:
            dealt = anchors(x, own) if len(own) > LEAF else [own]
            if len(dealt) == 1:  # few points, or all of them equal
                below.append(own)
                return len(below) - 1
            return middle_out([grow(o) for o in dealt], dealt)

        root = grow(np.arange(len(q)))
        # nodes anew from the root, so that every node's points are consecutive
        order, start, end, left, right = [], [], [], [], []
        at, todo = 0, [(root, -1, False)]
        while todo:
            node, parent, is_right = todo.pop()
            me = len(start)
            if parent >= 0:
                (right if is_right else left)[parent] = me
            start.append(at)
            left.append(-1)
            right.append(-1)
            end.append(-1)
            if isinstance(below[node], tuple):
                todo += [(below[node][1], me, True), (below[node][0], me, False)]
            else:
                order.append(below[node])
                at += len(below[node])
                end[me] = at
        for me in range(len(start) - 1, -1, -1):
            if end[me] < 0:
                end[me] = end[right[me]]
        tree = cls()
        tree.order = np.concatenate(order).astype("<i4")
        tree.start, tree.end, tree.left, tree.right = (np.array(a, "<i4") for a in (start, end, left, right))
        placed = q[tree.order]
        total = np.vstack([np.zeros((1, q.shape[1]), np.int64), np.cumsum(placed, axis=0, dtype=np.int64)])
        tree.sums = (total[tree.end] - total[tree.start]).astype("<i8")
        tree.centre = tree.sums / (tree.end - tree.start)[:, None]
        x = x[tree.order]
        tree.radius = np.array([np.sqrt(((x[a:b] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(start, tree.end, tree.centre)])
        return tree

    def dump(self) -> bytes:
        sizes = np.array([len(self.order), len(self.start)], "<i8").tobytes()
        return sizes + b"".join(np.ascontiguousarray(getattr(self, f), t).tobytes() for f, t in self.FIELDS)

    @classmethod
    def load(cls, data: bytes, width: int) -> Tree:
        tree, (points, nodes), at = cls(), np.frombuffer(data, "<i8", 2), 16
        for field, kind in cls.FIELDS:
            n = points if field == "order" else nodes * width if field in ("centre", "sums") else nodes
            value = np.frombuffer(data, kind, n, at)
            setattr(tree, field, value.reshape(-1, width) if field in ("centre", "sums") else value)
            at += value.nbytes
        return tree

    def descend(self, q: np.ndarray, codebook: np.ndarray):
        """``(owned nodes, their entries, points, their entries)``: every point is below one owned node or among the points."""
        book = codebook.astype(np.float64)
        apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(axis=2))
        same_later = np.triu((codebook[:, None] == codebook[None]).all(axis=2), 1)  # [o, j]: entry j equals o and ranks behind it
        nodes, open_ = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
        owned, owner, points, chosen = [], [], [], []
        while len(nodes):
            far = ((self.centre[nodes][:, None] - book[None]) ** 2).sum(axis=2)
            best = np.where(open_, far, np.inf).argmin(axis=1)
            mine = np.take_along_axis(far, best[:, None], 1)
            # largest value of |x - own|^2 - |x - other|^2 over the ball
            worst = mine - far + 2 * self.radius[nodes][:, None] * apart[best]
            open_ &= (worst >= -SLACK * (mine + far + 1)) & ~same_later[best]
            open_[np.arange(len(nodes)), best] = True
            single = open_.sum(axis=1) == 1
            owned.append(nodes[single])
            owner.append(best[single])
            leaf = ~single & (self.left[nodes] < 0)
            if leaf.any():
                at, many = nodes[leaf], (self.end - self.start)[nodes[leaf]]
                place = np.repeat(self.start[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
                row = self.order[place]
                choice = np.empty(len(row), np.int64)
                listed = np.repeat(open_[leaf], many, axis=0)
                for a in range(0, len(row), 8192):
                    exact = ((q[row[a:a + 8192], None] - codebook[None]) ** 2).sum(axis=2)
                    choice[a:a + 8192] = np.where(listed[a:a + 8192], exact, np.iinfo(np.int64).max).argmin(axis=1)
                points.append(row)
                chosen.append(choice)
            deeper = ~single & ~leaf
            nodes = np.concatenate([self.left[nodes[deeper]], self.right[nodes[deeper]]]).astype(np.int64)
            open_ = np.concatenate([open_[deeper], open_[deeper]])
        none = [np.zeros(0, np.int64)]
        return tuple(np.concatenate(a or none) for a in (owned, owner, points, chosen))

    def totals(self, q: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per entry, the sum and the count of the points nearest to it."""
        sums, counts = np.zeros(codebook.shape, np.int64), np.zeros(len(codebook), np.int64)
        nodes, owner, points, chosen = self.descend(q, codebook)
        np.add.at(sums, owner, self.sums[nodes])
        np.add.at(counts, owner, (self.end - self.start)[nodes])
        np.add.at(sums, chosen, q[points])
        np.add.at(counts, chosen, 1)
        return sums, counts

    def nearest(self, q: np.ndarray, codebook: np.ndarray) -> np.ndarray:
        """Every point's entry."""
        out = np.empty(len(q), np.int64)
        nodes, owner, points, chosen = self.descend(q, codebook)
        for n, o in zip(nodes, owner):
            out[self.order[self.start[n]:self.end[n]]] = o
        out[points] = chosen
        return out


def compress(df: DataFrame, parts: int = 8, size: int = 16, rounds: int = 6, scale: int = 4096,
             key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows ``(vec_id, code, error, label_error, codebooks_sha256)``, one per usable input row.

    A component x becomes the integer floor(scale * x), cut to +-2**27.  Rows
    whose vector is null, empty or holds null or non-finite components are left
    out.  Codebooks begin as the parts of the ``size`` smallest ids (equal ids by
    their integers, null ids last; fewer rows give fewer entries).  A vector
    whose length is no multiple of ``parts`` is filled up with zeros at its end;
    vectors of different lengths have codebooks of their own.  Ties go to the
    lower index; repeated rows count and are returned like all others.  Other
    columns are ignored; an empty table gives no rows.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "codes")
    v = F.col("vector")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                     F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.coalesce((F.size(v) > 0) & finite, F.lit(False)))
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c * scale))).cast("long"))
    filled = F.concat(F.col("q"), F.array_repeat(F.lit(0).cast("long"), (F.lit(parts) - F.size("q") % parts) % parts))
    rows = rows.select("vec_id", "label", F.size(v).alias("length"), whole.alias("q")).withColumn("q", filled)
    rows = scratch.write(rows, "integers")
    named = spark.createDataFrame([], f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long, codebooks_sha256 string")
    for r in sorted(rows.select("length").distinct().collect()):
        named = named.unionByName(_coded(scratch, rows.where(F.col("length") == r["length"]).drop("length"), parts, size, rounds, named.schema))
    named = scratch.write(named, "coded")
    whole = named.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return named.join(whole, named.label.eqNullSafe(whole.of)).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _coded(scratch: Scratch, rows: DataFrame, parts: int, size: int, rounds: int, schema) -> DataFrame:
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(size).select("q").collect()
    books = np.array([list(r["q"]) for r in first], np.int64)  # one line per entry
    d = books.shape[1]
    cut = [slice(d // parts * p, d // parts * (p + 1)) for p in range(parts)]

    def grow(batches):
        def block(held):
            q = np.concatenate([entries(b.column(2), d) for b in held])
            trees = [Tree.build(np.ascontiguousarray(q[:, s])).dump() for s in cut]
            own = pa.Table.from_batches(held).select(["vec_id", "label"]).combine_chunks()
            lists = [pa.array([own.column(i).to_pylist()], pa.list_(own.column(i).type)) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*lists, pa.array([q.astype("<i4").tobytes()]), pa.array([trees], pa.list_(pa.binary()))], names=["vec_id", "label", "q", "trees"])

        held, n = [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                held.append(b.slice(at, BLOCK - n))
                at, n = at + held[-1].num_rows, n + held[-1].num_rows
                if n == BLOCK:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    label = schema["label"].dataType.simpleString()
    blocks = scratch.write(rows.mapInArrow(grow, f"vec_id array<long>, label array<{label}>, q binary, trees array<binary>"), "blocks")

    def opened(b, i):
        q = np.frombuffer(b.column("q")[i].as_py(), "<i4").reshape(-1, d).astype(np.int64)
        for s, tree in zip(cut, b.column("trees")[i]):
            yield s, np.ascontiguousarray(q[:, s]), Tree.load(tree.as_py(), d // parts)

    for _ in range(rounds):
        def count(batches, books=books):
            sums, counts = np.zeros((parts, len(books), d // parts), np.int64), np.zeros((parts, len(books)), np.int64)
            for b in batches:
                for i in range(b.num_rows):
                    for p, (s, q, tree) in enumerate(opened(b, i)):
                        own = tree.totals(q, books[:, s])
                        sums[p] += own[0]
                        counts[p] += own[1]
            part, entry = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
                                              pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

        told = blocks.select("q", "trees").mapInArrow(count, "part int, entry int, n long, sums array<long>").groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(d // parts)]).collect()
        books = books.copy()
        for part, entry, n, *sums in told:
            books[entry, cut[part]] = [int(s) // n for s in sums]

    text = ",".join(str(c) for s in cut for line in books[:, s].tolist() for c in line)
    digest = hashlib.sha256(text.encode()).hexdigest()

    def code(batches):
        for b in batches:
            for i in range(b.num_rows):
                chosen, error = [], 0
                for s, q, tree in opened(b, i):
                    near = tree.nearest(q, books[:, s])
                    chosen.append(near)
                    error = error + ((q - books[near][:, s]) ** 2).sum(axis=1)
                codes = ["".join(f"{c:02x}" for c in line) for line in np.stack(chosen, axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id")[i].values, b.column("label")[i].values, pa.array(codes), pa.array(error), pa.array([digest] * len(codes))],
                    names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return blocks.mapInArrow(code, schema)
