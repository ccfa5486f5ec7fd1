"""Near-duplicate embeddings by cover trees and dual traversal.

Vectors are scaled to length 1; two are near duplicates when their cosine is at
least ``cosine``, that is when their distance is at most sqrt(2 - 2 cosine).  Equal
vectors are taken as one, with their number.  The upper levels of the tree are
distributed: all vectors of one dimension are a cell, and one of more than a bundle's
size is divided by pivots, one for each ``cell`` vectors, each vector going to the
nearest one.  A pivot's covering radius is the distance of the farthest of its own.
Cells side by side make a bundle; a cell larger than a bundle is divided again, or
dealt over several bundles if pivots don't tell its vectors apart.  Of each two bundles
one is visited by vectors of the other: by those within the covering radius plus the
threshold of one of its pivots, each once however many of its cells it may reach.
One task sees a bundle's own vectors as a whole and its visitors in runs, so its memory
grows neither with the table nor with the number of visitors.  Trees of nested levels
with halving radii are built over the own vectors and over each run.  Pairs of
nodes are pruned where the distance of their centres exceeds both covering radii
plus the threshold, and taken as a whole where even their farthest points lie within
it.  Links are exact, each found in one bundle.  A node whose points fall into too many
groups at the next level that separates them stays a leaf, and is compared as a whole.

Null ids, null vectors, vectors with a null or non-finite value or of length zero
take no part and get no row.  Vectors of different dimensions are never near.  Of
rows with the same vec_id the first in value order counts.  Other columns, whatever
their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import mix, stored
from .simhash import components

COSINE = 0.95
CELL = 4096
PIVOTS = 4096
BUNDLE = 1 << 17
BUNDLE_BYTES = 32 << 20
MOST_AT_ONCE = 31
RUN = 1 << 13
BLOCK = 256, 512
BRIEF = 19
BROADCAST_ROWS = 200_000
LEAF = 48
FAN_OUT = 64
SAFETY = 2e-3  # float32: of two vectors nearly the same the distance may come out that much off


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, all of a to all of b."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Tree:
    """Nested levels over unit vectors: nodes hold a centre, a covering radius, children or points."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        self.root = self._node(np.arange(len(x)), 0, 2.0, leaf) if len(x) else -1

    @cached_property
    def brief(self) -> np.ndarray:
        """The first values of each vector and the length of the rest: the product of two of these is at least that of the vectors."""
        return np.column_stack([self.x[:, :BRIEF], np.linalg.norm(self.x[:, BRIEF:], axis=1)])

    def _node(self, members: np.ndarray, centre: int, scale: float, leaf: int) -> int:
        at = len(self.centre)
        away = _distance(self.x[members], self.x[centre : centre + 1])[:, 0]
        self.centre.append(centre)
        self.radius.append(float(away.max()))
        self.children.append([])
        self.points.append(members)
        if len(members) <= leaf or away.max() < 1e-6:
            return at
        most = max(FAN_OUT, int(len(members) ** 0.5))
        while True:  # the next level that tells members apart
            scale /= 2
            some = members[:: max(1, len(members) // (8 * most))]
            groups = None if self._groups(some, centre, scale, most) is None else self._groups(members, centre, scale, most)
            if groups is None:  # almost all lie farther apart than this level's radius: no smaller level separates them
                return at
            if len(groups) > 1:
                break
        self.points[at] = members[:0]
        self.children[at] = [self._node(g, c, scale, leaf) for g, c in groups]
        return at

    def _groups(self, left: np.ndarray, near: int, scale: float, most: int) -> list[tuple[np.ndarray, int]] | None:
        """Members within ``scale`` of one centre after the other, with it; None if that makes more than ``most`` groups."""
        groups = []
        while len(left):
            d = _distance(self.x[left], self.x[near : near + 1])[:, 0]
            inside = d <= scale
            inside[left == near] = True
            groups.append((left[inside], near))
            left = left[~inside]
            if len(left):
                if len(groups) > most:
                    return None
                near = int(left[0])
        return groups

    def below(self, node: int) -> np.ndarray:
        """All points of a node."""
        found, stack = [], [node]
        while stack:
            k = stack.pop()
            found.append(self.points[k])
            stack += self.children[k]
        return np.concatenate(found)


def dual_pairs(a: Tree, b: Tree, reach: float, cosine: float):
    """Index pairs (of a, of b) whose vectors are within the threshold; with b = a, each pair once."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j, whole in _traverse(a, b, reach, cosine):
        if whole:
            x, y = i, j
            i, j = np.repeat(x, len(y)), np.tile(y, len(x))
            if x is y:
                i, j = i[i < j], j[i < j]
        left.append(i)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _traverse(a: Tree, b: Tree, reach: float, cosine: float):
    """Yields (rows of a, rows of b, whether all of one are near all of the other, else near pairs), none twice; the same array twice stands for the pairs within it."""
    if a.root < 0 or b.root < 0:
        return
    same = a is b
    stack = [(a.root, b.root)]
    while stack:
        p, q = stack.pop()
        alike = same and p == q
        gap = 0.0 if alike else float(np.sqrt(max(0.0, 2 - 2 * float(a.x[a.centre[p]] @ b.x[b.centre[q]]))))
        if gap > a.radius[p] + b.radius[q] + reach + SAFETY:
            continue
        if gap + a.radius[p] + b.radius[q] < reach - SAFETY:
            x = a.below(p)
            yield x, x if alike else b.below(q), True
        elif not a.children[p] and not b.children[q]:
            for x, y in _compared(a, a.points[p], b, b.points[q], alike, cosine):
                yield x, y, False
        elif alike:
            kids = a.children[p]
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif a.children[p] and (not b.children[q] or a.radius[p] >= b.radius[q]):
            stack += [(k, q) for k in a.children[p]]
        else:
            stack += [(p, k) for k in b.children[q]]


def _compared(a: Tree, x: np.ndarray, b: Tree, y: np.ndarray, alike: bool, cosine: float):
    """Yields (rows of a, rows of b), the near pairs of the points x and y of two leaves, block by block; of a leaf with itself each pair once."""
    few = lambda table, rows: table if len(rows) == len(table) else table[rows]
    u, v = few(a.x, x), few(b.x, y)
    brief = min(len(x), len(y)) >= BLOCK[0] and u.shape[1] > 2 * BRIEF
    if brief:
        s, t = few(a.brief, x), few(b.brief, y)
    most = min(BLOCK[0], len(x)) * min(BLOCK[1], len(y))
    value, reached = np.empty(most, np.float32), np.empty(most, bool)

    def least(p: np.ndarray, q: np.ndarray, bound: float) -> np.ndarray:
        """Places in the flat matrix of products where they come to ``bound``."""
        size = len(p) * len(q)
        np.matmul(p, q.T, out=value[:size].reshape(len(p), len(q)))
        np.greater_equal(value[:size], bound, out=reached[:size])
        if size % 8:
            return np.flatnonzero(reached[:size])
        eight = np.flatnonzero(reached[:size].view(np.uint64))  # few are true: eight at a time first
        i, j = np.nonzero(reached[:size].reshape(-1, 8)[eight])
        return 8 * eight[i] + j

    for k in range(0, len(x), BLOCK[0]):
        rows = slice(k, k + BLOCK[0])
        for m in range(k if alike else 0, len(y), BLOCK[1]):
            others = slice(m, m + BLOCK[1])
            wide = len(y[others])
            if brief:
                at = least(s[rows], t[others], cosine - SAFETY)
                brief = len(at) <= len(x[rows]) * wide // 16  # if it leaves too many: whole vectors from here on
            if not brief:
                at = least(u[rows], v[others], cosine)
            if not len(at):
                continue
            i, j = np.divmod(at, wide)
            if brief:
                near = np.einsum("ij,ij->i", u[rows][i], v[others][j]) >= cosine
                i, j = i[near], j[near]
            if alike and m == k:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield x[rows][i], y[others][j]


def _united(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the least index of a group) after the groups of i and j are made one, pair by pair."""
    while True:
        x, y = label[i], label[j]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if np.array_equal(low, high):
            return label
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


class Bundle:
    """A bundle's own vectors (``number`` equal ones each) with their links and groups, as far as they have met others."""

    def __init__(self, x: np.ndarray, number: np.ndarray, reach: float, cosine: float):
        self.tree, self.number, self.reach, self.cosine = Tree(x), number, reach, cosine
        self.links, self.label = number * 0, np.arange(len(x))
        self._meet(self.tree, number, self.links, self.label, 0)

    def visited(self, x: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(links, an own vector of the group) of each visitor; the latter means nothing without links."""
        own, links = len(self.label), number * 0
        label = np.append(self.label, np.arange(own, own + len(x)))
        return links, self._meet(Tree(x), number, links, label, own)[own:]

    def _meet(self, other: Tree, number: np.ndarray, links: np.ndarray, label: np.ndarray, first: int) -> np.ndarray:
        """Adds the links between own vectors and others; labels after their groups are made one."""
        pairs, waiting = [], 0
        for p, q, whole in _traverse(self.tree, other, self.reach, self.cosine):
            if whole:
                self.links[p] += number[q].sum()
                if p is q:
                    self.links[p] -= number[p]
                else:
                    links[q] += self.number[p].sum()
                i, j = np.append(p, np.full(len(q), p[0])), np.append(np.full(len(p), q[0]), q)
            else:
                i, j = p, q
                np.add.at(self.links, i, number[j])
                np.add.at(links, j, self.number[i])
            pairs.append((i, j + first))
            waiting += len(i)
            if waiting > 1 << 20:
                label, pairs, waiting = _united(label, *map(np.concatenate, zip(*pairs))), [], 0
        if pairs:
            label = _united(label, *map(np.concatenate, zip(*pairs)))
        self.label = label[: len(self.label)]
        return label


def _vectors(x: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(x, np.float32)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * flat.shape[1]), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _numbers(column: pa.BinaryArray) -> np.ndarray:
    """Vectors of one dimension; a view where Arrow's buffer can serve as one."""
    if not len(column):
        return np.zeros((0, 0), np.float32)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(len(column), -1)


def _units(vectors: DataFrame) -> DataFrame:
    """(vec_id, d, vector): valid vectors at length 1, one for each vec_id."""
    value = F.col("embedding")
    whole = F.col("vec_id").isNotNull() & value.isNotNull() & F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e30)) & F.exists(value, lambda v: v != 0)
    rows = vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    repeated = stored(rows.groupBy("vec_id").agg(F.count("*").alias("rows")).where("rows > 1").select("vec_id"))
    many = repeated.count()
    first = lambda df: df.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    if many > BROADCAST_ROWS:
        rows = first(rows)
    elif many:  # only rows of repeated ids are shuffled
        repeated = F.broadcast(repeated)
        rows = rows.join(repeated, "vec_id", "left_anti").unionByName(first(rows.join(repeated, "vec_id", "left_semi")))

    def unit(batches):
        for batch in batches:
            size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                x = _matrix(part.column(1))
                x = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(x), d, np.int32)), _vectors(x)], names=["vec_id", "d", "vector"])

    return rows.mapInArrow(unit, "vec_id long, d int, vector binary")


def _bundled(size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first bundle, bundles) of cells of these sizes.

    In this order cells of up to ``most`` vectors lie side by side in bundles of about as many, and
    each larger one is a bundle of its own, or dealt over several where it holds over half of all.
    """
    small, large = np.flatnonzero(size <= most), np.flatnonzero(size > most)
    first, dealt = np.zeros(len(size), np.int64), np.ones(len(size), np.int64)
    used, total = 0, int(size[small].sum())
    if total:
        used = -(-total // most)
        middle = np.cumsum(size[small]) - size[small] / 2
        first[small] = np.unique((middle * used / total).astype(np.int64), return_inverse=True)[1]
        used = int(first[small].max()) + 1
    dealt[large] = np.where(2 * size[large] > size.sum(), -(-size[large] // most), 1)
    first[large] = used + np.cumsum(dealt[large]) - dealt[large]
    return np.append(small, large), first, dealt


def _by_place(batch: pa.RecordBatch):
    """(place, its rows) for each place in a batch."""
    place = batch.column("place").to_numpy()
    for k in np.unique(place):
        mine = place == k
        yield int(k), batch if mine.all() else batch.filter(pa.array(mine))


def _divided(rows: DataFrame, size: dict[int, tuple[int, int]], cell: int, pivots: int, reach: float) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(places, vec_id, n, vector) with each bundle of too many own vectors divided, and the new bundles' sizes where they need it again.

    ``size`` has own vectors of each bundle (0: done) and how many it may have.

    A place is twice the number of a bundle, and one more for visitors.  Bundles get new numbers, from 0.
    """
    spark = rows.sparkSession
    wanted = {k: min(pivots, -(-n // cell)) for k, (n, most) in size.items() if n > most}
    held = {}
    if wanted:
        limit = F.broadcast(spark.createDataFrame([(2 * k, n) for k, n in wanted.items()], "place long, wanted int"))
        order = W.partitionBy("place").orderBy(F.xxhash64("vec_id"), "vec_id")
        chosen = rows.join(limit, "place").withColumn("at", F.row_number().over(order)).where((F.col("at") <= max(wanted.values())) & (F.col("at") <= F.col("wanted")))
        found = {}
        for r in chosen.select("place", "vector").collect():  # one for each ``cell`` vectors, on the driver
            found.setdefault(r.place // 2, []).append(np.frombuffer(r.vector, np.float32))
        held = {k: np.stack(v) for k, v in found.items()}
    sent = spark.sparkContext.broadcast(held)

    def nearest(x, p):
        """(rows, distances to all pivots), a few rows at a time."""
        step = RUN // 4
        for k in range(0, len(x), step):
            yield np.arange(k, min(k + step, len(x))), _distance(x[k : k + step], p)

    def tally(batches):
        for batch in batches:
            for place, part in _by_place(batch):
                p = sent.value.get(place // 2)
                if p is None or place & 1:
                    continue
                radius, own = np.zeros(len(p), np.float32), np.zeros(len(p), np.int64)
                for _, d in nearest(_numbers(part.column("vector")), p):
                    at = d.argmin(axis=1)
                    np.maximum.at(radius, at, d.min(axis=1))
                    np.add.at(own, at, 1)
                some = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), place // 2, np.int64)), pa.array(some), pa.array(own[some]), pa.array(radius[some])], names=["bundle", "at", "own", "radius"])

    counted = {}
    if held:
        for r in rows.select("place", "vector").mapInArrow(tally, "bundle long, at long, own long, radius float").groupBy("bundle", "at").agg(F.sum("own").alias("own"), F.max("radius").alias("radius")).collect():
            counted.setdefault(r.bundle, []).append((r.at, r.own, r.radius))
    plan, again, used = {}, {}, 0
    for k, (_, most) in sorted(size.items()):
        if k not in held:
            plan[k], again[used], used = (used, None), (0, most), used + 1
            continue
        at, own, radius = (np.array(c) for c in zip(*sorted(counted[k])))
        order, first, dealt = _bundled(own, most)
        columns = np.repeat(order, dealt[order])
        bundle = np.concatenate([first[c] + np.arange(dealt[c]) for c in order])
        starts = np.flatnonzero(np.diff(bundle, prepend=-1))
        plan[k] = used, (held[k][at], radius.astype(np.float32) + np.float32(reach + SAFETY), columns, starts, first, dealt)
        again |= {used + b: (0, most) for b in range(len(starts))}
        again |= {used + int(first[c]): (int(own[c]), most) for c in np.flatnonzero((own > most) & (dealt == 1))}
        used += len(starts)
    planned = spark.sparkContext.broadcast(plan)

    def visit(batches):
        for batch in batches:
            for place, part in _by_place(batch):
                base, split = planned.value[place // 2]
                if split is None:
                    counts, places = np.ones(len(part), np.int64), np.full(len(part), 2 * base + (place & 1))
                else:
                    p, within, columns, starts, first, dealt = split
                    turn = mix(part.column("vec_id").to_numpy().view(np.uint64), 3)
                    bundles, counts, places = np.arange(len(starts)), [], []
                    for k, d in nearest(_numbers(part.column("vector")), p):
                        to = np.logical_or.reduceat((d <= within[None, :])[:, columns], starts, axis=1)
                        if not place & 1:  # of two bundles one is visited
                            at = d.argmin(axis=1)
                            home = (first[at] + (turn[k] % dealt[at].astype(np.uint64)).astype(np.int64))[:, None]
                            ahead = (home - bundles) % len(bundles)
                            to &= (ahead > 0) & ((2 * ahead < len(bundles)) | ((2 * ahead == len(bundles)) & (bundles < home)))
                            to |= home == bundles
                        i, j = np.nonzero(to)
                        counts.append(to.sum(axis=1))
                        places.append(2 * (base + j) + ((place & 1) | (j != home[i, 0]) if not place & 1 else 1))
                    counts, places = np.concatenate(counts), np.concatenate(places)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(places.astype(np.int64))), *(part.column(c) for c in ("vec_id", "n", "vector"))], names=["places", "vec_id", "n", "vector"])

    return rows.select("place", "vec_id", "n", "vector").mapInArrow(visit, "places array<long>, vec_id long, n long, vector binary"), again


def _cells(units: DataFrame, cell: int, pivots: int, reach: float, most: int = BUNDLE) -> DataFrame:
    """Rows (vec_id, d, n, vector) as (place, vec_id, n, vector): a bundle's own vectors and then its visitors, all in one partition."""
    size = {r.d: r["count"] for r in units.groupBy("d").count().collect()}
    at_once = min(units.sparkSession.sparkContext.defaultParallelism, MOST_AT_ONCE)
    most = min(most, -(-sum(size.values()) // max(1, at_once - 1 + at_once % 2)))  # an odd number of bundles, so that each is visited by as many others
    size = {d: (n, max(cell, min(most, BUNDLE_BYTES // (4 * d)))) for d, n in size.items()}
    rows = units.select((2 * F.col("d").cast("long")).alias("place"), "vec_id", "n", "vector")
    while True:
        placed, size = _divided(rows, size, cell, pivots, reach)
        done = all(n <= most for n, most in size.values())
        if not done:
            placed = stored(placed)
        rows = placed.select(F.explode("places").alias("place"), "vec_id", "n", "vector")
        if done:
            break
    tasks = max(1, min(len(size), 4096))
    return rows.repartitionById(tasks, (F.shiftright("place", 1) % tasks).cast("int")).sortWithinPartitions("place")


def _runs(batches):
    """(place, ids, numbers, vectors): a bundle's own vectors as a whole, by vec_id, and then its visitors, ``RUN`` at most at once."""
    now, held, count = None, [], 0

    def taken():
        ids, n, x = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(ids, kind="stable")
        return now, ids[order], n[order], x[order]

    for batch in batches:
        place, ids, n = (batch.column(c).to_numpy() for c in ("place", "vec_id", "n"))
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1), len(place)]
        for k, end in zip(cuts, cuts[1:]):
            while k < end:
                if held and (place[k] != now or (now & 1 and count == RUN)):
                    yield taken()
                    held, count = [], 0
                now = int(place[k])
                to = min(end, k + RUN - count) if now & 1 else end
                held.append((ids[k:to].copy(), n[k:to].copy(), _numbers(batch.column("vector").slice(k, to - k)).copy()))
                count, k = count + to - k, to
    if held:
        yield taken()


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, class_id, links) for every valid vector.

    ``links`` is the number of other vectors with at least this cosine, ``class_id`` the least
    vec_id among those that links lead to, step by step; a vector without links is its own class.
    """
    reach = float(np.sqrt(2 - 2 * cosine))
    held = stored(_units(vectors).withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector")}))
    alike = stored(held.groupBy("d", "h", "g").agg(F.min("vec_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    many = alike.count()
    near = F.broadcast if many <= BROADCAST_ROWS else lambda df: df
    once = held.join(near(alike), ["d", "h", "g"], "left").where("first IS NULL OR vec_id = first").select("vec_id", "d", F.coalesce("n", F.lit(1)).alias("n"), "vector")
    if many > BROADCAST_ROWS:
        once = stored(once)

    def meet(batches):
        def result(ids, links, root):
            some = np.flatnonzero(links > 0)
            return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(root[some])], names=["vec_id", "links", "root"])

        bundle = own = None
        for place, ids, n, x in _runs(batches):
            if place & 1:
                links, group = bundle.visited(x, n)
                some = np.flatnonzero(links > 0)
                yield result(ids[some], links[some], own[group[some]])
                continue
            if bundle is not None:
                yield result(own, bundle.links, own[bundle.label])
            bundle, own = Bundle(x, n, reach, cosine), ids
        if bundle is not None:
            yield result(own, bundle.links, own[bundle.label])

    found = stored(_cells(once, cell, pivots, reach).mapInArrow(meet, "vec_id long, links long, root long"))
    classes = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("doc_id", "vec_id")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    first = once.select("vec_id", "n").join(links, "vec_id", "left").join(classes, "vec_id", "left")
    first = first.select("vec_id", "n", F.coalesce("group_id", "vec_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    columns = ["vec_id", "class_id", "links"]
    if not many:
        return first.select(*columns)
    copied = stored(alike.select("d", "h", "g", "first").join(first.select(F.col("vec_id").alias("first"), "class_id", "links"), "first"))
    copies = held.join(near(copied), ["d", "h", "g"]).where("vec_id <> first")
    return first.select(*columns).unionByName(copies.select(*columns))


def near_pairs(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id_a, vec_id_b, cosine), vec_id_a < vec_id_b: every pair with at least this cosine, equal vectors included.

    For sets with few copies: ``near_duplicates`` gives classes and numbers of links in one row a vector.
    """
    reach = float(np.sqrt(2 - 2 * cosine))

    def meet(batches):
        for place, ids, _, x in _runs(batches):
            if not place & 1:
                own, tree = ids, Tree(x)
            a, b = dual_pairs(tree, Tree(x) if place & 1 else tree, reach, cosine)
            value = np.einsum("ij,ij->i", tree.x[a], x[b]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.minimum(own[a], ids[b]), np.maximum(own[a], ids[b]), value)], names=["vec_id_a", "vec_id_b", "cosine"])

    units = stored(_units(vectors)).withColumn("n", F.lit(1).cast("long"))
    return _cells(units, cell, pivots, reach).mapInArrow(meet, "vec_id_a long, vec_id_b long, cosine double").withColumn("cosine", F.round("cosine", 4))


ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
SELECT v.vec_id, (SELECT min(b) FROM reach r WHERE r.a = v.vec_id) AS class_id, (SELECT count(*) FROM pairs p WHERE p.a = v.vec_id) AS links FROM v
"""
