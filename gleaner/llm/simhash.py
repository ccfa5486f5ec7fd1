"""Near duplicates by SimHash with a generalised pigeonhole search.

A document has a 64-bit SimHash of its set of words and a 128-bit SimHash of its
set of word pairs.  Two documents are near duplicates when the first differ in
at most ``tau`` bits and the second in at most ``confirm`` bits.  The search for
the first condition is exact: correlated bits are grouped into partitions, each
partition i gets a threshold t_i with sum(t_i) = tau - m + 1, chosen by dynamic
programming on candidate counts taken over all fingerprints, and any two
fingerprints within ``tau`` then lie within t_i of each other in some partition.

Null, empty and word-free texts have no fingerprint and belong to no group.
Equal fingerprints are collapsed before the search, so that thousands of exact
copies cost one probe.  Repeated rows of one doc_id count once; of different texts
under one doc_id that with the least fingerprint counts.  Rows without a doc_id are
left out.  Very long texts are taken whole.  Other columns, whatever their names, are
ignored, or carried through.  An empty table gives no groups.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import PRIME, Words, cut, fresh, mix, small_batches, text_chunks

BITS = 64
TAU = 12
CONFIRM = 30
PARTITIONS = 4
REGION_ROWS = 1 << 20
MARKS = "doc_id long, f0 long, f1 long, f2 long"


def _signs(keys: np.ndarray, starts: np.ndarray, words: int, seed: int) -> np.ndarray:
    """SimHash of each run of distinct feature keys: ``words`` columns of 64 bits."""
    out = np.empty((len(starts), words), dtype=np.uint64)
    if not len(starts):
        return out
    size = np.diff(np.append(starts, len(keys)))
    for w in range(words):
        bits = np.unpackbits(mix(keys, seed + w).view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[:, w] = np.packbits(2 * ones > size[:, None], axis=1).view(np.uint64)[:, 0]
    return out


def _distinct(row: np.ndarray, value: np.ndarray):
    """Distinct (row, value) pairs as 64-bit keys, with the start of each row's run."""
    both = np.unique((row.astype(np.uint64) << np.uint64(42)) | (value >> np.uint64(22)))
    of = (both >> np.uint64(42)).astype(np.int64)
    rows, starts = np.unique(of, return_index=True)
    return both & np.uint64((1 << 42) - 1), rows, starts


def fingerprints(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """(ids, 3 words) of the rows of a chunk that have a word."""
    w = Words(data, offsets)
    keys, rows, starts = _distinct(w.row, w.hash)
    first = _signs(keys, starts, 1, 1)
    with np.errstate(over="ignore"):
        pair = w.hash[:-1] * np.uint64(0xD6E8FEB86659FD93) + w.hash[1:]
    same = w.row[:-1] == w.row[1:]
    one = np.flatnonzero(np.diff(w.first) == 1)
    keys, rows2, starts = _distinct(np.concatenate([w.row[:-1][same], one]), mix(np.concatenate([pair[same], w.hash[w.first[one]]])))
    second = _signs(keys, starts, 2, 11)
    assert np.array_equal(rows, rows2)
    return ids[rows], np.hstack([first, second]).view(np.int64)


def _mark(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at, data, offsets in text_chunks(batch.column(1), limit=1 << 19):
            own, marks = fingerprints(ids[at : at + len(offsets) - 1], data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *[pa.array(marks[:, k]) for k in range(3)]], names=["doc_id", "f0", "f1", "f2"])


def marks(docs: DataFrame) -> DataFrame:
    """One row of MARKS for each document that has a word."""
    small_batches(docs.sparkSession)
    return docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_mark, MARKS)


def _together(batches):
    """Counts of bits set, alone and in pairs, over a partition."""
    total = np.zeros((BITS, BITS), dtype=np.int64)
    n = 0
    for batch in batches:
        b = _bits(batch.column(0).to_numpy()).astype(np.float32)
        total += (b.T @ b).astype(np.int64)
        n += len(b)
    i, j = np.triu_indices(BITS)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(total[i, j], n))], names=["i", "j", "n"])


def _bits(f: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(f).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Bits in m partitions of equal width, each bit with those it correlates with most."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    var = np.clip(np.sqrt(np.outer(p * (1 - p), p * (1 - p))), 1e-9, None)
    cor = np.abs(cov / var)
    np.fill_diagonal(cor, 0)
    left, width, parts = set(range(BITS)), BITS // m, []
    for k in range(m):
        if k == m - 1:
            parts.append(sorted(left))
            break
        seed = max(left, key=lambda b: (cor[b, list(left)].sum(), -b))
        part = [seed]
        left.remove(seed)
        while len(part) < width:
            best = max(left, key=lambda b: (cor[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def part_key(f: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint side by side."""
    u = np.ascontiguousarray(f).view(np.uint64)
    out = np.zeros(len(u), dtype=np.int64)
    for k, b in enumerate(bits):
        out |= ((u >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def masks(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` bits, none for a radius of -1."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], dtype=np.int64)


def candidates_by_radius(counts: np.ndarray, most: int) -> np.ndarray:
    """Pairs of rows at most t apart for t = -1 .. most, from the count of rows by key (Walsh-Hadamard)."""
    width = len(counts).bit_length() - 1

    def transform(a):
        a = a.astype(np.float64)
        for k in range(width):
            a = a.reshape(-1, 2, 1 << k)
            a = np.concatenate([a[:, :1] + a[:, 1:], a[:, :1] - a[:, 1:]], axis=1).reshape(-1)
        return a

    apart = transform(transform(counts) ** 2) / len(counts)
    weight = np.bitwise_count(np.arange(len(counts)))
    return np.array([0.0, *[apart[weight <= t].sum() for t in range(most + 1)]])


def allocate(costs: list[np.ndarray], total: int) -> list[int]:
    """Thresholds (-1 leaves a partition out) of least summed cost with the given sum."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for k, x in enumerate(cost):
                t = k - 1
                if s + t not in after or c + x < after[s + t][0]:
                    after[s + t] = (c + x, [*ts, t])
        best = after
    return best[total][1]


def plan(marked: DataFrame, tau: int = TAU, m: int = PARTITIONS):
    """Bit partitions and thresholds from statistics over every distinct fingerprint."""
    found = marked.select("f0").mapInArrow(_together, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    together, n = np.zeros((BITS, BITS)), 0
    for r in found:
        if r.i < 0:
            n = r.n
        else:
            together[r.i, r.j] = together[r.j, r.i] = r.n
    parts = group_bits(together, n, m)

    def histogram(batches):
        for batch in batches:
            f = batch.column(0).to_numpy()
            for k, bits in enumerate(parts):
                key, count = np.unique(part_key(f, bits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k, np.int64)), pa.array(key), pa.array(count.astype(np.int64))], names=["part", "key", "n"])

    counts = [np.zeros(1 << len(b)) for b in parts]
    table = marked.select("f0").mapInArrow(histogram, "part long, key long, n long").groupBy("part", "key").agg(F.sum("n").alias("n")).toArrow()
    part, key, count = (table.column(c).to_numpy() for c in range(3))
    for k in range(len(parts)):
        counts[k][key[part == k]] = count[part == k]
    costs = []
    for k, b in enumerate(parts):
        most = min(tau, len(b))
        probes = np.cumsum([0.0, *[float(comb(len(b), t)) for t in range(most + 1)]])
        costs.append(candidates_by_radius(counts[k], most) + n * probes * 0.1)
    return parts, allocate(costs, tau - m + 1), n


def pairs(marked: DataFrame, tau: int = TAU, confirm: int = CONFIRM, m: int = PARTITIONS) -> DataFrame:
    """(a, b), a < b: all pairs of rows of ``marked`` (distinct doc_id) within both distances.

    Both sides of a partition meet in regions named by the first bits of its key:
    a row is indexed in its own region and probes those within its threshold.
    The number of regions grows with the rows, so that one fits into memory.
    """
    parts, radius, n = plan(marked, tau, m)
    top = int(min(BITS // m, max(4, np.ceil(np.log2(max(n, 1) / REGION_ROWS)))))

    def route(batches):
        for batch in batches:
            cols = [batch.column(k) for k in range(4)]
            f = cols[1].to_numpy()
            for k, (bits, t) in enumerate(zip(parts, radius)):
                if t < 0:
                    continue
                region = part_key(f, bits) >> (len(bits) - top)
                for mask in masks(top, min(t, top)):
                    to = region ^ mask
                    at = np.flatnonzero(to >= region)
                    if len(at):
                        take = pa.array(at)
                        yield pa.RecordBatch.from_arrays([pa.array((k << top) + to[at]), pa.array(np.full(len(at), mask == 0)), *[c.take(take) for c in cols]], names=["region", "own", "doc_id", "f0", "f1", "f2"])

    def meet(key, table):
        k = key[0].as_py() >> top
        own = table.column("own").to_numpy()
        ids = table.column("doc_id").to_numpy()
        f = [table.column(c).to_numpy().view(np.uint64) for c in ("f0", "f1", "f2")]
        keys = [part_key(f[0], parts[j]) for j in range(len(parts))]
        here = np.flatnonzero(own)
        here = here[np.argsort(keys[k][here], kind="stable")]
        sorted_keys = keys[k][here]
        low, high = [], []
        low_bits = len(parts[k]) - top
        mine, theirs = here, np.flatnonzero(~own)
        for probes in (mine, theirs):
            for mask in masks(len(parts[k]), radius[k]):
                if (probes is mine) != (mask >> low_bits == 0):
                    continue
                for at in range(0, len(probes), 1 << 16):
                    p = probes[at : at + (1 << 16)]
                    want = keys[k][p] ^ mask
                    a = np.searchsorted(sorted_keys, want, side="left")
                    b = np.searchsorted(sorted_keys, want, side="right")
                    for x, y in _near(p, a, b - a, here, f, tau, confirm):
                        once = ids[x] != ids[y]
                        if probes is mine:  # both directions are met within a region
                            once &= ids[x] < ids[y]
                        for j in range(k):  # an earlier partition has found the pair
                            if radius[j] >= 0:
                                once &= np.bitwise_count(keys[j][x] ^ keys[j][y]) > radius[j]
                        low.append(np.minimum(ids[x], ids[y])[once])
                        high.append(np.maximum(ids[x], ids[y])[once])
        return pa.table({"a": np.concatenate([np.zeros(0, np.int64), *low]), "b": np.concatenate([np.zeros(0, np.int64), *high])})

    routed = marked.mapInArrow(route, "region long, own boolean, doc_id long, f0 long, f1 long, f2 long")
    return routed.groupBy("region").applyInArrow(meet, "a long, b long")


def _near(p, start, size, here, f, tau, confirm, most=1 << 20):
    """Candidate pairs of probes and bucket members, by blocks, verified on both fingerprints."""
    held = size > 0
    p, start, size = p[held], start[held], size[held]
    ends = np.cumsum(size)
    at = 0
    while at < len(p):
        base = ends[at] - size[at]
        to = max(int(np.searchsorted(ends, base + most, side="right")), at + 1)
        s = size[at:to]
        x = np.repeat(p[at:to], s)
        y = here[np.repeat(start[at:to], s) + np.arange(len(x)) - np.repeat(np.cumsum(s) - s, s)]
        ok = np.flatnonzero(np.bitwise_count(f[0][x] ^ f[0][y]) <= tau)
        x, y = x[ok], y[ok]
        ok = np.bitwise_count(f[1][x] ^ f[1][y]) + np.bitwise_count(f[2][x] ^ f[2][y]) <= confirm
        yield x[ok], y[ok]
        at = to


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, group_id): connected components of edges (a, b) by alternating large and small stars, until nothing changes."""
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").withColumnRenamed("a", "u").join(least, "u").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        centre = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(centre, "b").select(F.col("m").alias("x"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("y"))
        edges = cut(small.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("doc_id"), F.col("a").alias("group_id"))


def near_duplicates(docs: DataFrame, tau: int = TAU, confirm: int = CONFIRM, m: int = PARTITIONS) -> DataFrame:
    """(doc_id, group_id) for every document that has a near duplicate; group_id is the least doc_id of its group.

    Groups are connected components of the pair relation.
    """
    marked = cut(marks(docs).groupBy("doc_id").agg(F.min(F.struct("f0", "f1", "f2")).alias("f")).select("doc_id", "f.*"))
    alike = cut(marked.groupBy("f0", "f1", "f2").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "f0", "f1", "f2"))
    between = pairs(alike, tau, confirm, m)
    copies = marked.join(alike.withColumnRenamed("doc_id", "first"), ["f0", "f1", "f2"]).where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    linked = components(between.union(copies))
    return linked.union(linked.select("group_id", "group_id").distinct())


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without those whose group has a lesser doc_id."""
    name = fresh(docs, "dropped")
    drop = near_duplicates(docs, **options).where("doc_id <> group_id").select(F.col("doc_id").alias(name))
    return docs.join(drop, F.col("doc_id") == F.col(name), "left_anti")


def _sql_mix(x: str, seed: int, name: str) -> str:
    """Columns that end in ``name``: the 64-bit finaliser of x."""
    times = lambda a, c: f"((({a})::UHUGEINT * {c}::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"
    plus = (PRIME * (seed + 1)) % (1 << 64)
    return (
        f"((({x})::UHUGEINT + {plus}::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT AS {name}_0, {times(f'xor({name}_0, {name}_0 >> 30)', 0xBF58476D1CE4E5B9)} AS {name}_1, "
        f"{times(f'xor({name}_1, {name}_1 >> 27)', 0x94D049BB133111EB)} AS {name}_2, xor({name}_2, {name}_2 >> 31) AS {name}"
    )


def _sql_signs(column: str, name: str) -> str:
    return " + ".join(f"CASE WHEN 2 * sum(({column} >> {p}) & 1) > count(*) THEN {1 << p}::UBIGINT ELSE 0::UBIGINT END" for p in range(BITS)) + f" AS {name}"


ORACLE = f"""
WITH RECURSIVE lists AS (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents WHERE doc_id IS NOT NULL),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place, len(w) AS n FROM lists),
spelt AS (SELECT DISTINCT word, hex(word) AS x FROM words),
valued AS (SELECT word, (list_reduce(list_transform(range(len(x) // 2 - 1, -1, -1), lambda i: (('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2))::INTEGER + 1)::UHUGEINT),
  lambda a, b: (a * {PRIME}::UHUGEINT + b) % 18446744073709551616::UHUGEINT) + (len(x) // 2)::UHUGEINT) % 18446744073709551616::UHUGEINT AS value FROM spelt),
hashed AS (SELECT word, {_sql_mix('value', 0, 'h')} FROM valued),
placed AS (SELECT doc_id, place, n, h, lead(h) OVER (PARTITION BY doc_id ORDER BY place) AS after FROM words JOIN hashed USING (word)),
singles AS (SELECT DISTINCT doc_id, h >> 22 AS key FROM placed),
marked_singles AS (SELECT doc_id, {_sql_mix('key', 1, 'a')} FROM singles),
first AS (SELECT doc_id, {_sql_signs('a', 'f0')} FROM marked_singles GROUP BY doc_id),
paired AS (SELECT doc_id, CASE WHEN n = 1 THEN h::UHUGEINT ELSE ((h::UHUGEINT * {0xD6E8FEB86659FD93}::UHUGEINT) % 18446744073709551616::UHUGEINT + after::UHUGEINT) % 18446744073709551616::UHUGEINT END AS value FROM placed WHERE n = 1 OR after IS NOT NULL),
mixed AS (SELECT doc_id, {_sql_mix('value', 0, 'p')} FROM paired),
doubles AS (SELECT DISTINCT doc_id, p >> 22 AS key FROM mixed),
marked_doubles AS (SELECT doc_id, {_sql_mix('key', 11, 'b')}, {_sql_mix('key', 12, 'c')} FROM doubles),
second AS (SELECT doc_id, {_sql_signs('b', 'f1')}, {_sql_signs('c', 'f2')} FROM marked_doubles GROUP BY doc_id),
marked AS MATERIALIZED (SELECT * FROM first JOIN second USING (doc_id)),
pairs AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM marked a JOIN marked b ON a.doc_id <> b.doc_id
  WHERE bit_count(xor(a.f0, b.f0)::HUGEINT) <= {TAU} AND bit_count(xor(a.f1, b.f1)::HUGEINT) + bit_count(xor(a.f2, b.f2)::HUGEINT) <= {CONFIRM}),
reach(a, b) AS (SELECT DISTINCT a, a FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
SELECT a AS doc_id, min(b) AS group_id FROM reach GROUP BY a
"""
