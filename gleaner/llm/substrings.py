"""Passages that repeat across documents, found by compact windows.

A text is its sequence of words (see ``Words``), a token the run of ``gram``
words at a position.  The Cartesian tree over the token hashes gives compact
windows (left, centre, right): every subsequence that holds the centre and lies
within the window has the centre's hash as its min-hash.  Only windows that hold a passage of ``words`` words count;
their centres are the minima of sliding windows of that length, and the bounds
of such a centre are always such centres too, so the tree is built over these
few.  Windows with equal hashes meet in a join; their intersections are verified
word by word.

Exact repeats of ``words`` words or more are all found: each run of that length
has the same centre wherever it occurs, and runs are compared by rolling hash.
Near repeats count where ``agree`` of the words of such a run are equal, place by
place, and reach from the first to the last equal word, ``words`` words at least.
The words that differ leave somewhere between them a run of equal ones, of 8 words
if 5 of 50 differ.  Seeds are the minima of the short grams within every run of
that length, so two texts that agree have a seed in common: nothing is left to
chance.  One word or two over and over are no passage, as such runs are alike without
one being copied from another: a gram or seed of fewer than three different words
counts for nothing, and a passage needs another one.  Seeds with the same words on both sides, as far as a passage reaches, are
exact repeats, and only the first document's go on to be compared, each with those
before it until one agrees.  Not all of a group are compared, as a line that many
texts have in common puts all of them into one.  Of the blocks of words next to the
seed two rows that agree have all but a few in common, so of any window of blocks
one of the few rarest of the group is common to both (prefix filtering): rows are
compared where they share such a block.  That loses no pair.

Null and empty texts, and texts of fewer words, have no passages.  Repetition
within one document does not count, and rows of one doc_id are one document.
Such rows are taken to hold the same text.
Rows without a doc_id take no part.  An empty table gives none.  Other columns,
whatever their names, are ignored, or carried through.  Very long texts are taken
whole.  Ties go to the least doc_id, whose passage
is the one that stays.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import PRIME, Words, _inverse, cut, fresh, mix, partitions, small_batches, stored, text_chunks

WORDS = 50
GRAM = 8
SEED = 5
AGREE = 0.9
AROUND_BITS = 21
BROADCAST_ROWS = 200_000
BLOCK = 1 << 12
FEW = 4
_SHARED = ["code", "doc_id", "place", "source_doc_id"]


def gram_hashes(w: Words, gram: int):
    """Hash of the ``gram`` words from each position that has them in its row; those positions."""
    n = max(0, len(w.hash) - gram + 1)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            total = total * np.uint64(PRIME) + w.hash[k : k + n]
    at = np.flatnonzero(w.row[:n] == w.row[gram - 1 : gram - 1 + n]) if n else np.zeros(0, np.int64)
    return mix(total[at]), at


def plain(w: Words, at: np.ndarray, gram: int) -> np.ndarray:
    """Whether the ``gram`` words from each position are fewer than three different ones."""
    first = w.hash[at]
    other = np.zeros(len(at), dtype=np.uint64)
    two, three = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
    for k in range(1, gram):
        here = w.hash[at + k]
        differs = here != first
        three |= differs & two & (here != other)
        other = np.where(differs & ~two, here, other)
        two |= differs
    return ~three


def centres(value: np.ndarray, row: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the leftmost minimum of some ``width`` positions of one row."""
    n = len(value)
    if n < width:
        return np.zeros(0, np.int64)
    shift = np.uint64(max(20, int(n).bit_length()))
    least = (value >> shift << shift) | np.arange(n, dtype=np.uint64)
    held = 1
    while held * 2 <= width:
        least = np.minimum(least[: len(least) - held], least[held:])
        held *= 2
    if held < width:
        least = np.minimum(least[: n - width + 1], least[width - held :])
    inside = row[: n - width + 1] == row[width - 1 :]
    return np.unique(least[inside] & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)


def bounds(value: list, at: list, row: list, first: list, last: list):
    """Window (left, right) of each centre: a Cartesian tree by one pass with a stack."""
    left, right = [0] * len(at), [0] * len(at)
    stack: list[int] = []
    own = -1
    for i, v in enumerate(value):
        if row[i] != own:
            for j in stack:
                right[j] = last[own]
            stack, own = [], row[i]
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = at[i] - 1
        left[i] = at[stack[-1]] + 1 if stack else first[own]
        stack.append(i)
    for j in stack:
        right[j] = last[own]
    return left, right


def compact_windows(w: Words, rows: int, words: int, gram: int):
    """(key, row, centre, left, right) of the windows that hold a passage; positions are words of the row."""
    grams, at = gram_hashes(w, gram)
    row = w.row[at]
    value = mix(grams, 100)
    poor = plain(w, at, gram)
    value[poor] = ~np.uint64(0)
    c = centres(value, row, words - gram + 1)
    c = c[~poor[c]]
    count = np.bincount(row, minlength=rows)
    end = np.cumsum(count)
    left, right = bounds(value[c].tolist(), c.tolist(), row[c].tolist(), (end - count).tolist(), (end - 1).tolist())
    base = (end - count)[row[c]]
    return value[c].view(np.int64), row[c], c - base, np.array(left, dtype=np.int64) - base, np.array(right, dtype=np.int64) - base


def most_misses(words: int, agree: float) -> int:
    """Words of a passage that may differ."""
    return words - math.ceil(agree * words - 1e-9)


def seed_width(words: int, agree: float) -> tuple[int, int]:
    """Words of a seed, and how many neighbouring places it is the minimum of."""
    misses = most_misses(words, agree)
    run = -(-(words - misses) // (misses + 1))
    seed = max(1, min(SEED, run))
    return seed, max(1, run - seed + 1)


def regions(w: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words [low, high) of a chunk, for many regions."""
    n = len(w.hash)
    with np.errstate(over="ignore"):
        power, back = np.full(n + 1, PRIME, dtype=np.uint64), np.full(n + 1, _inverse(PRIME), dtype=np.uint64)
        power[0] = back[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(back, out=back)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(w.hash * power[:n], out=total[1:])
        return mix((total[high] - total[low]) * back[low] + (high - low).astype(np.uint64))


def seeds(w: Words, words: int, agree: float):
    """(key, row, position, hash of the words around it that a passage with it may have)."""
    seed, width = seed_width(words, agree)
    side = words - seed
    grams, at = gram_hashes(w, seed)
    value = mix(grams, 200)
    poor = plain(w, at, seed)
    value[poor] = ~np.uint64(0)
    c = centres(value, w.row[at], width)
    c = c[~poor[c]]
    place = at[c]
    row = w.row[place]
    long = np.diff(w.first)[row] >= words
    c, place, row = c[long], place[long], row[long]
    low = np.maximum(w.first[row], place - side)
    high = np.minimum(w.first[row + 1], place + seed + side)
    around = mix(regions(w, low, high) + (place - low).astype(np.uint64))
    return value[c].view(np.int64), row, place - w.first[row], around.view(np.int64)


def _buckets(spark) -> int:
    """Parts that keys are dealt to: several for each partition, so that one fits into memory, but not so many that a batch has next to nothing for each."""
    size = partitions(spark)
    return size * max(1, min(16, 8192 // size))


def _packed(code, doc, place) -> bytes:
    """Three columns of numbers, documents as differences, by bytes of equal weight, compressed."""
    import zstandard

    columns = (code, np.diff(doc, prepend=np.int64(0)), place)
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(payloads):
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    parts = []
    for p in payloads:
        planes = np.frombuffer(unpack(p), np.uint8).reshape(3, 8, -1)
        code, doc, place = (np.ascontiguousarray(x.T).view(np.int64)[:, 0] for x in planes)
        parts.append((code, np.cumsum(doc), place))
    return [np.concatenate(c) for c in zip(*parts)]


def _windows(docs: DataFrame, words: int, gram: int, agree: float) -> DataFrame:
    """Windows and seeds, three numbers each, those of a batch that go to one bucket packed into a row.

    ``code`` has the key above ``AROUND_BITS``, its last bit 0 for windows and 1 for seeds,
    and below it bits of the hash of the words around.  ``place`` has the position in the
    last 31 bits; of windows also the bounds in the next 16 and further bits of the hash.
    """
    side = words - gram
    if not 0 <= side < 256:
        raise ValueError("passages of 8 to 263 words can be searched for, with grams no longer than a passage")
    key_bits, around_bits, buckets = -(1 << AROUND_BITS + 1), (1 << AROUND_BITS) - 1, _buckets(docs.sparkSession)

    def emit(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            codes, docs_, places = [], [], []
            for first, data, offsets in text_chunks(batch.column(1)):
                w = Words(data, offsets)
                key, row, c, left, right = compact_windows(w, len(offsets) - 1, words, gram)
                left, right = np.minimum(c - left, side), np.minimum(right - c, side)
                at = w.first[row] + c
                around = regions(w, at - left, at + right + gram).view(np.int64)
                span = (around >> 43 & 0xFFFF) << 47 | left << 39 | right << 31
                for key, row, place, around, kind in ((key, row, c | span, around, 0), (*seeds(w, words, agree), 1)):
                    codes.append(key & key_bits | kind << AROUND_BITS | around & around_bits)
                    docs_.append(ids[first + row])
                    places.append(place)
            if not codes:
                continue
            code, doc, place = (np.concatenate(x) for x in (codes, docs_, places))
            bucket = ((mix((code >> AROUND_BITS).view(np.uint64), 7) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            code, doc, place, bucket = code[order], doc[order], place[order], bucket[order]
            heads = np.flatnonzero(_starts_of(bucket) == np.arange(len(bucket)))
            ends = np.append(heads[1:], len(bucket))
            payload = [_packed(code[i:j], doc[i:j], place[i:j]) for i, j in zip(heads, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[heads]), pa.array(payload, pa.binary())], names=["bucket", "payload"])

    return docs.mapInArrow(emit, "bucket int, payload binary")


def _whole_groups(batches):
    """Tables of the rows of batches sorted by their first column, of which no group is cut."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cut_at = int(np.searchsorted(keys, keys[-1]))
        if rows < 2 * BLOCK or not cut_at and held[0].column(0)[0].as_py() == keys[-1]:
            continue
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut_at)]).combine_chunks()
        held, rows = [batch.slice(cut_at)], batch.num_rows - cut_at
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _buckets_of(batches):
    """(code, doc, place) of each bucket of batches sorted by bucket."""
    held, now = [], None
    for batch in batches:
        for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            if held and bucket != now:
                yield _unpacked(held)
                held = []
            now = bucket
            held.append(payload.as_py())
    if held:
        yield _unpacked(held)


def _shared(found: DataFrame, gram: int) -> DataFrame:
    """Rows whose key several documents have, of those with equal words around them only the first document's.

    The others repeat that document: of windows the whole region is a passage, given as a
    row with ``source_doc_id`` whose ``place`` has its bounds.
    """

    def emit(batches):
        for code, doc, place in _buckets_of(batches):
            around = place >> 31
            order = np.lexsort((doc, around, code))
            code, doc, place, around = code[order], doc[order], place[order], around[order]
            first = _starts_of(code, around)
            stays = doc == doc[first]
            again = np.flatnonzero(~stays & (code >> AROUND_BITS & 1 == 0))
            if len(again):
                c, left, right = place[again] & (1 << 31) - 1, place[again] >> 39 & 0xFF, place[again] >> 31 & 0xFF
                cols = islands(np.stack([doc[again], c - left, c + gram + right, doc[first[again]]], axis=1))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(cols[0]), pa.int64()), pa.array(cols[0]), pa.array(cols[1] << 31 | cols[2]), pa.array(cols[3])], names=_SHARED)
            kept = np.flatnonzero(stays)
            key = code[kept] >> AROUND_BITS
            heads = np.flatnonzero(_starts_of(key) == np.arange(len(key)))
            many = np.minimum.reduceat(doc[kept], heads) < np.maximum.reduceat(doc[kept], heads)
            kept = kept[np.repeat(many, np.diff(np.append(heads, len(key))))]
            if len(kept):
                yield pa.RecordBatch.from_arrays([pa.array(code[kept]), pa.array(doc[kept]), pa.array(place[kept]), pa.nulls(len(kept), pa.int64())], names=_SHARED)

    size = partitions(found.sparkSession)
    return found.repartitionById(size, F.col("bucket") % size).sortWithinPartitions("bucket").mapInArrow(emit, "code long, doc_id long, place long, source_doc_id long")


def _short(docs: DataFrame) -> DataFrame:
    """Texts as 8 bits of the hash of each word: those of two words that differ are equal once in 256 times."""

    def emit(batches):
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                w = Words(data, offsets)
                ends = pa.py_buffer(w.first.astype(np.int64))
                words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, ends, pa.py_buffer(w.hash.astype(np.uint8))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(offsets) - 1), words.cast(pa.binary())], names=["doc_id", "words"])

    return docs.mapInArrow(emit, "doc_id long, words binary")


def _contexts(joined: DataFrame, words: int, gram: int, agree: float) -> DataFrame:
    """Word hashes around each centre, of rows of ``_short`` with their anchors."""
    kinds = (gram, seed_width(words, agree)[0])

    def emit(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts, anchors = batch.column(1).cast(pa.large_binary()), batch.column(2)
            first = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = texts.buffers()[2]
            short = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(1, np.uint8)
            bound = np.asarray(anchors.offsets)
            code, place = (anchors.values.field(k).to_numpy(zero_copy_only=False)[bound[0] : bound[-1]] for k in range(2))
            rows_of = np.repeat(np.arange(len(ids)), np.diff(bound))
            kind_of, at = code >> AROUND_BITS & 1, place & (1 << 31) - 1
            extra_of = np.where(kind_of == 1, code & (1 << AROUND_BITS) - 1, place >> 31 & 0xFFFF)
            for kind, size in enumerate(kinds):
                side = words - size
                width = 2 * side + size
                length = np.diff(first)[rows_of]
                here = np.flatnonzero((kind_of == kind) & (at + size <= length))
                for k in range(0, len(here), 1 << 15):
                    i = here[k : k + (1 << 15)]
                    row, c, extra = rows_of[i], at[i], extra_of[i]
                    span = (np.minimum(c, side) << 16 | np.minimum(length[i] - size - c, side)) if kind else (extra >> 8) << 16 | extra & 0xFF
                    near = short[np.clip((first[row] + c)[:, None] + np.arange(-side, size + side), 0, len(short) - 1)]
                    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(near), [None, pa.py_buffer(np.ascontiguousarray(near).tobytes())]).cast(pa.binary())
                    cols = [code[i] >> AROUND_BITS, ids[row], c.astype(np.int32), span.astype(np.int32), extra]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), flat], names=["key", "doc_id", "centre", "span", "extra", "near"])

    return joined.mapInArrow(emit, "key long, doc_id long, centre int, span int, extra long, near binary")


def _starts_of(*columns):
    """Where a sorted run of equal values begins, for each row the index of its first row."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _allowed(left, right, side: int):
    """For each row, the places of the context at which a passage may begin."""
    at = np.arange(side + 1)[None, :]
    return (at >= side - left[:, None]) & (at <= right[:, None])


def exact_repeats(key, doc, left, right, near, words: int, gram: int):
    """Passages of windows sorted by (key, doc_id), whole groups: equal runs at the same place before the centre.

    Gives (row, first word, end, source doc_id), words counted from the left end of the context.
    """
    width, offsets = near.shape[1], words - gram + 1
    run = np.empty((len(key), offsets), dtype=np.uint64)
    with np.errstate(over="ignore"):
        power = np.full(width + 1, PRIME, dtype=np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        for s in range(0, len(key), BLOCK):
            at = slice(s, s + BLOCK)
            total = np.zeros((len(key[at]), width + 1), dtype=np.uint64)
            np.cumsum((near[at].astype(np.uint64) + np.uint64(1)) * power[:width], axis=1, out=total[:, 1:])
            sums = (total[:, words:] - total[:, :offsets]) * power[width - np.arange(offsets)]
            run[at] = mix(sums) + key[at].view(np.uint64)[:, None] + np.arange(offsets, dtype=np.uint64)[None, :]
    i, o = np.nonzero(_allowed(left, right, words - gram))
    value = run[i, o]
    order = np.argsort(value, kind="stable")
    first = i[order[_starts_of(value[order])]]
    row, o = i[order], o[order]
    again = doc[row] > doc[first]
    return row[again], o[again], o[again] + words, doc[first[again]]


def _rare_blocks(key, left, right, near, side: int, seed: int, misses: int):
    """(row, block) where rows of a key may agree: what each row has among the rarest blocks of some window of blocks.

    Blocks are the words next to the seed, ``size`` at a time.  Any passage has ``wide``
    whole blocks, i on the left and the others on the right; two that agree differ in
    ``misses`` of them at most, so the ``misses + 1`` first ones of both, in one order of
    all blocks by rarity, have one in common.  Gives none where passages have too few blocks.
    """
    size = max(1, side // (2 * misses + 4))
    each = side // size
    wide = min(a // size + (side - a) // size for a in range(side + 1))
    if wide <= misses:
        return None
    rows = len(key)
    value = np.empty((rows, 2 * each), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(each):
            for column, start in ((j, side - size * (j + 1)), (each + j, side + seed + size * j)):
                x = key.view(np.uint64) * np.uint64(PRIME) + np.uint64(column)
                for k in range(start, start + size):
                    x = x * np.uint64(PRIME) + near[:, k]
                value[:, column] = mix(x)
    there = np.concatenate([left[:, None] >= size * np.arange(1, each + 1), right[:, None] >= size * np.arange(1, each + 1)], axis=1)
    i, j = np.nonzero(there)
    _, token, count = np.unique(value[i, j], return_inverse=True, return_counts=True)
    rank = np.full(value.shape, ~np.uint64(0))
    rank[i, j] = np.minimum(count[token], (1 << 20) - 1).astype(np.uint64) << np.uint64(44) | value[i, j] >> np.uint64(20)
    chosen = np.zeros(value.shape, dtype=bool)
    for k in range(max(0, wide - each), min(wide, each) + 1):
        has = np.flatnonzero((left >= size * k) & (right >= size * (wide - k)))
        columns = np.concatenate([np.arange(k), each + np.arange(wide - k)])
        for s in range(0, len(has), BLOCK):
            at = has[s : s + BLOCK]
            least = np.argpartition(rank[at][:, columns], misses, axis=1)[:, : misses + 1]
            chosen[at[:, None], columns[least]] = True
    picked = chosen[i, j] & (count[token] > 1)
    return i[picked], token[picked]


def near_repeats(key, doc, left, right, near, words: int, seed: int, agree: float):
    """As ``exact_repeats``, of seeds: each row against those before it in its group until one agrees."""
    side = words - seed
    width, offsets = near.shape[1], side + 1
    misses = most_misses(words, agree)
    # of the words next to the seed on one side or the other, a passage has half of its other words
    half = min((side + 1) // 2, 32)
    lanes = np.arange(half, dtype=np.uint64) * np.uint64(2)
    before, after = ((near[:, k : k + half].astype(np.uint64) & np.uint64(3)) << lanes for k in (side - half, side + seed))
    before, after = np.bitwise_or.reduce(before, axis=1), np.bitwise_or.reduce(after, axis=1)

    def differ(x):
        return np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555))

    out = []

    def compare(x, y):
        """Whether each row has a passage in common with the row y beside it."""
        held = np.zeros(len(x), dtype=bool)
        for s in range(0, len(x), BLOCK):
            a, b = x[s : s + BLOCK], y[s : s + BLOCK]
            equal = near[a] == near[b]
            same = np.zeros((len(a), width + 1), dtype=np.int16)
            np.cumsum(equal, axis=1, out=same[:, 1:])
            good = (same[:, words:] - same[:, :offsets] >= words - misses) & _allowed(np.minimum(left[a], left[b]), np.minimum(right[a], right[b]), side)
            found = np.flatnonzero(good.any(axis=1))
            good, equal = good[found], equal[found]
            # the passage begins and ends with words that agree
            places = np.arange(width)[None, :]
            equal &= (places >= good.argmax(axis=1)[:, None]) & (places < (offsets - 1 - good[:, ::-1].argmax(axis=1) + words)[:, None])
            low, high = equal.argmax(axis=1), width - equal[:, ::-1].argmax(axis=1)
            enough = high - low >= words
            found, low, high = found[enough], low[enough], high[enough]
            held[s + found] = True
            out.append((a[found], low, high, doc[b[found]]))
        return held

    matched = np.zeros(len(key), dtype=bool)

    def meet(a, b):
        """Compares rows a with rows b of lesser documents where a is not matched yet."""
        maybe = np.flatnonzero((doc[b] < doc[a]) & ~matched[a] & ((differ(before[a] ^ before[b]) <= misses) | (differ(after[a] ^ after[b]) <= misses)))
        _, once = np.unique(a[maybe] * len(key) + b[maybe], return_index=True)
        maybe = maybe[once]
        matched[a[maybe[compare(a[maybe], b[maybe])]]] = True

    # groups of a few rows are compared as they are, others where rows share a rare block
    group = _starts_of(key)
    entry = np.arange(len(key))
    large = np.flatnonzero(np.bincount(group, minlength=len(key))[group] > FEW)
    if len(large):
        for words_of in (near[large, side + seed :], near[large, :side][:, ::-1]):  # those most alike first: next to each other by the words on one side
            text = np.ascontiguousarray(words_of.astype(">u2")).view(f"V{2 * words_of.shape[1]}")[:, 0]
            order = np.argsort(text, kind="stable")
            alike = large[order[np.argsort(group[large[order]], kind="stable")]]
            for away in range(1, FEW + 1):
                a, b = alike[away:], alike[:-away]
                same = group[a] == group[b]
                a, b = a[same], b[same]
                later = doc[a] > doc[b]
                meet(np.where(later, a, b), np.where(later, b, a))
        rare = _rare_blocks(key[large], left[large], right[large], near[large], side, seed, misses)
        if rare is not None:
            row, token = rare
            order = np.lexsort((row, token))
            few = np.setdiff1d(entry, large, assume_unique=True)
            entry, group = np.append(few, large[row[order]]), np.append(group[few], len(key) + token[order])
    start = _starts_of(group)
    x = np.flatnonzero((start < np.arange(len(group))) & ~matched[entry])
    step = 0
    while len(x):  # those not matched yet against the next row of their group, itself matched or not
        meet(entry[x], entry[start[x] + step])
        step += 1
        x = x[start[x] + step < x]
        x = x[~matched[entry[x]] & (doc[entry[start[x] + step]] < doc[entry[x]])]
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def islands(spans: np.ndarray):
    """Rows (doc_id, start, end, source doc_id): those of one document that overlap become one, of the least source."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    other = spans[1:, 0] != spans[:-1, 0]
    # by the document's place in the rows, as a doc_id may be of any size
    shift = np.append(np.zeros(1, np.int64), np.cumsum(other)) << 32
    reach = np.maximum.accumulate(spans[:, 2] + shift) - shift
    heads = np.flatnonzero(np.append(np.ones(1, bool), other | (spans[1:, 1] > reach[:-1])))
    return spans[heads, 0], spans[heads, 1], np.maximum.reduceat(spans[:, 2], heads), np.minimum.reduceat(spans[:, 3], heads)


def _verify(contexts: DataFrame, words: int, gram: int, agree: float) -> DataFrame:
    kinds = (gram, seed_width(words, agree)[0])

    def spans(table, kind: int):
        key, doc, c, span, extra = (table.column(k).to_numpy() for k in range(5))
        own = np.flatnonzero(key & 1 == kind)
        if not len(own):
            return np.zeros((0, 4), np.int64)
        side = words - kinds[kind]
        near = np.frombuffer(b"".join(table.column(5).take(pa.array(own)).to_pylist()), dtype=np.uint8).reshape(len(own), -1)
        key, doc, c, span, extra = (x[own] for x in (key, doc, c, span, extra))
        left, right = span >> 16, span & 0xFFFF
        if kind:  # places of one document with equal words around them are compared once
            first = _starts_of(key, doc, extra)
            one = np.flatnonzero(first == np.arange(len(first)))
            row, low, high, source = near_repeats(key[one], doc[one], left[one], right[one], near[one], words, kinds[kind], agree)
            size = np.diff(np.append(one, len(first)))[row]
            ends = np.cumsum(size)
            low, high, source = (np.repeat(x, size) for x in (low, high, source))
            row = np.repeat(one[row], size) + np.arange(len(low)) - np.repeat(ends - size, size)
        else:
            row, low, high, source = exact_repeats(key, doc, left, right, near, words, gram)
        start = c[row].astype(np.int64) - side + low
        return np.stack([doc[row], start, start + high - low, source], axis=1)

    def emit(batches):
        for table in _whole_groups(batches):
            both = np.concatenate([spans(table, kind) for kind in range(len(kinds))])
            if len(both):
                doc, start, end, source = islands(both)
                cols = [doc, start.astype(np.int32), end.astype(np.int32), source]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["doc_id", "start", "end", "source_doc_id"])

    sorted_ = contexts.repartition(partitions(contexts.sparkSession), "key").sortWithinPartitions("key", "doc_id", "extra", "centre")
    return sorted_.mapInArrow(emit, "doc_id long, start int, end int, source_doc_id long")


def repeated_passages(docs: DataFrame, words: int = WORDS, gram: int = GRAM, agree: float = AGREE) -> DataFrame:
    """(doc_id, start, end, source_doc_id): words [start, end) of a document repeat a passage of one with a lesser doc_id."""
    small_batches(docs.sparkSession)
    source = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = stored(_shared(_windows(source, words, gram, agree), gram))
    anchors = shared.where("source_doc_id IS NULL").groupBy("doc_id").agg(F.collect_set(F.struct("code", "place")).alias("anchors"))
    joined = _short(source).join(anchors, "doc_id").select("doc_id", "words", "anchors")
    whole = shared.where("source_doc_id IS NOT NULL").select("doc_id", F.shiftright("place", 31).cast("int").alias("start"), F.col("place").bitwiseAND((1 << 31) - 1).cast("int").alias("end"), "source_doc_id")
    spans = _verify(_contexts(joined, words, gram, agree), words, gram, agree).union(whole)
    order = W.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    island = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = island.groupBy("doc_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("source_doc_id").alias("source_doc_id"))
    return merged.drop("island")


def _cut_words(batches):
    """Texts without the given spans of words."""
    for batch in batches:
        column = batch.column(0)
        spans = batch.column(1)
        texts = []
        for text, cuts in zip(column.to_pylist(), spans.to_pylist()):
            if not text or not cuts:
                texts.append(text)
                continue
            lowered = pa.array([text])
            for _, data, offsets in text_chunks(lowered, lower=False):
                raw = data.tobytes()
                w = Words(np.frombuffer(_lower_same_length(raw), np.uint8), offsets)
                kept, at = [], 0
                for low, high in sorted((s["start"], s["end"]) for s in cuts):
                    if low >= len(w.start):
                        continue
                    kept.append(raw[at : w.start[low]])
                    at = w.start[high] if high < len(w.start) else len(raw)
                kept.append(raw[at:])
                texts.append(b"".join(kept).decode("utf-8", "ignore").strip())
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


def _lower_same_length(raw: bytes) -> bytes:
    """Only ASCII letters are lowered: bytes keep their places, and words their bounds."""
    return raw.lower()


def without_passages(docs: DataFrame, **options) -> DataFrame:
    """The documents without their repeated passages, ``n_chars`` counted again.

    A document of which no word is left goes; one without a repeated passage stays as it is.
    """
    from pyspark.sql.pandas.functions import arrow_udf

    doc, cuts_of, left = (fresh(docs, c) for c in ("_doc", "_spans", "_text"))
    spans = repeated_passages(docs, **options).groupBy(F.col("doc_id").alias(doc)).agg(F.collect_list(F.struct("start", "end")).alias(cuts_of))
    spans = cut(spans)
    n = spans.count()
    joined = docs.join(F.broadcast(spans) if n <= BROADCAST_ROWS else spans, F.col("doc_id") == F.col(doc), "left")

    @arrow_udf("string")
    def cut_text(text: pa.Array, cuts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, cuts], names=["text", "cuts"])
        return next(_cut_words([batch])).column(0)

    whole = F.col(cuts_of).isNull()
    out = joined.withColumn(left, F.when(whole, F.col("text")).otherwise(cut_text("text", cuts_of)))
    out = out.where(whole | F.col(left).rlike("[0-9A-Za-z\u0080-\U0010ffff]"))
    n_chars = F.when(whole, F.col("n_chars")).otherwise(F.length(left).cast("long")) if "n_chars" in docs.columns else None
    return out.select(*[F.col(left).alias("text") if c == "text" else n_chars.alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns])
