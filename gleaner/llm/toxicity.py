"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of a text's characters, lower-cased, hashed into
buckets.  Each is scaled by its log-count ratio, the log of the smoothed share of
toxic texts over that of other texts that have it; features whose ratio is less than
``LEAST_RATIO`` either way say nothing and are left out.  A logistic regression with
L2 is fitted over the scaled features.  It is fitted on at most ``per_class``
labelled texts of each class, on the driver; the intercept is corrected to the share
of toxic labels.  Every text is scored whole, a very long one in overlapping pieces
whose n-grams are put together.

Null and empty texts, and all texts where no label of one class exists, score
null and are not toxic.  Texts shorter than the shortest n-gram score null too.
Repeated rows score alike; other columns, whatever their names, are ignored, or
carried through.  An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from .labelled import sample
from .shared import small_batches, text_chunks

SIZES = (4, 6, 8)
BUCKET_BITS = 21
PER_CLASS = 2000
LEAST_TEXTS = 2
LEAST_RATIO = 1.0
SMOOTH = 12
THRESHOLD = 0.2
PIECE = 1 << 20


def characters(data: np.ndarray, offsets: np.ndarray):
    """One number a character of UTF-8 bytes, its bytes side by side; row offsets in characters."""
    lead = (data & np.uint8(0xC0)) != np.uint8(0x80)
    if lead.all():
        return data.astype(np.uint32), offsets
    at = np.flatnonzero(lead)
    value = data[at].astype(np.uint32)
    for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        more = np.flatnonzero(data[at] >= least)
        value[more] = value[more] << np.uint32(8) | data[at[more] + k]
    return value, np.searchsorted(at, offsets)


def _grams(b: np.ndarray, bits: int):
    """(size, bucket of the n-gram at each position) for each size."""
    n, value, out = len(b), b, []
    with np.errstate(over="ignore"):
        for size in range(2, max(SIZES) + 1):
            value = value[: n - size + 1] * np.uint32(0x01000193) ^ b[size - 1 :] if n >= size else value[:0]
            if size in SIZES:
                h = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * size)
                out.append((size, ((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - bits)).astype(np.int32)))
    return out


def text_features(column: pa.Array, bits: int = BUCKET_BITS):
    """Yields (row, distinct feature buckets) for each text that has any."""
    stamp = np.zeros(1 << bits, dtype=np.int32)

    def distinct(x):
        at = np.arange(len(x), dtype=np.int32)
        stamp[x] = at
        return x[stamp[x] == at]

    for first, data, offsets in text_chunks(column):
        if len(offsets) == 2 and len(data) > 2 * PIECE:
            b, _ = characters(data, offsets)
            pieces = [distinct(np.concatenate([g for _, g in _grams(b[k : k + PIECE + max(SIZES) - 1], bits)])) for k in range(0, len(b), PIECE)]
            yield first, distinct(np.concatenate(pieces))
            continue
        b, offsets = characters(data, offsets)
        grams = _grams(b, bits)
        for k in range(len(offsets) - 1):
            low, high = offsets[k], offsets[k + 1]
            x = np.concatenate([g[low : max(low, high - s + 1)] for s, g in grams])
            if len(x):
                yield first + k, distinct(x)


def fit(texts: pa.Array, labels: np.ndarray, share: float, steps: int = 400, decay: float = 1e-2, bits: int = BUCKET_BITS):
    """(weights by bucket, intercept): logistic regression on scaled features."""
    rows, found = [], []
    counts = np.zeros((2, 1 << bits), dtype=np.int32)
    for row, x in text_features(texts, bits):
        rows.append(row)
        found.append(x)
        counts[int(labels[row] > 0), x] += 1
    y = labels[np.array(rows, dtype=np.int64)].astype(np.float32) if rows else np.zeros(0, np.float32)
    if not 0 < y.sum() < len(y):
        return None
    q, p = counts
    some, bit = np.array([len(y) - y.sum(), y.sum()], dtype=np.float64), SMOOTH / len(y)
    ratio = np.log(p / some[1] + bit) - np.log(q / some[0] + bit)
    ratio[(p + q < LEAST_TEXTS) | (np.abs(ratio) < LEAST_RATIO)] = 0
    known = np.flatnonzero(ratio)
    place = np.full(1 << bits, -1, dtype=np.int32)
    place[known] = np.arange(len(known))
    for k, x in enumerate(found):
        at = place[x]
        found[k] = at[at >= 0]
    blocks = []
    for k in range(0, len(found), 256):
        size = [len(x) for x in found[k : k + 256]]
        blocks.append((slice(k, k + len(size)), np.concatenate(found[k : k + 256]), np.array(size)))
    del found, counts
    r = ratio[known].astype(np.float32) / np.float32(10)
    w, bias = np.zeros(len(known), np.float32), 0.0
    m = np.zeros_like(w)
    v = np.zeros_like(w)
    bm = bv = 0.0
    for t in range(1, steps + 1):
        g = np.float32(decay / len(y)) * w
        gb = 0.0
        wr = w * r
        for rows_, x, size in blocks:
            z = np.bincount(np.repeat(np.arange(len(size)), size), weights=wr[x], minlength=len(size)) + bias
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows_]) / len(y)
            g += r * np.bincount(x, weights=np.repeat(error, size), minlength=len(known)).astype(np.float32)
            gb += float(error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        bm, bv = 0.9 * bm + 0.1 * gb, 0.999 * bv + 0.001 * gb * gb
        rate = 0.05
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        bias = bias - rate * (bm / (1 - 0.9**t)) / (np.sqrt(bv / (1 - 0.999**t)) + 1e-8)
    full = np.zeros(1 << bits, dtype=np.float32)
    full[known] = w * r
    prior = y.mean()
    share = min(max(share, 1e-6), 1 - 1e-6)
    bias += np.log(share / (1 - share)) - np.log(prior / (1 - prior))
    return full, float(bias)


def scorer(spark, model, bits: int = BUCKET_BITS):
    """A column function: the probability that a text is toxic, null for null and empty texts."""
    if model is None:
        return lambda c: F.lit(None).cast("double")
    small_batches(spark)
    weights, bias = model
    known = np.flatnonzero(weights).astype(np.int32)
    shared = spark.sparkContext.broadcast((known, weights[known]))

    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        table = np.zeros(1 << bits, dtype=np.float32)
        at, values = shared.value
        table[at] = values
        out = np.full(len(column), np.nan)
        for row, x in text_features(column, bits):
            out[row] = 1 / (1 + np.exp(-np.clip(float(table[x].sum(dtype=np.float64)) + bias, -500, 500)))
        return pa.array(out, mask=np.isnan(out))

    return score


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    return fit(*sample(docs, labels, "toxic", per_class))


def scored(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, toxicity, is_toxic) for every document."""
    score = scorer(docs.sparkSession, train(docs, labels, per_class))
    return docs.select("doc_id", score("text").alias("toxicity")).withColumn("is_toxic", F.coalesce(F.col("toxicity") >= threshold, F.lit(False)))


def without_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic."""
    score = scorer(docs.sparkSession, train(docs, labels, per_class))
    return docs.where(F.coalesce(score("text") < threshold, F.lit(True)))
