"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes.  Each passage is encoded
from the histogram of its byte pairs by a learned layer, gated attention
(tanh and sigmoid branches) weighs the passages of a document, and a logistic
output scores the weighted sum.  All layers are learned together from document
labels alone, on at most ``per_class`` labelled texts of each class, on the
driver; the intercept is corrected to the share of good labels.  Every passage
of every text is scored.

Null and empty texts have no passage: their quality is null and they are not
kept.  Without labels of both classes every quality is null and nothing is kept.
Repeated rows score alike; very long texts are scored whole, passage by passage.
Other columns, whatever their names, are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from .labelled import sample
from .shared import text_chunks

PASSAGE = 512
CODES = 256
HIDDEN = 24
GATE = 12
PER_CLASS = 2000
THRESHOLD = 0.5


def passages(data: np.ndarray, offsets: np.ndarray):
    """Encoder inputs (passages x CODES) of a chunk, and each row's number of passages."""
    size = np.diff(offsets)
    count = -(-size // PASSAGE)
    first = np.cumsum(count) - count
    if not count.sum():
        return np.zeros((0, CODES), np.float32), count
    row = np.repeat(np.arange(len(size)), size)
    of = first[row] + (np.arange(len(data)) - offsets[row]) // PASSAGE
    wide = data.astype(np.uint32)
    after = np.append(wide[1:], np.uint32(0))
    with np.errstate(over="ignore"):
        code = ((wide * np.uint32(0x9E3779B1) + after * np.uint32(0x85EBCA77)) >> np.uint32(24)).astype(np.int64)
    n = np.bincount(of * CODES + code, minlength=int(count.sum()) * CODES).reshape(-1, CODES)
    x = np.log1p(n.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6), count


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(model: dict, x: np.ndarray, count: np.ndarray):
    """Scores (logits) of bags that each have a passage, with what the backward pass needs."""
    starts = np.cumsum(count) - count
    bag = np.repeat(np.arange(len(count)), count)
    h = np.tanh(x @ model["we"] + model["be"])
    t, s = np.tanh(h @ model["v"]), _sigmoid(h @ model["u"])
    e = (t * s) @ model["w"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return z @ model["c"] + model["d"], (bag, h, t, s, a, z)


def fit(texts: pa.Array, labels: np.ndarray, share: float, epochs: int = 25, seed: int = 5) -> dict | None:
    """Adam over whole bags; gradients by hand."""
    xs, ys, counts = [], [], []
    for first, data, offsets in text_chunks(texts, lower=False):
        x, count = passages(data, offsets)
        xs.append(x)
        counts.append(count)
        ys.append(labels[first : first + len(count)])
    if not xs:
        return None
    x, count, y = np.concatenate(xs), np.concatenate(counts), np.concatenate(ys).astype(np.float32)
    y, count = y[count > 0], count[count > 0]
    if not 0 < y.sum() < len(y):
        return None
    rng = np.random.default_rng(seed)
    p = {
        "we": rng.normal(0, 1.0, (CODES, HIDDEN)).astype(np.float32) * 0.5, "be": np.zeros(HIDDEN, np.float32), "v": rng.normal(0, 0.3, (HIDDEN, GATE)).astype(np.float32),
        "u": rng.normal(0, 0.3, (HIDDEN, GATE)).astype(np.float32), "w": rng.normal(0, 0.3, GATE).astype(np.float32), "c": rng.normal(0, 0.3, HIDDEN).astype(np.float32), "d": np.zeros((), np.float32),
    }
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    starts, step = np.cumsum(count) - count, 0
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 64):
            pick = order[k : k + 64]
            n = count[pick]
            at = np.repeat(starts[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            own = x[at]
            logit, (bag, h, t, s, a, z) = forward(p, own, n)
            g = ((_sigmoid(logit) - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
            grad = {"c": z.T @ g, "d": g.sum()}
            dz = g[:, None] * p["c"]
            dh = a[:, None] * dz[bag]
            da = (h * dz[bag]).sum(axis=1)
            de = a * (da - np.add.reduceat(a * da, np.cumsum(n) - n)[bag])
            grad["w"] = (t * s).T @ de
            dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
            grad["v"], grad["u"] = h.T @ dt, h.T @ ds
            dh = (dh + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
            grad["we"], grad["be"] = own.T @ dh, dh.sum(axis=0)
            step += 1
            for name, value in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * value
                v[name] = 0.999 * v[name] + 0.001 * value * value
                p[name] = (p[name] - 3e-3 * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8) - 3e-7 * p[name]).astype(np.float32)
    share = min(max(share, 1e-6), 1 - 1e-6)
    p["d"] = np.float32(p["d"] + np.log(share / (1 - share)))
    return p


def scorer(model: dict | None):
    """A column function giving struct(quality, n_passages)."""
    if model is None:
        return lambda c: F.struct(F.lit(None).cast("double").alias("quality"), F.ceil(F.coalesce(F.octet_length(c), F.lit(0)) / F.lit(PASSAGE)).cast("int").alias("n_passages"))

    @arrow_udf("quality double, n_passages int")
    def score(column: pa.Array) -> pa.Array:
        out, number = np.full(len(column), np.nan), np.zeros(len(column), np.int32)
        for first, data, offsets in text_chunks(column, lower=False):
            x, count = passages(data, offsets)
            number[first : first + len(count)] = count
            at = np.flatnonzero(count)
            if len(at):
                out[first + at] = _sigmoid(forward(model, x, count[at])[0])
        return pa.StructArray.from_arrays([pa.array(out, mask=np.isnan(out)), pa.array(number)], names=["quality", "n_passages"])

    return score


def scored(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, quality, n_passages, keep) for every document."""
    score = scorer(fit(*sample(docs, labels, "quality", per_class)))
    found = docs.select("doc_id", score(F.col("text")).alias("s"))
    return found.select("doc_id", "s.quality", "s.n_passages", F.coalesce(F.col("s.quality") >= threshold, F.lit(False)).alias("keep"))
