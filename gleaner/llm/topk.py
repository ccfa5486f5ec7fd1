"""Exact top-k search with BM25 by MaxScore over document shards.

Terms are words in lower case (runs of ASCII letters and digits and non-ASCII
characters).  Document frequencies, lengths and their mean are counted over all
documents.  Every partition of documents indexes blocks of them and runs every
query by MaxScore: terms are ordered by score bound; those whose bounds add up to
less than the k-th best score so far are non-essential and are only probed, for
documents that can still get in.  Shards are merged by a last selection.  A term's
score is a whole number of units of 2 ** -24, so that sums don't depend on their
order.  Results are exactly those of scoring every document.

Ties go to the lesser doc_id.  Documents and queries without a word, or null, match
nothing; a document scores only if it shares a term with the query.  Rows of one
item_id are one query that has the terms of all of them.  Rows of one doc_id are
documents of their own for the counts, and the best of them is kept.  Very long texts
are taken whole; other columns, whatever their names, are ignored; an empty table of
documents or queries gives no rows.
Queries are sent to the shards in groups of at most ``group_bytes`` of text, with
one pass over the documents for each group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Words, text_chunks

K = 10
K1, B = 1.2, 0.75
GROUP_BYTES = 16 << 20
DECIMALS = 4
UNIT = float(1 << 24)


def _postings(w: Words, rows: int, terms: np.ndarray):
    """Postings of the wanted terms in a chunk, sorted by term: term number, row, frequency."""
    at = np.searchsorted(terms, w.hash)
    at[at == len(terms)] = 0
    held = terms[at] == w.hash if len(terms) else np.zeros(len(w.hash), bool)
    both, n = np.unique(at[held] * rows + w.row[held], return_counts=True)
    return both // max(rows, 1), both % max(rows, 1), n


def _statistics(docs: DataFrame, terms: np.ndarray):
    """Document frequency of each term, number of documents with a word, and their mean length."""

    def count(batches):
        df = np.zeros(len(terms), np.int64)
        n = total = 0
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                w = Words(data, offsets)
                term, _, _ = _postings(w, len(offsets) - 1, terms)
                df += np.bincount(term, minlength=len(terms))
                n += int((np.diff(w.first) > 0).sum())
                total += len(w.hash)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, [-1, -2]])), pa.array(np.concatenate([df[at], [n, total]]))], names=["term", "n"])

    found = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms), np.int64)
    term, n = found.column("term").to_numpy(), found.column("n").to_numpy()
    df[term[term >= 0]] = n[term >= 0]
    number, total = int(n[term == -1].sum()), int(n[term == -2].sum())
    return df, number, total / number if number else 0.0


class Best:
    """The k best (score, doc_id) so far."""

    __slots__ = ("k", "score", "doc")

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0), np.zeros(0, np.int64)

    def least(self) -> float:
        return self.score[-1] if len(self.score) == self.k else 0.0

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))
        _, first = np.unique(doc[order], return_index=True)
        order = order[np.sort(first)][: self.k]
        self.score, self.doc = score[order], doc[order]


def max_score(lists, bounds: np.ndarray, best: Best, docs: np.ndarray) -> None:
    """One query over one block.  lists: (rows, scores) of each term, rows ascending; bounds: the most each term gives."""
    order = np.argsort(bounds, kind="stable")
    below = np.cumsum(bounds[order])
    slack = 1e-9 * (below[-1] if len(below) else 0.0)
    least = best.least()
    split = int(np.searchsorted(below, least - slack, side="left")) if least > 0 else 0
    essential = [lists[t] for t in order[split:]]
    if not essential:
        return
    rows, inverse = np.unique(np.concatenate([r for r, _ in essential]), return_inverse=True)
    score = np.bincount(inverse, weights=np.concatenate([s for _, s in essential]), minlength=len(rows))
    for j in range(split - 1, -1, -1):
        held = score + below[j] >= least - slack
        rows, score = rows[held], score[held]
        if not len(rows):
            return
        r, s = lists[order[j]]
        at = np.minimum(np.searchsorted(r, rows), len(r) - 1)
        score = score + np.where(r[at] == rows, s[at], 0.0)
    held = score >= least - slack
    best.add(score[held], docs[rows[held]])


def _search(docs: DataFrame, queries: list[tuple[int, np.ndarray]], terms: np.ndarray, k: int) -> DataFrame:
    df, number, mean = _statistics(docs, terms)
    idf = np.log(1 + (number - df + 0.5) / (df + 0.5))
    shared = docs.sparkSession.sparkContext.broadcast((queries, terms, idf, mean))

    def search(batches):
        queries, terms, idf, mean = shared.value
        best = [Best(k) for _ in queries]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, data, offsets in text_chunks(batch.column(1), limit=4 << 20):
                rows = len(offsets) - 1
                w = Words(data, offsets)
                term, row, n = _postings(w, rows, terms)
                size = np.diff(w.first)[row]
                score = np.rint(UNIT * idf[term] * (n * (K1 + 1)) / (n + K1 * (1 - B + B * size / mean)))
                start = np.searchsorted(term, np.arange(len(terms) + 1))
                most = np.zeros(len(terms))
                some = np.flatnonzero(np.diff(start))
                if not len(some):
                    continue
                most[some] = np.maximum.reduceat(score, start[some])
                doc = ids[first : first + rows]
                for (_, wanted), held in zip(queries, best):
                    here = wanted[most[wanted] > 0]
                    if len(here):
                        max_score([(row[start[t] : start[t + 1]], score[start[t] : start[t + 1]]) for t in here], most[here], held, doc)
        for (query, _), held in zip(queries, best):
            if len(held.doc):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held.doc), query)), pa.array(held.doc), pa.array(held.score)], names=["item_id", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, "item_id long, doc_id long, score double")


def top_documents(docs: DataFrame, queries: DataFrame, k: int = K, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every query row (item_id, text)."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    asked = queries.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    groups = max(1, -(-int(size) // group_bytes))
    found = None
    for g in range(groups):
        table = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).toArrow().sort_by("item_id")
        ids, wanted = table.column("item_id").to_numpy(), {}
        for first, data, offsets in text_chunks(table.column("text")):
            w = Words(data, offsets)
            for i in range(len(offsets) - 1):
                wanted.setdefault(int(ids[first + i]), []).append(w.hash[w.first[i] : w.first[i + 1]])
        wanted = {i: np.unique(np.concatenate(x)) for i, x in wanted.items()}
        terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *wanted.values()]))
        prepared = [(i, np.searchsorted(terms, x)) for i, x in wanted.items() if len(x)]
        part = _search(docs, prepared, terms, k)
        found = part if found is None else found.union(part)
    found = found.groupBy("item_id", "doc_id").agg(F.max("score").alias("score"))
    score = F.round(F.col("score") / F.lit(UNIT), DECIMALS)
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", score.alias("score"))


ORACLE = f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
size AS (SELECT doc_id, sum(n) AS size FROM tf GROUP BY ALL),
stats AS (SELECT count(*) AS docs, avg(size) AS mean FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, sum(round({UNIT} * ln(1 + (docs - df + 0.5) / (df + 0.5)) * (n * {K1 + 1}) / (n + {K1} * (1 - {B} + {B} * size / mean)))) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN size USING (doc_id), stats GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores)
SELECT item_id, rank::INTEGER AS rank, doc_id, round(score / {UNIT}, {DECIMALS}) AS score FROM ranked WHERE rank <= {K}
"""
