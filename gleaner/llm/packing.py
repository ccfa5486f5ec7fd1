"""Best-fit packing planned on the histogram of lengths.

A document's length is its number of white-space separated tokens.  Documents
longer than ``capacity`` are cut into pieces of ``capacity`` tokens and a rest.
Best-fit decreasing runs over (length, count) pairs, never over documents: its
plan says which ranks within a length go to which sequences.  Documents take
their slots by their rank within their length.

Null and empty texts have no tokens and take no slot.  Repeated rows are packed
as often as they occur; rows that tie in doc_id and length may swap places,
which leaves the result the same.  Very long texts take as many pieces as they need.
Other columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored

CAPACITY = 2048
SALTS = 16
PLACED = "sequence long, position int"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing by counts.

    Rows (length, first rank, first sequence, items in each sequence, position of the first):
    ranks from the first one on fill one sequence after another.
    """
    out = []
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = {}
    made = 0

    def leave(room: int, low: int, n: int) -> None:
        if room > 0 and n > 0:
            if room not in open_:
                insort(rooms, room)
                open_[room] = []
            open_[room].append((low, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                low, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, low = capacity, made
                n = -(-left // (capacity // length))
                made += n
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, low, each, capacity - room))
                leave(room - each * length, low, full)
                rank, left, low, n = rank + full * each, left - full * each, low + full, n - full
            if n and left:
                out.append((length, rank, low, left, capacity - room))
                leave(room - left * length, low, 1)
                rank, left, low, n = rank + left, 0, low + 1, n - 1
            leave(room, low, n)
    return out


def salted(salts: int):
    """A part of each length by a hash of doc_id and start."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("start").cast("string"))
    return (F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("int") % salts).cast("int")


def packed(docs: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """(sequence, position, doc_id, start, length): which tokens of which document lie where.

    The rank within a length is taken in ``salts`` parts that are put end to end by their
    counts, so no length is ranked by one task.  The plan and the counts have at most
    capacity * salts rows whatever the number of documents.
    """
    tokens = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long")
    sized = docs.select("doc_id", tokens.alias("n")).where("n > 0")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(capacity).cast("long")))
    pieces = sized.select("doc_id", "n", start.alias("start")).select(
        "doc_id", F.col("start").cast("int").alias("start"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("start")).cast("int").alias("length"), salted(salts).alias("salt")
    )
    pieces = stored(pieces)
    table = pieces.groupBy("length", "salt").agg(F.count("*").alias("n")).toArrow()
    length, salt, n = (table.column(c).to_numpy() for c in ("length", "salt", "n"))
    by = np.zeros((capacity + 1, salts), dtype=np.int64)
    by[length, salt] = n
    before = np.cumsum(by, axis=1) - by
    total = by.sum(axis=1)
    rows = np.array(sorted(plan({int(k): int(total[k]) for k in np.flatnonzero(total)}, capacity)), dtype=np.int64).reshape(-1, 5)
    bounds = np.searchsorted(rows[:, 0], np.arange(capacity + 2))

    @F.pandas_udf(PLACED)
    def place(length: pd.Series, salt: pd.Series, number: pd.Series) -> pd.DataFrame:
        size = length.to_numpy()
        rank = before[size, salt.to_numpy()] + number.to_numpy() - 1
        row = np.empty(len(size), dtype=np.int64)
        for one in np.unique(size):
            at = size == one
            low, high = bounds[one], bounds[one + 1]
            row[at] = low + np.searchsorted(rows[low:high, 1], rank[at], side="right") - 1
        step, inside = np.divmod(rank - rows[row, 1], rows[row, 3])
        return pd.DataFrame({"sequence": rows[row, 2] + step, "position": (rows[row, 4] + inside * size).astype(np.int32)})

    number = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "start"))
    ranked = pieces.withColumn("number", number).withColumn("at", place("length", "salt", "number"))
    return ranked.select("at.sequence", "at.position", "doc_id", "start", "length")


#: One step of the recursion fills the sequences of one entry of the open ones, or new ones.
ORACLE = f"""
WITH RECURSIVE sized AS (SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS n FROM documents),
pieces AS MATERIALIZED (SELECT doc_id, s::INTEGER AS start, least({CAPACITY}, n - s)::INTEGER AS length, ('0x' || substr(md5(doc_id || ':' || s), 1, 4))::INTEGER % {SALTS} AS salt FROM (SELECT doc_id, n, unnest(range(0, n, {CAPACITY})) AS s FROM sized WHERE n > 0)),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY length ORDER BY salt, doc_id, start) - 1 AS rank FROM pieces),
counts AS MATERIALIZED (SELECT row_number() OVER (ORDER BY length DESC) AS i, length, count(*) AS n FROM pieces GROUP BY length),
step(i, length, need, rank, made, open, made_rows) AS (
  SELECT 1::BIGINT, length, n, 0::BIGINT, 0::BIGINT, []::STRUCT(room BIGINT, low BIGINT, n BIGINT)[], []::STRUCT(length BIGINT, rank BIGINT, low BIGINT, per BIGINT, position BIGINT)[] FROM counts WHERE i = 1
  UNION ALL
  SELECT CASE WHEN f.need = 0 THEN f.i + 1 ELSE f.i END, CASE WHEN f.need = 0 THEN c.length ELSE f.length END, CASE WHEN f.need = 0 THEN c.n ELSE f.need END, CASE WHEN f.need = 0 THEN 0 ELSE f.rank END, f.made, f.open, f.made_rows
  FROM (
    SELECT i, length, made, need - filled * per - part AS need, rank + filled * per + part AS rank,
      list_concat(open, list_filter([{{'room': room - per * length, 'low': low, 'n': filled}}, {{'room': room - part * length, 'low': low + filled, 'n': CASE WHEN part > 0 THEN 1 ELSE 0 END}}, {{'room': room, 'low': low + filled + (part > 0)::BIGINT, 'n': n - filled - (part > 0)::BIGINT}}], lambda x: x.room > 0 AND x.n > 0)) AS open,
      list_concat(CASE WHEN filled > 0 THEN [{{'length': length, 'rank': rank, 'low': low, 'per': per, 'position': {CAPACITY} - room}}] ELSE [] END,
        CASE WHEN part > 0 THEN [{{'length': length, 'rank': rank + filled * per, 'low': low + filled, 'per': part, 'position': {CAPACITY} - room}}] ELSE [] END) AS made_rows
    FROM (
      SELECT *, CASE WHEN n > filled AND need > filled * per THEN need - filled * per ELSE 0 END AS part
      FROM (SELECT *, room // length AS per, least(n, need // (room // length)) AS filled
        FROM (SELECT i, length, need, rank, coalesce(open[p].room, {CAPACITY}) AS room, coalesce(open[p].low, made) AS low,
            CASE WHEN p IS NULL THEN (need + ({CAPACITY} // length) - 1) // ({CAPACITY} // length) ELSE open[p].n END AS n, CASE WHEN p IS NULL THEN made + (need + ({CAPACITY} // length) - 1) // ({CAPACITY} // length) ELSE made END AS made,
            CASE WHEN p IS NULL THEN open ELSE list_concat(open[:p - 1], open[p + 1:]) END AS open
          FROM (SELECT *, CASE WHEN best IS NULL THEN NULL ELSE len(open) + 1 - list_position(list_transform(list_reverse(open), lambda x: x.room), best) END AS p
            FROM (SELECT *, list_min(list_transform(list_filter(open, lambda x: x.room >= length), lambda x: x.room)) AS best FROM step WHERE length IS NOT NULL))))))
  f LEFT JOIN counts c ON c.i = f.i + 1),
slots AS (SELECT r.length, r.rank AS first, r.low, r.per, r.position FROM (SELECT unnest(made_rows) AS r FROM step))
SELECT s.low + (p.rank - s.first) // s.per AS sequence, (s.position + ((p.rank - s.first) % s.per) * p.length)::INTEGER AS position, p.doc_id, p.start, p.length
FROM ranked p ASOF JOIN slots s ON p.length = s.length AND p.rank >= s.first
"""
