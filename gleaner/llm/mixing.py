"""Mixing sources to target weights by Poisson replication.

Each source gets the mean repetition rate that brings its characters to its
target share of the output.  A document's number of copies inverts the Poisson
distribution of that mean at a uniform value hashed from (seed, doc_id); its
copies are exploded and all rows shuffled globally by a second hash.

Weights default to size ** alpha over the sources.  A null source is a source of
its own; sources without characters, or without a target weight where weights
are given, get no copies.  Null and empty texts count no characters but are
repeated at their source's rate.  Repeated rows get equal counts.  A null doc_id
hashes as an empty string.  Input columns called ``copy`` or ``shuffle_key`` are
replaced; all others are carried through, very long texts whole.  An empty table
gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, fresh, partitions

SEED = 17
ALPHA = 0.7
BROADCAST_SOURCES = 50_000


def uniform(*parts):
    """A hashed uniform value in [0, 1) of 52 bits."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def poisson_steps(rate: float) -> list[float]:
    """Values of the distribution function, up to where it is 1 in double precision."""
    if not rate > 0:
        return []
    most = int(rate + 12 * math.sqrt(rate) + 30)
    k = np.arange(most)
    return np.cumsum([math.exp(i * math.log(rate) - rate - math.lgamma(i + 1)) for i in k]).tolist()


def _steps(batches):
    for batch in batches:
        steps = [poisson_steps(r or 0.0) for r in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(steps, pa.list_(pa.float64()))], names=["_source", "_rate", "_steps"])


def rates(docs: DataFrame, weights: dict | None = None, repeat: float = 1.0, alpha: float = ALPHA) -> DataFrame:
    """(_source, _rate): mean copies of a document of each source, from characters counted over all documents."""
    size = docs.groupBy(F.col("source").alias("_source")).agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("double").alias("_size"))
    size = cut(size.where("_size > 0"))
    if weights is None:
        weighed = size.withColumn("_weight", F.pow("_size", F.lit(float(alpha))))
    else:
        named = size.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_source string, _weight double")
        weighed = size.join(named, size["_source"].eqNullSafe(named["_source"])).select(size["_source"], "_size", "_weight").where("_weight > 0")
    total = weighed.agg(F.sum("_weight").alias("w")).first().w
    volume = size.agg(F.sum("_size").alias("s")).first().s
    share = F.lit(float(repeat) * (volume or 0.0)) * F.col("_weight") / F.lit(total or 1.0)
    return weighed.select("_source", (share / F.col("_size")).alias("_rate"))


def mixed(docs: DataFrame, weights: dict | None = None, repeat: float = 1.0, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """The documents, each repeated by its count, in a globally shuffled order, with ``copy`` and ``shuffle_key``."""
    spark = docs.sparkSession
    source, steps, u, n = (fresh(docs, c) for c in ("_source", "_steps", "_u", "_n"))
    table = cut(rates(docs, weights, repeat, alpha).mapInArrow(_steps, "_source string, _rate double, _steps array<double>"))
    few = table.count() <= BROADCAST_SOURCES
    table = table.select(F.col("_source").alias(source), F.col("_steps").alias(steps))
    if few:
        table = F.broadcast(table)
    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    counted = docs.select(*kept).join(table, F.col("source").eqNullSafe(F.col(source)))
    counted = counted.withColumn(u, uniform(F.lit(str(seed)), "doc_id") / F.lit(float(1 << 52)))
    counted = counted.withColumn(n, F.size(F.filter(steps, lambda c: c <= F.col(u)))).where(F.col(n) > 0)
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(n))))
    copies = copies.withColumn("shuffle_key", uniform(F.lit(f"{seed}/order"), "doc_id", "copy"))
    size = partitions(spark)
    place = F.floor(F.col("shuffle_key") / F.lit(float(1 << 52)) * F.lit(size)).cast("int")
    return copies.select(*kept, "copy", "shuffle_key").repartitionById(size, place).sortWithinPartitions("shuffle_key", "doc_id", "copy")


ORACLE = f"""
WITH sizes AS (SELECT source, sum(length(text))::DOUBLE AS size FROM documents GROUP BY source HAVING sum(length(text)) > 0),
weighed AS (SELECT source, size, pow(size, {ALPHA}) AS weight FROM sizes),
rates AS (SELECT source, (SELECT sum(size) FROM sizes) * weight / (SELECT sum(weight) FROM weighed) / size AS rate FROM weighed),
mass AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM rates, unnest(range(0, CAST(floor(rate + 12 * sqrt(rate) + 30) AS BIGINT))) AS t(k)),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM mass),
counted AS (SELECT d.doc_id, any_value(d.text) AS text, any_value(d.lang) AS lang, d.source, any_value(d.n_chars) AS n_chars, count(*) AS n
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
   AND s.c <= ('0x' || substr(md5('{SEED}:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0
  GROUP BY d.doc_id, d.source)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
  ('0x' || substr(md5('{SEED}/order:' || doc_id || ':' || copy), 1, 13))::BIGINT AS shuffle_key
FROM counted, unnest(range(1, n + 1)) AS t(copy)
"""
