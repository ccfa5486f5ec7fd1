"""Identity of URLs and articles: ranked lookups, duplicate tests and ordered admission.

A test on url OR canonical OR hash is split into one equi-join for each key, so that
none plans as a nested loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions import session

KEYS = ("url", "canonical_url", "content_hash")


def first_seen(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in this order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def lookup(inputs: DataFrame, articles: DataFrame, input_id: str = "input_id", keys=KEYS) -> DataFrame:
    """(input_id, id, rank): the article each input is, by the first key that matches, then the least id.

    ``rank`` is the position of that key.  Null keys match nothing.
    """
    by_rank = F.posexplode(F.array(*keys)).alias("rank", "_key")
    left = inputs.select(input_id, by_rank).where("_key IS NOT NULL")
    right = articles.select("id", by_rank).where("_key IS NOT NULL").groupBy("rank", "_key").agg(F.min("id").alias("id"))
    best = left.join(right, ["rank", "_key"]).groupBy(input_id).agg(F.min(F.struct("rank", "id")).alias("_best"))
    return best.select(input_id, "_best.id", "_best.rank")


def duplicates(inputs: DataFrame, articles: DataFrame, input_id: str = "input_id", keys=("content_hash", "canonical_url"), own_id: str | None = None) -> DataFrame:
    """The inputs for which another article has an equal hash or canonical URL.

    ``own_id`` names the input's column with the id of the row it is, which doesn't count.
    """
    hits = []
    for key in keys:
        right = articles.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("id").alias("_low"), F.max("id").alias("_high"))
        joined = inputs.join(right, F.col(key) == F.col("_key"))
        if own_id:
            joined = joined.where((F.col("_low") != F.col(own_id)) | (F.col("_high") != F.col(own_id)))
        hits.append(joined.select(F.col(input_id).alias("_hit")))
    found = reduce(DataFrame.unionByName, hits).distinct()
    return inputs.join(found, inputs[input_id] == found["_hit"], "left_semi")


def without_matches(inputs: DataFrame, articles: DataFrame, keys=KEYS) -> DataFrame:
    """The inputs that share no key with an article: one anti-join for each key."""
    for key in keys:
        held = articles.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
        inputs = inputs.join(held, inputs[key] == held["_key"], "left_anti")
    return inputs


def admitted(inputs: DataFrame, order: str, existing: DataFrame | None = None, keys=KEYS, cut=None) -> DataFrame:
    """The inputs that one-by-one insertion would accept: each only if no accepted row shares a key with it.

    Rounds of set operations: a row that comes first under each of its keys is accepted,
    rows that share a key with an accepted one are refused, and the rest goes on.  Note
    that this isn't one row for each connected component.  ``cut`` ends a plan's lineage
    between rounds (a reliable checkpoint by default).  Each round settles at least the first
    row of every group that is left, so rounds end; a chain of rows takes half as many.
    """
    cut = cut or session.cut
    left = inputs if existing is None else without_matches(inputs, existing, keys)
    left = cut(left)
    accepted = []
    while True:
        first = reduce(lambda a, b: a & b, [F.col(k).isNull() | (F.col(order) == F.min(order).over(W.partitionBy(k))) for k in keys])
        flagged = cut(left.withColumn("_first", first))
        taken = flagged.where("_first").drop("_first")
        accepted.append(taken)
        left = cut(without_matches(flagged.where("NOT _first").drop("_first"), taken, keys))
        if left.isEmpty():
            return reduce(DataFrame.unionByName, accepted)


def outcomes(inputs: DataFrame, articles: DataFrame, order: str = "input_id") -> DataFrame:
    """What an upsert does with each input: adds ``outcome`` (insert, upgrade, refuse) and ``target_id``.

    An input that is a known article without a score upgrades it, unless another row has
    its hash or canonical URL; one that is a scored article is refused; of the rest those
    that ``admitted`` accepts are inserted.  Of several inputs for one target the first wins.
    """
    found = inputs.join(lookup(inputs, articles, order).drop("rank"), order, "left").join(articles.select(F.col("id"), F.col("quality_score").alias("_score")), "id", "left").withColumnRenamed("id", "target_id")
    legacy = found.where("target_id IS NOT NULL AND _score IS NULL").drop("_score")
    clash = duplicates(legacy, articles, order, own_id="target_id").select(F.col(order).alias("_clash"))
    free = first_seen(legacy.join(clash, legacy[order] == clash["_clash"], "left_anti"), ["target_id"], [F.col(order)])
    upgraded = admitted(free, order, keys=("canonical_url", "content_hash"))
    fresh = found.where("target_id IS NULL").drop("_score")
    after_upgrades = upgraded.select("url", "canonical_url", "content_hash")
    inserted = admitted(fresh, order, existing=after_upgrades)
    decided = upgraded.withColumn("outcome", F.lit("upgrade")).unionByName(inserted.withColumn("outcome", F.lit("insert")))
    settled = decided.select(F.col(order).alias("_in"), "outcome")
    return found.drop("_score").join(settled, F.col(order) == F.col("_in"), "left").drop("_in").withColumn("outcome", F.coalesce("outcome", F.lit("refuse")))
