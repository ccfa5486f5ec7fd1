"""A bounded, balanced sample of labelled texts, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int):
    """At most ``per_class`` texts of each class in hash order, and the share of class 1 among all labels.

    Gives (texts, 0/1 labels, share).  Labels are joined on doc_id; rows without a
    label, doc_id or text are left out, a doc_id with several labels takes the
    largest, and repeated documents count once.
    """
    from pyspark.sql.functions import broadcast

    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    picked = broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "_doc"))
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").join(picked, F.col("doc_id") == F.col("_doc"))
    once = texts.withColumn("_k", F.row_number().over(W.partitionBy("doc_id").orderBy("text"))).where("_k = 1")
    table = once.select("doc_id", "text", "label").toArrow().sort_by("doc_id")
    return table.column("text"), table.column("label").to_numpy(), (counts.get(1, 0) / total if total else 0.0)
