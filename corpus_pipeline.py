"""A corpus pipeline: raw documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns the documents it leaves, the
last one their places in sequences.  Between stages the rows are written as
Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import mixing, packing, simhash, substrings, toxicity
from gleaner.llm.shared import checkpoint_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go.

    Null and empty texts, and all texts where labels of one class are missing, stay; repeated
    rows go or stay together.  Columns pass unchanged, whatever their names; an empty table
    stays empty.  Long texts are scored whole.
    """
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays.

    Null, empty and word-free texts, and rows without a doc_id, are in no group and stay;
    repeated rows of the doc_id that stays all stay.  Columns pass unchanged, whatever their
    names; an empty table stays empty.
    """
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat one of an earlier document are cut out.

    The passage of the least doc_id stays.  A document of which no word is left goes; null,
    empty and short texts, and rows without a doc_id, stay as they are.  Columns other than
    text and n_chars pass unchanged; an empty table stays empty.  Long texts are taken whole.
    """
    return substrings.without_passages(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out to bring sources to their target weights, and shuffled.

    A null source is a source of its own; null and empty texts are repeated at their source's
    rate; repeated rows get equal counts.  A source without a character gets no copies.
    Columns pass unchanged, but those called ``copy`` or ``shuffle_key`` in the input are
    dropped; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    return mixing.mixed(docs).select(*kept)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents take their places in training sequences.

    Null and empty texts take none; repeated rows each take their own; long texts run over as
    many sequences as they need.  Other columns are left out; an empty table gives no rows.
    """
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", simhash_stage),
    ("substring dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained, iterative and sketch-based stages can't be put in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
