"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bitplanes, covertree, html, mixing, packing, quality, simhash, substrings, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark, sf_dir):
    """Every document that has a near duplicate, with its group."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_mixing(spark, sf_dir):
    """The documents replicated to their sources' target weights, shuffled."""
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op3_substrings(spark, sf_dir):
    """Every passage of 50 words or more that repeats one of an earlier document."""
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir):
    """The quality of every document."""
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_html(spark, sf_dir):
    """The main text of every page."""
    return html.extracted(_table(spark, sf_dir, "pages"))


def op6_toxicity(spark, sf_dir):
    """The toxicity of every document."""
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_topk(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return topk.top_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_packing(spark, sf_dir):
    """The place of every token of every document in sequences of 2,048 tokens."""
    return packing.packed(_table(spark, sf_dir, "documents"))


def op9_covertree(spark, sf_dir):
    """Every embedding with its class of near duplicates (cosine of at least 0.95) and its number of links."""
    return covertree.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_bitplanes(spark, sf_dir):
    """All documents as compressed bit planes of token ids."""
    return bitplanes.blocks(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_mixing, op3_substrings, op4_quality, op5_html, op6_toxicity, op7_topk, op8_packing, op9_covertree, op10_bitplanes)}

ORACLE_SQL = {"op1_simhash": simhash.ORACLE, "op2_mixing": mixing.ORACLE, "op7_topk": topk.ORACLE, "op8_packing": packing.ORACLE, "op9_covertree": covertree.ORACLE}
