"""Session helpers."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def reliable(spark: SparkSession) -> SparkSession:
    """The session with a checkpoint folder: the configured shared one, a temporary one only on a single machine where none is set.

    A cluster without such a folder is an error: its executors don't share a machine's own.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Runs a plan once and cuts its lineage through reliable storage."""
    reliable(df.sparkSession)
    return df.checkpoint()
