"""The quality gate over a stream: accepted articles and a quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.quality import Options, validated
from gleaner.functions.session import cut
from gleaner.operators.identity import KEYS, admitted

EVENTS = "doc_id long, url string, title string, published_date string, text string"


def split(candidates: DataFrame, as_of: Column, options: Options = Options(), held: DataFrame | None = None, order: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): duplicates of held or earlier accepted rows are quarantined as DUPLICATE."""
    judged = cut(validated(candidates, as_of, options))
    good = judged.where("accepted")
    unique = admitted(good, order, existing=held)
    double = good.join(unique.select(order), order, "left_anti").withColumn("reason_code", F.lit("DUPLICATE")).withColumn("accepted", F.lit(False))
    return unique, judged.where("NOT accepted").unionByName(double)


def run(stream: DataFrame, accepted: str, quarantine: str, checkpoint: str, as_of: Column, options: Options = Options()):
    """A query that appends each batch's accepted and quarantined rows below two folders.

    A batch is written under its number, so a batch that is run again replaces what it had
    written.  Identity is held against all accepted batches before it, of which the three keys
    alone are read.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(accepted)
        held = None
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "batch=*/*.parquet")):
            held = spark.read.option("basePath", accepted).parquet(accepted).where(F.col("batch") < number).select(*KEYS)
        good, bad = split(batch, as_of, options, held)
        good.write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, delay: str = "1 hour", size: str = "1 hour") -> DataFrame:
    """Events counted by type in tumbling windows; works on streams and tables alike."""
    timed = events.withWatermark("ts", delay) if events.isStreaming else events
    counts = timed.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counts.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
