"""Tables as Parquet folders, their schemas and constraints.

A table is the parts that its latest manifest lists.  A write adds parts and then the
next manifest, which is created or refused as a whole, so a reader or a failed job
never sees half of one, and of two writers one fails.  All goes through Hadoop's file
systems: a folder may lie in any store that the cluster shares.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import dates
from gleaner.functions.session import cut
from gleaner.operators.identity import duplicates, first_seen, without_matches
from gleaner.operators.queue import STATUSES

VERSION = 5
SCHEMAS = {
    "sources": "id long, source_key string, name string, category string, config string, enabled boolean, created_at timestamp, updated_at timestamp",
    "source_jobs": "id long, source_id long, status string, requested_days_back int, attempt_count int, worker_id string, enqueued_at timestamp, started_at timestamp, heartbeat_at timestamp, completed_at timestamp, error string, stats string",
    "urls": "id long, url string, canonical_url string, source_name string, source_category string, discovery_method string, status string, crawl_attempt_count int, claimed_at timestamp, crawled_at timestamp, failed_reason string, source_id long, source_job_id long, created_at timestamp",
    "source_job_urls": "source_job_id long, url_id long, article_id long, status string, crawl_attempt_count int, failed_reason string, crawled_at timestamp",
    "rejected_pages": "id long, url string, source_id long, source_job_id long, stage string, reason_code string, reason_details string, title string, published_date string, text_length int, content_hash string, created_at timestamp",
    "articles": "id long, url string, canonical_url string, source_name string, source_category string, source_id long, source_job_id long, title string, published_date string, text string, content_hash string, quality_score double, cleaned_at timestamp",
    "article_classifications": "id long, article_id long, is_news_article boolean, is_relevant boolean, reason string, model string, classified_at timestamp",
    "matches": "id long, article_id long, url string, source_name string, category string, keyword string, reason string, model string, created_at timestamp",
}
URL_STATUSES = ("pending", "crawled", "skipped", "failed")


class Store:
    """Named tables below a folder.  Missing ones read as empty, missing columns as null."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self, name: str) -> list[int]:
        path, files = self._path(f"{name}.manifests")
        return sorted(int(f.getPath().getName()) for f in files.listStatus(path) if f.getPath().getName().isdigit()) if files.exists(path) else []

    def _parts(self, name: str) -> tuple[int, list[str]]:
        """Number and parts of the latest manifest; 0 and none where there is no table."""
        known = self._manifests(name)
        if not known:
            return 0, []
        path, _ = self._path(f"{name}.manifests", str(known[-1]))
        return known[-1], json.loads(self.spark.read.text(path.toString(), wholetext=True).first().value)

    def _publish(self, name: str, number: int, parts: list[str]) -> None:
        path, files = self._path(f"{name}.manifests", str(number))
        out = files.create(path, False)  # an error if another writer was there first
        out.write(json.dumps(parts).encode())
        out.close()

    def _part(self, name: str, df: DataFrame) -> str:
        part = f"{name}-{uuid.uuid4().hex}"
        cells = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema(name)]
        df.select(*cells).write.parquet(f"{self.folder}/{part}")
        return part

    def schema(self, name: str):
        return self.spark.createDataFrame([], SCHEMAS[name]).schema

    def exists(self, name: str) -> bool:
        return bool(self._manifests(name))

    def tables(self) -> dict[str, list[str]]:
        """Existing tables with their columns."""
        return {name: self.schema(name).names for name in SCHEMAS if self.exists(name)}

    def has_column(self, name: str, column: str) -> bool:
        return column in self.tables().get(name, [])

    def read(self, name: str) -> DataFrame:
        _, parts = self._parts(name)
        if not parts:
            return self.spark.createDataFrame([], self.schema(name))
        return self.spark.read.schema(self.schema(name)).parquet(*[f"{self.folder}/{p}" for p in parts])

    def write(self, name: str, df: DataFrame) -> None:
        """Replaces a table, whose keys may not occur twice."""
        df = cut(df)
        check_table(name, df)
        number, _ = self._parts(name)
        self._publish(name, number + 1, [self._part(name, df)])

    def append(self, name: str, rows: DataFrame, order: list[Column]) -> None:
        """Adds rows as a new part, with ids (where the table has them) that follow those held, in this order."""
        number, parts = self._parts(name)
        if "id" in self.schema(name).names:
            rows = numbered(rows, self.read(name), order)
        self._publish(name, number + 1, [*parts, self._part(name, rows)])

    def extend(self, name: str, rows: DataFrame) -> None:
        """Adds rows as they are, ids included, as a new part."""
        number, parts = self._parts(name)
        self._publish(name, number + 1, [*parts, self._part(name, rows)])


def numbered(rows: DataFrame, held: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with dense ids after the greatest held one: ranks within range partitions, put end to end."""
    from pyspark.sql import Window as W

    last = held.agg(F.max("id")).first()[0] or 0
    ranged = cut(rows.drop("id").repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    local = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    sizes = {r._p: r.n for r in ranged.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(total)]
        total += sizes[p]
    base = F.try_element_at(F.create_map(*before), F.col("_p")) if before else F.lit(0)
    return ranged.withColumn("id", (local + base + last).cast("long")).drop("_p")


def new_urls(found: DataFrame, known: DataFrame, order: list[Column]) -> DataFrame:
    """Found URLs that are new by url and canonical URL, first seen first."""
    once = first_seen(found, ["url"], order)
    with_canonical = first_seen(once.where("canonical_url IS NOT NULL"), ["canonical_url"], order)
    return without_matches(with_canonical.unionByName(once.where("canonical_url IS NULL")), known, ("url", "canonical_url"))


def new_links(found: DataFrame, known: DataFrame, links: DataFrame) -> DataFrame:
    """(source_job_id, url_id) pairs of found URLs with their job that aren't linked yet, known URLs by url, else canonical URL."""
    from gleaner.operators.identity import lookup

    if "input_id" not in found.columns:
        found = cut(found.withColumn("input_id", F.monotonically_increasing_id()))
    ids = lookup(found, known, "input_id", ("url", "canonical_url"))
    pairs = found.join(ids, "input_id").select("source_job_id", F.col("id").alias("url_id")).where("source_job_id IS NOT NULL").distinct()
    return pairs.join(links.select("source_job_id", "url_id"), ["source_job_id", "url_id"], "left_anti")


def pending(urls: DataFrame, limit: int, source_like: str | None = None, source_id: int | None = None, domains: list[str] | None = None) -> DataFrame:
    """Pending URLs, oldest first; an empty list of domains gives none."""
    rows = urls.where("status = 'pending'")
    if source_like:
        rows = rows.where(F.col("source_name").ilike(f"%{source_like}%"))
    if source_id is not None:
        rows = rows.where(F.col("source_id") == source_id)
    if domains is not None:
        hit = F.lit(False)
        for d in domains:
            hit = hit | F.lower("url").contains(d.lower())
        rows = rows.where(hit)
    return rows.orderBy("id").limit(limit)


def job_pending(links: DataFrame, urls: DataFrame, jobs: DataFrame, sources: DataFrame, job_id: int | None = None, limit: int | None = None) -> DataFrame:
    """Pending URLs of jobs with their job and source: four-way inner join.  With a limit the oldest ones, in order."""
    held = links.where("status = 'pending'").select("source_job_id", "url_id")
    if job_id is not None:
        held = held.where(F.col("source_job_id") == job_id)
    named = jobs.select(F.col("id").alias("source_job_id"), F.col("source_id").alias("_source")).join(sources.select(F.col("id").alias("_source"), F.col("name").alias("job_source_name")), "_source").drop("_source")
    found = held.join(named, "source_job_id").join(urls.drop("source_job_id", "status"), F.col("url_id") == F.col("id"))
    return found if limit is None else found.orderBy("id", "source_job_id").limit(limit)


def pending_count(urls: DataFrame, links: DataFrame, job_id: int | None = None, source_id: int | None = None, source_like: str | None = None) -> int:
    """Pending URLs of a job, else of a source by id, else by a part of its name, else all."""
    if job_id is not None:
        return links.where((F.col("status") == "pending") & (F.col("source_job_id") == job_id)).count()
    rows = urls.where("status = 'pending'")
    if source_id is not None:
        rows = rows.where(F.col("source_id") == source_id)
    elif source_like:
        rows = rows.where(F.col("source_name").ilike(f"%{source_like}%"))
    return rows.count()


def violations(rows: DataFrame, **rules: Column) -> DataFrame:
    """(rule, n): how many rows break each rule; a rule that is null for a row holds."""
    counts = rows.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"`{k}`").alias("n")) for k in rules])).alias("r")).select("r.*")


def check(rows: DataFrame, **rules: Column) -> None:
    """Raises a ValueError naming the rules that some row breaks."""
    broken = violations(rows, **rules).where("n > 0").collect()
    if broken:
        raise ValueError("constraints broken: " + ", ".join(f"{r.rule} ({r.n} rows)" for r in broken))


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once; a key with an unknown part doesn't count."""
    for k in key:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def check_unique(rows: DataFrame, *key: str) -> None:
    """Raises where a key whose parts are all known occurs twice."""
    if not repeated(rows, *key).isEmpty():
        raise ValueError(f"not unique: {', '.join(key)}")


#: Keys that may not occur twice in a table.
UNIQUE = {"sources": [("source_key",)], "urls": [("url",), ("canonical_url",)], "source_job_urls": [("source_job_id", "url_id")], "articles": [("url",)], "article_classifications": [("article_id",)], "matches": [("article_id", "category", "keyword")]}


def check_table(name: str, rows: DataFrame) -> None:
    """Raises where a table's keys occur twice."""
    for key in UNIQUE.get(name, []):
        check_unique(rows, *key)


def check_jobs(jobs: DataFrame) -> None:
    check(jobs, status=~F.col("status").isin(*STATUSES), days_back=F.col("requested_days_back") != 365)
    check_unique(jobs.where(F.col("status").isin("queued", "running")), "source_id")


def check_links(links: DataFrame) -> None:
    check(links, status=~F.col("status").isin(*URL_STATUSES))
    check_unique(links, "source_job_id", "url_id")


def article_rules(as_of: Column) -> dict[str, Column]:
    """What is wrong with a job's article, rule by rule."""
    at = dates.parse_lax(F.col("published_date"))
    return {
        "canonical_url": F.col("canonical_url").isNull(), "published_date": at.isNull() | ~dates.in_window(at, as_of),
        "text": F.coalesce(F.length("text"), F.lit(0)) < 700, "quality_score": F.coalesce(F.col("quality_score"), F.lit(0)) < 70,
    }


def check_articles(new: DataFrame, as_of: Column, held: DataFrame | None = None) -> None:
    """Job-owned articles need a canonical URL, a date in the window, 700 characters, a score of 70, and no double.

    Rows without a job are free of these rules.
    """
    owned = new.where("source_job_id IS NOT NULL")
    check(owned, **article_rules(as_of))
    if held is not None and not duplicates(owned, held, "id", own_id="id").isEmpty():
        raise ValueError("constraints broken: duplicate article")


def orphans(child: DataFrame, parent: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Rows whose reference names no row of the parent."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_k")), F.col(column) == F.col("_k"), "left_anti")
