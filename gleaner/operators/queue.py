"""The source-job queue as transitions from one snapshot of a table to the next.

Nothing is locked: one writer applies a transition and stores its result.  Columns
of jobs: id, source_id, status, requested_days_back, attempt_count, worker_id,
enqueued_at, started_at, heartbeat_at, completed_at, error, stats.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STATUSES = ("queued", "running", "completed", "failed", "cancelled")
STALE = "Recovered after stale worker heartbeat"
DISABLED = "Source disabled before processing"
LEGACY = "Legacy pending queue cleared before FIFO source jobs"


def _set(df: DataFrame, where: Column, **values) -> DataFrame:
    """The table with these columns changed in the rows that meet the condition."""
    flagged = df.withColumn("_hit", F.coalesce(where, F.lit(False)))
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        flagged = flagged.withColumn(name, F.when(F.col("_hit"), value.cast(df.schema[name].dataType)).otherwise(F.col(name)))
    return flagged.drop("_hit")


def with_source(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """Jobs with their source's key, name, category, configuration and enabled flag."""
    named = sources.select(F.col("id").alias("source_id"), "source_key", F.col("name").alias("source_name"), F.col("category").alias("source_category"), "config", "enabled")
    return jobs.join(named, "source_id")


def claimable(jobs: DataFrame, sources: DataFrame, n: int = 1) -> DataFrame:
    """The oldest queued jobs of enabled sources."""
    return with_source(jobs, sources).where("status = 'queued' AND enabled").orderBy("id").limit(n)


def claim(jobs: DataFrame, sources: DataFrame, worker: str, as_of: Column) -> DataFrame:
    """The oldest claimable job starts running, unless any job runs."""
    worker = worker.strip()
    if not worker:
        raise ValueError("workerId cannot be empty")
    running = jobs.where("status = 'running'").limit(1).select(F.lit(True).alias("_busy"))
    free = claimable(jobs, sources).select(F.col("id").alias("_next")).join(running, F.lit(True), "left_anti")
    joined = jobs.join(F.broadcast(free), jobs["id"] == free["_next"], "left")  # one row at most
    out = _set(joined, F.col("_next").isNotNull(), status="running", attempt_count=F.col("attempt_count") + 1, worker_id=worker, started_at=as_of, heartbeat_at=as_of, completed_at=None, error=None)
    return out.drop("_next")


def heartbeat(jobs: DataFrame, job_id: int, as_of: Column, worker: str | None = None) -> tuple[DataFrame, bool]:
    """A running job's heartbeat; whether there was such a job (of this worker, if one is named)."""
    hit = (F.col("id") == job_id) & (F.col("status") == "running")
    if worker:
        hit = hit & (F.col("worker_id") == worker)
    return _set(jobs, hit, heartbeat_at=as_of), not jobs.where(hit).isEmpty()


def stale(jobs: DataFrame, as_of: Column, minutes: float = 120) -> DataFrame:
    """Running jobs whose last sign of life, to the second, is more than so many whole minutes old."""
    if not minutes >= 1:
        raise ValueError("staleAfterMinutes must be at least 1")
    seen = F.date_trunc("second", F.coalesce("heartbeat_at", "started_at", "enqueued_at"))
    return jobs.where((F.col("status") == "running") & (seen < F.date_trunc("second", as_of) - F.make_dt_interval(mins=F.lit(int(minutes)))))


def requeue_stale(jobs: DataFrame, job_urls: DataFrame, as_of: Column, minutes: float = 120) -> tuple[DataFrame, DataFrame]:
    """Stale jobs are queued again and their failed URLs are pending again."""
    lost = stale(jobs, as_of, minutes).select(F.col("id").alias("_lost"))
    out = _set(jobs.join(lost, jobs["id"] == lost["_lost"], "left"), F.col("_lost").isNotNull(), status="queued", worker_id=None, started_at=None, heartbeat_at=None, completed_at=None, error=STALE)
    links = _set(job_urls.join(lost, job_urls["source_job_id"] == lost["_lost"], "left"), F.col("_lost").isNotNull() & (F.col("status") == "failed"), status="pending", failed_reason=None, crawled_at=None)
    return out.drop("_lost"), links.drop("_lost")


def stable_json(value) -> str:
    """JSON with sorted keys and no spaces; absent (None) members of objects are dropped by the caller."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def _running(jobs: DataFrame, job_id: int, what: str) -> Column:
    hit = (F.col("id") == job_id) & (F.col("status") == "running")
    if jobs.where(hit).isEmpty():
        raise ValueError(f"Cannot {what} source job {job_id}: it is not running")
    return hit


def complete(jobs: DataFrame, job_id: int, as_of: Column, stats=None) -> DataFrame:
    hit = _running(jobs, job_id, "complete")
    return _set(jobs, hit, status="completed", completed_at=as_of, heartbeat_at=as_of, error=None, stats=None if stats is None else stable_json(stats))


def fail(jobs: DataFrame, job_id: int, error: str, as_of: Column, retry: bool = False, stats=None) -> DataFrame:
    hit = _running(jobs, job_id, "fail")
    changes = dict(error=error.strip() or "Unknown source job failure", stats=None if stats is None else stable_json(stats))
    if retry:
        return _set(jobs, hit, status="queued", worker_id=None, started_at=None, heartbeat_at=None, completed_at=None, **changes)
    return _set(jobs, hit, status="failed", completed_at=as_of, heartbeat_at=as_of, **changes)


def enqueue(jobs: DataFrame, sources: DataFrame, source: dict, key: str, config: str, as_of: Column, days_back: int = 365) -> tuple[DataFrame, DataFrame, bool]:
    """Source inserted or refreshed and enabled; a job queued unless one of this source is active."""
    if days_back != 365:
        raise ValueError("requestedDaysBack must be exactly 365")
    spark = jobs.sparkSession
    known = sources.where(F.col("source_key") == key).select("id").first()
    if known:
        source_id = known.id
        sources = _set(sources, F.col("source_key") == key, name=source["name"].strip(), category=source.get("category"), config=config, enabled=True, updated_at=as_of)
    else:
        source_id = (sources.agg(F.max("id")).first()[0] or 0) + 1
        row = spark.range(1).select(*[F.lit({"id": source_id, "source_key": key, "name": source["name"].strip(), "category": source.get("category"), "config": config, "enabled": True}.get(f.name)).cast(f.dataType).alias(f.name) if f.name not in ("created_at", "updated_at") else as_of.cast(f.dataType).alias(f.name) for f in sources.schema])
        sources = sources.unionByName(row)
    if not jobs.where((F.col("source_id") == source_id) & F.col("status").isin("queued", "running")).isEmpty():
        return jobs, sources, False
    job_id = (jobs.agg(F.max("id")).first()[0] or 0) + 1
    fixed = {"id": job_id, "source_id": source_id, "status": "queued", "requested_days_back": days_back, "attempt_count": 0}
    row = spark.range(1).select(*[(as_of if f.name == "enqueued_at" else F.lit(fixed.get(f.name))).cast(f.dataType).alias(f.name) for f in jobs.schema])
    return jobs.unionByName(row), sources, True


def set_enabled(jobs: DataFrame, sources: DataFrame, source_id: int, enabled: bool, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Enables or disables a source; disabling cancels its queued jobs and is refused while one runs."""
    mine = F.col("source_id") == source_id
    if not enabled:
        running = jobs.where(mine & (F.col("status") == "running")).orderBy("id").first()
        if running:
            raise ValueError(f"Cannot disable source {source_id} while job {running.id} is running")
    if sources.where(F.col("id") == source_id).isEmpty():
        raise ValueError(f"Source not found: {source_id}")
    if not enabled:
        jobs = _set(jobs, mine & (F.col("status") == "queued"), status="cancelled", completed_at=as_of, error=DISABLED)
    return jobs, _set(sources, F.col("id") == source_id, enabled=enabled, updated_at=as_of)


def clear_legacy(urls: DataFrame, as_of: Column, reason: str = LEGACY) -> DataFrame:
    """Pending URLs that no job owns are skipped."""
    return _set(urls, (F.col("status") == "pending") & F.col("source_job_id").isNull(), status="skipped", crawled_at=as_of, failed_reason=reason)


def mark_urls(rows: DataFrame, changes: DataFrame, as_of: Column, key: str | list[str] = "url_id", order: Column | None = None) -> DataFrame:
    """Sets statuses from (key, new_status, reason): all but pending count an attempt and stamp the time.

    Of several changes for one key the last in ``order`` stays (by status and reason where no
    order is given) and each counts its attempt, as if they had come one by one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    done = F.col("new_status") != "pending"
    value = F.struct("new_status", "reason")
    last = changes.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(value, order if order is not None else value).alias("_v"), F.count_if(done).cast("int").alias("_tries"))
    on = [rows[k] == last[f"_{k}"] for k in keys]
    hit = F.col("_v").isNotNull()
    out = rows.join(last, on, "left").withColumn("crawl_attempt_count", F.col("crawl_attempt_count") + F.coalesce("_tries", F.lit(0)))
    out = _set(out, hit, status=F.col("_v.new_status"), failed_reason=F.col("_v.reason"), crawled_at=F.when(F.col("_v.new_status") != "pending", as_of))
    return out.drop("_v", "_tries", *[f"_{k}" for k in keys])


def link_articles(links: DataFrame, found: DataFrame) -> DataFrame:
    """Sets article_id of (source_job_id, url_id) pairs; of several for one pair the greatest stays."""
    new = found.groupBy("source_job_id", "url_id").agg(F.max("article_id").alias("_article"))
    return links.join(new, ["source_job_id", "url_id"], "left").withColumn("article_id", F.coalesce("_article", "article_id")).drop("_article")


def retry_failed(links: DataFrame, job_id: int) -> DataFrame:
    """The failed URLs of a job are pending again."""
    return _set(links, (F.col("source_job_id") == job_id) & (F.col("status") == "failed"), status="pending", failed_reason=None, crawled_at=None)


def status_counts(jobs: DataFrame, statuses=STATUSES) -> DataFrame:
    """(status, n) with every status, 0 where none, and the total."""
    dim = jobs.sparkSession.createDataFrame([(k, s) for k, s in enumerate(statuses)], "ord int, status string")
    counts = jobs.groupBy("status").agg(F.count("*").alias("n"))
    filled = F.broadcast(dim).join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))
    return filled.unionByName(filled.agg(F.sum("n").alias("n")).select(F.lit("total").alias("status"), "n"))


def latest(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last written row of each key: what replacing rows one by one leaves."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")
