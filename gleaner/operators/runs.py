"""The writers, and the runs that drive them: discovery, crawl, job, queue, filter and classifier.

A run reads tables of a ``Store``, decides for all rows at once and writes the results
back.  Everything that reaches out (pages, sitemaps, the model) is a callable that the
caller injects, and the time is passed as ``as_of``.  One run at a time may write.
"""

from __future__ import annotations

import json
import time

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions import dates, quality, text, urls
from gleaner.functions.session import cut
from gleaner.operators import classify, identity, queue, reports, store as tables
from gleaner.sources import listings, pages, sitemaps

NO_LINK = "Duplicate canonical URL or content hash"
GAVE_UP = "Fetching failed after retries"


class GivenUp(Exception):
    """A job's failure that trying again won't mend; ``stats`` says how far it came."""

    def __init__(self, message: str, stats=None):
        super().__init__(message)
        self.stats = stats


# writers

def new_rows(found: DataFrame, known: DataFrame, links: DataFrame, numbered) -> tuple[DataFrame, DataFrame]:
    """(URLs to add, pairs of job and URL to add) of found URLs (position, url, canonical_url, source_job_id and others).

    ``numbered`` gives the added URLs their ids.
    """
    fresh = numbered(tables.new_urls(found, known, [F.col("position")]))
    after = known.select("id", "url", "canonical_url").unionByName(fresh.select("id", "url", "canonical_url"))
    return fresh, tables.new_links(found.withColumn("input_id", F.col("position")), after, links)


def insert_counts(found: DataFrame, fresh: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row (inserted, duplicated): a URL of a job counts where the job had not had it, another where it was not known."""
    new = fresh.where("source_job_id IS NULL").agg(F.count("*").alias("urls"))
    joined = pairs.agg(F.count("*").alias("pairs"))
    every = found.agg(F.count("*").alias("every"))
    inserted = F.col("urls") + F.col("pairs")
    return new.crossJoin(joined).crossJoin(every).select(inserted.alias("inserted"), (F.col("every") - inserted).alias("duplicated"))


def insert_urls(store, found: DataFrame, as_of: Column) -> dict:
    """Adds found URLs that are new by url and canonical URL, and associates all with their jobs; counts of both."""
    found = cut(found.select("position", "url", "canonical_url", "source_name", "source_category", "discovery_method", "source_id", "source_job_id"))
    known, links = store.read("urls"), store.read("source_job_urls")

    def numbered(rows: DataFrame) -> DataFrame:
        extra = rows.withColumn("status", F.lit("pending")).withColumn("crawl_attempt_count", F.lit(0)).withColumn("created_at", as_of)
        return cut(tables.numbered(extra.withColumn("id", F.lit(None).cast("long")), known, [F.col("position")]))

    fresh, pairs = new_rows(found, known, links, numbered)
    pairs = cut(pairs.withColumn("status", F.lit("pending")).withColumn("crawl_attempt_count", F.lit(0)))
    counts = insert_counts(found, fresh, pairs).first().asDict()
    store.extend("urls", fresh)
    store.extend("source_job_urls", pairs)
    return counts


def upserted(decided: DataFrame, articles: DataFrame, as_of: Column) -> DataFrame:
    """The articles held, those that an input upgrades with its values in place of their own (their url stays)."""
    changed = [c for c in articles.columns if c not in ("id", "url", "cleaned_at")]
    new = decided.where("outcome = 'upgrade'").select(F.col("target_id").alias("_of"), *[F.col(c).alias(f"_{c}") for c in changed])
    hit = F.col("_of").isNotNull()
    out = articles.join(new, articles["id"] == new["_of"], "left")
    values = {c: F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)) for c in changed} | {"cleaned_at": F.when(hit, as_of).otherwise(F.col("cleaned_at"))}
    return out.select(*[values.get(c, F.col(c)).alias(c) for c in articles.columns])


def upsert_articles(store, inputs: DataFrame, as_of: Column) -> DataFrame:
    """Inserts, upgrades or refuses articles (input_id and an article's columns); gives (input_id, outcome, article_id).

    An upgraded article loses its classifications and matches.  ``article_id`` is the article
    that the input now is, by the first of its keys that matches.
    """
    articles = store.read("articles")
    decided = cut(identity.outcomes(inputs, articles))
    upgraded = decided.where("outcome = 'upgrade'").select("target_id").distinct()
    if not upgraded.isEmpty():
        store.write("articles", upserted(decided, articles, as_of))
        for name in ("article_classifications", "matches"):
            rows = store.read(name)
            store.write(name, rows.join(upgraded, rows["article_id"] == upgraded["target_id"], "left_anti"))
    store.append("articles", decided.where("outcome = 'insert'").drop("target_id", "outcome").withColumn("cleaned_at", as_of), [F.col("input_id")])
    now = identity.lookup(decided, store.read("articles")).select("input_id", F.col("id").alias("article_id"))
    return decided.select("input_id", "outcome").join(now, "input_id", "left")


def reject_pages(store, rows: DataFrame, as_of: Column) -> None:
    """Appends rejections."""
    store.append("rejected_pages", rows.withColumn("created_at", as_of), [F.col("url")])


def marked(classifications: DataFrame, matches: DataFrame, results: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classifications, matches) after results: one row an article stays, and matches are those of the results alone.

    ``results`` has (article_id, is_news_article, is_relevant, reason, model), one row an article,
    ``found`` their matches.  Articles without a result keep what they have.
    """
    done = results.select(F.col("article_id").alias("_done")).distinct()
    rows = classifications.join(done, F.col("article_id") == F.col("_done"), "left_anti").unionByName(results, allowMissingColumns=True)
    kept = matches.join(done, F.col("article_id") == F.col("_done"), "left_anti").unionByName(found, allowMissingColumns=True)
    return rows.select(*classifications.columns), kept.select(*matches.columns)


# crawl

_FETCHED = "url_id long, attempts int, status int, content_type string, address string, final_url string, html string, error string"


def fetched_pages(rows: DataFrame, get, retries: int = 2) -> DataFrame:
    """The rows (url_id, url) with what ``get(url)`` gave: a dict of status, content_type, address, final_url and html.

    A call that raises is made again, ``retries`` times; what it raised last is ``error``.
    """
    names = ["status", "content_type", "address", "final_url", "html"]
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 5]

    def call(url):
        for attempt in range(1, retries + 2):
            try:
                got = get(url)
                return [attempt, *[got.get(n) if got else None for n in names], None]
            except Exception as e:  # noqa: BLE001 - the client is anybody's code
                error = f"{type(e).__name__}: {e}"
        return [attempt, None, None, None, None, None, error]

    def run(batches):
        for batch in batches:
            for i, url in zip(*(c.to_pylist() for c in batch.columns)):  # one page at a time is held
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([i, *call(url)], types)], names=["url_id", "attempts", *names, "error"])

    return rows.join(rows.select("url_id", "url").mapInArrow(run, _FETCHED), "url_id")


def judged(fetched: DataFrame, as_of: Column, options: quality.Options = quality.CRAWL) -> DataFrame:
    """Fetched pages with their article record and ``reason_code``: the first that turns a page away, null where it is accepted."""
    from gleaner.functions.addresses import private_host

    rows = pages.articles(fetched.withColumn("html", F.coalesce("html", F.lit(""))), F.coalesce("final_url", "url"), F.col("url"))
    private = F.col("address").isNull() | private_host(F.col("address"))
    code = pages.crawl_rejection(F.col("url"), F.col("status"), F.col("content_type"), private, F.coalesce("final_url", "url"), F.col("url"), F.col("is_article_document"))
    rows = cut(rows.withColumn("_code", code).withColumnRenamed("url", "requested_url").drop("html"))
    gate = quality.validated(rows.withColumn("url", F.coalesce("canonical_url", "final_url", "requested_url")).drop("canonical_url"), as_of, options)
    return gate.withColumn("reason_code", F.coalesce("_code", "reason_code")).drop("_code", "url").withColumnRenamed("requested_url", "url")


def counters(outcomes: DataFrame, pending_after: int = 0) -> DataFrame:
    """One row of a run's counters over (outcome): inserted, duplicate, rejected or failed."""
    n = {name: F.count_if(F.col("outcome").isin(*kinds)) for name, kinds in {"crawled": ("inserted", "duplicate"), "inserted": ("inserted",), "duplicates": ("duplicate",), "rejected": ("rejected",), "failed": ("failed",)}.items()}
    return outcomes.agg(F.count("*").alias("selected"), *[v.alias(k) for k, v in n.items()]).withColumn("pending_after", F.lit(pending_after).cast("long"))


def crawl(store, get, as_of: Column, job_id: int | None = None, limit: int = 100, source_id: int | None = None, source_like: str | None = None, retries: int = 2, options: quality.Options = quality.CRAWL) -> dict:
    """Fetches and judges the oldest pending URLs, stores articles and rejections, and sets the URLs' statuses; gives the counters.

    A URL of a job is marked in the job's own row alone.
    """
    known, links = store.read("urls"), store.read("source_job_urls")
    if job_id is None:
        rows = tables.pending(known, limit, source_like, source_id).withColumnRenamed("id", "url_id").drop("status")
    else:
        rows = tables.job_pending(links, known, store.read("source_jobs"), store.read("sources"), job_id, limit).drop("id")
    rows = cut(rows.select("url_id", "url", "source_name", "source_category", "source_id", F.lit(job_id).cast("long").alias("source_job_id")))
    skipped = urls.skip_article(F.col("url"))
    seen = fetched_pages(rows.where(~skipped), get, retries)
    found = cut(seen.unionByName(rows.where(skipped), allowMissingColumns=True))
    verdicts = cut(judged(found, as_of, options))
    failed = F.col("error").isNotNull()
    rejected = verdicts.where(~failed & F.col("reason_code").isNotNull())
    reject_pages(
        store,
        rejected.select(F.coalesce("final_url", "url").alias("url"), "source_id", "source_job_id", F.lit("article_quality").alias("stage"), "reason_code", F.to_json(F.struct("rejection_codes", "quality_score", "metrics")).alias("reason_details"), "title", "published_date", F.length("cleaned_text").alias("text_length"), "content_hash"),
        as_of,
    )
    good = verdicts.where(~failed & F.col("reason_code").isNull())
    inputs = good.select(
        F.col("url_id").alias("input_id"), F.coalesce("final_url", "url").alias("url"), "canonical_url", "source_name", "source_category", "source_id", "source_job_id", "title",
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_date"), F.col("cleaned_text").alias("text"), "content_hash", F.col("quality_score").cast("double").alias("quality_score"),
    )
    stored = cut(upsert_articles(store, cut(inputs), as_of))
    outcome = F.when(failed, "failed").when(F.col("reason_code").isNotNull(), "rejected").when(F.col("_outcome").isin("insert", "upgrade"), "inserted").otherwise("duplicate")
    results = verdicts.join(stored.select(F.col("input_id").alias("url_id"), F.col("outcome").alias("_outcome"), "article_id"), "url_id", "left").withColumn("outcome", outcome)
    status = F.when(F.col("outcome") == "failed", "failed").when(F.col("outcome") == "rejected", "skipped").otherwise("crawled")
    reason = F.when(F.col("outcome") == "failed", F.concat(F.lit(f"{GAVE_UP}: "), "error")).when(F.col("outcome") == "rejected", F.col("reason_code")).when(F.col("outcome") == "duplicate", NO_LINK)
    results = cut(results.select("url_id", "source_job_id", "article_id", "outcome", status.alias("new_status"), reason.alias("reason")))
    if job_id is None:
        store.write("urls", queue.mark_urls(known.withColumn("url_id", F.col("id")), results, as_of).drop("url_id"))
    else:
        linked = queue.link_articles(links, results.where("article_id IS NOT NULL"))
        store.write("source_job_urls", queue.mark_urls(linked, results, as_of, ["source_job_id", "url_id"]))
    left = tables.pending_count(store.read("urls"), store.read("source_job_urls"), job_id, source_id, source_like)
    return counters(results, left).first().asDict()


# discovery

def discover(store, source: DataFrame, sitemap, page, as_of: Column, source_id: int | None = None, job_id: int | None = None, days: int = 365) -> dict:
    """Finds a source's URLs in its sitemaps and listing pages and stores them; counts (inserted, duplicated, discovered).

    ``source`` is one row of the registry; ``sitemap`` and ``page`` turn a frontier into
    documents (see ``sitemaps.walk`` and ``listings.walk``).
    """
    base = F.lit(source.select(urls.base_of(F.col("baseUrl"), F.col("homepageUrl"), F.get("startUrls", 0), F.get("sitemapUrls", 0)).alias("b")).first().b)
    starts = source.select(F.explode("sitemapUrls").alias("sitemap_url"))
    mapped = sitemaps.walk(starts, sitemap, base, dates.discovery_cutoff(as_of, days)).select("url", F.lit("sitemap").alias("discovery_method"))
    lists = listings.start_urls(source).select("url", F.lit(0).alias("kind"))
    archive = listings.archive_urls(source, as_of, days).select("url", F.lit(1).alias("kind")).unionByName(listings.search_urls(source, as_of, days).select("url", F.lit(1).alias("kind")))
    linked = listings.walk(lists.unionByName(archive).select("url").distinct(), page, base).select("url", F.lit("listing").alias("discovery_method"))
    named = source.select(F.col("name").alias("source_name"), F.col("category").alias("source_category")).first()
    ids = [F.lit(source_id).cast("long").alias("source_id"), F.lit(job_id).cast("long").alias("source_job_id"), F.lit(named.source_name).alias("source_name"), F.lit(named.source_category).cast("string").alias("source_category")]
    total = {"inserted": 0, "duplicated": 0}
    for found in (mapped, linked):
        # one order for all rows, by range and place within it
        rows = cut(found.select("url", urls.canonical(F.col("url")).alias("canonical_url"), "discovery_method", *ids).withColumn("id", F.lit(None).cast("long")))
        counts = insert_urls(store, tables.numbered(rows, store.read("urls").limit(0), [F.col("url")]).withColumnRenamed("id", "position"), as_of)
        total = {k: total[k] + counts[k] for k in total}
    return total | {"discovered": total["inserted"] + total["duplicated"]}


# job and queue

def coverage(links: DataFrame, articles: DataFrame, rejections: DataFrame, job_id: int, as_of: Column) -> DataFrame:
    """One row: a job's URLs by status, accepted articles by month and their dates, months expected and missing, and rejections by reason."""
    mine = links.where(F.col("source_job_id") == job_id)
    dated = articles.select("id", "published_date").withColumn("published_at", dates.parse_strict(F.col("published_date")))
    accepted = mine.where("status = 'crawled'").select("article_id").join(dated, F.col("article_id") == F.col("id"))

    def listed(counts: DataFrame, name: str, order: str) -> DataFrame:
        """Counts as one array in order: the key's, or most first."""
        cells = F.struct("n", "key") if order == "key" else F.struct((-F.col("n")).alias("o"), "key", "n")
        ordered = F.array_sort(F.collect_list(F.struct("key", "n"))) if order == "key" else F.transform(F.array_sort(F.collect_list(cells)), lambda x: F.struct(x["key"].alias("key"), x["n"].alias("n")))
        return counts.agg(ordered.alias(name))

    seen = reports.observed_months(accepted, as_of)
    parts = [
        listed(mine.groupBy(F.col("status").alias("key")).agg(F.count("*").alias("n")), "url_statuses", "key"),
        listed(reports.accepted_months(accepted).select(F.col("month").alias("key"), "n"), "months", "key"),
        listed(seen.select(F.col("month").alias("key"), "n"), "observed_months", "key"),
        reports.expected_months(links.sparkSession, as_of).agg(F.array_sort(F.collect_list("month")).alias("expected_months")),
        reports.missing_months(seen, as_of).agg(F.array_sort(F.collect_list("month")).alias("missing_months")),
        listed(rejections.where(F.col("source_job_id") == job_id).groupBy(F.col("reason_code").alias("key")).agg(F.count("*").alias("n")), "rejection_reasons", "most"),
        reports.date_profile(accepted, as_of).select(F.struct("*").alias("accepted")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # one row each
    return out


def process_job(store, job, source: DataFrame, sitemap, page, get, as_of: Column, batch: int = 100, policy: reports.Policy | None = None) -> dict:
    """Discovery, crawl in batches, coverage and completion gate of a running job; gives what they found.

    After each step the job's heartbeat is set; a job that another worker has taken over stops.
    """
    if job.requested_days_back != 365:
        raise ValueError(f"Source job {job.id} requested {job.requested_days_back} days; backfills need 365")

    def beat():
        jobs, held = queue.heartbeat(store.read("source_jobs"), job.id, as_of, job.worker_id)
        if not held:
            raise RuntimeError(f"Source job {job.id} lost its worker lease")
        store.write("source_jobs", jobs)

    beat()
    found = discover(store, source, sitemap, page, as_of, job.source_id, job.id)
    if not found["discovered"]:
        raise GivenUp("Source discovery returned no candidate URLs")
    total: dict = {}
    while True:
        beat()
        part = crawl(store, get, as_of, job.id, batch)
        total = {k: total.get(k, 0) + v for k, v in part.items()} | {"pending_after": part["pending_after"]}
        if not part["selected"] or not part["pending_after"]:
            break
    if total["pending_after"]:
        raise RuntimeError(f"Source job cannot complete with {total['pending_after']} pending URL(s)")
    if policy is None:
        months = source.select("minCoverageMonths").first()[0]
        policy = reports.Policy(months=months or 12)
    links, articles = store.read("source_job_urls").where(F.col("source_job_id") == job.id), store.read("articles")
    report = coverage(links, articles, store.read("rejected_pages"), job.id, as_of).first().asDict(recursive=True)
    dated = articles.select("id", "published_date").withColumn("published_at", dates.parse_strict(F.col("published_date")))
    gate = reports.completion(links, links.where("status = 'crawled'").join(dated, F.col("article_id") == F.col("id")), as_of, policy).first().asDict(recursive=True)
    stats = {"discovery": found, "crawl": total, "coverage": report, "completionGate": gate}
    if not gate["passed"]:
        raise GivenUp(f"Source coverage failed completion gate: {', '.join(gate['failure_codes'])}. Missing months: {', '.join(report['missing_months'])}", stats)
    return stats


def run_queue(store, worker: str, process, now, attempts: int = 3, stale_minutes: float = 120, once: bool = True, poll: float = 5.0, stopped=lambda: False, sleep=time.sleep) -> list[tuple[int, str]]:
    """Recovers stale jobs, then claims and processes one job after another; (job id, what became of it) in order.

    ``process(job)`` gives the job's stats; ``now()`` the time as a column.  A job that fails is
    queued again up to ``attempts`` times, its failed URLs pending again, unless it has given
    up.  With ``once`` the run ends when nothing is left to claim, else it waits and looks again.
    """
    history: list[tuple[int, str]] = []

    def recover() -> bool:
        jobs, links = store.read("source_jobs"), store.read("source_job_urls")
        if queue.stale(jobs, now(), stale_minutes).isEmpty():
            return False
        jobs, links = queue.requeue_stale(jobs, links, now(), stale_minutes)
        store.write("source_job_urls", links)
        store.write("source_jobs", jobs)
        return True

    recover()
    while not stopped():
        jobs, sources = store.read("source_jobs"), store.read("sources")
        if jobs.where("status = 'running'").isEmpty() and not queue.claimable(jobs, sources).isEmpty():
            store.write("source_jobs", queue.claim(jobs, sources, worker, now()))
            job = store.read("source_jobs").where((F.col("status") == "running") & (F.col("worker_id") == worker.strip())).first()
        else:
            job = None
        if job is None:
            if recover():
                continue
            if once:
                break
            sleep(poll)
            continue
        try:
            stats = process(job)
            if stats.get("crawl", {}).get("failed"):
                raise RuntimeError(f"{stats['crawl']['failed']} URL(s) failed after crawler retries")
            store.write("source_jobs", queue.complete(store.read("source_jobs"), job.id, now(), stats))
            history.append((job.id, "completed"))
        except Exception as e:  # noqa: BLE001 - whatever a job raises is its result
            retry = not isinstance(e, GivenUp) and job.attempt_count < attempts
            if retry:
                store.write("source_job_urls", queue.retry_failed(store.read("source_job_urls"), job.id))
            store.write("source_jobs", queue.fail(store.read("source_jobs"), job.id, str(e), now(), retry, getattr(e, "stats", None)))
            history.append((job.id, "retried" if retry else "failed"))
    return history


def status_document(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """(value): the queue as one JSON document: jobs by status, their number, the running job and the next in line."""
    counts = jobs.agg(*[F.count_if(F.col("status") == s).alias(s) for s in queue.STATUSES], F.count("*").alias("total"))
    named = queue.with_source(jobs, sources).select("id", "status", "enabled", F.struct("id", "source_key", "source_name", "status").alias("job"))
    running = named.where("status = 'running'").agg(F.min_by("job", "id").alias("current"))
    following = named.where("status = 'queued' AND enabled").agg(F.min_by("job", "id").alias("next"))
    return counts.crossJoin(running).crossJoin(following).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))  # one row each


def read_json(value, fallback=None):
    """A JSON text's value; the fallback for null, empty or broken text."""
    try:
        return json.loads(value) if value else fallback
    except ValueError:
        return fallback


# filter and classifier

def filtered(rows: DataFrame, as_of: Column, mode: str = "balanced", source_like: str | None = None) -> DataFrame:
    """The URLs, pending ones that the legacy filter turns away skipped with its reason."""
    chosen = F.col("status") == "pending"
    if source_like:
        chosen = chosen & F.col("source_name").ilike(f"%{source_like}%")
    reason = text.barrier(F.when(chosen, urls.filter_reason(F.col("url"), mode)))
    out = rows.withColumn("_why", reason)
    return queue._set(out, F.col("_why").isNotNull(), status="skipped", failed_reason=F.col("_why"), crawled_at=as_of).drop("_why")


def filter_batch(store, as_of: Column, mode: str = "balanced", source_like: str | None = None, dry_run: bool = False) -> dict:
    """Skips pending URLs by the legacy filter, or only says how many it would skip and keep."""
    rows = store.read("urls")
    after = cut(filtered(rows, as_of, mode, source_like))
    checked = tables.pending_count(rows, rows, source_like=source_like)
    left = tables.pending_count(after, after, source_like=source_like)
    if not dry_run:
        store.write("urls", after)
    return {"checked": checked, "keep": left, "skip": checked - left}


SETTLED = {"error_page": (False, "Skipped obvious error page before LLM."), "date": (True, "Skipped because published date is outside range or unknown."), "keyword": (True, "Skipped by keyword prefilter.")}


def settled(judged_rows: DataFrame, model: str) -> DataFrame:
    """Results of the articles that need no model: (article_id, is_news_article, is_relevant, matched_keywords, reason, model)."""
    news, reason = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    for name, (is_news, why) in SETTLED.items():
        news = F.when(F.col("outcome") == name, F.lit(is_news)).otherwise(news)
        reason = F.when(F.col("outcome") == name, F.lit(why)).otherwise(reason)
    rows = judged_rows.where(F.col("outcome") != "model")
    return rows.select(F.col("id").alias("article_id"), news.alias("is_news_article"), F.lit(False).alias("is_relevant"), F.array().cast("array<string>").alias("matched_keywords"), reason.alias("reason"), F.lit(model).alias("model"))


def classifier_run(store, ask, model: str, as_of: Column, limit: int = 50, days: int = 365, source_like: str | None = None, use_prefilter: bool = False) -> dict:
    """Classifies the newest unclassified articles, stores results and matches; gives the run's counters.

    An article whose call fails stays unclassified and is asked about in a later run.
    """
    articles, held, old = store.read("articles"), store.read("article_classifications"), store.read("matches")
    chosen = cut(classify.outcome(classify.unclassified(articles, held, model, limit, source_like), dates.from_date(as_of, days), as_of, use_prefilter))
    asked = cut(classify.classified(chosen.where("outcome = 'model'"), ask, model))
    results = cut(settled(chosen, model).unionByName(asked.select("article_id", "is_news_article", "is_relevant", "matched_keywords", "reason", "model")))
    named = articles.select(F.col("id").alias("article_id"), "url", "source_name")
    found = classify.matches(results).join(named, "article_id").withColumn("created_at", as_of)
    rows, kept = marked(held, old, results.drop("matched_keywords").withColumn("classified_at", as_of), found)
    rows, kept = cut(rows), cut(kept)
    store.write("article_classifications", rows)
    store.write("matches", kept)
    n = {r.outcome: r["count"] for r in chosen.groupBy("outcome").count().collect()}
    done, relevant = asked.count(), asked.where("is_news_article AND is_relevant").count()
    calls = n.get("model", 0)
    return {"selected": sum(n.values()), "error_page": n.get("error_page", 0), "date": n.get("date", 0), "keyword": n.get("keyword", 0), "calls": calls, "failures": calls - done, "relevant": relevant, "classified": results.count()}
