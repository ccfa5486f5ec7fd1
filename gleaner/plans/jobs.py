"""Queries over the queue, the writers and the runs, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import dates, text, urls
from gleaner.functions.session import reliable
from gleaner.operators import classify, identity, queue, runs, store
from gleaner.plans import registry as R
from gleaner.plans import views as V
from gleaner.plans.registry import query
from gleaner.sources import listings, sitemaps

_AS_OF = f"TIMESTAMP '{V.AS_OF}'"

SQL_QUEUE = f"""queue AS (SELECT *, 365 AS requested_days_back, (id % 4)::INTEGER AS attempt_count, CASE status WHEN 'running' THEN 'w' || (id % 3) END AS worker_id, CASE status WHEN 'running' THEN enqueued_at END AS started_at,
  CASE WHEN status = 'running' AND id % 2 = 0 THEN {_AS_OF} - INTERVAL 60 MINUTE END AS heartbeat_at FROM jobs)"""
_STALE = f"status = 'running' AND coalesce(heartbeat_at, started_at, enqueued_at) < {_AS_OF} - INTERVAL 120 MINUTE"
_LINK = "CASE min(l_returnflag) WHEN 'A' THEN 'crawled' WHEN 'N' THEN 'failed' ELSE 'pending' END"
SQL_LINKS = f"links AS (SELECT l_orderkey AS source_job_id, l_partkey AS url_id, {_LINK} AS status FROM lineitem GROUP BY ALL)"


def _queue(spark, sf_dir):
    """Jobs with all columns: running ones have a worker, every second of them a fresh heartbeat."""
    running, job = F.col("status") == "running", F.col("id")
    return V.jobs(spark, sf_dir).select(
        "id", "source_id", "status", F.lit(365).alias("requested_days_back"), (job % 4).cast("int").alias("attempt_count"), F.when(running, F.concat(F.lit("w"), (job % 3).cast("string"))).alias("worker_id"), "enqueued_at",
        F.when(running, F.col("enqueued_at")).alias("started_at"), F.when(running & (job % 2 == 0), V.as_of() - F.make_dt_interval(mins=F.lit(60))).alias("heartbeat_at"), F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("stats"),
    )


def _sources(spark, sf_dir):
    return V.sources(spark, sf_dir).withColumn("created_at", F.lit(None).cast("timestamp")).withColumn("updated_at", F.lit(None).cast("timestamp"))


def _links(spark, sf_dir):
    least = V.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("source_job_id"), F.col("l_partkey").alias("url_id")).agg(F.min("l_returnflag").alias("_f"))
    status = F.when(F.col("_f") == "A", "crawled").when(F.col("_f") == "N", "failed").otherwise("pending")
    return least.select("source_job_id", "url_id", F.lit(None).cast("long").alias("article_id"), status.alias("status"), F.lit(1).alias("crawl_attempt_count"), F.lit(None).cast("string").alias("failed_reason"), F.lit(None).cast("timestamp").alias("crawled_at"))


# transitions of the queue

@query(
    f"""WITH {V.SQL_JOBS}, {SQL_QUEUE}, {SQL_LINKS}, lost AS (SELECT id FROM queue WHERE {_STALE})
SELECT 'job' AS kind, CASE WHEN id IN (SELECT id FROM lost) THEN 'queued' ELSE status END AS status, CASE WHEN id IN (SELECT id FROM lost) THEN '{queue.STALE}' END AS error, count(*) AS n FROM queue GROUP BY ALL
UNION ALL SELECT 'url', CASE WHEN status = 'failed' AND source_job_id IN (SELECT id FROM lost) THEN 'pending' ELSE status END, NULL, count(*) FROM links GROUP BY ALL"""
)
def stale_requeued(spark, sf_dir):
    """Jobs and their URLs by status after stale jobs are queued again."""
    jobs, links = queue.requeue_stale(_queue(spark, sf_dir), _links(spark, sf_dir), V.as_of())
    count = lambda df, kind, error: df.groupBy(F.lit(kind).alias("kind"), "status", error.alias("error")).agg(F.count("*").alias("n"))
    return count(jobs, "job", F.col("error")).unionByName(count(links, "url", F.lit(None).cast("string")))


@query(
    f"""WITH {V.SQL_JOBS}, {SQL_QUEUE}, r AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM queue WHERE status = 'running')
SELECT id, CASE n WHEN 1 THEN 'completed' WHEN 2 THEN 'failed' ELSE 'queued' END AS status, CASE WHEN n > 1 THEN 'broken' END AS error, CASE n WHEN 1 THEN '{{"a":{{"c":2,"d":1}},"b":"é"}}' END AS stats, CASE WHEN n < 3 THEN {_AS_OF} END AS completed_at FROM r WHERE n <= 3"""
)
def finished_jobs(spark, sf_dir):
    """The first three running jobs, of which one is completed, one fails and one is to be tried again."""
    jobs = _queue(spark, sf_dir)
    first = [r.id for r in jobs.where("status = 'running'").orderBy("id").limit(3).collect()]
    jobs = queue.complete(jobs, first[0], V.as_of(), {"b": "é", "a": {"d": 1, "c": 2}})
    jobs = queue.fail(jobs, first[1], " broken ", V.as_of())
    jobs = queue.fail(jobs, first[2], "broken", V.as_of(), retry=True)
    return jobs.where(F.col("id").isin(first)).select("id", "status", "error", "stats", F.col("completed_at").cast("timestamp_ntz").alias("completed_at"))


@query(
    f"""WITH {V.SQL_JOBS}, {SQL_QUEUE}, f AS (SELECT min(id) AS id, arg_min(worker_id, id) AS worker FROM queue WHERE status = 'running'), d AS (SELECT min(id) AS id FROM queue WHERE status = 'completed')
SELECT 'own' AS kind, true AS held, {_AS_OF} AS heartbeat_at FROM f UNION ALL SELECT 'other', false, heartbeat_at FROM queue JOIN f USING (id) UNION ALL SELECT 'not running', false, NULL FROM d"""
)
def heartbeats(spark, sf_dir):
    """Heartbeats of a running job by its worker and by another, and of a job that doesn't run."""
    jobs = _queue(spark, sf_dir)
    mine = jobs.where("status = 'running'").orderBy("id").first()
    done = jobs.where("status = 'completed'").agg(F.min("id")).first()[0]
    parts = []
    for kind, job, worker in (("own", mine.id, mine.worker_id), ("other", mine.id, "nobody"), ("not running", done, None)):
        after, held = queue.heartbeat(jobs, job, V.as_of(), worker)
        parts.append(after.where(F.col("id") == job).select(F.lit(kind).alias("kind"), F.lit(held).alias("held"), F.col("heartbeat_at").cast("timestamp_ntz").alias("heartbeat_at")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""WITH {V.SQL_JOBS}, {SQL_QUEUE}, {V.SQL_SOURCES}, p AS (SELECT min(source_id) AS id FROM queue WHERE status = 'queued' AND source_id NOT IN (SELECT source_id FROM queue WHERE status = 'running'))
SELECT 'job' AS kind, CASE WHEN source_id = p.id AND status = 'queued' THEN 'cancelled' ELSE status END AS state, CASE WHEN source_id = p.id AND status = 'queued' THEN '{queue.DISABLED}' END AS error, count(*) AS n FROM queue, p GROUP BY ALL
UNION ALL SELECT 'source', CASE WHEN s.enabled AND s.id <> p.id THEN 'enabled' ELSE 'disabled' END, NULL, count(*) FROM sources s, p GROUP BY ALL"""
)
def disabled_source(spark, sf_dir):
    """Jobs and sources after the first source with queued jobs alone is disabled."""
    jobs = _queue(spark, sf_dir)
    running = jobs.where("status = 'running'").select("source_id").distinct()
    source = jobs.where("status = 'queued'").join(running, "source_id", "left_anti").agg(F.min("source_id")).first()[0]
    if source is None:
        source = -1
    jobs, sources = queue.set_enabled(jobs, _sources(spark, sf_dir), source, False, V.as_of())
    a = jobs.groupBy(F.lit("job").alias("kind"), F.col("status").alias("state"), "error").agg(F.count("*").alias("n"))
    return a.unionByName(sources.groupBy(F.lit("source").alias("kind"), F.when(F.col("enabled"), "enabled").otherwise("disabled").alias("state"), F.lit(None).cast("string").alias("error")).agg(F.count("*").alias("n")))


@query(
    f"""WITH {V.SQL_JOBS}, {V.SQL_SOURCES}, b AS (SELECT min(source_id) AS id FROM jobs WHERE status IN ('queued', 'running')), f AS (SELECT min(id) AS id FROM sources WHERE id NOT IN (SELECT source_id FROM jobs WHERE status IN ('queued', 'running')))
SELECT 'busy' AS kind, false AS enqueued, (SELECT count(*) FROM jobs) AS jobs, (SELECT count(*) FROM sources) AS sources, true AS enabled FROM b
UNION ALL SELECT 'idle', true, (SELECT count(*) FROM jobs) + 1, (SELECT count(*) FROM sources), true FROM f WHERE id IS NOT NULL UNION ALL SELECT 'new', true, (SELECT count(*) FROM jobs) + 1, (SELECT count(*) FROM sources) + 1, true"""
)
def enqueued_sources(spark, sf_dir):
    """What enqueueing does for a source with an active job, one without, and a new one."""
    jobs, sources = _queue(spark, sf_dir), _sources(spark, sf_dir)
    active = jobs.where("status IN ('queued', 'running')").select("source_id").distinct()
    busy = active.agg(F.min("source_id")).first()[0]
    idle = sources.join(active, sources["id"] == active["source_id"], "left_anti").agg(F.min("id")).first()[0]
    parts = []
    for kind, key in (("busy", f"key:{busy}"), *([("idle", f"key:{idle}")] if idle else []), ("new", "key:new")):
        j, s, made = queue.enqueue(jobs, sources, {"name": " Some source ", "category": "social"}, key, "{}", V.as_of())
        state = s.agg(F.count("*").alias("sources"), F.bool_or((F.col("source_key") == key) & F.col("enabled") & (F.col("name") == "Some source")).alias("enabled"))
        parts.append(j.agg(F.count("*").alias("jobs")).crossJoin(state).select(F.lit(kind).alias("kind"), F.lit(made).alias("enqueued"), "jobs", "sources", "enabled"))
    return reduce(DataFrame.unionByName, parts)


_JOB_OBJECT = "struct_pack(id := j.id, source_key := s.source_key, source_name := s.name, status := j.status)"


@query(
    f"""WITH {V.SQL_JOBS}, {V.SQL_SOURCES}, c AS (SELECT count(*) FILTER (status = 'queued') AS queued, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'cancelled') AS cancelled, count(*) AS total FROM jobs),
n AS (SELECT arg_min({_JOB_OBJECT}, j.id) FILTER (j.status = 'running') AS current, arg_min({_JOB_OBJECT}, j.id) FILTER (j.status = 'queued' AND s.enabled) AS "next" FROM jobs j JOIN sources s ON j.source_id = s.id)
SELECT to_json(struct_pack(queued := queued, running := running, completed := completed, failed := failed, cancelled := cancelled, total := total, current := current, next := "next"))::VARCHAR AS value FROM c, n"""
)
def queue_status(spark, sf_dir):
    """The queue as one JSON document."""
    return runs.status_document(V.jobs(spark, sf_dir), V.sources(spark, sf_dir))


# URLs

_URLS = "urls AS (SELECT p_partkey AS id, p_name AS url, CASE WHEN p_size % 2 = 0 THEN 'pending' ELSE 'crawled' END AS status, CASE WHEN p_partkey % 3 > 0 THEN p_partkey END AS source_job_id FROM part)"


def _parts(spark, sf_dir):
    p = V.table(spark, sf_dir, "part")
    status = F.when(F.col("p_size") % 2 == 0, "pending").otherwise("crawled")
    return p.select(F.col("p_partkey").cast("long").alias("id"), F.col("p_name").alias("url"), status.alias("status"), F.lit(0).alias("crawl_attempt_count"), F.lit(None).cast("timestamp").alias("crawled_at"), F.lit(None).cast("string").alias("failed_reason"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_partkey")).alias("source_job_id"))


@query(f"WITH {_URLS} SELECT CASE WHEN status = 'pending' AND source_job_id IS NULL THEN 'skipped' ELSE status END AS status, CASE WHEN status = 'pending' AND source_job_id IS NULL THEN '{queue.LEGACY}' END AS failed_reason, count(*) AS n FROM urls GROUP BY ALL")
def legacy_cleared(spark, sf_dir):
    """URLs by status and reason after those without a job are cleared."""
    return queue.clear_legacy(_parts(spark, sf_dir), V.as_of()).groupBy("status", "failed_reason").agg(F.count("*").alias("n"))


_CHANGE = "CASE l_returnflag WHEN 'A' THEN 'crawled' WHEN 'N' THEN 'failed' ELSE 'pending' END"


@query(
    f"""WITH {_URLS}, c AS (SELECT l_partkey, arg_max(struct_pack(s := {_CHANGE}, r := l_linestatus), (l_orderkey, l_linenumber)) AS v, count(*) FILTER ({_CHANGE} <> 'pending') AS tries FROM lineitem GROUP BY ALL)
SELECT id AS url_id, coalesce(c.v.s, status) AS status, c.v.r AS failed_reason, coalesce(tries, 0)::INTEGER AS crawl_attempt_count, c.v.s IS NOT NULL AND c.v.s <> 'pending' AS stamped FROM urls LEFT JOIN c ON id = l_partkey"""
)
def marked_urls(spark, sf_dir):
    """URLs after the changes of all line items, many to a URL, in their order."""
    kind = F.when(F.col("l_returnflag") == "A", "crawled").when(F.col("l_returnflag") == "N", "failed").otherwise("pending")
    changes = V.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("url_id"), kind.alias("new_status"), F.col("l_linestatus").alias("reason"), "l_orderkey", "l_linenumber")
    rows = _parts(spark, sf_dir).withColumnRenamed("id", "url_id")
    out = queue.mark_urls(rows, changes, V.as_of(), order=F.struct("l_orderkey", "l_linenumber"))
    return out.select("url_id", "status", "failed_reason", "crawl_attempt_count", F.col("crawled_at").isNotNull().alias("stamped"))


@query(f"WITH {SQL_LINKS}, a AS (SELECT l_orderkey, l_partkey, max(l_suppkey) AS article_id FROM lineitem WHERE l_linenumber > 1 GROUP BY ALL) SELECT source_job_id, url_id, article_id FROM links LEFT JOIN a ON source_job_id = l_orderkey AND url_id = l_partkey")
def linked_articles(spark, sf_dir):
    """Articles of job URLs, several found for some pairs."""
    found = V.table(spark, sf_dir, "lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").alias("source_job_id"), F.col("l_partkey").alias("url_id"), F.col("l_suppkey").alias("article_id"))
    return queue.link_articles(_links(spark, sf_dir), found).select("source_job_id", "url_id", "article_id")


_FOUND = f"""found AS (SELECT page_id AS position, url, {R._CANONICAL} AS canonical_url, CASE WHEN page_id % 3 > 0 THEN page_id % 5 END AS source_job_id FROM pages),
known AS (SELECT position AS id, url, canonical_url FROM found WHERE position % 4 = 0), held AS (SELECT position % 5 AS source_job_id, position AS url_id FROM found WHERE position % 8 = 0),
once AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY url ORDER BY position) = 1),
firsts AS (SELECT * FROM once QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY position) = 1),
fresh AS (SELECT * FROM firsts WHERE url NOT IN (SELECT url FROM known) AND canonical_url NOT IN (SELECT canonical_url FROM known)),
every AS (SELECT id, url, canonical_url FROM known UNION ALL SELECT position + 1000000000, url, canonical_url FROM fresh),
ids AS (SELECT f.position, f.source_job_id, coalesce(min(e.id) FILTER (e.url = f.url), min(e.id)) AS url_id FROM found f JOIN every e ON e.url = f.url OR e.canonical_url = f.canonical_url WHERE f.source_job_id IS NOT NULL GROUP BY ALL),
pairs AS (SELECT DISTINCT source_job_id, url_id FROM ids EXCEPT SELECT * FROM held),
n AS (SELECT (SELECT count(*) FROM fresh WHERE source_job_id IS NULL) + (SELECT count(*) FROM pairs) AS inserted)"""


@query(f"WITH {_FOUND} SELECT inserted, (SELECT count(*) FROM found) - inserted AS duplicated FROM n")
def inserted_urls(spark, sf_dir):
    """Counts of a batch insert of all pages' URLs, some with a job, into a store that knows some of them."""
    found = R._pages(spark, sf_dir).select(F.col("page_id").alias("position"), "url", text.barrier(urls.canonical(F.col("url"))).alias("canonical_url"), F.when(F.col("page_id") % 3 > 0, F.col("page_id") % 5).alias("source_job_id"))
    known = found.where("position % 4 = 0").select(F.col("position").alias("id"), "url", "canonical_url")
    held = found.where("position % 8 = 0").select((F.col("position") % 5).alias("source_job_id"), F.col("position").alias("url_id"))
    fresh, pairs = runs.new_rows(found, known, held, lambda rows: rows.withColumn("id", F.col("position") + 1_000_000_000))
    return runs.insert_counts(found, fresh, pairs)


@query(
    f"""WITH u AS (SELECT page_id AS id, url, CASE WHEN page_id % 3 > 0 THEN 'pending' ELSE 'crawled' END AS status, r.reason FROM pages JOIN ({R._reason_sql(f"WHEN NOT {R._LIKELY} THEN '{urls.REASON_STRICT}'")}) r USING (page_id))
SELECT CASE WHEN status = 'pending' AND reason IS NOT NULL THEN 'skipped' ELSE status END AS status, CASE WHEN status = 'pending' THEN reason END AS failed_reason, count(*) AS n FROM u GROUP BY ALL"""
)
def legacy_filtered(spark, sf_dir):
    """URLs by status and reason after a run of the legacy filter, strict."""
    rows = R._pages(spark, sf_dir).select(F.col("page_id").alias("id"), "url", F.when(F.col("page_id") % 3 > 0, "pending").otherwise("crawled").alias("status"), F.lit(None).cast("string").alias("failed_reason"), F.lit(None).cast("timestamp").alias("crawled_at"))
    return runs.filtered(rows, V.as_of(), "strict").groupBy("status", "failed_reason").agg(F.count("*").alias("n"))


# articles

@query(
    """WITH d AS (SELECT doc_id AS id, doc_id % 3 = 0 AS held, doc_id % 2 = 0 AS legacy, doc_id % 21 = 0 AND doc_id + 3 IN (SELECT doc_id FROM documents) AS clash FROM documents)
SELECT CASE WHEN NOT held THEN 'insert' WHEN legacy AND NOT clash THEN 'upgrade' ELSE 'refuse' END AS outcome, count(*) AS n, min(CASE WHEN held THEN id END) AS least_target FROM d GROUP BY ALL"""
)
def article_outcomes(spark, sf_dir):
    """What an upsert does with articles: of those held every second has no score, and some inputs have another article's hash."""
    d = R._docs(reliable(spark), sf_dir).select("doc_id")
    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    doc = F.col("doc_id")
    inputs = d.select(doc.alias("input_id"), F.when(doc % 5 == 4, name("m", doc)).otherwise(name("n", doc)).alias("url"), name("c", doc).alias("canonical_url"), name("h", F.when(doc % 21 == 0, doc + 3).otherwise(doc)).alias("content_hash"))
    held = d.where(doc % 3 == 0).select(doc.alias("id"), name("n", doc).alias("url"), name("c", doc).alias("canonical_url"), name("h", doc).alias("content_hash"), F.when(doc % 2 == 1, 80.0).alias("quality_score"))
    return identity.outcomes(inputs, held).groupBy("outcome").agg(F.count("*").alias("n"), F.min("target_id").alias("least_target"))


@query(
    """WITH d AS (SELECT doc_id AS id, 't' || doc_id AS title, doc_id % 2 = 0 AS up FROM documents)
SELECT id, 'n' || id AS url, CASE WHEN up THEN 'new ' ELSE '' END || title AS title, CASE WHEN up THEN 90.0 END AS quality_score, up AS cleaned FROM d"""
)
def upgraded_articles(spark, sf_dir):
    """Legacy articles after every second one has been upgraded: url and id stay."""
    doc = F.col("doc_id")
    d = R._docs(spark, sf_dir).select("doc_id")
    name = lambda p: F.concat(F.lit(p), doc.cast("string"))
    held = d.select(doc.alias("id"), name("n").alias("url"), name("t").alias("title"), F.lit(None).cast("double").alias("quality_score"), F.lit(None).cast("timestamp").alias("cleaned_at"))
    decided = d.select(doc.alias("target_id"), F.when(doc % 2 == 0, "upgrade").otherwise("refuse").alias("outcome"), name("x").alias("url"), name("new t").alias("title"), F.lit(90.0).alias("quality_score"))
    return runs.upserted(decided, held, V.as_of()).select("id", "url", "title", "quality_score", F.col("cleaned_at").isNotNull().alias("cleaned"))


@query(
    """WITH old AS (SELECT doc_id AS article_id, true AS is_relevant, 'old' AS reason FROM labels), new AS (SELECT doc_id AS article_id, doc_id % 8 = 0 AS is_relevant, 'new' AS reason FROM labels WHERE doc_id % 4 = 0),
after AS (SELECT * FROM old WHERE article_id NOT IN (SELECT article_id FROM new) UNION ALL SELECT * FROM new), m AS (SELECT article_id, 'kept' AS keyword FROM old WHERE article_id NOT IN (SELECT article_id FROM new) UNION ALL SELECT article_id, 'found' FROM new WHERE is_relevant)
SELECT 'classification' AS kind, reason AS state, is_relevant, count(*) AS n FROM after GROUP BY ALL UNION ALL SELECT 'match', keyword, true, count(*) FROM m GROUP BY ALL"""
)
def classifications_marked(spark, sf_dir):
    """Classifications and matches after new results: one row an article, and matches of relevant ones alone."""
    article = V.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("article_id"))
    held = article.select("article_id", F.lit(True).alias("is_news_article"), F.lit(True).alias("is_relevant"), F.lit("old").alias("reason"), F.lit("m").alias("model"))
    results = article.where("article_id % 4 = 0").select("article_id", F.lit(True).alias("is_news_article"), (F.col("article_id") % 8 == 0).alias("is_relevant"), F.lit("new").alias("reason"), F.lit("m").alias("model"))
    old = article.select("article_id", F.lit("kept").alias("keyword"))
    found = results.where("is_relevant").select("article_id", F.lit("found").alias("keyword"))
    rows, kept = runs.marked(held, old, results, found)
    a = rows.groupBy(F.lit("classification").alias("kind"), F.col("reason").alias("state"), "is_relevant").agg(F.count("*").alias("n"))
    return a.unionByName(kept.groupBy(F.lit("match").alias("kind"), F.col("keyword").alias("state"), F.lit(True).alias("is_relevant")).agg(F.count("*").alias("n")))


_REPLY = """CASE doc_id % 6 WHEN 0 THEN '{"isNewsArticle": true, "isRelevant": true, "matchedKeywords": ["a' || doc_id || '", 5, "b"], "reason": "good"}' WHEN 1 THEN 'Sure! {"isNewsArticle": true, "isRelevant": false, "matchedKeywords": ["a"]} Done.'
  WHEN 2 THEN '{"isNewsArticle": "true", "isRelevant": true}' WHEN 3 THEN 'no JSON here' WHEN 4 THEN '{"isNewsArticle": tru' || 'e, }' END"""


@query(
    """SELECT doc_id AS id, doc_id % 6 IN (0, 1) AS is_news_article, doc_id % 6 = 0 AS is_relevant, CASE WHEN doc_id % 6 = 0 THEN 'a' || doc_id || ',b' ELSE '' END AS matched_keywords,
CASE doc_id % 6 WHEN 0 THEN 'good' WHEN 3 THEN 'LLM did not return JSON.' WHEN 4 THEN 'Failed to parse JSON from LLM response.' WHEN 5 THEN 'LLM did not return JSON.' ELSE '' END AS reason FROM labels"""
)
def parsed_replies(spark, sf_dir):
    """A model's replies read: good, within prose, of the wrong types, without JSON, broken and null."""
    rows = V.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.expr(_REPLY).alias("reply"))
    r = rows.select("id", classify.parsed_reply("reply").alias("r"))
    return r.select("id", "r.is_news_article", "r.is_relevant", F.array_join("r.matched_keywords", ",").alias("matched_keywords"), "r.reason")


@query(
    f"""WITH {V.SQL_ARTICLES}, s AS (SELECT id, CASE WHEN id % 5 = 0 THEN 'error_page' WHEN id % 5 = 1 THEN 'date' WHEN id % 5 = 2 THEN 'keyword' END AS outcome FROM articles)
SELECT id AS article_id, outcome <> 'error_page' AS is_news_article, false AS is_relevant, CASE outcome WHEN 'error_page' THEN 'Skipped obvious error page before LLM.' WHEN 'date' THEN 'Skipped because published date is outside range or unknown.' ELSE 'Skipped by keyword prefilter.' END AS reason FROM s WHERE outcome IS NOT NULL"""
)
def settled_results(spark, sf_dir):
    """Results of articles that need no model."""
    kind = F.when(F.col("id") % 5 == 0, "error_page").when(F.col("id") % 5 == 1, "date").when(F.col("id") % 5 == 2, "keyword").otherwise("model")
    return runs.settled(V.articles(spark, sf_dir).select("id", kind.alias("outcome")), "m").select("article_id", "is_news_article", "is_relevant", "reason")


@query(
    f"""WITH {V.SQL_ARTICLES}, {R._KEYWORDS}, c AS (SELECT doc_id AS article_id, 'r' || (doc_id % 5) AS reason FROM labels WHERE quality = 1 AND toxic = 0),
j AS (SELECT a.*, coalesce(m.category, a.source_category, 'general') AS category, m.keyword, coalesce(m.reason, c.reason) AS why FROM c JOIN articles a ON a.id = c.article_id LEFT JOIN m ON m.article_id = a.id WHERE published_at >= {V.LOW} AND published_at <= {_AS_OF} + INTERVAL 1 DAY),
g AS (SELECT id, category, any_value(source_name) AS source_name, any_value(title) AS title, any_value(published_date) AS published_date, any_value(url) AS url, any_value(text) AS text, coalesce(string_agg(DISTINCT keyword, ',' ORDER BY keyword), '{classify.GENERAL}') AS words, max(why) AS why FROM j GROUP BY id, category)
SELECT array_to_string([repeat('=', 30), 'SOURCE: ' || source_name, 'CATEGORY: ' || category, 'MATCHED KEYWORDS: ' || words, 'TITLE: ' || title, 'DATE: ' || published_date, 'LINK: ' || url, 'LLM_REASON: ' || why, repeat('=', 30), '', 'TEXT:', text, '', repeat('-', 30), ''], chr(10)) AS value FROM g"""
)
def kb_text(spark, sf_dir):
    """The knowledge export as text, one block for each article and category."""
    low = V.as_of() - F.make_dt_interval(F.lit(365))
    results = R._results(spark, sf_dir)
    return classify.export_blocks(classify.knowledge(results, V.articles(spark, sf_dir), classify.matches(results), "m", low, V.as_of() + F.make_dt_interval(F.lit(1))))


# constraints

@query(
    f"""WITH {V.SQL_JOBS}, {SQL_LINKS}, {V.SQL_SOURCES} SELECT 'job status' AS rule, count(*) AS n FROM jobs WHERE status NOT IN ('queued', 'running') UNION ALL SELECT 'days back', count(*) FROM jobs WHERE id % 50 = 0
UNION ALL SELECT 'active jobs', (SELECT count(*) FROM (SELECT source_id FROM jobs WHERE status IN ('queued', 'running') GROUP BY ALL HAVING count(*) > 1)) UNION ALL SELECT 'source names', (SELECT count(*) FROM (SELECT category FROM sources GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'orphans', count(*) FROM links WHERE url_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)"""
)
def constraint_violations(spark, sf_dir):
    """How many rows or keys break some rules."""
    jobs, sources = V.jobs(spark, sf_dir), V.sources(spark, sf_dir)
    days = F.when(F.col("id") % 50 == 0, 30).otherwise(365)
    broken = store.violations(jobs.withColumn("days", days), **{"job status": ~F.col("status").isin("queued", "running"), "days back": F.col("days") != 365})
    lost = store.orphans(_links(spark, sf_dir), V.table(spark, sf_dir, "part").where("p_size > 5"), "url_id", "p_partkey")
    number = lambda df, rule: df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
    active = number(store.repeated(jobs.where("status IN ('queued', 'running')"), "source_id"), "active jobs")
    return broken.unionByName(active).unionByName(number(store.repeated(sources, "category"), "source names")).unionByName(number(lost, "orphans"))


_OWNED = "source_job_id IS NOT NULL"


@query(
    f"""WITH {V.SQL_ARTICLES}, a AS (SELECT *, CASE WHEN id % 4 > 0 THEN id END AS source_job_id, CASE WHEN id % 7 > 0 THEN url END AS canonical_url, (id % 100)::DOUBLE AS quality_score FROM articles)
SELECT 'canonical_url' AS rule, count(*) AS n FROM a WHERE {_OWNED} AND canonical_url IS NULL UNION ALL SELECT 'published_date', count(*) FROM a WHERE {_OWNED} AND NOT {V.IN_WINDOW}
UNION ALL SELECT 'text', count(*) FROM a WHERE {_OWNED} AND length(text) < 700 UNION ALL SELECT 'quality_score', count(*) FROM a WHERE {_OWNED} AND quality_score < 70"""
)
def article_violations(spark, sf_dir):
    """How many articles of jobs break each rule; articles without a job are free of them."""
    rows = V.articles(spark, sf_dir)
    rows = rows.withColumn("source_job_id", F.when(F.col("id") % 4 > 0, F.col("id"))).withColumn("canonical_url", F.when(F.col("id") % 7 > 0, F.col("url"))).withColumn("quality_score", (F.col("id") % 100).cast("double"))
    return store.violations(rows.where(_OWNED), **store.article_rules(V.as_of()))


# reports

_STATUS = "CASE WHEN quality = 1 AND toxic = 0 THEN 'crawled' ELSE 'skipped' END"


@query(
    f"""WITH {V.SQL_ARTICLES}, links AS (SELECT doc_id, {_STATUS} AS status FROM labels), acc AS (SELECT a.* FROM articles a JOIN links l ON a.id = l.doc_id WHERE l.status = 'crawled'), {R._EXPECTED}, rej AS (SELECT 'CODE_' || (doc_id % 3) AS code FROM documents WHERE doc_id % 2 = 0),
seen AS (SELECT strftime(published_at, '%Y-%m') AS month, count(*) AS n FROM acc WHERE {V.IN_WINDOW} GROUP BY ALL)
SELECT 'url' AS part, status AS key, count(*) AS n FROM links GROUP BY ALL UNION ALL SELECT 'month', strftime(published_at, '%Y-%m'), count(*) FROM acc GROUP BY ALL UNION ALL SELECT 'observed', month, n FROM seen
UNION ALL SELECT 'expected', month, 0 FROM expected UNION ALL SELECT 'missing', month, 0 FROM expected WHERE month NOT IN (SELECT month FROM seen) UNION ALL SELECT 'reason', code, count(*) FROM rej GROUP BY ALL
UNION ALL SELECT 'accepted', 'count', count(*) FROM acc UNION ALL SELECT 'accepted', 'too_old', count(*) FROM acc WHERE published_at < {V.LOW} UNION ALL SELECT 'accepted', 'future_dates', count(*) FROM acc WHERE published_at > {V.HIGH}"""
)
def job_report(spark, sf_dir):
    """The coverage report of the job of all labelled documents, part by part."""
    status = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "crawled").otherwise("skipped")
    links = V.table(spark, sf_dir, "labels").select(F.lit(1).alias("source_job_id"), F.col("doc_id").alias("article_id"), status.alias("status"))
    rejections = R._docs(spark, sf_dir).where("doc_id % 2 = 0").select(F.lit(1).alias("source_job_id"), F.concat(F.lit("CODE_"), (F.col("doc_id") % 3).cast("string")).alias("reason_code"))
    report = runs.coverage(links, V.articles(spark, sf_dir), rejections, 1, V.as_of())
    cell = lambda part, key, n: F.struct(F.lit(part).alias("part"), key.alias("key"), n.cast("long").alias("n"))
    counts = lambda part, c: F.transform(c, lambda x: cell(part, x["key"], x["n"]))
    months = lambda part, c: F.transform(c, lambda x: cell(part, x, F.lit(0)))
    one = F.array(*[cell("accepted", F.lit(k), F.col(f"accepted.{k}")) for k in ("count", "too_old", "future_dates")])
    rows = F.concat(counts("url", F.col("url_statuses")), counts("month", F.col("months")), counts("observed", F.col("observed_months")), months("expected", F.col("expected_months")), months("missing", F.col("missing_months")), counts("reason", F.col("rejection_reasons")), one)
    return report.select(F.explode(rows).alias("r")).select("r.*")


@query("SELECT count(*) AS selected, count(*) FILTER (quality = 1) AS crawled, count(*) FILTER (quality = 1 AND toxic = 0) AS inserted, count(*) FILTER (quality = 1 AND toxic = 1) AS duplicates, count(*) FILTER (quality = 0 AND toxic = 0) AS rejected, count(*) FILTER (quality = 0 AND toxic = 1) AS failed, 7::BIGINT AS pending_after FROM labels")
def run_counters(spark, sf_dir):
    """A crawl's counters over outcomes that labels stand for."""
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    kind = F.when(good & ~toxic, "inserted").when(good, "duplicate").when(~toxic, "rejected").otherwise("failed")
    return runs.counters(V.table(spark, sf_dir, "labels").select(kind.alias("outcome")), 7)


# sitemaps

@query("SELECT 'https://example.com/bare-' || (page_id // 50) || '.xml' AS sitemap_url, url AS loc FROM pages")
def sitemap_bare_locs(spark, sf_dir):
    """Entries of documents that have locations alone, in CDATA or with entities."""
    escaped = F.replace("url", F.lit("&"), F.lit("&amp;"))
    held = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<![CDATA["), F.col("url"), F.lit("]]>"))).otherwise(escaped)
    rows = R._pages(spark, sf_dir).select(F.concat(F.lit("https://example.com/bare-"), F.floor(F.col("page_id") / 50).cast("string"), F.lit(".xml")).alias("sitemap_url"), F.concat(F.lit("<x:loc> "), held, F.lit(" </x:loc>")).alias("e"))
    found = sitemaps.entries(rows.groupBy("sitemap_url").agg(F.array_join(F.collect_list("e"), "").alias("xml")))
    return found.where("kind = 'bare' AND lastmod IS NULL").select("sitemap_url", "loc")


@query(
    f"""WITH d AS (SELECT page_id, url, DATE '1997-06-01' + CAST(page_id % 600 AS INTEGER) AS day FROM pages)
SELECT DISTINCT {R._DISCOVERED} AS url, 1 AS depth FROM d WHERE day >= CAST({V.LOW} AS DATE) AND ({R._HOST} = 'example.com' OR ends_with({R._HOST}, '.example.com')) AND NOT {R._SKIP} AND NOT {R._LISTING}"""
)
def sitemap_walk(spark, sf_dir):
    """Recent pages below a sitemap index, walked level by level."""
    documents = R._sitemaps(reliable(spark), sf_dir)
    index = "https://example.com/sitemap.xml"
    children = F.array_join(F.collect_list(F.concat(F.lit("<sitemap><loc>"), F.col("sitemap_url"), F.lit("</loc></sitemap>"))), "")
    documents = documents.unionByName(documents.agg(F.lit(index).alias("sitemap_url"), F.concat(F.lit("<sitemapindex>"), children, F.lit("</sitemapindex>")).alias("xml")))
    start = spark.range(1).select(F.lit(index).alias("sitemap_url"))
    cutoff = V.as_of() - F.make_dt_interval(F.lit(365))
    found = sitemaps.walk(start, lambda frontier: documents.join(F.broadcast(frontier), "sitemap_url"), F.lit("https://www.example.com/"), cutoff, max_files=1 << 30, max_urls=1 << 30)
    return found.select("url", "depth")


_SITE = "https://example.com"


@query(f"SELECT '{_SITE}/stories/p-' || page_id AS url FROM pages")
def listing_walk(spark, sf_dir):
    """Stories linked from the pages of a listing, which its first page links to."""
    number = (F.col("page_id") / 20).cast("long")
    rows = R._pages(reliable(spark), sf_dir).select(number.alias("k"), F.concat(F.lit('<a href="/stories/p-'), F.col("page_id").cast("string"), F.lit('">s</a>')).alias("a"))
    address = lambda k: F.concat(F.lit(f"{_SITE}/news/page/"), k.cast("string"))
    site = rows.groupBy("k").agg(F.array_join(F.collect_list("a"), " ").alias("links")).select(F.col("k").alias("page_id"), address(F.col("k")).alias("url"), F.concat(F.lit("<html><head><title>Stories</title></head><body>"), "links", F.lit("</body></html>")).alias("html"))
    pages = F.concat(F.lit("<html><body>"), F.array_join(F.transform(F.sequence(F.lit(0), F.col("n")), lambda k: F.concat(F.lit('<a rel="next" href="'), address(k), F.lit('">Next</a>'))), " "), F.lit("</body></html>"))
    index = rows.agg(F.max("k").alias("n")).select(F.lit(-1).cast("long").alias("page_id"), F.lit(f"{_SITE}/news/page/all").alias("url"), pages.alias("html"))
    site = site.unionByName(index)
    start = spark.range(1).select(F.lit(f"{_SITE}/news/page/all").alias("url"))
    return listings.walk(start, lambda frontier: site.join(F.broadcast(frontier), "url").select("page_id", "url", "html"), F.lit(_SITE), max_requests=1 << 30, max_pagination=1 << 30)


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 1 THEN o_orderdate WHEN 3 THEN o_orderdate - INTERVAL 2 HOUR END AS strict, CASE o_orderkey % 6 WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 1 THEN o_orderdate WHEN 2 THEN o_orderdate WHEN 3 THEN o_orderdate - INTERVAL 2 HOUR END AS lax FROM orders""")
def parsed_dates(spark, sf_dir):
    """Dates in several forms, read strictly and laxly: days, instants with and without a zone, words and nothing."""
    at = F.col("o_orderdate").cast("timestamp")
    k = F.col("o_orderkey") % 6
    form = F.when(k == 0, F.date_format(at, "yyyy-MM-dd")).when(k == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 2, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 3, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+02:00'")).when(k == 4, "soon")
    rows = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), form.alias("d"))
    return rows.select("id", dates.parse_strict(F.col("d")).cast("timestamp_ntz").alias("strict"), dates.parse_lax(F.col("d")).cast("timestamp_ntz").alias("lax"))
