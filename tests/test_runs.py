"""The writers and the runs on a small site of their own: discovery, crawl, job, queue, filter, classifier."""

import hashlib
import json
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_functions import PROSE, at_noon

from gleaner.operators import classify, identity, queue, reports, runs, store
from gleaner.sources import registry
from gleaner.streaming import gate

BASE = "https://e.com"
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the site goes to the executors


def article(number, day="2026-07-01", text=None):
    ld = json.dumps({"@type": "NewsArticle", "headline": f"Committee report number {number}", "datePublished": f"{day}T08:00:00Z"})
    body = text or PROSE.replace("committee", f"committee{number}").replace("report", f"report{number}")
    return f'<html><head><title>T</title><script type="application/ld+json">{ld}</script></head><body><article>' + "".join(f"<p>{p}</p>" for p in body.split("\n\n")) + "</article></body></html>"


class Site:
    """Pages by address; ``broken`` ones fail so many times before they answer."""

    def __init__(self, folder, pages, broken=None):
        self.pages, self.broken, self.folder = pages, broken or {}, folder

    def get(self, url):
        if url in self.broken:
            tries = self.folder / hashlib.md5(url.encode()).hexdigest()
            n = int(tries.read_text()) if tries.exists() else 0
            tries.write_text(str(n + 1))
            if n < self.broken[url]:
                raise OSError("connection reset")
        if url not in self.pages:
            return {"status": 404, "content_type": "text/html", "address": "8.8.8.8", "final_url": url, "html": ""}
        return {"status": 200, "content_type": "text/html; charset=utf-8", "address": "8.8.8.8", "final_url": url, "html": self.pages[url]}


@pytest.fixture
def held(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "store"))
    empty = spark.createDataFrame([], store.SCHEMAS["source_jobs"]), spark.createDataFrame([], store.SCHEMAS["sources"])
    jobs, sources, _ = queue.enqueue(*empty, {"name": "Example", "category": "social"}, "key", "{}", at_noon())
    s.write("source_jobs", jobs)
    s.write("sources", sources)
    return s


def parts(spark, tmp_path, pages, broken=None, minimum=1):
    """(source row, sitemap fetch, page fetch, client) of a site whose sitemap lists all pages but one, which a listing links to."""
    site = Site(tmp_path, pages, broken)
    listed = [u for u in pages if not u.endswith("-linked")]
    xml = "<urlset>" + "".join(f"<url><loc>{u}</loc><lastmod>2026-07-01</lastmod></url>" for u in listed) + "</urlset>"
    home = "<html><head><title>Home</title></head><body>" + "".join(f'<a href="{u}">x</a>' for u in pages if u.endswith("-linked")) + "</body></html>"
    maps = spark.createDataFrame([(f"{BASE}/sitemap.xml", xml)], "sitemap_url string, xml string")
    homes = spark.createDataFrame([(0, f"{BASE}/", home)], "page_id long, url string, html string")
    source = spark.createDataFrame([("Example", "social", BASE, f"{BASE}/", None, [], [], [], [], [f"{BASE}/sitemap.xml"], minimum)], registry.SCHEMA)
    return source, lambda f: f.join(maps, "sitemap_url"), lambda f: f.join(homes, "url").select("page_id", "url", "html"), site.get


def drive(spark, held, tmp_path, pages, broken=None, policy=None, **options):
    source, sitemap, page, get = parts(spark, tmp_path, pages, broken)
    policy = policy or reports.Policy(months=1, articles=1, rate=0.05)
    process = lambda job: runs.process_job(held, job, source, sitemap, page, get, at_noon(), batch=3, policy=policy)
    return runs.run_queue(held, "worker", process, at_noon, **options)


def test_a_job_from_the_queue_to_its_report(spark, held, tmp_path):
    pages = {f"{BASE}/story-{k}": article(k) for k in range(4)} | {f"{BASE}/story-linked": article(9)}
    pages[f"{BASE}/copy-of-0"] = article(0)
    pages[f"{BASE}/thin-page"] = article(5, text="Too short.")
    assert drive(spark, held, tmp_path, pages) == [(1, "completed")]
    job = held.read("source_jobs").first()
    stats = json.loads(job.stats)
    assert job.status == "completed" and job.attempt_count == 1 and stats["completionGate"]["passed"]
    assert stats["discovery"] == {"discovered": 7, "duplicated": 0, "inserted": 7}
    assert {k: stats["crawl"][k] for k in ("selected", "crawled", "inserted", "duplicates", "rejected", "failed", "pending_after")} == {"selected": 7, "crawled": 6, "inserted": 5, "duplicates": 1, "rejected": 1, "failed": 0, "pending_after": 0}
    assert stats["coverage"]["url_statuses"] == [{"key": "crawled", "n": 6}, {"key": "skipped", "n": 1}] and stats["coverage"]["observed_months"] == [{"key": "2026-07", "n": 5}]
    assert stats["coverage"]["rejection_reasons"][0]["key"] == held.read("rejected_pages").first().reason_code
    articles = held.read("articles").orderBy("id").collect()
    assert [r.id for r in articles] == [1, 2, 3, 4, 5] and all(r.source_job_id == 1 and r.quality_score == 100 for r in articles)
    links = held.read("source_job_urls").where("status = 'crawled'").collect()
    assert {r.article_id for r in links} == {1, 2, 3, 4, 5} and len(links) == 6
    assert {r.status for r in held.read("urls").collect()} == {"pending"}  # a job's URLs are marked in its own rows alone
    store.check_articles(held.read("articles"), at_noon())


def test_a_failing_page_is_tried_again(spark, tmp_path):
    """Twice; what fails for good is marked as failed, and the job's gate doesn't let it pass."""
    pages = {f"{BASE}/story-{k}": article(k) for k in range(3)}
    site = Site(tmp_path, pages, {f"{BASE}/story-1": 2, f"{BASE}/story-2": 3})
    s = store.Store(spark, str(tmp_path / "s"))
    s.extend("urls", spark.createDataFrame([(k, u, "pending", "s", 0) for k, u in enumerate(pages, 1)], "id long, url string, status string, source_name string, crawl_attempt_count int"))
    out = runs.crawl(s, site.get, at_noon(), limit=10)
    assert (out["selected"], out["inserted"], out["failed"], out["pending_after"]) == (3, 2, 1, 0)
    assert {(r.id, r.status, r.crawl_attempt_count) for r in s.read("urls").collect()} == {(1, "crawled", 1), (2, "crawled", 1), (3, "failed", 1)}
    assert s.read("urls").where("id = 3").first().failed_reason == f"{runs.GAVE_UP}: OSError: connection reset"


def test_a_job_gives_up(spark, held, tmp_path):
    pages = {f"{BASE}/story-{k}": article(k) for k in range(2)}
    assert drive(spark, held, tmp_path, pages, policy=reports.Policy()) == [(1, "failed")]
    job = held.read("source_jobs").first()
    assert "INSUFFICIENT_COVERAGE_MONTHS" in job.error and json.loads(job.stats)["completionGate"]["passed"] is False
    assert drive(spark, held, tmp_path, pages) == []


def test_a_job_fails_after_its_attempts(spark, held):
    def broken(job):
        raise OSError("no network")

    assert runs.run_queue(held, "w", broken, at_noon) == [(1, "retried"), (1, "retried"), (1, "failed")]
    assert json.loads(runs.status_document(held.read("source_jobs"), held.read("sources")).first().value) == {"queued": 0, "running": 0, "completed": 0, "failed": 1, "cancelled": 0, "total": 1, "current": None, "next": None}


def test_a_stale_job_is_recovered_and_waiting_ends(spark, held):
    first = queue.claim(held.read("source_jobs"), held.read("sources"), "lost", F.lit("2026-07-13 08:00:00").cast("timestamp"))
    held.write("source_jobs", first)
    assert runs.run_queue(held, "w", lambda job: {}, at_noon) == [(1, "completed")]
    waits = []
    assert runs.run_queue(held, "w", lambda job: {}, at_noon, once=False, stopped=lambda: len(waits) > 1, sleep=waits.append) == [] and waits == [5.0, 5.0]


def found(spark, rows):
    return spark.createDataFrame([(k, u, c, "s", None, "sitemap", None, j) for k, (u, c, j) in enumerate(rows)], "position long, url string, canonical_url string, source_name string, source_category string, discovery_method string, source_id long, source_job_id long")


def test_inserted_urls_and_their_jobs(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"))
    assert runs.insert_urls(s, found(spark, [("a", "A", 1), ("b", "B", 1), ("a", "A", 1), ("a2", "A", 1), ("c", None, None), ("c", None, None)]), at_noon()) == {"inserted": 3, "duplicated": 3}
    assert runs.insert_urls(s, found(spark, [("a", "A", 2), ("x", "B", 2), ("a", "A", 1), ("c", None, 2)]), at_noon()) == {"inserted": 3, "duplicated": 1}
    assert [(r.id, r.url) for r in s.read("urls").orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "c")]
    assert {(r.source_job_id, r.url_id, r.status) for r in s.read("source_job_urls").collect()} == {(1, 1, "pending"), (1, 2, "pending"), (2, 1, "pending"), (2, 2, "pending"), (2, 3, "pending")}


def one_by_one(articles, inputs):
    """What inserting one after another does: {input_id: outcome} and the articles after."""
    out = {}
    for i, url, canonical, content in inputs:
        keys = [("url", url), ("canonical_url", canonical), ("content_hash", content)]
        hits = [[a for a in articles if a[k] == v] for k, v in keys if v is not None]
        known = next((min(h, key=lambda a: a["id"]) for h in hits if h), None)
        if known is None:
            articles.append({"id": max((a["id"] for a in articles), default=0) + 1, "url": url, "canonical_url": canonical, "content_hash": content, "quality_score": 90.0})
            out[i] = "insert"
        elif known["quality_score"] is None and not any(a is not known and (a["content_hash"] == content or canonical is not None and a["canonical_url"] == canonical) for a in articles):
            known |= {"canonical_url": canonical, "content_hash": content, "quality_score": 90.0}
            out[i] = "upgrade"
        else:
            out[i] = "refuse"
    return out


def test_upserted_articles(spark, tmp_path):
    """Legacy upgrade, conflict, refusal and insert; what hung on an upgraded article goes."""
    s = store.Store(spark, str(tmp_path / "s"))
    old = [{"id": 1, "url": "a", "canonical_url": None, "content_hash": "h1", "quality_score": None}, {"id": 2, "url": "b", "canonical_url": "B", "content_hash": "h2", "quality_score": 80.0}, {"id": 3, "url": "c", "canonical_url": None, "content_hash": "h3", "quality_score": None}]
    s.extend("articles", spark.createDataFrame([(a["id"], a["url"], a["canonical_url"], a["content_hash"], a["quality_score"]) for a in old], "id long, url string, canonical_url string, content_hash string, quality_score double").withColumn("title", F.lit("old")))
    s.extend("article_classifications", spark.createDataFrame([(1, 1), (2, 2)], "id long, article_id long"))
    s.extend("matches", spark.createDataFrame([(1, 1, "c", "k"), (2, 3, "c", "k")], "id long, article_id long, category string, keyword string"))
    inputs = [(10, "a", "A", "g1"), (11, "x", "B", "g2"), (12, "c", "B", "g3"), (13, "n", "N", "g4"), (14, "m", None, "g4")]
    rows = spark.createDataFrame([(*i, 90.0, "new") for i in inputs], "input_id long, url string, canonical_url string, content_hash string, quality_score double, title string")
    for name in ("source_name", "source_category", "text", "published_date"):
        rows = rows.withColumn(name, F.lit("v"))
    rows = rows.withColumn("source_id", F.lit(1).cast("long")).withColumn("source_job_id", F.lit(1).cast("long"))
    got = {r.input_id: r.outcome for r in runs.upsert_articles(s, rows, at_noon()).collect()}
    assert got == one_by_one(old, inputs) == {10: "upgrade", 11: "refuse", 12: "refuse", 13: "insert", 14: "refuse"}
    after = {r.id: (r.url, r.canonical_url, r.content_hash, r.title) for r in s.read("articles").collect()}
    assert after == {1: ("a", "A", "g1", "new"), 2: ("b", "B", "h2", "old"), 3: ("c", None, "h3", "old"), 4: ("n", "N", "g4", "new")}
    assert {r.article_id for r in s.read("article_classifications").collect()} == {2} and {r.article_id for r in s.read("matches").collect()} == {3}


def test_changes_for_one_key_leave_one_row(spark):
    rows = spark.createDataFrame([(1, "pending", 0, None, None), (2, "pending", 0, None, None)], "url_id long, status string, crawl_attempt_count int, failed_reason string, crawled_at timestamp")
    changes = spark.createDataFrame([(1, "failed", "x", 1), (1, "crawled", None, 2), (1, "pending", "again", 0)], "url_id long, new_status string, reason string, at int")
    out = {r.url_id: r for r in queue.mark_urls(rows, changes, at_noon(), order=F.col("at")).collect()}
    assert len(out) == 2 and (out[1].status, out[1].crawl_attempt_count, out[1].failed_reason) == ("crawled", 2, None) and out[1].crawled_at is not None
    assert (out[2].status, out[2].crawl_attempt_count) == ("pending", 0)
    links = spark.createDataFrame([(1, 1, None), (1, 2, 7)], "source_job_id long, url_id long, article_id long")
    linked = queue.link_articles(links, spark.createDataFrame([(1, 1, 4), (1, 1, 5)], "source_job_id long, url_id long, article_id long")).collect()
    assert sorted((r.url_id, r.article_id) for r in linked) == [(1, 5), (2, 7)]


def test_admission_of_a_long_chain(spark):
    """Rows that share a hash and an address by turns: every second one is accepted, however long the chain."""
    rows = spark.createDataFrame([(k, f"u{k}", f"c{(k + 1) // 2}", f"h{k // 2}") for k in range(24)], "input_id long, url string, canonical_url string, content_hash string")
    assert sorted(r.input_id for r in identity.admitted(rows, "input_id").collect()) == list(range(0, 24, 2))


def test_store_appends_parts_and_refuses_a_second_writer(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"))
    assert s.tables() == {} and not s.has_column("urls", "url") and s.read("urls").count() == 0
    for k in range(3):
        s.append("urls", spark.createDataFrame([(f"u{k}{j}",) for j in range(2)], "url string"), [F.col("url")])
    assert [(r.id, r.url) for r in s.read("urls").orderBy("id").collect()] == [(1, "u00"), (2, "u01"), (3, "u10"), (4, "u11"), (5, "u20"), (6, "u21")]
    assert len(s._parts("urls")[1]) == 3 and s.has_column("urls", "canonical_url") and not s.has_column("urls", "nothing")
    with pytest.raises(Exception, match="(?i)exists"):
        s._publish("urls", 3, [])
    with pytest.raises(ValueError, match="not unique"):
        s.write("sources", spark.createDataFrame([(1, "k"), (2, "k")], "id long, source_key string"))
    s.write("urls", s.read("urls").where("id > 4"))
    assert s.read("urls").count() == 2


def test_filter_batch(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"))
    rows = [(1, "https://e.com/news/a-long-story-about-rivers", "pending", "One"), (2, "https://e.com/tag/x", "pending", "One"), (3, "https://e.com/tag/y", "crawled", "One"), (4, "https://e.com/tag/z", "pending", "Two")]
    s.extend("urls", spark.createDataFrame(rows, "id long, url string, status string, source_name string"))
    assert runs.filter_batch(s, at_noon(), source_like="one", dry_run=True) == {"checked": 2, "keep": 1, "skip": 1}
    assert s.read("urls").where("status = 'skipped'").count() == 0
    assert runs.filter_batch(s, at_noon()) == {"checked": 3, "keep": 1, "skip": 2}
    assert {r.id for r in s.read("urls").where("status = 'skipped' AND failed_reason IS NOT NULL").collect()} == {2, 4}


def test_classifier_run(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"))
    rows = [(1, "About recycling", "2026-07-01"), (2, "Page not found", "2026-07-01"), (3, "Old", "2020-01-01"), (4, "Fails", "2026-07-02"), (5, "Nothing", "2026-07-03")]
    s.extend("articles", spark.createDataFrame([(i, f"u{i}", t, d, PROSE) for i, t, d in rows], "id long, url string, title string, published_date string, text string").withColumn("source_name", F.lit("s")))
    s.extend("matches", spark.createDataFrame([(1, 5, "c", "k")], "id long, article_id long, category string, keyword string"))

    def ask(title, text):
        if title == "Fails":
            raise OSError("timeout")
        return json.dumps({"isNewsArticle": True, "isRelevant": title.startswith("About"), "matchedKeywords": ["Recycling", "Weather"], "reason": "r"})

    out = runs.classifier_run(s, ask, "m", at_noon())
    assert out == {"selected": 5, "error_page": 1, "date": 1, "keyword": 0, "calls": 3, "failures": 1, "relevant": 1, "classified": 4}
    assert {(r.article_id, r.is_relevant) for r in s.read("article_classifications").collect()} == {(1, True), (2, False), (3, False), (5, False)}
    assert {(r.article_id, r.keyword) for r in s.read("matches").collect()} == {(1, "Recycling")}
    assert runs.classifier_run(s, lambda t, x: "{}", "m", at_noon())["selected"] == 1


def test_model_request():
    body = classify.request({"title": "T", "text": "x" * 9000, "source_category": "Tech news", "url": "u"}, "m", own_only=True)
    assert body["format"] == "json" and body["stream"] is False and body["options"] == {"temperature": 0.1, "num_ctx": 8192}
    assert "x" * 7000 in body["prompt"] and "x" * 7001 not in body["prompt"] and "Patent protection" in body["prompt"] and "Money supply" not in body["prompt"]
    assert "Money supply" in classify.request({"text": None}, "m", own_only=True)["prompt"] and "Date: unknown" in classify.request({}, "m")["prompt"]


def test_json_without_exceptions():
    assert [runs.read_json(x, 0) for x in (None, "", "{", '{"a": [1]}', "null")] == [0, 0, 0, {"a": [1]}, None]


def test_gate_over_batches_holds_identity_against_all_before(spark, tmp_path):
    folder = tmp_path / "in"
    rng = random.Random(1)
    texts = [PROSE.replace("committee", f"committee{rng.random()}") for _ in range(3)]
    for k, chosen in enumerate(([0, 1], [1, 2])):
        rows = [(10 * k + j, f"https://e.com/news/{k}-{j}", "Committees meet", "2026-07-01T08:00:00Z", texts[j]) for j in chosen]
        spark.createDataFrame(rows, gate.EVENTS).write.mode("append").json(str(folder))
        stream = spark.readStream.schema(gate.EVENTS).json(str(folder))
        gate.run(stream, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "check"), at_noon()).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "good")).collect()) == [0, 1, 12]
    assert [(r.doc_id, r.reason_code) for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == [(11, "DUPLICATE")]
