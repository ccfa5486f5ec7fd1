"""Sources, extraction, queue, store, admission, reports, classification and the stream."""

import gzip
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import classify, identity, queue, reports, store
from gleaner.sources import fetch, listings, pages, registry, sitemaps
from gleaner.streaming import gate
from test_functions import PROSE, at_noon

JOBS = store.SCHEMAS["source_jobs"]
SOURCES = store.SCHEMAS["sources"]


def test_sitemap_entries(spark):
    xml = "<ns:urlset><ns:url><ns:loc> https://e.com/a?x=1&amp;y=2 </ns:loc><ns:lastmod>2026-07-01</ns:lastmod></ns:url><url><loc><![CDATA[https://e.com/b]]></loc></url><url><lastmod>2020-01-01</lastmod></url><url><loc>https://e.com/&#x63;</loc></url></ns:urlset>"
    found = sitemaps.entries(spark.createDataFrame([("s", xml), ("t", "<loc>https://e.com/d</loc>"), ("u", None)], "sitemap_url string, xml string"))
    assert {(r.loc, r.lastmod) for r in found.collect()} == {("https://e.com/a?x=1&y=2", "2026-07-01"), ("https://e.com/b", None), ("https://e.com/c", None), ("https://e.com/d", None)}


def test_sitemap_walk(spark):
    site = {
        "https://e.com/sitemap.xml": "<sitemapindex><sitemap><loc>https://e.com/one.xml</loc></sitemap><sitemap><loc>https://e.com/sitemap.xml</loc></sitemap></sitemapindex>",
        "https://e.com/one.xml": "<urlset>" + "".join(f"<url><loc>{u}</loc><lastmod>{d}</lastmod></url>" for u, d in [("https://e.com/fresh-story", "2026-07-01"), ("https://e.com/old-story", "2020-01-01"), ("https://other.com/x", "2026-07-01"), ("https://e.com/odd-date", "soon")]) + "</urlset>",
    }
    documents = spark.createDataFrame(list(site.items()), "sitemap_url string, xml string")
    start = documents.where("sitemap_url LIKE '%sitemap.xml'").select("sitemap_url")
    run = lambda **o: sitemaps.walk(start, lambda f: f.join(documents, "sitemap_url"), F.lit("https://e.com"), F.lit("2025-07-13").cast("timestamp"), **o)
    assert {r.url for r in run().collect()} == {"https://e.com/fresh-story", "https://e.com/odd-date"}
    with pytest.raises(ValueError, match="MAX_SITEMAP_FILES"):
        run(max_files=1)
    with pytest.raises(ValueError, match="MAX_SITEMAP_URLS"):
        run(max_urls=2)


def test_fetch_limits():
    ok = lambda body, kind="text/xml": lambda u: (200, {"content-type": kind}, [body])
    public = lambda h: ["8.8.8.8"]
    assert fetch.fetch_text("https://e.com/", ok(gzip.compress(b"<x/>")), public) == "<x/>"
    with pytest.raises(ValueError, match="unsafe"):
        fetch.fetch_text("https://e.com/", ok(b""), lambda h: ["10.0.0.1"])
    with pytest.raises(ValueError, match="redirects"):
        fetch.fetch_text("https://e.com/", lambda u: (302, {"location": "/again"}, []), public)
    with pytest.raises(ValueError, match="content type"):
        fetch.fetch_text("https://e.com/", ok(b"", "image/png"), public)
    with pytest.raises(ValueError, match="exceeds"):
        fetch.capped([b"abc", b"def"], 5)
    with pytest.raises(ValueError, match="Uncompressed"):
        fetch.inflated(gzip.compress(b"x" * 1000), 100)


def page(ld=None, head="", body=""):
    script = f'<script type="application/ld+json">{json.dumps(ld)}</script>' if ld else ""
    return f"<html><head><title>Page title</title>{head}{script}</head><body><nav>Menu</nav><article><h1>Heading</h1><p>First part.</p><p>Second part.</p></article><footer>Foot</footer>{body}</body></html>"


def test_article_extraction(spark):
    rows = [
        (1, page({"@graph": [{"@type": "NewsArticle", "headline": "Told  so", "datePublished": "2026-07-01T00:00:00Z", "dateModified": "2026-07-02"}]}, '<link rel="canonical" href="/real?utm_source=x">')),
        (2, page({"@type": "Article", "headline": "H", "dateModified": "2026-07-02T00:00:00Z"})),
        (3, page(body="<time datetime='2026-07-01'>then</time>")),
        (4, page(head='<meta property="og:type" content="article"><meta property="article:published_time" content="nonsense"><meta name="pubdate" content="2026-06-30"><link rel="canonical" href="https://else.com/x">')),
        (5, None),
    ]
    at = F.lit("https://www.e.com/found")
    out = {r.page_id: r for r in pages.articles(spark.createDataFrame(rows, "page_id int, html string"), at, at).collect()}
    assert (out[1].title, out[1].published_date, out[1].published_date_source, out[1].canonical_url, out[1].is_article_document) == ("Told so", "2026-07-01T00:00:00Z", "jsonld:datePublished", "https://e.com/real", True)
    assert "First part.\n\nSecond part." in out[1].text and "Menu" not in out[1].text and "Foot" not in out[1].text
    assert out[2].published_date is None and out[3].published_date is None and not out[3].is_article_document
    assert (out[4].title, out[4].published_date, out[4].canonical_url, out[4].is_article_document) == ("Heading", "2026-06-30", "https://e.com/found", True)
    assert out[5].text == ""


def test_registry():
    good = {"name": "A Source!", "homepageUrl": "https://example.com", "archiveUrlTemplates": ["https://example.com/{yyyy}/{mm}"]}
    assert registry.validate(good) is good
    assert registry.key(good) == registry.key(dict(reversed(good.items())) | {"category": None}) and registry.key(good).startswith("a-source:")
    for change, words in [({"name": " "}, "name"), ({"homepageUrl": None}, "needs"), ({"homepageUrl": "http://10.0.0.1"}, "Private"), ({"category": "sport"}, "category"), ({"minCoverageMonths": 14}, "between"), ({"startUrls": [""]}, "non-empty"), ({"homepageUrl": "https://u:p@e.com"}, "credentials"), ({"searchUrlTemplates": ["ftp://e.com"]}, "HTTP")]:
        with pytest.raises(ValueError, match=words):
            registry.validate(good | change)


def test_registry_file(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"name": "First Post"}, {"name": "Second post", "startUrls": ["https://e.com"]}]))
    found = registry.read(spark, str(tmp_path / "s.json"))
    assert registry.select(found, "POST").first().name == "First Post" and registry.select(found, index=1).first().startUrls == ["https://e.com"]
    with pytest.raises(ValueError):
        registry.select(found, "third")


def queue_tables(spark, statuses):
    jobs = spark.createDataFrame([(k + 1, k + 1, s, 365) for k, s in enumerate(statuses)], "id long, source_id long, status string, requested_days_back int")
    for f in spark.createDataFrame([], JOBS).schema:
        if f.name not in jobs.columns:
            jobs = jobs.withColumn(f.name, F.lit(0 if f.name == "attempt_count" else None).cast(f.dataType))
    sources = spark.createDataFrame([(k + 1, f"k{k + 1}", f"s{k + 1}") for k in range(len(statuses))], "id long, source_key string, name string")
    for f in spark.createDataFrame([], SOURCES).schema:
        if f.name not in sources.columns:
            sources = sources.withColumn(f.name, F.lit(True if f.name == "enabled" else None).cast(f.dataType))
    return jobs, sources


def status(jobs):
    return [r.status for r in jobs.orderBy("id").collect()]


def test_queue(spark):
    jobs, sources = queue_tables(spark, ["queued", "queued", "completed"])
    one = queue.claim(jobs, sources, "w", at_noon())
    assert status(one) == ["running", "queued", "completed"] and one.where("id = 1").first().attempt_count == 1
    assert status(queue.claim(one, sources, "w", at_noon())) == status(one)
    beaten, alive = queue.heartbeat(one, 1, at_noon(), "w")
    assert alive and not queue.heartbeat(one, 1, at_noon(), "other")[1] and not queue.heartbeat(one, 2, at_noon())[1]
    assert status(queue.complete(beaten, 1, at_noon(), {"b": 1, "a": 2})) == ["completed", "queued", "completed"]
    assert status(queue.fail(beaten, 1, " ", at_noon(), retry=True))[0] == "queued" and status(queue.fail(beaten, 1, "x", at_noon()))[0] == "failed"
    with pytest.raises(ValueError, match="not running"):
        queue.complete(jobs, 1, at_noon())
    with pytest.raises(ValueError, match="running"):
        queue.set_enabled(one, sources, 1, False, at_noon())
    cancelled, off = queue.set_enabled(jobs, sources, 2, False, at_noon())
    assert status(cancelled) == ["queued", "cancelled", "completed"] and not off.where("id = 2").first().enabled
    later = F.lit("2026-07-13 14:30:00").cast("timestamp")
    links = spark.createDataFrame([(1, 5, None, "failed", 1, "x", None), (2, 5, None, "failed", 1, "x", None)], store.SCHEMAS["source_job_urls"])
    again, freed = queue.requeue_stale(one, links, later)
    assert status(again)[0] == "queued" and [r.status for r in freed.orderBy("source_job_id").collect()] == ["pending", "failed"]
    assert status(queue.requeue_stale(one, links, at_noon())[0])[0] == "running"


def test_enqueue(spark):
    jobs, sources = queue_tables(spark, ["queued"])
    j, s, new = queue.enqueue(jobs, sources, {"name": "s1"}, "k1", "{}", at_noon())
    assert not new and j.count() == 1
    j, s, new = queue.enqueue(jobs, sources, {"name": "n"}, "fresh", "{}", at_noon())
    assert new and j.count() == 2 and s.count() == 2
    with pytest.raises(ValueError, match="365"):
        queue.enqueue(jobs, sources, {"name": "n"}, "fresh", "{}", at_noon(), days_back=180)


def test_admission_equals_one_by_one(spark):
    rng = random.Random(2)
    rows = [(k, f"u{rng.randrange(60)}", rng.choice([None, f"c{rng.randrange(60)}"]), f"h{rng.randrange(60)}") for k in range(80)]
    held, kept = set(), []
    for k, *keys in rows:
        mine = {(n, v) for n, v in enumerate(keys) if v is not None}
        if not mine & held:
            held |= mine
            kept.append(k)
    frame = spark.createDataFrame(rows, "input_id int, url string, canonical_url string, content_hash string")
    assert sorted(r.input_id for r in identity.admitted(frame, "input_id").collect()) == kept


def test_outcomes(spark):
    known = spark.createDataFrame([(1, "u1", "c1", "h1", None), (2, "u2", "c2", "h2", 90.0)], "id long, url string, canonical_url string, content_hash string, quality_score double")
    given = spark.createDataFrame([(1, "u1", "c1", "new"), (2, "u2", "x", "y"), (3, "u3", "c3", "h3"), (4, "u4", "c3", "h4")], "input_id long, url string, canonical_url string, content_hash string")
    assert [r.outcome for r in identity.outcomes(given, known).orderBy("input_id").collect()] == ["upgrade", "refuse", "insert", "refuse"]


def test_store(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"))
    assert s.read("urls").count() == 0
    for batch in (["b", "a"], ["c"]):
        s.append("urls", spark.createDataFrame([(x,) for x in batch], "url string"), [F.col("url")])
    assert [(r.id, r.url) for r in s.read("urls").orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "c")]
    found = spark.createDataFrame([("a", None, 7), ("x", None, 7), ("b", None, None), ("c", None, 8)], "url string, canonical_url string, source_job_id long")
    links = spark.createDataFrame([(8, 3)], "source_job_id long, url_id long")
    assert [tuple(r) for r in store.new_links(found, s.read("urls"), links).collect()] == [(7, 1)]
    assert [r.url for r in store.new_urls(found, s.read("urls"), [F.col("url")]).collect()] == ["x"]
    assert store.pending(s.read("urls").withColumn("status", F.lit("pending")), 10, domains=[]).count() == 0
    bad = spark.createDataFrame([(1, 1, "odd", 365), (2, 1, "queued", 180), (3, 1, "running", 365)], "id long, source_id long, status string, requested_days_back int")
    with pytest.raises(ValueError, match="status .*days_back"):
        store.check_jobs(bad)
    with pytest.raises(ValueError, match="not unique"):
        store.check_jobs(bad.where("id = 3").union(bad.where("id = 2").withColumn("requested_days_back", F.lit(365))))
    article = spark.createDataFrame([(1, 7, None, "2026-07-01", "short", 50.0, "h")], "id long, source_job_id long, canonical_url string, published_date string, text string, quality_score double, content_hash string")
    with pytest.raises(ValueError, match="canonical_url.*text.*quality_score"):
        store.check_articles(article, at_noon())
    store.check_articles(article.withColumn("source_job_id", F.lit(None).cast("long")), at_noon())


def test_completion(spark):
    links = spark.createDataFrame([("crawled",), ("skipped",), ("pending",)], "status string")
    accepted = spark.createDataFrame([(1, "broken", None)], "id long, published_date string, published_at timestamp")
    r = reports.completion(links, accepted, at_noon()).first()
    assert not r.passed and r.acceptance_rate == 0.5
    assert r.failure_codes == ["INCOMPLETE_URLS", "INSUFFICIENT_COVERAGE_MONTHS", "INSUFFICIENT_ACCEPTED_ARTICLES", "INVALID_ACCEPTED_DATES"]
    with pytest.raises(ValueError):
        reports.Policy(rate=0)


def test_classification(spark):
    replies = ['{"isNewsArticle":true,"isRelevant":true,"matchedKeywords":["Tax laws",3],"reason":"r"}', 'Sure: {"isNewsArticle":"true"} done', "none", "{bad}", None, '{"isNewsArticle":false,"isRelevant":true}']
    out = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(replies)], "k int, x string").orderBy("k").select(classify.parsed_reply("x")).collect()]
    assert (out[0].is_relevant, out[0].matched_keywords) == (True, ["Tax laws"]) and not out[1].is_news_article and not out[5].is_relevant
    assert [out[k].reason for k in (2, 3, 4)] == ["LLM did not return JSON.", "Failed to parse JSON from LLM response.", "LLM did not return JSON."]
    articles = spark.createDataFrame([(1, "t", "x"), (2, "boom", "x")], "id long, title string, text string")

    def ask(title, body):
        if title == "boom":
            raise RuntimeError
        return replies[0]

    found = classify.classified(articles, ask, "m")
    assert [(r.article_id, r.reason) for r in found.collect()] == [(1, "r")]
    assert {(r.category, r.keyword) for r in classify.matches(found).collect()} == {("political", "Tax laws")}
    nothing = spark.createDataFrame([], "source_name string, category string, matched_keywords string, title string, published_date string, url string, reason string, text string")
    assert [r.value for r in classify.export_blocks(nothing).collect()] == [classify.EMPTY_EXPORT]


def test_listing_walk(spark):
    site = {"https://e.com/news": '<a href="/story-one">a</a><a rel="next" href="/news?page=2">next</a><a href="https://other.com/x">x</a>', "https://e.com/news?page=2": '<a href="/story-two">b</a><a href="/news">back</a>'}
    documents = spark.createDataFrame(list(site.items()), "url string, html string")
    start = spark.createDataFrame([("https://e.com/news",)], "url string")
    found = listings.walk(start, lambda f: f.join(documents, "url").withColumn("page_id", F.xxhash64("url")), F.lit("https://e.com"))
    assert {r.url for r in found.collect()} == {"https://e.com/story-one", "https://e.com/story-two"}
    wall = spark.createDataFrame([("https://e.com/news", "<title>Just a moment...</title>", 1)], "url string, html string, page_id int")
    with pytest.raises(ValueError, match="challenge"):
        listings.walk(start, lambda f: f.join(wall, "url"), F.lit("https://e.com"))


def test_stream_of_articles(spark, tmp_path):
    source, good, bad = (str(tmp_path / x) for x in ("in", "good", "bad"))
    row = lambda k, body, title="Committees meet": (k, f"https://e.com/story-{k}", title, "2026-07-01T08:00:00Z", body)
    for batch in ([row(1, PROSE), row(2, PROSE), row(3, "short")], [row(4, PROSE), row(5, PROSE + " An ending of its own.")]):
        spark.createDataFrame(batch, gate.EVENTS).coalesce(1).write.mode("append").parquet(source)
        gate.run(spark.readStream.schema(gate.EVENTS).parquet(source), good, bad, str(tmp_path / "c"), at_noon()).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(good).collect()) == [1, 5]
    assert {(r.doc_id, r.reason_code) for r in spark.read.parquet(bad).collect()} >= {(2, "DUPLICATE"), (4, "DUPLICATE")}
    assert spark.read.parquet(bad).count() == 3


def test_event_windows_stream_equals_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    query = gate.event_windows(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(spark.table("w")) == rows(gate.event_windows(events))


def test_months_and_templates(spark):
    assert len(list(itertools.chain(reports.expected_months(spark, at_noon()).collect()))) == 13
