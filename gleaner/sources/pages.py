"""Article records from HTML pages.

Main text is that of the first ``article`` (else ``main``, else ``body``) once
clutter is taken out, by the standard library's parser; it stands in for a
readability heuristic.
"""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from gleaner.functions import dates, text, urls

CLUTTER = frozenset("form footer aside nav iframe template noscript style script".split())
CLUTTER_ROLES = frozenset(("contentinfo", "banner", "navigation"))
CLUTTER_CLASSES = frozenset("share-tools social-share recommended related-posts newsletter".split())
ARTICLE_TYPES = frozenset("techarticle scholarlyarticle report blogposting analysisnewsarticle newsarticle article".split())
META_DATES = [("property", "article:published_time"), ("itemprop", "datePublished"), ("name", "pubdate"), ("name", "publish-date")]
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BREAKS = frozenset("p div br li h1 h2 h3 h4 h5 h6 section article main tr blockquote pre ul ol table figure".split())


def json_ld_nodes(value) -> list[dict]:
    """Objects of a JSON-LD value: arrays and graphs are flattened."""
    if isinstance(value, list):
        return [n for v in value for n in json_ld_nodes(v)]
    if not isinstance(value, dict):
        return []
    graph = value.get("@graph")
    return [value, *(json_ld_nodes(graph) if isinstance(graph, list) else [])]


def is_article_node(node: dict) -> bool:
    kinds = node.get("@type")
    return any(isinstance(k, str) and k.lower() in ARTICLE_TYPES for k in (kinds if isinstance(kinds, list) else [kinds]))


def json_ld_article(scripts: list[str]) -> tuple[str | None, str | None, bool]:
    """(headline, datePublished, whether an article was found); dateModified proves nothing."""
    spare = None
    for script in scripts:
        try:
            nodes = json_ld_nodes(json.loads(script))
        except ValueError:
            continue
        for node in filter(is_article_node, nodes):
            raw = node.get("headline")
            headline = " ".join(raw.split()) or None if isinstance(raw, str) else None
            spare = spare or headline
            published = node.get("datePublished")
            if isinstance(published, str) and published:
                return headline or spare, published, True
    return spare, None, spare is not None


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.metas: list[dict] = []
        self.scripts: list[str] = []
        self.canonical = None
        self.title: list[str] = []
        self.heads: dict[str, list[str]] = {}
        self.text = {"article": [], "main": [], "body": []}
        self.stack: list[tuple[str, bool]] = []
        self.script = None

    def handle_starttag(self, tag, attrs):
        held = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.metas.append(held)
        if tag == "link" and held.get("rel", "").lower() == "canonical" and self.canonical is None:
            self.canonical = held.get("href")
        if tag == "script" and held.get("type", "").lower() == "application/ld+json":
            self.script = []
        if tag in _BREAKS:
            self._write("\n")
        if tag in _VOID:
            return
        clutter = tag in CLUTTER or held.get("role") in CLUTTER_ROLES or held.get("aria-hidden") == "true" or bool(CLUTTER_CLASSES & set(held.get("class", "").split()))
        self.stack.append((tag, clutter))

    def handle_endtag(self, tag):
        if tag == "script" and self.script is not None:
            self.scripts.append("".join(self.script))
            self.script = None
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass
        if tag in _BREAKS:
            self._write("\n")

    def handle_data(self, data):
        if self.script is not None:
            self.script.append(data)
        tags = [t for t, _ in self.stack]
        if "title" in tags and "svg" not in tags:
            self.title.append(data)
        self._write(data)

    def _write(self, data):
        if any(c for _, c in self.stack):
            return
        tags = [t for t, _ in self.stack]
        if "head" in tags or "title" in tags:
            return
        self.text["body"].append(data)
        for root in ("article", "main"):
            if root in tags:
                self.text[root].append(data)
        if "h1" in tags:
            where = "article" if "article" in tags else "main" if "main" in tags else "any"
            self.heads.setdefault(where, []).append(data)

    def meta(self, kind, name):
        return next((m.get("content", "").strip() or None for m in self.metas if m.get(kind) == name), None)


RECORD = pa.struct([("title", pa.string()), ("text", pa.string()), ("canonical_raw", pa.string()), ("date_candidates", pa.list_(pa.struct([("source", pa.string()), ("value", pa.string())]))), ("is_article_document", pa.bool_())])


def record(html: str) -> dict:
    """What a page says of itself, dates unparsed."""
    page = _Page()
    page.feed(html)
    page.close()
    headline, published, matched = json_ld_article(page.scripts)
    heading = " ".join("".join(next((page.heads[k] for k in ("article", "main", "any") if k in page.heads), [])).split())
    titles = [headline, page.meta("property", "og:title"), page.meta("name", "twitter:title"), heading, " ".join("".join(page.title).split())]
    body = next((b for b in ("".join(page.text[k]).strip() for k in ("article", "main", "body")) if b), "")
    lines = [" ".join(x.split()) for x in body.split("\n")]
    found = [(f"meta:{name}", page.meta(kind, name)) for kind, name in META_DATES] + [("jsonld:datePublished", published)]
    return {
        "title": " ".join(next((t for t in titles if t), "").split()),
        "text": "\n\n".join(x for x in lines if x),
        "canonical_raw": page.canonical,
        "date_candidates": [{"source": s, "value": v} for s, v in found if v],
        "is_article_document": matched or (page.meta("property", "og:type") or "").lower() in ("article", "newsarticle", "blogposting"),
    }


@arrow_udf(from_arrow_type(RECORD))
def page_record(column: pa.Array) -> pa.Array:
    return pa.array([record(h or "") for h in column.to_pylist()], RECORD)


def articles(pages: DataFrame, final_url: Column, requested_url: Column) -> DataFrame:
    """Pages with title, text, published_date and its source, canonical_url and is_article_document.

    The first date that can be parsed counts.  A canonical link to another domain gives way
    to the final address.
    """
    rows = pages.withColumn("_r", page_record(F.col("html")))
    parseable = F.filter("_r.date_candidates", lambda d: dates.parse_strict(d["value"]).isNotNull())
    chosen = F.get(parseable, 0)
    link = F.when(F.col("_r.canonical_raw").isNotNull(), urls.resolved(F.col("_r.canonical_raw"), final_url)).otherwise(final_url)
    canonical = urls.canonical(link)
    own = F.when(urls.same_domain(canonical, requested_url), canonical)
    out = rows.withColumn("title", F.col("_r.title")).withColumn("text", F.col("_r.text")).withColumn("published_date", chosen["value"]).withColumn("published_date_source", chosen["source"])
    return out.withColumn("canonical_url", F.coalesce(own, urls.canonical(final_url))).withColumn("is_article_document", F.col("_r.is_article_document")).drop("_r")


def shown_title(html: Column) -> Column:
    """The ``<title>`` by a regular expression, one line."""
    return text.inline(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def crawl_rejection(url: Column, status: Column, content_type: Column, address_private: Column, final_url: Column, base: Column, is_document: Column) -> Column:
    """The first code that turns a fetched page away before the quality gate, else null."""
    return (
        F.when(urls.skip_article(url), "NON_ARTICLE_URL")
        .when(status.isNull(), "MISSING_HTTP_RESPONSE")
        .when((status < 200) | (status >= 400), "HTTP_STATUS")
        .when(~F.coalesce(F.lower(content_type).rlike("application/xhtml\\+xml|text/html"), F.lit(False)), "NON_HTML_RESPONSE")
        .when(F.coalesce(address_private, F.lit(True)), "NON_PUBLIC_RESPONSE_ADDRESS")
        .when(~urls.same_domain(final_url, base), "CROSS_DOMAIN_REDIRECT")
        .when(urls.skip_article(final_url), "NON_ARTICLE_FINAL_URL")
        .when(~F.coalesce(is_document, F.lit(False)), "MISSING_ARTICLE_DOCUMENT_SIGNAL")
    )
