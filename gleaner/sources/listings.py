"""Links of listing pages, and the URLs that discovery starts from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from gleaner.functions import dates, urls
from gleaner.functions.session import cut

MAX_REQUESTS, MAX_PAGINATION = 500, 10
_ANCHOR = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"'
#: Types that arrive as text would need a session when the module is imported.
ANCHORS = pa.list_(pa.struct([("href", pa.string()), ("rel", pa.string()), ("text", pa.string())]))


@arrow_udf(from_arrow_type(ANCHORS))
def anchors(column: pa.Array) -> pa.Array:
    """Links of an HTML page with their rel and text, in order."""
    from html.parser import HTMLParser

    class Anchors(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.found, self.open = [], None

        def handle_starttag(self, tag, attrs):
            if tag == "a":
                self.close_anchor()
                held = dict(attrs)
                if held.get("href"):
                    self.open = {"href": held["href"], "rel": held.get("rel") or "", "text": []}

        def handle_endtag(self, tag):
            if tag == "a":
                self.close_anchor()

        def handle_data(self, data):
            if self.open:
                self.open["text"].append(data)

        def close_anchor(self):
            if self.open:
                self.found.append({**self.open, "text": "".join(self.open["text"]).strip()})
                self.open = None

    def links(html):
        if html is None:
            return []
        parser = Anchors()
        parser.feed(html)
        parser.close()
        parser.close_anchor()
        return parser.found

    return pa.array([links(h) for h in column.to_pylist()], ANCHORS)


def hrefs(html: Column) -> Column:
    """Addresses of double-quoted links, in order, by a regular expression alone."""
    return F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))


def links(pages: DataFrame, base: Column) -> DataFrame:
    """(page_id, position, url, rel, text, kind) of links that stay in the domain and aren't skipped.

    ``kind`` is pagination, listing or article.
    """
    rows = pages.select("page_id", F.col("url").alias("page_url"), base.alias("base"), F.posexplode(anchors("html")).alias("position", "a"))
    rows = rows.select("page_id", "position", "base", urls.discovered(F.col("a.href"), F.col("page_url")).alias("url"), F.col("a.rel").alias("rel"), F.col("a.text").alias("text"))
    rows = rows.where(F.col("url").isNotNull() & urls.same_domain(F.col("url"), F.col("base")) & ~urls.skip(F.col("url")))
    kind = F.when(urls.pagination(F.col("url"), F.col("rel"), F.col("text")), "pagination").when(urls.listing(F.col("url")), "listing").otherwise("article")
    return rows.drop("base").withColumn("kind", kind)


def challenge_title(title: Column) -> Column:
    return F.coalesce(F.trim(title).rlike("(?i)^(?:verify you are human|captcha|attention required|access denied|just a moment)"), F.lit(False))


def walk(start: DataFrame, fetch, base: Column, max_requests: int = MAX_REQUESTS, max_pagination: int = MAX_PAGINATION) -> DataFrame:
    """(url) of articles linked from listing pages (url), pagination followed.

    ``fetch`` turns a frontier (url) into pages (page_id, url, html).  A page with more new
    pagination links than the limit, more pages than may be requested, or a page that is a
    challenge by its title, is an error.
    """
    from gleaner.operators.identity import first_seen
    from gleaner.sources.pages import shown_title

    begin = start.select(urls.discovered(F.col("url")).alias("url"))
    frontier = cut(begin.where(F.col("url").isNotNull() & urls.same_domain(F.col("url"), base)).distinct())
    visited, articles = None, None
    while not frontier.isEmpty():
        visited = frontier if visited is None else cut(visited.unionByName(frontier))
        if visited.count() > max_requests:
            raise ValueError("listing pagination hit its safety cap; raise MAX_LISTING_REQUESTS")
        got = cut(fetch(frontier))
        challenged = got.where(challenge_title(shown_title(F.col("html")))).select("url").first()
        if challenged:
            raise ValueError(f"Listing returned a challenge page: {challenged.url}")
        found = cut(links(got, base))
        here = found.where("kind = 'article'").select("url", "page_id", "position")
        articles = here if articles is None else articles.unionByName(here)
        more = found.where("kind = 'pagination'").join(visited, "url", "left_anti")
        more = first_seen(more, ["url"], [F.col("page_id"), F.col("position")])
        if not more.groupBy("page_id").count().where(F.col("count") > max_pagination).isEmpty():
            raise ValueError("listing pagination hit its safety cap; raise MAX_PAGINATION_LINKS_PER_PAGE")
        frontier = cut(more.select("url"))
    if articles is None:
        return start.select("url").limit(0)
    return articles.select("url").distinct()


def archive_urls(sources: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """(name, template, month, url): archive templates by month, newest first."""
    rows = sources.select("name", F.explode("archiveUrlTemplates").alias("template")).withColumn("month", F.explode(F.reverse(dates.months(as_of, days))))
    return rows.withColumn("url", dates.render(F.col("template"), F.col("month")))


def search_urls(sources: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """(name, url): daily templates by day and others by month, distinct."""
    daily = sources.select("name", F.explode("dailySearchUrlTemplates").alias("t")).withColumn("d", F.explode(dates.days(as_of, days)))
    monthly = sources.select("name", F.explode("searchUrlTemplates").alias("t")).withColumn("d", F.explode(dates.months(as_of, days)))
    return daily.unionByName(monthly).select("name", dates.render(F.col("t"), F.col("d")).alias("url")).distinct()


def start_urls(sources: DataFrame) -> DataFrame:
    """(name, url): the configured start pages, else the first of home, base and feed."""
    fallback = F.array_compact(F.array(F.coalesce("homepageUrl", "baseUrl", "feedUrl")))
    return sources.select("name", F.explode(F.when(F.size(F.coalesce("startUrls", F.array())) > 0, F.col("startUrls")).otherwise(fallback)).alias("url"))
