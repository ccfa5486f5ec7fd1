"""Sitemaps: entries of a document, and the walk over an index."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import StringType

from gleaner.functions import urls
from gleaner.functions.session import cut

_PREFIX = r"(?:[A-Za-z_][\w.\-]*:)?"
MAX_FILES, MAX_DEPTH, MAX_URLS = 1_000, 8, 50_000


@arrow_udf(StringType())
def xml_text(column: pa.Array) -> pa.Array:
    """An element's text: CDATA taken off, the five XML entities and numeric references decoded."""
    import re

    named = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

    def entity(m):
        body = m[1].lower()
        if body in named:
            return named[body]
        code = int(body[2:], 16) if body.startswith("#x") else int(body[1:])
        return chr(code) if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else m[0]

    def clean(s):
        if s is None:
            return None
        m = re.fullmatch(r"\s*<!\[CDATA\[(.*?)\]\]>\s*", s, re.S | re.I)
        return re.sub(r"&(#[xX][0-9a-fA-F]+|#[0-9]+|amp|lt|gt|quot|apos);", entity, (m[1] if m else s).strip(), flags=re.I)

    return pa.array([clean(s) for s in column.to_pylist()], pa.string())


def _element(xml: Column, tag: str) -> Column:
    found = F.regexp_extract(xml, rf"(?is)<{_PREFIX}{tag}(?![\w.\-])[^>]*>(.*?)</{_PREFIX}{tag}\s*>", 1)
    return F.when(found != "", found)


def _blocks(xml: Column, tag: str) -> Column:
    return F.regexp_extract_all(xml, F.lit(rf"(?is)<{_PREFIX}{tag}(?![\w.\-])[^>]*>(.*?)</{_PREFIX}{tag}\s*>"), F.lit(1))


def entries(sitemaps: DataFrame) -> DataFrame:
    """(sitemap_url, kind, position, loc, lastmod) of documents (sitemap_url, xml).

    ``kind`` is sitemap or url; where a document has neither, every ``loc`` is a bare
    entry without date.  Entries come in this order, those without a loc are dropped.
    """
    child, page = _blocks(F.col("xml"), "sitemap"), _blocks(F.col("xml"), "url")
    bare = F.when((F.size(child) == 0) & (F.size(page) == 0), F.regexp_extract_all(F.col("xml"), F.lit(rf"(?is)(<{_PREFIX}loc(?![\w.\-])[^>]*>.*?</{_PREFIX}loc\s*>)"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    tag = lambda kind: lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("block"))
    every = F.concat(F.transform(child, tag("sitemap")), F.transform(page, tag("url")), F.transform(bare, tag("bare")))
    rows = sitemaps.select("sitemap_url", F.posexplode(every).alias("position", "e"))
    out = rows.select("sitemap_url", F.col("e.kind").alias("kind"), "position", xml_text(_element(F.col("e.block"), "loc")).alias("loc"), F.when(F.col("e.kind") != "bare", xml_text(_element(F.col("e.block"), "lastmod"))).alias("lastmod"))
    return out.where("loc IS NOT NULL AND loc <> ''")


def routed(found: DataFrame, base: Column, cutoff: Column) -> DataFrame:
    """Entries that are recent enough and of the base's domain, resolved, with ``is_sitemap``; no pages that discovery skips."""
    kept = found.where(urls.keep_entry(F.col("lastmod"), cutoff)).withColumn("url", urls.discovered(F.col("loc"), F.col("sitemap_url")))
    kept = kept.where(F.col("url").isNotNull() & urls.same_domain(F.col("url"), base))
    kept = kept.withColumn("is_sitemap", urls.sitemap(F.col("url")) | (F.col("kind") == "sitemap"))
    return kept.where(F.col("is_sitemap") | ~(urls.skip(F.col("url")) | urls.listing(F.col("url"))))


def walk(start: DataFrame, fetch, base: Column, cutoff: Column, max_files: int = MAX_FILES, max_depth: int = MAX_DEPTH, max_urls: int = MAX_URLS) -> DataFrame:
    """(url, depth, sitemap_url, position) of every page below the start sitemaps (sitemap_url), first seen first.

    ``fetch`` turns a frontier (sitemap_url) into documents (sitemap_url, xml).  Levels
    are walked one after another, each as one job.  Reaching a limit is an error.
    """
    frontier, visited, pages = cut(start.select("sitemap_url").distinct()), None, None
    for depth in range(max_depth + 2):
        if frontier.isEmpty():
            break
        if depth > max_depth:
            raise ValueError(f"exceeded MAX_SITEMAP_DEPTH={max_depth}")
        visited = frontier if visited is None else visited.unionByName(frontier)
        if visited.count() > max_files:
            raise ValueError(f"reached MAX_SITEMAP_FILES={max_files}; sitemap index is too large")
        found = cut(routed(entries(fetch(frontier)), base, cutoff).withColumn("depth", F.lit(depth)))
        here = found.where("NOT is_sitemap").select("url", "depth", "sitemap_url", "position")
        pages = here if pages is None else pages.unionByName(here)
        below = found.where("is_sitemap").select(F.col("url").alias("sitemap_url")).distinct()
        frontier = cut(below.join(visited, "sitemap_url", "left_anti"))
    if pages is None:
        return start.sparkSession.createDataFrame([], "url string, depth int, sitemap_url string, position int")
    first = pages.groupBy("url").agg(F.min(F.struct("depth", "sitemap_url", "position")).alias("f")).select("url", "f.*")
    if first.count() >= max_urls:
        raise ValueError(f"reached MAX_SITEMAP_URLS={max_urls}; raise the cap rather than accepting a partial backfill")
    return first
