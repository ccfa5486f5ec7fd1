"""Fetching through an injected client, with limits that raise."""

from __future__ import annotations

import zlib
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.functions.addresses import resolves_to_public

MAX_DOWNLOAD, MAX_INFLATED, MAX_REDIRECTS = 50 << 20, 100 << 20, 5
ACCEPTED = ("gzip", "octet-stream", "text/html", "text/plain", "xml")


def capped(chunks, limit: int = MAX_DOWNLOAD, declared: int | None = None) -> bytes:
    """A body's bytes; an error if its declared or real size exceeds the limit."""
    if declared is not None and declared > limit:
        raise ValueError(f"Sitemap response exceeds {limit} bytes")
    parts, size = [], 0
    for chunk in chunks:
        size += len(chunk)
        if size > limit:
            raise ValueError(f"Sitemap response exceeds {limit} bytes")
        parts.append(chunk)
    return b"".join(parts)


def inflated(body: bytes, limit: int = MAX_INFLATED) -> str:
    """The text of a body, inflated where it begins like gzip; an error beyond the limit."""
    if body[:2] == b"\x1f\x8b":
        machine = zlib.decompressobj(wbits=31)
        out = machine.decompress(body, limit + 1)
        if len(out) > limit or machine.unconsumed_tail:
            raise ValueError(f"Uncompressed sitemap exceeds {limit} bytes")
        return out.decode("utf-8", "replace")
    if len(body) > limit:
        raise ValueError(f"Uncompressed sitemap exceeds {limit} bytes")
    return body.decode("utf-8", "replace")


def fetch_text(url: str, get, resolve) -> str:
    """Text of a URL.  ``get(url)`` gives (status, headers in lower case, chunks); redirects are followed here, each checked."""
    from urllib.parse import urlsplit

    here = url
    for _ in range(MAX_REDIRECTS + 1):
        parts = urlsplit(here)
        if parts.scheme not in ("http", "https") or parts.username or parts.password or not resolves_to_public(parts.hostname or "", resolve):
            raise ValueError(f"Blocked unsafe sitemap URL: {here}")
        status, headers, chunks = get(here)
        if 300 <= status < 400:
            if not headers.get("location"):
                raise ValueError(f"Redirect missing Location: {here}")
            here = urljoin(here, headers["location"])
            continue
        if not 200 <= status < 300:
            raise ValueError(f"Fetch failed {status}: {here}")
        kind = headers.get("content-type", "").lower()
        if kind and not any(k in kind for k in ACCEPTED):
            raise ValueError(f"Unexpected sitemap content type {kind}: {here}")
        declared = headers.get("content-length", "")
        return inflated(capped(chunks, declared=int(declared) if declared.isdigit() else None))
    raise ValueError(f"Too many sitemap redirects: {url}")


def fetched(frontier: DataFrame, get, resolve, url: str = "sitemap_url", into: str = "xml") -> DataFrame:
    """The frontier's URLs with their texts, fetched by the executors."""

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([fetch_text(u, get, resolve) for u in names], pa.string())], names=[url, into])

    return frontier.select(url).mapInArrow(run, f"{url} string, {into} string")
