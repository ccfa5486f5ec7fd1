"""The registry of sources: reading, validation, stable keys."""

from __future__ import annotations

import hashlib
import json
import os
import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.addresses import resolves_to_public
from gleaner.operators.queue import stable_json

LISTS = ("startUrls", "dailySearchUrlTemplates", "searchUrlTemplates", "archiveUrlTemplates", "sitemapUrls")
TEXTS = ("baseUrl", "homepageUrl", "feedUrl")
SCHEMA = "name string, category string, " + ", ".join(f"{c} string" for c in TEXTS) + ", " + ", ".join(f"{c} array<string>" for c in LISTS) + ", minCoverageMonths int"
CATEGORIES = ("general", "social", "technology", "economic", "environmental", "political")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All sources of a JSON array, with their place in it."""
    found = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    return found.withColumn("position", F.row_number().over(W.orderBy(F.monotonically_increasing_id())) - 1)


def select(sources: DataFrame, name: str | None = None, index: int = 0) -> DataFrame:
    """The first source whose name contains this, or the one at an index; an error if none."""
    if name:
        one = sources.where(F.lower("name").contains(name.lower())).orderBy("position").limit(1)
    else:
        one = sources.where(F.col("position") == index)
    if one.isEmpty():
        raise ValueError(f"no source matches {name or index}")
    return one


def one(environment: dict | None = None, argument: str | None = None) -> dict:
    """A source from SOURCE_JSON, else an inline object, else a file."""
    inline = (os.environ if environment is None else environment).get("SOURCE_JSON")
    if inline:
        return json.loads(inline)
    if not argument:
        raise ValueError("a source is needed: SOURCE_JSON, an object or a file")
    if argument.lstrip().startswith("{"):
        return json.loads(argument)
    with open(argument, encoding="utf-8") as f:
        return json.load(f)


def serialized(source: dict) -> str:
    """Stable JSON: members in key order, absent ones (None) left out at every level."""

    def present(v):
        if isinstance(v, dict):
            return {k: present(x) for k, x in v.items() if x is not None}
        return [present(x) for x in v] if isinstance(v, list) else v

    return stable_json(present(source))


def slug(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", name.strip().lower()).strip("-")[:48] or "source"


def key(source: dict) -> str:
    """Slug of the name and 24 digits of the configuration's SHA-256."""
    return f"{slug(source['name'])}:{hashlib.sha256(serialized(source).encode()).hexdigest()[:24]}"


def slug_column(name: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "-"), r"^-+|-+\z", "")
    return F.when(plain == "", "source").otherwise(F.substring(plain, 1, 48))


def validate(source: dict) -> dict:
    """The source, or a ValueError that says what is wrong with it."""
    if not isinstance(source, dict):
        raise ValueError("Source config must be an object")
    name = source.get("name")
    if not isinstance(name, str) or not name.strip():
        raise ValueError("Source name is required")
    if len(name.strip()) > 200:
        raise ValueError("Source name cannot exceed 200 characters")
    for c in LISTS:
        values = source.get(c)
        if values is None:
            continue
        if not isinstance(values, list):
            raise ValueError(f"{c} must be an array")
        if len(values) > 100:
            raise ValueError(f"{c} cannot contain more than 100 entries")
        if not all(isinstance(v, str) and v.strip() for v in values):
            raise ValueError(f"{c} must contain non-empty URL strings")
    for c in TEXTS:
        value = source.get(c)
        if value is not None and not (isinstance(value, str) and value.strip()):
            raise ValueError(f"{c} must be a non-empty URL string")
    category = source.get("category")
    if category is not None and not isinstance(category, str):
        raise ValueError("Source category must be a string")
    if category and category.lower() not in CATEGORIES:
        raise ValueError(f"Unsupported source category: {category}")
    months = source.get("minCoverageMonths")
    if months is not None and not (isinstance(months, int) and 1 <= months <= 13):
        raise ValueError("minCoverageMonths must be an integer between 1 and 13")
    entries = [u for u in (source.get("baseUrl"), source.get("homepageUrl"), *(source.get("startUrls") or []), *(source.get("sitemapUrls") or [])) if u]
    if not entries:
        raise ValueError(f"Source {name} needs a baseUrl, homepageUrl, startUrl, or sitemapUrl")
    templates = [t for c in ("archiveUrlTemplates", "dailySearchUrlTemplates", "searchUrlTemplates") for t in source.get(c) or []]
    for raw in [*entries, *([source["feedUrl"]] if source.get("feedUrl") else []), *templates]:
        _check_url(raw)
    return source


def _check_url(raw: str) -> None:
    filled = re.sub(r"\{(yyyy|yy|mm|m|dd|d|date)\}", lambda m: {"yyyy": "2025", "yy": "25", "mm": "01", "m": "1", "dd": "15", "d": "15", "date": "2025-01-15"}[m[1]], raw)
    parts = urlsplit(filled)
    if parts.scheme not in ("http", "https"):
        raise ValueError(f"Source URLs must use HTTP(S): {raw}")
    if parts.username or parts.password:
        raise ValueError(f"Source URLs cannot contain credentials: {raw}")
    if not parts.hostname or not resolves_to_public(parts.hostname, lambda h: ["93.184.216.34"]):
        raise ValueError(f"Private/local source hosts are not allowed: {parts.hostname}")


def number(value, name: str, fallback: int | None = None) -> int:
    """A positive integer setting, the fallback where it is unset."""
    if value in (None, "") and fallback is not None:
        return fallback
    try:
        n = int(str(value))
    except ValueError:
        n = 0
    if n < 1:
        raise ValueError(f"{name} must be a positive integer")
    return n


def rate(value, name: str) -> float:
    """A setting greater than 0 and at most 1."""
    r = float(value)
    if not 0 < r <= 1:
        raise ValueError(f"{name} must be greater than 0 and at most 1")
    return r
