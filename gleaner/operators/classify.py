"""Topic classification: taxonomy, pre-filters, the model's replies, matches and the text export.

The model itself is a callable that the caller injects.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from gleaner.functions import dates, text

#: Keywords by category; the order of categories decides where a keyword belongs that two of them have.
TAXONOMY = {
    "social": "Unionization;Living wage;Level of education;Health care;Pension plans;Birthrates;Life expectancies;Regional shifts in population;Age distribution of population;Growth rate of population;Rate of family formation;Consumer activism;Career expectations;Lifestyle changes",
    "technology": "Computer hacking activity;Telecommunication infrastructure;Internet availability;Productivity improvements through automation;Transfer from lab to marketplace;New developments in technology;New products;Patent protection;Focus of technological efforts;Total industry spending for R&D;Total government spending for R&D",
    "economic": "Global financial system;Currency markets;Disposable and discretionary income;Energy availability and cost;Energy alternatives;Devaluation/revaluation;Wage/price controls;Unemployment levels;Inflation rates;Money supply;Interest rates;GDP trends",
    "environmental": "Recycling;Triple bottom line;Reuse;Pollution impacts;Non-governmental organizations;Global warming impacts;Environmental protection laws",
    "political": "Foreign sweatshops;Outsourcing regulation;Stability of government;Laws on hiring and promotion;Attitudes toward foreign companies;Foreign trade regulations;Special incentives;Tax laws;Immigration laws;Global warming legislation;Environmental protection laws;Antitrust regulations",
}
TAXONOMY = {k: v.split(";") for k, v in TAXONOMY.items()}
FOLDS = [("social", "social"), ("tech", "technology"), ("economic", "economic"), ("environment", "environmental"), ("politic", "political")]
STOP_WORDS = frozenset("rates rate level total an a with through from to in for the and of".split())
ERROR_TITLES = "bad gateway|service unavailable|forbidden|access denied|not found|page not found|404".split("|")
#: Those with punctuation never match, since punctuation is gone by then; they are kept as they are.
ERROR_TEXTS = "bad gateway|service unavailable|403 forbidden|access denied|this page could not be found|sorry, the page you are looking for does not exist|the page you are looking for could not be found|the page you requested could not be found|404 page not found|404 - page not found".split("|")
GENERAL = "General STEEP relevance"
EMPTY_EXPORT = "No relevant knowledge-base articles found."


def keyword_words(keyword: str) -> list[str]:
    """Words of a keyword that stand for it: four letters or more and no stop word."""
    plain = re.sub(r"r\s*&\s*d", "research and development", keyword.lower()).replace("&", " and ")
    return [w for w in re.sub(r"[\W_]+", " ", plain).split() if len(w) >= 4 and w not in STOP_WORDS]


def tokens(*categories: str) -> list[str]:
    """Distinct keyword words of these categories, of all where none is named."""
    return list(dict.fromkeys(w for c in categories or TAXONOMY for k in TAXONOMY[c] for w in keyword_words(k)))


def category(c: Column) -> Column:
    """A source's category folded into one of the five, or null."""
    low, out = F.lower(c), F.when(F.lit(False), F.lit(None).cast("string"))
    for part, name in FOLDS:
        out = out.when(low.contains(part), name)
    return out


def scopes(c: Column, own_only: bool = False) -> Column:
    """The categories an article is held against: all five, or its own if known and ``own_only``."""
    every = F.array(*[F.lit(k) for k in TAXONOMY])
    return F.when(category(c).isNotNull(), F.array(category(c))).otherwise(every) if own_only else every


def prefilter(title: Column, body: Column, *categories: str) -> Column:
    """Whether any keyword word occurs in the normalised title and text."""
    form = text.keyword_form(F.concat_ws("\n", title, body))
    return form.rlike("|".join(tokens(*categories)))


def error_page(title: Column, body: Column) -> Column:
    """A short title with an error's words, or an error's phrase in the first 1,000 characters."""
    t, start = text.keyword_form(F.coalesce(title, F.lit(""))), F.substring(text.keyword_form(F.coalesce(body, F.lit(""))), 1, 1000)
    return ((F.length(t) <= 80) & t.rlike("|".join(ERROR_TITLES))) | start.rlike("|".join(ERROR_TEXTS))


SHAPE = '{"isNewsArticle": true or false, "isRelevant": true or false, "matchedKeywords": [strings], "reason": string}'
ADVICE = (
    "Say whether the page below is an article (news, report, analysis, research or blog post) rather than a home, listing, search, login, consent or error page.",
    "Say whether it tells something of use about society, technology, the economy, the environment or politics. When in doubt, say no.",
    "Name the keywords of the lists that fit it best, in their own spelling; a keyword's words need not occur in the text. Name none that isn't listed, and none for a page of no use.",
)


def request(article: dict, model: str, own_only: bool = False, characters: int = 7000) -> dict:
    """The body of a call to a local model: JSON mode, little randomness, a context of 8,192 tokens.

    ``article`` has title, text, url, source_name, source_category and published_date; its text
    is cut to what the context holds.
    """
    low = (article.get("source_category") or "").lower()
    own = next((name for part, name in FOLDS if part in low), None)
    chosen = {own: TAXONOMY[own]} if own_only and own else TAXONOMY
    lists = "\n\n".join(f"{name}:\n" + "\n".join(f"- {w}" for w in words) for name, words in chosen.items())
    fields = [("Source", "source_name", ""), ("Category", "source_category", "unknown"), ("Address", "url", ""), ("Title", "title", ""), ("Date", "published_date", "unknown")]
    about = "\n".join(f"{label}: {article.get(key) or default}" for label, key, default in fields)
    prompt = "\n\n".join([*ADVICE, f"Keywords by category\n\n{lists}", about, (article.get("text") or "")[:characters], f"Answer with JSON alone: {SHAPE}"])
    return {"model": model, "prompt": prompt, "stream": False, "format": "json", "options": {"temperature": 0.1, "num_ctx": 8192}}


REPLY = pa.struct([("is_news_article", pa.bool_()), ("is_relevant", pa.bool_()), ("matched_keywords", pa.list_(pa.string())), ("reason", pa.string())])


@arrow_udf(from_arrow_type(REPLY))
def parsed_reply(column: pa.Array) -> pa.Array:
    """A model's reply: its JSON, else the JSON between the outermost braces, else a reason why not."""

    def normal(v):
        v = v if isinstance(v, dict) else {}
        news = v.get("isNewsArticle") is True
        relevant = news and v.get("isRelevant") is True
        words, reason = v.get("matchedKeywords"), v.get("reason")
        return {"is_news_article": news, "is_relevant": relevant, "matched_keywords": [w for w in words if isinstance(w, str)] if relevant and isinstance(words, list) else [], "reason": reason if isinstance(reason, str) else ""}

    def read(s):
        try:
            return normal(json.loads(s or ""))
        except ValueError:
            m = re.search(r"\{.*\}", s or "", re.S)
            if not m:
                return normal({}) | {"reason": "LLM did not return JSON."}
            try:
                return normal(json.loads(m[0]))
            except ValueError:
                return normal({}) | {"reason": "Failed to parse JSON from LLM response."}

    return pa.array([read(s) for s in column.to_pylist()], REPLY)


def unclassified(articles: DataFrame, classifications: DataFrame, model: str, limit: int | None = None, source_like: str | None = None) -> DataFrame:
    """Articles that this model hasn't classified, newest first, unknown dates last."""
    done = classifications.where(F.col("model") == model).select(F.col("article_id").alias("_done")).distinct()
    left = articles if source_like is None else articles.where(F.col("source_name").ilike(f"%{source_like}%"))
    left = left.join(done, left["id"] == done["_done"], "left_anti").orderBy(F.desc_nulls_last("published_date"), "id")
    return left if limit is None else left.limit(limit)


def outcome(articles: DataFrame, low: Column, as_of: Column, use_prefilter: bool = False, allow_unknown: bool = False, use_error_page: bool = True) -> DataFrame:
    """Adds ``outcome``: error_page, date, keyword or model, the cheapest test first."""
    out = F.when(error_page(F.col("title"), F.col("text")) if use_error_page else F.lit(False), "error_page").when(~dates.date_accepted(F.col("published_date"), low, as_of, allow_unknown=allow_unknown), "date")
    if use_prefilter:
        out = out.when(~prefilter(F.col("title"), F.col("text")), "keyword")
    return articles.withColumn("outcome", out.otherwise("model"))


def classified(articles: DataFrame, ask, model: str, characters: int = 7000) -> DataFrame:
    """(article_id, is_news_article, is_relevant, matched_keywords, reason, model) from ``ask(title, text)``.

    A call that raises leaves its article out, to be asked about again.
    """

    def call(batches):
        for batch in batches:
            ids, titles, texts = (c.to_pylist() for c in batch.columns)
            found = []
            for i, t, x in zip(ids, titles, texts):
                try:
                    found.append((i, ask(t, x)))
                except Exception:  # noqa: BLE001 - the model is anybody's code
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([r for _, r in found], pa.string())], names=["article_id", "reply"])

    asked = articles.select(F.col("id").cast("long"), "title", F.substring("text", 1, characters)).mapInArrow(call, "article_id long, reply string")
    read = asked.withColumn("r", parsed_reply("reply"))
    return read.select("article_id", "r.*", F.lit(model).alias("model"))


def keyword_categories(spark) -> DataFrame:
    """(keyword, category), each keyword under its first category."""
    first: dict[str, str] = {}
    for name, words in TAXONOMY.items():
        for w in words:
            first.setdefault(w, name)
    return spark.createDataFrame(list(first.items()), "keyword string, category string")


def matches(results: DataFrame) -> DataFrame:
    """(article_id, category, keyword, reason, model) of relevant results; unknown keywords are dropped."""
    exploded = results.where("is_news_article AND is_relevant").select("article_id", F.explode("matched_keywords").alias("keyword"), "reason", "model")
    return exploded.join(F.broadcast(keyword_categories(results.sparkSession)), "keyword").dropDuplicates(["article_id", "category", "keyword"]).select("article_id", "category", "keyword", "reason", "model")


def knowledge(classifications: DataFrame, articles: DataFrame, found: DataFrame, model: str, low: Column, high: Column) -> DataFrame:
    """One row for each relevant article and category: keywords joined in order, and a reason."""
    good = classifications.where((F.col("model") == model) & F.col("is_news_article") & F.col("is_relevant")).select("article_id", F.col("reason").alias("_reason"))
    dated = articles.withColumn("_at", dates.parse_lax(F.col("published_date"))).where((F.col("_at") >= low) & (F.col("_at") <= high))
    joined = good.join(dated, good["article_id"] == dated["id"]).join(found.select(F.col("article_id").alias("_of"), "category", "keyword", "reason"), F.col("id") == F.col("_of"), "left")
    key = F.coalesce("category", "source_category", F.lit("general")).alias("category")
    grouped = joined.groupBy("id", key).agg(
        F.first("source_name").alias("source_name"), F.first("title").alias("title"), F.first("published_date").alias("published_date"), F.first("url").alias("url"),
        F.coalesce(F.nullif(F.array_join(F.sort_array(F.collect_set("keyword")), ","), F.lit("")), F.lit(GENERAL)).alias("matched_keywords"),
        F.coalesce(F.max("reason"), F.first("_reason")).alias("reason"), F.first("text").alias("text"),
    )
    return grouped.orderBy(F.desc("published_date"), "id", "category")


def export_blocks(rows: DataFrame) -> DataFrame:
    """(value): one block of text for each row, or the one line that there is nothing."""
    bar = "=" * 30
    fields = [("SOURCE", "source_name"), ("CATEGORY", "category"), ("MATCHED KEYWORDS", "matched_keywords"), ("TITLE", "title"), ("DATE", "published_date"), ("LINK", "url"), ("LLM_REASON", "reason")]
    parts = [F.lit(bar), *[F.concat(F.lit(f"{k}: "), F.coalesce(F.col(c), F.lit("Unknown" if k == "DATE" else ""))) for k, c in fields], F.lit(bar), F.lit(""), F.lit("TEXT:"), F.coalesce("text", F.lit("")), F.lit(""), F.lit("-" * 30), F.lit("")]
    blocks = rows.select(F.concat_ws("\n", *parts).alias("value"))
    nothing = rows.sparkSession.range(1).select(F.lit(EMPTY_EXPORT).alias("value")).join(rows.limit(1).select(F.lit(1)), F.lit(True), "left_anti")
    return blocks.unionByName(nothing)
