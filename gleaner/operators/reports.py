"""Coverage reports, the completion gate, audits and statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import dates

FAILURES = ("INCOMPLETE_URLS", "INSUFFICIENT_COVERAGE_MONTHS", "INSUFFICIENT_ACCEPTED_ARTICLES", "LOW_ACCEPTANCE_RATE", "UNKNOWN_ACCEPTED_DATES", "INVALID_ACCEPTED_DATES", "ACCEPTED_DATES_TOO_OLD", "ACCEPTED_DATES_IN_FUTURE")


def counted(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    """Rows by a column, most first, ties by its value."""
    return df.groupBy(by).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc(by))


def totals(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and how many meet each condition."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


def accepted_months(accepted: DataFrame, at: Column | None = None) -> DataFrame:
    """(month, n) over distinct (id, published); a null month stands for unreadable dates."""
    distinct = accepted.select("id", (F.col("published_at") if at is None else at).alias("at")).distinct()
    return distinct.groupBy(F.date_format("at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def observed_months(accepted: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """Months with accepted articles inside the window."""
    return accepted_months(accepted.where(dates.in_window(F.col("published_at"), as_of, days))).where("month IS NOT NULL")


def expected_months(spark, as_of: Column, days: int = 365) -> DataFrame:
    return spark.range(1).select(F.explode(dates.months(as_of, days)).alias("m")).select(F.date_format("m", "yyyy-MM").alias("month"))


def missing_months(observed: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    return expected_months(observed.sparkSession, as_of, days).join(observed, "month", "left_anti")


def missing_months_by(articles: DataFrame, by: list[str], as_of: Column, days: int = 365) -> DataFrame:
    """(by..., month): the expected months in which a group has no article inside the window."""
    groups = articles.select(*by).distinct().withColumn("_m", F.explode(dates.months(as_of, days)))
    expected = groups.select(*by, F.date_format("_m", "yyyy-MM").alias("month"))
    seen = articles.where(dates.in_window(F.col("published_at"), as_of, days)).select(*by, F.date_format("published_at", "yyyy-MM").alias("month")).distinct()
    return expected.join(seen, [*by, "month"], "left_anti")


def date_profile(accepted: DataFrame, as_of: Column, days: int = 365, minutes: int = 15) -> DataFrame:
    """One row: count, least and greatest date string, and how many are unknown, invalid, too old or ahead.

    Bridge rows count, not articles.
    """
    low, high = dates.window_bounds(as_of, days, minutes)
    at, raw = F.col("published_at"), F.col("published_date")
    return accepted.agg(
        F.count("*").alias("count"), F.min(raw).alias("min_date"), F.max(raw).alias("max_date"), F.count_if(raw.isNull()).alias("unknown_dates"),
        F.count_if(raw.isNotNull() & at.isNull()).alias("invalid_dates"), F.count_if(at < low).alias("too_old"), F.count_if(at > high).alias("future_dates"),
    )


@dataclass(frozen=True)
class Policy:
    months: int = 12
    articles: int = 10
    rate: float = 0.05

    def __post_init__(self):
        if not (isinstance(self.months, int) and 1 <= self.months <= 13):
            raise ValueError("minimumCoverageMonths must be an integer between 1 and 13")
        if not (isinstance(self.articles, int) and self.articles >= 1):
            raise ValueError("minimumAcceptedArticles must be a positive integer")
        if not 0 < self.rate <= 1:
            raise ValueError("minimumAcceptanceRate must be greater than 0 and at most 1")


def completion(statuses: DataFrame, accepted: DataFrame, as_of: Column, policy: Policy = Policy()) -> DataFrame:
    """One row: whether a job may complete, and the codes of what stands against it, in order.

    ``statuses`` are the job's URL rows, ``accepted`` its accepted bridge rows with their articles.
    """
    counts = statuses.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("crawled", "skipped", "pending", "failed")])
    months = observed_months(accepted, as_of).agg(F.count("*").alias("months"))
    row = counts.crossJoin(months).crossJoin(date_profile(accepted, as_of))
    reviewed = F.col("crawled") + F.col("skipped")
    row = row.withColumn("acceptance_rate", F.coalesce(F.try_divide("crawled", reviewed), F.lit(0.0)))
    tests = [
        (F.col("pending") > 0) | (F.col("failed") > 0), F.col("months") < policy.months, F.col("count") < policy.articles, F.col("acceptance_rate") < policy.rate,
        F.col("unknown_dates") > 0, F.col("invalid_dates") > 0, F.col("too_old") > 0, F.col("future_dates") > 0,
    ]
    codes = F.array_compact(F.array(*[F.when(t, c) for t, c in zip(tests, FAILURES)]))
    row = row.withColumn("failure_codes", codes)
    return row.select(
        (F.size("failure_codes") == 0).alias("passed"), "failure_codes", F.col("count").alias("accepted_articles"), F.col("crawled").alias("accepted_urls"), F.col("skipped").alias("rejected_urls"),
        F.col("pending").alias("pending_urls"), F.col("failed").alias("failed_urls"), reviewed.alias("reviewed_urls"), "acceptance_rate",
    )


def duplicate_extras(articles: DataFrame) -> DataFrame:
    """One row: articles beyond the first of each content hash."""
    groups = articles.groupBy("content_hash").agg(F.count("*").alias("copies")).where("copies > 1")
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("exact_duplicate_extras"))


def duplicate_titles(articles: DataFrame, n: int = 25) -> DataFrame:
    """The commonest titles that occur more than once, case and outer spaces aside."""
    groups = articles.groupBy(F.lower(F.trim("title")).alias("key")).agg(F.min("title").alias("title"), F.count("*").alias("copies"))
    return groups.where("copies > 1").orderBy(F.desc("copies"), "title").limit(n).select("title", "copies")


def merged_stats(batches: DataFrame) -> DataFrame:
    """Batch counters added up; pending_after is that of the last batch."""
    sums = [F.sum(c).alias(c) for c in ("selected", "crawled", "skipped", "failed", "duplicates") if c in batches.columns]
    return batches.agg(*sums, F.max_by("pending_after", "batch").alias("pending_after"))


def classification_stats(classifications: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: classified, relevant, matches and matched articles."""
    a = classifications.agg(F.count("*").alias("classified"), F.count_if(F.col("is_news_article") & F.col("is_relevant")).alias("relevant"))
    return a.crossJoin(matches.agg(F.count("*").alias("matches"), F.count_distinct("article_id").alias("matched_articles")))
