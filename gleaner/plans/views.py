"""The supplied tables seen as the engine's tables, in Spark and in SQL alike.

Documents are articles (dated by the order of their number), orders are jobs,
customers sources, and line items the bridge between jobs and URLs (parts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "1998-12-31 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores where the scan has fewer splits than there are cores (a small table in one row group).

    A large table has more splits and isn't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, url, source_name, source_category, title, published_date, published_at, text)."""
    docs, orders = spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    at = F.col("o_orderdate").cast("timestamp")
    return docs.join(orders, F.col("doc_id") == F.col("o_orderkey")).select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("source_name"),
        F.col("lang").alias("source_category"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_date"),
        at.alias("published_at"),
        "text",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source_id, status, enqueued_at)."""
    status = F.when(F.col("o_orderstatus") == "P", "queued").when(F.col("o_orderstatus") == "O", "running").otherwise("completed")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("source_id"), status.alias("status"), F.col("o_orderdate").cast("timestamp").alias("enqueued_at"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source_key, name, category, config, enabled)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.concat(F.lit("key:"), F.col("c_custkey").cast("string")).alias("source_key"), F.col("c_name").alias("name"), F.lower("c_mktsegment").alias("category"), F.lit("{}").alias("config"), (F.col("c_acctbal") > 0).alias("enabled"))


SQL_ARTICLES = f"""articles AS (SELECT d.doc_id AS id, 'https://' || d.source || '.example.com/' || d.lang || '/' || d.doc_id AS url, d.source AS source_name, d.lang AS source_category,
  split_part(d.text, chr(10), 1) AS title, strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published_date, o.o_orderdate AS published_at, d.text
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey)"""
SQL_JOBS = "jobs AS (SELECT o_orderkey AS id, o_custkey AS source_id, CASE o_orderstatus WHEN 'P' THEN 'queued' WHEN 'O' THEN 'running' ELSE 'completed' END AS status, o_orderdate AS enqueued_at FROM orders)"
SQL_SOURCES = "sources AS (SELECT c_custkey AS id, 'key:' || c_custkey AS source_key, c_name AS name, lower(c_mktsegment) AS category, c_acctbal > 0 AS enabled FROM customer)"

LOW, HIGH = f"TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY", f"TIMESTAMP '{AS_OF}' + INTERVAL 15 MINUTE"
IN_WINDOW = f"(published_at >= {LOW} AND published_at <= {HIGH})"


def sql_comparable(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[.!:]+$', ''))"


def sql_cleaned(x: str) -> str:
    """Labels and adjacent repeats of lines taken out; the supplied texts are in normal form already."""
    from gleaner.functions.text import BOILERPLATE

    labels = ", ".join(f"'{b}'" for b in BOILERPLATE)
    lines = f"list_filter(string_split({x}, chr(10)), lambda l: {sql_comparable('l')} NOT IN ({labels}))"
    kept = f"list_filter({lines}, lambda l, i: i = 1 OR {sql_comparable('l')} = '' OR {sql_comparable('l')} <> {sql_comparable(f'({lines})[i - 1]')})"
    return f"trim(array_to_string({kept}, chr(10)), ' ' || chr(10))"


TOKENS = r"[\p{L}\p{N}]+"


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKENS}')"


def sql_repeated(x: str) -> str:
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: trim(regexp_replace(lower(l), '\\s+', ' ', 'g'))), lambda l: length(l) >= 20)"
    size = lambda a: f"coalesce(list_sum(list_transform({a}, lambda l: length(l))), 0)"
    return f"CASE WHEN len({lines}) < 3 THEN 0.0 ELSE ({size(lines)} - {size(f'list_distinct({lines})')})::DOUBLE / {size(lines)} END"


def sql_metrics(x: str) -> dict[str, str]:
    tokens = sql_tokens(x)
    ends = "[.!?。！？](?:[\\s \"''”’)]|$)"
    return {
        "character_count": f"length({x})::INTEGER",
        "word_count": f"len({tokens})::INTEGER",
        "sentence_count": f"len(regexp_extract_all({x}, '{ends}'))::INTEGER",
        "letter_ratio": f"CASE WHEN length({x}) > 0 THEN len(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]'))::DOUBLE / length({x}) ELSE 0.0 END",
        "repeated_line_ratio": sql_repeated(x),
        "token_diversity": f"CASE WHEN len({tokens}) > 0 THEN len(list_distinct({tokens}))::DOUBLE / len({tokens}) ELSE 0.0 END",
    }


def sql_content_form(x: str) -> str:
    plain = f"translate(lower({x}), '‘’‚‛“”„‟‐‑‒–—―', '''''''''\"\"\"\"------')"
    return f"trim(regexp_replace(regexp_replace(regexp_replace({plain}, '<[^>]+>', ' ', 'g'), '[\\p{{P}}\\p{{S}}]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_signals(x: str, phrases: list[str]) -> str:
    quoted = [p.replace("'", "''") for p in phrases]
    return "(" + " + ".join(f"regexp_matches({x}, '\\b{p}\\b')::INTEGER" for p in quoted) + ")"


TAGS = "</?(?:header|footer|nav|link|meta|style|script|span|div|article|main|body|head|html)\\b[^>]*>"


def sql_html_shell(x: str) -> str:
    tags = f"regexp_extract_all(lower({x}), '{TAGS}')"
    many = f"(len({tags}) >= 8 AND length(array_to_string({tags}, ''))::DOUBLE / greatest(length({x}), 1) >= 0.12)"
    return f"(contains({x}, '<') AND (regexp_matches(lower({x}), '^\\s*<(?:!doctype\\s+html|(?:html|head|body)[\\s>])') OR {many}))"


def sql_code_shell(x: str) -> str:
    """Script or style sheet, judged by the first 20,000 characters, by the counts of both languages' signs."""
    s = f"substring({x}, 1, 20000)"
    js = f"len(regexp_extract_all({s}, '(?i)(?:\\b(?:var|let|const|function)\\s+[a-z_$][\\w$]*\\s*[=(]|\\b(?:__NEXT_DATA__|webpackJsonp|module\\.exports|document|window)\\b|=>\\s*[({{]|[}};]\\s*[}};])'))"
    css = f"len(regexp_extract_all({s}, '(?im)(?:^|\\n)\\s*(?:@(?:import|keyframes|font-face|media)\\b|[a-z.#][^\\n{{}}]{{0,120}}\\{{\\s*(?:[a-z-]+\\s*:\\s*[^;}}]+;)+)'))"
    marks = f"len(regexp_extract_all({s}, '[;{{}}]'))"
    lines = f"string_split({s}, chr(10))"
    filled = f"len(list_filter({lines}, lambda l: regexp_matches(l, '\\S')))"
    code = f"len(list_filter({lines}, lambda l: regexp_matches(l, '(?i)(?:\\b(?:function|var|let|const)\\b|=>|[#.][\\w-]+\\s*\\{{|@media\\b|[;{{}}]\\s*\\z)')))"
    ratio, density = f"({code}::DOUBLE / greatest({filled}, 1))", f"({marks}::DOUBLE / greatest(length({s}), 1))"
    return f"(({js} >= 3 AND ({ratio} >= 0.35 OR {density} >= 0.012)) OR ({css} >= 2 AND {ratio} >= 0.3) OR ({js} + {css} >= 2 AND {marks} >= 12 AND {ratio} >= 0.25))"


def sql_codes() -> str:
    """CTEs ``gated``: articles with the ordered codes of the gate, by its default limits."""
    from gleaner.functions import quality as Q

    metrics = ", ".join(f"{v} AS {k}" for k, v in sql_metrics("clean").items())
    latin = "len(regexp_extract_all(clean, '[A-Za-z]'))"
    letters = "len(regexp_extract_all(clean, '\\p{L}'))"
    rules = {
        "PUBLISHED_DATE_TOO_OLD": f"published_at < {LOW}",
        "PUBLISHED_DATE_IN_FUTURE": f"published_at > {HIGH}",
        "MISSING_TITLE": "trim(title) = ''",
        "GENERIC_OR_ERROR_TITLE": "length(title) > 300 OR regexp_matches(lower(title), '\\b(?:404|403|500)\\b') OR regexp_matches(lower(trim(title)), '^(?:archives?|articles?|blog|home|homepage|latest|latest news|news|news archive|posts?|untitled)$')",
        "HTML_SHELL": sql_html_shell("text"),
        "JAVASCRIPT_OR_CSS_SHELL": sql_code_shell("text"),
        "COOKIE_OR_CONSENT_NOISE": f"{sql_signals('lower(text)', Q.COOKIE)} >= 2 OR ({sql_signals('lower(text)', Q.COOKIE)} >= 1 AND length(text) < 1500)",
        "PAYWALL_OR_LOGIN_WALL": f"{sql_signals('lower(text)', Q.PAYWALL)} >= 1",
        "BOT_CHALLENGE_OR_ERROR_PAGE": f"{sql_signals('substring(lower(text), 1, 2500)', Q.CHALLENGE)} >= 1 OR regexp_matches(substring(lower(text), 1, 2500), '(?s)\\battention required\\b.*\\bcloudflare\\b|\\bcf-chl-')",
        "NAVIGATION_NOISE": f"{sql_signals('lower(text)', Q.NAVIGATION)} >= 3 OR ({sql_signals('lower(text)', Q.NAVIGATION)} >= 2 AND (length(text) < 1500 OR sentence_count < 4))",
        "CONTENT_TOO_SHORT": "character_count < 500",
        "NON_PROSE_CONTENT": f"clean = '' OR letter_ratio < 0.52 OR ({letters} > 0 AND {latin}::DOUBLE / {letters} >= 0.7 AND (word_count < 80 OR (sentence_count < 3 AND character_count < 2000)))",
        "REPETITIVE_CONTENT": "repeated_line_ratio >= 0.35 OR (word_count >= 80 AND token_diversity < 0.18)",
    }
    listed = ", ".join(f"CASE WHEN {r} THEN '{c}' END" for c, r in rules.items())
    deduct = "CASE c " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in Q.DEDUCTIONS.items()) + " END"
    return f"""{SQL_ARTICLES},
cleaned AS (SELECT *, {sql_cleaned('text')} AS clean FROM articles),
measured AS (SELECT *, {metrics} FROM cleaned),
coded AS (SELECT *, list_filter([{listed}], lambda c: c IS NOT NULL) AS codes FROM measured),
gated AS (SELECT *, len(codes) = 0 AS accepted, codes[1] AS reason_code, greatest(0, 100 - coalesce(list_sum(list_transform(codes, lambda c: {deduct})), 0))::INTEGER AS quality_score FROM coded)"""
