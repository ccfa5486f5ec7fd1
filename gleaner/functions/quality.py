"""The deterministic quality gate: predicates, ordered rejection codes, score.

Patterns use look-around instead of ``\\b``, which Java takes to be Unicode aware.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dates, text, urls

#: Codes in the order they are reported, with what each takes off the score.
DEDUCTIONS = dict(
    INVALID_URL=30, MISSING_PUBLISHED_DATE=35, INVALID_PUBLISHED_DATE=35, PUBLISHED_DATE_TOO_OLD=35, PUBLISHED_DATE_IN_FUTURE=35, MISSING_TITLE=25, GENERIC_OR_ERROR_TITLE=35, HTML_SHELL=55,
    JAVASCRIPT_OR_CSS_SHELL=55, COOKIE_OR_CONSENT_NOISE=35, PAYWALL_OR_LOGIN_WALL=40, BOT_CHALLENGE_OR_ERROR_PAGE=60, NAVIGATION_NOISE=30, CONTENT_TOO_SHORT=35, NON_PROSE_CONTENT=30, REPETITIVE_CONTENT=35,
)

COOKIE = ["we (?:value|use) cookies", "accept all cookies", "manage (?:consent|cookie) (?:settings|preferences)", "cookie (?:consent manager|settings|preferences)", "(?:decline|reject) (?:all )?(?:optional )?cookies", "consent preferences"]
PAYWALL = [
    r"you have \d+ (?:free )?articles? remaining", "unlock (?:the full|this) article", "register to (?:read|continue)", "(?:log|sign) in to (?:read|continue)", "start your free trial",
    "you (?:have )?reached your (?:free )?(?:article )?limit", "you['’]ve read your last free article", "already (?:a )?subscriber", "subscription (?:is )?required", "subscribe to (?:unlock|read|continue)",
]
CHALLENGE = ["(?:bad gateway|service unavailable|404 page not found|403 forbidden)", "the page you requested could not be found", "captcha", "enable javascript and cookies to continue", "verify (?:that )?you are (?:a )?human", "checking (?:your )?browser"]
NAVIGATION = ["follow us on", "(?:close|open) menu", "(?:primary|main) navigation", "terms (?:of (?:use|service)|and conditions)", "privacy policy", r"home\s+(?:contact|news|about)\s+(?:privacy|contact|news|about)", "skip to (?:main )?content"]

_BEFORE, _AFTER = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


@dataclass(frozen=True)
class Options:
    """Limits of the gate; ``CRAWL`` has those of the crawler."""

    days_back: int = 365
    tolerance_minutes: int = 15
    min_characters: int = 500
    min_words: int = 80


CRAWL = Options(min_characters=700, min_words=100)


def _has(c: Column, parts: str) -> Column:
    some = F.lit(False)
    for part in parts.split("|"):
        some = some | F.contains(c, F.lit(part))
    return some


def _always(phrase: str) -> str:
    """The longest run of characters that every match of the phrase holds, which may be none."""
    while (plain := re.sub(r"\(\?:[^()]*\)\??", "\n", phrase)) != phrase:
        phrase = plain
    return max(re.split(r"\n|\[[^\]]*\]|\\.[+?]?|.\?", phrase), key=len)


def _signals(c: Column, phrases: list[str], stems: str) -> Column:
    """How many of the phrases occur, each at word bounds.  Every phrase holds one of the stems, which are looked for first, then the phrase's own words."""
    found = [(F.contains(c, F.lit(_always(p))) & c.rlike(_BEFORE + p + _AFTER)).cast("int") for p in phrases]
    total = found[0]
    for f in found[1:]:
        total = total + f
    return F.when(_has(c, stems), total).otherwise(0)


def generic_title(title: Column) -> Column:
    """Normalised titles that are those of archives, error pages and the like."""
    start = text.trim(F.rtrim(F.lower(title), F.lit("|:–—- \t\n\x0b\f\r")))
    section = r"^(?:untitled|posts?|news archive|news|latest news|latest|homepage|home|blog|articles?|archives?)(?:\s*[–—|\-]\s*.+)?\z"
    error = r"^(?:web server is returning an unknown error|something went wrong|service unavailable|page not found|looking for something|internal server error|forbidden|bad gateway|access denied)(?:\s*[–—|\-]\s*.+)?\z"
    others = [r"^day:\s+[a-z]+\s+\d{1,2},?\s+20\d\d\z", r"^your choices regarding cookies on this site\z", r"^scitechdaily\s*[|\-]\s*science,? space and technology news\s+20\d\d\z", _BEFORE + "(?:500|403|404)" + _AFTER]

    def judge(t: Column) -> Column:
        hit = t.rlike(section) | t.rlike(error)
        for pattern in others:
            hit = hit | t.rlike(pattern)
        return (t != "") & ((F.length(t) > 300) | hit)

    return text.let(start, judge)


def html_shell(raw: Column) -> Column:
    """Markup rather than text."""
    low = F.lower(raw)
    tags = F.regexp_extract_all(low, F.lit(r"</?(?:header|footer|nav|link|meta|style|script|span|div|article|main|body|head|html)(?![A-Za-z0-9_])[^>]*>"), F.lit(0))
    many = text.let(tags, lambda t: (F.size(t) >= 8) & (F.length(F.array_join(t, "")) / F.greatest(F.length(raw), F.lit(1)) >= 0.12))
    return F.contains(raw, F.lit("<")) & (low.rlike(r"^\s*<(?:!doctype\s+html|(?:body|head|html)[\s>])") | many)


def code_shell(raw: Column) -> Column:
    """Script or style sheet rather than text, judged by the first 20,000 characters.

    Every case needs two signs at least, so lines are looked at only where there are as many.
    """
    s = F.substring(raw, 1, 20_000)
    js = F.regexp_count(s, F.lit(rf"(?i)(?=[vlcf_wmd=}};])(?:{_BEFORE}(?:var|let|const|function)\s+[a-z_$][\w$]*\s*[=(]|{_BEFORE}(?:__NEXT_DATA__|webpackJsonp|module\.exports|document|window){_AFTER}|=>\s*[({{]|[}};]\s*[}};])"))
    css = F.regexp_count(s, F.lit(rf"(?im)(?:^|\n)\s*(?:@(?:import|keyframes|font-face|media){_AFTER}|[a-z.#][^\n{{}}]{{0,120}}\{{\s*(?:[a-z-]+\s*:\s*[^;}}]+;)+)"))
    signs = F.struct(
        F.when(_has(s, "=|(|}|;") | _has(F.lower(s), "__next_data__|webpackjsonp|module.exports|document|window"), js).otherwise(0).alias("js"),
        F.when(_has(s, "{|@"), css).otherwise(0).alias("css"),
    )

    def judge(n: Column) -> Column:
        js, css, marks = n["js"], n["css"], text.count_of(s, ";{}")
        lines = F.split(s, "\n")
        filled = F.size(F.filter(lines, lambda x: text.trim(x) != ""))
        code = F.size(F.filter(lines, lambda x: x.rlike(rf"(?i)(?:{_BEFORE}(?:function|var|let|const){_AFTER}|=>|[#.][\w-]+\s*\{{|@media{_AFTER}|[;{{}}]\s*\z)")))
        ratio = code / F.greatest(filled, F.lit(1))
        density = marks / F.greatest(F.length(s), F.lit(1))
        shell = ((js >= 3) & ((ratio >= 0.35) | (density >= 0.012))) | ((css >= 2) & (ratio >= 0.3)) | ((js + css >= 2) & (marks >= 12) & (ratio >= 0.25))
        return F.when(js + css >= 2, shell).otherwise(False)

    return text.let(signs, judge)


# these take the text in lower case as well, which is computed once for all


def cookie_noise(raw: Column, low: Column | None = None) -> Column:
    n = _signals(F.lower(raw) if low is None else low, COOKIE, "cookie|consent")
    return (n >= 2) | ((n >= 1) & (F.length(raw) < 1500))


def paywall(raw: Column, low: Column | None = None) -> Column:
    return _signals(F.lower(raw) if low is None else low, PAYWALL, "article|register to|sign in to|log in to|free trial|limit|subscri") >= 1


def bot_challenge(raw: Column, low: Column | None = None) -> Column:
    start = F.substring(F.lower(raw) if low is None else low, 1, 2500)
    required = _has(start, "attention required") & start.rlike(rf"(?s){_BEFORE}attention required{_AFTER}.*{_BEFORE}cloudflare{_AFTER}")
    guarded = required | (_has(start, "cf-chl-") & start.rlike(_BEFORE + "cf-chl-"))
    return guarded | (_signals(start, CHALLENGE, "bad gateway|unavailable|not found|forbidden|could not be|captcha|javascript|human|browser") >= 1)


def navigation_noise(raw: Column, sentences: Column, low: Column | None = None) -> Column:
    n = _signals(F.lower(raw) if low is None else low, NAVIGATION, "follow us|menu|navigation|terms|privacy|home|skip to")
    return (n >= 3) | ((n >= 2) & ((F.length(raw) < 1500) | (sentences < 4)))


def non_prose(clean: Column, m: Column, min_words: int) -> Column:
    latin, letters = text.count_of(clean, "A-Za-z"), text.count_of(clean, r"\p{L}")
    mostly = (letters > 0) & (latin / F.greatest(letters, F.lit(1)) >= 0.7)
    thin = (m["word_count"] < min_words) | ((m["sentence_count"] < 3) & (m["character_count"] < 2000))
    return (clean == "") | (m["letter_ratio"] < 0.52) | (thin & mostly)


def repetitive(m: Column) -> Column:
    return (m["repeated_line_ratio"] >= 0.35) | ((m["word_count"] >= 80) & (m["token_diversity"] < 0.18))


def score(codes: Column) -> Column:
    """100 less the deductions of the codes, 0 at least."""
    table = F.create_map(*[F.lit(x) for pair in DEDUCTIONS.items() for x in pair])
    return F.greatest(F.lit(0), F.lit(100) - F.aggregate(codes, F.lit(0), lambda n, c: n + F.coalesce(F.try_element_at(table, c), F.lit(0))))


def validated(candidates: DataFrame, as_of: Column, options: Options = Options(), decode: bool = True) -> DataFrame:
    """The candidates (url, title, published_date, text as strings) with the gate's verdict.

    Adds accepted, rejection_codes, reason_code, quality_score, cleaned_text, canonical_url,
    content_hash, published_at and metrics.  ``decode=False`` leaves out entities and Unicode
    normal forms, for text known to need neither.
    """
    out = candidates.withColumn("_raw", text.normalized(F.col("text"), decode)).withColumn("_title", text.normalized(F.col("title"), decode))
    out = out.withColumn("canonical_url", urls.canonical(F.col("url"))).withColumn("published_at", dates.parse_strict(F.col("published_date")))
    # each step is a projection of its own, computed once
    out = out.withColumn("cleaned_text", text.barrier(text.without_boilerplate(F.col("_raw"))))
    out = out.withColumn("metrics", text.barrier(text.metrics(F.col("cleaned_text")))).withColumn("_low", text.barrier(F.lower(F.col("_raw"))))
    raw, title, clean, m, lower = (F.col(c) for c in ("_raw", "_title", "cleaned_text", "metrics", "_low"))
    low, high = dates.window_bounds(as_of, options.days_back, options.tolerance_minutes)
    missing = F.col("published_date").isNull() | (F.col("published_date") == "")
    rules = {
        "INVALID_URL": F.col("canonical_url").isNull(),
        "MISSING_PUBLISHED_DATE": missing,
        "INVALID_PUBLISHED_DATE": ~missing & F.col("published_at").isNull(),
        "PUBLISHED_DATE_TOO_OLD": F.col("published_at") < low,
        "PUBLISHED_DATE_IN_FUTURE": F.col("published_at") > high,
        "MISSING_TITLE": title == "",
        "GENERIC_OR_ERROR_TITLE": generic_title(title),
        "HTML_SHELL": html_shell(raw),
        "JAVASCRIPT_OR_CSS_SHELL": code_shell(raw),
        "COOKIE_OR_CONSENT_NOISE": cookie_noise(raw, lower),
        "PAYWALL_OR_LOGIN_WALL": paywall(raw, lower),
        "BOT_CHALLENGE_OR_ERROR_PAGE": bot_challenge(raw, lower),
        "NAVIGATION_NOISE": navigation_noise(raw, m["sentence_count"], lower),
        "CONTENT_TOO_SHORT": m["character_count"] < options.min_characters,
        "NON_PROSE_CONTENT": non_prose(clean, m, options.min_words),
        "REPETITIVE_CONTENT": repetitive(m),
    }
    codes = F.array_compact(F.array(*[F.when(rule, code) for code, rule in rules.items()]))
    out = out.withColumn("rejection_codes", text.barrier(codes))
    found = F.col("rejection_codes")
    out = out.withColumns({"accepted": F.size(found) == 0, "reason_code": F.get(found, F.lit(0)), "quality_score": score(found), "content_hash": text.content_hash(clean, decode)})
    return out.drop("_raw", "_title", "_low")
