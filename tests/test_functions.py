"""Text, dates, URLs, addresses and the quality gate on cases of their own."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions import addresses, dates, quality, text, urls

def at_noon():
    return F.lit("2026-07-13 12:00:00").cast("timestamp")


PROSE = "\n\n".join(
    f"The {a} committee met on the {b} to review the long report about {c}. Members asked several questions, and the answers of the {d} were written down with care for the public record."
    for a, b, c, d in [("water", "north bank", "river levels", "engineer"), ("school", "main square", "new classrooms", "head teacher"), ("harbour", "old pier", "fishing quotas", "captain"), ("library", "second floor", "rare maps", "archivist"),
                       ("forest", "southern slope", "storm damage", "ranger"), ("railway", "central station", "night trains", "signal master"), ("museum", "west wing", "glass cases", "curator"), ("market", "corn exchange", "grain prices", "auditor")]
)


def values(spark, f, *inputs):
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(inputs)], "k int, x string")
    return [r[0] for r in rows.select("k", f(F.col("x")).alias("y")).orderBy("k").select("y").collect()]


def judged(spark, options=quality.Options(), **changes):
    row = {"url": "https://www.example.com/news/committees-meet", "title": "Committees meet", "published_date": "2026-07-01T08:00:00Z", "text": PROSE} | changes
    return quality.validated(spark.createDataFrame([row], "url string, title string, published_date string, text string"), at_noon(), options).first()


def test_good_prose_is_accepted(spark):
    r = judged(spark)
    assert r.accepted and r.rejection_codes == [] and r.quality_score == 100 and len(r.content_hash) == 64
    assert r.canonical_url == "https://example.com/news/committees-meet"


@pytest.mark.parametrize("change, code", [
    (dict(title="News archive"), "GENERIC_OR_ERROR_TITLE"), (dict(title=None), "MISSING_TITLE"), (dict(published_date=None), "MISSING_PUBLISHED_DATE"), (dict(published_date="last Tuesday"), "INVALID_PUBLISHED_DATE"),
    (dict(published_date="2026-07-01T08:00:00"), "INVALID_PUBLISHED_DATE"), (dict(published_date="2025-07-12T11:00:00Z"), "PUBLISHED_DATE_TOO_OLD"), (dict(published_date="2026-07-13T12:16:00Z"), "PUBLISHED_DATE_IN_FUTURE"),
    (dict(url="ftp://example.com/x"), "INVALID_URL"), (dict(text="<!DOCTYPE html><html><body>" + PROSE), "HTML_SHELL"), (dict(text="\n".join(f"const value{k} = window.load({k});" for k in range(40))), "JAVASCRIPT_OR_CSS_SHELL"),
    (dict(text="\n".join(f".box{k} {{ color: red; margin: 0; }}" for k in range(40))), "JAVASCRIPT_OR_CSS_SHELL"), (dict(text="We value cookies. Accept all cookies. " * 12 + PROSE), "COOKIE_OR_CONSENT_NOISE"),
    (dict(text=PROSE + "\n\nPlease sign in to continue."), "PAYWALL_OR_LOGIN_WALL"), (dict(text="Checking your browser. " + PROSE), "BOT_CHALLENGE_OR_ERROR_PAGE"), (dict(text="Attention required! A page by Cloudflare.\n" + PROSE), "BOT_CHALLENGE_OR_ERROR_PAGE"),
    (dict(text="Follow us on. Open menu. Privacy policy. " + PROSE), "NAVIGATION_NOISE"), (dict(text="Too short."), "CONTENT_TOO_SHORT"), (dict(text="12 !!!! ???? " * 60), "NON_PROSE_CONTENT"), (dict(text="The same words again and again. " * 60), "REPETITIVE_CONTENT"), (dict(text=None), "CONTENT_TOO_SHORT"),
])
def test_rejections(spark, change, code):
    r = judged(spark, **change)
    assert not r.accepted and code in r.rejection_codes and r.reason_code == r.rejection_codes[0]
    assert r.quality_score == max(0, 100 - sum(quality.DEDUCTIONS[c] for c in r.rejection_codes))


def test_ten_minutes_ahead_pass(spark):
    assert judged(spark, published_date="2026-07-13T12:10:00Z").accepted


def test_crawl_limits_are_stricter(spark):
    short = PROSE[:600]
    assert "CONTENT_TOO_SHORT" in judged(spark, quality.CRAWL, text=short).rejection_codes
    assert "CONTENT_TOO_SHORT" not in judged(spark, text=short).rejection_codes


def test_hash_ignores_case_quotes_dashes_and_entities(spark):
    a, b, c = values(spark, text.content_hash, "“Fish” — &amp; chips", "\"fish\" - & CHIPS", "other")
    assert a == b != c


def test_cleaning(spark):
    assert values(spark, text.cleaned, "Menu\nFirst line\nFirst line\nAdvertisement:\nfirst LINE.\n\n\n\nSecond", None, "", "a​b&nbsp;c\r\nd") == ["First line\n\nSecond", "", "", "ab c\nd"]
    assert text.decode_entities("&#65;&#x42;&AMP;&bogus;&#xD800;&amp;lt;") == "AB&&bogus;&#xD800;&lt;"


def test_metrics(spark):
    m = values(spark, text.metrics, "One two two. Three!", "")
    assert (m[0].character_count, m[0].word_count, m[0].sentence_count, m[0].token_diversity) == (19, 4, 2, 0.75)
    assert (m[1].word_count, m[1].letter_ratio, m[1].token_diversity) == (0, 0.0, 0.0)
    line = "a line of more than twenty"
    assert values(spark, text.repeated_line_ratio, f"{line}\n {line.upper()}\n{line}\nshort", f"{line}\n{line}")[0] == pytest.approx(2 / 3)


def test_canonical(spark):
    got = values(spark, urls.canonical, "HTTPS://WWW.Example.com:443/a//b/?utm_source=x&b=2&a=1&fbclid=3#part", "ftp://example.com/", None, "nonsense", "http://u:p@example.com")
    assert got == ["https://example.com/a/b?a=1&b=2", None, None, None, "http://example.com/"]


def test_classifiers(spark):
    assert values(spark, urls.skip, "https://e.com/contact/x", "https://e.com/contact-tracing-works", "https://e.com/a?s=1", "https://e.com/a.pdf", "mailto:x", None) == [True, False, True, True, True, True]
    assert values(spark, urls.listing, "https://e.com/", "https://e.com/page/3", "https://e.com/2026/07", "https://e.com/en/news", "https://e.com/a-long-story") == [True, True, True, True, False]
    assert values(spark, urls.sitemap, "https://e.com/x.xml.gz", "https://e.com/sitemap/1", "https://e.com/x") == [True, True, False]
    assert values(spark, lambda c: urls.same_domain(c, F.lit("https://www.e.com")), "https://e.com/a", "https://b.e.com", "https://be.com") == [True, True, False]


def test_dates(spark):
    got = values(spark, lambda c: dates.parse_strict(c).cast("string"), "2026-07-13", "2026-07-13T10:00:00Z", "2026-07-13T10:00:00", "2026-07-13T10:00:00+0200", "Mon, 13 Jul 2026 10:00:00 GMT", "", None, "2026-02-31")
    assert got == ["2026-07-13 00:00:00", "2026-07-13 10:00:00", None, "2026-07-13 08:00:00", "2026-07-13 10:00:00", None, None, None]
    months = spark.range(1).select(F.size(dates.months(at_noon()))).first()[0]
    assert months == 13
    assert values(spark, lambda c: dates.render(c, F.lit("2026-03-05").cast("date")), "/{yyyy}/{yy}/{mm}/{m}/{dd}/{d}/{date}") == ["/2026/26/03/3/05/5/2026-03-05"]


PRIVATE = ["localhost", "x.localhost", "10.0.0.1", "127.0.0.1", "169.254.1.1", "172.16.0.1", "192.168.1.1", "100.64.0.1", "0.0.0.0", "224.0.0.1", "::1", "fe80::1", "fc00::1", "::ffff:10.0.0.1"]


def test_addresses(spark):
    assert all(values(spark, addresses.private_host, *PRIVATE))
    assert not any(values(spark, addresses.private_host, "example.com", "8.8.8.8", "2606:4700:4700::1111"))
    assert values(spark, addresses.safe_url, "https://example.com/", "ftp://example.com/", "https://u:p@example.com/", "http://127.0.0.1/", "http://[fe80::1]/") == [True, False, False, False, False]
    assert addresses.resolves_to_public("x", lambda h: ["8.8.8.8"]) and not addresses.resolves_to_public("x", lambda h: ["8.8.8.8", "10.0.0.1"])

    def fails(h):
        raise OSError

    assert not addresses.resolves_to_public("x", fails)


@pytest.mark.parametrize("url, expected", [
    ("HTTPS://www.Ex\u00e4mple.com/a/../b/./c?z=1&a=x y#f", "https://xn--exmple-cua.com/b/c?a=x+y&z=1"), ("https://e.com/%7Efoo/\u00fc/", "https://e.com/%7Efoo/%C3%BC"), ("https://e.com/a/%2E%2e/b", "https://e.com/b"),
    ("https://e.com/a/..", "https://e.com/"), ("https://e.com/a b", "https://e.com/a%20b"), ("https:\\\\e.com\\a", "https://e.com/a"), ("http://e.com:80/x?q=a/b&UTM_source=x", "http://e.com/x?q=a%2Fb"),
    ("https://u:p@e.com:8443//a//b//?b=2&a=%31", "https://e.com:8443/a/b?a=1&b=2"), ("ftp://e.com/%41", None), ("https://e%20x.com/", None), ("https://e.com/?a=\u20ac", "https://e.com/?a=%E2%82%AC"), ("https://e.com/x?a=1+2", "https://e.com/x?a=1+2"),
    ("https://e.com/plain?b=1&a", "https://e.com/plain?a=&b=1"),
])
def test_canonical_by_the_standard(spark, url, expected):
    assert values(spark, urls.canonical, url) == [expected]
    if expected:
        assert urls.standard_canonical(url) == expected  # and of URLs that need no rewriting both ways agree
