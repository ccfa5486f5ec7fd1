"""URL canonicalisation and the URL classifiers, as column expressions.

URLs are taken apart by regular expressions.  Those with anything that the URL
standard rewrites (escapes, dot segments, white space, characters outside ASCII) are
canonicalised in Python, over Arrow batches that hold null for all others.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import StringType

_URL = r"(?i)^([a-z][a-z0-9+.\-]*)://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@\s\[\]]+)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"

TRACKING = set("vero_id vero_conv tracking spm ref_ ref ocid msclkid mkt_tok mc_eid mc_cid igshid gclid ga_term ga_source ga_medium ga_content ga_campaign fbclid dclid cmpid campaign _gl _ga".split())
DISCOVERY_TRACKING = r"(?i)^(?:mc_[ce]id|fbclid|gclid|utm_(?:id|content|term|campaign|medium|source))\z"

SKIP_SEGMENTS = "search account cart shop jobs careers event events podcasts podcast videos video tags tag authors author newsletter advertise contact about terms privacy subscription subscribe signup signin login".split()
SKIP_EXTENSIONS = "ico js css mov avi mp3 mp4 zip pdf svg webp gif png jpeg jpg".split()
ARTICLE_SKIP_SEGMENTS = "search podcast video newsletter subscribe signup signin login terms privacy contact about authors author categories category tags tag press-release sponsored sponsor".split()
ARTICLE_SKIP_EXTENSIONS = "rss xml js css mp3 mp4 zip pdf svg gif webp png jpeg jpg".split()
LEGACY_PARTS = (
    "/web-stories/ /gallery/ /coupon/ /deals/ /advertorial/ /brand-studio/ /partner/ /press-release/ /sponsored/ /sponsor/ ?s= /search /account /cart /shop /jobs /careers /event /podcast /video "
    "/categories/ /category/ /tags/ /tag/ /authors/ /author/ /newsletter /advertise /contact /about /terms /privacy /subscription /subscribe /signup /signin /login"
).split()
LEGACY_EXTENSIONS = [*SKIP_EXTENSIONS, "xml"]
HINTS = "blog reports report research stories story articles article news".split()
STRONG_HINTS = [*HINTS, "posts", "post", "resources"]

REASON_BLOCKED = "Filtered before crawl: blocked non-article URL"
REASON_ARCHIVE = "Filtered before crawl: homepage/archive/listing URL"
REASON_STRICT = "Filtered before crawl: not likely article URL"
REASON_ULTRA = "Filtered before crawl: ultra non-article URL"
REASON_INVALID = "Filtered before crawl: invalid URL"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(F.trim(url), _URL, k)


def valid(url: Column) -> Column:
    """Whether a URL has a scheme and a host; false for null."""
    return F.coalesce(F.trim(url).rlike(_URL), F.lit(False))


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    found = _part(url, 4)
    return F.when(found == "", "/").otherwise(found)


def query(url: Column) -> Column:
    return _part(url, 5)


def parameter_names(url: Column) -> Column:
    named = F.filter(F.split(query(url), "&"), lambda p: p != "")
    return F.transform(named, lambda p: F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)))


def _web(url: Column) -> Column:
    return scheme(url).isin("http", "https")


def _plain_canonical(url: Column) -> Column:
    """``canonical`` of URLs in which the standard has nothing to rewrite."""

    def name(p: Column) -> Column:
        return F.lower(F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)))

    kept = F.filter(F.split(query(url), "&"), lambda p: (p != "") & ~name(p).startswith("utm_") & ~name(p).isin(*sorted(TRACKING)))
    full = F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))
    pairs = F.array_sort(F.transform(full, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), p.alias("p"))))
    search = F.array_join(F.transform(pairs, lambda p: p["p"]), "&")
    port = _part(url, 3)
    default = F.when(scheme(url) == "http", "80").otherwise("443")
    single = F.regexp_replace(path(url), "/{2,}", "/")
    tidy = F.when(F.length(single) > 1, F.regexp_replace(single, r"/+\z", "")).otherwise(single)
    out = F.concat(
        scheme(url),
        F.lit("://"),
        F.regexp_replace(host(url), r"^www\.", ""),
        F.when((port == "") | (port == default), "").otherwise(F.concat(F.lit(":"), port)),
        F.when(tidy == "", "/").otherwise(tidy),
        F.when(search == "", "").otherwise(F.concat(F.lit("?"), search)),
    )
    return F.when(valid(url) & _web(url), out)


#: What the standard rewrites: characters that it escapes or drops, escapes, dot segments, and parameters that are written anew.
_REWRITTEN = r"""[^\x21-\x7e]|[%\\"<>`{}|^]|/\.{1,2}(?:[/?#]|\z)|\?[^#]*[^A-Za-z0-9*._=&#?-]"""
_PARTS = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*):[/]*([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?", re.S)


def _escaped(text: str, kept: str) -> str:
    return "".join(c if c in kept else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


_SAFE = {c for c in map(chr, range(0x21, 0x7F))}
_IN_PATH = "".join(sorted(_SAFE - set('"#<>?`{}^')))
_IN_FORM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789*-._ "


def standard_canonical(url: str) -> str | None:
    """``canonical`` by the URL standard's own rules, for one URL."""
    from urllib.parse import unquote, unquote_plus

    m = _PARTS.fullmatch(re.sub(r"[\t\n\r]", "", url.strip("".join(map(chr, range(0x21))))).replace("\\", "/"))
    if not m or m[1].lower() not in ("http", "https"):
        return None
    scheme_, authority, path_, query_ = m[1].lower(), m[2].rpartition("@")[2], m[3], m[4] or ""
    found = re.fullmatch(r"(\[[^\]]*\]|[^:]*)(?::(\d*))?", authority)
    if not found or not found[1]:
        return None
    host_, port = found[1].lower(), found[2]
    if not host_.startswith("["):
        try:
            host_ = ".".join(p.encode("idna").decode() if p else p for p in re.split("[.\u3002\uff0e\uff61]", unquote(host_).lower())).lower()
        except UnicodeError:
            return None
        if not host_ or re.search(r"[\x00-\x20#%/:<>?@\[\\\]^|\x7f]", host_):
            return None
    if port and int(port) > 65535:
        return None
    out: list[str] = []
    segments = path_.split("/")[1:] if path_.startswith("/") else []
    for k, segment in enumerate(segments):
        dots = segment.lower().replace("%2e", ".")
        if dots == "..":
            out[-1:] = []
        elif dots != ".":
            out.append(_escaped(segment, _IN_PATH))
        if dots in (".", "..") and k == len(segments) - 1:
            out.append("")
    tidy = "/" + re.sub("/{2,}", "/", "/".join(out)).strip("/")
    pairs = [tuple(unquote_plus(x) for x in (p.partition("=")[0], p.partition("=")[2])) for p in query_.split("&") if p]
    kept = [(n, v) for n, v in pairs if not n.lower().startswith("utm_") and n.lower() not in TRACKING]
    kept.sort(key=lambda x: x[0].encode("utf-16-be", "surrogatepass"))
    search = "&".join("=".join(_escaped(x, _IN_FORM).replace(" ", "+") for x in pair) for pair in kept)
    end = "" if not port or int(port) == {"http": 80, "https": 443}[scheme_] else f":{int(port)}"
    return f"{scheme_}://{host_.removeprefix('www.')}{end}{tidy}" + (f"?{search}" if search else "")


@arrow_udf(StringType())
def _standard(url: pa.Array) -> pa.Array:
    return pa.array([None if u is None else standard_canonical(u) for u in url.to_pylist()], pa.string())


def canonical(url: Column) -> Column:
    """The form of a URL that identity is decided by; null where it isn't a web address.

    Fragment, credentials, ``www.``, default ports and tracking parameters go, the other
    parameters are sorted, runs of slashes become one and trailing ones go; escapes, dot
    segments and international names are brought to the URL standard's form.
    """
    rewritten = F.trim(url).rlike(_REWRITTEN)
    return F.when(rewritten, _standard(F.when(rewritten, url))).otherwise(_plain_canonical(url))


@arrow_udf(StringType())
def resolved(url: pa.Array, base: pa.Array) -> pa.Array:
    """A link resolved against its page's address; null where that fails."""
    from urllib.parse import urljoin

    def join(u, b):
        if u is None:
            return None
        try:
            return urljoin(b or "", u.strip())
        except ValueError:
            return None

    return pa.array([join(u, b) for u, b in zip(url.to_pylist(), base.to_pylist())], pa.string())


def discovered(url: Column, relative_to: Column | None = None) -> Column:
    """A found link without fragment and the ten campaign parameters, order kept; null unless http(s)."""
    whole = F.trim(url) if relative_to is None else resolved(url, relative_to)
    name = lambda p: F.substring_index(p, "=", 1)
    kept = F.array_join(F.filter(F.split(query(whole), "&"), lambda p: ~name(p).rlike(DISCOVERY_TRACKING)), "&")
    port = _part(whole, 3)
    out = F.concat(
        scheme(whole), F.lit("://"), host(whole),
        F.when((port == "") | (port == F.when(scheme(whole) == "http", "80").otherwise("443")), "").otherwise(F.concat(F.lit(":"), port)),
        path(whole), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)),
    )
    return F.when(valid(whole) & _web(whole), out)


def base_of(*candidates: Column) -> Column:
    """Scheme and host of the first candidate that isn't null or empty."""
    first = F.coalesce(*[F.when(F.trim(c) != "", c) for c in candidates])
    return F.when(valid(first), F.concat(scheme(first), F.lit("://"), host(first)))


def bare_host(h: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(h), r"\.\z", ""), r"^www\.", "")


def same_domain(url: Column, base: Column) -> Column:
    """Equal hosts, or the first one under the second; ``www.`` and a final dot don't count."""
    mine, theirs = bare_host(host(url)), bare_host(host(base))
    return F.when(valid(url) & valid(base), (mine == theirs) | mine.endswith(F.concat(F.lit("."), theirs))).otherwise(False)


def _segments(url: Column) -> Column:
    return F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")


def _literals(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _ends_with(c: Column, extensions) -> Column:
    return F.lower(c).rlike(r"\.(?:" + "|".join(extensions) + r")\z")


def skip(url: Column) -> Column:
    """Links that discovery passes over."""
    blocked = F.arrays_overlap(_segments(url), _literals(SKIP_SEGMENTS)) | F.array_contains(parameter_names(url), "s") | _ends_with(path(url), SKIP_EXTENSIONS)
    return F.when(valid(url) & _web(url), blocked).otherwise(True)


_COLLECTIONS = "press(?:-releases?)?|blog|topics?|categor(?:y|ies)|publications|resources|insights|updates|latest|stories|articles?|newsroom|news"


def listing(url: Column) -> Column:
    """Collection, archive and pagination pages; unreadable URLs count as such."""
    p = F.lower(F.regexp_replace(path(url), r"/+\z", ""))
    paged = F.exists(F.split(query(url), "&"), lambda x: x.rlike(r"^(?:paged|page)=\d+\z"))
    found = (
        (p == "")
        | p.rlike(r"/paged?/\d+\z")
        | p.rlike(r"/(?:sitemap|archive-list|archives?)(?:/|\z)")
        | p.rlike(r"(?:^|/)20\d\d(?:/\d\d?){0,2}\z")
        | p.rlike(rf"^/(?:[a-z][a-z](?:-[a-z][a-z])?/)?(?:{_COLLECTIONS})\z")
        | paged
    )
    return F.when(valid(url), found).otherwise(True)


def pagination(url: Column, rel: Column, text: Column) -> Column:
    """Links to the next or previous page of a listing."""
    rels = F.split(F.lower(F.coalesce(rel, F.lit(""))), r"\s+")
    label = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))
    worded = label.rlike(r"^(?:newer|older|prev(?:ious)?|next)(?: (?:articles?|posts?|page))? ?[→»›]?\z")
    numbered = url.rlike(r"(?i)/paged?/\d+/?(?:[?#].*)?\z") | url.rlike(r"(?i)[?&]paged?=\d+(?:&|\z)")
    return F.arrays_overlap(rels, _literals(["prev", "next"])) | worded | label.rlike("^[←«‹→»›]\\z") | (listing(url) & F.coalesce(numbered, F.lit(False)))


def sitemap(url: Column) -> Column:
    p = F.lower(path(url))
    return F.when(valid(url), p.rlike(r"\.xml(?:\.gz)?\z") | p.contains("sitemap")).otherwise(False)


def keep_entry(lastmod: Column, cutoff: Column) -> Column:
    """Sitemap entries not known to be older than the cutoff."""
    return F.coalesce(F.try_to_timestamp(lastmod) >= cutoff, F.lit(True))


def skip_article(url: Column) -> Column:
    """Pages that are not fetched as articles; the scheme doesn't matter here."""
    segments = _segments(url)
    last = F.array_join(F.slice(F.reverse(segments), 1, 3), "/")  # day/month/year when reversed
    dated = last.rlike(r"^\d\d?/\d\d?/20\d\d\z")
    trimmed = F.regexp_replace(path(url), r"/+\z", "")
    blocked = dated | listing(url) | F.arrays_overlap(segments, _literals(ARTICLE_SKIP_SEGMENTS)) | F.array_contains(parameter_names(url), "s") | _ends_with(trimmed, ARTICLE_SKIP_EXTENSIONS)
    return F.when(valid(url), blocked).otherwise(True)


def legacy_blocked(url: Column) -> Column:
    u = F.lower(url)
    parts = "|".join(p.replace("?", r"\?") for p in LEGACY_PARTS)
    return u.rlike(parts) | u.contains("#") | u.rlike("^(?:tel|mailto):") | _ends_with(u, LEGACY_EXTENSIONS)


def archive_or_home(url: Column) -> Column:
    return F.regexp_replace(path(url), r"/+\z", "").rlike(r"^(?:/20\d\d(?:/\d\d)?)?\z")


def _slug(url: Column) -> Column:
    return F.coalesce(F.try_element_at(_segments(url), F.lit(-1)), F.lit(""))


def _dated(url: Column) -> Column:
    return path(url).rlike(r"/20\d\d/\d\d/\d\d/")


def _hinted(url: Column, hints) -> Column:
    return F.lower(path(url)).rlike("/(?:" + "|".join(hints) + ")/")


def likely_article(url: Column) -> Column:
    slug = _slug(url)
    long_slug = (F.size(_segments(url)) >= 2) & (F.length(slug) >= 20) & (F.regexp_count(slug, F.lit("-")) >= 3)
    return ~legacy_blocked(url) & ~archive_or_home(url) & (_dated(url) | long_slug | (_hinted(url, HINTS) & (F.length(slug) >= 12)))


def ultra_article(url: Column) -> Column:
    u, slug = F.lower(url), _slug(url)
    feed = u.contains("sitemap") | u.contains("/feed") | u.rlike(r"\.(?:rss|xml)\z")
    strong = _hinted(url, STRONG_HINTS) & (F.length(slug) >= 20) & (F.regexp_count(slug, F.lit("-")) >= 2)
    return ~legacy_blocked(url) & ~archive_or_home(url) & ~feed & (_dated(url) | strong)


def filter_reason(url: Column, mode: str = "balanced") -> Column:
    """Why a URL isn't crawled in this mode, null where it is.  An unreadable URL has a reason of its own."""
    out = F.when(legacy_blocked(url), REASON_BLOCKED).when(~valid(url) | url.isNull(), REASON_INVALID).when(archive_or_home(url), REASON_ARCHIVE)
    if mode == "strict":
        out = out.when(~likely_article(url), REASON_STRICT)
    elif mode == "ultra":
        out = out.when(~ultra_article(url), REASON_ULTRA)
    elif mode != "balanced":
        raise ValueError(f"no such mode: {mode}")
    return out
