"""Which hosts and addresses are public."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import BooleanType

from . import urls

#: First address and prefix length of the IPv4 ranges that aren't public.
IPV4_RANGES = [
    ("240.0.0.0", 4), ("224.0.0.0", 4), ("203.0.113.0", 24), ("198.51.100.0", 24), ("198.18.0.0", 15), ("192.168.0.0", 16), ("192.88.99.0", 24), ("192.0.2.0", 24),
    ("192.0.0.0", 24), ("172.16.0.0", 12), ("169.254.0.0", 16), ("127.0.0.0", 8), ("100.64.0.0", 10), ("10.0.0.0", 8), ("0.0.0.0", 8),
]
IPV6_RANGES = ["ff00::/8", "fec0::/10", "fe80::/10", "fc00::/7", "2001:db8::/32", "2001:20::/28", "2001:10::/28", "2001:2::/48", "100::/64", "64:ff9b:1::/48", "::1/128", "::/128"]
LOCAL_SUFFIXES = [".home.arpa", ".internal", ".local", ".localhost"]

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = "^" + r"\.".join([_OCTET] * 4) + r"\z"


def ipv4_number(c: Column) -> Column:
    """The address as a long; null unless four decimal octets."""
    n = F.lit(0).cast("long")
    for k in range(1, 5):
        n = n * 256 + F.regexp_extract(c, _IPV4, k).try_cast("long")
    return F.when(c.rlike(_IPV4), n)


def _number(dotted: str) -> int:
    a, b, c, d = map(int, dotted.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def in_ipv4_range(number: Column, base: str, bits: int) -> Column:
    size = 1 << (32 - bits)
    low = _number(base) // size * size
    return number.between(low, low + size - 1)


def non_public_ipv4(number: Column) -> Column:
    """Whether a numeric address lies in a range that isn't public; a null one counts as such."""
    hit = number.isNull()
    for base, bits in IPV4_RANGES:
        hit = hit | in_ipv4_range(number, base, bits)
    return F.coalesce(hit, F.lit(True))


@arrow_udf(BooleanType())
def non_public_ipv6(column: pa.Array) -> pa.Array:
    """Whether an IPv6 address isn't public: null for other strings; mapped IPv4 addresses are judged as those."""
    import ipaddress

    six = [ipaddress.ip_network(r) for r in IPV6_RANGES]
    four = [ipaddress.ip_network(f"{b}/{n}") for b, n in IPV4_RANGES]

    def judge(s):
        if s is None or ":" not in s:
            return None
        try:
            a = ipaddress.IPv6Address(s.split("%")[0])
        except ValueError:
            return None
        if a.ipv4_mapped is not None:
            return any(a.ipv4_mapped in n for n in four)
        return any(a in n for n in six)

    return pa.array([judge(s) for s in column.to_pylist()], pa.bool_())


def private_host(h: Column) -> Column:
    """Local names, and addresses that aren't public."""
    h = F.regexp_replace(F.regexp_replace(F.lower(h), r"^\[|\]\z", ""), r"\.\z", "")
    named = h == "localhost"
    for suffix in LOCAL_SUFFIXES:
        named = named | h.endswith(suffix)
    number = ipv4_number(h)
    return named | (number.isNotNull() & non_public_ipv4(number)) | F.coalesce(non_public_ipv6(h), F.lit(False))


def safe_url(url: Column) -> Column:
    """Web addresses without credentials whose host isn't private."""
    credentials = F.trim(url).rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*@")
    ok = urls.valid(url) & urls.scheme(url).isin("http", "https") & ~credentials & ~private_host(urls.host(url))
    return F.coalesce(ok, F.lit(False))


def resolves_to_public(host: str, resolve) -> bool:
    """Whether every address that ``resolve(host)`` gives is public; a failure to resolve is not.

    For the caller that is about to connect: never cache it or put it in a column.
    """
    import ipaddress

    name = host.lower().strip("[]").rstrip(".")
    try:
        found = [ipaddress.ip_address(name)]
    except ValueError:
        if name == "localhost" or name.endswith(tuple(LOCAL_SUFFIXES)):
            return False
        try:
            found = [ipaddress.ip_address(a.split("%")[0]) for a in resolve(name)]
        except (OSError, ValueError):
            return False

    def public(a) -> bool:
        if a.version == 6 and a.ipv4_mapped is not None:
            a = a.ipv4_mapped
        ranges = [f"{b}/{n}" for b, n in IPV4_RANGES] if a.version == 4 else IPV6_RANGES
        return not any(a in ipaddress.ip_network(r) for r in ranges)

    return bool(found) and all(map(public, found))
