"""Publication dates, windows, month calendars and URL templates.

Every function that depends on the time takes it as ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"^\d{4}-\d{2}-\d{2}\z"
_CLOCK = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"
_ZONE = r"(?:[Zz]|[+-]\d{2}:?\d{2})\z"


def parse_strict(c: Column) -> Column:
    """Timestamp of an ISO date (midnight UTC) or a timestamp with a zone, else null.

    RFC 2822 dates and space-separated timestamps are read as well; a ``T`` timestamp
    without a zone names no instant and is null.
    """
    c = F.trim(c)
    zoned = F.regexp_replace(F.upper(c), r"([+-]\d{2})(\d{2})\z", "$1:$2")
    iso = F.when(zoned.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"), F.try_to_timestamp(zoned))
    spaced = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}"), F.try_to_timestamp(c))
    rfc = F.when(c.rlike(r"^[A-Z][a-z]{2}, \d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} "), F.try_to_timestamp(F.regexp_replace(F.substring_index(c, ", ", -1), "GMT|UTC", "+0000"), F.lit("d MMM yyyy HH:mm:ss Z")))
    return (
        F.when(c.rlike(_DAY), F.try_to_timestamp(F.concat(c, F.lit("T00:00:00Z"))))
        .when(c.rlike(_CLOCK) & ~c.rlike(_ZONE), F.lit(None).cast("timestamp"))
        .otherwise(F.coalesce(iso, spaced, rfc))
    )


def parse_lax(c: Column) -> Column:
    """Like ``parse_strict``, but a missing zone means the session's."""
    return F.coalesce(parse_strict(c), F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(c)))


def window_bounds(as_of: Column, days: int = 365, tolerance_minutes: int = 15) -> tuple[Column, Column]:
    return as_of - F.make_dt_interval(F.lit(days)), as_of + F.make_dt_interval(mins=F.lit(tolerance_minutes))


def in_window(at: Column, as_of: Column, days: int = 365, tolerance_minutes: int = 15) -> Column:
    low, high = window_bounds(as_of, days, tolerance_minutes)
    return (at >= low) & (at <= high)


def discovery_cutoff(as_of: Column, days: int) -> Column:
    """Midnight UTC, so many days ago."""
    return F.date_sub(F.to_date(as_of), days).cast("timestamp")


def from_date(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def months(as_of: Column, days: int = 365) -> Column:
    """First days of the months from that of ``days`` ago to this one."""
    return F.sequence(F.trunc(F.date_sub(F.to_date(as_of), days), "MM"), F.trunc(F.to_date(as_of), "MM"), F.expr("interval 1 month"))


def days(as_of: Column, back: int) -> Column:
    return F.sequence(F.date_sub(F.to_date(as_of), back), F.to_date(as_of), F.expr("interval 1 day"))


PLACEHOLDERS = {"date": "yyyy-MM-dd", "yyyy": "yyyy", "yy": "yy", "dd": "dd", "d": "d", "mm": "MM", "m": "M"}


def render(template: Column, day: Column) -> Column:
    """A URL template with its seven date placeholders filled in."""
    for name, form in PLACEHOLDERS.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.date_format(day, form))
    return template


def date_accepted(published: Column, low: Column, as_of: Column, use_filter: bool = True, allow_unknown: bool = False) -> Column:
    """Whether the classifier takes an article of this date: up to a day ahead of now."""
    if not use_filter:
        return F.lit(True)
    at = parse_lax(published)
    return F.coalesce((at >= low) & (at <= as_of + F.make_dt_interval(F.lit(1))), F.lit(allow_unknown))
