"""Date functions as column expressions. The instant of reference is always given, never read from a clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ].*)?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
MAIL_DATE = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}(?::\d{2})? (?:[+\-]\d{4}|GMT|UTC|Z))$"


def is_date_only(value: Column) -> Column:
    return F.coalesce(F.regexp_like(F.trim(value), F.lit(ISO_DATE)), F.lit(False))


def instant(value: Column) -> Column:
    """The instant that an ISO 8601 or mail date names; dates are midnight, times without offset UTC; else null."""
    text = F.trim(value)
    mail = F.regexp_replace(F.regexp_extract(text, MAIL_DATE, 1), "(?:GMT|UTC|Z)$", "+0000")
    mail = F.coalesce(F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm Z")))
    return F.when(F.regexp_like(text, F.lit(ISO)), F.try_to_timestamp(text)).when(F.regexp_like(text, F.lit(MAIL_DATE)), mail)


def relative(text: Column, now: Column) -> Column:
    """The instant that "today", "yesterday", "3 hours ago" and the like name; hours are looked for first."""
    s = F.lower(F.trim(F.replace(F.replace(text, F.lit("\u00a0"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" "))))
    out = F.when(s.isin("today", "just now"), now).when(s == "yesterday", now - F.expr("interval 1 day"))
    for unit, seconds in ((r"(?:hours?|hrs?)", 3600), (r"days?", 86_400), (r"weeks?", 7 * 86_400), (r"months?", 30 * 86_400), (r"(?:mins?|minutes?)", 60)):
        n = F.regexp_extract(s, rf"(\d+)\s*{unit}\s*ago", 1)
        # Spark keeps instants as microseconds; so do the sums
        out = out.when(n != "", F.timestamp_micros(F.unix_micros(now) - n.cast("long") * (seconds * 1_000_000)))
    return out


def is_fresh(published: Column, now: Column, hours: int = 24) -> Column:
    """Whether an instant lies in the hours before now, both ends included; not for null."""
    age = F.unix_micros(now) - F.unix_micros(published)
    return F.coalesce((age >= 0) & (age <= hours * 3_600_000_000), F.lit(False))


def freshness(published: Column, now: Column, hours: int = 24) -> Column:
    """fresh, stale, future or missing_or_invalid_date."""
    age = F.unix_micros(now) - F.unix_micros(published)
    return F.when(age.isNull(), "missing_or_invalid_date").when(age < 0, "future").when(age <= hours * 3_600_000_000, "fresh").otherwise("stale")


def age_days(since: Column, now: Column) -> Column:
    """Whole periods of 24 hours."""
    return F.floor((F.unix_micros(now) - F.unix_micros(since)) / F.lit(86_400_000_000)).cast("long")


def paper_window(now: Column, days: int = 7) -> Column:
    """The query for papers submitted in the days before an instant."""
    day = lambda at: F.date_format(at, "yyyyMMdd")
    return F.concat(F.lit("(cat:cs.AI OR cat:cs.LG) AND submittedDate:["), day(F.timestamp_micros(F.unix_micros(now) - days * 86_400_000_000)), F.lit(" TO "), day(now), F.lit("]"))
