"""URL functions as column expressions. The normal forms differ on purpose: each belongs to one step."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.functions.binding import let

# Query keys that only track.
TRACKING_KEYS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "promo")
TRACKING_PREFIXES = ("utm_", "ref", "fid", "aff", "fbclid", "gclid")
# Hosts whose pages are no items, endings that are no pages, paths that aren't items.
EXCLUDED_DOMAINS = (
    "twitter.com", "x.com", "facebook.com", "linkedin.com", "instagram.com", "youtube.com", "bsky.app", "tiktok.com",
    "pinterest.com", "reddit.com", "threads.net", "google.com", "apple.com", "amazon.com",
)
EXCLUDED_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".css", ".js", ".pdf", ".ico", ".woff", ".woff2", ".eot", ".ttf",
    ".mp4", ".mp3", ".xml", ".rss", ".zip", ".gz", ".tar", ".exe", ".dmg", ".pkg",
)
EXCLUDED_PATHS = (
    "/login", "/signin", "/sign-in", "/sign_in", "/signup", "/sign-up", "/sign_up", "/register", "/subscribe", "/privacy",
    "/terms", "/contact", "/about", "/cookie", "/advertise", "/sponsor", "/cart", "/account", "/feed", "/rss", "/faq",
    "/help", "/support", "/pricing", "/disrupt", "/newsletter",
)
# Hosts that list products, and hosts that can't be a product's own.
DIRECTORY_DOMAINS = ("theresanaiforthat.com", "creati.ai", "producthunt.com", "futurepedia.io", "toolify.ai", "topai.tools")
VALIDATOR_DIRECTORIES = DIRECTORY_DOMAINS + ("aitools.fyi",)
DISALLOWED_DOMAINS = (
    "theresanaiforthat.com", "creati.ai", "futurepedia.io", "toolify.ai", "topai.tools", "aitools.fyi", "futuretools.io",
    "producthunt.com", "alternativeto.net", "g2.com", "capterra.com", "trustpilot.com", "saasworthy.com", "sourceforge.net",
    "wsj.com", "techcrunch.com", "venturebeat.com", "wired.com", "forbes.com", "bloomberg.com", "medium.com", "substack.com",
    "twitter.com", "x.com", "facebook.com", "linkedin.com", "instagram.com", "youtube.com", "discord.com", "discord.gg",
    "reddit.com", "t.me", "telegram.org", "tiktok.com", "github.blog",
)
#: Lower-case scheme and host, no query, fragment or slash at the end: nothing that storage_url would change.
PLAIN_URL = r"^[a-z][a-z0-9+.\-]*://[!-.0-@\[-~&&[^?#]]+(?:/(?:[^?#]*[^?#/])?)?(?<!/)\z"
ITEM_SKIP = r"^(?:javascript:|mailto:|tel:|#)"


@dataclass(frozen=True)
class Parts:
    """A URL in five columns; '' for what it lacks."""

    scheme: Column
    host: Column
    path: Column
    query: Column
    fragment: Column


def parts(url: Column) -> Parts:
    pick = lambda group: F.coalesce(F.regexp_extract(url, r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", group), F.lit(""))
    return Parts(F.lower(pick(1)), F.lower(pick(2)), pick(3), pick(4), pick(5))


def kept_query(query: Column, drop: Sequence[str], prefix: bool, blank: bool) -> Column:
    """The query's pairs in order, without those whose key is tracked; those without a value only if blank."""
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    key = lambda p: F.lower(F.substring_index(p, "=", 1))
    tracked = (lambda p: F.regexp_like(key(p), F.lit("^(?:" + "|".join(map(re.escape, drop)) + ")"))) if prefix else (lambda p: key(p).isin(*drop))
    kept = F.filter(pairs, lambda p: ~tracked(p) & (F.lit(True) if blank else F.regexp_like(p, F.lit("=."))))
    if blank:
        kept = F.transform(kept, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    return F.array_join(kept, "&")


def _joined(p: Parts, host: Column, path: Column, query: Column) -> Column:
    return F.concat(p.scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def item_url(url: Column) -> Column:
    """An absolute item URL in normal form: tracking keys and fragment go, a trailing slash stays. '' for what is no item."""
    raw = F.trim(url)
    p = parts(raw)
    path = F.trim(p.path)
    slash = F.when(F.endswith(path, F.lit("/")) & (F.length(path) > 1), "/").otherwise("")
    out = _joined(p, p.host, F.concat(F.rtrim(path, F.lit("/")), slash), kept_query(p.query, TRACKING_KEYS, False, True))
    bad_host = F.regexp_like(p.host, F.lit("|".join(map(re.escape, EXCLUDED_DOMAINS))))
    bad_end = F.regexp_like(F.lower(path), F.lit("(?:" + "|".join(map(re.escape, EXCLUDED_EXTENSIONS)) + ")$"))
    return F.when(raw.isNull() | (raw == "") | F.regexp_like(raw, F.lit(ITEM_SKIP)) | ~p.scheme.isin("http", "https") | bad_host | bad_end, "").otherwise(out)


def storage_url(url: Column) -> Column:
    """The form in which claims compare URLs: item keys and click ids go, no trailing slash. Others stay, trimmed."""
    raw = F.trim(url)
    p = parts(raw)
    out = _joined(p, p.host, F.rtrim(p.path, F.lit("/")), kept_query(p.query, TRACKING_KEYS + ("fbclid", "gclid"), False, True))
    normal = F.regexp_like(raw, F.lit(PLAIN_URL))  # most are, and taking them apart is far dearer
    return F.coalesce(F.when(normal | (p.scheme == "") | (p.host == ""), raw).otherwise(out), F.lit(""))


def directory_url(url: Column) -> Column:
    """The form in which listings compare URLs: keys with tracking prefixes and empty ones go, `www.` stays."""
    raw = F.trim(url)
    p = parts(raw)
    out = _joined(p, p.host, F.rtrim(F.substring_index(p.path, ";", 1), F.lit("/")), kept_query(p.query, TRACKING_PREFIXES, True, False))
    return F.coalesce(F.when((p.scheme == "") | (p.host == ""), raw).otherwise(out), F.lit(""))


def clean_url(url: Column) -> Column:
    """The form in which products compare URLs: as directory_url, without `source` keys and a leading `www.`."""
    raw = F.trim(url)
    p = parts(raw)
    out = _joined(p, F.regexp_replace(p.host, r"^www\.", ""), F.rtrim(p.path, F.lit("/")), kept_query(p.query, TRACKING_PREFIXES + ("source",), True, False))
    return F.coalesce(F.when((p.scheme == "") | (p.host == ""), raw).otherwise(out), F.lit(""))


def official_url(url: Column) -> Column:
    """A product's own address, or null: http(s), a host that isn't disallowed, no `www.` anywhere, `/` for no path."""
    raw = F.trim(url)
    p = parts(raw)
    path = F.rtrim(p.path, F.lit("/"))
    out = _joined(p, F.replace(p.host, F.lit("www."), F.lit("")), F.when(path == "", "/").otherwise(path), kept_query(p.query, TRACKING_PREFIXES + ("source",), True, False))
    return F.when(p.scheme.isin("http", "https") & (p.host != "") & ~is_disallowed(raw), out)


def validator_url(url: Column) -> Column:
    return F.lower(F.rtrim(F.substring_index(F.trim(url), "?", 1), F.lit("/")))


def domain(url: Column) -> Column:
    """Host in lower case, without port and leading `www.`; '' if there is none."""
    return F.regexp_replace(F.substring_index(parts(F.trim(url)).host, ":", 1), r"^www\.", "")


def in_domains(host: Column, domains: Sequence[str]) -> Column:
    """Whether a host is one of the domains or below one."""
    return F.regexp_like(host, F.lit(r"(?:^|\.)(?:" + "|".join(map(re.escape, domains)) + ")$"))


def is_disallowed(url: Column) -> Column:
    host = F.replace(F.substring_index(parts(url).host, ":", 1), F.lit("www."), F.lit(""))
    return F.coalesce((host == "") | in_domains(host, DISALLOWED_DOMAINS), F.lit(True))


def below(host: Column, site: Column) -> Column:
    """Whether a host is a site's or below it."""
    return F.coalesce((site != "") & ((host == site) | F.endswith(host, F.concat(F.lit("."), site))), F.lit(False))


def same_site(asset: Column, official: Column) -> Column:
    return below(domain(asset), domain(official))


def slug(url: Column) -> Column:
    return F.element_at(F.split(F.rtrim(parts(url).path, F.lit("/")), "/"), -1)


def repository(url: Column) -> Column:
    """owner/name of a repository's address; null for others."""
    return F.nullif(F.regexp_extract(F.rtrim(url, F.lit("/")), r"github\.com/([^/]+/[^/]+?)(?:\.git)?$", 1), F.lit(""))


def paper_id(url: Column) -> Column:
    """The id at the end of a paper's address, without its version."""
    return F.nullif(F.regexp_replace(F.regexp_extract(url, r"/abs/([^?#]+)$", 1), r"v\d+$", ""), F.lit(""))


def with_scheme(site: Column) -> Column:
    s = F.trim(site)
    return F.when(s == "", None).when(F.regexp_like(s, F.lit("^https?://")), s).otherwise(F.concat(F.lit("https://"), s))


# What sites are called.
SITE_NAMES = (
    ("techcrunch.com", "TechCrunch"), ("venturebeat.com", "VentureBeat"), ("technologyreview.com", "MIT Technology Review"), ("wired.com", "WIRED"), ("engadget.com", "Engadget"),
    ("ycombinator.com", "Y Combinator"), ("builtin.com", "Built In"), ("remoteok.com", "RemoteOK"), ("workingnomads.com", "Working Nomads"), ("jobspresso.co", "Jobspresso"),
    ("huggingface.co", "Hugging Face"), ("arxiv.org", "arXiv"),
)


def brand(url: Column, names: Sequence[tuple[str, str]] = SITE_NAMES) -> Column:
    """The name of the first listed domain that the host has in it; else the host without `www.`, capitalised; a fallback for
    no address."""
    from loam.functions.text import title_case

    host = F.substring_index(F.element_at(F.split(parts(url).host, "@"), -1), ":", 1)
    out = title_case(F.replace(host, F.lit("www."), F.lit("")))
    for part, name in reversed(list(names)):
        out = F.when(F.contains(host, F.lit(part)), name).otherwise(out)
    return F.when(F.coalesce(url, F.lit("")) == "", "Public Web").otherwise(out)


@F.pandas_udf(T.StringType())
def join(base: pd.Series, url: pd.Series) -> pd.Series:
    """RFC 3986 resolution of a reference against its page's address."""
    from urllib.parse import urljoin

    def one(b, u):
        try:
            return None if u is None else urljoin(b or "", u.strip())
        except ValueError:
            return None

    return pd.Series([one(b, u) for b, u in zip(base, url, strict=True)])


def join_simple(base: Column, url: Column) -> Column:
    """As join, natively, for the references that pages mostly have: absolute, `//host`, `/path` and plain names."""
    b = parts(base)
    root = F.concat(b.scheme, F.lit("://"), b.host)
    folder = F.regexp_replace(b.path, "[^/]*$", "")
    return let(
        F.trim(url),
        lambda u: F.when(F.regexp_like(u, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), u)
        .when(F.startswith(u, F.lit("//")), F.concat(b.scheme, F.lit(":"), u))
        .when(F.startswith(u, F.lit("/")), F.concat(root, u))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), u)),
    )
