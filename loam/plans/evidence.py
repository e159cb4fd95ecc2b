"""Queries of discovery, verification, enrichment, publishing and reports, each with its equivalent for DuckDB.

Pages, cards and records are made from the driver's rows, so that the SQL can state what the operators must find in them
from the rows themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import dates, pages, text, urls
from loam.operators import claims, crawling, dashboard, discovery, enriching, merging, publishing, reporting, resolution, searching, verifying
from loam.plans import harvest, queries
from loam.plans.tools_view import AS_OF, TOOLS_SQL, tools
from loam.sources.files import atom_entries, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def instant(at: str = AS_OF):
    return F.lit(at).cast("timestamp")


def part(spark, sf_dir):
    """Parts, with i as their key."""
    return table(spark, sf_dir, "part").withColumn("i", F.col("p_partkey"))


def picked(column: str, *values: str | None):
    """The SQL, in both languages, of a value that follows a number's remainder."""
    shown = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(shown)) + " END"


NL = "chr(10)"

# What pages say

_PHRASES = (
    "Upload an image to begin.", "Supported formats: png and more", "Type your question here", "Get it from a text prompt", "Chat with your PDF", "Paste source code", "Record a voice note",
    "Import any mp4 clip", "Paste the link", "Drop a csv", "It will turn sketches into prompts", "Creates great illustrations", "Builds a quick summary", "output: transcript",
    "Writes clean code", "text-to-speech", "Renders short videos", "result: reports", "nothing at all",
)
_KINDS = (
    ("Image", ""), ("Image", ""), ("Text", ""), ("Text", ""), ("PDF / Document", ""), ("Code", ""), ("Audio", ""), ("Video", ""), ("URL", ""), ("Spreadsheet / CSV", ""), ("", "Text Prompt"),
    ("", "Generated Image"), ("", "Summary"), ("", "Transcript"), ("", "Code"), ("Text", "Audio"), ("", "Video"), ("", "Report"), ("", ""),
)


@query(f"SELECT p_partkey AS i, {picked('p_partkey', *[k[0] for k in _KINDS])} AS inputs, {picked('p_partkey', *[k[1] for k in _KINDS])} AS outputs FROM part")
def inputs_outputs(spark, sf_dir):
    body = F.expr(f"{picked('i', *_PHRASES)} || '. ' || p_name")
    return part(spark, sf_dir).select("i", F.array_join(pages.inputs(body), ",").alias("inputs"), F.array_join(pages.outputs(body), ",").alias("outputs"))


_BODY = picked("i", "On the Web, macOS and mac os", "For Windows or linux", "iOS app; Android too", "A Chrome extension for VS Code", "Webby GitHubs", "Connects to Slack, GitHub and Google Drive", "Zapier, Shopify, WordPress")


@query(
    f"SELECT p_partkey AS i, {picked('p_partkey', 'Web,macOS', 'Windows,Linux', 'iOS,Android', 'Chrome Extension,VS Code Extension', '', '', '')} AS platforms, "
    f"{picked('p_partkey', '', '', '', '', '', 'GitHub,Slack,Google Drive', 'Zapier,Shopify,WordPress')} AS integrations FROM part"
)
def platforms_integrations(spark, sf_dir):
    return part(spark, sf_dir).select("i", F.array_join(pages.platforms(F.expr(_BODY)), ",").alias("platforms"), F.array_join(pages.integrations(F.expr(_BODY)), ",").alias("integrations"))


@query(f"SELECT p_partkey AS i, {picked('p_partkey', 'Beta', 'Pre-launch', 'Discontinued', 'Active', None, 'Active', None)} AS status FROM part")
def page_status(spark, sf_dir):
    body = picked("i", "Now in public beta. Get started", "Join the waitlist", "We are shutting down", "Get started now", "Just a page", "A page with a form", "A form alone")
    html = picked("i", "", "", "", "", "", '<form id="f"><p>x</p><textarea></textarea></form>', "<form></form>")
    return part(spark, sf_dir).select("i", pages.status(F.col("p_name"), F.expr(body), F.expr(html)).alias("status"))


@query(
    f"SELECT p_partkey AS i, {picked('p_partkey', 'Acme Labs', 'Foo & Bar LLC', None, 'Long Names AI', None)} AS owner, CASE WHEN p_partkey % 3 = 0 THEN true END AS api, "
    "CASE WHEN p_partkey % 4 = 0 THEN 'Open Source' END AS open_source FROM part"
)
def page_flags(spark, sf_dir):
    footer = picked("i", "© 2024 Acme Labs, all rights", "Copyright Foo & Bar LLC x", "© 2024 nobody", "© Long Names AI | terms", "no mark")
    body = f"{picked('i', 'See our API docs', 'An apiary', 'A rest')} || ', ' || {picked('i', 'MIT License', 'open source', 'closed', 'GPL')}"
    html = picked("i", '<a href="https://github.com/x/y">code</a>', "<a href='/github'>x</a>", '<a href="https://github.com/x">x</a>', "no link")
    return part(spark, sf_dir).select("i", pages.copyright_owner(F.expr(footer)).alias("owner"), pages.offers_api(F.expr(body)).alias("api"), pages.open_source(F.expr(html), F.expr(body)).alias("open_source"))


@query(f"SELECT p_partkey AS i, {picked('p_partkey', 'Freemium', 'Free', 'Paid', 'Paid', 'Paid', None)} AS hint FROM part")
def pricing_hints(spark, sf_dir):
    return part(spark, sf_dir).select("i", pages.pricing_hint(F.expr(picked("i", "Freemium, free trial", "FREE", "free trial $5", "Paid only", "9/mo", "ask us"))).alias("hint"))


@query(
    f"SELECT p_partkey AS i, 'https://own.example.org' || {picked('p_partkey', '/a.png', '/touch.bin', '/l.gif', '/og-logo.jpg', '/plain.ico', '', '/b/x.gif')} AS logo FROM part WHERE p_partkey % 7 <> 5 "
    "UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 7 = 5"
)
def page_logo(spark, sf_dir):
    base = "'https://own.example.org/home'"
    html = picked(
        "i",
        '<link href="/z.ico" rel="shortcut icon"><link rel="icon" href="/a.png">',
        '<link rel="apple-touch-icon" href="/touch.bin">',
        '<img alt="Logo" src="/no.gif"><nav><img src="/x.gif"><img class="site-logo" src="/l.gif"></nav>',
        '<meta content="/og-logo.jpg" property="og:image"><link rel="icon" href="https://cdn.example.net/i.png">',
        '<meta property="og:image" content="/photo.jpg"><link rel=\'icon\' href=\'/plain.ico\'>',
        '<link rel="icon" href="https://cdn.example.net/i.png"><img src="/logo.png">',
        '<img alt="our LOGO" src="../b/x.gif">',
    ).replace("../b/x.gif", "b/x.gif")
    return part(spark, sf_dir).select("i", pages.logo(F.expr(html), F.expr(base)).alias("logo"))


#: What a name, host, title, heading and text make of a page, case by case: domain and title; domain alone; title, heading and
#: mentions without the domain; title alone; nothing; core words in the domain; the empty title.
_CASES = (
    ("Zorbo AI", "zorbo.com", "Zorbo - home", "Welcome", "x", "verified", None),
    ("Zorbo AI", "www.zorbo.io", "Home", "Welcome", "nothing here", "unverified", "Insufficient branding evidence for 'Zorbo AI' on official page title 'home'"),
    ("Kwix", "pages.example.org", "Kwix!", "Use Kwix", "Kwix is kwix.", "verified", None),
    ("Kwix", "pages.example.org", "kwix", "Welcome", "x", "partially_verified", "Partial branding evidence for 'Kwix' on domain 'pages.example.org' (title: 'kwix', mentions: 0)"),
    ("Kwix", "pages.example.org", "Other", "Else", "we like kwix", "partially_verified", "Partial branding evidence for 'Kwix' on domain 'pages.example.org' (title: 'other', mentions: 1)"),
    ("Paper Mill: the tool", "get-paper-mill.dev", "Home", "Paper mill", "x", "verified", None),
    ("Brixo (beta)", "brixo.app", "", "", "Brixo and Brixo", "verified", None),
)


@query(f"SELECT p_partkey AS i, {picked('p_partkey', *[c[5] for c in _CASES])} AS verification_status, {picked('p_partkey', *[c[6] for c in _CASES])} AS error FROM part")
def page_authenticity(spark, sf_dir):
    at = lambda k: F.expr(picked("i", *[c[k] for c in _CASES]))
    found = pages.authenticity(at(0), F.concat(F.lit("https://"), at(1), F.lit("/")), at(2), at(3), at(4))
    return part(spark, sf_dir).select("i", *[c.alias(n) for n, c in found.items()])


_JOB_SQL = """SELECT p_partkey AS i, CASE p_partkey % 4 WHEN 0 THEN 'Role ' || p_partkey WHEN 1 THEN 'Shown ' || p_name WHEN 2 THEN 'Tag & ' || p_size ELSE 'Listed' END AS title,
  CASE p_partkey % 4 WHEN 0 THEN 'Acme ' || p_size WHEN 1 THEN 'Deep-Mind'  WHEN 2 THEN 'Site name' ELSE 'Plain' END AS company,
  CASE WHEN p_partkey % 4 IN (0, 2) OR (p_partkey % 4 = 3 AND p_size % 2 = 0) THEN true END AS is_remote FROM part""".replace("'Deep-Mind' ", "'Deep Mind'")


@query(_JOB_SQL)
def job_metadata(spark, sf_dir):
    html = """CASE i % 4
      WHEN 0 THEN '<title>x</title><script type="application/ld+json">{"@graph": [{"@type": "Thing"}, {"@type": ["JobPosting"], "title": "Role ' || i || '", "hiringOrganization": {"name": "Acme ' || p_size || '"}, "jobLocationType": "telecommute"}]}</script>'
      WHEN 1 THEN '<script type="application/ld+json">{broken</script><h1>Shown <b>' || p_name || '</b></h1>'
      WHEN 2 THEN '<meta content="Tag &amp; ' || p_size || '" property="og:title"><meta property="og:site_name" content="Site name"><p>You can work from home</p>'
      ELSE '<title>Other</title><script type="application/ld+json">[{"@type": "JobPosting", "title": "Listed", "hiringOrganization": "Plain", "description": "' || CASE WHEN p_size % 2 = 0 THEN 'Remote' ELSE 'Office' END || '"}]</script>' END"""
    url = "CASE i % 4 WHEN 1 THEN 'https://www.ycombinator.com/companies/deep-mind/jobs/1' ELSE 'https://jobs.example.org/1' END"
    # the scripts' own words count as shown only where they say so: no other text has the word
    found = pages.job_metadata(F.expr(html), F.expr(url))
    return part(spark, sf_dir).select("i", *[c.alias(n) for n, c in found.items()])


@query("SELECT p_partkey AS i, CASE p_partkey % 3 WHEN 0 THEN 'Head ' || p_size WHEN 1 THEN 'Tweet ' || p_size ELSE 'Line ' || p_size END AS title FROM part")
def news_metadata(spark, sf_dir):
    html = """CASE i % 3 WHEN 0 THEN '<script type="application/ld+json">{"@type": "NewsArticle", "headline": "Head ' || p_size || '"}</script>'
      WHEN 1 THEN '<h1>No</h1><meta content=\\'Tweet ' || p_size || '\\' name=\\'twitter:title\\'>' ELSE '<h1> Line  ' || p_size || '</h1><title>t</title>' END"""
    return part(spark, sf_dir).select("i", pages.news_metadata(F.expr(html))["title"].alias("title"))


@query("SELECT p_partkey AS i, CASE WHEN p_partkey % 2 = 0 THEN 'Open-' || 'X' || p_size END AS company FROM part".replace("'Open-' || 'X' || p_size", "'Open X' || p_size"))
def company_of_address(spark, sf_dir):
    url = "CASE WHEN i % 2 = 0 THEN 'https://www.ycombinator.com/companies/open-x' || p_size || '/jobs/abc' ELSE 'https://jobs.example.org/companies/a/jobs' END"
    return part(spark, sf_dir).select("i", pages.company_of_address(F.expr(url)).alias("company"))


# Addresses


@query("SELECT p_partkey AS i, CASE p_partkey % 3 WHEN 0 THEN '24' || lpad(p_size::VARCHAR, 2, '0') || '.1' WHEN 1 THEN 'cs/' || p_size END AS paper, CASE p_partkey % 3 WHEN 0 THEN 'a/r' || p_size WHEN 1 THEN 'b/c.d' END AS repository FROM part")
def paper_and_repository(spark, sf_dir):
    paper = "CASE i % 3 WHEN 0 THEN 'http://arxiv.org/abs/24' || lpad(p_size, 2, '0') || '.1v' || p_size WHEN 1 THEN 'https://arxiv.org/abs/cs/' || p_size ELSE 'https://arxiv.org/pdf/1' END"
    code = "CASE i % 3 WHEN 0 THEN 'https://github.com/a/r' || p_size || '.git' WHEN 1 THEN 'http://github.com/b/c.d/' ELSE 'https://gitlab.com/a/b' END"
    return part(spark, sf_dir).select("i", urls.paper_id(F.expr(paper)).alias("paper"), urls.repository(F.expr(code)).alias("repository"))


@query(
    "SELECT page_id, list_extract(string_split(rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), '/'), -1) AS slug, "
    "CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://' || regexp_extract(url, '://(.*)$', 1) END AS website FROM pages"
)
def slugs_and_schemes(spark, sf_dir):
    site = F.expr("CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN regexp_extract(url, '://(.*)$', 1) ELSE ' ' END")
    return table(spark, sf_dir, "pages").select("page_id", urls.slug(F.col("url")).alias("slug"), urls.with_scheme(site).alias("website"))


@query(
    "WITH u AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root FROM pages) SELECT page_id, CASE page_id % 4 WHEN 0 THEN root || '/x' WHEN 1 THEN 'https://o.example/' || page_id "
    "WHEN 2 THEN regexp_extract(root, '^[a-z]+:', 0) || '//c.example/y' ELSE root || '/a/c' END AS joined FROM u"
)
def url_join(spark, sf_dir):
    base = F.expr("CASE WHEN page_id % 4 = 3 THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/a/b/../d' ELSE url END")
    reference = F.expr("CASE page_id % 4 WHEN 0 THEN '/x' WHEN 1 THEN ' https://o.example/' || page_id WHEN 2 THEN '//c.example/y' ELSE 'c' END")
    return table(spark, sf_dir, "pages").select("page_id", urls.join(base, reference).alias("joined"))


@query(
    "SELECT p_partkey AS i, p_partkey % 6 = 0 AS by_row, p_partkey % 6 = 2 AS by_card FROM part"
)
def permalink_rules(spark, sf_dir):
    full = picked("i", "https://theresanaiforthat.com/ai/x/", "https://theresanaiforthat.com/task/x", "https://creati.ai/ai-tools/x", "https://creati.ai/ai-tools/x/y", "https://creati.ai/ai-tools/most-used", "https://example.org/ai/x")
    href = picked("i", "/ai/x", "/ai-tools", "/ai-tools/x?a=1", "/ai-tools/x/y", "/ai-tools/most-used", "ai-tools/x")
    return part(spark, sf_dir).select("i", discovery.is_table_page(F.expr(full)).alias("by_row"), discovery.is_card_page(F.expr(href)).alias("by_card"))


_LINKED = (
    # site, news address, whether it is one, job address, whether it is one
    ("https://techcrunch.com/ai", "https://techcrunch.com/2024/05/06/a-b/", True, "https://techcrunch.com/jobs", False),
    ("https://venturebeat.com/ai", "https://venturebeat.com/category/ai/", False, "https://x.org/careers/ml", True),
    ("https://www.technologyreview.com", "https://www.technologyreview.com/2024/05/06/1090/x", True, "https://x.org/about/us", False),
    ("https://www.wired.com", "https://www.wired.com/story/x", True, "https://x.org/job/1/y", True),
    ("https://www.engadget.com", "https://www.engadget.com/tag/ai/x", False, "https://x.org/jobs/", False),
    ("https://www.ycombinator.com/jobs", "https://news.example/a/b", True, "https://www.ycombinator.com/companies/a/jobs/b", True),
    ("https://builtin.com/jobs", "https://news.example/topic/b", False, "https://builtin.com/job/ml/123", True),
    ("https://remoteok.com", "https://news.example/b", False, "https://remoteok.com/remote-jobs/ml-engineer-99", True),
    ("https://www.workingnomads.com/jobs", "https://news.example/a/b/c", True, "https://www.workingnomads.com/jobs/remote-jobs", False),
    ("https://jobspresso.co", "https://news.example/author/x", False, "https://jobspresso.co/job/ml-engineer/", True),
)


@query(f"SELECT p_partkey AS i, {picked('p_partkey', *[str(x[2]) for x in _LINKED])}::BOOLEAN AS news, {picked('p_partkey', *[str(x[4]) for x in _LINKED])}::BOOLEAN AS job FROM part")
def source_link_rules(spark, sf_dir):
    at = lambda k: F.expr(picked("i", *[x[k] for x in _LINKED]))
    return part(spark, sf_dir).select("i", crawling.news_link(at(0), at(1)).alias("news"), crawling.job_link(at(0), at(3)).alias("job"))


@query("SELECT p_partkey AS i, p_partkey % 6 IN (1, 3, 5) AS lacks FROM part")
def scripted_boards(spark, sf_dir):
    url = picked("i", "https://remoteok.com/x", "https://remoteok.com", "https://www.workingnomads.com/jobs", "https://www.workingnomads.com/jobs", "https://jobspresso.co", "https://jobspresso.co")
    html = picked("i", '<a href="/remote-jobs/ml-1">', '<a href="/remote-jobs/">', '<a href="/jobs/ml-engineer">', '<a href="/jobs/bg-x"><a href="/jobs/design">', '<a href="/job/a-b/">', '<a href="/job/">')
    return part(spark, sf_dir).select("i", crawling.lacks_postings(F.expr(url), F.expr(html)).alias("lacks"))


# Crawling

_FETCH = "CASE p_partkey % 8 WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 404 WHEN 3 THEN 429 WHEN 4 THEN 500 WHEN 5 THEN 301 END"
_REASON = "CASE p_partkey % 8 WHEN 4 THEN 'Server Error' WHEN 6 THEN 'refused' WHEN 7 THEN 'the read timed out' END"


@query(f"SELECT p_partkey AS i, {picked('p_partkey', None, 'HTTP 403 Forbidden — site blocked automated access', 'HTTP 404 Not Found', 'HTTP 429 Too Many Requests', 'HTTP Error 500: Server Error', None, 'Connection error: refused', 'Request timed out')} AS error FROM part")
def fetch_errors(spark, sf_dir):
    return part(spark, sf_dir).select("i", discovery.fetch_error(F.expr(_FETCH), F.expr(_REASON)).alias("error"))


@query(
    f"""WITH f AS (SELECT p_brand AS discovery_source, {_FETCH} AS c, p_size FROM part) SELECT discovery_source, count(*) AS pages_attempted, count(*) FILTER (coalesce(c <> 200, true)) AS failed_requests,
  count(*) FILTER (p_size < 3) AS candidates, CASE WHEN count(*) FILTER (p_size < 3) > 0 THEN 'PASS' WHEN count(*) FILTER (coalesce(c <> 200, true)) > 0 THEN 'FAIL' ELSE 'EMPTY' END AS status FROM f GROUP BY 1"""
)
def source_statuses(spark, sf_dir):
    rows = part(spark, sf_dir).select(F.col("p_brand").alias("discovery_source"), F.expr(_FETCH).alias("status_code"), "p_size")
    return discovery.source_status(rows, rows.where("p_size < 3"))


@query(
    """SELECT p_partkey AS url, CASE p_partkey % 5 WHEN 0 THEN 'first' WHEN 1 THEN 'second' END AS html,
  CASE p_partkey % 5 WHEN 1 THEN least(60, CAST(p_size AS DOUBLE) * 2) WHEN 2 THEN 60.0 WHEN 3 THEN 0.0 ELSE 0.0 END AS waited FROM part"""
)
def rate_limited_fetch(spark, sf_dir):
    p = part(spark, sf_dir)
    code = lambda *c: F.expr(picked("i", *c)).cast("int")
    first = p.select(F.col("i").alias("url"), F.lit(0).alias("attempt"), code("200", "429", "429", "500", "404").alias("status_code"), F.expr("CASE WHEN i % 5 = 1 THEN CAST(p_size * 2 AS STRING) WHEN i % 5 = 2 THEN 'soon' END").alias("retry_after"), F.expr(picked("i", "first", None, None, None, None)).alias("html"))
    second = p.where("i % 5 in (1, 2)").select(F.col("i").alias("url"), F.lit(1).alias("attempt"), code("0", "200", "429", "0", "0").alias("status_code"), F.lit(None).cast("string").alias("retry_after"), F.lit("second").alias("html"))
    return crawling.rate_limited(first.unionByName(second))


_CRAWLED = "c AS (SELECT page_id, url, page_id % 4 <> 0 AS success, CASE WHEN page_id % 7 = 0 THEN '  ' ELSE html END AS html, page_id % 3 = 0 AS used_browser, TIMESTAMP '" + AS_OF + "' - to_hours(page_id % 40) AS published FROM pages)"


def _crawled(spark, sf_dir):
    shown = "date_format(timestamp_micros(unix_micros(TIMESTAMP '" + AS_OF + "') - (page_id % 40) * 3600000000), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    return table(spark, sf_dir, "pages").select("page_id", "url", (F.col("page_id") % 4 != 0).alias("success"), F.when(F.col("page_id") % 7 == 0, "  ").otherwise(F.col("html")).alias("html"), (F.col("page_id") % 3 == 0).alias("used_browser"), F.expr(shown).alias("published_date"))


@query(f"WITH {_CRAWLED}, k AS (SELECT * FROM c WHERE success AND trim(html) <> '') SELECT page_id, 'NEWS' AS kind FROM k WHERE published >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR UNION ALL SELECT page_id, 'STARTUP' FROM k UNION ALL SELECT page_id, 'PAPER' FROM k")
def crawled_records(spark, sf_dir):
    rows = _crawled(spark, sf_dir)
    kept = [crawling.keep_crawled(rows, instant(), kind).select("page_id", F.col("recordType").alias("kind")) for kind in ("news", "startup")]
    return kept[0].unionByName(kept[1]).unionByName(crawling.with_content(rows).select("page_id", F.lit("PAPER").alias("kind")))


@query(f"WITH {_CRAWLED} SELECT count(*) AS urls, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed, count(*) FILTER (success AND used_browser) AS by_browser FROM c")
def crawl_summary(spark, sf_dir):
    return crawling.crawl_summary(_crawled(spark, sf_dir))


_DATED = f"strftime(TIMESTAMP '{AS_OF}' - to_days(CAST(p_size AS INTEGER)), '%Y-%m-%d %H:%M:%S')"


@query(
    f"""SELECT p_partkey AS i, CASE WHEN p_partkey % 9 = 8 THEN NULL WHEN p_partkey % 9 IN (2, 6) THEN strftime(date_trunc('day', TIMESTAMP '{AS_OF}' - to_days(CAST(p_size AS INTEGER))), '%Y-%m-%d %H:%M:%S') ELSE {_DATED} END AS published,
  p_partkey % 9 IN (2, 6) AS is_date_only, CASE WHEN p_partkey % 9 = 8 THEN 'missing_or_invalid_date' WHEN p_partkey % 9 IN (2, 6) THEN 'stale' WHEN p_size <= 1 THEN 'fresh' ELSE 'stale' END AS freshness FROM part"""
)
def item_dates(spark, sf_dir):
    """Dates by meta, JSON-LD (an object, a graph, a list), time elements, classed texts and relative texts."""
    at = f"timestamp_micros(unix_micros(TIMESTAMP '{AS_OF}') - p_size * 86400000000)"
    iso, day = f"date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", f"date_format({at}, 'yyyy-MM-dd')"
    html = f"""CASE i % 9
      WHEN 0 THEN '<meta property="article:published_time" content="' || {iso} || '"><time datetime="2001-01-01">x</time>'
      WHEN 1 THEN '<meta content="' || {iso} || '" itemprop="datePublished">'
      WHEN 2 THEN '<script type="application/ld+json">{{"@type": "NewsArticle", "datePublished": "' || {day} || '"}}</script>'
      WHEN 3 THEN '<script type="application/ld+json">{{"@graph": [{{"@type": "WebPage"}}, {{"@type": "Article", "datePublished": "' || {iso} || '"}}]}}</script>'
      WHEN 4 THEN '<script type="application/ld+json">bad</script><script type="application/ld+json">[{{"@type": "BlogPosting", "datePublished": "' || {iso} || '"}}]</script>'
      WHEN 5 THEN '<time datetime="' || {iso} || '">then</time>'
      WHEN 6 THEN '<span class="post-date"> ' || {day} || ' </span>'
      WHEN 7 THEN '<span class="posted">' || p_size || ' days ago</span>'
      ELSE '<p class="date">someday</p>' END"""
    df = part(spark, sf_dir).select("i", F.expr(html).alias("html"))
    read = crawling.item_records(df, instant(), F.lit("NEWS"))
    return read.select("i", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"), F.coalesce("is_date_only", F.lit(False)).alias("is_date_only"), "freshness")


# Listings

_ROWS_HTML = """concat('<div class="listing-table-row"><div class="cell name-cell"><a href="', CASE WHEN p_size % 5 = 0 THEN '/task/' ELSE '/ai/' END, 't', i, '/?ref=x">', p_name, CASE WHEN i % 3 = 0 THEN ' by Maker' ELSE '' END,
  '</a><a>About ', i, '</a></div><div class="topic-cell"><a>Topic ', p_size % 4, '</a></div><div class="author-cell"><a>', CASE WHEN i % 2 = 0 THEN concat('Dev', p_size, ' 😀 @dev') ELSE '' END, '</a></div><span>', CASE WHEN i % 4 = 0 THEN 'Free' ELSE '$9/mo' END, '</span></div>')"""


def _listing(spark, sf_dir, row: str) -> DataFrame:
    """A listing for each brand: its parts' cards, in order."""
    cards = part(spark, sf_dir).select(F.col("p_brand").alias("url"), F.struct("i", F.expr(row).alias("html")).alias("c"))
    return cards.groupBy("url").agg(F.concat(F.lit("<html><body>"), F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["html"]), ""), F.lit("</body></html>")).alias("html"))


@query(
    """SELECT p_brand AS page, 'candidate-t' || p_partkey AS candidate_id, p_name AS tool_name, CASE WHEN p_partkey % 2 = 0 THEN 'Dev' || p_size WHEN p_partkey % 3 = 0 THEN 'Maker' END AS company_developer,
  'https://theresanaiforthat.com/ai/t' || p_partkey AS discovered_url, 'About ' || p_partkey AS short_description, 'topic ' || (p_size % 4) AS tag, CASE WHEN p_partkey % 4 = 0 AND NOT contains(lower(p_name), 'trial') THEN 'Free' ELSE 'Paid' END AS pricing_hint
FROM part WHERE p_size % 5 <> 0"""
)
def table_listing(spark, sf_dir):
    found = discovery.table_candidates(_listing(spark, sf_dir, _ROWS_HTML), F.lit("2026-09-12"))
    return found.select("page", "candidate_id", "tool_name", "company_developer", "discovered_url", "short_description", F.get("tags", F.lit(0)).alias("tag"), F.element_at("raw_metadata", "pricing_hint").alias("pricing_hint"))


_CARDS_HTML = """concat('<div class="cardContainer"><a href="/ai-tools/', CASE WHEN p_size % 6 = 0 THEN 'most-used' WHEN p_size % 6 = 1 THEN concat('a/', i) ELSE concat('c', i) END, '?fid=1">link ', i, '</a>',
  CASE i % 3 WHEN 0 THEN concat('<h3>', p_name, '</h3>') WHEN 1 THEN concat('<img alt=" Alt ', i, ' ">') ELSE '' END, '<div class="card-description">', CASE WHEN i % 2 = 0 THEN concat('Does ', p_size) ELSE '' END, '</div>',
  '<span class="category-tag">K', p_size % 3, '</span><span class="categoriedTag">All</span><span class="category-tag">All</span><a href="https://creati.ai/x">in</a>', CASE WHEN i % 4 = 0 THEN concat('<a href="https://own', i, '.example/?utm_source=c">out</a>') ELSE '' END, '</div>')"""


@query(
    """SELECT p_brand AS page, 'candidate-c' || p_partkey AS candidate_id, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN 'Alt ' || p_partkey ELSE 'link ' || p_partkey END AS tool_name, 'https://creati.ai/ai-tools/c' || p_partkey AS discovered_url,
  CASE WHEN p_partkey % 2 = 0 THEN 'Does ' || p_size END AS short_description, 'K' || (p_size % 3) || ',All' AS categories, CASE WHEN p_partkey % 4 = 0 THEN 'https://own' || p_partkey || '.example' END AS external FROM part WHERE p_size % 6 > 1"""
)
def card_listing(spark, sf_dir):
    found = discovery.card_candidates(_listing(spark, sf_dir, _CARDS_HTML), F.lit("2026-09-12"))
    return found.select("page", "candidate_id", "tool_name", "discovered_url", "short_description", F.array_join("categories", ",").alias("categories"), F.element_at("raw_metadata", "external_product_url").alias("external"))


@query(
    """SELECT p_brand AS page, CASE WHEN p_partkey % 3 = 0 THEN 'In span' ELSE p_name END AS "productName", CASE p_partkey % 4 WHEN 0 THEN 'FREEMIUM' WHEN 1 THEN 'ENTERPRISE' WHEN 2 THEN 'PAID' END AS "pricingModel",
  'https://theresanaiforthat.com/ai/l' || p_partkey AS product_url FROM part WHERE NOT regexp_matches(lower(p_name), 'free|paid|[$]|trial')"""
)
def product_links(spark, sf_dir):
    card = """CASE WHEN p_name rlike '(?i)free|paid|[$]|trial' THEN '' ELSE concat('<div><a href="/ai/l', i, '">', CASE WHEN i % 3 = 0 THEN '' ELSE p_name END, '</a><a href="/ai/l', i, '">again</a><span>In span</span> ', CASE i % 4 WHEN 0 THEN 'freemium' WHEN 1 THEN 'for the enterprise' WHEN 2 THEN '$3' ELSE 'ask' END, '</div>') END"""
    found = discovery.linked_products(_listing(spark, sf_dir, card))
    return found.select("page", "productName", "pricingModel", "product_url")


@query("SELECT CASE WHEN p_partkey % 3 = 1 THEN p_name ELSE 'm' || p_partkey || '/v1' END AS \"productName\", CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN 'Owner' END AS \"startupName\", 'https://huggingface.co/' || CASE p_partkey % 3 WHEN 0 THEN p_type || '/m' || p_partkey || '/v1' WHEN 1 THEN p_name ELSE ' /m' || p_partkey || '/v1' END AS product_url FROM part")
def hosted_models(spark, sf_dir):
    rows = part(spark, sf_dir).select(F.expr("CASE i % 3 WHEN 0 THEN p_type || '/m' || i || '/v1' WHEN 1 THEN p_name ELSE ' /m' || i || '/v1' END").alias("id"), F.lit("Owner").alias("author"))
    return discovery.hosted_models(rows).select("productName", "startupName", "product_url")


@query("SELECT p_partkey AS i, CASE WHEN p_partkey % 2 = 0 THEN 'https://api.example/p?c=' || p_size END AS next FROM part")
def next_pages(spark, sf_dir):
    header = "CASE WHEN i % 2 = 0 THEN '<https://api.example/p?c=' || p_size || '>; rel=\"next\"' ELSE '<https://api.example/p>; rel=\"prev\"' END"
    return part(spark, sf_dir).select("i", discovery.next_page(F.expr(header)).alias("next"))


@query(
    """WITH h AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS n FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 3 <> 0)
SELECT p_partkey AS i, p_name AS "entityName", 'https://www.ycombinator.com/companies/s' || p_size AS company_url, CASE p_partkey % 2 WHEN 0 THEN 'https://w' || p_partkey || '.example' ELSE 'http://w.example' END AS website,
  CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey % 4 AS INTEGER) END AS "employeeCount" FROM h WHERE n = 1"""
)
def listed_companies(spark, sf_dir):
    hits = part(spark, sf_dir).select(
        "i",
        F.expr("CASE WHEN i % 5 = 0 THEN ' ' ELSE p_name END").alias("name"),
        F.expr("' s' || p_size").alias("slug"),
        (F.col("i") % 4).alias("team_size"),
        F.expr("CASE i % 2 WHEN 0 THEN 'w' || i || '.example' ELSE 'http://w.example' END").alias("website"),
        F.array(F.expr("CASE WHEN i % 3 = 0 THEN 'Retail' ELSE 'Machine Learning' END")).alias("industries"),
        F.lit("one line").alias("one_liner"),
    )
    found = discovery.listed_companies(hits, harvest.in_field(F.array_join("industries", " ")), "i")
    return found.select("i", "entityName", "company_url", "website", "employeeCount")


@query("WITH r AS (SELECT p_partkey AS i, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) SELECT i, p_brand FROM r WHERE n <= CASE p_brand WHEN 'Brand#11' THEN 7 ELSE 3 END")
def source_budgets(spark, sf_dir):
    return discovery.budgeted(part(spark, sf_dir).select("i", "p_brand"), "p_brand", "i", {"Brand#11": 7}, 3)


def _found(spark, sf_dir):
    """Candidates of two directories: those of one give no site, of the other a site for each name."""
    p = part(spark, sf_dir)
    source = F.when(F.col("i") % 2 == 0, "Rows").otherwise("Cards")
    url = F.concat(F.lit("https://d.example/"), "i")
    metadata = F.when(F.col("i") % 2 == 0, F.create_map(F.lit("source_slug"), F.col("i").cast("string"), F.lit("pricing_hint"), F.expr("CASE WHEN i % 4 = 0 THEN 'Free' END"))).otherwise(
        F.create_map(F.lit("source_slug"), F.col("i").cast("string"), F.lit("external_product_url"), F.concat(F.lit("https://www.g"), F.col("p_size"), F.lit(".example/x")))
    )
    reference = F.struct(source.alias("source"), F.lit("s").alias("source_url"), url.alias("discovered_url"), F.lit("t").alias("discovered_at"))
    made = {
        "candidate_id": F.concat(F.lit("candidate-"), "i"),
        "tool_name": F.concat(F.lit("Group "), F.col("p_size")),
        "company_developer": F.expr("CASE WHEN i % 3 = 0 THEN 'Dev ' || i END"),
        "discovered_url": url,
        "discovery_source": source,
        "discovery_source_url": F.lit("s"),
        "short_description": F.expr("CASE WHEN i % 5 = 0 THEN 'About ' || i END"),
        "categories": F.array(F.concat(F.lit("c"), F.col("i") % 3)),
        "tags": F.array().cast("array<string>"),
        "raw_metadata": metadata,
        "discovery_references": F.array(reference),
        "discovery_timestamp": F.lit("2026-09-12T00:00:00Z"),
        "input_idx": F.col("i").cast("long"),
    }
    return p.select(*[c.alias(n) for n, c in made.items()])


_MERGED_SQL = """g AS (SELECT *, p_partkey AS i FROM part),
c AS (SELECT p_size, i, 'c' || (i % 3) AS c, min(i) OVER (PARTITION BY p_size, i % 3) AS first FROM g),
l AS (SELECT p_size, string_agg(c, ',' ORDER BY i) AS categories FROM c WHERE i = first GROUP BY 1),
m AS (SELECT p_size, min(i) AS input_idx, arg_min('Dev ' || i, i) FILTER (i % 3 = 0) AS company_developer, arg_min('About ' || i, i) FILTER (i % 5 = 0) AS short_description, count(*) AS found,
  CASE count(DISTINCT i % 2) WHEN 2 THEN CASE min(i) % 2 WHEN 0 THEN 'Rows,Cards' ELSE 'Cards,Rows' END ELSE CASE min(i) % 2 WHEN 0 THEN 'Rows' ELSE 'Cards' END END AS sources,
  CAST(max(i) AS VARCHAR) AS slug, arg_max(CASE WHEN i % 4 = 0 THEN 'Free' ELSE '' END, i) FILTER (i % 2 = 0) AS hint FROM g GROUP BY 1)"""


@query(f"WITH {_MERGED_SQL} SELECT input_idx, company_developer, short_description, categories, sources, slug, coalesce(hint, '') AS hint, found FROM m JOIN l USING (p_size)")
def discovery_merge(spark, sf_dir):
    out = discovery.merge_candidates(_found(spark, sf_dir))
    return out.select(
        "input_idx",
        "company_developer",
        "short_description",
        F.array_join("categories", ",").alias("categories"),
        F.array_join(F.transform("discovery_references", lambda r: r["source"]), ",").alias("sources"),
        F.element_at("raw_metadata", "source_slug").alias("slug"),
        F.coalesce(F.element_at("raw_metadata", "pricing_hint"), F.lit("")).alias("hint"),
        "found",
    )


@query(
    """WITH g AS (SELECT p_size, min(p_partkey) AS i FROM part GROUP BY 1 ORDER BY 2 LIMIT 10), k AS (SELECT max(i) AS cut FROM g)
SELECT 10 AS target_limit, count(DISTINCT p_size) AS final_candidate_count, (SELECT count(*) FROM part) AS total_discovered, CAST(count(*) - count(DISTINCT p_size) AS BIGINT) AS duplicates_removed,
  (SELECT count(*) FROM part) AS total_pages_attempted, CAST((SELECT count(*) FILTER (p_partkey % 9 = 0) FROM part) AS BIGINT) AS total_failures, 'PASS' AS status FROM part, k WHERE p_partkey <= cut"""
)
def discovery_report(spark, sf_dir):
    found = _found(spark, sf_dir)
    fetches = found.select("discovery_source", F.when(F.col("input_idx") % 9 == 0, 500).otherwise(200).alias("status_code"))
    return discovery.discovery_report(found, discovery.merge_candidates(found, 10), discovery.source_status(fetches, found), 10)


# Verification

_SITE = "CASE WHEN i % 7 = 6 THEN NULL WHEN i % 7 = 0 THEN 'https://www.own' || i || '.example/?utm_source=a' WHEN i % 7 = 1 THEN 'https://x.com/own' END"
_SEEN = "CASE WHEN i % 7 = 2 THEN 'https://found' || i || '.example/p/' WHEN i % 7 IN (1, 3, 4, 5) THEN 'https://creati.ai/ai-tools/' || i END"
_RESOLVED_SQL = """r AS (SELECT p_partkey AS i, p_name, p_size, CASE p_partkey % 7 WHEN 0 THEN 'https://own' || p_partkey || '.example/' WHEN 2 THEN 'https://found' || p_partkey || '.example/p'
    WHEN 1 THEN 'https://out' || p_partkey || '.example/' WHEN 3 THEN 'https://out' || p_partkey || '.example/' END AS site,
  CASE p_partkey % 7 WHEN 1 THEN 'Discovered external URL was invalid or disallowed: https://x.com/own' WHEN 4 THEN 'Directory listing unavailable: HTTP 404 Not Found'
    WHEN 5 THEN 'No eligible official product website link found on directory page' WHEN 6 THEN 'No discovered URL or external product URL provided' ELSE '' END AS errors FROM part)"""


def _resolved(spark, sf_dir):
    p = part(spark, sf_dir)
    candidates = _found(spark, sf_dir).drop("raw_metadata", "discovered_url", "tool_name").join(p.select(F.col("i").cast("long").alias("input_idx"), F.expr(_SITE).alias("site"), F.expr(_SEEN).alias("discovered_url"), F.concat(F.lit("Own"), F.col("i")).alias("tool_name")), "input_idx")
    candidates = candidates.withColumn("raw_metadata", F.create_map(F.lit("external_product_url"), "site")).drop("site")
    html = "CASE i % 7 WHEN 5 THEN '<a href=\"https://twitter.com/a\">t</a>' ELSE '<a href=\"/in\">x</a><a href=\"https://g2.com/x\">g</a><a href=\" https://www.out' || i || '.example \">o</a>' END"
    listed = p.where("i % 7 in (1, 3, 4, 5)").select(F.expr(_SEEN).alias("url"), F.expr("CASE WHEN i % 7 = 4 THEN 404 ELSE 200 END").alias("status_code"), F.expr(f"CASE WHEN i % 7 <> 4 THEN {html} END").alias("html"), F.lit(None).cast("string").alias("error"))
    return verifying.official_websites(candidates, listed)


@query(f"WITH {_RESOLVED_SQL} SELECT i AS input_idx, site AS official_website, errors FROM r")
def official_websites(spark, sf_dir):
    return _resolved(spark, sf_dir).select("input_idx", "official_website", F.array_join("resolve_errors", "|").alias("errors"))


_VERIFIED_SQL = (
    _RESOLVED_SQL
    + """,
v AS (SELECT *, CASE WHEN site IS NULL THEN 'unverified' WHEN p_size % 5 = 0 THEN 'failed' WHEN i % 7 = 0 THEN 'verified' WHEN p_size % 5 = 1 THEN 'partially_verified' ELSE 'unverified' END AS verification_status,
  site IS NOT NULL AND p_size % 5 <> 0 AS read FROM r)"""
)


def _verified(spark, sf_dir):
    """Sites whose host has the product's name, or whose text names it once, or doesn't; a fifth can't be had."""
    resolved = _resolved(spark, sf_dir).join(part(spark, sf_dir).select(F.col("i").cast("long").alias("input_idx"), "p_size"), "input_idx")
    html = F.concat(
        F.lit('<html><head><title>Home</title><meta name="description" content="About '), F.col("input_idx"), F.lit('"></head><body><h1>Welcome</h1><p>'),
        F.when((F.col("p_size") % 5 == 1) | F.contains("official_website", F.lit("//own")), F.concat(F.lit("Try "), "tool_name", F.lit(" and "), "tool_name")).otherwise("Try it"),
        F.lit(" now. Get started: upload an image. Free plan, then $9/mo. Works on iOS with Slack.</p><footer>© 2024 Acme Labs, x</footer></body></html>"),
    )
    html = F.when((F.col("p_size") % 5 == 1) & ~F.contains("official_website", F.lit("//own")), F.regexp_replace(html, "Try (\\S+) and \\S+", "Try $1")).otherwise(html)
    fetched = resolved.where("official_website is not null").select(F.col("official_website").alias("url"), F.when(F.col("p_size") % 5 == 0, 500).otherwise(200).alias("status_code"), F.when(F.col("p_size") % 5 != 0, html).alias("html"), F.lit("boom").alias("error"))
    return verifying.verify(resolved.drop("p_size"), fetched, instant())


@query(
    f"""WITH {_VERIFIED_SQL} SELECT i AS input_idx, verification_status, CASE WHEN read THEN 'Active' END AS current_status, CASE WHEN i % 3 = 0 THEN 'Dev ' || i WHEN read THEN 'Acme Labs' END AS company_developer,
  CASE WHEN read THEN 'About ' || i WHEN i % 5 = 0 THEN 'About ' || i END AS short_description, CASE WHEN read THEN 'Image' ELSE '' END AS inputs, CASE WHEN read THEN 'iOS' ELSE '' END AS platforms, CASE WHEN read THEN 'Slack' ELSE '' END AS integrations,
  CASE WHEN read THEN 'Freemium' END AS pricing_model, CASE WHEN read THEN '$9/month' END AS starting_price, 'c' || (i % 3) AS primary_task, CASE WHEN site IS NOT NULL THEN 'Official Website' END AS verification_source,
  CASE WHEN site IS NOT NULL AND NOT read THEN 'Official website failed (' || site || '): HTTP Error 500: boom' ELSE '' END AS failure FROM v"""
)
def verified_records(spark, sf_dir):
    out = _verified(spark, sf_dir)
    failure = F.coalesce(F.get(F.filter("verification_errors", lambda e: F.startswith(e, F.lit("Official website failed"))), F.lit(0)), F.lit(""))
    return out.select(
        "input_idx", "verification_status", "current_status", "company_developer", "short_description", F.array_join("inputs", ",").alias("inputs"), F.array_join("supported_platforms", ",").alias("platforms"), F.array_join("integrations", ",").alias("integrations"),
        "pricing_model", "starting_price", "primary_task", "verification_source", failure.alias("failure"),
    )


@query(
    f"""WITH {_VERIFIED_SQL} SELECT count(*) AS candidates_attempted, {', '.join(f"count(*) FILTER (verification_status = '{s}') AS {s}" for s in ('verified', 'partially_verified', 'unverified', 'failed'))}, count(site) AS official_websites_resolved,
  0 AS logos_resolved, count(*) FILTER (verification_status = 'failed' OR i % 7 = 4) AS network_failures FROM v"""
)
def verification_report(spark, sf_dir):
    return verifying.verification_report(_verified(spark, sf_dir))


@query(f"WITH {_VERIFIED_SQL} SELECT i AS input_idx FROM v WHERE verification_status IN ('verified', 'partially_verified')")
def verified_only(spark, sf_dir):
    return verifying.verified_only(_verified(spark, sf_dir)).select("input_idx")


@query("SELECT p_partkey AS input_idx, CASE p_partkey % 2 WHEN 1 THEN 'with-external-url' ELSE 'directory-only' END AS mode FROM part")
def candidate_modes(spark, sf_dir):
    each = [verifying.external_mode(_found(spark, sf_dir), m).select("input_idx", F.lit(m).alias("mode")) for m in ("with-external-url", "directory-only")]
    return each[0].unionByName(each[1])


@query("SELECT p_partkey AS input_idx FROM part ORDER BY p_partkey LIMIT 25")
def first_candidates(spark, sf_dir):
    return verifying.first_rows(_found(spark, sf_dir), 25).select("input_idx")


# Enrichment

_LISTS = {c: f"array_to_string({c}, ', ')" for c in ("categories", "inputs", "outputs", "supported_platforms")}


@query(
    f"""WITH {TOOLS_SQL}, o AS (SELECT *, coalesce(nullif(detailed_overview, ''), nullif(short_description, ''), 'No further page evidence') AS overview FROM tools)
SELECT input_idx, 'Tool Name: ' || coalesce(tool_name, 'Unknown Tool') || chr(10) || 'Primary Task: ' || coalesce(nullif(primary_task, ''), 'Not verified')
  || chr(10) || 'Categories: ' || CASE WHEN n_categories > 0 THEN {_LISTS['categories']} ELSE 'None' END || chr(10) || 'Verified Inputs: ' || CASE WHEN n_inputs > 0 THEN {_LISTS['inputs']} ELSE 'None verified' END
  || chr(10) || 'Verified Outputs: ' || CASE WHEN n_outputs > 0 THEN {_LISTS['outputs']} ELSE 'None verified' END || chr(10) || 'Verified Pricing Model: ' || coalesce(pricing_model, 'Not publicly verified')
  || chr(10) || 'Verified Starting Price: ' || coalesce(starting_price, 'Not publicly verified') || chr(10) || 'Verified Free Plan: ' || CASE WHEN free_plan THEN 'Yes' WHEN NOT free_plan THEN 'No' ELSE 'Not verified' END
  || chr(10) || 'Verified Free Trial: Not verified' || chr(10) || 'Supported Platforms: ' || CASE WHEN n_supported_platforms > 0 THEN {_LISTS['supported_platforms']} ELSE 'None verified' END
  || chr(10) || 'Verified Integrations: None verified' || chr(10) || 'API Available: ' || CASE WHEN api_availability = 'True' THEN 'Yes' ELSE 'Not verified' END || chr(10) || 'Open Source: ' || coalesce(open_source_status, 'Not verified')
  || chr(10) || 'Official Page Context / Evidence:' || chr(10) || CASE WHEN length(overview) > 1500 THEN substr(overview, 1, 1500) || '...' ELSE overview END AS prompt FROM o"""
)
def evidence_prompt(spark, sf_dir):
    return tools(spark, sf_dir).select("input_idx", enriching.evidence().alias("prompt"))


_KIND = picked("doc_id", "JOB", "news ", "PRODUCT", "Startup", "AI_TOOL_DESCRIPTION", "RESEARCH_PAPER", "OTHER")
_SHAPES = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in enriching.FORMATS.items())


@query(
    f"""WITH k AS (SELECT doc_id, text, {_KIND} AS kind FROM documents)
SELECT doc_id, '{enriching.SYSTEM_HEAD}' || kind || '{enriching.SYSTEM_RULES}' AS system, 'Record Type: ' || kind || chr(10) || chr(10) || 'Expected JSON Schema:' || chr(10) || CASE upper(trim(kind)) {_SHAPES} ELSE '{enriching.OTHER_FORMAT}' END
  || chr(10) || chr(10) || 'Source Text:' || chr(10) || '---' || chr(10) || text || chr(10) || '---' || chr(10) || chr(10) || 'Extract the JSON matching the schema above. Return only the JSON object.' AS question FROM k"""
)
def extraction_prompts(spark, sf_dir):
    system, question = enriching.prompts(F.col("text"), F.expr(_KIND))
    return table(spark, sf_dir, "documents").select("doc_id", system.alias("system"), question.alias("question"))


_ENRICHED_SQL = (
    TOOLS_SQL
    + """,
a AS (SELECT *, verification_status <> 'unverified' AS wanted, input_idx % 6 AS a FROM tools),
e AS (SELECT *, CASE WHEN NOT wanted THEN 'skipped_unverified' WHEN a IN (0, 1) THEN 'enriched' ELSE 'failed' END AS enrichment_status FROM a)"""
)


def _enriched(spark, sf_dir):
    """Answers with fences, quotes and hype; without a description; broken; failed; and none."""
    df = tools(spark, sf_dir)
    raw = """CASE input_idx % 6 WHEN 0 THEN concat('```json\\n{"short_description": "\\\\"Tool  ', input_idx, '\\\\"", "detailed_overview": "The ultimate, truly Revolutionary thing"}\\n```')
      WHEN 1 THEN concat('Sure: {"short_description": "Does ', input_idx, '", "detailed_overview": "Long"} ok') WHEN 2 THEN '{"short_description": "only"}' WHEN 3 THEN '{broken' END"""
    answers = df.where("input_idx % 6 < 5").select("input_idx", (F.col("input_idx") % 6 < 4).alias("success"), F.expr(picked("input_idx", "gemini", "groq", "deepseek")).alias("provider"), F.expr(raw).alias("raw"), F.expr("CASE WHEN input_idx % 6 = 4 THEN 'quota' END").alias("error"))
    return enriching.enrich(df, answers, instant())


@query(
    f"""WITH {_ENRICHED_SQL} SELECT input_idx, enrichment_status, CASE WHEN enrichment_status = 'enriched' THEN {picked('input_idx', 'gemini', 'groq', 'deepseek')} END AS provider,
  CASE WHEN enrichment_status = 'enriched' THEN CASE a WHEN 0 THEN 'Tool ' || input_idx ELSE 'Does ' || input_idx END ELSE short_description END AS short_description,
  CASE WHEN enrichment_status = 'enriched' THEN CASE a WHEN 0 THEN 'The , truly thing' ELSE 'Long' END ELSE detailed_overview END AS detailed_overview,
  CASE WHEN enrichment_status <> 'failed' THEN '' WHEN a = 4 THEN 'quota' ELSE 'LLM returned empty description fields.' END AS errors FROM e"""
)
def enrich_outcomes(spark, sf_dir):
    return _enriched(spark, sf_dir).select("input_idx", "enrichment_status", F.col("enrichment_provider").alias("provider"), "short_description", "detailed_overview", F.array_join("enrichment_errors", "|").alias("errors"))


@query(
    f"""WITH {_ENRICHED_SQL} SELECT count(*) AS records_attempted, count(*) FILTER (enrichment_status = 'enriched') AS descriptions_successfully_generated, count(*) FILTER (enrichment_status = 'failed') AS failures,
  count(*) FILTER (enrichment_status = 'skipped_unverified') AS skipped_unverified, count(*) FILTER (enrichment_status = 'failed' AND coalesce(short_description, '') = '' AND coalesce(detailed_overview, '') = '') AS records_with_missing_descriptions,
  (SELECT string_agg(DISTINCT {picked('input_idx', 'gemini', 'groq', 'deepseek')}, ', ' ORDER BY {picked('input_idx', 'gemini', 'groq', 'deepseek')}) FROM e WHERE enrichment_status = 'enriched') AS providers_used FROM e"""
)
def enrichment_report(spark, sf_dir):
    return enriching.enrichment_report(_enriched(spark, sf_dir))


@query(
    """WITH r AS (SELECT p_partkey AS i, p_partkey % 10 AS c, p_size % 3 AS a FROM part)
SELECT i, CASE WHEN c = 0 THEN 'done' WHEN c IN (1, 2, 3, 4, 5, 6) AND a < 2 THEN 'retry' ELSE 'next_provider' END AS action,
  CASE WHEN a = 2 THEN 0.0 WHEN c = 1 THEN 7.5 WHEN c = 2 THEN 4.5 WHEN c = 3 THEN 13.0 WHEN c IN (4, 6) THEN 2.0 ** a WHEN c = 5 THEN 0.5 ELSE 0.0 END AS wait, CASE WHEN c = 5 THEN CASE WHEN a = 0 THEN 7200 ELSE 1000 END WHEN a = 0 THEN 12000 ELSE 1500 END AS max_chars FROM r"""
)
def model_retries(spark, sf_dir):
    p = part(spark, sf_dir).withColumn("attempt", F.col("p_size") % 3)
    code = F.expr(picked("i", "200", "429", "429", "429", "429", "413", None, "500", "200", None)).cast("int")
    error = F.expr(picked("i", None, None, None, None, None, None, "network", None, "invalid", "no_key"))
    after = F.expr(picked("i", None, "7.5", "soon", None, None, None, None, None, None, None))
    body = F.expr(picked("i", "", "", "Please Retry in 3.5s", '{"retryDelay": "12s"}', "", "", "", "", "", ""))
    found = enriching.next_try(code, error, F.col("attempt"), after, body, F.when(F.col("attempt") == 0, 12_000).otherwise(1_500))
    return p.select("i", *[c.alias(n) for n, c in found.items()])


# Texts


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN trim(regexp_replace(trim(text), '[ \\t]+', ' ', 'g')) WHEN 1 THEN trim(regexp_replace(regexp_replace(trim(text), '[ \\t]+', ' ', 'g'), '^\\s+', '')) ELSE 'quoted ' || doc_id END AS tidy, regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') AS plain FROM documents")
def tidy_texts(spark, sf_dir):
    quoted = F.expr("CASE doc_id % 3 WHEN 2 THEN concat(' \"quoted  ', doc_id, '\" ') ELSE text END")
    return table(spark, sf_dir, "documents").select("doc_id", text.tidy_description(quoted).alias("tidy"), text.ascii_only(F.col("text")).alias("plain"))


@query("SELECT p_partkey AS i, p_name AS name, CASE p_partkey % 3 WHEN 0 THEN 'Maker ' || p_size WHEN 1 THEN 'M by N' END AS developer FROM part")
def name_and_developer(spark, sf_dir):
    title = "p_name || CASE i % 3 WHEN 0 THEN ' by Maker ' || p_size || ' 🚀 @maker' WHEN 1 THEN ' by M by N' ELSE '' END"
    name, developer = text.name_and_developer(F.expr(title))
    return part(spark, sf_dir).select("i", name.alias("name"), developer.alias("developer"))


@query(
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(substr(text, 1, length(text) // 2)), '\s+'), lambda x: length(x) > 4) AS ws, lower(reverse(text)) AS t FROM documents)
SELECT doc_id, CASE WHEN len(ws) = 0 THEN 1.0 ELSE len(list_filter(ws, lambda x: contains(t, x))) / len(ws) END AS support FROM w""".replace("substr(text, 1, length(text) // 2)", "text")
)
def claim_support(spark, sf_dir):
    """How much of a text its own reversal holds."""
    return table(spark, sf_dir, "documents").select("doc_id", text.support_ratio(F.col("text"), F.reverse("text")).alias("support"))


@query("SELECT o_orderkey, '(cat:cs.AI OR cat:cs.LG) AND submittedDate:[' || strftime(o_orderdate - INTERVAL 7 DAY, '%Y%m%d') || ' TO ' || strftime(o_orderdate, '%Y%m%d') || ']' AS asked FROM orders")
def paper_window(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.paper_window(F.col("o_orderdate").cast("timestamp")).alias("asked"))


# Harvests


def _feeds(spark, sf_dir):
    """Atom feeds of ten entries: some without a title or authors, some twice."""
    entry = """concat('<entry><id>http://arxiv.org/abs/', CASE WHEN i % 10 = 9 THEN i - 1 ELSE i END, 'v', p_size, '</id><title>', CASE WHEN i % 10 = 3 THEN ' ' ELSE concat('On  ', chr(10), p_size) END, '</title><published>2024-05-', lpad(1 + i % 28, 2, '0'), 'T00:00:00Z</published>',
      CASE WHEN i % 10 = 5 THEN '' ELSE concat('<author><name>A', p_size, '</name></author><author><name>B</name></author>') END, '</entry>')"""
    rows = part(spark, sf_dir).select(F.floor(F.col("i") / 10).alias("batch"), F.struct("i", F.expr(entry).alias("x")).alias("e"))
    feeds = rows.groupBy("batch").agg(F.concat(F.lit("<feed>"), F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["x"]), ""), F.lit("</feed>")).alias("xml"))
    return atom_entries(feeds, F.col("xml"))


_PAPER_SQL = "e AS (SELECT CAST(CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR) AS arxiv_id, 'On ' || p_size AS title, 'A' || p_size || ',B' AS authors, p_partkey AS i FROM part WHERE p_partkey % 10 NOT IN (3, 5))"


@query(f"WITH {_PAPER_SQL} SELECT arxiv_id, title, authors, '2024-05-' || lpad(CAST(1 + i % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS published_date FROM e")
def atom_papers(spark, sf_dir):
    return _feeds(spark, sf_dir).select("arxiv_id", "title", F.array_join("authors", ",").alias("authors"), "published_date")


@query(f"WITH {_PAPER_SQL}, f AS (SELECT i, min(i) OVER (PARTITION BY arxiv_id) AS first FROM e) SELECT CAST(floor(i / 10) AS BIGINT) AS batch, count(*) AS fetched, count(*) FILTER (i = first) AS new FROM f GROUP BY 1")
def paper_batches(spark, sf_dir):
    rows = _feeds(spark, sf_dir).withColumns({"batch": F.floor(F.col("arxiv_id").cast("long") / 10), "input_idx": F.col("published_date")})
    return harvest.batch_totals(rows)


_REPO_SQL = "r AS (SELECT CAST(p_partkey AS VARCHAR) AS arxiv_id, CASE WHEN p_partkey % 4 = 0 THEN 'https://github.com/o/r' || p_partkey END AS github_url, CASE WHEN p_partkey % 8 = 0 THEN CAST(p_size AS INTEGER) END AS github_stars FROM part)"


def _papers(spark, sf_dir):
    found = _feeds(spark, sf_dir).withColumn("input_idx", F.regexp_extract("published_date", "(\\d+)T", 1).cast("int"))
    p = part(spark, sf_dir)
    repositories = p.where("i % 2 = 0").select(F.col("i").cast("string").alias("arxiv_id"), F.expr("CASE WHEN i % 4 = 0 THEN 'http://github.com/o/r' || i ELSE 'https://gitlab.com/x' END").alias("github_url"), F.expr("CASE WHEN i % 8 = 0 THEN CAST(p_size AS STRING) ELSE 'many' END").alias("github_stars"))
    return harvest.papers(found, repositories, instant())


@query(f"WITH {_PAPER_SQL}, {_REPO_SQL}, d AS (SELECT DISTINCT arxiv_id FROM e) SELECT arxiv_id, github_url, github_stars FROM d LEFT JOIN r USING (arxiv_id)")
def papers_with_repositories(spark, sf_dir):
    return _papers(spark, sf_dir).select("arxiv_id", "github_url", "github_stars")


@query(
    f"""WITH {_PAPER_SQL}, {_REPO_SQL}, d AS (SELECT DISTINCT arxiv_id FROM e), j AS (SELECT * FROM d LEFT JOIN r USING (arxiv_id))
SELECT count(*) AS verified_unique_papers, count(github_url) AS papers_with_github, count(github_stars) AS papers_with_stars, count(*) - count(github_url) AS papers_without_github, round(count(github_url) / count(*), 4) AS github_enrichment_success_rate,
  1.0 AS source_traceability_rate, 1.0 AS paper_url_coverage, 0 AS fabricated_records, 1000 AS target, CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END AS status, (SELECT count(*) FROM e) AS raw_records_received,
  (SELECT count(arxiv_id) - count(DISTINCT arxiv_id) FROM e) AS duplicates_removed, 0 AS rejected_records, (SELECT count(DISTINCT floor(i / 10)) FROM e) AS batches_requested FROM j"""
)
def research_report(spark, sf_dir):
    raw = _feeds(spark, sf_dir).withColumn("batch", F.floor(F.col("arxiv_id").cast("long") / 10))
    return reporting.research_report(_papers(spark, sf_dir), raw)


def _raw_startups(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("input_idx"),
        F.expr("CASE s_suppkey % 9 WHEN 0 THEN 'La France' WHEN 1 THEN 'FRANCE Inc.' WHEN 2 THEN ' x ' ELSE s_name END").alias("entityName"),
        F.expr("CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey AS INT) END").alias("employeeCount"),
        F.expr("CASE WHEN s_suppkey % 5 <> 0 THEN 'w' || s_suppkey || '.example' END").alias("website"),
        F.lit(None).cast("string").alias("company_url"),
        F.array(F.lit("AI")).alias("industries"),
        F.lit("d").alias("description"),
        F.lit("Src").alias("source_name"),
        F.lit("https://src.example").alias("source_url"),
    )


# the first France is supplier 1, which has a website; names of one letter go
_STARTUPS_SQL = """s AS (SELECT s_suppkey AS i, CASE WHEN s_suppkey % 9 < 2 THEN 'France' ELSE trim(s_name) END AS name, s_suppkey % 9 <> 2 AS named, s_suppkey % 5 <> 0 AS valid FROM supplier),
f AS (SELECT *, named AND i = min(i) FILTER (named) OVER (PARTITION BY name) AS first FROM s),
k AS (SELECT * FROM f WHERE first AND valid ORDER BY i LIMIT 40),
m AS (SELECT *, (SELECT count(*) FROM k) < 40 OR i <= (SELECT max(i) FROM k) AS seen FROM f)"""


@query(f"WITH {_STARTUPS_SQL} SELECT name AS \"entityName\", CASE WHEN i % 4 <> 0 THEN CAST(i AS INTEGER) END AS \"employeeCount\", 'https://w' || i || '.example' AS website FROM k")
def harvest_startups(spark, sf_dir):
    out = harvest.startups(_raw_startups(spark, sf_dir), queries._dims(spark), instant(), 40)
    return out.select("content.entityName", "content.data.employeeCount", "content.data.website")


@query(
    f"""WITH {_STARTUPS_SQL} SELECT count(*) AS total_raw_discovered, count(*) FILTER (seen AND first AND valid) AS verified_unique_count, count(*) FILTER (seen AND named AND NOT first) AS duplicates_removed,
  count(*) FILTER (seen AND (NOT named OR (first AND NOT valid))) AS records_rejected, count(*) FILTER (seen AND first AND i % 4 = 0) AS null_records, 0 AS resolved_startup_records, 40 AS target, 100.0 AS source_traceability_rate,
  0 AS fabricated_records, 'FAIL' AS status FROM m"""
)
def startup_harvest_report(spark, sf_dir):
    return _startup_report(spark, sf_dir)


def _startup_report(spark, sf_dir):
    named = resolution.resolve_startups(_raw_startups(spark, sf_dir), queries._dims(spark), "entityName")
    return reporting.harvested(named, "entityName", text.entity_key(F.col("canonical_name")), F.col("website").isNotNull(), "employeeCount", target=40)


def _raw_products(spark, sf_dir):
    return part(spark, sf_dir).select(
        F.col("i").alias("input_idx"),
        F.expr("CASE i % 4 WHEN 0 THEN 'P' || p_size WHEN 1 THEN 'p' || p_size || ', Inc.' WHEN 2 THEN 'y' ELSE 'Q' || i END").alias("productName"),
        F.expr("CASE WHEN i % 4 < 2 THEN 'Deutschland' END").alias("startupName"),
        F.expr(picked("i", "free", None, "Paid", "nonsense", None)).alias("pricingModel"),
        F.concat(F.lit("https://p.example/"), "i").alias("product_url"),
        F.lit("Src").alias("source_name"),
        F.lit("https://src.example").alias("source_url"),
    )


_PRODUCTS_SQL = """p AS (SELECT p_partkey AS i, p_partkey % 4 <> 2 AS named, CASE WHEN p_partkey % 4 < 2 THEN 'P' || p_size ELSE 'Q' || p_partkey END AS key, p_partkey % 5 <> 3 AS valid, p_size FROM part),
f AS (SELECT *, named AND i = min(i) FILTER (named) OVER (PARTITION BY key) AS first FROM p),
k AS (SELECT * FROM f WHERE first AND valid ORDER BY i LIMIT 60),
m AS (SELECT *, (SELECT count(*) FROM k) < 60 OR i <= (SELECT max(i) FROM k) AS seen FROM f)"""


@query(f"WITH {_PRODUCTS_SQL} SELECT i, CASE WHEN i % 4 < 2 THEN 'Germany' END AS \"startupName\", {picked('i', 'FREE', None, 'PAID', 'x', None)} AS \"pricingModel\" FROM k")
def harvest_products(spark, sf_dir):
    out = harvest.products(_raw_products(spark, sf_dir), queries._dims(spark), instant(), 60)
    return out.select(F.regexp_extract("content.product_url", r"(\d+)$", 1).cast("int").alias("i"), "content.startupName", "content.pricingModel")


def _product_report(spark, sf_dir):
    raw = _raw_products(spark, sf_dir)
    model = F.upper("pricingModel")
    key = F.concat_ws("|", text.entity_key(F.col("productName")), F.coalesce("startupName", "product_url"))
    return reporting.harvested(raw, "productName", key, model.isNull() | model.isin(*schemas.PRICING_MODELS), "pricingModel", "startupName", target=60)


_PRODUCT_REPORT_SQL = """count(*) AS total_raw_discovered, count(*) FILTER (seen AND first AND valid) AS verified_unique_count, count(*) FILTER (seen AND named AND NOT first) AS duplicates_removed,
  count(*) FILTER (seen AND (NOT named OR (first AND NOT valid))) AS records_rejected, count(*) FILTER (seen AND first AND i % 5 IN (1, 4)) AS null_records, count(*) FILTER (seen AND i % 4 < 2) AS resolved_startup_records"""


@query(f"WITH {_PRODUCTS_SQL} SELECT {_PRODUCT_REPORT_SQL}, 60 AS target, 100.0 AS source_traceability_rate, 0 AS fabricated_records, 'FAIL' AS status FROM m")
def product_harvest_report(spark, sf_dir):
    return _product_report(spark, sf_dir)


@query(
    f"""WITH {_STARTUPS_SQL.replace('k AS', 'sk AS').replace('FROM k)', 'FROM sk)').replace('m AS', 'sm AS').replace('f AS', 'sf AS').replace('FROM f', 'FROM sf')}, {_PRODUCTS_SQL},
a AS (SELECT count(*) FILTER (seen AND first AND valid) AS n, count(*) FILTER (seen AND named AND NOT first) AS d, count(*) FILTER (seen AND (NOT named OR (first AND NOT valid))) AS r, count(*) FILTER (seen AND first AND i % 4 = 0) AS z FROM sm),
b AS (SELECT {_PRODUCT_REPORT_SQL} FROM m)
SELECT 40 AS target_startups, 60 AS target_products, n AS startup_count, verified_unique_count AS product_count, d + duplicates_removed AS duplicates_removed, r + records_rejected AS records_rejected, z AS records_with_null_employee_count,
  null_records AS records_with_null_pricing, 100.0 AS source_traceability_rate, 0 AS fabricated_records, 'FAIL' AS startup_status, 'FAIL' AS product_status, 'FAIL' AS status FROM a, b"""
)
def combined_harvest_report(spark, sf_dir):
    return reporting.combined_harvest(_startup_report(spark, sf_dir), _product_report(spark, sf_dir))


# Records as they are shown and published

_AT = f"TIMESTAMP '{AS_OF}' - to_hours(p_partkey)"
_ISO = f"strftime({_AT}, '%Y-%m-%dT%H:%M:%S+00:00')"


def _record(spark, sf_dir, kind: str, content: dict, **top) -> DataFrame:
    at = F.timestamp_micros(F.unix_micros(instant()) - F.col("i") * 3_600_000_000)
    source = F.struct(F.expr("CASE WHEN i % 2 = 0 THEN 'Src' END").alias("name"), F.expr("CASE i % 3 WHEN 0 THEN 'https://www.ycombinator.com/x' WHEN 1 THEN 'https://www.my-site.example/y' END").alias("url"))
    inner = F.struct(*[c.alias(n) for n, c in content.items()])
    return part(spark, sf_dir).select("i", F.lit("1.0").alias("schemaVersion"), F.lit(kind).alias("recordType"), source.alias("source"), inner.alias("content"), at.alias("collectedAt"), at.alias("collected_at"), *[c.alias(n) for n, c in top.items()])


_URL = "CASE p_partkey % 3 WHEN 0 THEN 'https://www.ycombinator.com/x' WHEN 1 THEN 'https://www.my-site.example/y' ELSE '' END"
_NAMED = "CASE WHEN p_partkey % 2 = 0 THEN 'Src' WHEN p_partkey % 3 = 0 THEN 'Y Combinator' WHEN p_partkey % 3 = 1 THEN 'My-Site.Example' ELSE 'Public Web' END"


def _heads(kind: str, item: str) -> str:
    return f"'1.0' AS \"schemaVersion\", '{kind}' AS \"recordType\", {_NAMED} AS \"sourceName\", {_URL} AS \"sourceUrl\", coalesce({item}, {_URL}) AS \"itemUrl\""


def _startup_records(spark, sf_dir):
    data = F.struct(F.expr("CASE WHEN i % 4 <> 0 THEN p_size - 1 END").cast("int").alias("employeeCount"), F.expr("CASE WHEN i % 5 <> 0 THEN 'https://w.example' END").alias("website"), F.expr("CASE WHEN i % 2 = 0 THEN 'https://c.example/' || i END").alias("company_url"), F.array(F.lit("AI"), F.col("p_brand")).alias("industries"), F.lit("d").alias("description"))
    return _record(spark, sf_dir, "STARTUP", {"entityName": F.col("p_name"), "data": data})


@query(
    f"""SELECT {_heads('STARTUP', "CASE WHEN p_partkey % 2 = 0 THEN 'https://c.example/' || p_partkey END")}, p_name AS "entityName", CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size - 1 AS VARCHAR) ELSE '' END AS "employeeCount",
  CASE WHEN p_partkey % 5 <> 0 THEN 'https://w.example' ELSE '' END AS website, 'AI, ' || p_brand AS industries, 'd' AS description, {_ISO} AS "collectedAt" FROM part"""
)
def startup_rows(spark, sf_dir):
    return publishing.startup_rows(_startup_records(spark, sf_dir))


def _product_records(spark, sf_dir):
    return _record(spark, sf_dir, "PRODUCT", {"productName": F.col("p_name"), "startupName": F.expr("CASE WHEN i % 4 = 0 THEN 'Own' END"), "pricingModel": F.expr("CASE WHEN i % 5 = 0 THEN 'FREE' END"), "product_url": F.expr("CASE WHEN i % 2 = 0 THEN 'https://p.example/' || i END")})


_PURL = "CASE WHEN p_partkey % 2 = 0 THEN 'https://p.example/' || p_partkey END"


@query(f"SELECT {_heads('PRODUCT', _PURL)}, p_name AS \"productName\", CASE WHEN p_partkey % 4 = 0 THEN 'Own' ELSE '' END AS \"startupName\", CASE WHEN p_partkey % 5 = 0 THEN 'FREE' ELSE '' END AS \"pricingModel\", coalesce({_PURL}, '') AS \"productUrl\", {_ISO} AS \"collectedAt\" FROM part")
def product_rows(spark, sf_dir):
    return publishing.product_rows(_product_records(spark, sf_dir))


def _paper_records(spark, sf_dir, **top):
    at = F.timestamp_micros(F.unix_micros(instant()) - F.col("i") * 3_600_000_000)
    return _record(spark, sf_dir, "RESEARCH_PAPER", {"title": F.col("p_name"), "authors": F.array(F.lit("A"), F.col("p_type")), "paper_url": F.lit("https://arxiv.org/abs/1"), "github_url": F.expr("CASE WHEN i % 3 = 0 THEN 'https://github.com/a/b' END"), "github_stars": F.expr("CASE WHEN i % 2 = 0 THEN p_size - 1 END").cast("int"), "published_date": at}, **top)


@query(
    f"""SELECT '1.0' AS "schemaVersion", 'RESEARCH_PAPER' AS "recordType", CASE WHEN p_partkey % 2 = 0 THEN 'Src' ELSE 'arXiv' END AS "sourceName", {_URL} AS "sourceUrl", p_name AS title, 'A; ' || p_type AS authors, 'https://arxiv.org/abs/1' AS "paperUrl",
  CASE WHEN p_partkey % 3 = 0 THEN 'https://github.com/a/b' ELSE '' END AS "githubUrl", CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size - 1 AS VARCHAR) ELSE '' END AS "githubStars", {_ISO} AS "publishedDate", {_ISO} AS "collectedAt" FROM part"""
)
def paper_rows(spark, sf_dir):
    return publishing.paper_rows(_paper_records(spark, sf_dir))


def _job_records(spark, sf_dir):
    at = F.timestamp_micros(F.unix_micros(instant()) - F.col("i") * 3_600_000_000)
    remote = F.expr("CASE i % 3 WHEN 0 THEN true WHEN 1 THEN false END")
    return _record(spark, sf_dir, "JOB", {"url": F.expr("CASE WHEN i % 2 = 0 THEN 'https://j.example/' || i END"), "title": F.expr("CASE WHEN i % 4 <> 0 THEN p_name END"), "company": F.expr("CASE WHEN i % 5 <> 0 THEN p_type END"), "role": F.lit("Role"), "role_family": F.expr("CASE WHEN i % 6 = 0 THEN 'Research' END"), "date": at, "is_remote": remote})


_JURL = "CASE WHEN p_partkey % 2 = 0 THEN 'https://j.example/' || p_partkey END"


@query(
    f"""SELECT {_heads('JOB', _JURL)}, CASE WHEN p_partkey % 5 <> 0 THEN p_type ELSE '' END AS company, CASE WHEN p_partkey % 4 <> 0 THEN p_name ELSE 'Role' END AS role, {_ISO} AS date,
  CASE p_partkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE '' END AS "isRemote", CASE WHEN p_partkey % 6 = 0 THEN 'Research' ELSE 'Engineering / AI' END AS "roleFamily", {_ISO} AS "collectedAt" FROM part"""
)
def job_rows(spark, sf_dir):
    return publishing.job_rows(_job_records(spark, sf_dir))


def _news_records(spark, sf_dir):
    at = F.timestamp_micros(F.unix_micros(instant()) - F.col("i") * 3_600_000_000)
    return _record(spark, sf_dir, "NEWS", {"url": F.expr("CASE WHEN i % 2 = 0 THEN 'https://j.example/' || i END"), "title": F.col("p_name"), "text": F.expr("CASE WHEN i % 3 = 0 THEN p_comment END") if False else F.expr("CASE WHEN i % 3 = 0 THEN p_type END"), "published_date": at})


@query(f"SELECT {_heads('NEWS', _JURL)}, p_name AS title, {_ISO} AS date, {_ISO} AS \"collectedAt\", CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE '' END AS content FROM part")
def news_rows(spark, sf_dir):
    return publishing.news_rows(_news_records(spark, sf_dir))


@query(
    f"""SELECT '1.0' AS "schemaVersion", 'ENTITY_MAPPING_LOG' AS "recordType", CASE WHEN p_partkey % 2 = 0 THEN 'Src' ELSE 'Entity Resolver' END AS "sourceName", CASE WHEN p_partkey % 3 < 2 THEN {_URL} ELSE 'https://s.example' END AS "sourceUrl",
  CASE WHEN p_partkey % 5 = 0 THEN 'https://i.example' WHEN p_partkey % 3 < 2 THEN {_URL} ELSE 'https://s.example' END AS "itemUrl", p_name AS "rawName", p_brand AS "canonicalName", 'EXACT' AS "matchType", 'STARTUP' AS "entityType",
  CASE WHEN p_partkey % 2 = 0 THEN '0.5' ELSE '1.0' END AS confidence, CASE WHEN p_partkey % 4 = 0 THEN 'because' ELSE 'Matched via EXACT' END AS reason FROM part"""
)
def mapping_rows(spark, sf_dir):
    top = {"raw_name": F.col("p_name"), "canonical_name": F.col("p_brand"), "match_type": F.lit("EXACT"), "entity_type": F.lit("STARTUP"), "confidence": F.expr("CASE WHEN i % 2 = 0 THEN 0.5D END"), "reason": F.expr("CASE WHEN i % 4 = 0 THEN 'because' END"), "source_url": F.lit("https://s.example"), "item_url": F.expr("CASE WHEN i % 5 = 0 THEN 'https://i.example' END")}
    return publishing.mapping_rows(_record(spark, sf_dir, "ENTITY_MAPPING_LOG", {"x": F.lit(1)}, **top))


_SRC = "CASE WHEN p_partkey % 2 = 0 THEN 'Src' END AS \"Source\""
_SHOWN_AT = f"strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS \"Collected\""


def _shown(df: DataFrame) -> DataFrame:
    """Instants as texts, which both engines write alike."""
    return df.withColumns({f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") for f in df.schema.fields if f.dataType.typeName() == "timestamp"})


@query(f"SELECT p_name AS \"Startup\", CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size - 1 AS INTEGER) END AS \"Employees\", CASE WHEN p_partkey % 5 <> 0 THEN 'https://w.example' END AS \"Website\", 'AI, ' || p_brand AS \"Industries\", 'd' AS \"Description\", {_SRC}, {_SHOWN_AT} FROM part")
def dashboard_startups(spark, sf_dir):
    return _shown(dashboard.startups(_startup_records(spark, sf_dir)))


@query(f"SELECT p_name AS \"Product\", CASE WHEN p_partkey % 4 = 0 THEN 'Own' END AS \"Startup\", CASE WHEN p_partkey % 5 = 0 THEN 'FREE' END AS \"Pricing\", {_PURL} AS \"Product URL\", {_SRC}, {_SHOWN_AT} FROM part")
def dashboard_products(spark, sf_dir):
    return _shown(dashboard.products(_product_records(spark, sf_dir)))


@query(
    f"""SELECT CASE WHEN p_partkey % 3 = 0 THEN 'Top ' || p_partkey ELSE p_name END AS "Title", 'A, ' || p_type AS "Authors", strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS "Published", CASE WHEN p_partkey % 3 = 1 THEN 0 WHEN p_partkey % 2 = 0 THEN CAST(p_size - 1 AS INTEGER) END AS "GitHub Stars",
  'https://arxiv.org/abs/1' AS "Paper URL", CASE WHEN p_partkey % 3 = 0 THEN 'https://github.com/a/b' END AS "GitHub", {_SRC}, {_SHOWN_AT} FROM part"""
)
def dashboard_papers(spark, sf_dir):
    top = {"title": F.expr("CASE WHEN i % 3 = 0 THEN 'Top ' || i END"), "github_stars": F.expr("CASE WHEN i % 3 = 1 THEN 0 END").cast("int")}
    return _shown(dashboard.papers(_paper_records(spark, sf_dir, **top)))


@query(f"SELECT CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS \"Company\", 'Role' AS \"Role\", strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS \"Date\", CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS \"Remote\", {_JURL} AS \"Job URL\", {_SRC}, {_SHOWN_AT} FROM part")
def dashboard_jobs(spark, sf_dir):
    return _shown(dashboard.jobs(_job_records(spark, sf_dir)))


@query(f"SELECT p_name AS \"Title\", strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS \"Published\", {_JURL} AS \"News URL\", nullif({_URL}, '') AS \"Source\", {_SHOWN_AT} FROM part")
def dashboard_news(spark, sf_dir):
    return _shown(dashboard.news(_news_records(spark, sf_dir)))


@query("SELECT p_name AS \"Raw Name\", p_brand AS \"Canonical Name\", 'ALIAS' AS \"Match Type\", 'PRODUCT' AS \"Entity Type\", CAST(1 AS DOUBLE) AS \"Confidence\", 'r' || p_partkey AS \"Reason\" FROM part")
def dashboard_entity_logs(spark, sf_dir):
    log = part(spark, sf_dir).select(F.col("p_name").alias("raw_name"), F.col("p_brand").alias("canonical_name"), F.lit("ALIAS").alias("match_type"), F.lit("PRODUCT").alias("entity_type"), F.lit(1.0).alias("confidence"), F.concat(F.lit("r"), "i").alias("reason"))
    return dashboard.entity_logs(log)


@query("SELECT doc_id FROM documents WHERE contains(source, 'c1') OR contains(source, 'src2')")
def industry_multiselect(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(searching.any_part("source", ["c1", "src2"])).select("doc_id")


@query("SELECT r_regionkey, '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":' || CASE WHEN r_regionkey % 2 = 0 THEN '\"' || r_name || '\"' ELSE 'null' END || '}' AS record FROM region")
def record_json(spark, sf_dir):
    df = table(spark, sf_dir, "region").select("r_regionkey", F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name")).alias("r_name"))
    return publishing.records_json(df).select(F.get_json_object("record", "$.r_regionkey").cast("int").alias("r_regionkey"), "record")


@query("SELECT n_regionkey, CAST(floor((row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1) / 2) AS BIGINT) AS chunk, n_nationkey FROM nation")
def sheet_chunks(spark, sf_dir):
    df = table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey")
    return publishing.chunked(df, "n_nationkey", 2, ["n_regionkey"])


@query(
    """SELECT 'Startups' AS name, count(*) AS count, count(*) >= 1000 AS valid, CASE WHEN count(*) < 1000 THEN 'Expected >=1000 startups, found ' || count(*) || '|' ELSE '' END || 'Found ' || (count(*) - count(DISTINCT coalesce(p_brand, ''))) || ' duplicate startups' AS errors, CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM part
UNION ALL SELECT 'Products', count(*), count(*) >= 1000, CASE WHEN count(*) < 1000 THEN 'Expected >=1000 products, found ' || count(*) ELSE '' END, CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END FROM supplier
UNION ALL SELECT 'News', count(*), true, '', 'PASS' FROM nation"""
)
def dataset_checks(spark, sf_dir):
    named = part(spark, sf_dir).select(F.struct(F.col("p_brand").alias("entityName")).alias("content"))
    out = reporting.dataset_validation({"Startups": named, "Products": table(spark, sf_dir, "supplier"), "News": table(spark, sf_dir, "nation")})
    return out.withColumn("errors", F.array_join("errors", "|"))


@query(f"WITH {queries._CLAIMS_SQL} SELECT count(*) AS n, count(DISTINCT worker_id) AS workers FROM c WHERE source = 'click' AND normalized_url IN ('https://item.example/5', 'https://item.example/6')")
def claimed_items(spark, sf_dir):
    held = spark.createDataFrame([("click", "https://item.example/5"), ("click", "https://item.example/6"), ("other", "https://item.example/7")], "source string, normalized_url string")
    return claims.is_claimed(queries._requests(spark, sf_dir), held).agg(F.count("*").alias("n"), F.countDistinct("worker_id").alias("workers"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY 1")
def distinct_items(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.array("o_orderstatus").alias("statuses"))
    return merging.items_in_order(rows, ["o_custkey"], "statuses", "o_orderstatus").withColumn("statuses", F.array_join("statuses", ","))
