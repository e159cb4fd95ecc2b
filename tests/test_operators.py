"""Operators on cases with known results."""

import datetime as dt
import html
import random
from collections import Counter
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import dates, markup, pages, text, urls
from loam.operators import claims, crawling, discovery, merging, publishing, resolution, scoring, validation
from loam.plans import curation, harvest, news
from loam.sources import files

NOW = "2026-09-12 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def one(spark, values, f, kind="string"):
    """f over a column of values, as a list."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("said", "fresh"),
    [
        ("2026-09-11T13:00:00Z", True), ("2026-09-12T16:30:00+05:30", True), ("2026-09-12T10:00:00Z", True), ("2026-09-12", True), ("2026-09-10", False), ("", False),
        ("not-a-valid-date", False), ("2026-09-11T12:00:00Z", True), ("2026-09-11T11:59:59Z", False), ("2026-09-12T13:00:00Z", False), (None, False), ("2026-09-11", False),
        ("2026", False), ("12:30", False), ("Sat, 12 Sep 2026 09:00:00 GMT", True), ("12 Sep 2026 14:00:00 +0530", True),
    ],
)
def test_freshness(spark, said, fresh):
    assert one(spark, [said], lambda v: dates.is_fresh(dates.instant(v), now())) == [fresh]


def test_relative_dates(spark):
    said = ["today", "Yesterday", "3 hrs ago", "Posted 2 weeks ago", "1 month ago", "5 minutes ago", "soon", None]
    got = one(spark, said, lambda v: dates.relative(v, now()))
    at = dt.datetime(2026, 9, 12, 12)
    assert got == [at, at - dt.timedelta(1), at - dt.timedelta(hours=3), at - dt.timedelta(14), at - dt.timedelta(30), at - dt.timedelta(minutes=5), None, None]


def test_entity_keys(spark):
    names = ["OpenAI, Inc.", "OPEN_AI", "Café-Über GmbH", "Inc", "A.B.C. L.L.C.", " x  &  y co. ", None, "日本 株式会社"]
    assert one(spark, names, text.entity_key) == ["openai", "open ai", "cafe uber", "inc", "abc", "x y", "", "日本 株式会社"]
    assert one(spark, ["Ⅻ ﬁn"], lambda v: text.entity_key(text.nfkd(v), True)) == ["xii fin"]


def test_urls(spark):
    u = "HTTPS://WWW.Cursor.com/Features/?utm_source=a&x=1&y=&ref=b#top"
    assert one(spark, [u], urls.item_url) == ["https://www.cursor.com/Features/?x=1&y="]
    assert one(spark, [u], urls.storage_url) == ["https://www.cursor.com/Features?x=1&y="]
    assert one(spark, [u], urls.directory_url) == ["https://www.cursor.com/Features?x=1"]
    assert one(spark, [u], urls.clean_url) == ["https://cursor.com/Features?x=1"]
    assert one(spark, [u, "https://x.com/a", "ftp://a.b"], urls.official_url) == ["https://cursor.com/Features?x=1", None, None]
    assert one(spark, ["mailto:a@b", "https://a.b/c.pdf", "https://netflix.com/a", None], urls.item_url) == ["", "", "", ""]
    assert one(spark, ["https://arxiv.org/abs/2401.00001v2", "x"], urls.paper_id) == ["2401.00001", None]
    assert one(spark, ["https://github.com/a/b.git/", "https://github.com/a"], urls.repository) == ["a/b", None]


def test_joined_urls_agree_with_the_standard_library(spark):
    base = "https://a.example/x/y.html?q#f"
    refs = ["/p", "p/q", "//b.example/z", "https://c.example/", "?a=1", "../up", "p?x"]
    df = spark.createDataFrame([(r,) for r in refs], "r string")
    exact = [r[0] for r in df.select(urls.join(F.lit(base), F.col("r"))).collect()]
    assert exact == [urljoin(base, r) for r in refs]
    simple = [r[0] for r in df.limit(4).select(urls.join_simple(F.lit(base), F.col("r"))).collect()]
    assert simple == exact[:4]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB./?=&#:éutm_ref"), max_size=30), min_size=20, max_size=40))
def test_normal_forms_are_stable(spark, values):
    for f in (urls.storage_url, urls.directory_url, urls.clean_url):
        once = one(spark, ["https://h.example/" + v for v in values], f)
        assert one(spark, once, f) == once


def test_pages(spark):
    html = '<html><head><title>T &amp; x</title><meta property="article:published_time" content="2026-09-12T08:30:00Z"></head><body><h1> A <b>b</b></h1><a href="/2026/a-b">x</a><script>no</script><p>Free plan. $15/mo. Upload your PDF. Try it now</p></body></html>'
    assert one(spark, [html], pages.title) == ["A b"]
    assert one(spark, [html], pages.hrefs) == [["/2026/a-b"]]
    assert "no" not in one(spark, [html], text.html_text)[0].split()
    body = one(spark, [html], text.html_text)
    price = pages.pricing(F.lit(body[0]))
    assert tuple(spark.range(1).select(*price.values()).first()) == ("Freemium", "$15/month", True, None)
    assert one(spark, body, pages.inputs) == [["PDF / Document"]]
    assert one(spark, body, lambda b: pages.status(F.lit(""), b, F.lit(html))) == ["Active"]
    assert one(spark, [html, "<", None], lambda v: pages.date_candidates(v, F.lit("NEWS"))) == [["2026-09-12T08:30:00Z"], [], []]
    ld = '<script type="application/ld+json">{"@graph":[{"@type":"JobPosting","datePosted":"2026-09-11"}]}</script>'
    assert one(spark, [ld], lambda v: pages.date_candidates(v, F.lit("JOB"))) == [["2026-09-11"]]


def test_links_of_listings(spark):
    html = '<a href="/2026/09/12/one/?utm_source=x">1</a><a href="https://techcrunch.com/2026/09/12/one/">same</a><a href="/login">no</a><a href="/2026/09/12/two#c">2</a>'
    df = spark.createDataFrame([("s", "https://techcrunch.com/category/ai/", html)], "source string, url string, html string")
    got = [r.link for r in crawling.candidate_links(df, "source").orderBy("position").collect()]
    assert got == ["https://techcrunch.com/2026/09/12/one/", "https://techcrunch.com/2026/09/12/two"]


def test_fresh_items_end_to_end(spark):
    listing = [("s", "https://n.example/list", '<a href="/a/1">x</a><a href="/a/2">y</a><a href="/a/1#z">x</a>')]
    items = [("https://n.example/a/1", '<h1>One</h1><time datetime="2026-09-12T01:00:00Z"></time>', True), ("https://n.example/a/2", "<h1>Two</h1>", True)]
    got = news.fresh_items(spark.createDataFrame(listing, "source string, url string, html string"), spark.createDataFrame(items, "url string, html string, success boolean"), now(), "NEWS")
    rows = {r.link: r for r in got.collect()}
    assert {u[-1]: r.freshness for u, r in rows.items()} == {"1": "fresh", "2": "missing_or_invalid_date"}
    assert {(r.source, r.rows, r.fresh, r.missing) for r in news.summary(got).collect()} == {("s", 2, 1, 1), (None, 2, 1, 1)}


def tool(**values):
    base = {c: None for c in schemas.TOOL | schemas.STAGE} | {c: [] for c in schemas.LISTS}
    return base | {"discovery_references": [], "tool_name": "Tool", "official_website": "https://tool.example", "verification_status": "verified", "short_description": "does a thing", "detailed_overview": "does a thing at length"} | values


def frame(spark, *tools):
    schema = "input_idx long, " + schemas.columns(schemas.TOOL | schemas.STAGE)
    names = [*(schemas.TOOL | schemas.STAGE)]
    return spark.createDataFrame([(i, *[t[c] for c in names]) for i, t in enumerate(tools)], schema)


def test_scores_tiers_and_rejections(spark):
    rich = tool(
        primary_task="Coding", categories=["Developer"], inputs=["a", "b"], outputs=["c", "d"], supported_platforms=["Web", "iOS"], ai_capabilities=["x", "y"], key_features=["z", "w"], api_availability="REST API",
        detailed_overview="o" * 61, short_description="s" * 21, main_use_cases=["u", "v"], usage_adoption_signals="12000 users", current_status="Active", company_developer="Dev", version="2", pricing_model="Paid",
        launch_date=dt.datetime(2026, 1, 1), logo_url="https://tool.example/l.png",
    )
    rows = scoring.score(frame(spark, tool(), rich, rich | {"current_status": "Deprecated"}, rich | {"official_website": "https://creati.ai/x"}, rich | {"current_status": "Discontinued"}), now())
    got = rows.withColumn("why", scoring.rejection()).orderBy("input_idx").collect()
    assert got[0].quality_score < 60 and got[0].why.startswith("Quality score") and got[0].quality_tier == "Reject"
    assert got[1].quality_score == 99.0 and got[1].why is None and got[1].quality_score_rationale == (
        "Tier: Exceptional (99.0/100). Capability: 25.0/25 (Task: Coding, Modalities (2 in, 2 out), Platforms (2), API verified) | Usefulness: 20.0/20 (High workflow utility domain, Documented problem solving, 2 use cases)"
        " | Adoption: 14.0/15 (Verified signals: 12000 users, Active live service) | Activity: 15.0/15 (Active verified status) | Maturity: 10.0/10 (Developer: Dev, Dedicated domain, Version: 2, Pricing: Paid)"
        " | Recency: 5.0/5 (Launched within 1 year (2026)) | Differentiation: 5.0/5 (Multi-modal pipeline, Cross-platform support, Programmable API)"
        " | Info Quality: 5.0/5 (Official website verified, Official logo verified, Pricing model verified, Descriptions verified)"
    )
    assert got[2].why == "Tool status is inactive/deprecated: 'deprecated'" and got[3].why.startswith("Directory URL") and got[4].why is None
    edges = [95.0, 90.0, 85.0, 80.0, 75.0, 70.0, 65.0, 59.9, 40.0]
    assert one(spark, edges, scoring.tier, "double") == ["Exceptional"] * 2 + ["Excellent"] * 2 + ["Good"] * 2 + ["Average / Skip"] + ["Reject"] * 2


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({}, None), ({"tool_name": " "}, "Identity: missing or empty tool_name"), ({"official_website": None}, "Identity: missing canonical"), ({"verification_status": "unverified"}, "Verification: invalid"),
        ({"official_website": "https://www.toolify.ai/x"}, "Verification: directory"), ({"short_description": ""}, "Description: missing short"), ({"detailed_overview": "A miracle."}, "Description Quality: contains marketing hype word 'miracle'"),
        ({"detailed_overview": "Only $5 / seat"}, "Description Grounding"), ({"country": "None"}, "Data Cleanliness: field 'country'"), ({"tags": ["ok", "TBD"]}, "Data Cleanliness: list field 'tags'"),
        ({"version": "<TODO>"}, "Null Correctness: field 'version'"), ({"logo_url": "https://other.example/l.png"}, "Official Links: logo host"), ({"logo_url": "https://cdn.tool.example/l.png"}, None),
    ],
)
def test_gates(spark, change, error):
    errors = validation.validate(frame(spark, tool(**change))).first().errors
    assert (errors == []) if error is None else any(e.startswith(error) for e in errors)


def test_later_rows_of_a_site_fail_even_after_a_failing_one(spark):
    rows = frame(spark, tool(tool_name=""), tool(), tool(official_website="https://www.tool.example/p?x"))
    passed, failed = validation.split_valid(validation.validate(rows))
    assert passed.count() == 0 and failed.count() == 3


def merged(spark, *tools):
    return merging.merge_duplicates(frame(spark, *tools).repartition(3)).orderBy("input_idx").collect()


def test_merging(spark):
    ref = lambda s: [(s, s, f"{s}/x", None)]
    got = merged(spark, tool(tool_name="Cursor", official_website="https://www.cursor.com", categories=["a"], discovery_references=ref("one")), tool(tool_name="Cursor by X", official_website="https://cursor.com/features", categories=["b", "a"], discovery_references=ref("two")))
    assert len(got) == 1 and got[0].tool_name == "Cursor" and got[0].categories == ["a", "b"] and len(got[0].discovery_references) == 2 and got[0].domain_matches == 1
    assert len(merged(spark, tool(tool_name="Writer", official_website="https://writer.com"), tool(tool_name="Writer", official_website="https://aiwriter.io"))) == 2
    got = merged(spark, tool(tool_name="V", official_website="https://v0.dev/?utm_source=d", verification_status="unverified"), tool(tool_name="V0", official_website="https://v0.dev", company_developer="D"))
    assert (len(got), got[0].verification_status, got[0].company_developer, got[0].official_website) == (1, "verified", "D", "https://v0.dev")
    got = merged(spark, tool(tool_name="N", official_website=None, company_developer="A"), tool(tool_name="n", official_website=None, company_developer="B"), tool(tool_name="N", official_website=None, version="3"))
    assert len(got) == 2 and got[1].version == "3" and got[1].name_matches == 1


def test_curation_end_to_end(spark):
    rows = frame(spark, tool(current_status="Active", company_developer="D", pricing_model="Free", categories=["Design"], primary_task="Design", usage_adoption_signals="9 users", inputs=["a", "b"], outputs=["c"], supported_platforms=["Web", "iOS"]), tool(tool_name="Bad", official_website="https://bad.example"))
    done = curation.curate(rows, now())
    report = done.report(raw=9).first()
    assert (report.raw_candidates_discovered, report.candidates_after_deduplication, report.candidates_rejected, report.final_qualifying_count, report.validation_failures, report.candidates_verified) == (9, 2, 1, 1, 0, 2)
    assert report.source_distribution == {"Unknown": 1} and sum(report.score_distribution.values()) == 2
    assert done.published().columns == list(schemas.TOOL)


SEEDS = [("OpenAI", ["OpenAI, Inc.", "Open AI"], ["ChatGPT", "Sora"]), ("Other", ["OAI"], ["Sora"])]


def test_resolution(spark):
    dims = resolution.dimensions(resolution.seed_catalog(spark, SEEDS))
    rows = [("OPENAI", "STARTUP", None), ("Open AI", "startup", None), ("Nobody", "STARTUP", None), ("chatgpt", "PRODUCT", "OpenAI, Inc."), ("ChatGPT", "PRODUCT", None), ("Sora", "PRODUCT", None), ("Sora", "PRODUCT", "Nobody"), ("x", "NEWS", None), (None, "STARTUP", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, raw_name string, entity_type string, startup_context string")
    got = [(r.canonical_name, r.match_method, r.owner) for r in resolution.resolve(df, dims).orderBy("i").collect()]
    assert got == [
        ("OpenAI", "EXACT", None), ("OpenAI", "ALIAS", None), ("Nobody", "UNRESOLVED", None), ("ChatGPT", "EXACT", "OpenAI"), ("ChatGPT", "EXACT", "OpenAI"), ("Sora", "UNRESOLVED", None),
        ("Sora", "UNRESOLVED", "Nobody"), ("x", "UNRESOLVED", None), ("", "UNRESOLVED", None),
    ]


def test_harvests(spark):
    dims = resolution.dimensions(resolution.seed_catalog(spark, SEEDS))
    startups = [(0, "Open AI", "https://o.example", None, 5, ["AI"], "d", "s", "https://s"), (1, "OpenAI Inc", "https://o2.example", None, 1, [], "d", "s", "https://s"), (2, "N", None, "n.example", None, None, None, "s", "https://s"), (3, "No site", None, None, None, None, None, "s", "https://s")]
    df = spark.createDataFrame(startups, "input_idx int, entityName string, company_url string, website string, employeeCount int, industries array<string>, description string, source_name string, source_url string")
    assert [r.content.entityName for r in harvest.startups(df, dims, now()).collect()] == ["OpenAI"]
    products = [(0, "Sora", "OpenAI", "free", "u1", "s", "https://s"), (1, "sora", "Open AI", None, "u2", "s", "https://s"), (2, "Sora", "Other", None, "u3", "s", "https://s"), (3, "Odd", None, "cheap", "u", "s", "https://s")]
    df = spark.createDataFrame(products, "input_idx int, productName string, startupName string, pricingModel string, product_url string, source_name string, source_url string")
    assert {(r.content.productName, r.content.startupName, r.content.pricingModel) for r in harvest.products(df, dims, now()).collect()} == {("Sora", "OpenAI", "FREE"), ("Sora", "Other", None)}


def test_atom_feeds(spark):
    entry = "<entry><id>http://arxiv.org/abs/2401.0000{0}v1</id><title>A\n  title</title><published>2024-01-01T00:00:00Z</published><author><name>X</name></author><author><name>Y</name></author></entry>"
    feed = "<feed>" + entry.format(1) + entry.format(2) + "<entry><id>http://arxiv.org/abs/1</id></entry></feed>"
    df = spark.createDataFrame([(0, feed)], "input_idx int, xml string")
    got = files.atom_entries(df, F.col("xml")).orderBy("arxiv_id").collect()
    assert [(r.arxiv_id, r.title, r.authors) for r in got] == [("2401.00001", "A title", ["X", "Y"]), ("2401.00002", "A title", ["X", "Y"])]


def test_claims(spark):
    rows = [("s", "https://a.example/x?utm_source=1", "w1", 1), (" s", "https://a.example/x#f", "w2", 2), ("s", "https://a.example/y", "w2", 3), ("s", "", "w3", 4)]
    df = spark.createDataFrame(rows, "source string, url string, worker_id string, event_order long")
    none = spark.createDataFrame([], "source string, normalized_url string")
    won = claims.claim(df, none)
    assert {(r.normalized_url[-1], r.worker_id) for r in won.collect()} == {("x", "w1"), ("y", "w2")}
    assert claims.claim(df, won).count() == 0


def test_claims_on_a_stream(spark, tmp_path):
    from loam.streaming import claims as stream

    events = [("s", "https://a.example/x", "w2", "CLAIM", 2), ("s", "https://a.example/x/", "w1", "CLAIM", 1), ("s", "https://a.example/x", "w1", "COMPLETE", 3), ("s", "https://a.example/y", "w1", "CLAIM", 4), ("s", "https://a.example/y", "w1", "RELEASE", 5), ("s", "https://a.example/y", "w9", "CLAIM", 6)]
    schema = "source string, url string, worker_id string, event string, event_order long"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = stream.claims(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()

    run(events[:4])
    run(events[4:])  # a restart finds the state of the first run
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("event_order").collect()
    assert [(r.normalized_url[-1], r.worker_id, r.status) for r in got] == [("x", "w1", "CLAIMED"), ("x", "w1", "COMPLETED"), ("y", "w1", "CLAIMED"), ("y", None, "FREE"), ("y", "w9", "CLAIMED")]


def test_published_rows_come_back(spark):
    df = frame(spark, tool(free_plan=True, categories=["a", "b"], launch_date=dt.datetime(2026, 1, 2, 3, 4, 5), quality_score=66.0, quality_score_breakdown={"b": 1.5, "a": 2.0}), tool(country="null"))
    rows = publishing.tool_rows(df)
    assert (rows.first().free_plan, rows.first().categories, rows.first().quality_score_breakdown) == ("True", "a, b", '{"a": 2.0, "b": 1.5}')
    assert publishing.read_tool_rows(rows).orderBy("free_plan").collect()[-1] == df.select(*schemas.TOOL).first()
    assert [(r.column, r.value) for r in publishing.bad_cells(rows).collect()] == [("country", "null")]


def test_tables_are_published_and_surplus_ones_go(spark, tmp_path):
    good, bad = spark.createDataFrame([("x", "1"), ("y", "")], "a string, b string"), spark.createDataFrame([("NaN", "")], "a string, b string")
    good.write.parquet(str(tmp_path / "old"))
    for kind in ("parquet", "csv", "json"):
        report = {r["name"]: (r.records, r.bad_cells, r.written) for r in publishing.publish({"good": good, "bad": bad}, str(tmp_path), kind).collect()}
        assert report == {"good": (2, 0, True), "bad": (1, 1, False)}
        reader = spark.read.schema("a string, b string").option("header", True).option("nullValue", "zz")
        assert reader.format(kind).load(str(tmp_path / "good")).count() == 2
    assert publishing.surplus(spark, str(tmp_path), ["good"]) == ["old"]
    publishing.publish({"good": good}, str(tmp_path), clean=True)
    assert publishing.surplus(spark, str(tmp_path), []) == ["good"]
    publishing.write_report(spark.createDataFrame([(1, None)], "n int, s string"), str(tmp_path / "report"))
    assert spark.read.text(str(tmp_path / "report")).first()[0] == '{"n":1,"s":null}'


def test_export_checks_and_publishes(spark, tmp_path):
    startup = spark.createDataFrame([("1.0", None, ("S", "https://s.example"), ("Acme", (3, None, None, ["AI"], "d")), dt.datetime(2026, 1, 2))], schemas.STARTUP)
    log = startup.select("schemaVersion", F.lit(None).cast("string").alias("recordType"), "source", F.lit("a").alias("raw_name"), F.lit("A").alias("canonical_name"), F.lit("STARTUP").alias("entity_type"), F.lit(None).cast("string").alias("source_url"), F.lit("ALIAS").alias("match_type"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("item_url"), F.lit(None).cast("string").alias("reason"))
    got = {r["name"]: r for r in publishing.export({"Startups": startup, "Entity Mapping Log": log}, str(tmp_path)).collect()}
    assert got["Startups"].verdict == "FAIL" and got["Startups"].written and got["Entity Mapping Log"].verdict == "PASS" and got["Entity Mapping Log"].records == 1
    assert spark.read.parquet(str(tmp_path / "Startups")).first().itemUrl == "https://s.example" and spark.read.parquet(str(tmp_path / "Entity Mapping Log")).first().reason == "Matched via ALIAS"
    assert publishing.export({"Startups": startup}).count() == 1


def test_catalogs_come_from_files(spark, tmp_path):
    (tmp_path / "seeds.json").write_text('[{"canonical_name": "OpenAI", "aliases": ["Open AI"], "products": ["Sora"]}, {"canonical_name": "Other", "aliases": [], "products": []}]')
    dims = resolution.dimensions(resolution.catalog_file(spark, str(tmp_path / "seeds.json")))
    got = resolution.resolve_startups(spark.createDataFrame([("open ai",), ("other",), ("x",)], "raw_name string"), dims).orderBy("raw_name").collect()
    assert [(r.canonical_name, r.match_method) for r in got] == [("OpenAI", "ALIAS"), ("Other", "EXACT"), ("x", "UNRESOLVED")]


def test_unknown_kinds_are_refused(spark):
    with pytest.raises(ValueError):
        crawling.keep_crawled(spark.createDataFrame([], schemas.CRAWL), now(), "RESEARCH")


def test_json_arrays(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"a": 1, "b": "x"}, {"a": 2}]')
    (tmp_path / "bad.json").write_text('[{"a": 1, "b": "x"}, {"a": ')
    read = lambda name, **k: files.json_array(spark, str(tmp_path / name), "a int, b string", **k).collect()
    assert [(r.a, r.b) for r in read("good.json")] == [(1, "x"), (2, None)] and read("bad.json") == [] and read("none.json") == []
    assert len(read("good.json", required=True)) == 2 and files.records(spark, str(tmp_path / "good.json")) == 2 and files.records(spark, str(tmp_path / "bad.json")) == 0
    for name in ("none.json", "bad.json"):
        with pytest.raises(Exception):  # noqa: B017, PT011
            read(name, required=True)


def test_entities_agree_with_the_standard_library(spark):
    values = ["plain", "a &amp; b &lt;i&gt;", "&amp;lt; once", "&#65;&#x41;&#X1F600; &#0; &#128; &#xD800;", "&copy 2020 &copy; &notit; &notin; &nope; & &&;", "&eacute;&Eacute &ampx", "", None, "&#8217;s&nbsp;x"]
    assert one(spark, values, text.unescaped) == [None if v is None else html.unescape(v) for v in values]


def greedy(rows):
    """The merge by its definition, on (order, name, developer, host, address) in order: the kept one of each row."""
    by_site, by_name, kept = {}, {}, {}
    for i, name, dev, site in sorted(rows):
        match = by_site.get(site) if site else None
        if match is None and name in by_name:
            other = by_name[name]
            if len({site, kept[other][1]} - {""}) < 2 and len({dev, kept[other][0]} - {""}) < 2:
                match = other
        if match is None:
            kept[i] = [dev, site]
            by_name[name] = i
            if site:
                by_site[site] = i
            yield i, i
        else:
            kept[match] = [kept[match][0] or dev, kept[match][1] or site]
            yield i, match


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_against_a_plain_version(spark, seed):
    draw = random.Random(seed)
    rows = [(i, f"n{draw.randrange(12)}", draw.choice(["", "", "d1", "d2"]), draw.choice(["", f"s{draw.randrange(15)}.example"])) for i in range(70)]
    tools = [tool(tool_name=n, company_developer=d or None, official_website=f"https://{s}/" if s else None) for _, n, d, s in rows]
    out = merged(spark, *tools)
    want = Counter(rep for _, rep in greedy(rows))
    assert {r.input_idx: 1 + r.domain_matches + r.url_matches + r.name_matches for r in out} == want


def test_discovery_stops_at_its_limit(spark):
    names = ["A1", "B1", "a1", "C1", "b1", "A1"]
    made = [(f"c{i}", n, None, f"https://d.example/{i}", "S", "s", f"about {i}", [f"k{i}"], [], {"external_product_url": None}, [("S", "s", "u", "t")], "t", i) for i, n in enumerate(names)]
    df = spark.createDataFrame(made, discovery.CANDIDATE)
    assert [(r.input_idx, r.found, r.categories) for r in discovery.merge_candidates(df).orderBy("input_idx").collect()] == [(0, 3, ["k0", "k2", "k5"]), (1, 2, ["k1", "k4"]), (3, 1, ["k3"])]
    assert [(r.input_idx, r.found) for r in discovery.merge_candidates(df, 2).orderBy("input_idx").collect()] == [(0, 1), (1, 1)]
    assert [(r.input_idx, r.found) for r in discovery.merge_candidates(df, 3).orderBy("input_idx").collect()] == [(0, 2), (1, 1), (3, 1)]
    assert discovery.merge_candidates(df.where("false")).count() == 0


def test_markup_of_broken_pages():
    page = markup.read("<div class='a b'><p>one<br>two</p><img src=x><ul><li>1<li>2</ul></span></div><p>last")
    assert [e.tag for e in page.walk()] == ["div", "p", "br", "img", "ul", "li", "li", "p"] and page.first(markup.tag("p")).text("|") == "one|two"
    assert page.first(lambda e: e.has_class("b")).class_part("a") and markup.read(None).text() == "" and markup.read("<" * 50_000 + "a>").text(strip=False) is not None
    deep = markup.read("<div>" * 20_000 + "x")
    assert deep.text() == "x" and sum(1 for _ in deep.walk()) == 20_000


def by_sql(spark, where, name, **tables):
    """Rows of a query and of its SQL, sorted, on tables that are written to a folder."""
    import duckdb

    from loam import registry

    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{where}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{where}/{table}.parquet/*.parquet')")
    got = [tuple(r) for r in registry.QUERIES[name](spark, str(where)).collect()]
    return sorted(got, key=repr), sorted(con.execute(registry.ORACLE_SQL[name]).fetchall(), key=repr)


@pytest.mark.parametrize("name", ["html_to_text", "page_title_coalesce"])
def test_page_queries_read_the_entities_of_their_sql(spark, tmp_path, name):
    heads = ["a &amp b", "&amp;lt; &lt;i&gt;", "&quot;x&quot; &copy &copy; &#39;", "&eacute;&middot;", "cut &am"]
    rows = [(i, f"<title>t{i}</title><body><h1>{h}</h1><p>{h} c</p></body>") for i, h in enumerate(heads)]
    got, want = by_sql(spark, tmp_path, name, pages=(rows, "page_id long, html string"))
    assert got == want
    assert one(spark, ["<h1>a &amp b &eacute;</h1>"], pages.title) == ["a & b é"]


def test_pages_of_one_url_are_merged_by_id(spark, tmp_path):
    rows = [(i, f"https://a.example/{i % 4}", "<p>x</p>") for i in range(24)]
    got, want = by_sql(spark, tmp_path, "crawl_status_merge", pages=(rows, "page_id long, url string, html string"))
    assert got == want


def test_results_of_a_browser_do_not_multiply_pages(spark):
    schema = "url string, status_code int, html string, success boolean"
    plain = spark.createDataFrame([("u", 503, "", False), ("v", 503, "", False), ("w", 200, "x" * 600, True)], schema)
    browser = spark.createDataFrame([("u", 200, "b", True), ("u", 200, "a", True), ("v", 500, "", False), ("w", 200, "c", True)], schema)
    out = crawling.with_browser(plain, browser).select("url", "used_browser", "status_code", "html").collect()
    assert sorted(map(tuple, out)) == [("u", True, 200, "a"), ("v", False, 503, ""), ("w", False, 200, "x" * 600)]


def test_support_counts_words_within_words(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abé", k=draw.randrange(3, 9)))
    for size in (0, 5, 300, 9000):
        claim, source = ("\t ".join(word() for _ in range(size)) for _ in range(2))
        words = [w for w in claim.split() if len(w) > 4]
        want = sum(w in source for w in words) / len(words) if words else 1.0
        assert text._supported(claim, source) == want
    rows = [("Longer words Longer", "xlongerx"), (None, "x"), ("wordy", None), ("first\x1cword", "afirst\x1cwordb")]
    df = spark.createDataFrame(rows, "c string, s string")
    assert [r[0] for r in df.coalesce(1).select(text.support_ratio(F.col("c"), F.col("s"))).collect()] == [2 / 3, 1.0, 0.0, 1.0]


def test_support_of_a_long_text_is_found_in_time():
    import time

    claim = " ".join(f"word{i}" for i in range(60_000))
    begin = time.perf_counter()
    assert text._supported(claim, claim[::-1]) < 0.01
    assert time.perf_counter() - begin < 20


def test_a_stream_has_few_states_for_many_items(spark, tmp_path):
    from loam.streaming import claims as stream

    draw = random.Random(6)
    events = ("CLAIM", "COMPLETE", "FAIL", "RELEASE")
    rows = [("s", f"https://a.example/{draw.randrange(60)}", f"w{draw.randrange(3)}", draw.choice(events), k) for k in range(600)]
    schema = "source string, url string, worker_id string, event string, event_order long"
    held, want = {}, []
    for source, url, worker, event, order in rows:
        had = held.get(url)
        if event == "CLAIM" and had is None:
            held[url] = (worker, "CLAIMED")
        elif event in ("COMPLETE", "FAIL") and had:
            held[url] = (had[0], {"COMPLETE": "COMPLETED", "FAIL": "FAILED"}[event])
        elif event == "RELEASE" and had:
            held[url] = None
        else:
            continue
        want.append((source, url, *(held[url] or (None, "FREE")), order))
    for part in (rows[:300], rows[300:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = stream.claims(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), buckets=4).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=lambda r: r[-1]) == want


def test_plain_urls_are_what_storage_urls_are(spark):
    cases = {"https://a.b/c": "https://a.b/c", "https://a.b/": "https://a.b", "https://a.b": "https://a.b", "https://A.b/c": "https://a.b/c", "HTTPS://a.b/C": "https://a.b/C", "https://a.b/c?": "https://a.b/c", "https://a.b/c#d": "https://a.b/c", "https://a.b/c//": "https://a.b/c", "https://a.b?ref=x": "https://a.b", " https://a.b/C d ": "https://a.b/C d", "https://É.b/c": "https://é.b/c", "https:///c/": "https:///c/"}
    assert one(spark, list(cases), urls.storage_url) == list(cases.values())
