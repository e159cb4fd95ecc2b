"""Discovery of products: what listings and interfaces give, fetch outcomes, and the merge of candidates across sources."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import markup, pages, text, urls
from loam.operators import merging
from loam.operators.resolution import first_of, ranked

# The directories, and the paths of one that are no products.
TABLE_SITE, TABLE_HOST = "https://theresanaiforthat.com/", "theresanaiforthat.com"
CARD_SITE, CARD_HOST = "https://creati.ai/ai-tools/", "creati.ai"
CARD_NAVIGATION = ("/ai-tools/month", "/ai-tools/new", "/ai-tools/ranking", "/ai-tools/most-", "/ai-tools/platform", "/ai-tools/pricing", "/ai-tools/tag", "/ai-tools/categories")
COMPANY_PAGE, MODEL_PAGE = "https://www.ycombinator.com/companies/", "https://huggingface.co/"
STATUS_TEXTS = {403: "HTTP 403 Forbidden — site blocked automated access", 404: "HTTP 404 Not Found", 429: "HTTP 429 Too Many Requests"}

CANDIDATE = (
    "candidate_id string, tool_name string, company_developer string, discovered_url string, discovery_source string, discovery_source_url string, short_description string, "
    f"categories array<string>, tags array<string>, raw_metadata map<string,string>, discovery_references array<{schemas.REFERENCE}>, discovery_timestamp string, input_idx long"
)


def fetch_error(status_code: Column, reason: Column) -> Column:
    """Why a page could not be had; null if it could. Without a status the connection failed, for the reason given."""
    out = F.when(status_code.isNull(), F.when(F.lower(reason).contains("timed out"), "Request timed out").otherwise(F.concat(F.lit("Connection error: "), F.coalesce(reason, F.lit("unknown")))))
    for code, said in STATUS_TEXTS.items():
        out = out.when(status_code == code, said)
    return out.when(status_code >= 400, F.concat(F.lit("HTTP Error "), status_code.cast("string"), F.lit(": "), F.coalesce(reason, F.lit(""))))


def source_status(fetches: DataFrame, found: DataFrame, source: str = "discovery_source") -> DataFrame:
    """For each source: pages_attempted, failed_requests, candidates and status: PASS with candidates, FAIL if a request failed,
    else EMPTY. fetches: source, status_code."""
    tried = fetches.groupBy(source).agg(F.count("*").alias("pages_attempted"), F.count_if(F.coalesce(F.col("status_code") != 200, F.lit(True))).alias("failed_requests"))
    counts = found.groupBy(F.col(source).alias("of")).agg(F.count("*").alias("candidates"))
    out = tried.join(counts, F.col(source) == F.col("of"), "left").drop("of").fillna(0, ["candidates"])
    return out.withColumn("status", F.when(F.col("candidates") > 0, "PASS").when(F.col("failed_requests") > 0, "FAIL").otherwise("EMPTY"))


def is_table_page(url: Column) -> Column:
    """Whether an address is a product's page of the directory that lists by rows."""
    p = urls.parts(url)
    return F.contains(p.host, F.lit(TABLE_HOST)) & F.startswith(p.path, F.lit("/ai/"))


def is_card_page(href: Column) -> Column:
    """Whether a link is a product's page of the directory that lists by cards: /ai-tools/ and one part more."""
    path = F.substring_index(href, "?", 1)
    navigation = F.regexp_like(href, F.lit("^(?:" + "|".join(CARD_NAVIGATION) + ")"))
    return F.startswith(href, F.lit("/ai-tools/")) & ~navigation & (F.size(F.split(F.trim(path, F.lit("/")), "/")) == 2)


_ROW = "struct<href:string,name:string,description:string,category:string,author:string,said:string>"
_CARD = "struct<href:string,name:string,description:string,categories:array<string>,external:string>"
_LINK = "struct<href:string,name:string,said:string>"


def _parsed(html: Column, kind: str, one: Callable[[markup.Element], list[tuple]]) -> Column:
    """What `one` reads from each page, as an array of structs."""
    names = [f.split(":")[0] for f in kind.removeprefix("struct<").removesuffix(">").replace("array<string>", "list").split(",")]

    def run(part):
        return pd.Series([[dict(zip(names, row, strict=True)) for row in one(markup.read(p))] for p in part])

    run.__annotations__ = {"part": pd.Series, "return": pd.Series}  # as objects, which annotations of this module aren't
    return F.pandas_udf(run, f"array<{kind}>")(html)


def _table_rows(page: markup.Element) -> list[tuple]:
    """What each row of a listing says, as it stands there."""
    rows = page.all(lambda e: e.has_class("listing-table-row", "home-listing-row", "home-today-row"))
    rows = rows or page.all(lambda e: e.has_class("ai", "tool") or "listing" in e.attrs.get("class", ""))
    out = []
    for row in rows:
        cells = {part: row.first(lambda e, part=part: e.class_part(part)) for part in ("name-cell", "topic-cell", "author-cell")}
        href = name = description = ""
        if (cell := cells["name-cell"]) is not None:
            links = cell.all(markup.tag("a"))
            if links:
                href, name = links[0].attrs.get("href", ""), links[0].text()
                description = links[1].text() if len(links) > 1 else ""
        elif link := row.first(lambda e: e.tag == "a" and "/ai/" in e.attrs.get("href", "")):
            href, name = link.attrs["href"], link.text()
            paragraph = row.first(markup.tag("p"))
            description = paragraph.text() if paragraph is not None else ""
        linked = [cells[c].first(markup.tag("a")) if cells[c] is not None else None for c in ("topic-cell", "author-cell")]
        category, author = (a.text() if a is not None else "" for a in linked)
        out.append((href, name, description, category, author, row.text(" ", strip=False)))
    return out


def _cards(page: markup.Element) -> list[tuple]:
    """What each card says that links to a product's page."""
    cards = page.all(lambda e: e.has_class("cardContainer"))
    cards = cards or page.all(lambda e: (e.tag == "li" and "display:grid" in e.attrs.get("style", "")) or "card" in e.attrs.get("class", "")) or page.all(markup.tag("li"))
    out = []
    for card in cards:
        link = card.first(lambda e: e.tag == "a" and e.attrs.get("href", "").startswith("/ai-tools/") and not e.attrs["href"].startswith(CARD_NAVIGATION))
        if link is None:
            continue
        heading, image = card.first(markup.tag("h3")), card.first(markup.tag("img"))
        name = (heading.text() if heading is not None else "") or (image.attrs.get("alt", "").strip() if image is not None else "") or link.text()
        about = card.first(lambda e: e.class_part("description"))
        categories = dict.fromkeys(t for e in card.all(lambda e: e.has_class("category-tag", "categoriedTag")) if (t := e.text()))
        others = [a.attrs.get("href", "") for a in card.all(markup.tag("a"))]
        external = next((h for h in others if h.startswith("http") and CARD_HOST not in urlsplit(h).netloc.lower()), None)
        out.append((link.attrs["href"], name, about.text() if about is not None else None, list(categories), external))
    return out


def _product_links(page: markup.Element) -> list[tuple]:
    """Links to products' pages, each address once, with their names and what the cards around them say."""
    out, seen = [], set()
    for a in page.all(lambda e: e.tag == "a" and "/ai/" in e.attrs.get("href", "")):
        href = a.attrs["href"].strip()
        if not href or href in seen:
            continue
        seen.add(href)
        name = a.text(strip=False).strip()
        if len(name) < 2 and (span := a.parent.first(markup.tag("span"))) is not None:
            name = span.text(strip=False).strip() or name
        card = a.parent
        while card.parent is not None and card.tag != "div":
            card = card.parent
        card = card if card.tag == "div" else a.parent
        out.append((href, name, card.text(" ", strip=False)))
    return out


def _candidates(rows: DataFrame, source: str, site: str, at: Column, metadata: Column, slug: Column) -> DataFrame:
    """Candidates of rows (page, position, tool_name, company_developer, discovered_url, short_description, categories), the
    first of each address on its page."""
    reference = F.struct(F.lit(source).alias("source"), F.lit(site).alias("source_url"), F.col("discovered_url"), at.alias("discovered_at"))
    made = rows.select(
        "page",
        "position",
        F.concat(F.lit("candidate-"), slug).alias("candidate_id"),
        "tool_name",
        "company_developer",
        "discovered_url",
        F.lit(source).alias("discovery_source"),
        F.lit(site).alias("discovery_source_url"),
        F.nullif("short_description", F.lit("")).alias("short_description"),
        "categories",
        F.transform("categories", F.lower).alias("tags"),
        metadata.alias("raw_metadata"),
        F.array(reference).alias("discovery_references"),
        at.alias("discovery_timestamp"),
    )
    return first_of(made, ["page", "discovered_url"], ["position"])


def table_candidates(listings: DataFrame, at: Column, page: str = "url", html: str = "html", source: str = "There's An AI For That") -> DataFrame:
    """Candidates of listings by rows. "X by Y" names product and developer, unless the row has a developer of its own."""
    rows = listings.select(F.col(page).alias("page"), F.posexplode(_parsed(F.col(html), _ROW, _table_rows)).alias("position", "r")).select("page", "position", "r.*")
    full = urls.join_simple(F.lit(TABLE_SITE), F.col("href"))
    rows = rows.where(is_table_page(full)).withColumn("discovered_url", urls.directory_url(full))
    own = F.trim(F.substring_index(F.trim(F.regexp_replace("author", r"[\x{10000}-\x{10FFFF}]", "")), "@", 1))
    own = F.when((F.length("author") > 1) & (F.length(own) > 1), own)
    split = F.split("name", " by ", 2)
    named = F.size(split) > 1
    rows = rows.withColumns(
        {
            "tool_name": F.when(named, F.trim(F.get(split, F.lit(0)))).otherwise(F.col("name")),
            "company_developer": F.coalesce(own, F.when(named, F.trim(F.get(split, F.lit(1))))),
            "short_description": F.col("description"),
            "categories": F.filter(F.array("category"), lambda c: c != ""),
        }
    )
    slug = F.element_at(F.split(F.rtrim("discovered_url", F.lit("/")), "/"), -1)
    metadata = F.create_map(F.lit("source_slug"), slug, F.lit("pricing_hint"), pages.pricing_hint(F.col("said")))
    return _candidates(rows, source, TABLE_SITE, at, metadata, slug)


def card_candidates(listings: DataFrame, at: Column, page: str = "url", html: str = "html", source: str = "Creati.ai") -> DataFrame:
    """Candidates of listings by cards; names of one character are none."""
    rows = listings.select(F.col(page).alias("page"), F.posexplode(_parsed(F.col(html), _CARD, _cards)).alias("position", "r")).select("page", "position", "r.*")
    rows = rows.where(is_card_page(F.col("href")) & (F.length("name") >= 2))
    rows = rows.withColumns(
        {
            "discovered_url": urls.directory_url(urls.join_simple(F.lit("https://creati.ai"), F.col("href"))),
            "tool_name": F.col("name"),
            "company_developer": F.lit(None).cast("string"),
            "short_description": F.col("description"),
        }
    )
    slug = F.get(F.split(F.trim(F.substring_index("href", "?", 1), F.lit("/")), "/"), F.lit(1))
    metadata = F.create_map(F.lit("source_slug"), slug, F.lit("external_product_url"), F.when(F.col("external").isNotNull(), urls.directory_url(F.col("external"))))
    return _candidates(rows, source, CARD_SITE, at, metadata, slug)


def linked_products(listings: DataFrame, page: str = "url", html: str = "html") -> DataFrame:
    """(page, position, productName, startupName, pricingModel, product_url) of listings that only link to products."""
    rows = listings.select(F.col(page).alias("page"), F.posexplode(_parsed(F.col(html), _LINK, _product_links)).alias("position", "r")).select("page", "position", "r.*")
    low = F.lower("said")
    model = F.coalesce(F.upper(pages.pricing_hint(F.col("said"))), F.when(F.contains(low, F.lit("enterprise")), "ENTERPRISE"))
    return rows.where(F.length("name") >= 2).select(
        "page", "position", F.col("name").alias("productName"), F.lit(None).cast("string").alias("startupName"), model.alias("pricingModel"), urls.join_simple(F.lit(TABLE_SITE), F.col("href")).alias("product_url")
    )


def hosted_models(items: DataFrame, model_id: str = "id", author: str = "author") -> DataFrame:
    """(productName, startupName, pricingModel, product_url) of hosted models: an id names its author before the first slash.
    Licences aren't prices, so no model has one."""
    i = F.col(model_id)
    owned = F.contains(i, F.lit("/"))
    name = F.trim(F.when(owned, F.regexp_extract(i, "^[^/]*/(.*)$", 1)).otherwise(i))
    owner = F.nullif(F.trim(F.when(owned, F.substring_index(i, "/", 1)).otherwise(F.col(author))), F.lit(""))
    out = items.where((F.coalesce(i, F.lit("")) != "") & (name != ""))
    return out.select(name.alias("productName"), owner.alias("startupName"), F.lit(None).cast("string").alias("pricingModel"), F.concat(F.lit(MODEL_PAGE), i).alias("product_url"))


def next_page(link_header: Column) -> Column:
    """The address of the page after this one by a Link header; null at the last."""
    return F.nullif(F.regexp_extract(link_header, r'<([^>]+)>;\s*rel="next"', 1), F.lit(""))


def listed_companies(hits: DataFrame, wanted: Column, order: str) -> DataFrame:
    """Startups of a directory's hits (name, slug, team_size, website, industries, one_liner), the first hit of each slug."""
    named = hits.where((F.coalesce(F.trim("name"), F.lit("")) != "") & (F.coalesce(F.trim("slug"), F.lit("")) != "") & wanted).withColumn("slug", F.trim("slug"))
    first = first_of(named, ["slug"], [order])
    return first.select(
        order,
        F.trim("name").alias("entityName"),
        F.concat(F.lit(COMPANY_PAGE), "slug").alias("company_url"),
        F.when(F.col("website") != "", F.when(F.regexp_like("website", F.lit("^https?://")), F.col("website")).otherwise(F.concat(F.lit("https://"), "website"))).alias("website"),
        F.when(F.col("team_size") > 0, F.col("team_size").cast("int")).alias("employeeCount"),
        F.coalesce("industries", F.array().cast("array<string>")).alias("industries"),
        F.nullif("one_liner", F.lit("")).alias("description"),
    )


def budgeted(rows: DataFrame, source: str, order: str, budgets: dict[str, int], default: int) -> DataFrame:
    """The first rows of every source, as many as its budget allows."""
    most, at = F.lit(default), "budget_rank"
    for name, n in budgets.items():
        most = F.when(F.col(source) == name, n).otherwise(most)
    return ranked(rows, [source], [order], at).where(F.col(at) <= most).drop(at)


def _represented(block: pd.DataFrame, order: str) -> pd.DataFrame:
    """For each record the one that stands for it: the kept one of its site, else of its name, else itself."""
    sites: dict[str, int] = {}
    names: dict[str, int] = {}
    kept = []
    block = block.sort_values(order)
    for i, site, name in zip(block[order], block["site"], block["name"], strict=True):
        rep = sites.get(site) if site else None
        rep = names.get(name) if rep is None else rep
        if rep is None:
            rep = names[name] = i
            if site:
                sites[site] = i
        kept.append(rep)
    return pd.DataFrame({order: block[order], "rep": kept})


def representatives(candidates: DataFrame, order: str = "input_idx") -> DataFrame:
    """(order, rep): the record that each candidate is merged into. Nameless ones have none. Only keys go through Python."""
    site = F.replace(urls.parts(F.element_at("raw_metadata", "external_product_url")).host, F.lit("www."), F.lit(""))
    keyed = candidates.select(order, F.coalesce(site, F.lit("")).alias("site"), text.entity_key(F.col("tool_name")).alias("name")).where(F.length("name") >= 2)
    members = merging.labelled(keyed, order, ["site", "name"])
    alone = keyed.join(members, order, "left_anti").select(order, F.col(order).alias("rep"))
    shared = keyed.join(members, order).select("block", order, "site", "name").groupBy("block").applyInPandas(lambda b: _represented(b, order), f"`{order}` long, rep long")
    return alone.unionByName(shared)


def merge_candidates(candidates: DataFrame, limit: int | None = None, order: str = "input_idx") -> DataFrame:
    """One row for each product, the first by order: it takes references of other sources, a missing developer or
    description, further categories and tags, and metadata, where later values win. With a limit, discovery stops at that
    many products, so that later copies add nothing."""
    reps = representatives(candidates, order)
    if limit is not None:
        cut = reps.where(F.col(order) == F.col("rep")).orderBy("rep").limit(limit).agg(F.max("rep").alias("cut"), F.count("*").alias("n")).first()
        if cut["n"] == limit:
            reps = reps.where(F.col(order) <= cut["cut"])
    rows = candidates.join(reps, order)
    said = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c) != "", F.lit(False)), F.col(order))).alias(c)
    merged = rows.groupBy("rep").agg(said("company_developer"), said("short_description"), F.count("*").alias("found"))
    lists = [merging.items_in_order(rows, ["rep"], c, order) for c in ("categories", "tags")]
    references = rows.select("rep", order, F.posexplode("discovery_references").alias("at", "r")).groupBy("rep", F.col("r.source").alias("s")).agg(F.min(F.struct(order, "at", "r")).alias("r"))
    references = references.groupBy("rep").agg(F.array_sort(F.collect_list("r")).alias("r")).select("rep", F.transform("r", lambda x: x["r"]).alias("discovery_references"))
    entries = rows.select("rep", order, F.explode("raw_metadata").alias("k", "v")).groupBy("rep", "k").agg(F.max(F.struct(order, F.struct("v").alias("v"))).alias("e"))
    metadata = entries.groupBy("rep").agg(F.map_from_entries(F.collect_list(F.struct("k", "e.v.v"))).alias("raw_metadata"))
    own = candidates.drop("company_developer", "short_description", "categories", "tags", "discovery_references", "raw_metadata")
    out = own.join(merged, F.col(order) == F.col("rep"))
    for more in (*lists, references, metadata):
        out = out.join(more, "rep", "left")
    return out.drop("rep").select(*candidates.columns, "found")


def discovery_report(candidates: DataFrame, merged: DataFrame, statuses: DataFrame, limit: int) -> DataFrame:
    """One row: what was found, what was left after the merge, and how the requests went."""
    kept = merged.agg(F.count("*").alias("final_candidate_count"), F.coalesce(F.sum(F.col("found") - 1), F.lit(0)).alias("duplicates_removed"))
    tried = statuses.agg(F.coalesce(F.sum("pages_attempted"), F.lit(0)).alias("total_pages_attempted"), F.coalesce(F.sum("failed_requests"), F.lit(0)).alias("total_failures"))
    found = candidates.agg(F.count("*").alias("total_discovered"))
    # each side is one row
    joined = kept.withColumn("one", F.lit(1)).join(tried.withColumn("one", F.lit(1)), "one").join(found.withColumn("one", F.lit(1)), "one")
    return joined.drop("one").withColumns({"target_limit": F.lit(limit), "status": F.when(F.col("final_candidate_count") > 0, "PASS").otherwise("FAIL")})
