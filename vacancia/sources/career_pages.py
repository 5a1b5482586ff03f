"""Career pages of unknown make: linked data, embedded state, job arrays, links, sitemaps.

``pages`` tables have ``seq, url, company, payload``; the payload is the page's HTML unless said
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import dates, job_types, locations, salary, urls
from vacancia.functions.arrays import distinct_by, with_once
from vacancia.functions.json_tree import ITEM_DDL, job_arrays, jsonld_postings, largest_items
from vacancia.functions.markdown import convert_if_html, html_list_to_markdown
from vacancia.functions.markup import meta_content, page_links, script_bodies
from vacancia.functions.text import extract_emails, filled, first_match, let, non_empty, strip
from vacancia.operators.filters import MIN_JSON, MIN_PAGE_DESCRIPTION
from vacancia.operators.ranking import first_per_key
from vacancia.session import cut_lineage
from vacancia.schema import location, posting_columns
from vacancia.sources.payloads import has_text

LD_JSON = "application/ld+json"


# ---- linked data ------------------------------------------------------------------------------

# Fields whose shape varies (object, list or text) are kept as JSON text and read in a second step.
LD_POSTING = (
    "struct<title:string,url:string,description:string,jobLocation:string,baseSalary:string,"
    "datePosted:string,jobLocationType:string,employmentType:string,hiringOrganization:string,"
    "identifier:string>"
)
LD_PLACE = "struct<address:struct<addressLocality:string,addressRegion:string,addressCountry:string>>"
LD_PAY = "struct<currency:string,value:struct<minValue:string,maxValue:string,unitText:string>>"


def _is_list(text: Column) -> Column:
    return F.startswith(text, F.lit("["))


def _words(text: Column) -> Column:
    """A text, or a list of texts joined by blanks."""
    return F.when(
        _is_list(text), F.array_join(F.from_json(text, "array<string>"), " ")
    ).otherwise(text)


def _linked_url() -> Column:
    return F.coalesce(non_empty(F.col("p.url")), F.col("url"))


def _linked_parts() -> dict[str, Column]:
    """What is read from the members of ``p`` whose shape varies."""
    place, organization = F.col("p.jobLocation"), F.col("p.hiringOrganization")
    first_place = F.when(
        _is_list(place), F.get(F.from_json(place, "array<string>"), F.lit(0))
    ).otherwise(place)
    return {
        "address": F.from_json(first_place, LD_PLACE)["address"],
        "pay": F.from_json(F.col("p.baseSalary"), LD_PAY),
        "name": F.when(F.startswith(organization, F.lit("{")), F.get_json_object(organization, "$.name")),
        "types": _words(F.col("p.employmentType")),
    }


def _linked_fields() -> dict[str, Column]:
    """Posting fields of a row with ``p``, ``job_url``, ``description`` and ``_linked_parts``."""
    identifier = F.col("p.identifier")
    # An identifier without a value would be shared by all postings that have such a one.
    given = F.when(F.startswith(identifier, F.lit("{")), F.get_json_object(identifier, "$.value"))
    native = F.coalesce(non_empty(given), urls.url_hash(F.col("job_url")))
    text, types = F.col("description"), F.col("types")
    return dict(
        seq=F.col("seq"),
        pos=F.col("pos"),
        site=F.lit("custom"),
        source_url=F.col("url"),
        id=F.concat(F.lit("custom:jsonld:"), native),
        title=F.col("p.title"),
        company_name=F.coalesce(non_empty(F.col("name")), F.col("company")),
        job_url=F.col("job_url"),
        location=location(
            F.col("address.addressLocality"), F.col("address.addressRegion"),
            F.col("address.addressCountry"), True,
        ),
        description=text,
        is_remote=F.contains(
            F.upper(F.coalesce(_words(F.col("p.jobLocationType")), F.lit(""))),
            F.lit("TELECOMMUTE"),
        ),
        date_posted=dates.iso_date(F.col("p.datePosted")),
        compensation=salary.jsonld_compensation(F.col("pay")),
        job_type=F.when(F.length(types) > 0, job_types.extract_job_type(types)),
        emails=F.when(F.length(text) > 0, extract_emails(text)),
    )


def parse_jsonld_postings(pages: DataFrame) -> DataFrame:
    """JobPosting objects of a page, wherever they sit in its linked data."""
    found = pages.select(
        "seq", "url", "company",
        F.posexplode(jsonld_postings(script_bodies(F.col("payload"), LD_JSON))).alias("pos", "posting"),
    )
    read = with_once(found, p=F.from_json("posting", LD_POSTING)).where(has_text(F.col("p.title")))
    parts = with_once(
        read.withColumn("description", convert_if_html(F.col("p.description"))),
        job_url=_linked_url(), **_linked_parts(),
    )
    return parts.select(*posting_columns(**_linked_fields()))


def page_description(pages: DataFrame) -> DataFrame:
    """``seq, url, description`` of single-posting pages: linked data, then the two meta tags."""
    texts = F.transform(
        jsonld_postings(script_bodies(F.col("payload"), LD_JSON)),
        lambda p: F.get_json_object(p, "$.description"),
    )
    read = pages.select("seq", "url", "payload", texts.alias("texts"))
    marked = F.exists("texts", lambda t: F.contains(t, F.lit("<")))
    converted = F.when(
        marked,
        F.zip_with(
            F.col("texts"),
            html_list_to_markdown(F.when(marked, F.col("texts"))),
            lambda t, m: F.when(F.contains(t, F.lit("<")), m).otherwise(t),
        ),
    ).otherwise(F.col("texts"))
    linked = let(
        converted,
        lambda a: F.get(F.filter(a, lambda t: F.length(t) >= MIN_PAGE_DESCRIPTION), F.lit(0)),
    )
    html = F.col("payload")
    return read.select(
        "seq", "url",
        F.coalesce(
            linked,
            meta_content(html, "property", "og:description", 50),
            meta_content(html, "name", "description", 50),
        ).alias("description"),
    )


# ---- JSON of unknown shape --------------------------------------------------------------------

def _state_body(html: Column) -> Column:
    body = strip(
        first_match(html, r"(?is)<script\s+id=[\"']__NEXT_DATA__[\"'][^>]*>(.*?)</script>")
    )
    return F.get_json_object(body, "$.props.pageProps")


def next_data(pages: DataFrame) -> DataFrame:
    """``seq, url, company, body``: page properties embedded by the site's framework."""
    return with_once(pages, body=_state_body(F.col("payload"))).where(F.length("body") > 0).select("seq", "url", "company", "body")


def captured_bodies(responses: DataFrame) -> DataFrame:
    """``seq, url, company, body`` of captured JSON responses (``response_url``, ``payload``).

    ``url`` is the page they belong to. Trackers and tiny bodies are dropped.
    """
    return responses.where(
        ~urls.is_tracker_host(F.col("response_url")) & (F.length("payload") >= MIN_JSON)
    ).select("seq", "url", "company", F.col("payload").alias("body"))


def find_job_arrays(bodies: DataFrame) -> DataFrame:
    """``seq, candidate, path, pos, item`` of all arrays that look like lists of jobs."""
    arrays = bodies.select(
        "seq", F.posexplode(job_arrays(F.col("body"))).alias("candidate", "found")
    )
    return arrays.select(
        "seq", "candidate", F.col("found.path").alias("path"),
        F.posexplode("found.items").alias("pos", "item"),
    )


def _loose_title(item: Column) -> Column:
    return F.coalesce(item["title"], F.lit(""))


def largest_job_array(bodies: DataFrame) -> DataFrame:
    """``seq, url, company, items``: each body's array with most usable titles, null without one."""
    return bodies.select("seq", "url", "company", largest_items(F.col("body")).alias("items"))


def best_job_array(bodies: DataFrame) -> DataFrame:
    """``seq, url, company, pos, item``: rows of each body's array with most usable titles."""
    return largest_job_array(bodies).select("seq", "url", "company", F.posexplode("items").alias("pos", "item"))


def _loose_url(item: Column) -> Column:
    link = F.coalesce(filled(item["url"]), F.col("url"))
    return urls.absolute_url(link, F.col("url"))


def _loose_fields() -> dict[str, Column]:
    """Posting fields of a row with ``item``, ``title``, ``job_url`` and ``description``."""
    item, text = F.col("item"), F.col("description")
    native = F.coalesce(
        filled(item["id"]),
        urls.url_hash(F.concat(F.col("title"), F.col("job_url"))),
    )
    return dict(
        seq=F.col("seq"),
        pos=F.col("pos"),
        site=F.lit("custom"),
        source_url=F.col("url"),
        id=F.concat(F.lit("custom:xhr:"), native),
        title=F.col("title"),
        company_name=F.col("company"),
        job_url=F.col("job_url"),
        location=locations.loc_loose(item["location"]),
        description=text,
        is_remote=F.coalesce(item["remote"], F.lit(False)),
        date_posted=dates.iso_date(item["date"]),
        emails=F.when(F.length(text) > 0, extract_emails(text)),
        job_type=job_types.extract_job_type(F.coalesce(non_empty(text), F.col("title"))),
    )


def parse_loose_job(items: DataFrame) -> DataFrame:
    """``seq, url, company, pos, item`` to postings: the first key of each kind decides."""
    item = F.col("item")
    read = with_once(
        items, title=_loose_title(item), job_url=_loose_url(item), raw_text=item["description"]
    ).where(urls.is_loose_title(F.col("title")))
    read = read.withColumn("description", convert_if_html(F.col("raw_text")))
    return read.select(*posting_columns(**_loose_fields()))


def parse_next_data(pages: DataFrame) -> DataFrame:
    return parse_loose_job(best_job_array(next_data(pages)))


def parse_captured(responses: DataFrame) -> DataFrame:
    """Captured responses of a page: the one with most usable rows stands for the page.

    Responses are compared whole, before their arrays are exploded, so each map task passes on at most
    one of a page. A response of no known page stands for itself.
    """
    arrays = largest_job_array(captured_bodies(responses)).where(F.size("items") > 0)
    arrays = arrays.withColumns({"n": F.size("items"), "alone": F.when(F.col("url").isNull(), F.col("seq"))})
    best = first_per_key(arrays, ["url", "alone"], [F.desc("n"), "seq"])
    return parse_loose_job(best.select("seq", "url", "company", F.posexplode("items").alias("pos", "item")))


# ---- links ------------------------------------------------------------------------------------

def _own_links(html: Column, page: Column) -> Column:
    """``array<struct<pos, href, text>>`` of links that stay on the page's site, made absolute."""

    def on_site(name: Column) -> Column:
        full = F.transform(
            page_links(html),
            lambda x: F.struct(
                x["pos"], urls.absolute_url(x["href"], page).alias("href"), x["text"]
            ),
        )
        return F.filter(
            full,
            lambda x: F.startswith(x["href"], F.lit("http"))
            & urls.same_site(urls.host(x["href"]), name),
        )

    return let(urls.host(page), on_site)


def site_links(pages: DataFrame) -> DataFrame:
    """``seq, url, company, pos, href, text`` of links that stay on the page's site."""
    return pages.select(
        "seq", "url", "company", F.inline(_own_links(F.col("payload"), F.col("url")))
    )


def _job_links(html: Column, page: Column, at_least: int = 2) -> Column:
    """Links that look like postings, without repeats; null for a page with fewer than ``at_least``."""

    def judged(links: Column) -> Column:
        found = F.filter(
            links,
            lambda x: F.length(x["text"]).between(5, 150)
            & urls.is_job_url(x["href"])
            & ~urls.is_category_url(x["href"]),
        )
        once = distinct_by(found, lambda x: urls.normalized_url(x["href"]))
        titled = F.filter(once, lambda x: urls.is_link_title(x["text"]))
        return let(titled, lambda t: F.when(F.size(t) >= at_least, t))

    return judged(_own_links(html, page))


def _link_fields() -> dict[str, Column]:
    """Posting fields of a row with ``title`` and ``job_url`` of a link."""
    return dict(
        seq=F.col("seq"),
        pos=F.col("pos"),
        site=F.lit("custom"),
        source_url=F.col("url"),
        id=F.concat(F.lit("custom:link:"), urls.url_hash(F.col("job_url"))),
        title=F.col("title"),
        company_name=F.col("company"),
        job_url=F.col("job_url"),
        location=location(None, None, None, True),
        is_remote=F.lit(False),
    )


def extract_job_links(pages: DataFrame, at_least: int = 2) -> DataFrame:
    """Postings from links alone; only for pages that have enough of them.

    A page's links are judged, freed of repeats and counted inside its row: no shuffle.
    """
    rows = pages.select(
        "seq", "url", "company", F.inline(_job_links(F.col("payload"), F.col("url"), at_least))
    ).withColumnsRenamed({"href": "job_url", "text": "title"})
    return rows.select(*posting_columns(**_link_fields()))


# ---- the strategies of a page, in one scan ----------------------------------------------------

#: Ranks of what a page's own HTML offers, in the order in which it is tried.
STATE, LINKED, LINKS = 1, 2, 6


def page_cascade(pages: DataFrame) -> DataFrame:
    """Postings of the first strategy that finds any in a page's HTML, with its ``strategy_rank``.

    Embedded state, linked data and links are tried in this order inside the page's row, and what comes
    after the first that is enough isn't read. One scan and no shuffle. A page without payload, or in
    which no strategy finds anything, has no rows.
    """
    return _offered(pages, first=True)


def page_offers(pages: DataFrame) -> DataFrame:
    """Postings of every strategy that reads a page's HTML, with their ``strategy_rank``: one scan and no shuffle."""
    return _offered(pages, first=False)


def _offered(pages: DataFrame, first: bool) -> DataFrame:
    """Postings with ``strategy_rank``: of a page's first strategy that finds any, or of all."""

    def some(found: Column) -> Column:
        return F.coalesce(F.size(found) > 0, F.lit(False))

    def unless(enough: Column, read: Column) -> Column:
        return F.when(~enough, read) if first else read

    html, page = F.col("payload"), F.col("url")
    state = with_once(pages.select("seq", "url", "company", "payload"), body=_state_body(html))
    state = with_once(state, items=largest_items(non_empty(F.col("body")))).drop("body")
    linked = state.withColumn("scripts", unless(some(F.col("items")), script_bodies(html, LD_JSON)))
    linked = linked.withColumn("scripts", jsonld_postings(F.col("scripts")))
    read = F.transform("scripts", lambda p, i: F.struct(i.alias("pos"), F.from_json(p, LD_POSTING).alias("p")))
    linked = with_once(linked, linked=F.filter(read, lambda x: has_text(x["p"]["title"]))).drop("scripts")

    items, found = F.col("items"), F.col("linked")
    links = unless(some(items) | some(found), _job_links(html, page))
    kinds = {"item": ITEM_DDL, "p": LD_POSTING, "link": "struct<href:string,text:string>"}

    def offer(rank: int, pos: Column, **given: Column) -> Column:
        """One candidate; all kinds have the same layout."""
        return F.struct(
            F.lit(rank).alias("strategy_rank"), pos.cast("int").alias("pos"),
            *[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()],
        )

    offers = (
        F.transform(items, lambda x, i: offer(STATE, i, item=x)),
        F.transform(found, lambda x: offer(LINKED, x["pos"], p=x["p"])),
        F.transform(links, lambda x: offer(LINKS, x["pos"], link=F.struct(x["href"], x["text"]))),
    )
    if first:
        chosen = F.when(some(items), offers[0]).when(some(found), offers[1]).otherwise(offers[2])
    else:
        chosen = F.flatten(F.filter(F.array(*offers), lambda o: o.isNotNull()))
    rows = linked.select("seq", "url", "company", F.inline(chosen))
    rank, item = F.col("strategy_rank"), F.col("item")

    def by_rank(state: Column, linked: Column, link: Column) -> Column:
        return F.when(rank == STATE, state).when(rank == LINKED, linked).otherwise(link)

    rows = with_once(
        rows,
        title=by_rank(_loose_title(item), F.col("p.title"), F.col("link.text")),
        job_url=by_rank(_loose_url(item), _linked_url(), F.col("link.href")),
        raw_text=by_rank(item["description"], F.col("p.description"), F.lit(None)),
        **_linked_parts(),
    )
    rows = rows.withColumn("description", convert_if_html(F.col("raw_text")))
    each = [posting_columns(**fields()) for fields in (_loose_fields, _linked_fields, _link_fields)]
    names = rows.select(*each[0]).columns
    return rows.select(*[by_rank(*c).alias(name) for name, *c in zip(names, *each)], "strategy_rank")


def find_listing_link(pages: DataFrame) -> DataFrame:
    """``seq, url, listing_url``: the first link to a list of all postings, chosen inside the row."""

    page = F.col("url")

    def good(link: Column) -> Column:
        return (F.rtrim(link["href"], F.lit("/")) != F.rtrim(page, F.lit("/"))) & (
            urls.is_listing_link(link["href"], link["text"])
        )

    first = F.filter(_own_links(F.col("payload"), page), good)
    return pages.select("seq", "url", F.inline(F.slice(first, 1, 1))).select(
        "seq", "url", F.col("href").alias("listing_url")
    )


def detect_embedded_ats(pages: DataFrame) -> DataFrame:
    """``seq, url, platform_url, platform`` of pages that embed a known career platform."""
    return (
        pages.select("seq", "url", urls.embedded_platform_url(F.col("payload")).alias("platform_url"))
        .where(F.col("platform_url").isNotNull())
        .withColumn("platform", urls.detect_platform(F.col("platform_url")))
    )


# ---- sitemaps ---------------------------------------------------------------------------------

def parse_robots_sitemaps(raw: DataFrame) -> DataFrame:
    """``seq, url, pos, sitemap`` declared in robots files."""
    lines = raw.select(
        "seq", "url", F.posexplode(F.transform(F.split("payload", r"\R"), strip)).alias("pos", "line")
    ).where(F.startswith(F.lower("line"), F.lit("sitemap:")))
    found = strip(F.substr(F.col("line"), F.lit(len("sitemap:") + 1)))
    return lines.select("seq", "url", "pos", found.alias("sitemap")).where(
        F.startswith("sitemap", F.lit("http"))
    )


SITEMAP_DDL = "url array<struct<loc:string,lastmod:string>>, sitemap array<struct<loc:string>>"
# Words that mark a child sitemap as holding jobs.
JOB_SITEMAP_WORDS = ("job", "career", "position", "opening", "vacanc", "posting", "hiring")


def _read_sitemaps(raw: DataFrame) -> DataFrame:
    # White space is trimmed by ``strip``; the reader must not choke on a byte-order mark.
    xml = F.regexp_replace("payload", r"^[﻿\s]+", "")
    return raw.withColumn("map", F.from_xml(xml, SITEMAP_DDL))


def parse_sitemap(raw: DataFrame) -> DataFrame:
    """``seq, url, company, pos, loc, lastmod`` of entries that look like postings."""
    return (
        _read_sitemaps(raw)
        .select("seq", "url", "company", F.posexplode("map.url").alias("pos", "entry"))
        .select(
            "seq", "url", "company", "pos", strip(F.col("entry.loc")).alias("loc"),
            strip(F.col("entry.lastmod")).alias("lastmod"),
        )
        .where((F.length("loc") > 0) & urls.is_job_url(F.col("loc")))
    )


def sitemap_children(raw: DataFrame) -> DataFrame:
    """``seq, url, pos, child`` of index files; only the job-related ones if there are any."""
    children = F.filter(
        F.transform("map.sitemap", lambda s: strip(s["loc"])), lambda u: F.length(u) > 0
    )

    def chosen(all_: Column) -> Column:
        related = F.filter(all_, lambda u: F.lower(u).rlike("|".join(JOB_SITEMAP_WORDS)))
        return F.when(F.size(related) > 0, related).otherwise(all_)

    return _read_sitemaps(raw).select(
        "seq", "url", F.posexplode(F.array_distinct(let(children, chosen))).alias("pos", "child")
    )


def reached_sitemaps(files: DataFrame) -> DataFrame:
    """``root, url, depth``: the landed files that each robots file leads to, over any number of indexes.

    ``files`` are landed robots files and sitemaps (``url``, ``payload``). A file is reached from the
    robots file of its root directly (depth 1) or through index files; ``depth`` is its shortest way.
    Every round follows the links of what the round before has reached for the first time, so files that
    name each other come to an end. Files that haven't landed are reached, but lead no further.
    """
    declared = parse_robots_sitemaps(files).select("url", F.col("sitemap").alias("child"))
    listed = sitemap_children(files).select("url", "child")
    links = cut_lineage(declared.unionByName(listed).distinct(), "sitemap-links")
    new = declared.select(F.col("url").alias("root"), F.col("child").alias("url")).distinct().withColumn("depth", F.lit(1))
    new = cut_lineage(new, "sitemaps")
    reached = new
    while not new.isEmpty():
        onward = new.join(links, "url").select("root", F.col("child").alias("url"), (F.col("depth") + 1).alias("depth")).distinct()
        new = cut_lineage(onward.join(reached.select("root", "url"), ["root", "url"], "left_anti"), "sitemaps")
        reached = reached.unionByName(new)
    return reached


def reached_postings(files: DataFrame, at_least: int = 2) -> DataFrame:
    """Postings of all sitemaps that robots files lead to, with the root as ``source_url``."""
    ways = reached_sitemaps(files).select("root", F.col("url").alias("__url"))
    rows = sitemap_postings(files, at_least)
    return rows.join(ways, F.col("source_url") == F.col("__url")).withColumn("source_url", F.col("root")).drop("root", "__url")


def sitemap_postings(raw: DataFrame, at_least: int = 2) -> DataFrame:
    """Postings from the entries of a sitemap: titles come from the URLs."""

    def judged(entries: Column) -> Column:
        found = F.filter(entries, lambda e: urls.is_job_url(e["loc"]))
        once = distinct_by(found, lambda e: urls.normalized_url(e["loc"]))
        kept = F.filter(
            once, lambda e: ~urls.is_apply_url(e["loc"]) & ~urls.is_category_url(e["loc"])
        )
        titled = F.filter(
            F.transform(kept, lambda e: e.withField("title", urls.title_from_slug(e["loc"]))),
            lambda e: urls.is_sitemap_title(e["title"]),
        )
        return let(titled, lambda t: F.when(F.size(t) >= at_least, t))

    entries = F.transform(
        "map.url",
        lambda e, i: F.struct(
            i.alias("pos"), strip(e["loc"]).alias("loc"), strip(e["lastmod"]).alias("lastmod")
        ),
    )
    rows = _read_sitemaps(raw).select("seq", "url", "company", F.inline(judged(entries)))
    loc = F.col("loc")
    return rows.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("custom"),
            source_url=F.col("url"),
            id=F.concat(F.lit("custom:sitemap:"), urls.url_hash(loc)),
            title=F.col("title"),
            company_name=F.col("company"),
            job_url=loc,
            location=location(None, None, None, True),
            is_remote=F.lit(False),
            date_posted=dates.iso_date(F.col("lastmod")),
        )
    )
