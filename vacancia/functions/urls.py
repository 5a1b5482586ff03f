"""URL parts, keys, ids and classification. Hosts are read by pattern, so odd URLs never fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import first_match, let, non_empty, rx, strip, title_case
from vacancia.lookups import (
    EMBEDDED_HOSTS, ID_PREFIX, NON_JOB_TITLES, PLATFORM_HOSTS, POSTING_URL, SEEK_SITES,
    SKIP_LINK_PARTS, SKIP_LINK_TITLES, TRACKER_HOST_PARTS, TWO_PART_TLDS, country_records, lookup,
)

# Path words of single postings, of category pages and of listing pages.
JOB_PATHS = (
    "careers", "jobs", "positions", "openings", "vacancies", "job", "listing", "o", "role",
    "opportunity",
)
CATEGORY_PATHS = (
    "teams?", "departments?", "disciplines?", "locations?", "benefits?", "culture", "about", "faq",
    "students?", "campus", "intern(?:ship)?s?", "inclusion", "diversity", "values", "search",
    "results", "all-jobs", "open-roles", "blog", "stories?", "news", "press", "principles?",
    "extraordinary", "university", "people", "mission", "impact", "sustainability", "contacts?",
    "login", "sign-?up", "apply-?now", "subscribe", "newsletter", "articles?", "authors?",
    "shares", "events?", "guides?", "resources?", "policies?", "privacy", "terms", "cookies?",
    "legal", "employee-stories", "candidate-guidance", "class-of", "profiles?", "partners?",
    "clients?", "portfolio", "services?", "solutions?", "category", "tags?", "archives?", "page",
    "feed", "sitemap", "media",
)
CATEGORY_PREFIXES = (
    "life-at", "why-", "how-we", "our-", "how-to", "work-at", "meet-", "jobs-in-", "jobs-near-",
)
LISTING_PATHS = (
    "jobs", "positions", "openings", "search", "results", "all-jobs", "open-roles", "vacancies",
)
LISTING_TEXTS = (
    r"all\s+jobs",
    r"view\s+(?:all\s+)?(?:jobs|positions|openings|roles)",
    r"search\s+(?:jobs|positions|openings)",
    r"open\s+(?:positions|roles)",
    r"see\s+(?:all\s+)?(?:jobs|positions|openings|roles)",
    r"browse\s+(?:jobs|positions|openings|roles)",
)


def host(url: Column) -> Column:
    """Lower-cased host name, null when the URL has none."""
    return F.lower(first_match(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"))


def origin(url: Column) -> Column:
    """``scheme://host[:port]``."""
    return first_match(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)")


def path(url: Column) -> Column:
    """Path without query and fragment, ``''`` when there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def path_parts(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda p: p != "")


def normalized_url(url: Column) -> Column:
    """De-duplication key: trailing slashes go first, then the query, then the fragment."""
    return F.substring_index(F.substring_index(F.rtrim(url, F.lit("/")), "?", 1), "#", 1)


def is_job_url(url: Column) -> Column:
    return url.rlike(rx(rf"/(?:{'|'.join(JOB_PATHS)})/[a-z0-9][\w-]{{5,}}", ignore_case=True))


def is_category_url(url: Column) -> Column:
    exact = rf"(?i)/(?:{'|'.join(CATEGORY_PATHS)})(?:/|$|\?)"
    prefix = rf"(?i)/(?:{'|'.join(CATEGORY_PREFIXES)})"
    return url.rlike(exact) | url.rlike(prefix)


def is_apply_url(url: Column) -> Column:
    return F.endswith(F.rtrim(path(url), F.lit("/")), F.lit("/apply"))


def is_listing_link(url: Column, text: Column) -> Column:
    """Links to a page that lists all postings, by path or by wording."""
    by_path = url.rlike(rf"(?i)/(?:{'|'.join(LISTING_PATHS)})(?:/|$|\?)")
    by_text = text.rlike(rx(rf"\b(?:{'|'.join(LISTING_TEXTS)})\b", ignore_case=True))
    return by_path | by_text


def same_site(one: Column, other: Column) -> Column:
    """Equal host names, or one a sub-domain of the other."""
    a, b = F.coalesce(one, F.lit("")), F.coalesce(other, F.lit(""))
    return (
        (a == b)
        | F.endswith(a, F.concat(F.lit("."), b))
        | F.endswith(b, F.concat(F.lit("."), a))
    )


def is_tracker_host(url: Column) -> Column:
    return F.coalesce(host(url), F.lit("")).rlike(
        "|".join(p.replace(".", r"\.") for p in TRACKER_HOST_PARTS)
    )


def detect_platform(url: Column) -> Column:
    """Career platform of a URL's host; ``custom`` when unknown."""

    def match(name: Column) -> Column:
        rules = None
        for key, platform in PLATFORM_HOSTS.items():
            hit = F.endswith(name, F.lit(key)) if key.startswith(".") else name == key
            rules = F.when(hit, platform) if rules is None else rules.when(hit, platform)
        return rules.otherwise("custom")

    return let(F.coalesce(host(url), F.lit("")), match)


def embedded_platform_url(html: Column) -> Column:
    """First frame of a known platform, else the first link that mentions one."""
    frames = F.regexp_extract_all(
        html, F.lit("(?i)<iframe[^>]+src=[\"']([^\"']+)[\"']"), F.lit(1)
    )
    hosts = "|".join(h.replace(".", r"\.") for h in EMBEDDED_HOSTS)
    framed = F.get(F.filter(frames, lambda u: host(u).rlike(rf"(?:^|\.)(?:{hosts})$")), F.lit(0))
    links = F.regexp_extract_all(
        html, F.lit(rf"(?i)(?:href|src|data-src)=[\"']([^\"']*(?:{hosts})[^\"']*)[\"']"), F.lit(1)
    )
    full = F.transform(
        links,
        lambda u: F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).otherwise(u),
    )
    linked = F.get(F.filter(full, lambda u: F.startswith(u, F.lit("http"))), F.lit(0))
    return F.coalesce(framed, linked)


def parent_domain(name: Column) -> Column:
    """Registrable parent of a sub-domain; null when the host is already one."""

    def of(parts: Column) -> Column:
        n = F.size(parts)
        last_two = F.concat_ws(".", F.slice(parts, -2, 2))
        last_three = F.concat_ws(".", F.slice(parts, -3, 3))
        return F.when(
            n > 2,
            F.when(last_two.isin(*TWO_PART_TLDS), F.when(n > 3, last_three)).otherwise(last_two),
        )

    return let(F.split(name, r"\."), of)


def title_from_slug(url: Column) -> Column:
    """A readable title from the last path part (the one before, if that is just a number)."""

    def of(parts: Column) -> Column:
        last, before = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
        number = r"^\d+$"
        return F.when(last.rlike(number) & ~F.coalesce(before, F.lit("0")).rlike(number), before).otherwise(last)

    slug = let(F.split(F.rtrim(path(url), F.lit("/")), "/"), of)
    words = strip(F.translate(slug, "-_", "  "))
    uuid = r"(?i)\s+[0-9a-f]{8}\s+[0-9a-f]{4}\s+[0-9a-f]{4}\s+[0-9a-f]{4}\s+[0-9a-f]{12}$"
    return title_case(strip(F.regexp_replace(words, uuid, "")))


def career_slug(url: Column, platform: Column) -> Column:
    """The company's handle in a career-page URL; the place depends on the platform."""
    parts = path_parts(url)
    name = F.coalesce(host(url), F.lit(""))
    first = F.coalesce(F.get(parts, F.lit(0)), F.lit(""))
    last = F.coalesce(F.try_element_at(parts, F.lit(-1)), name)
    board = F.regexp_extract(path(url), r"/boards/([^/]+)", 1)
    embed = F.regexp_extract(url, r"[?&]for=([^&#]*)", 1)
    greenhouse = (
        F.when((name == "boards-api.greenhouse.io") & (board != ""), board)
        .when((first == "embed") & (embed != ""), embed)
        .otherwise(first)
    )
    return (
        F.when(platform == "greenhouse", greenhouse)
        .when(platform.isin("lever", "ashby", "smartrecruiters"), first)
        .when(platform == "workable", F.coalesce(F.get(parts, F.lit(0)), name))
        .when(platform == "bamboohr", F.replace(name, F.lit(".bamboohr.com"), F.lit("")))
        .when(platform == "jazzhr", F.substring_index(name, ".", 1))
        .otherwise(last)
    )


def strip_query(url: Column) -> Column:
    """Without the query; a fragment stays."""
    return F.regexp_replace(url, r"^([^?#]*)\?[^#]*", "$1")


def job_id_of_href(href: Column) -> Column:
    """Text after the last dash of the path."""
    return F.substring_index(F.substring_index(href, "?", 1), "-", -1)


def id_from_url(url: Column) -> Column:
    """``jobid=…``, ``job<digits>`` or ``/apply/<code>/``, in this order."""
    return F.coalesce(
        first_match(url, r"jobid=([^&]*)"),
        first_match(url, r"job(\d+)"),
        first_match(url, r"/apply/([A-Za-z0-9]+)/"),
    )


def apply_code(url: Column) -> Column:
    """Code of an application link, else its last path part."""
    last = F.try_element_at(F.filter(F.split(url, "/"), lambda p: p != ""), F.lit(-1))
    return F.coalesce(first_match(url, r"/apply/([A-Za-z0-9]+)/"), last)


def _without_dots(full_path: Column) -> Column:
    """A path with its ``.`` and ``..`` parts carried out."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.array_append(done, part))

    parts = F.split(F.substr(full_path, F.lit(2)), "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    open_end = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(open_end, "/").otherwise(""))
    return F.when(full_path.rlike(r"/\.\.?(?:/|$)"), joined).otherwise(full_path)


def absolute_url(href: Column, base: Column) -> Column:
    """A link resolved against its page as a browser does; null for links that are no web addresses."""

    def of(link: Column) -> Column:
        scheme = F.lower(F.regexp_extract(link, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
        folder = F.coalesce(non_empty(F.regexp_extract(path(base), r"^(.*/)", 1)), F.lit("/"))
        own, rest = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
        rooted = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(folder, own))
        return (
            F.when(scheme.isin("http", "https"), F.concat(scheme, F.substr(link, F.length(scheme) + 1)))
            .when(scheme != "", F.lit(None).cast("string"))
            .when(F.startswith(link, F.lit("//")), F.concat(F.substring_index(base, "//", 1), link))
            .when(F.startswith(link, F.lit("#")) | (link == ""), F.concat(F.substring_index(base, "#", 1), link))
            .when(F.startswith(link, F.lit("?")), F.concat(origin(base), path(base), link))
            .otherwise(F.concat(origin(base), _without_dots(rooted), rest))
        )

    return let(strip(href), of)


def unquote_direct_url(text: Column) -> Column:
    """Percent-decoded target of a ``?url=`` redirect."""
    raw = first_match(text, r'(?<=\?url=)([^"]+)')
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def url_hash(url: Column) -> Column:
    """Stable id of a URL: its whole digest, so that no two URLs share one."""
    return F.sha2(url, 256)


def _per_site(site: Column, make, otherwise: Column, table: dict) -> Column:
    rules = None
    for name, entry in table.items():
        value = make(entry)
        rules = F.when(site == name, value) if rules is None else rules.when(site == name, value)
    return rules.otherwise(otherwise)


def posting_id(site: Column, native_id: Column) -> Column:
    """Native id with the prefix of its board."""
    return _per_site(site, lambda p: F.concat(F.lit(p), native_id), native_id, ID_PREFIX)


def posting_url(site: Column, native_id: Column) -> Column:
    """Canonical posting URL of a board, null for boards without a template."""

    def fill(template: str) -> Column:
        head, _, tail = template.partition("{}")
        return F.concat(F.lit(head), native_id, F.lit(tail))

    return _per_site(site, fill, F.lit(None).cast("string"), POSTING_URL)


def seek_site(country: Column) -> Column:
    """``struct<base_url, site_key, locale>`` of a country, the first entry by default."""

    def entry(values: tuple[str, str, str]) -> Column:
        return F.struct(
            F.lit(values[0]).alias("base_url"),
            F.lit(values[1]).alias("site_key"),
            F.lit(values[2]).alias("locale"),
        )

    return _per_site(country, entry, entry(SEEK_SITES["australia"]), SEEK_SITES)


# ---- titles that are no postings --------------------------------------------------------------

def _one_word(title: Column) -> Column:
    return ~F.contains(strip(title), F.lit(" "))


def is_loose_title(title: Column) -> Column:
    """Titles of free-form JSON: not a menu word; single words must be long."""
    return F.coalesce(
        (F.length(title) >= 3)
        & ~F.lower(strip(title)).isin(*NON_JOB_TITLES)
        & ~(_one_word(title) & (F.length(title) < 20)),
        F.lit(False),
    )


def is_link_title(title: Column) -> Column:
    """Link texts: five characters or more, no call to action."""
    low = F.lower(title)
    return F.coalesce(
        (F.length(title) >= 5) & ~low.isin(*SKIP_LINK_TITLES) & ~low.rlike("|".join(SKIP_LINK_PARTS)),
        F.lit(False),
    )


def is_sitemap_title(title: Column) -> Column:
    """Titles from URL slugs: five characters or more; single words must be long."""
    return F.coalesce(
        (F.length(title) >= 5) & ~(_one_word(title) & (F.length(title) < 15)), F.lit(False)
    )


def board_domains(country: Column) -> Column:
    """``struct<indeed_subdomain, indeed_code, glassdoor_host>`` of a canonical country."""
    rows = country_records()
    return F.struct(
        *[
            lookup({r["country"]: r[name] for r in rows if r[name]}, country).alias(name)
            for name in ("indeed_subdomain", "indeed_code", "glassdoor_host")
        ]
    )


