"""Web pages: text, nodes, links, sitemaps, linked data, and the choice among strategies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import plain, pst, pst_sql, raw, spread, table
from checks.registry import query
from checks.selection import _CAREER_URL, career_urls
from vacancia.functions import markdown, markup, text, urls
from vacancia.plans import careers
from vacancia.sources import career_pages


def pages(spark, sf):
    """The web pages as a payload table."""
    df = spread(table(spark, sf, "pages"))
    return raw(df, F.col("html"), "custom", F.col("url"), seq="page_id")


# ---- text -------------------------------------------------------------------------------------

_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<[!?][^>]*>|</?[a-z](?:[^>\"'']|\"[^\"]*\"|''[^'']*'')*>"
_DECODED = """replace(replace(replace(replace({t}, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"""


@query(
    "html_to_text",
    f"""SELECT page_id, trim(regexp_replace({_DECODED.format(t=f"regexp_replace(html, '{_HIDDEN}', ' ', 'g')")}, '\\s+', ' ', 'g')) AS body FROM pages""",
)
def html_to_text(spark, sf):
    return spread(table(spark, sf, "pages")).select(
        "page_id", text.html_to_text(F.col("html")).alias("body")
    )


@query(
    "html_nodes",
    """SELECT page_id, len(regexp_extract_all(h, '<[a-zA-Z]')) AS elements, len(regexp_extract_all(h, '<a ')) AS links,
      len(regexp_extract_all(h, '<p>')) AS paragraphs FROM
      (SELECT page_id, regexp_replace(html, '(?s)(<script>|<style>).*?(</script>|</style>)', '\\1', 'g') AS h FROM pages)""",
)
def html_nodes(spark, sf):
    n = F.col("nodes")

    def count(match):
        return F.size(F.filter(n, match)).cast("bigint")

    return spread(table(spark, sf, "pages")).select(
        "page_id", markup.html_nodes(F.col("html")).alias("nodes")
    ).select(
        "page_id",
        count(lambda x: x["tag"] != "#text").alias("elements"),
        count(markup.tag("a")).alias("links"),
        count(markup.tag("p")).alias("paragraphs"),
    )


@query(
    "page_text_fields",
    """SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
      trim(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&quot;', '"'), '&amp;', '&')) AS headline,
      regexp_extract(html, '<div class="ad">([^<]*)</div>', 1) AS ad FROM pages""",
)
def page_text_fields(spark, sf):
    """Single fields by tag, attribute and class."""
    n = F.col("nodes")
    df = spread(table(spark, sf, "pages")).select(
        "page_id", markup.html_nodes(F.col("html")).alias("nodes")
    )
    return df.select(
        "page_id",
        markup.attr_of(markup.find(n, markup.tag("html")), "lang").alias("lang"),
        markup.text_of(n, markup.find(n, markup.tag("h1")), " ").alias("headline"),
        markup.text_of(
            n, markup.find(n, markup.both(markup.tag("div"), markup.has_class("ad")))
        ).alias("ad"),
    )


_FRAGMENT = """'<h2>' || title || '</h2><p><strong>' || company_name || '</strong> <em>' || site || '</em></p><ul><li>' || country
  || '</li><li><a href="' || job_url || '">apply</a></li></ul><p>' || job_type_text || '<br>end</p>'"""


def fragments(spark, sf):
    html = F.concat(
        F.lit("<h2>"), "title", F.lit("</h2><p><strong>"), "company_name", F.lit("</strong> <em>"),
        "site", F.lit("</em></p><ul><li>"), "country", F.lit('</li><li><a href="'), "job_url",
        F.lit('">apply</a></li></ul><p>'), F.coalesce("job_type_text", F.lit("any")),
        F.lit("<br>end</p>"),
    )
    return pst(spark, sf).select("*", html.alias("html"))


# Underscores are escaped in running text.
@query(
    "html_to_markdown",
    pst_sql("""SELECT seq, title || chr(10) || repeat('-', length(title)) || chr(10) || chr(10) || '**' || company_name || '** *' || replace(site, '_', '\\_') || '*'
      || chr(10) || chr(10) || '* ' || country || chr(10) || '* [apply](' || job_url || ')' || chr(10) || chr(10)
      || coalesce(job_type_text, 'any') || '  ' || chr(10) || 'end' AS body FROM pst"""),
)
def html_to_markdown(spark, sf):
    return fragments(spark, sf).select(
        "seq", markdown.html_to_markdown(F.col("html")).alias("body")
    )


@query(
    "convert_if_html",
    pst_sql("""SELECT seq, CASE WHEN seq % 3 = 0 THEN '**' || company_name || '**' ELSE company_name || ' & *co*' END AS body FROM pst"""),
)
def convert_if_html(spark, sf):
    body = F.when(
        F.col("seq") % 3 == 0, F.concat(F.lit("<b>"), "company_name", F.lit("</b>"))
    ).otherwise(F.concat("company_name", F.lit(" & *co*")))
    return pst(spark, sf).select("seq", markdown.convert_if_html(body).alias("body"))


@query(
    "strip_attributes",
    pst_sql("""SELECT seq, '<div><p class="x">' || title || '</p></div>' AS html FROM pst"""),
)
def strip_attributes(spark, sf):
    html = F.concat(
        F.lit("<div class='a>b' data-id=\""), F.col("seq").cast("string"),
        F.lit('" hidden><p class="x">'), "title", F.lit("</p></div>"),
    )
    return pst(spark, sf).select("seq", text.strip_attributes(html).alias("html"))


# ---- links ------------------------------------------------------------------------------------

_LINKS = """SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
  unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS text FROM pages"""
_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


@query(
    "page_links",
    f"SELECT page_id, href, text FROM ({_LINKS})",
)
def page_links(spark, sf):
    df = spread(table(spark, sf, "pages")).select(
        "page_id", F.explode(markup.page_links(F.col("html"))).alias("l")
    )
    return df.select("page_id", "l.href", "l.text")


# Pages whose navigation is rewritten to postings, a category page, a foreign one and a repeat.
_TAIL = """'<a href="/jobs/' || CAST(page_id AS VARCHAR) || '-engineer?ref=1">Engineer ' || CAST(page_id AS VARCHAR) || '</a>'
  || '<a href="/jobs/' || CAST(page_id AS VARCHAR) || '-engineer#x">Same again</a>'
  || CASE WHEN page_id % 3 > 0 THEN '<a href="https://careers.' || h || '/positions/analyst-' || CAST(page_id AS VARCHAR) || '">Analyst</a>' ELSE '' END
  || '<a href="/jobs/teams/">Our teams</a><a href="https://other.test/jobs/foreign-job">Foreign job</a><a href="/careers/learn-more-now">Learn more</a>'
  || '<a href="/careers/open-roles">View all jobs</a>'"""


def career_pages_input(spark, sf):
    """Every page with a career section at its end."""
    n = F.col("page_id").cast("string")
    h = urls.host(F.col("url"))
    tail = F.concat(
        F.lit('<a href="/jobs/'), n, F.lit('-engineer?ref=1">Engineer '), n, F.lit("</a>"),
        F.lit('<a href="/jobs/'), n, F.lit('-engineer#x">Same again</a>'),
        F.when(
            F.col("page_id") % 3 > 0,
            F.concat(
                F.lit('<a href="https://careers.'), h, F.lit("/positions/analyst-"), n,
                F.lit('">Analyst</a>'),
            ),
        ).otherwise(""),
        F.lit(
            '<a href="/jobs/teams/">Our teams</a><a href="https://other.test/jobs/foreign-job">Foreign job</a>'
            '<a href="/careers/learn-more-now">Learn more</a><a href="/careers/open-roles">View all jobs</a>'
        ),
    )
    df = spread(table(spark, sf, "pages"))
    return raw(df, F.concat("html", tail), "custom", F.col("url"), seq="page_id")


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))"


@query(
    "extract_job_links",
    f"""SELECT page_id AS seq, 'Engineer ' || CAST(page_id AS VARCHAR) AS title, {_ORIGIN} || '/jobs/' || CAST(page_id AS VARCHAR) || '-engineer?ref=1' AS job_url
      FROM pages WHERE page_id % 3 > 0 UNION ALL
      SELECT page_id, 'Analyst', 'https://careers.' || {_HOST} || '/positions/analyst-' || CAST(page_id AS VARCHAR) FROM pages WHERE page_id % 3 > 0""",
)
def extract_job_links(spark, sf):
    """Pages with one posting link only are left out."""
    return career_pages.extract_job_links(career_pages_input(spark, sf)).select(
        "seq", "title", "job_url"
    )


@query(
    "find_listing_link",
    # The first match: a posting link has /jobs/ in its path too, which is how listings are told.
    f"SELECT page_id AS seq, {_ORIGIN} || '/jobs/' || CAST(page_id AS VARCHAR) || '-engineer?ref=1' AS listing_url FROM pages",
)
def find_listing_link(spark, sf):
    return career_pages.find_listing_link(career_pages_input(spark, sf)).select("seq", "listing_url")


@query(
    "is_job_url",
    "SELECT page_id, href, regexp_matches(href, '(?i)/(careers|jobs|positions|openings|vacancies|job|listing|o|role|opportunity)/[a-z0-9][\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}-]{5,}') AS job FROM (SELECT page_id, '/jobs' || href AS href FROM (" + _LINKS + "))",
)
def is_job_url(spark, sf):
    """Over links put below ``/jobs``, with letters of any script."""
    df = page_links(spark, sf).select("page_id", F.concat(F.lit("/jobs"), "href").alias("href"))
    return df.select("page_id", "href", urls.is_job_url(F.col("href")).alias("job"))


@query(
    "is_category_url",
    f"""SELECT page_id, u, regexp_matches(u, '(?i)/(?:{'|'.join(urls.CATEGORY_PATHS)})(?:/|$|\\?)') OR regexp_matches(u, '(?i)/(?:{'|'.join(urls.CATEGORY_PREFIXES)})') AS category
      FROM (SELECT page_id, url || CASE page_id % 5 WHEN 0 THEN '/Teams/' WHEN 1 THEN '/our-story' WHEN 2 THEN '/internships?x=1' WHEN 3 THEN '/team-lead' ELSE '' END AS u FROM pages)""",
)
def is_category_url(spark, sf):
    k = F.col("page_id") % 5
    tail = (
        F.when(k == 0, "/Teams/").when(k == 1, "/our-story").when(k == 2, "/internships?x=1")
        .when(k == 3, "/team-lead").otherwise("")
    )
    df = table(spark, sf, "pages").select("page_id", F.concat("url", tail).alias("u"))
    return df.select("page_id", "u", urls.is_category_url(F.col("u")).alias("category"))


@query(
    "same_site",
    f"""SELECT page_id, a = b OR ends_with(a, '.' || b) OR ends_with(b, '.' || a) AS same FROM
      (SELECT page_id, {_HOST} AS a, CASE page_id % 4 WHEN 0 THEN {_HOST} WHEN 1 THEN 'jobs.' || {_HOST} WHEN 2 THEN 'x' || {_HOST} ELSE 'example.com' END AS b FROM pages)""",
)
def same_site(spark, sf):
    h, k = urls.host(F.col("url")), F.col("page_id") % 4
    other = (
        F.when(k == 0, h).when(k == 1, F.concat(F.lit("jobs."), h)).when(k == 2, F.concat(F.lit("x"), h))
        .otherwise("example.com")
    )
    return table(spark, sf, "pages").select("page_id", urls.same_site(h, other).alias("same"))


@query(
    "drop_tracker_hosts",
    f"""SELECT page_id FROM pages WHERE page_id % 4 > 1 AND length(html) >= 200""",
)
def drop_tracker_hosts(spark, sf):
    """Half of the responses come from analytics hosts."""
    df = table(spark, sf, "pages")
    k = F.col("page_id") % 4
    response = (
        F.when(k == 0, "https://www.google-analytics.com/collect")
        .when(k == 1, "https://o1.sentry.io/api/").otherwise(F.col("url"))
    )
    responses = raw(df, F.col("html"), "custom", F.col("url"), seq="page_id").withColumn(
        "k", F.col("seq")
    )
    named = df.select(F.col("page_id").alias("seq"), response.alias("response_url"))
    return career_pages.captured_bodies(responses.join(named, "seq")).select(
        F.col("seq").alias("page_id")
    )


@query("drop_apply_pages", "SELECT page_id FROM pages WHERE page_id % 3 <> 1")
def drop_apply_pages(spark, sf):
    bare = F.rtrim(urls.origin(F.col("url")), F.lit("/"))
    url = F.concat(
        bare, F.when(F.col("page_id") % 3 == 1, "/jobs/dev/apply/?x=1").otherwise("/jobs/apply-now")
    )
    df = table(spark, sf, "pages").withColumn("u", url)
    return df.where(~urls.is_apply_url(F.col("u"))).select("page_id")


@query(
    "title_from_slug",
    """SELECT p_partkey, array_to_string([upper(substr(w, 1, 1)) || lower(substr(w, 2)) FOR w IN string_split(p_name, ' ')], ' ') AS title FROM part""",
)
def title_from_slug(spark, sf):
    """Part names as slugs, some followed by a number, some by a UUID."""
    slug = F.replace("p_name", F.lit(" "), F.lit("-"))
    k = F.col("p_partkey") % 3
    url = F.concat(
        F.lit("https://a.test/careers/"), slug,
        F.when(k == 0, F.concat(F.lit("/"), F.col("p_partkey").cast("string")))
        .when(k == 1, "_79ddaec9-d32b-46c5-822b-f439074d896c").otherwise("/"),
    )
    return table(spark, sf, "part").select("p_partkey", urls.title_from_slug(url).alias("title"))


@query(
    "career_slug",
    f"""SELECT page_id, CASE WHEN page_id % 6 = 5 THEN h ELSE lower(h) END AS slug FROM
      (SELECT page_id, split_part(split_part(url, '//', 2), '.', 1) AS h FROM pages)""",
)
def career_slug(spark, sf):
    u = F.col("career_url")
    return career_urls(spark, sf).select(
        "page_id", urls.career_slug(u, urls.detect_platform(u)).alias("slug")
    )


@query(
    "detect_embedded_ats",
    f"""SELECT page_id AS seq, u AS platform_url, CASE page_id % 6 WHEN 0 THEN 'lever' WHEN 2 THEN 'greenhouse' ELSE 'workable' END AS platform
      FROM (SELECT page_id, {_CAREER_URL} AS u FROM (SELECT page_id, split_part(split_part(url, '//', 2), '.', 1) AS h FROM pages))
      WHERE page_id % 6 IN (0, 2, 4)""",
)
def detect_embedded_ats(spark, sf):
    """Career URLs put into a frame or a link; the sub-domain platforms are not found this way."""
    framed = career_urls(spark, sf).select("page_id", "career_url")
    pages_ = table(spark, sf, "pages").join(framed, "page_id")
    tail = F.when(
        F.col("page_id") % 4 < 2,
        F.concat(F.lit('<iframe width="9" src="'), "career_url", F.lit('"></iframe>')),
    ).otherwise(F.concat(F.lit('<a href="'), "career_url", F.lit('">x</a>')))
    df = raw(pages_, F.concat("html", tail), "custom", F.col("url"), seq="page_id")
    return career_pages.detect_embedded_ats(df).select("seq", "platform_url", "platform")


# ---- sitemaps and robots ----------------------------------------------------------------------

_URLSET = "https://a.test/careers/{slug}"


def sitemaps(spark, sf):
    """One sitemap per posting: the posting twice, a category page, an apply page, a second posting."""
    df = pst(spark, sf)
    slug = F.replace("title", F.lit(" "), F.lit("-"))
    k = F.col("seq").cast("string")
    day = F.coalesce(F.concat(F.lit("<lastmod>"), F.col("date_posted").cast("string"), F.lit("T08:00:00+02:00</lastmod>")), F.lit(""))

    def entry(*loc):
        return F.concat(F.lit("<url><loc> "), *loc, F.lit(" </loc>"), day, F.lit("</url>"))

    body = F.concat(
        F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
        entry(F.lit("https://a.test/careers/"), slug, F.lit("-"), k),
        entry(F.lit("https://a.test/careers/"), slug, F.lit("-"), k, F.lit("?src=2")),
        entry(F.lit("https://a.test/careers/locations/")),
        entry(F.lit("https://a.test/careers/"), slug, F.lit("/apply")),
        F.when(F.col("seq") % 2 == 0, entry(F.lit("https://a.test/jobs/second-role/"), k)).otherwise(""),
        F.lit("</urlset>"),
    )
    return raw(df, body, "custom", F.concat(F.lit("https://a.test/s"), k))


_SLUG = "replace(title, ' ', '-')"


@query(
    "parse_sitemap",
    pst_sql(f"""SELECT seq, loc, CAST(date_posted AS VARCHAR) || 'T08:00:00+02:00' AS lastmod FROM (
      SELECT seq, date_posted, unnest(['https://a.test/careers/' || {_SLUG} || '-' || CAST(seq AS VARCHAR), 'https://a.test/careers/' || {_SLUG} || '-' || CAST(seq AS VARCHAR) || '?src=2',
        'https://a.test/careers/locations/', 'https://a.test/careers/' || {_SLUG} || '/apply', CASE WHEN seq % 2 = 0 THEN 'https://a.test/jobs/second-role/' || CAST(seq AS VARCHAR) END]) AS loc FROM pst)
      WHERE loc IS NOT NULL"""),
)
def parse_sitemap(spark, sf):
    return career_pages.parse_sitemap(sitemaps(spark, sf)).select("seq", "loc", "lastmod")


@query(
    "sitemap_postings",
    pst_sql(f"""SELECT seq, array_to_string([upper(substr(w, 1, 1)) || lower(substr(w, 2)) FOR w IN string_split(title, ' ')], ' ') || ' ' || CAST(seq AS VARCHAR) AS title,
        'https://a.test/careers/' || {_SLUG} || '-' || CAST(seq AS VARCHAR) AS job_url, CAST(date_posted AS VARCHAR) AS date_posted FROM pst WHERE seq % 2 = 0
      UNION ALL SELECT seq, 'Second Role', 'https://a.test/jobs/second-role/' || CAST(seq AS VARCHAR), CAST(date_posted AS VARCHAR) FROM pst WHERE seq % 2 = 0"""),
)
def sitemap_postings(spark, sf):
    """Sitemaps with one posting only are left out."""
    return plain(
        career_pages.sitemap_postings(sitemaps(spark, sf)).select(
            "seq", "title", "job_url", "date_posted"
        )
    )


@query(
    "parse_robots_sitemaps",
    "SELECT page_id AS seq, unnest([rtrim(url, '/') || '/s1.xml', rtrim(url, '/') || '/s2.xml']) AS sitemap FROM pages",
)
def parse_robots_sitemaps(spark, sf):
    df = table(spark, sf, "pages")
    base = F.rtrim("url", F.lit("/"))
    body = F.concat(
        F.lit("User-agent: *\r\nSitemap: "), base, F.lit("/s1.xml\r\n  SITEMAP:"), base,
        F.lit("/s2.xml\nsitemap: /relative.xml\nDisallow: /sitemap: x"),
    )
    return career_pages.parse_robots_sitemaps(
        raw(df, body, "custom", F.col("url"), seq="page_id")
    ).select("seq", "sitemap")


@query(
    "sitemap_children",
    """SELECT page_id AS seq, unnest(CASE WHEN page_id % 2 = 0 THEN ['https://a.test/Jobs-' || CAST(page_id AS VARCHAR) || '.xml']
      ELSE ['https://a.test/a.xml', 'https://a.test/b.xml'] END) AS child FROM pages""",
)
def sitemap_children(spark, sf):
    df = table(spark, sf, "pages")
    k = F.col("page_id").cast("string")
    jobs = F.when(
        F.col("page_id") % 2 == 0,
        F.concat(F.lit("<sitemap><loc>https://a.test/Jobs-"), k, F.lit(".xml</loc></sitemap>")),
    ).otherwise("")
    body = F.concat(
        F.lit("<sitemapindex><sitemap><loc>https://a.test/a.xml</loc></sitemap>"), jobs,
        F.lit("<sitemap><loc>https://a.test/b.xml</loc></sitemap></sitemapindex>"),
    )
    return career_pages.sitemap_children(
        raw(df, body, "custom", F.col("url"), seq="page_id")
    ).select("seq", "child")


_ROOT = "'https://h' || CAST(page_id AS VARCHAR) || '.test/'"


@query(
    "reached_postings",
    f"""SELECT {_ROOT} || 'robots.txt' AS source_url, {_ROOT} || 'jobs/role-' || k || '-' || CAST(page_id AS VARCHAR) AS job_url
    FROM pages, (VALUES ('one', 1), ('two', 1), ('three', 2), ('four', 2), ('five', 3), ('six', 3)) AS t(k, part)
    WHERE part < 3 OR page_id % 2 = 0""",
)
def reached_postings(spark, sf):
    """Robots files that lead to an index, that to another and to itself, and these to sitemaps; one is linked to nowhere."""
    df = table(spark, sf, "pages").select("page_id")
    root = F.concat(F.lit("https://h"), F.col("page_id").cast("string"), F.lit(".test/"))

    def index(*names):
        return F.concat(F.lit("<sitemapindex>"), *[F.concat(F.lit("<sitemap><loc>"), root, F.lit(f"{n}</loc></sitemap>")) for n in names], F.lit("</sitemapindex>"))

    def entries(*names):
        each = [F.concat(F.lit("<url><loc>"), root, F.lit(f"jobs/role-{n}-"), F.col("page_id").cast("string"), F.lit("</loc></url>")) for n in names]
        return F.concat(F.lit("<urlset>"), *each, F.lit("</urlset>"))

    even = F.col("page_id") % 2 == 0
    files = {
        "robots.txt": F.concat(F.lit("User-agent: *\nSitemap: "), root, F.lit("index.xml\nSitemap: "), root, F.lit("missing.xml")),
        "index.xml": F.when(even, index("index.xml", "more.xml", "a.xml")).otherwise(index("more.xml", "a.xml")),
        "more.xml": F.when(even, index("index.xml", "b.xml", "deep.xml")).otherwise(index("b.xml", "a.xml")),
        "deep.xml": index("more.xml", "c.xml"),
        "a.xml": entries("one", "two"), "b.xml": entries("three", "four"), "c.xml": entries("five", "six"), "nowhere.xml": entries("seven", "eight"),
    }
    landed = reduce(DataFrame.unionByName, [
        raw(df, payload, "custom", F.concat(root, F.lit(name)), seq="page_id") for name, payload in files.items()])
    return career_pages.reached_postings(landed).select("source_url", "job_url")


# ---- linked data and embedded state -----------------------------------------------------------


def jsonld_pages(spark, sf):
    """A page per posting with linked data: in a graph, a list or alone; one in 13 is broken."""
    df = pst(spark, sf)
    posting = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"),
            F.col("title"),
            F.when(F.col("seq") % 3 > 0, F.col("job_url")).alias("url"),
            F.concat(F.lit("<p>"), F.coalesce("description", F.lit("")), F.lit("</p>")).alias("description"),
            F.struct(
                F.struct(
                    F.col("country").alias("addressCountry"), F.col("company_name").alias("addressLocality")
                ).alias("address")
            ).alias("jobLocation"),
            F.struct(
                F.lit("EUR").alias("currency"),
                F.struct(
                    F.col("comp_min").alias("minValue"), F.col("comp_max").alias("maxValue"),
                    F.upper(F.substring_index(F.element_at(F.create_map(
                        F.lit("hourly"), F.lit("hour"), F.lit("daily"), F.lit("day"), F.lit("weekly"),
                        F.lit("week"), F.lit("monthly"), F.lit("month"), F.lit("yearly"), F.lit("year")),
                        F.col("comp_interval")), " ", 1)).alias("unitText"),
                ).alias("value"),
            ).alias("baseSalary"),
            F.concat(F.col("date_posted").cast("string"), F.lit("T23:00:00-08:00")).alias("datePosted"),
            F.when(F.col("seq") % 4 == 0, "TELECOMMUTE").alias("jobLocationType"),
            F.array(F.lit("CONTRACTOR"), F.col("job_type_text")).alias("employmentType"),
            F.struct(F.concat(F.lit("Org "), F.col("company_name")).alias("name")).alias("hiringOrganization"),
            F.struct(F.col("id").alias("value")).alias("identifier"),
        )
    )
    shaped = (
        F.when(F.col("seq") % 13 == 0, F.concat(posting, F.lit("}")))
        .when(F.col("seq") % 3 == 0, F.concat(F.lit('{"@context":"x","@graph":['), posting, F.lit("]}")))
        .when(F.col("seq") % 3 == 1, F.concat(F.lit('[{"@type":"Organization"},'), posting, F.lit("]")))
        .otherwise(posting)
    )
    html = F.concat(
        F.lit('<html><head><meta property="og:description" content="'), F.repeat(F.lit("about us "), F.lit(8)),
        F.lit('"><script type="application/ld+json">'), shaped, F.lit("</script></head><body></body></html>"),
    )
    url = F.concat(F.lit("https://c.test/p/"), F.col("seq").cast("string"))
    return raw(df, html, "custom", url)


@query(
    "parse_jsonld_postings",
    pst_sql("""SELECT seq, 'custom:jsonld:' || id AS id, title, 'Org ' || company_name AS company,
      CASE WHEN seq % 3 > 0 THEN job_url ELSE 'https://c.test/p/' || CAST(seq AS VARCHAR) END AS job_url,
      company_name AS city, country, CAST(date_posted AS VARCHAR) AS date_posted, seq % 4 = 0 AS is_remote,
      CASE WHEN comp_min IS NOT NULL THEN comp_interval END AS interval, comp_min AS min_amount, comp_max AS max_amount,
      CASE WHEN comp_min IS NOT NULL THEN 'EUR' END AS currency,
      concat_ws(', ', CASE WHEN job_type_text = 'Part Time' THEN 'parttime' END, 'contract') AS job_type
      FROM pst WHERE seq % 13 <> 0"""),
)
def parse_jsonld_postings(spark, sf):
    df = career_pages.parse_jsonld_postings(jsonld_pages(spark, sf))
    return plain(
        df.select(
            "seq", "id", "title", F.col("company_name").alias("company"), "job_url",
            F.col("location.city").alias("city"), F.col("location.country").alias("country"),
            "date_posted", "is_remote", "compensation.*", F.array_join("job_type", ", ").alias("job_type"),
        )
    )


@query(
    "page_description",
    pst_sql("""SELECT seq, CASE WHEN seq % 13 <> 0 AND length(trim(description)) > 50 THEN trim(description) ELSE trim(repeat('about us ', 8)) END AS description FROM pst"""),
)
def page_description(spark, sf):
    return career_pages.page_description(jsonld_pages(spark, sf)).select("seq", "description")


def _state(df, wrap):
    """Three jobs as free-form JSON next to shorter and untitled arrays."""

    def job(i, title):
        return F.struct(
            title.alias("Title"),
            F.struct(F.col("country").alias("city"), F.col("site").alias("zone")).alias("location"),
            F.concat(F.col("id"), F.lit(f"-{i}")).alias("uid"),
            F.concat(F.lit("/jobs/"), F.col("id"), F.lit(f"/{i}")).alias("href"),
            F.concat(F.col("date_posted").cast("string"), F.lit("T01:00:00Z")).alias("posted_date"),
            F.lit("full time, remote").alias("worktype"),
        )

    jobs = F.array(
        job(0, F.concat("title", F.lit(" one"))),
        job(1, F.when(F.col("seq") % 2 == 0, "Engineering").otherwise(F.concat("title", F.lit(" two")))),
        job(2, F.concat("title", F.lit(" three"))),
    )
    menu = F.array(*[F.struct(F.lit(t).alias("name"), F.lit(i).alias("id")) for i, t in enumerate(
        ("About us", "Blog", "News", "Login"))])
    body = F.to_json(
        F.struct(
            F.struct(menu.alias("items")).alias("nav"),
            F.struct(F.struct(jobs.alias("rows")).alias("list")).alias("data"),
            F.array(F.lit(1), F.lit(2), F.lit(3)).alias("codes"),
        )
    )
    body = F.when(F.col("seq") % 13 == 0, F.concat(F.lit("<"), body)).otherwise(body)
    url = F.concat(F.lit("https://c.test/p/"), F.col("seq").cast("string"))
    return raw(df, wrap(body), "custom", url)


def state_pages(spark, sf):
    return _state(
        pst(spark, sf),
        lambda body: F.concat(
            F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":'),
            body, F.lit("}}</script></html>"),
        ),
    )


_LOOSE = """SELECT seq, i, title || CASE i WHEN 0 THEN ' one' WHEN 1 THEN ' two' ELSE ' three' END AS title, id || '-' || CAST(i AS VARCHAR) AS uid,
  'https://c.test/jobs/' || id || '/' || CAST(i AS VARCHAR) AS job_url, country, site, date_posted FROM (SELECT *, unnest([0, 1, 2]) AS i FROM pst)
  WHERE seq % 13 <> 0 AND NOT (i = 1 AND seq % 2 = 0)"""


def _loose_out(df):
    return plain(
        df.select(
            "seq", "id", "title", "job_url", F.col("location.city").alias("city"),
            F.col("location.country").alias("country"), "date_posted", "is_remote",
            F.array_join("job_type", ", ").alias("job_type"),
        )
    )


_LOOSE_OUT = """SELECT seq, 'custom:xhr:' || uid AS id, title, job_url, country AS city, site AS country, CAST(date_posted AS VARCHAR) AS date_posted,
  true AS is_remote, CAST(NULL AS VARCHAR) AS job_type FROM loose"""


@query("parse_next_data", pst_sql(_LOOSE_OUT, loose=_LOOSE))
def parse_next_data(spark, sf):
    return _loose_out(career_pages.parse_next_data(state_pages(spark, sf)))


@query(
    "find_job_arrays",
    pst_sql("""SELECT seq, path, CASE path WHEN 'nav.items' THEN 4 ELSE 3 END AS items FROM
      (SELECT seq, unnest(['nav.items', 'data.list.rows']) AS path FROM pst) WHERE seq % 13 <> 0"""),
)
def find_job_arrays(spark, sf):
    bodies = career_pages.next_data(state_pages(spark, sf))
    found = career_pages.find_job_arrays(bodies)
    return found.groupBy("seq", "path").agg(F.count(F.lit(1)).alias("items"))


@query("parse_loose_job", pst_sql(_LOOSE_OUT, loose=_LOOSE))
def parse_loose_job(spark, sf):
    """Every item of every array; those of the menu fail the title rules."""
    bodies = career_pages.next_data(state_pages(spark, sf))
    items = career_pages.find_job_arrays(bodies).join(
        bodies.select("seq", "url", "company"), "seq"
    )
    return _loose_out(career_pages.parse_loose_job(items))


@query("parse_captured", pst_sql(_LOOSE_OUT, loose=_LOOSE))
def parse_captured(spark, sf):
    """Captured responses; a tracker's copy and a too short body must not count."""
    bodies = _state(pst(spark, sf), lambda body: body)
    good = bodies.withColumn("response_url", F.lit("https://api.c.test/v1"))
    tracker = bodies.withColumn("response_url", F.lit("https://www.google.com/x")).withColumn(
        "seq", F.col("seq") + 1_000_000_000
    )
    short = good.withColumn("payload", F.lit("[]")).withColumn("seq", F.col("seq") + 2_000_000_000)
    return _loose_out(career_pages.parse_captured(good.union(tracker).union(short)))


@query(
    "career_strategies",
    pst_sql(
        """SELECT seq, title, 1 AS strategy_rank FROM loose
      UNION ALL SELECT seq, title, 2 FROM pst WHERE seq % 13 <> 0""",
        loose=_LOOSE,
    ),
)
def career_strategies(spark, sf):
    """Rows of the in-page strategies, side by side."""
    both = state_pages(spark, sf).withColumn("kind", F.lit(1)).unionByName(
        jsonld_pages(spark, sf).withColumn("kind", F.lit(2))
    )
    return careers.page_strategies(both.drop("kind")).select("seq", "title", "strategy_rank")


@query(
    "career_postings",
    pst_sql(
        """SELECT seq, title FROM loose WHERE seq % 2 = 0 UNION ALL SELECT seq, title FROM pst WHERE seq % 2 = 1 AND seq % 13 <> 0""",
        loose=_LOOSE,
    ),
)
def career_postings(spark, sf):
    """Even pages have both embedded state and linked data: the state wins."""
    state = state_pages(spark, sf)
    bare = F.replace("payload", F.lit("__NEXT_DATA__"), F.lit("other"))
    state = state.withColumn(
        "payload", F.when(F.col("seq") % 2 == 0, F.col("payload")).otherwise(bare)
    )
    return careers.career_postings(state.unionByName(jsonld_pages(spark, sf))).select("seq", "title")
