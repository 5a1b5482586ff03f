"""HTML payloads made from the projected postings and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import AS_OF, plain, pst, pst_sql, raw
from checks.payloads_json import C, _KS, _DAY, day_text, k, key, out
from checks.registry import query
from checks.scalars import _TYPED
from vacancia.functions import markup
from vacancia.operators.enrich import enrich_with_details
from vacancia.sources import boards_html
from vacancia.sources.payloads import ParseOptions

OPTIONS = ParseOptions(as_of=AS_OF)


def html(*parts):
    """Markup from texts and columns; a null column gives an empty text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def oracle(where="true", **columns):
    return pst_sql("SELECT " + ", ".join(f"{v} AS {n}" for n, v in columns.items()) + f" FROM pst WHERE {where}")


_PARTS = "string_split({t}, ', ')"
_LOC = "location_text"


def _nth(text, n):
    return f"string_split({text}, ', ')[{n}]"


# ---- LinkedIn ---------------------------------------------------------------------------------


def linkedin_raw(spark, sf):
    """Two cards per page; the second has nothing but a link."""
    salary = F.when(
        k() % 2 == 0,
        html('<span class="job-search-card__salary-info"> $', (30 + k() % 50).cast("string"), ",000.00 - <b>$", (90 + k() % 9).cast("string"), ",000.00</b></span>"),
    )
    card = html(
        '<ul><li><div class="base-card base-search-card x" data-x="1"><a class="base-card__full-link abs" href="https://ie.linkedin.com/jobs/view/role-at-x-', key(),
        '?refId=a-b"><span class="sr-only"> ', C("title"), ' </span></a><div class="base-search-card__info"><h4 class="base-search-card__subtitle">'
        '<a class="hidden" href="https://www.linkedin.com/company/acme?trk=1#top">', C("company_name"),
        '</a></h4><div class="base-search-card__metadata"><span class="job-search-card__location">', C("location_text"), "</span>", salary,
        F.when(k() % 3 > 0, '<time class="job-search-card__listdate').otherwise('<time class="job-search-card__listdate--new'), '" datetime="', day_text(),
        '">1 day ago</time></div></div></div></li><li><div class="base-search-card"><a class="base-card__full-link" href="/jobs/view/9', key(),
        '">x</a></div></li><li><div class="base-search-card"><p>no link</p></div></li></ul>',
    )
    return raw(pst(spark, sf), card, "linkedin")


_LI_N = f"len(string_split({_LOC}, ', '))"


@query(
    "parse_linkedin_cards",
    pst_sql(f"""SELECT 'li-' || {_KS} AS id, title, company_name, 'https://www.linkedin.com/company/acme#top' AS company_url, 'https://www.linkedin.com/jobs/view/' || {_KS} AS job_url,
      CASE WHEN {_LI_N} IN (2, 3) THEN {_nth(_LOC, 1)} END AS city, CASE WHEN {_LI_N} IN (2, 3) THEN {_nth(_LOC, 2)} END AS state,
      CASE WHEN {_LI_N} = 3 THEN lower({_nth(_LOC, 3)}) ELSE 'usa' END AS country, {_DAY} AS date_posted,
      CASE WHEN seq % 2 = 0 THEN (30 + seq % 50) * 1000.0 END::DOUBLE AS min_amount, CASE WHEN seq % 2 = 0 THEN (90 + seq % 9) * 1000.0 END::DOUBLE AS max_amount,
      CASE WHEN seq % 2 = 0 THEN 'USD' END AS currency, contains(lower(title), 'remote') AS is_remote, '' AS job_level FROM pst
      UNION ALL SELECT 'li-/jobs/view/9' || {_KS}, 'N/A', 'N/A', '', 'https://www.linkedin.com/jobs/view//jobs/view/9' || {_KS}, NULL, NULL, 'usa', NULL, NULL, NULL, NULL, false, '' FROM pst"""),
)
def parse_linkedin_cards(spark, sf):
    return out(
        boards_html.parse_linkedin_cards(linkedin_raw(spark, sf), OPTIONS),
        "id title company_name company_url job_url city state country date_posted min_amount max_amount currency is_remote job_level",
    )


def linkedin_detail_raw(spark, sf):
    def criterion(label, value):
        return [
            f'<li><h3 class="description__job-criteria-subheader">\n  {label}\n</h3>'
            '<span class="description__job-criteria-text description__job-criteria-text--criteria"> ', value, " </span></li>",
        ]

    page = html(
        '<html><body><img class="artdeco-entity-image lazy" data-delayed-url="https://i.test/logo.png"><code id="applyUrl" style="display: none"><!--"https://www.linkedin.com/redir?url=https%3A%2F%2Fc.test%2Fa%2Bb%3Fx%3D',
        key(), '&urlHash=z"--></code><div class="show-more-less-html__markup rel"><p>', C("description"), "</p></div><ul>",
        *criterion("Seniority level", C("site")), *criterion("Employment type", C("job_type_text")), *criterion("Job function", C("country")),
        *criterion("Industries", C("company_name")), "</ul></body></html>",
    )
    return raw(pst(spark, sf), page, "linkedin", F.concat(F.lit("https://www.linkedin.com/jobs/view/"), key()))


_LI_TYPE = "CASE job_type_text WHEN 'full-time' THEN 'fulltime' WHEN 'Contract' THEN 'contract' WHEN 'Praktikum' THEN 'internship' ELSE '' END"


@query(
    "parse_linkedin_detail",
    oracle(
        id=f"'li-' || {_KS}", description="coalesce(trim(description), '')", job_level="site", company_industry="company_name", types=_LI_TYPE,
        job_function="country", company_logo="'https://i.test/logo.png'", job_url_direct=f"'https://c.test/a+b?x=' || {_KS} || '&urlHash=z'",
    ),
)
def parse_linkedin_detail(spark, sf):
    """``Part Time`` with a blank is no spelling this board's rule knows."""
    df = boards_html.parse_linkedin_detail(linkedin_detail_raw(spark, sf), OPTIONS)
    return out(df, "id description job_level company_industry types job_function company_logo job_url_direct")


@query(
    "enrich_linkedin",
    pst_sql(f"""SELECT 'li-' || {_KS} AS id, title, nullif(trim(description), '') AS description, site AS job_level, country AS job_function, nullif({_LI_TYPE}, '') AS types FROM pst
      UNION ALL SELECT 'li-/jobs/view/9' || {_KS}, 'N/A', NULL, '', NULL, NULL FROM pst"""),
)
def enrich_linkedin(spark, sf):
    """Cards completed with their detail pages; a later copy of a page does not count."""
    cards = boards_html.parse_linkedin_cards(linkedin_raw(spark, sf), OPTIONS)
    pages = linkedin_detail_raw(spark, sf)
    again = pages.withColumn("seq", C("seq") + 1_000_000_000).withColumn("payload", F.lit("<p>later copy</p>"))
    details = boards_html.parse_linkedin_detail(pages.unionByName(again), OPTIONS)
    done = enrich_with_details(
        cards, details, override=("description", "job_level", "job_function", "job_type", "company_industry", "company_logo", "job_url_direct"),
        job_type="keep",
    )
    return done.select("id", "title", "description", "job_level", "job_function", F.array_join("job_type", ", ").alias("types"))


# ---- detail pages -----------------------------------------------------------------------------


def zip_detail_raw(spark, sf):
    state = F.when(k() % 3 > 0, html('{"model":{"saveJobURL":"/save?x=1&job_url=', C("job_url"), '"}}')).otherwise('{"model":{}}')
    firm = F.when(k() % 2 == 0, html('<section class="company_description"><p>About ', C("company_name"), "</p></section>"))
    page = html('<div class="y job_description"><b>', C("title"), "</b></div><div>other</div>", firm, '<script type="application/json">', state, "</script>")
    url = F.concat(F.lit("https://www.ziprecruiter.com/jobs//j?lvk="), C("id"))
    return raw(pst(spark, sf), page, "zip_recruiter", url)


@query(
    "parse_ziprecruiter_detail",
    oracle(
        id="'zr-' || id", description="concat_ws(chr(10) || chr(10), '**' || title || '**', CASE WHEN seq % 2 = 0 THEN 'About ' || company_name END)",
        job_url_direct="CASE WHEN seq % 3 > 0 THEN job_url END",
    ),
)
def parse_ziprecruiter_detail(spark, sf):
    return boards_html.parse_ziprecruiter_detail(zip_detail_raw(spark, sf), OPTIONS).drop("seq")


def seek_detail_raw(spark, sf):
    """A marked span wins over a marked div; every fifth page has neither."""
    inner = html(C("title"), F.when(k() % 2 == 0, html("<ul><li>", C("company_name"), "</li></ul>")))
    page = F.when(k() % 5 == 0, "<p>none</p>").when(
        k() % 3 == 0, html('<div data-automation="jobAdDetails">wrong</div><span data-automation="jobAdDetails">', inner, "</span>")
    ).otherwise(html('<div class="a" data-automation="jobAdDetails">', inner, "</div>"))
    url = F.concat(F.lit("https://www.seek.com.au/job/"), key())
    return raw(pst(spark, sf), page, "seek", url)


@query(
    "parse_seek_detail",
    oracle(id=_KS, description="CASE WHEN seq % 5 > 0 THEN title || CASE WHEN seq % 2 = 0 THEN chr(10) || chr(10) || '* ' || company_name ELSE '' END END"),
)
def parse_seek_detail(spark, sf):
    return boards_html.parse_seek_detail(seek_detail_raw(spark, sf), OPTIONS).drop("seq")


# ---- Bayt, BDJobs -----------------------------------------------------------------------------


def bayt_raw(spark, sf):
    """Every seventh listing has no link."""
    page = html(
        '<ul><li data-js-job=""><h2 class="x"> ', F.when(k() % 7 > 0, html('<a href=" /en/job-', key(), ' ">')), C("title"), F.when(k() % 7 > 0, "</a>"), "</h2>",
        F.when(k() % 4 > 0, html('<div class="t-nowrap p10l"><span>', C("company_name"), "</span></div>")), '<div class="t-mute t-small"> ', C("location_text"),
        ' </div></li><li data-js-job="x"><h2><a href="/no">no</a></h2></li></ul>',
    )
    return raw(pst(spark, sf), page, "bayt")


@query(
    "parse_bayt",
    oracle(
        where="seq % 7 > 0", id=f"'bayt-' || sha256('https://www.bayt.com/en/job-' || {_KS})", title="title",
        company_name="CASE WHEN seq % 4 > 0 THEN company_name END", city="coalesce(location_text, '')", country="'worldwide'", job_url=f"'https://www.bayt.com/en/job-' || {_KS}",
    ),
)
def parse_bayt(spark, sf):
    return out(boards_html.parse_bayt(bayt_raw(spark, sf), OPTIONS), "id title company_name city country job_url")


def bdjobs_raw(spark, sf):
    """Cards of three kinds; half of the links have no text, so the heading counts."""
    href = F.when(k() % 3 == 0, html("/jobdetails.asp?jobid=", key(), "&amp;ln=1")).otherwise(html("/jobdetails/", key()))
    kind = F.when(k() % 4 == 0, "job-item extra").when(k() % 4 == 1, "norm-jobs-wrapper").when(k() % 4 == 2, "featured-wrap").otherwise("plain")
    page = html(
        '<div class="', kind, '"><a href="', href, '">', F.when(k() % 2 == 0, C("title")), '</a><div class="job-title-text">Alt ', C("title"), "</div>",
        F.when(k() % 5 > 0, html('<span class="Comp-Name-Text">', C("company_name"), "</span>")),
        F.when(C("location_text").isNotNull(), html('<span class="', F.when(k() % 2 == 0, "locon-text-d").otherwise("job-location"), '">', C("location_text"), "</span>")),
        '<div class="published-on">Deadline: ', F.date_format("date_posted", "d MMM yyyy"), "</div></div>",
    )
    return raw(pst(spark, sf), page, "bdjobs")


@query(
    "parse_bdjobs_cards",
    oracle(
        id=f"CASE WHEN seq % 3 = 0 THEN {_KS} ELSE 'bdjobs-' || sha256('https://jobs.bdjobs.com/jobdetails/' || {_KS}) END",
        title="CASE WHEN seq % 2 = 0 THEN title ELSE 'Alt ' || title END", company_name="CASE WHEN seq % 5 > 0 THEN company_name ELSE 'N/A' END",
        city="CASE WHEN location_text IS NULL THEN 'Dhaka' ELSE trim(split_part(location_text, ',', 1)) END",
        state="CASE WHEN location_text IS NULL THEN 'Bangladesh' ELSE nullif(trim(split_part(location_text, ',', 2)), '') END", country="'bangladesh'",
        date_posted=_DAY, is_remote="contains(lower(concat_ws(' ', title, location_text)), 'remote')",
        job_url=f"CASE WHEN seq % 3 = 0 THEN 'https://jobs.bdjobs.com/jobdetails.asp?jobid=' || {_KS} || '&ln=1' ELSE 'https://jobs.bdjobs.com/jobdetails/' || {_KS} END",
    ),
)
def parse_bdjobs_cards(spark, sf):
    return out(
        boards_html.parse_bdjobs_cards(bdjobs_raw(spark, sf), OPTIONS),
        "id title company_name city state country date_posted is_remote job_url",
    )


def bdjobs_detail_raw(spark, sf):
    listed = html(
        '<div class="jobcontent"><h5>Context</h5><p>skip</p><h4>Job Responsibilities</h4><ul><li>', C("title"), "</li><li>second <i>item</i></li></ul><p>",
        C("company_name"), "</p><h5>Other</h5><p>not this</p></div>",
    )
    block = html('<section class="Job-Description x"><p>Do <b>', C("title"), "</b></p></section>")
    page = html(
        F.when(k() % 3 == 0, listed).when(k() % 3 == 1, block), "<div><span>Employment Type</span><span>", C("job_type_text"),
        "</span></div><div>Industry:</div><div>", C("country"), "</div>",
    )
    url = F.concat(F.lit("https://jobs.bdjobs.com/jobdetails.asp?jobid="), key(), F.lit("&ln=1"))
    return raw(pst(spark, sf), page, "bdjobs", url)


@query(
    "parse_bdjobs_detail",
    oracle(
        id=_KS, description="""CASE seq % 3 WHEN 0 THEN title || chr(10) || 'second item' || chr(10) || company_name
          WHEN 1 THEN 'Do **' || title || '**' ELSE '' END""",
        types="CASE job_type_text WHEN 'full-time' THEN 'fulltime' WHEN 'Part Time' THEN 'parttime' WHEN 'Contract' THEN 'contract' WHEN 'Praktikum' THEN 'internship' ELSE '' END",
        company_industry="country",
    ),
)
def parse_bdjobs_detail(spark, sf):
    return out(
        boards_html.parse_bdjobs_detail(bdjobs_detail_raw(spark, sf), OPTIONS), "id description types company_industry"
    )


@query(
    "first_matching_selector",
    pst_sql("SELECT seq, CASE seq % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS rank, CASE seq % 4 WHEN 3 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS cards FROM pst"),
)
def first_matching_selector(spark, sf):
    """The best class decides, even when a worse one marks more elements."""
    kind = F.when(k() % 4 == 1, "norm-jobs-wrapper").when(k() % 4 == 2, "featured-wrap").when(k() % 4 == 0, "featured-wrap").otherwise("x")
    page = html('<div class="', kind, '">a</div><div class="', kind, '">b</div>', F.when(k() % 4 == 0, '<div class="job-item">c</div>'))
    df = raw(pst(spark, sf), page).withColumn("nodes", markup.html_nodes(C("payload")))
    found = boards_html.first_matching_selector(C("nodes"), boards_html.BDJOBS_CARDS)
    return df.select("seq", found.alias("f")).select("seq", "f.rank", F.coalesce(F.size("f.cards"), F.lit(0)).alias("cards"))


# ---- IrishJobs --------------------------------------------------------------------------------

_IRISH_DAY = f"CASE date_label WHEN 'Today' THEN DATE '{AS_OF}' WHEN '3 days ago' THEN DATE '{AS_OF}' - 3 WHEN 'posted 2 weeks ago' THEN DATE '{AS_OF}' - 14 WHEN '15 Jan 2024' THEN DATE '2024-01-15' END"
_IRISH = dict(
    title="title", company_name="company_name", city="trim(split_part(location_text, ',', 1))", state="nullif(trim(split_part(location_text, ',', 2)), '')", country="'ireland'",
    min_amount="CAST(CASE seq % 6 WHEN 0 THEN 5 + seq % 20 WHEN 1 THEN 1 WHEN 3 THEN (30 + seq % 40) * 1000 WHEN 4 THEN 35 + seq % 9 END AS DOUBLE)",
    currency="CASE WHEN seq % 6 IN (0, 1, 3, 4) THEN 'EUR' END",
)
_IRISH_TYPE = "CASE job_type_text WHEN 'full-time' THEN 'fulltime' WHEN 'Part Time' THEN 'parttime' WHEN 'Contract' THEN 'contract' {more} END"


def irish_raw(spark, sf):
    link = html('<a data-', F.when(k() % 2 == 0, "testid").otherwise("at"), '="job-item-title" href="', F.when(k() % 5 > 0, html("/job/dev-job", key())), '"> ', C("title"), " </a>")

    def field(name, value):
        return F.when(value.isNotNull(), html(f'<span data-at="job-item-{name}">', value, "</span>"))

    page = html(
        '<article data-testid="job-item"><h2>', link, "</h2>", field("company-name", C("company_name")), field("location", C("location_text")),
        field("salary-info", C("salary_label")), field("timeago", C("date_label")), '<span class="my-job-type">', C("job_type_text"), "</span></article>",
    )
    return raw(pst(spark, sf), page, "irish_jobs")


@query(
    "parse_irishjobs_cards",
    oracle(
        where="seq % 5 > 0", id=f"'ij-' || {_KS}", job_url=f"'https://www.irishjobs.ie/jobs/' || {_KS}", date_posted=f"CAST({_IRISH_DAY} AS VARCHAR)",
        types=_IRISH_TYPE.format(more=""), is_remote="regexp_matches(concat_ws(chr(10), title, location_text), '(?i)\\bremote\\b')", **_IRISH,
    ),
)
def parse_irishjobs_cards(spark, sf):
    return out(
        boards_html.parse_irishjobs_cards(irish_raw(spark, sf), OPTIONS),
        "id title company_name job_url city state country min_amount currency date_posted types is_remote",
    )


def irish_jsonld_raw(spark, sf):
    """Linked data as an item list or as a list; pages with cards do not use it."""
    df = pst(spark, sf)
    # One bound alone stands for both; here both are given or neither is.
    pay = F.when(C("comp_max").isNotNull(), F.struct(
        F.struct(C("comp_min").alias("minValue"), C("comp_max").alias("maxValue")).alias("value"), F.lit("EUR").alias("currency")))
    pay = F.when(C("comp_max").isNull() & C("comp_min").isNotNull(), F.struct(
        F.struct(C("comp_min").alias("minValue"), F.lit(None).cast("double").alias("maxValue")).alias("value"), F.lit("EUR").alias("currency"))).otherwise(pay)
    posting = F.to_json(F.struct(
        F.lit("JobPosting").alias("@type"), C("title"), F.concat(F.lit("/job/dev-job"), key()).alias("url"),
        F.struct(C("company_name").alias("name")).alias("hiringOrganization"),
        F.struct(F.struct(C("country").alias("addressLocality")).alias("address")).alias("jobLocation"), pay.alias("baseSalary"),
        day_text().alias("datePosted"), C("job_type_text").alias("employmentType"), C("description").alias("description"),
    ))
    body = F.when(k() % 2 == 0, html('{"@type":"ItemList","itemListElement":[{"@type":"ListItem","item":', posting, "}]}")).otherwise(
        html('[{"@type":"Organization"},', posting, "]"))
    page = html('<script type="application/ld+json">', body, "</script>", F.when(k() % 4 == 3, '<p data-testid="job-item"></p>'))
    return raw(df, page, "irish_jobs")


@query(
    "parse_irishjobs_jsonld",
    oracle(
        where="seq % 4 < 3", id=f"'ij-' || {_KS}", title="title", company_name="company_name", job_url=f"'https://www.irishjobs.ie/jobs/' || {_KS}", city="country",
        min_amount="comp_min", max_amount="comp_max", currency="CASE WHEN comp_min IS NOT NULL THEN 'EUR' END", date_posted=_DAY, description="description",
        types=f"CASE job_type_text WHEN 'Part Time' THEN 'parttime' WHEN 'Contract' THEN 'contract' WHEN 'full-time' THEN 'fulltime' ELSE nullif({_TYPED.format(t='description')}, 'none') END",
    ),
)
def parse_irishjobs_jsonld(spark, sf):
    return plain(
        out(boards_html.parse_irishjobs_jsonld(irish_jsonld_raw(spark, sf), OPTIONS),
            "id title company_name job_url city min_amount max_amount currency date_posted description types")
        .withColumn("max_amount", F.when(C("max_amount") != C("min_amount"), C("max_amount")))
    )


@query(
    "build_irishjobs_row",
    oracle(
        id=f"CASE WHEN seq % 2 = 0 THEN 'ij-' || {_KS} ELSE 'ij-' || sha256('https://x.test/r/' || {_KS}) END",
        job_url=f"CASE WHEN seq % 2 = 0 THEN 'https://www.irishjobs.ie/jobs/' || {_KS} ELSE 'https://x.test/r/' || {_KS} END",
        description="CASE WHEN seq % 3 = 0 THEN '**' || title || '** wfh' ELSE description END",
        types=f"coalesce({_IRISH_TYPE.format(more='')}, CASE WHEN seq % 3 > 0 THEN nullif({_TYPED.format(t='description')}, 'none') END)",
        is_remote="seq % 3 = 0 OR regexp_matches(concat_ws(chr(10), CASE WHEN seq % 3 > 0 THEN description END, title, location_text), '(?i)\\b(remote|wfh|work from home)\\b')",
        **_IRISH,
    ),
)
def build_irishjobs_row(spark, sf):
    url = F.when(k() % 2 == 0, html("https://x.test/dev-job", key())).otherwise(html("https://x.test/r/", key()))
    text = F.when(k() % 3 == 0, html("<b>", C("title"), "</b> wfh")).otherwise(C("description"))
    rows = pst(spark, sf).select(
        "seq", F.lit(0).alias("pos"), "title", url.alias("url"), C("company_name").alias("company"), C("location_text").alias("place"),
        C("salary_label").alias("pay"), C("date_label").alias("day"), C("job_type_text").alias("kind"), text.alias("description"),
    )
    return out(
        boards_html.build_irishjobs_row(rows, OPTIONS),
        "id job_url description types is_remote title company_name city state country min_amount currency",
    )


# ---- JazzHR -----------------------------------------------------------------------------------


def jazzhr_raw(spark, sf):
    page = html(
        '<ul><li class="list-group-item"><h3 class="list-group-item-heading"><a href="/apply/', C("id"), '/role">', C("title"),
        '</a></h3><ul class="list-group-item-text"><li><i class="fa fa-map-marker"></i> ', C("location_text"),
        ' </li><li><i class="fa fa-sitemap"></i> Dept</li></ul></li><li class="list-group-item"><p>empty</p></li></ul>',
    )
    url = F.concat(F.lit("https://"), F.replace("site", F.lit("_"), F.lit("-")), F.lit(".applytojob.com/apply"))
    return raw(pst(spark, sf), page, "jazzhr", url)


@query(
    "parse_jazzhr",
    oracle(
        id="'jazzhr:' || replace(site, '_', '-') || ':' || id", title="title", job_url="'https://' || replace(site, '_', '-') || '.applytojob.com/apply/' || id || '/role'",
        city="nullif(trim(split_part(location_text, ',', 1)), 'Remote')", state="CASE WHEN len(string_split(location_text, ',')) >= 3 THEN trim(split_part(location_text, ',', 2)) END",
        country="CASE len(string_split(location_text, ',')) WHEN 3 THEN trim(split_part(location_text, ',', 3)) WHEN 2 THEN trim(split_part(location_text, ',', 2)) END",
        is_remote="regexp_matches(lower(concat_ws(' ', title, location_text)), '\\bremote\\b')",
    ),
)
def parse_jazzhr(spark, sf):
    return out(boards_html.parse_jazzhr(jazzhr_raw(spark, sf), OPTIONS), "id title job_url city state country is_remote")


@query("jazzhr_detail", oracle(job_url="job_url", description="title || chr(10) || '=' || repeat('=', length(title) - 1) || chr(10) || chr(10) || company_name"))
def jazzhr_detail(spark, sf):
    page = html('<div id="x">no</div><div id="job-description" class="d"><h1>', C("title"), "</h1><p>", C("company_name"), "</p></div>")
    return boards_html.parse_jazzhr_detail(raw(pst(spark, sf), page, "jazzhr", C("job_url"))).drop("seq")
