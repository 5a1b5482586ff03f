"""The main job over payloads of every site at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks import payloads_html as h
from checks import payloads_json as j
from checks import social as posts
from checks.assembly import postings
from checks.inputs import AS_OF, pst_sql
from checks.registry import ORACLES, query
from vacancia.plans.collect import SearchSpec, collect_landed, complete_landed, quarantine_landed, select_postings
from vacancia.session import cut_lineage
from vacancia.sources.payloads import ParseOptions

OPTIONS = ParseOptions(as_of=AS_OF)


def tweets_raw(spark, sf):
    df = posts.tweets(spark, sf)
    payload = F.to_json(F.array(F.struct("id", "handle", "name", "text", "iso", "permalink", "links")))
    none = F.lit(None).cast("string")
    return df.select("seq", F.lit("twitter").alias("site"), F.lit(None).cast("timestamp").alias("fetched_at"),
                     none.alias("url"), none.alias("company"), payload.alias("payload"))


# Site (or site and kind) -> builders of its payloads, and the queries that parse just these.
LANDED = {
    "linkedin": ((h.linkedin_raw,), ("parse_linkedin_cards",)),
    "indeed": ((j.indeed_raw,), ("parse_indeed",)),
    "zip_recruiter": ((j.zip_raw,), ("parse_ziprecruiter",)),
    "glassdoor": ((j.glassdoor_raw,), ("parse_glassdoor",)),
    "google": ((j.google_initial_raw, j.google_page_raw), ("parse_google_initial", "parse_google_page")),
    "bayt": ((h.bayt_raw,), ("parse_bayt",)),
    "naukri": ((j.naukri_raw,), ("parse_naukri",)),
    "bdjobs": ((h.bdjobs_raw,), ("parse_bdjobs_cards",)),
    "seek": ((j.seek_raw,), ("parse_seek",)),
    "reed": ((j.reed_raw,), ("parse_reed",)),
    "irish_jobs": ((h.irish_raw, h.irish_jsonld_raw), ("parse_irishjobs_cards", "parse_irishjobs_jsonld")),
    "twitter": ((tweets_raw,), ("parse_tweets",)),
    "linkedin_posts": ((posts.inner_texts,), ("parse_linkedin_posts",)),
    "greenhouse": ((j.greenhouse_raw,), ("parse_greenhouse",)),
    "lever": ((j.lever_raw,), ("parse_lever",)),
    "ashby": ((j.ashby_raw,), ("parse_ashby",)),
    "smartrecruiters": ((j.smartrecruiters_raw,), ("parse_smartrecruiters",)),
    "workable": ((j.workable_raw,), ("parse_workable",)),
    "bamboohr": ((j.bamboohr_raw,), ("parse_bamboohr",)),
    "jazzhr": ((h.jazzhr_raw,), ("parse_jazzhr",)),
}
DETAILS = {
    "linkedin_detail": h.linkedin_detail_raw, "zip_recruiter_detail": h.zip_detail_raw, "seek_detail": h.seek_detail_raw,
    "bdjobs_detail": h.bdjobs_detail_raw, "reed_detail": j.reed_details_raw, "workable_detail": j.workable_detail_raw,
    "bamboohr_detail": j.bamboohr_detail_raw,
}


def landed(spark, sf, sites=tuple(LANDED)):
    """Payloads of the sites and of their details in one written table, as they land."""
    frames = [(s, build) for s in sites for build in LANDED[s][0]]
    frames += [(s, build) for s, build in DETAILS.items() if s.removesuffix("_detail") in sites]
    return cut_lineage(
        reduce(lambda a, b: a.unionByName(b), [build(spark, sf).withColumn("site", F.lit(s)) for s, build in frames]), "landed",
        by=["site"],  # every site's parser reads the table
    )


def _counts():
    parts = [f"SELECT '{s}' AS site FROM ({ORACLES[q]})" for s, (_, queries) in LANDED.items() for q in queries]
    return f"SELECT site, count(*) AS postings FROM ({' UNION ALL '.join(parts)}) GROUP BY site"


@query("collect_every_site", _counts())
def collect_every_site(spark, sf):
    """All boards and career platforms, with the details that have landed for seven of them."""
    found = complete_landed(landed(spark, sf), list(LANDED), OPTIONS)
    return found.groupBy("site").agg(F.count(F.lit(1)).alias("postings"))


@query(
    "collect_details",
    f"""SELECT l.id, d.description, d.job_level FROM ({ORACLES['parse_linkedin_cards']}) l LEFT JOIN
      (SELECT id, nullif(description, '') AS description, job_level FROM ({ORACLES['parse_linkedin_detail']})) d ON l.id = d.id""",
)
def collect_details(spark, sf):
    """Names in any letter case; the board's details reach its rows."""
    spec = SearchSpec(site_name=" LinkedIn", results_wanted=None, as_of=AS_OF)
    found = complete_landed(landed(spark, sf, ("linkedin", "seek")), ["LinkedIn"], spec.options())
    return found.select("id", "description", F.when(F.length("job_level") > 0, F.col("job_level")).alias("job_level"))


@query(
    "request_terms",
    pst_sql("""SELECT site, count(*) AS n FROM (SELECT CASE WHEN site = 'naukri' THEN 'google' ELSE site END AS site, title, seq FROM pst)
      WHERE CASE WHEN site = 'google' THEN contains(lower(title), 'intern') ELSE contains(lower(title), 'engineer') END
        AND (site <> 'linkedin' OR seq % 4 = 2 OR seq % 4 = 1) GROUP BY site"""),
)
def request_terms(spark, sf):
    """One board has its own search term, another is narrowed to two companies."""
    df = postings(spark, sf).withColumns({
        "site": F.when(F.col("site") == "naukri", "google").otherwise(F.col("site")),
        "id": F.col("seq").cast("string"), "job_url": F.col("seq").cast("string"), "description": F.lit(None).cast("string"),
        "company_id": F.col("seq") % 4,
    })
    spec = SearchSpec(search_term="engineer", google_search_term="intern", linkedin_company_ids=[1, 2], results_wanted=None)
    return select_postings(df, spec).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


def quarantined(spark, sf):
    """What cannot be read of all landed rows, with two such payloads planted for each site; one is nested deeply."""
    rows = landed(spark, sf)
    deep = "[" * 5000 + "]" * 5000
    broken = spark.createDataFrame(
        [(-1 - i, s, None, "https://a.test/x", None, p) for s in LANDED for i, p in enumerate(('{"x": [', deep))], rows.schema
    )
    return rows, quarantine_landed(rows.unionByName(broken), list(LANDED), OPTIONS)


# What the builders make unreadable: every 13th JSON payload, and by site cards or records without a link or title.
_JSON = ("indeed", "zip_recruiter", "glassdoor", "naukri", "seek", "reed", "greenhouse", "lever", "ashby", "smartrecruiters",
         "workable", "bamboohr")
_LACKING = {
    "seek": "seq % 10 = 0 AND seq % 13 > 0",
    "linkedin": "true",  # the last card of every page is empty
    "jazzhr": "true",
    "bayt": "seq % 7 = 0",
}


def _quarantined_sql():
    # A post is plain text, so only the shorter of the planted payloads is none.
    planted = [(s, "unreadable payload" if s in _JSON else "no posting read", 2 - (s == "linkedin_posts")) for s in LANDED]
    parts = [f"SELECT * FROM (VALUES {', '.join(map(str, planted))}) AS t(site, reason, n)"]
    parts += [f"SELECT '{s}', 'unreadable payload', count(*) FROM pst WHERE seq % 13 = 0" for s in (*_JSON, "google")]
    parts += [f"SELECT '{s}', 'missing field', count(*) FROM pst WHERE {rule}" for s, rule in _LACKING.items()]
    # Two records on Google's first page, of which every 13th first one is no JSON, and one on the page after.
    parts.append("SELECT 'google', 'missing field', sum(CASE WHEN seq % 13 = 0 THEN 2 ELSE 3 END) FROM pst WHERE seq % 10 = 0")
    # Cards, and linked data on pages without cards.
    parts.append("SELECT 'irish_jobs', 'missing field', count(*) FILTER (seq % 5 = 0) + count(*) FILTER (seq % 4 = 3) FROM pst")
    parts.append(f"""SELECT 'twitter', 'missing field', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM ({ORACLES['parse_tweets']}))""")
    return pst_sql(f"SELECT site, reason, CAST(sum(n) AS BIGINT) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY site, reason")


@query("quarantine_every_site", _quarantined_sql())
def quarantine_every_site(spark, sf):
    """What cannot be read of all landed rows, by site and reason, with two planted payloads for each site among them."""
    found = quarantined(spark, sf)[1]
    return found.groupBy("site", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "collect_platform",
    f"SELECT id, title FROM ({ORACLES['parse_greenhouse']})",
)
def collect_platform(spark, sf):
    """A career platform is asked for like a board."""
    spec = SearchSpec(site_name="greenhouse", results_wanted=None, as_of=AS_OF)
    return collect_landed(landed(spark, sf, ("greenhouse", "seek")), spec).select("id", "title")
