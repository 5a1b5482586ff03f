"""Filters, joins, counts, ranks and duplicates over the posting table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.assembly import postings, rec_sql
from checks.inputs import plain, pst, pst_sql, soc, soc_sql, table
from checks.registry import ORACLES, query
from vacancia import lookups
from vacancia.functions import urls
from vacancia.functions.text import join_present
from vacancia.operators import aggregates, dedup, enrich, filters, ranking
from vacancia.operators.assemble import union_sites
from vacancia.operators.skew import hot_keys, salted_join
from vacancia.session import work_folder

# ---- filters ----------------------------------------------------------------------------------


@query(
    "filter_hours_old",
    # The projected dates are old, so the window is applied to them shifted close to the reference day.
    pst_sql("""SELECT seq, site FROM (SELECT seq, site, CAST(date_posted AS DATE) AS d FROM pst)
      WHERE CASE site WHEN 'indeed' THEN d >= DATE '1998-07-31' WHEN 'linkedin' THEN d >= DATE '1998-07-31'
        WHEN 'zip_recruiter' THEN d >= DATE '1998-08-01' WHEN 'glassdoor' THEN d >= DATE '1998-08-01'
        WHEN 'naukri' THEN d >= DATE '1998-08-01' ELSE true END"""),
)
def filter_hours_old(spark, sf):
    """Posted within 30 hours of 1998-08-02: one day or two, by board."""
    as_of = F.lit("1998-08-02").cast("date")
    return filters.filter_hours_old(pst(spark, sf), 30, as_of).select("seq", "site")


@query("filter_remote", rec_sql("SELECT seq FROM rec WHERE remote"))
def filter_remote(spark, sf):
    return filters.filter_remote(postings(spark, sf)).select("seq")


@query("filter_job_type", rec_sql("SELECT seq, jt AS job_type FROM rec WHERE jt = 'internship'"))
def filter_job_type(spark, sf):
    df = filters.filter_job_type(postings(spark, sf), "praktikum")
    return df.select("seq", F.array_join("job_type", ",").alias("job_type"))


@query("filter_easy_apply", pst_sql("SELECT seq FROM pst WHERE seq % 3 <> 0"))
def filter_easy_apply(spark, sf):
    outside = F.when(F.col("seq") % 3 == 0, F.col("job_url"))
    return filters.filter_easy_apply(
        pst(spark, sf).withColumn("job_url_direct", outside)
    ).select("seq")


@query(
    "filter_company",
    pst_sql("""SELECT seq, company_name FROM pst WHERE company_name =
      (SELECT company_name FROM pst WHERE contains(lower(company_name), '00007') ORDER BY seq LIMIT 1)"""),
)
def filter_company(spark, sf):
    return filters.filter_company(pst(spark, sf), "00007").select("seq", "company_name")


@query("filter_company_ids", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (7, 11, 13, 42)")
def filter_company_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return filters.filter_company_ids(orders, [7, 11, 13, 42], "o_custkey")


@query(
    "filter_location",
    rec_sql("""SELECT seq FROM rec WHERE contains(lower(concat_ws(', ', city, state, c_name2)), 'dublin')
      AND contains(lower(concat_ws(', ', city, state, c_name2)), 'usa')"""),
)
def filter_location(spark, sf):
    return filters.filter_location(postings(spark, sf), "Dublin, USA").select("seq")


TEXT = "lower(concat_ws(' ', title, description))"


@query(
    "filter_search_terms",
    pst_sql(f"""SELECT seq, title FROM pst WHERE contains({TEXT}, 'data intern')
      AND (contains({TEXT}, 'machinery') OR contains({TEXT}, 'building')) AND NOT contains({TEXT}, 'bonus')"""),
)
def filter_search_terms(spark, sf):
    df = filters.filter_search_terms(
        pst(spark, sf), '"data intern" (machinery OR building) -bonus'
    )
    return df.select("seq", "title")


@query("filter_hashtags", soc_sql("SELECT id FROM soc WHERE contains(text, '#hiring')"))
def filter_hashtags(spark, sf):
    return filters.filter_hashtags(soc(spark, sf)).select("id")


@query("filter_min_length", "SELECT doc_id, length(text) AS n FROM documents WHERE length(text) >= 50")
def filter_min_length(spark, sf):
    df = filters.filter_min_length(table(spark, sf, "documents"), "text", filters.MIN_TWEET)
    return df.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(
    "filter_required_fields",
    pst_sql("""SELECT seq FROM pst WHERE coalesce(trim(id), '') <> '' AND coalesce(trim(title), '') <> ''
      AND coalesce(trim(description), '') <> ''"""),
)
def filter_required_fields(spark, sf):
    return filters.filter_required_fields(
        pst(spark, sf), ("id", "title", "description")
    ).select("seq")


_STOP = ", ".join(f"'{t}'" for t in lookups.NON_JOB_TITLES)
_SKIP = ", ".join(f"'{t}'" for t in lookups.SKIP_LINK_TITLES)
_PARTS = "|".join(lookups.SKIP_LINK_PARTS)
# Titles of three shapes: a full one, its first word, and a menu word.
_SHAPES = """SELECT seq, CASE seq % 3 WHEN 0 THEN title WHEN 1 THEN split_part(title, ' ', 1)
  ELSE CASE seq % 7 WHEN 0 THEN 'About Us' WHEN 1 THEN 'Privacy Policy' WHEN 2 THEN 'Apply now'
    WHEN 3 THEN 'Sign up today' WHEN 4 THEN 'Engineering' WHEN 5 THEN 'QA' ELSE 'Administratively-speaking' END END AS t FROM pst"""


@query(
    "filter_title_noise",
    pst_sql(
        f"""SELECT seq, t AS title,
      length(t) >= 3 AND lower(trim(t)) NOT IN ({_STOP}) AND NOT (NOT contains(trim(t), ' ') AND length(t) < 20) AS loose,
      length(t) >= 5 AND lower(t) NOT IN ({_SKIP}) AND NOT regexp_matches(lower(t), '{_PARTS}') AS link,
      length(t) >= 5 AND NOT (NOT contains(trim(t), ' ') AND length(t) < 15) AS sitemap FROM s""",
        s=_SHAPES,
    ),
)
def filter_title_noise(spark, sf):
    df = pst(spark, sf)
    menu = (
        F.when(F.col("seq") % 7 == 0, "About Us").when(F.col("seq") % 7 == 1, "Privacy Policy")
        .when(F.col("seq") % 7 == 2, "Apply now").when(F.col("seq") % 7 == 3, "Sign up today")
        .when(F.col("seq") % 7 == 4, "Engineering").when(F.col("seq") % 7 == 5, "QA")
        .otherwise("Administratively-speaking")
    )
    title = (
        F.when(F.col("seq") % 3 == 0, F.col("title"))
        .when(F.col("seq") % 3 == 1, F.substring_index("title", " ", 1))
        .otherwise(menu)
    )
    df = df.select("seq", title.alias("title"))
    t = F.col("title")
    return df.select(
        "seq", "title", urls.is_loose_title(t).alias("loose"), urls.is_link_title(t).alias("link"),
        urls.is_sitemap_title(t).alias("sitemap"),
    )


@query("site_selection", pst_sql("SELECT seq, site FROM pst WHERE site IN ('indeed', 'reed')"))
def site_selection(spark, sf):
    return filters.site_selection(pst(spark, sf), ["indeed", "reed"]).select("seq", "site")


# ---- joins ------------------------------------------------------------------------------------


@query(
    "enrich_with_details",
    rec_sql(
        """SELECT l.seq, l.id2 AS id, coalesce(nullif(d.text, ''), l.description) AS description,
      CASE WHEN d.text <> '' THEN nullif(array_to_string(regexp_extract_all(d.text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}'), ', '), '') ELSE l.mails END AS emails,
      CASE WHEN d.text <> '' THEN nullif(concat_ws(', ',
          CASE WHEN regexp_matches(d.text, 'full\\s?time', 'i') THEN 'fulltime' END, CASE WHEN regexp_matches(d.text, 'part\\s?time', 'i') THEN 'parttime' END,
          CASE WHEN regexp_matches(d.text, 'internship', 'i') THEN 'internship' END, CASE WHEN regexp_matches(d.text, 'contract', 'i') THEN 'contract' END), '')
        ELSE l.jt END AS job_type
      FROM l LEFT JOIN d ON l.id2 = d.id""",
        l="SELECT *, 'd' || CAST(seq % 4000 AS VARCHAR) AS id2 FROM rec",
        d="SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text || ' Contract, part time' END AS text FROM documents",
    ),
)
def enrich_with_details(spark, sf):
    """Documents as detail records; several listings share one, some details are empty."""
    return enriched(enrich.enrich_with_details(*listings_and_details(spark, sf)))


def listings_and_details(spark, sf):
    listing = postings(spark, sf).withColumn(
        "id", F.concat(F.lit("d"), (F.col("seq") % 4000).cast("string"))
    )
    text = F.when(F.col("doc_id") % 3 == 0, "").otherwise(
        F.concat("text", F.lit(" Contract, part time"))
    )
    details = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), text.alias("description")
    )
    return listing, details


def enriched(done):
    return done.select(
        "seq", "id", "description",
        F.when(F.size("emails") > 0, F.array_join("emails", ", ")).alias("emails"),
        F.when(F.size("job_type") > 0, F.array_join("job_type", ", ")).alias("job_type"),
    )


_ALIASES = ", ".join(f"('{a}', '{c}')" for a, c in lookups.ALIAS_TO_COUNTRY.items())


@query(
    "country_lookup",
    pst_sql(
        """SELECT p.seq, a.country AS country_name, a.country IS NOT NULL AS country_known
      FROM (SELECT seq, lower(trim(split_part(coalesce(location_text, country), ',', 1))) AS k FROM pst) p LEFT JOIN a ON p.k = a.alias""",
        a=f"SELECT * FROM (VALUES {_ALIASES}) t(alias, country)",
    ),
)
def country_lookup(spark, sf):
    df = pst(spark, sf).select(
        "seq",
        F.substring_index(F.coalesce("location_text", "country"), ",", 1).alias("name"),
    )
    return enrich.country_lookup(df, "name").drop("name")


_SYNONYMS = ", ".join(f"('{s}', '{c}')" for s, c in lookups.SYNONYM_TO_JOB_TYPE.items())


@query(
    "job_type_lookup",
    pst_sql(
        """SELECT p.seq, a.canonical FROM pst p LEFT JOIN a
      ON lower(regexp_replace(p.job_type_text, '[-_ ]', '', 'g')) = a.synonym""",
        a=f"SELECT * FROM (VALUES {_SYNONYMS}) t(synonym, canonical)",
    ),
)
def job_type_lookup(spark, sf):
    """As a join with the dimension table (a few dozen rows, so it is broadcast)."""
    df = pst(spark, sf).select(
        "seq", F.lower(F.regexp_replace("job_type_text", "[-_ ]", "")).alias("synonym")
    )
    return df.join(F.broadcast(lookups.job_type_dim(spark)), "synonym", "left").select(
        "seq", "canonical"
    )


# Career hosts derived from the pages' hosts.
_CAREER_URL = """CASE page_id % 6 WHEN 0 THEN 'https://jobs.lever.co/' || h WHEN 1 THEN 'https://' || h || '.bamboohr.com/careers'
  WHEN 2 THEN 'https://boards.greenhouse.io/' || h || '/jobs' WHEN 3 THEN 'https://' || h || '.applytojob.com/apply'
  WHEN 4 THEN 'https://apply.workable.com/' || h || '/' ELSE 'https://bamboohr.com/' || h END"""
_SLUGS = f"""SELECT page_id, {_CAREER_URL} AS career_url, h FROM
  (SELECT page_id, split_part(split_part(url, '//', 2), '.', 1) AS h FROM pages)"""


def career_urls(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id",
        F.substring_index(F.get(F.split("url", "//"), F.lit(1)), ".", 1).alias("h"),
    )
    return pages.select(
        "page_id",
        F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("https://jobs.lever.co/"), "h"))
        .when(F.col("page_id") % 6 == 1, F.concat(F.lit("https://"), "h", F.lit(".bamboohr.com/careers")))
        .when(F.col("page_id") % 6 == 2, F.concat(F.lit("https://boards.greenhouse.io/"), "h", F.lit("/jobs")))
        .when(F.col("page_id") % 6 == 3, F.concat(F.lit("https://"), "h", F.lit(".applytojob.com/apply")))
        .when(F.col("page_id") % 6 == 4, F.concat(F.lit("https://apply.workable.com/"), "h", F.lit("/")))
        .otherwise(F.concat(F.lit("https://bamboohr.com/"), "h")).alias("career_url"),
        "h",
    )


@query(
    "detect_platform",
    f"""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'lever' WHEN 1 THEN 'bamboohr' WHEN 2 THEN 'greenhouse'
      WHEN 3 THEN 'jazzhr' WHEN 4 THEN 'workable' ELSE 'custom' END AS platform FROM ({_SLUGS})""",
)
def detect_platform(spark, sf):
    return enrich.platform_lookup(career_urls(spark, sf), "career_url").select("page_id", "platform")


_DOMAINS = ", ".join(
    "('{}', '{}', '{}', {})".format(
        r["country"], r["indeed_subdomain"], r["indeed_code"],
        f"'{r['glassdoor_host']}'" if r["glassdoor_host"] else "NULL",
    )
    for r in lookups.country_records()
)


@query(
    "country_domains",
    f"""SELECT n.n_nationkey, d.indeed_subdomain, d.indeed_code, d.glassdoor_host FROM nation n LEFT JOIN
      (SELECT * FROM (VALUES {_DOMAINS}) t(country, indeed_subdomain, indeed_code, glassdoor_host)) d
      ON d.country = lower(n.n_name)""",
)
def country_domains(spark, sf):
    df = table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("c"))
    return enrich.country_domains(df, "c").drop("c")


@query(
    "seen_anti_join",
    pst_sql("""SELECT seq FROM pst p WHERE NOT EXISTS (SELECT 1 FROM pst q WHERE q.seq % 5 = 0 AND q.site = p.site AND q.id = p.id)"""),
)
def seen_anti_join(spark, sf):
    df = pst(spark, sf)
    other = F.concat("id", F.lit("-elsewhere"))
    published = df.withColumn("id", F.when(F.col("seq") % 5 == 0, F.col("id")).otherwise(other))
    return dedup.seen_anti_join(df, published).select("seq")


@query("unpublished", ORACLES["seen_anti_join"])
def unpublished(spark, sf):
    """The same rows, of a published table that grew over two runs and lies in buckets of its key."""
    df = pst(spark, sf)
    other = F.concat("id", F.lit("-elsewhere"))
    name = f"published_{uuid.uuid4().hex}"
    path = work_folder(spark, name)
    for run in range(2):
        part = df.where(F.col("seq") % 2 == run)
        part = part.withColumn("id", F.when(F.col("seq") % 5 == 0, F.col("id")).otherwise(other))
        dedup.publish(part.select("site", "id"), name, path, buckets=8)
    return dedup.unpublished(df, name).select("seq")


@query(
    "distinct_over_runs",
    pst_sql("SELECT site, count(DISTINCT id) AS distinct_postings, true AS near FROM pst GROUP BY site"),
)
def distinct_over_runs(spark, sf):
    """Sketches of three runs that have postings in common, merged, beside the exact count of all."""
    df = pst(spark, sf)
    runs = [aggregates.postings_sketch(df.where(F.col("seq") % 4 != run)) for run in range(3)]
    merged = aggregates.distinct_from_sketches(reduce(DataFrame.unionByName, runs))
    exact = aggregates.distinct_postings_count(df)
    off = F.abs(merged["distinct_postings"] - exact["distinct_postings"])
    return exact.join(merged, exact["site"] == merged["site"]).select(
        exact["site"], exact["distinct_postings"], (off <= 4 * 1.04 / 64 * exact["distinct_postings"]).alias("near"))


@query(
    "site_config_lookup",
    """SELECT n_nationkey, CASE WHEN n_name = 'NEW ZEALAND' THEN 'https://www.seek.co.nz' ELSE 'https://www.seek.com.au' END AS base_url,
      CASE WHEN n_name = 'NEW ZEALAND' THEN 'NZ-Main' ELSE 'AU-Main' END AS site_key,
      CASE WHEN n_name = 'NEW ZEALAND' THEN 'en-NZ' ELSE 'en-AU' END AS locale FROM nation""",
)
def site_config_lookup(spark, sf):
    df = table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("c"))
    return enrich.site_config_lookup(df, "c").drop("c")


@query(
    "salted_join",
    "SELECT e.event_id, c.c_name FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey",
)
def salted_join_events(spark, sf):
    """Events to customers with the heaviest users split, as a caller lists them."""
    events = table(spark, sf, "events").select("event_id", F.col("user_id").alias("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    hot = hot_keys(events, ["c_custkey"], min_rows=20)
    joined = salted_join(events, customers, ["c_custkey"], "left", hot, ("event_id",), salts=8)
    return joined.select("event_id", "c_name")


# ---- counts -----------------------------------------------------------------------------------


@query("count_by_site", pst_sql("SELECT site, count(*) AS postings FROM pst GROUP BY site"))
def count_by_site(spark, sf):
    return aggregates.count_by_site(pst(spark, sf))


@query(
    "enrichment_coverage",
    pst_sql("""SELECT site, sum(CASE WHEN description <> '' THEN 1 ELSE 0 END) AS enriched, count(*) AS total
      FROM pst GROUP BY site"""),
)
def enrichment_coverage(spark, sf):
    return aggregates.enrichment_coverage(pst(spark, sf))


@query(
    "distinct_postings_count",
    pst_sql("SELECT site, count(DISTINCT id) AS distinct_postings FROM pst GROUP BY site"),
)
def distinct_postings_count(spark, sf):
    return aggregates.distinct_postings_count(pst(spark, sf))


@query(
    "min_support",
    """SELECT event_id FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) WHERE n >= 2""",
)
def min_support(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    kept = aggregates.min_support(events, ["user_id", "event_type"])
    return kept.select("event_id")


@query(
    "strategy_cascade",
    pst_sql("""SELECT seq, r AS strategy_rank FROM (SELECT seq, r, min(r) OVER (PARTITION BY company_name) AS best FROM
      (SELECT *, seq % 7 AS r FROM pst)) WHERE r = best"""),
)
def strategy_cascade(spark, sf):
    df = pst(spark, sf).withColumn("strategy_rank", F.col("seq") % 7)
    return aggregates.strategy_cascade(df, ["company_name"]).select("seq", "strategy_rank")


@query(
    "cascade_null_keys",
    pst_sql("""SELECT seq, strategy_rank FROM (SELECT seq, seq % 4 AS strategy_rank, min(seq % 4) OVER (PARTITION BY comp_interval, comp_max IS NULL) AS best FROM pst)
      WHERE strategy_rank = best"""),
)
def cascade_null_keys(spark, sf):
    """Groups whose key is null are groups like any other."""
    df = pst(spark, sf).withColumns({"strategy_rank": F.col("seq") % 4, "open": F.col("comp_max").isNull()})
    return aggregates.strategy_cascade(df, ["comp_interval", "open"]).select("seq", "strategy_rank")


@query(
    "largest_array_wins",
    pst_sql("""SELECT seq, candidate FROM (SELECT *, seq % 5 AS candidate FROM pst) p JOIN
      (SELECT company_name, candidate, row_number() OVER (PARTITION BY company_name ORDER BY n DESC, candidate) AS rn FROM
        (SELECT company_name, seq % 5 AS candidate, count(*) AS n FROM pst GROUP BY ALL)) b USING (company_name, candidate) WHERE rn = 1"""),
)
def largest_array_wins(spark, sf):
    df = pst(spark, sf).withColumn("candidate", F.col("seq") % 5)
    return aggregates.largest_array_wins(df, ["company_name"]).select("seq", "candidate")


@query(
    "concat_sections",
    pst_sql("""SELECT seq, nullif(concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(description, ''), nullif(salary_label, '')), '') AS body FROM pst"""),
)
def concat_sections(spark, sf):
    body = join_present(F.array("title", "description", "salary_label"))
    return pst(spark, sf).select("seq", body.alias("body"))


# ---- ranks ------------------------------------------------------------------------------------


@query(
    "final_sort",
    pst_sql("""SELECT site, id, CAST(date_posted AS VARCHAR) AS date_posted FROM pst
      ORDER BY site, date_posted DESC NULLS LAST, id"""),
)
def final_sort(spark, sf):
    return plain(ranking.final_sort(pst(spark, sf).select("site", "id", "date_posted")))


@query(
    "results_wanted",
    pst_sql("SELECT seq, site FROM (SELECT seq, site, row_number() OVER (PARTITION BY site ORDER BY seq) AS rn FROM pst) WHERE rn <= 15"),
)
def results_wanted(spark, sf):
    df = pst(spark, sf).withColumn("pos", F.lit(0))
    return ranking.results_wanted(df, 15).select("seq", "site")


@query(
    "offset_slice",
    pst_sql("SELECT seq, site FROM (SELECT seq, site, row_number() OVER (PARTITION BY site ORDER BY seq) AS rn FROM pst) WHERE rn BETWEEN 101 AND 150"),
)
def offset_slice(spark, sf):
    df = pst(spark, sf).withColumn("pos", F.lit(0))
    return ranking.offset_slice(df, 100, 50).select("seq", "site")


@query(
    "offset_slice_deep",
    """SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
      FROM events) WHERE rn BETWEEN 11 AND 1600""",
)
def offset_slice_deep(spark, sf):
    """A deep slice, beyond what is cut before the shuffle, of groups that hold much of the rows."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    return ranking.rows_per_group(events, 1590, 10, keys=("event_type",), order=("event_id",))


@query(
    "slice_null_seq",
    pst_sql("""SELECT k, site FROM (SELECT seq AS k, site, row_number() OVER (PARTITION BY site ORDER BY CASE WHEN seq % 5 > 0 THEN seq END NULLS FIRST, seq) AS rn FROM pst)
      WHERE rn BETWEEN 21 AND 1500"""),
)
def slice_null_seq(spark, sf):
    """Rows without arrival number come first and are kept."""
    df = pst(spark, sf).select("site", F.col("seq").alias("k"), F.when(F.col("seq") % 5 > 0, F.col("seq")).alias("seq"))
    return ranking.rows_per_group(df, 1480, 20, order=("seq", "k")).select("k", "site")


@query(
    "first_per_key",
    pst_sql("SELECT seq, company_name FROM (SELECT seq, company_name, row_number() OVER (PARTITION BY company_name ORDER BY seq) AS rn FROM pst) WHERE rn = 1"),
)
def first_per_key(spark, sf):
    df = pst(spark, sf).withColumn("pos", F.lit(0))
    return ranking.first_per_key(df, ["company_name"]).select("seq", "company_name")


# ---- sets and duplicates ----------------------------------------------------------------------


@query(
    "union_sites",
    pst_sql("""SELECT seq, CASE WHEN site IN ('indeed', 'linkedin', 'glassdoor') THEN title END AS title,
      CASE WHEN site IN ('zip_recruiter', 'naukri', 'reed') THEN salary_label END AS salary_label FROM pst"""),
)
def union_sites_query(spark, sf):
    df = pst(spark, sf)
    by = {"indeed": "title", "linkedin": "title", "glassdoor": "title",
          "zip_recruiter": "salary_label", "naukri": "salary_label", "reed": "salary_label"}
    return union_sites([df.where(F.col("site") == s).select(c, "seq") for s, c in by.items()])


@query(
    "dedup_within_site",
    pst_sql("""SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY site,
      CASE WHEN site IN ('indeed', 'glassdoor', 'zip_recruiter') THEN job_url ELSE id END ORDER BY seq) AS rn FROM pst) WHERE rn = 1"""),
)
def dedup_within_site(spark, sf):
    return dedup.dedup_within_site(pst(spark, sf), ("seq",)).select("seq")


@query(
    "dedup_null_keys",
    pst_sql("""SELECT seq FROM (SELECT seq, site, id, job_url, row_number() OVER (PARTITION BY site, CASE WHEN seq % 3 > 0 THEN
      CASE WHEN site IN ('indeed', 'glassdoor', 'zip_recruiter') THEN job_url ELSE id END END, CASE WHEN seq % 3 = 0 THEN seq END ORDER BY seq) AS rn FROM pst) WHERE rn = 1"""),
)
def dedup_null_keys(spark, sf):
    """A third of the postings has neither id nor URL: all of them stay."""
    known = F.col("seq") % 3 > 0
    df = pst(spark, sf).withColumns({"id": F.when(known, F.col("id")), "job_url": F.when(known, F.col("job_url"))})
    return dedup.dedup_within_site(df, ("seq",)).select("seq")


@query(
    "dedup_by_normalized_url",
    pst_sql("""SELECT seq, k FROM (SELECT seq, k, row_number() OVER (PARTITION BY k ORDER BY seq) AS rn FROM
      (SELECT seq, split_part(split_part(rtrim(job_url, '/'), '?', 1), '#', 1) AS k FROM pst)) WHERE rn = 1"""),
)
def dedup_by_normalized_url(spark, sf):
    df = dedup.dedup_by_normalized_url(pst(spark, sf), order=("seq",))
    return df.select("seq", urls.normalized_url(F.col("job_url")).alias("k"))


@query(
    "dedup_by_prefix",
    """SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY left(text, 80), CASE WHEN text IS NULL THEN doc_id END ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedup_by_prefix(spark, sf):
    """The key is the first 80 characters: that is the rule of this operator."""
    return dedup.dedup_by_prefix(table(spark, sf, "documents"), order=("doc_id",)).select("doc_id")


@query(
    "dedup_ordered_list",
    pst_sql("""SELECT seq, CASE WHEN site = id THEN site ELSE concat_ws('|', site, id) END AS items FROM pst"""),
)
def dedup_ordered_list(spark, sf):
    items = dedup.dedup_ordered_list(F.array("site", "id", "site", "id"))
    return pst(spark, sf).select("seq", F.array_join(items, "|").alias("items"))


