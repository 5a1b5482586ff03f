"""Projections, salary rules and the output table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import AS_OF, plain, pst, pst_sql
from checks.registry import query
from vacancia.functions import job_types, locations, remote, salary, text, urls
from vacancia.operators import assemble
from vacancia.plans.collect import SearchSpec, collect_postings
from vacancia.schema import OUTPUT_FIELDS, compensation, posting_columns


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """Posting records of the projected postings."""
    kind = job_types.normalize_job_type(F.col("job_type_text"))
    pay = compensation(F.col("comp_interval"), F.col("comp_min"), F.col("comp_max"), F.lit("USD"))
    return pst(spark, sf).select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.lit(0),
            site=F.col("site"),
            id=F.col("id"),
            title=F.col("title"),
            company_name=F.col("company_name"),
            job_url=F.col("job_url"),
            location=locations.loc_first_comma(
                F.col("location_text"), locations.country_of(F.col("country"))
            ),
            description=F.col("description"),
            job_type=F.when(kind.isNotNull(), F.array(kind)),
            compensation=F.when(F.col("comp_interval").isNotNull(), pay),
            date_posted=F.col("date_posted"),
            emails=text.extract_emails(F.col("description")),
            is_remote=remote.remote_keywords3(
                F.col("title"), F.col("location_text"), F.col("description")
            ),
            skills=F.split(F.lower("title"), " "),
        )
    )


PAY = r"\$(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)\s*[-—–]\s*\$?(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"

# Salary of a text column ``description`` in three steps.
PAY_STEPS = {
    "pay1": f"""SELECT *, regexp_extract(description, '{PAY}', 1) AS g1, regexp_extract(description, '{PAY}', 2) AS g2,
        regexp_extract(description, '{PAY}', 3) AS g3, regexp_extract(description, '{PAY}', 4) AS g4 FROM rec""",
    "pay2": """SELECT *, CASE WHEN g1 <> '' THEN trunc(CAST(replace(g1, ',', '') AS DOUBLE)) * CASE WHEN g2 || g4 <> '' THEN 1000 ELSE 1 END END AS lo,
        CASE WHEN g1 <> '' THEN trunc(CAST(replace(g3, ',', '') AS DOUBLE)) * CASE WHEN g2 || g4 <> '' THEN 1000 ELSE 1 END END AS hi FROM pay1""",
    "pay3": """SELECT *, CASE WHEN lo < 350 THEN 'hourly' WHEN lo < 30000 THEN 'monthly' ELSE 'yearly' END AS band,
        CASE WHEN lo < 350 THEN 2080 WHEN lo < 30000 THEN 12 ELSE 1 END AS fac FROM pay2""",
    "pay4": """SELECT *, coalesce((CASE WHEN lo < 350 THEN hi < 350 WHEN lo < 30000 THEN hi < 30000 ELSE true END)
        AND lo * fac BETWEEN 1000 AND 700000 AND hi * fac BETWEEN 1000 AND 700000 AND lo < hi, false) AS fits FROM pay3""",
    "pay": """SELECT *, CASE WHEN fits THEN band END AS d_interval, CASE WHEN fits THEN lo END AS d_min, CASE WHEN fits THEN hi END AS d_max,
        CASE WHEN fits THEN 'USD' END AS d_currency FROM pay4""",
}

REC = f"""SELECT *,
  CASE country WHEN 'united kingdom' THEN 'uk' ELSE country END AS c_name2,
  trim(split_part(location_text, ',', 1)) AS city,
  CASE WHEN position(',' IN location_text) > 0 THEN trim(substr(location_text, position(',' IN location_text) + 1)) END AS state,
  CASE country WHEN 'usa' THEN 'USA' WHEN 'united kingdom' THEN 'UK' WHEN 'ireland' THEN 'Ireland' END AS c_shown,
  CASE job_type_text WHEN 'full-time' THEN 'fulltime' WHEN 'Part Time' THEN 'parttime' WHEN 'Contract' THEN 'contract' WHEN 'Praktikum' THEN 'internship' END AS jt,
  nullif(array_to_string(regexp_extract_all(description, '{EMAIL}'), ', '), '') AS mails,
  regexp_matches(lower(concat_ws(' ', title, location_text, description)), 'remote|work from home|wfh') AS remote
FROM pst"""

LOCATION = "concat_ws(', ', nullif(city, ''), nullif(state, ''), c_shown)"


def rec_sql(body: str, **ctes: str) -> str:
    return pst_sql(body, rec=REC, **ctes)


def pay_sql(body: str, **ctes: str) -> str:
    return pst_sql(body, rec=REC, **PAY_STEPS, **ctes)


def _struct_out(df: DataFrame, name: str, *keep: str) -> DataFrame:
    return df.select(*keep, f"{name}.*")


@query(
    "flatten_posting",
    rec_sql(f"""SELECT id, site, job_url, title, company_name AS company, {LOCATION} AS location, description FROM rec"""),
)
def flatten_posting(spark, sf):
    return assemble.flatten_postings(postings(spark, sf)).select(
        "id", "site", "job_url", "title", "company", "location", "description"
    )


@query("join_job_types", rec_sql("SELECT seq, jt AS job_type FROM rec"))
def join_job_types(spark, sf):
    df = postings(spark, sf)
    return df.select("seq", assemble.joined_list(F.col("job_type")).alias("job_type"))


@query("join_emails", rec_sql("SELECT seq, mails AS emails FROM rec"))
def join_emails(spark, sf):
    df = postings(spark, sf)
    return df.select("seq", assemble.joined_list(F.col("emails")).alias("emails"))


@query("join_skills", rec_sql("SELECT seq, replace(lower(title), ' ', ', ') AS skills FROM rec"))
def join_skills(spark, sf):
    df = postings(spark, sf)
    return df.select("seq", assemble.joined_list(F.col("skills")).alias("skills"))


@query("display_location", rec_sql(f"SELECT seq, {LOCATION} AS location FROM rec"))
def display_location(spark, sf):
    df = postings(spark, sf)
    return df.select("seq", locations.display_location(F.col("location")).alias("location"))


@query(
    "flatten_compensation",
    rec_sql("""SELECT seq, comp_interval AS interval, comp_min AS min_amount, comp_max AS max_amount,
      CASE WHEN comp_interval IS NOT NULL THEN 'USD' END AS currency,
      CASE WHEN comp_interval IS NOT NULL THEN 'direct_data' END AS salary_source FROM rec"""),
)
def flatten_compensation(spark, sf):
    resolved = assemble.resolved_salary(F.col("compensation"), F.col("description"), False, False)
    df = postings(spark, sf).select("seq", resolved.alias("pay"))
    return df.select("seq", "pay.comp.*", F.col("pay.source").alias("salary_source"))


RESOLVED = """SELECT seq,
  CASE WHEN comp_interval IS NOT NULL THEN comp_interval ELSE d_interval END AS interval,
  CASE WHEN comp_interval IS NOT NULL THEN comp_min ELSE d_min END AS min_amount,
  CASE WHEN comp_interval IS NOT NULL THEN comp_max ELSE d_max END AS max_amount,
  CASE WHEN comp_interval IS NOT NULL THEN 'USD' ELSE d_currency END AS currency,
  CASE WHEN comp_interval IS NOT NULL THEN 'direct_data' ELSE 'description' END AS salary_source FROM pay"""


@query("resolve_salary", pay_sql(RESOLVED))
def resolve_salary(spark, sf):
    resolved = assemble.resolved_salary(F.col("compensation"), F.col("description"), True, False)
    df = postings(spark, sf).select("seq", resolved.alias("pay"))
    return df.select("seq", "pay.comp.*", F.col("pay.source").alias("salary_source"))


@query(
    "blank_salary_source",
    pay_sql(
        "SELECT seq, CASE WHEN coalesce(min_amount, 0) <> 0 THEN salary_source END AS salary_source FROM r",
        r=RESOLVED,
    ),
)
def blank_salary_source(spark, sf):
    df = resolve_salary(spark, sf)
    return df.select(
        "seq",
        assemble.salary_source(F.col("salary_source"), F.col("min_amount")).alias("salary_source"),
    )


ANNUAL = """SELECT seq,
  CASE WHEN f IS NOT NULL AND comp_min <> 0 AND comp_max <> 0 THEN 'yearly' ELSE comp_interval END AS interval,
  CASE WHEN f IS NOT NULL AND comp_min <> 0 AND comp_max <> 0 THEN comp_min * f ELSE comp_min END AS min_amount,
  CASE WHEN f IS NOT NULL AND comp_min <> 0 AND comp_max <> 0 THEN comp_max * f ELSE comp_max END AS max_amount
FROM (SELECT *, CASE comp_interval WHEN 'hourly' THEN 2080 WHEN 'daily' THEN 260 WHEN 'weekly' THEN 52 WHEN 'monthly' THEN 12 END AS f FROM rec)"""


@query("annualize", rec_sql(ANNUAL))
def annualize(spark, sf):
    df = postings(spark, sf).select("seq", salary.annualize(F.col("compensation")).alias("comp"))
    return df.select("seq", "comp.interval", "comp.min_amount", "comp.max_amount")


SQL_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def aligned(known: dict[str, str]) -> str:
    """The output columns: known expressions, typed nulls for the rest (dates are written as text)."""
    return ", ".join(
        (known[c] if c in known else f"CAST(NULL AS {SQL_TYPES.get(t, 'VARCHAR')})") + f" AS {c}"
        for c, t in OUTPUT_FIELDS.items()
    )


ALIGNED = aligned({"id": "id", "site": "site", "title": "title"})


@query("align_schema", pst_sql(f"SELECT {ALIGNED} FROM pst"))
def align_schema(spark, sf):
    narrow = pst(spark, sf).select("title", "id", "seq", "site")
    return plain(assemble.align_schema(narrow))


@query(
    "posting_ids",
    pst_sql("""SELECT seq, CASE site WHEN 'indeed' THEN 'in-' WHEN 'linkedin' THEN 'li-' WHEN 'zip_recruiter' THEN 'zr-'
      WHEN 'glassdoor' THEN 'gd-' WHEN 'naukri' THEN 'nk-' ELSE '' END || id AS id,
      'custom:link:' || sha256(job_url) AS link_id FROM pst"""),
)
def posting_ids(spark, sf):
    return pst(spark, sf).select(
        "seq",
        urls.posting_id(F.col("site"), F.col("id")).alias("id"),
        F.concat(F.lit("custom:link:"), urls.url_hash(F.col("job_url"))).alias("link_id"),
    )


@query(
    "posting_urls",
    pst_sql("""SELECT seq, CASE site WHEN 'indeed' THEN 'https://www.indeed.com/viewjob?jk=' || id
      WHEN 'linkedin' THEN 'https://www.linkedin.com/jobs/view/' || id
      WHEN 'zip_recruiter' THEN 'https://www.ziprecruiter.com/jobs//j?lvk=' || id
      WHEN 'glassdoor' THEN 'https://www.glassdoor.com/job-listing/j?jl=' || id
      WHEN 'naukri' THEN 'https://www.naukri.com/job/' || id
      WHEN 'reed' THEN 'https://www.reed.co.uk/jobs/' || id END AS url FROM pst"""),
)
def posting_urls(spark, sf):
    return pst(spark, sf).select("seq", urls.posting_url(F.col("site"), F.col("id")).alias("url"))


@query(
    "industry_cleanup",
    pst_sql("""SELECT seq, upper(substr(a, 1, 1)) || lower(substr(a, 2)) || ' ' || upper(substr(b, 1, 1)) || lower(substr(b, 2)) AS industry
      FROM (SELECT seq, split_part(title, ' ', 1) AS a, split_part(title, ' ', 2) AS b FROM pst)"""),
)
def industry_cleanup(spark, sf):
    """A code like ``SENIOR_engineerIv1`` made from the first two words of the title."""
    words = F.split("title", " ")
    code = F.concat(F.upper(words[0]), F.lit("_"), words[1], F.lit("Iv1"))
    return pst(spark, sf).select("seq", text.industry_cleanup(code).alias("industry"))


FULL = {
    "id": "id", "site": "site", "job_url": "job_url", "title": "title", "company": "company_name",
    "location": LOCATION, "date_posted": "CAST(date_posted AS VARCHAR)", "job_type": "jt",
    "salary_source": "CASE WHEN coalesce(min_amount, 0) <> 0 THEN salary_source END",
    "interval": "interval", "min_amount": "min_amount", "max_amount": "max_amount",
    "currency": "currency", "is_remote": "remote", "emails": "mails", "description": "description",
    "skills": "replace(lower(title), ' ', ', ')",
}


def full_sql(source: str = "rec JOIN resolved USING (seq)", where: str = "") -> str:
    return f"SELECT {aligned(FULL)} FROM {source} {where}"


@query("normalize_posting", pay_sql(full_sql(), resolved=RESOLVED))
def normalize_posting(spark, sf):
    """The flagship: every rule of the output table, sorted."""
    return plain(assemble.normalize_postings(postings(spark, sf)))


@query(
    "collect_request",
    pay_sql(
        full_sql("picked JOIN resolved USING (seq)"),
        resolved=RESOLVED,
        once="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site,
            CASE WHEN site IN ('indeed', 'glassdoor', 'zip_recruiter') THEN job_url ELSE id END ORDER BY seq) AS rn
            FROM rec WHERE remote AND jt = 'parttime' AND lower(concat_ws(' ', title, description)) LIKE '%analyst%') WHERE rn = 1""",
        picked="SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY seq) AS rn2 FROM once) WHERE rn2 BETWEEN 6 AND 25",
    ),
)
def collect_request(spark, sf):
    """A request with filters, duplicates, offset and limit, end to end."""
    spec = SearchSpec(
        search_term="analyst", is_remote=True, job_type="parttime", offset=5, results_wanted=20,
        as_of=AS_OF,
    )
    return plain(collect_postings(postings(spark, sf), spec))
