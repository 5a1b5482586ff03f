"""JSON payloads made from the projected postings and parsed back. Every 13th payload is broken."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from checks.assembly import EMAIL
from checks.inputs import AS_OF, plain, pst, pst_sql, raw
from checks.registry import query
from checks.scalars import _TYPED
from vacancia.functions import salary
from vacancia.functions.arrays import with_once
from vacancia.lookups import lookup
from vacancia.operators.enrich import enrich_with_details
from vacancia.plans.collect import SearchSpec, collect_landed, parse_landed
from vacancia.sources import boards_json, careers_json, sinks
from vacancia.sources.payloads import ParseOptions
from vacancia.session import work_folder

OPTIONS = ParseOptions(as_of=AS_OF)
C = F.col


def k():
    return F.col("seq")


def key():
    return F.col("seq").cast("string")


def s(**fields):
    return F.struct(*[(F.lit(v) if isinstance(v, (str, int, float, bool)) else v).alias(n) for n, v in fields.items()])


def payloads(spark, sf, payload, site, url=None):
    """A payload table; ``payload`` is a struct or array column."""
    text = F.to_json(payload)
    broken = F.when(k() % 13 == 0, F.concat(F.lit("<"), text)).otherwise(text)
    return raw(pst(spark, sf), broken, site, url)


def outs():
    return {
        "city": C("location.city"),
        "state": C("location.state"),
        "country": C("location.country"),
        "interval": C("compensation.interval"),
        "min_amount": C("compensation.min_amount"),
        "max_amount": C("compensation.max_amount"),
        "currency": C("compensation.currency"),
        "paid": C("compensation").isNotNull(),
        "types": F.array_join("job_type", ", "),
        "mails": F.when(F.size("emails") > 0, F.array_join("emails", ", ")),
        "skill_list": F.array_join("skills", "|"),
    }


def out(df, names):
    known = outs()
    return plain(df.select(*[(known[n] if n in known else C(n)).alias(n) for n in names.split()]))


def oracle(where="seq % 13 <> 0", **columns):
    return pst_sql("SELECT " + ", ".join(f"{v} AS {n}" for n, v in columns.items()) + f" FROM pst WHERE {where}")


_KS = "CAST(seq AS VARCHAR)"
_DAY = "CAST(date_posted AS VARCHAR)"
_TEXT = "coalesce(description, 'none')"
_MAILS = f"nullif(array_to_string(regexp_extract_all(description, '{EMAIL}'), ', '), '')"


def unit():
    names = {"hourly": "HOUR", "daily": "DAY", "weekly": "WEEK", "monthly": "MONTH", "yearly": "YEAR"}
    return lookup(names, C("comp_interval"))


def day_text():
    return C("date_posted").cast("string")


def day_ms():
    return F.unix_date("date_posted").cast("bigint") * 86_400_000 + 18_000_000


# ---- boards -----------------------------------------------------------------------------------


def indeed_raw(spark, sf):
    pay = F.when(C("comp_min").isNotNull(), s(unitOfWork=unit(), range=s(min=C("comp_min") + 0.7, max=C("comp_max"))))
    estimated = F.when(k() % 5 == 0, s(currencyCode="EUR", baseSalary=s(unitOfWork="YEAR", range=s(min=1000.5, max=2000.5))))
    dossier = F.when(
        k() % 2 == 0,
        s(
            employerDetails=s(addresses=F.array(C("location_text")), industry="IT_services_Iv1", employeesLocalizedLabel="10+",
                              revenueLocalizedLabel="$1M", briefDescription=C("company_name")),
            images=s(squareLogoUrl="https://i.test/x.png"), links=s(corporateWebsite="https://corp.test"),
        ),
    )
    job = s(
        key=key(), title=C("title"), datePublished=day_ms(),
        description=s(html=F.concat(F.lit("<p>"), F.coalesce("description", F.lit("none")), F.lit("</p>"))),
        location=s(city=C("country"), admin1Code="CA", countryCode="US", formatted=s(long=C("location_text"))),
        compensation=s(currencyCode="USD", baseSalary=pay, estimated=estimated),
        attributes=F.array(s(key="a", label=F.coalesce("job_type_text", F.lit("Pets"))), s(key="b", label="Health insurance")),
        employer=F.when(k() % 8 > 0, s(name=C("company_name"), relativeCompanyPageUrl="/cmp/x", dossier=dossier)),
        recruit=F.when(k() % 3 == 0, s(viewJobUrl=C("job_url"))),
    )
    return payloads(spark, sf, s(data=s(jobSearch=s(results=F.array(s(job=job))))), "indeed")


_INDEED_PAY = dict(
    interval="CASE WHEN comp_min IS NOT NULL THEN comp_interval WHEN seq % 5 = 0 THEN 'yearly' END",
    min_amount="CASE WHEN comp_min IS NOT NULL THEN comp_min WHEN seq % 5 = 0 THEN 1000 END",
    max_amount="CASE WHEN comp_min IS NOT NULL THEN comp_max WHEN seq % 5 = 0 THEN 2000 END",
    currency="CASE WHEN seq % 5 = 0 THEN 'EUR' WHEN comp_min IS NOT NULL THEN 'USD' END",
)
_FOUND_TYPE = """CASE job_type_text WHEN 'full-time' THEN 'fulltime' WHEN 'Part Time' THEN 'parttime' WHEN 'Contract' THEN 'contract' WHEN 'Praktikum' THEN 'internship' ELSE {none} END"""


@query(
    "parse_indeed",
    oracle(
        id=f"'in-' || {_KS}", title="title", company_name="CASE WHEN seq % 8 > 0 THEN company_name END",
        job_url=f"'https://www.indeed.com/viewjob?jk=' || {_KS}", job_url_direct="CASE WHEN seq % 3 = 0 THEN job_url END",
        city="country", state="'CA'", country="'US'", description=f"trim({_TEXT})", date_posted=_DAY,
        types=_FOUND_TYPE.format(none="''"), mails=_MAILS,
        is_remote=f"regexp_matches(lower(concat_ws(' ', {_TEXT}, location_text)), 'remote|work from home|wfh')",
        company_url="CASE WHEN seq % 8 > 0 THEN 'https://www.indeed.com/cmp/x' END",
        company_addresses="CASE WHEN seq % 8 > 0 AND seq % 2 = 0 THEN location_text END",
        company_industry="CASE WHEN seq % 8 > 0 AND seq % 2 = 0 THEN 'It Services' END",
        company_logo="CASE WHEN seq % 8 > 0 AND seq % 2 = 0 THEN 'https://i.test/x.png' END",
        **_INDEED_PAY,
    ),
)
def parse_indeed(spark, sf):
    return out(
        boards_json.INDEED.parse(indeed_raw(spark, sf), OPTIONS),
        "id title company_name job_url job_url_direct city state country description date_posted types mails is_remote "
        "company_url company_addresses company_industry company_logo interval min_amount max_amount currency",
    )


@query("indeed_compensation", oracle(seq="seq", **_INDEED_PAY))
def indeed_compensation(spark, sf):
    return out(boards_json.INDEED.parse(indeed_raw(spark, sf), OPTIONS), "seq interval min_amount max_amount currency")


def zip_raw(spark, sf):
    job = s(
        name=C("title"), listing_key=C("id"), job_description=F.concat(F.lit(" "), F.coalesce("description", F.lit("none")), F.lit("\n")),
        buyer_type=C("site"), hiring_company=s(name=C("company_name")), job_country=F.when(k() % 2 == 0, "US").otherwise("CA"),
        job_city=C("location_text"), job_state="CA", employment_type=F.when(k() % 3 == 0, "full_time").when(k() % 3 == 1, "Contract").otherwise("x"),
        posted_time=F.concat(F.coalesce(day_text(), F.lit("2024-01-01")), F.lit("T10:00:00Z")),
        compensation_interval=F.when(k() % 4 == 0, "annual").otherwise(C("comp_interval")),
        compensation_min=C("comp_min") + 0.9, compensation_max=C("comp_max"), compensation_currency=F.when(k() % 4 < 2, "USD"),
    )
    return payloads(spark, sf, s(jobs=F.array(job)), "zip_recruiter")


_ZIP_PAY = dict(
    paid="true", interval="CASE WHEN seq % 4 = 0 THEN 'yearly' ELSE comp_interval END", min_amount="comp_min", max_amount="comp_max",
    currency="CASE WHEN seq % 4 < 2 THEN 'USD' END",
)


@query(
    "parse_ziprecruiter",
    oracle(
        id="'zr-' || id", title="title", company_name="company_name", job_url="'https://www.ziprecruiter.com/jobs//j?lvk=' || id",
        city="location_text", state="'CA'", country="CASE WHEN seq % 2 = 0 THEN 'usa' ELSE 'canada' END", description=f"trim({_TEXT})",
        date_posted=f"coalesce({_DAY}, '2024-01-01')", types="CASE seq % 3 WHEN 0 THEN 'fulltime' WHEN 1 THEN 'contract' END",
        mails=_MAILS, listing_type="site", **_ZIP_PAY,
    ),
)
def parse_ziprecruiter(spark, sf):
    return out(
        boards_json.ZIP_RECRUITER.parse(zip_raw(spark, sf), OPTIONS),
        "id title company_name job_url city state country description date_posted types mails listing_type paid interval min_amount max_amount currency",
    )


@query("zip_compensation", oracle(seq="seq", **_ZIP_PAY))
def zip_compensation(spark, sf):
    return out(boards_json.ZIP_RECRUITER.parse(zip_raw(spark, sf), OPTIONS), "seq paid interval min_amount max_amount currency")


def glassdoor_raw(spark, sf):
    header = s(
        ageInDays=F.when(k() % 6 > 0, (k() % 40).cast("int")), employerNameFromSearch=C("company_name"), locationName=C("location_text"),
        locationType=F.when(k() % 7 == 0, "S").otherwise("C"), payCurrency=F.when(k() % 2 == 0, "GBP"),
        payPeriod=F.when(k() % 4 == 0, "ANNUAL").when(k() % 4 == 1, "HOUR").when(k() % 4 == 2, "MONTHLY"),
        payPeriodAdjustedPay=F.when(C("comp_max").isNotNull(), s(p10=C("comp_min") + 0.9, p90=C("comp_max") + 0.2)),
        adOrderSponsorshipLevel=F.upper(C("site")), employer=s(id=F.when(k() % 3 > 0, k())),
    )
    view = s(header=header, job=s(listingId=k(), jobTitleText=C("title"), description=C("description")), overview=s(squareLogoUrl="https://i.test/l"))
    page = s(data=s(jobListings=s(jobListings=F.array(s(jobview=view)))))
    return payloads(spark, sf, F.array(page), "glassdoor")


_GD_ON = "comp_max IS NOT NULL AND seq % 4 < 3"
_GD_PAY = dict(
    interval=f"CASE WHEN {_GD_ON} THEN CASE seq % 4 WHEN 0 THEN 'yearly' WHEN 1 THEN 'hourly' ELSE 'monthly' END END",
    min_amount=f"CASE WHEN {_GD_ON} THEN comp_min END", max_amount=f"CASE WHEN {_GD_ON} THEN comp_max END",
    currency=f"CASE WHEN {_GD_ON} THEN CASE WHEN seq % 2 = 0 THEN 'GBP' ELSE 'USD' END END",
)


@query(
    "parse_glassdoor",
    oracle(
        id=f"'gd-' || {_KS}", title="title", company_name="company_name", job_url=f"'https://www.glassdoor.com/job-listing/j?jl=' || {_KS}",
        company_url=f"CASE WHEN seq % 3 > 0 THEN 'https://www.glassdoor.com/Overview/W-EI_IE' || {_KS} || '.htm' END",
        city="CASE WHEN seq % 7 > 0 AND location_text <> 'Remote' THEN split_part(location_text, ', ', 1) END",
        state="CASE WHEN seq % 7 > 0 AND location_text <> 'Remote' THEN CASE WHEN contains(location_text, ', ') THEN substr(location_text, position(', ' IN location_text) + 2) ELSE '' END END",
        date_posted=f"CASE WHEN seq % 6 > 0 THEN CAST(DATE '{AS_OF}' - CAST(seq % 40 AS INTEGER) AS VARCHAR) END",
        is_remote="seq % 7 = 0", description="nullif(trim(description), '')", mails=_MAILS,
        listing_type="lower(site)", company_logo="'https://i.test/l'", **_GD_PAY,
    ),
)
def parse_glassdoor(spark, sf):
    return out(
        boards_json.GLASSDOOR.parse(glassdoor_raw(spark, sf), OPTIONS),
        "id title company_name job_url company_url city state date_posted is_remote description mails listing_type company_logo "
        "interval min_amount max_amount currency",
    )


@query("glassdoor_compensation", oracle(seq="seq", **_GD_PAY))
def glassdoor_compensation(spark, sf):
    return out(boards_json.GLASSDOOR.parse(glassdoor_raw(spark, sf), OPTIONS), "seq interval min_amount max_amount currency")


def naukri_raw(spark, sf):
    holders = F.array(
        s(type="experience", label="2-5 Yrs"), s(type="salary", label=C("salary_label")),
        s(type="location", label=F.coalesce("location_text", F.lit("Hybrid - Pune, Delhi"))),
    )
    text = F.concat(F.lit('<span class="x job-type">Full-Time</span><span class="industry"> IT </span><p>'), F.coalesce("description", F.lit("none")), F.lit("</p>"))
    job = s(
        jobId=key(), title=C("title"), companyName=F.when(k() % 9 > 0, C("company_name")), staticUrl=F.when(k() % 2 == 0, "acme-jobs"),
        jdURL=F.when(k() % 3 > 0, F.concat(F.lit("/job-listings-"), key())), jobDescription=text, tagsAndSkills=F.replace("title", F.lit(" "), F.lit(",")),
        experienceText="2-5 Yrs", vacancy=k() % 7, footerPlaceholderLabel=C("date_label"), createdDate=day_ms(),
        logoPath="https://i.test/1", logoPathV3=F.when(k() % 2 == 0, "https://i.test/3").otherwise(""), placeholders=holders,
        ambitionBoxData=F.when(k() % 4 > 0, s(AggregateRating="4.1", ReviewsCount=k())),
    )
    return payloads(spark, sf, s(jobDetails=F.array(job)), "naukri")


_PLACE = "coalesce(location_text, 'Hybrid - Pune, Delhi')"


@query(
    "parse_naukri",
    oracle(
        id=f"'nk-' || {_KS}", title="title", company_name="CASE WHEN seq % 9 > 0 THEN company_name ELSE 'N/A' END",
        company_url="CASE WHEN seq % 2 = 0 THEN 'https://www.naukri.com/acme-jobs' END",
        job_url=f"'https://www.naukri.com' || CASE WHEN seq % 3 > 0 THEN '/job-listings-' ELSE '/job/' END || {_KS}",
        city=f"split_part({_PLACE}, ', ', 1)", state=f"nullif(split_part({_PLACE}, ', ', 2), '')", country="'india'",
        date_posted=f"""CAST(CASE WHEN date_label = 'Today' THEN DATE '{AS_OF}' WHEN date_label = '3 days ago' THEN DATE '{AS_OF}' - 3
          WHEN contains(date_label, 'ago') THEN NULL ELSE date_posted END AS VARCHAR)""",
        min_amount="CAST(CASE seq % 6 WHEN 0 THEN (5 + seq % 20) * 100000 WHEN 1 THEN 10000000 END AS DOUBLE)",
        max_amount="CAST(CASE seq % 6 WHEN 0 THEN (25 + seq % 20) * 100000 WHEN 1 THEN 25000000 END AS DOUBLE)",
        currency="CASE WHEN seq % 6 < 2 THEN 'INR' END", types="'fulltime'", company_industry="'IT'",
        skill_list="replace(title, ' ', '|')", vacancy_count="seq % 7", company_rating="CASE WHEN seq % 4 > 0 THEN CAST(4.1 AS DOUBLE) END",
        company_reviews_count="CASE WHEN seq % 4 > 0 THEN seq END", company_logo="CASE WHEN seq % 2 = 0 THEN 'https://i.test/3' ELSE 'https://i.test/1' END",
        work_from_home_type=f"CASE WHEN contains(lower({_PLACE}), 'hybrid') THEN 'Hybrid' WHEN contains(lower(concat_ws(' ', {_PLACE}, title, description)), 'remote') THEN 'Remote' ELSE 'Work from office' END",
        is_remote=f"regexp_matches(lower(concat_ws(' ', title, description, {_PLACE})), 'remote|work from home|wfh')",
    ),
)
def parse_naukri(spark, sf):
    return out(
        boards_json.NAUKRI.parse(naukri_raw(spark, sf), OPTIONS),
        "id title company_name company_url job_url city state country date_posted min_amount max_amount currency types company_industry "
        "skill_list vacancy_count company_rating company_reviews_count company_logo work_from_home_type is_remote",
    )


def seek_raw(spark, sf):
    job = s(
        id=key(), title=F.when(k() % 10 > 0, C("title")).otherwise(""), advertiser=s(description=C("company_name")),
        locations=F.when(C("location_text").isNotNull(), F.array(s(label=C("location_text")))), listingDate=F.concat(day_text(), F.lit("T10:30:00Z")),
        salaryLabel=C("salary_label"), workTypes=F.array(F.when(k() % 3 == 0, "Full time").otherwise("Casual")), teaser=C("description"),
        bulletPoints=F.when(k() % 2 == 0, F.array(C("site"), C("country"))),
    )
    return payloads(spark, sf, s(data=F.array(job)), "seek")


@query(
    "parse_seek",
    oracle(
        where="seq % 13 <> 0 AND seq % 10 > 0",
        id=_KS, title="title", company_name="company_name", job_url=f"'https://www.seek.co.nz/job/' || {_KS}",
        city="split_part(location_text, ',', 1)",
        state="CASE WHEN contains(location_text, ',') THEN trim(substr(location_text, position(',' IN location_text) + 1)) END", country="'new zealand'",
        date_posted=_DAY, types="CASE WHEN seq % 3 = 0 THEN 'fulltime' ELSE 'parttime' END",
        interval="CASE seq % 6 WHEN 2 THEN NULL WHEN 5 THEN NULL WHEN 4 THEN 'hourly' ELSE 'yearly' END",
        min_amount="CAST(CASE seq % 6 WHEN 0 THEN 5 + seq % 20 WHEN 1 THEN 1 WHEN 3 THEN (30 + seq % 40) * 1000 WHEN 4 THEN 35 + seq % 9 END AS DOUBLE)",
        currency="CASE WHEN seq % 6 IN (0, 1, 3, 4) THEN 'NZD' END",
        is_remote="regexp_matches(lower(concat_ws(' ', title, location_text)), 'remote')",
        description="nullif(concat_ws(chr(10) || chr(10), nullif(description, ''), CASE WHEN seq % 2 = 0 THEN '- ' || site || chr(10) || '- ' || country END), '')",
    ),
)
def parse_seek(spark, sf):
    options = ParseOptions(as_of=AS_OF, country="new zealand")
    return out(
        boards_json.SEEK.parse(seek_raw(spark, sf), options),
        "id title company_name job_url city state country date_posted types interval min_amount currency is_remote description",
    )


def reed_raw(spark, sf):
    job = s(
        jobId=k(), jobTitle=C("title"), employerName=C("company_name"), locationName=C("location_text"),
        date=F.date_format("date_posted", "dd/MM/yyyy"), minimumSalary=C("comp_min"), maximumSalary=C("comp_max"),
        currency=F.when(k() % 3 == 0, "EUR"), fullTime=k() % 2 == 0, partTime=k() % 5 == 0, contract=F.lit(False), temp=k() % 7 == 0,
    )
    return payloads(spark, sf, s(results=F.array(job)), "reed")


def reed_details_raw(spark, sf):
    """Details of all postings; two thirds of them belong to postings that are not listed."""
    df = pst(spark, sf)
    detail = F.to_json(
        s(
            jobId=F.when(k() % 3 == 0, k()).otherwise(-k() - 1), locationName=F.when(k() % 2 == 0, "Leeds, West Yorkshire"), minimumSalary=C("comp_min") * 100, maximumSalary=0,
            salaryType=F.when(k() % 4 == 0, "Per Month").otherwise("other"), currency=F.when(k() % 2 == 1, "CHF"), jobType="Full Time",
            contractType=F.when(k() % 2 == 0, "permanent").otherwise("Contract"), jobUrl=C("job_url"), externalUrl="",
            jobDescription=F.concat(F.lit("<b>wfh</b> "), "company_name"),
        )
    )
    return raw(df, detail, "reed", F.concat(F.lit("https://api.test/jobs/"), key()))


@query(
    "parse_reed",
    oracle(
        id=_KS, title="title", job_url=f"CASE WHEN seq % 3 = 0 THEN job_url ELSE 'https://www.reed.co.uk/jobs/' || {_KS} END",
        city="CASE WHEN seq % 6 = 0 THEN 'Leeds' ELSE split_part(location_text, ',', 1) END",
        state="CASE WHEN seq % 6 = 0 THEN 'West Yorkshire' WHEN contains(location_text, ',') THEN trim(substr(location_text, position(',' IN location_text) + 1)) END",
        country="'uk'", date_posted=_DAY,
        min_amount="CASE WHEN seq % 3 = 0 THEN comp_min * 100 ELSE comp_min END", max_amount="CASE WHEN seq % 3 > 0 THEN comp_max END",
        interval="CASE WHEN comp_min IS NOT NULL THEN CASE WHEN seq % 12 = 0 THEN 'monthly' WHEN seq % 3 = 0 THEN 'yearly' ELSE 'hourly' END END",
        currency="CASE WHEN comp_min IS NOT NULL THEN CASE WHEN seq % 3 = 0 AND seq % 2 = 1 THEN 'CHF' ELSE 'GBP' END END",
        types="""CASE WHEN seq % 3 = 0 THEN 'fulltime' || CASE WHEN seq % 2 = 1 THEN ', contract' ELSE '' END
          ELSE nullif(concat_ws(', ', CASE WHEN seq % 2 = 0 THEN 'fulltime' END, CASE WHEN seq % 5 = 0 THEN 'parttime' END, CASE WHEN seq % 7 = 0 THEN 'temporary' END), '') END""",
        description="CASE WHEN seq % 3 = 0 THEN '**wfh** ' || company_name END",
        is_remote="seq % 3 = 0 OR contains(lower(concat_ws(' ', title, location_text)), 'remote')",
    ),
)
def parse_reed(spark, sf):
    return out(
        boards_json.parse_reed(reed_raw(spark, sf), reed_details_raw(spark, sf), OPTIONS),
        "id title job_url city state country date_posted min_amount max_amount interval currency types description is_remote",
    )


@query(
    "reed_salary_details",
    oracle(
        where="true", seq="seq", interval="CASE WHEN comp_min IS NOT NULL THEN CASE WHEN seq % 4 = 0 THEN 'monthly' ELSE 'yearly' END END",
        min_amount="comp_min * 100", max_amount="CAST(NULL AS DOUBLE)",
        currency="CASE WHEN comp_min IS NOT NULL THEN CASE WHEN seq % 2 = 1 THEN 'CHF' ELSE 'GBP' END END",
    ),
)
def reed_salary_details(spark, sf):
    df = pst(spark, sf)
    comp = salary.reed_salary_details(
        C("comp_min") * 100, F.lit(0.0), F.when(k() % 4 == 0, "Per Month").otherwise("other"), F.when(k() % 2 == 1, "CHF")
    )
    return df.select("seq", comp.alias("c")).select("seq", "c.*")


# ---- positional records -----------------------------------------------------------------------


def google_record():
    """29 positions as JSON text; some lack the link, the age or everything after the text."""
    def q(c):
        return F.btrim(F.to_json(F.array(c)), F.lit("[]"))

    null = F.lit("null")
    link = F.when(k() % 10 == 0, F.lit("[]")).otherwise(F.concat(F.lit("[["), q(C("job_url")), F.lit(',"x"]]')))
    place = F.when(C("location_text").isNull(), null).otherwise(q(C("location_text")))
    age = F.when(k() % 4 == 0, F.lit("7")).otherwise(q(C("date_label")))
    text = F.when(C("description").isNull(), null).otherwise(q(C("description")))
    head = [q(C("title")), q(C("company_name")), place, link, *[null] * 8, age, *[null] * 6, text]
    tail = F.when(k() % 3 == 0, F.lit("")).otherwise(F.concat(*[F.lit(",null")] * 8, F.lit(","), q(C("id"))))
    return F.concat(F.lit("["), F.concat_ws(",", *head), tail, F.lit("]"))


_GOOGLE = dict(
    id="'go-' || CASE WHEN seq % 3 = 0 THEN sha256(job_url) ELSE id END", title="title", company_name="company_name", job_url="job_url",
    city="CASE WHEN contains(location_text, ',') THEN trim(split_part(location_text, ',', 1)) ELSE location_text END",
    state="nullif(trim(split_part(location_text, ',', 2)), '')", country="nullif(trim(split_part(location_text, ',', 3)), '')",
    date_posted=f"CAST(CASE WHEN seq % 4 > 0 THEN DATE '{AS_OF}' - CAST(nullif(regexp_extract(date_label, '\\d+'), '') AS INTEGER) END AS VARCHAR)",
    is_remote="regexp_matches(lower(coalesce(description, '')), 'remote|wfh')", description="coalesce(description, '')",
    mails=_MAILS, types="nullif(" + _TYPED.format(t="description") + ", 'none')",
)
_GOOGLE_OUT = "id title company_name job_url city state country date_posted is_remote description mails types"


@query("google_positional_job", oracle(where="seq % 10 > 0", **_GOOGLE))
def google_positional_job(spark, sf):
    records = pst(spark, sf).select("seq", F.lit(0).alias("pos"), google_record().alias("record"))
    return out(boards_json.google_positional_job(records, OPTIONS), _GOOGLE_OUT)


def google_page_raw(spark, sf):
    inner = F.concat(F.lit('[[["x",{"a":[{"b":1},{"520084652":'), google_record(), F.lit("}]}]]]"))
    quoted = F.btrim(F.to_json(F.array(inner)), F.lit("[]"))
    item = F.concat(F.lit('["k",'), quoted, F.lit("]"))
    body = F.concat(F.lit(")]}'\n[[[\"none\",\"skip\"],"), item, F.lit("],[[\"z\"]]]"))
    return raw(pst(spark, sf), body, "google")


@query("parse_google_page", oracle(where="seq % 10 > 0", **_GOOGLE))
def parse_google_page(spark, sf):
    return out(boards_json.parse_google_page(google_page_raw(spark, sf), OPTIONS), _GOOGLE_OUT)


def google_initial_raw(spark, sf):
    """Two records per page; the first of every 13th page is broken. Records end in an array."""
    df = with_once(pst(spark, sf), record=google_record())
    record = F.concat(C("record").substr(F.lit(1), F.length("record") - 1), F.lit(',["z"]]'))
    close = "}]]]]]"
    body = F.concat(
        F.lit('<html><script>data=[[[[[{"520084652":'), F.when(k() % 13 == 0, F.concat(F.lit("[oops,"), record, F.lit("]"))).otherwise(record), F.lit(close),
        F.lit(';more=[[[[[{"520084652":'), record, F.lit(close), F.lit("</script></html>"),
    )
    return raw(df, body, "google")


@query(
    "parse_google_initial",
    pst_sql("SELECT seq, title, job_url FROM pst WHERE seq % 10 > 0 AND seq % 13 > 0 UNION ALL SELECT seq, title, job_url FROM pst WHERE seq % 10 > 0"),
)
def parse_google_initial(spark, sf):
    return out(boards_json.parse_google_initial(google_initial_raw(spark, sf), OPTIONS), "seq title job_url")


# ---- career platforms -------------------------------------------------------------------------


def greenhouse_raw(spark, sf):
    job = s(
        id=k(), title=C("title"), absolute_url=F.when(k() % 2 == 0, C("job_url")).otherwise(""), location=s(name=C("location_text")),
        content=F.concat(F.lit("<div><p>"), F.coalesce("description", F.lit("none")), F.lit("</p></div>")),
        updated_at=F.when(k() % 3 > 0, F.concat(day_text(), F.lit("T20:00:00-05:00"))), created_at="2020-02-03T00:00:00Z",
    )
    url = F.concat(F.lit("https://boards-api.greenhouse.io/v1/boards/"), C("site"), F.lit("/jobs?content=true"))
    return payloads(spark, sf, s(jobs=F.array(job)), "greenhouse", url)


_P = "string_split(location_text, ',')"


def _loc(i):
    return f"trim({_P}[{i}])"


@query(
    "parse_greenhouse",
    oracle(
        id=f"'greenhouse:' || site || ':' || {_KS}", title="title", company_name="company_name",
        job_url=f"CASE WHEN seq % 2 = 0 THEN job_url ELSE 'https://boards.greenhouse.io/' || site || '/jobs/' || {_KS} END",
        city=_loc(1), state=f"CASE WHEN len({_P}) >= 3 OR length({_loc(2)}) = 2 THEN {_loc(2)} END",
        country=f"CASE WHEN len({_P}) >= 3 THEN {_loc(3)} WHEN length({_loc(2)}) <> 2 THEN {_loc(2)} END",
        date_posted=f"CASE WHEN seq % 3 > 0 AND date_posted IS NOT NULL THEN {_DAY} ELSE '2020-02-03' END", is_remote="coalesce(contains(lower(location_text), 'remote'), false)",
        description=f"trim({_TEXT})", types="nullif(" + _TYPED.format(t="description") + ", 'none')", mails=_MAILS,
    ),
)
def parse_greenhouse(spark, sf):
    return out(
        careers_json.GREENHOUSE.parse(greenhouse_raw(spark, sf), OPTIONS),
        "id title company_name job_url city state country date_posted is_remote description types mails",
    )


def lever_raw(spark, sf):
    job = s(
        id=C("id"), text=C("title"), hostedUrl=F.when(k() % 2 == 0, C("job_url")), applyUrl="https://apply.test",
        categories=s(location=C("location_text"), commitment=F.when(k() % 3 == 0, C("job_type_text"))),
        lists=F.when(k() % 4 > 0, F.array(s(text="Duties", content=F.concat(F.lit("<li>"), "company_name", F.lit("</li>"))), s(text="", content="<b>x</b>"))),
        additional=F.when(k() % 5 == 0, "<p>bye</p>"), descriptionPlain=C("description"), createdAt=day_ms(),
    )
    url = F.concat(F.lit("https://jobs.lever.co/"), C("site"))
    return payloads(spark, sf, F.array(job), "lever", url)


_LEVER_TEXT = """nullif(concat_ws(chr(10) || chr(10), nullif(description, ''), CASE WHEN seq % 4 > 0 THEN '## Duties' END,
  CASE WHEN seq % 4 > 0 THEN '- ' || company_name END, CASE WHEN seq % 4 > 0 THEN '**x**' END, CASE WHEN seq % 5 = 0 THEN 'bye' END), '')"""


@query(
    "parse_lever",
    pst_sql(
        f"""SELECT 'lever:' || site || ':' || id AS id, title, CASE WHEN seq % 2 = 0 THEN job_url ELSE 'https://apply.test' END AS job_url, {_loc(1)} AS city,
      CASE WHEN len({_P}) >= 2 AND length({_loc(-1)}) <= 3 THEN {_loc(-1)} END AS state, CASE WHEN len({_P}) >= 2 AND length({_loc(-1)}) > 3 THEN {_loc(-1)} END AS country,
      {_DAY} AS date_posted, contains(lower(concat_ws(' ', location_text, CASE WHEN seq % 3 = 0 THEN job_type_text END)), 'remote') AS is_remote, body AS description,
      nullif({_TYPED.format(t='kind')}, 'none') AS types FROM (SELECT *, CASE WHEN seq % 3 = 0 AND job_type_text IS NOT NULL THEN job_type_text ELSE body END AS kind
        FROM (SELECT *, {_LEVER_TEXT} AS body FROM pst)) WHERE seq % 13 <> 0"""
    ),
)
def parse_lever(spark, sf):
    return out(
        careers_json.LEVER.parse(lever_raw(spark, sf), OPTIONS),
        "id title job_url city state country date_posted is_remote description types",
    )


def ashby_raw(spark, sf):
    tier = s(min=C("comp_min"), max=C("comp_max"), currencyCode=F.when(k() % 2 == 0, "EUR"), interval=F.when(k() % 3 == 0, "hour").otherwise("1 BIWEEK"))
    job = s(
        id=C("id"), title=C("title"), jobUrl=F.when(k() % 2 == 0, C("job_url")),
        location=C("location_text"), descriptionHtml=F.when(k() % 2 == 0, C("description")), description="plain text",
        publishedAt=F.when(k() % 3 > 0, F.concat(day_text(), F.lit("T20:00:00.000+00:00"))), updatedAt="2020-02-03", isRemote=k() % 9 == 0,
        employmentType=F.when(k() % 3 == 0, "Contract"), compensation=F.when(k() % 4 > 0, s(compensationTiers=F.array(tier))),
    )
    text = F.to_json(s(jobs=F.array(job)))
    # Locations are a text or an object.
    text = F.when(
        k() % 2 == 0, F.regexp_replace(text, '"location":("[^"]*")', '"location":{"name":$1}')
    ).otherwise(text)
    broken = F.when(k() % 13 == 0, F.concat(F.lit("<"), text)).otherwise(text)
    return raw(pst(spark, sf), broken, "ashby", F.concat(F.lit("https://jobs.ashbyhq.com/"), C("site"), F.lit("/x")))


_ASHBY_ON = "seq % 4 > 0 AND comp_min IS NOT NULL"
_ASHBY_PAY = dict(
    interval=f"CASE WHEN {_ASHBY_ON} THEN CASE WHEN seq % 3 = 0 THEN 'hourly' ELSE 'yearly' END END", min_amount=f"CASE WHEN {_ASHBY_ON} THEN comp_min END",
    max_amount=f"CASE WHEN {_ASHBY_ON} THEN comp_max END", currency=f"CASE WHEN {_ASHBY_ON} THEN CASE WHEN seq % 2 = 0 THEN 'EUR' ELSE 'USD' END END",
)
_ASHBY_TEXT = "CASE WHEN seq % 2 = 0 AND description <> '' THEN trim(description) ELSE 'plain text' END"


@query(
    "parse_ashby",
    oracle(
        id="'ashby:' || site || ':' || id", title="title", job_url="CASE WHEN seq % 2 = 0 THEN job_url ELSE 'https://jobs.ashbyhq.com/' || site || '/' || id END",
        city=_loc(1), country=f"CASE WHEN len({_P}) >= 2 THEN {_loc(-1)} END",
        date_posted=f"CASE WHEN seq % 3 > 0 AND date_posted IS NOT NULL THEN {_DAY} ELSE '2020-02-03' END",
        is_remote="seq % 9 = 0 OR coalesce(contains(lower(location_text), 'remote'), false)", description=_ASHBY_TEXT,
        types=f"coalesce(nullif({_TYPED.format(t=_ASHBY_TEXT)}, 'none'), CASE WHEN seq % 3 = 0 THEN 'contract' END)", **_ASHBY_PAY,
    ),
)
def parse_ashby(spark, sf):
    return out(
        careers_json.ASHBY.parse(ashby_raw(spark, sf), OPTIONS),
        "id title job_url city country date_posted is_remote description types interval min_amount max_amount currency",
    )


@query("ashby_compensation", oracle(seq="seq", **_ASHBY_PAY))
def ashby_compensation(spark, sf):
    return out(careers_json.ASHBY.parse(ashby_raw(spark, sf), OPTIONS), "seq interval min_amount max_amount currency")


def smartrecruiters_raw(spark, sf):
    job = s(
        id=F.when(k() % 2 == 0, key()).otherwise(""), uuid=F.concat(F.lit("u"), key()), name=C("title"),
        location=s(city=C("country"), region="", country="ie", remote=k() % 3 == 0),
        compensation=F.when(k() % 4 > 0, s(min=C("comp_min"), max=C("comp_max"), currency=F.when(k() % 2 == 0, "EUR"))),
        releasedDate=F.concat(day_text(), F.lit("T10:00:00.000Z")), updatedOn="2020-02-03T00:00:00Z", typeOfEmployment=s(label="Full time"),
    )
    return payloads(spark, sf, s(content=F.array(job), totalFound=1), "smartrecruiters", F.concat(F.lit("https://careers.smartrecruiters.com/"), C("site")))


_SR_ID = f"'smartrecruiters:' || site || ':' || CASE WHEN seq % 2 = 0 THEN {_KS} ELSE 'u' || {_KS} END"
_SR_ON = "seq % 4 > 0 AND comp_min IS NOT NULL"
_SR_PAY = dict(
    interval=f"CASE WHEN {_SR_ON} THEN 'yearly' END", min_amount=f"CASE WHEN {_SR_ON} THEN comp_min END",
    max_amount=f"CASE WHEN {_SR_ON} THEN comp_max END", currency=f"CASE WHEN {_SR_ON} THEN CASE WHEN seq % 2 = 0 THEN 'EUR' ELSE 'USD' END END",
)


@query(
    "parse_smartrecruiters",
    oracle(
        id=_SR_ID, title="title", job_url=f"'https://jobs.smartrecruiters.com/' || site || '/' || CASE WHEN seq % 2 = 0 THEN {_KS} ELSE 'u' || {_KS} END",
        city="country", state="CAST(NULL AS VARCHAR)", country="'ie'", date_posted=f"coalesce({_DAY}, '2020-02-03')", is_remote="seq % 3 = 0", types="'fulltime'", **_SR_PAY,
    ),
)
def parse_smartrecruiters(spark, sf):
    return out(
        careers_json.SMARTRECRUITERS.parse(smartrecruiters_raw(spark, sf), OPTIONS),
        "id title job_url city state country date_posted is_remote types interval min_amount max_amount currency",
    )


@query("smartrecruiters_compensation", oracle(seq="seq", **_SR_PAY))
def smartrecruiters_compensation(spark, sf):
    return out(careers_json.SMARTRECRUITERS.parse(smartrecruiters_raw(spark, sf), OPTIONS), "seq interval min_amount max_amount currency")


@query(
    "enrich_smartrecruiters",
    oracle(
        id=_SR_ID, job_url=f"CASE WHEN seq % 2 = 0 AND seq % 3 = 0 THEN job_url ELSE 'https://jobs.smartrecruiters.com/' || site || '/' || CASE WHEN seq % 2 = 0 THEN {_KS} ELSE 'u' || {_KS} END END",
        description="CASE WHEN seq % 2 = 0 THEN '**' || company_name || '**' || chr(10) || chr(10) || 'mail a@b.co, contract' END",
        types="'fulltime'", mails="CASE WHEN seq % 2 = 0 THEN 'a@b.co' END",
    ),
)
def enrich_smartrecruiters(spark, sf):
    """Listings joined with details, half of which are of other postings; types are only filled in."""
    listing = careers_json.SMARTRECRUITERS.parse(smartrecruiters_raw(spark, sf), OPTIONS)
    df = pst(spark, sf)
    sections = s(
        jobDescription=s(text=F.concat(F.lit("<b>"), "company_name", F.lit("</b>"))), qualifications=s(text=""),
        additionalInformation=s(text="<p>mail a@b.co, contract</p>"),
    )
    detail = F.to_json(s(postingUrl=F.when(k() % 3 == 0, C("job_url")), jobAd=s(sections=sections)))
    url = F.concat(F.lit("https://api.test/v1/companies/"), C("site"), F.lit("/postings/"), F.when(k() % 2 == 0, "").otherwise("other-"), key())
    details = careers_json.smartrecruiters_details(raw(df, detail, "smartrecruiters", url))
    done = enrich_with_details(listing, details, override=("description", "job_url"), job_type="fill")
    return out(done, "id job_url description types mails")


def workable_raw(spark, sf):
    published = F.when(k() % 2 == 0, day_ms().cast("string")).otherwise(F.concat(F.lit('"'), day_text(), F.lit('T23:00:00-03:00"')))
    job = s(
        shortcode=C("id"), title=C("title"), location=s(city=C("country"), region="R", country="Ireland", countryCode=F.when(k() % 3 == 0, "IE").otherwise("")),
        remote=k() % 5 == 0, workplace=F.when(k() % 4 == 0, "Remote-first").otherwise("on_site"), published="@@",
    )
    text = F.replace(F.to_json(s(results=F.array(job))), F.lit('"@@"'), F.coalesce(published, F.lit("null")))
    broken = F.when(k() % 13 == 0, F.concat(F.lit("<"), text)).otherwise(text)
    return raw(pst(spark, sf), broken, "workable", F.concat(F.lit("https://apply.workable.com/"), C("site"), F.lit("/")))


@query(
    "parse_workable",
    oracle(
        id="'workable:' || site || ':' || id", title="title", job_url="'https://apply.workable.com/' || site || '/j/' || id || '/'", city="country", state="'R'",
        country="CASE WHEN seq % 3 = 0 THEN 'IE' ELSE 'Ireland' END", date_posted=_DAY, is_remote="seq % 5 = 0 OR seq % 4 = 0",
    ),
)
def parse_workable(spark, sf):
    return out(careers_json.WORKABLE.parse(workable_raw(spark, sf), OPTIONS), "id title job_url city state country date_posted is_remote")


def workable_detail_raw(spark, sf):
    detail = F.to_json(
        s(description=C("description"), requirements=F.concat(F.lit("<ul><li>"), "company_name", F.lit("</li></ul>")), benefits=F.when(k() % 2 == 0, "perks").otherwise(""))
    )
    url = F.concat(F.lit("https://apply.workable.com/api/v2/accounts/"), C("site"), F.lit("/jobs/"), C("id"))
    return raw(pst(spark, sf), detail, "workable", url)


@query(
    "workable_details",
    oracle(
        where="true", id="'workable:' || site || ':' || id",
        description="nullif(concat_ws(chr(10) || chr(10), nullif(trim(description), ''), '* ' || company_name, CASE WHEN seq % 2 = 0 THEN 'perks' END), '')",
    ),
)
def workable_details(spark, sf):
    return careers_json.workable_details(workable_detail_raw(spark, sf)).drop("seq")


def bamboohr_raw(spark, sf):
    job = s(id=k(), jobOpeningName=F.when(k() % 2 == 0, C("title")).otherwise(""), title=C("company_name"), location="@@", isRemote=F.when(k() % 3 == 0, True))
    place = F.when(k() % 2 == 0, F.to_json(s(city=C("country"), state="", country=F.when(k() % 4 == 0, "IE")))).otherwise(F.lit('"Cork, Munster, Ireland"'))
    text = F.replace(F.to_json(s(result=F.array(job))), F.lit('"@@"'), place)
    broken = F.when(k() % 13 == 0, F.concat(F.lit("<"), text)).otherwise(text)
    return raw(pst(spark, sf), broken, "bamboohr", F.concat(F.lit("https://"), F.replace("site", F.lit("_"), F.lit("-")), F.lit(".bamboohr.com/careers/list")))


_BAMBOO_ID = f"'bamboohr:' || replace(site, '_', '-') || ':' || {_KS}"


@query(
    "parse_bamboohr",
    oracle(
        id=_BAMBOO_ID, title="CASE WHEN seq % 2 = 0 THEN title ELSE company_name END", job_url=f"'https://' || replace(site, '_', '-') || '.bamboohr.com/careers/' || {_KS}",
        city="CASE WHEN seq % 2 = 0 THEN country ELSE 'Cork' END", state="CAST(NULL AS VARCHAR)",
        country="CASE WHEN seq % 4 = 0 THEN 'IE' WHEN seq % 2 = 1 THEN 'Ireland' END", is_remote="seq % 3 = 0",
    ),
)
def parse_bamboohr(spark, sf):
    return out(careers_json.BAMBOOHR.parse(bamboohr_raw(spark, sf), OPTIONS), "id title job_url city state country is_remote")


def bamboohr_detail_raw(spark, sf):
    place = s(addressCountry=F.when(k() % 2 == 0, "IE").otherwise(""), country="Ireland")
    detail = F.to_json(s(result=s(jobOpening=s(description=C("description"), datePosted=day_text(), location=place))))
    url = F.concat(F.lit("https://"), F.replace("site", F.lit("_"), F.lit("-")), F.lit(".bamboohr.com/careers/"), key(), F.lit("/detail"))
    return raw(pst(spark, sf), detail, "bamboohr", url)


@query(
    "bamboohr_details",
    oracle(where="true", id=_BAMBOO_ID, description="nullif(trim(description), '')", date_posted=_DAY, country="CASE WHEN seq % 2 = 0 THEN 'IE' ELSE 'Ireland' END"),
)
def bamboohr_details(spark, sf):
    return plain(careers_json.bamboohr_details(bamboohr_detail_raw(spark, sf))).drop("seq")


@query("jsonld_compensation", pst_sql("""SELECT seq, CASE WHEN comp_min IS NOT NULL THEN coalesce(CASE WHEN seq % 2 = 0 THEN comp_interval END, 'yearly') END AS interval,
  comp_min AS min_amount, comp_max AS max_amount, CASE WHEN comp_min IS NOT NULL THEN 'USD' END AS currency FROM pst"""))
def jsonld_compensation(spark, sf):
    pay = s(currency=F.lit(None).cast("string"), value=s(minValue=C("comp_min").cast("string"), maxValue=C("comp_max").cast("string"),
            unitText=F.when(k() % 2 == 0, F.lower(unit())).otherwise("PIECE")))
    return pst(spark, sf).select("seq", salary.jsonld_compensation(pay).alias("c")).select("seq", "c.*")


# ---- quarantine, whole jobs, sinks ------------------------------------------------------------


@query(
    "quarantine_bad_rows",
    pst_sql("""SELECT seq, CASE WHEN seq % 13 = 0 THEN 'unreadable payload' ELSE 'missing field' END AS reason FROM pst WHERE seq % 13 = 0 OR seq % 10 = 0"""),
)
def quarantine_bad_rows(spark, sf):
    return boards_json.SEEK.quarantine(seek_raw(spark, sf)).select("seq", "reason")


def landed(spark, sf):
    """Payloads of several boards in one table."""
    frames = (indeed_raw(spark, sf), zip_raw(spark, sf), seek_raw(spark, sf), greenhouse_raw(spark, sf))
    return reduce(lambda a, b: a.unionByName(b), frames)


@query(
    "parse_landed",
    pst_sql("""SELECT site2 AS site, count(*) AS rows_read, count(DISTINCT seq) AS payloads FROM
      (SELECT seq, unnest(['indeed', 'zip_recruiter', 'seek', 'greenhouse']) AS site2 FROM pst) WHERE seq % 13 <> 0 AND NOT (site2 = 'seek' AND seq % 10 = 0) GROUP BY site2"""),
)
def parse_landed_query(spark, sf):
    df = parse_landed(landed(spark, sf), ["indeed", "zip_recruiter", "seek", "greenhouse"], OPTIONS)
    return df.groupBy("site").agg(F.count(F.lit(1)).alias("rows_read"), F.count_distinct("seq").alias("payloads"))


@query(
    "collect_landed",
    pst_sql(f"""SELECT 'indeed' AS site, 'in-' || {_KS} AS id, title, comp_interval AS interval, CASE WHEN comp_min IS NOT NULL THEN comp_min END AS min_amount
        FROM (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM pst WHERE seq % 13 <> 0 AND contains(lower(title), 'engineer')) WHERE rn <= 40 AND comp_min IS NOT NULL
      UNION ALL SELECT 'indeed', 'in-' || {_KS}, title, CASE WHEN seq % 5 = 0 THEN 'yearly' ELSE NULL END, CASE WHEN seq % 5 = 0 THEN 1000.0 END
        FROM (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM pst WHERE seq % 13 <> 0 AND contains(lower(title), 'engineer')) WHERE rn <= 40 AND comp_min IS NULL
      UNION ALL SELECT 'seek', {_KS}, title, CASE seq % 6 WHEN 2 THEN NULL WHEN 5 THEN NULL WHEN 4 THEN 'hourly' ELSE 'yearly' END,
          CASE seq % 6 WHEN 0 THEN 5 + seq % 20 WHEN 1 THEN 1 WHEN 3 THEN (30 + seq % 40) * 1000 WHEN 4 THEN 35 + seq % 9 END
        FROM (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM pst WHERE seq % 13 <> 0 AND seq % 10 > 0 AND contains(lower(title), 'engineer')) WHERE rn <= 40"""),
)
def collect_landed_query(spark, sf):
    """Landed payloads of two boards to the output table. Outside the USA, text is not searched for pay."""
    spec = SearchSpec(site_name=["indeed", "seek"], search_term="engineer", results_wanted=40, country="australia", as_of=AS_OF)
    df = collect_landed(landed(spark, sf), spec)
    return df.select("site", "id", "title", "interval", "min_amount")


@query("sink_csv", pst_sql("SELECT CAST(seq AS VARCHAR) AS seq, title, nullif(description, '') AS description, salary_label FROM pst"))
def sink_csv(spark, sf):
    """Written and read back with the same options."""
    path = work_folder(spark, f"postings-csv-{uuid.uuid4().hex}")
    sinks.sink_csv(pst(spark, sf).select("seq", "title", "description", "salary_label"), path)
    return (
        spark.read.option("header", True).option("escape", "\\").schema("seq string, title string, description string, salary_label string").csv(path)
        .withColumn("description", F.when(F.length("description") > 0, C("description")))
    )


@query("sink_table", pst_sql("SELECT seq, site, CASE WHEN site = 'reed' THEN upper(title) ELSE title END AS title, comp_min FROM pst"))
def sink_table(spark, sf):
    """Written by site, one site written again with other titles, and read back."""
    path = work_folder(spark, f"postings-table-{uuid.uuid4().hex}")
    df = pst(spark, sf).select("seq", "site", "title", "comp_min")
    sinks.sink_table(df, path)
    sinks.sink_table(df.where(F.col("site") == "reed").withColumn("title", F.upper("title")), path, "overwrite")
    return spark.read.schema(df.schema).parquet(path).select("seq", "site", "title", "comp_min")


@query("upsert_table", pst_sql("SELECT seq, site, CASE WHEN seq % 3 = 0 THEN upper(title) ELSE title END AS title FROM pst"))
def upsert_table(spark, sf):
    """Two batches that have rows in common, the second tried again: later rows replace earlier ones of their key."""
    path = work_folder(spark, f"postings-upsert-{uuid.uuid4().hex}")
    df = pst(spark, sf).select("seq", "site", "title")
    write = sinks.table_writer(path, ["seq"])
    write(df.where("seq % 3 != 1"), 0)
    later = df.where("seq % 3 != 2").withColumn("title", F.when(F.col("seq") % 3 == 0, F.upper("title")).otherwise(F.col("title")))
    write(later, 1)
    write(later, 1)
    return spark.read.schema(df.schema).parquet(path).select("seq", "site", "title")
