"""Job boards that answer in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import dates, job_types, locations, remote, salary, urls
from vacancia.functions.arrays import with_once
from vacancia.functions.json_tree import google_records
from vacancia.functions.markdown import markdown
from vacancia.functions.text import (
    extract_emails, first_match, industry_cleanup, join_present, let, non_empty, strip,
)
from vacancia.operators.ranking import first_per_key
from vacancia.operators.skew import salted_join
from vacancia.schema import location, posting_columns
from vacancia.sources.payloads import JsonSource, ParseOptions, has_text, rejects

_PAY = "struct<unitOfWork:string,range:struct<min:double,max:double>>"


def _or(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def _text(html: Column, o: ParseOptions) -> Column:
    """Markdown if that is wanted; these boards keep their HTML otherwise."""
    return markdown(html) if o.description_format == "markdown" else html


# ---- Indeed -----------------------------------------------------------------------------------

def _indeed_fields(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    base = f"https://{o.country_record['indeed_subdomain']}.indeed.com"
    employer, dossier = r["employer"], r["employer"]["dossier"]
    details = dossier["employerDetails"]
    labels = F.transform(r["attributes"], lambda a: a["label"])
    return {
        "id": F.concat(F.lit("in-"), r["key"]),
        "title": r["title"],
        "company_name": employer["name"],
        "company_url": F.when(
            employer.isNotNull(), F.concat(F.lit(base), employer["relativeCompanyPageUrl"])
        ),
        "company_url_direct": dossier["links"]["corporateWebsite"],
        "location": location(
            r["location"]["city"], r["location"]["admin1Code"], r["location"]["countryCode"], True
        ),
        "job_type": job_types.types_of_labels(labels),
        "compensation": salary.indeed_compensation(r["compensation"]),
        "date_posted": dates.epoch_ms_date(r["datePublished"]),
        "job_url": F.concat(F.lit(f"{base}/viewjob?jk="), r["key"]),
        "job_url_direct": r["recruit"]["viewJobUrl"],
        "emails": extract_emails(d),
        "is_remote": F.coalesce(
            remote.remote_indeed(labels, d, r["location"]["formatted"]["long"]), F.lit(False)
        ),
        "company_addresses": F.get(details["addresses"], F.lit(0)),
        "company_industry": industry_cleanup(details["industry"]),
        "company_num_employees": details["employeesLocalizedLabel"],
        "company_revenue": details["revenueLocalizedLabel"],
        "company_description": details["briefDescription"],
        "company_logo": dossier["images"]["squareLogoUrl"],
    }


INDEED = JsonSource(
    site="indeed",
    schema=f"""struct<data:struct<jobSearch:struct<results:array<struct<job:struct<
        key:string,title:string,datePublished:bigint,description:struct<html:string>,
        location:struct<city:string,admin1Code:string,countryCode:string,formatted:struct<long:string>>,
        compensation:struct<currencyCode:string,baseSalary:{_PAY},
            estimated:struct<currencyCode:string,baseSalary:{_PAY}>>,
        attributes:array<struct<key:string,label:string>>,
        employer:struct<name:string,relativeCompanyPageUrl:string,dossier:struct<
            employerDetails:struct<addresses:array<string>,industry:string,
                employeesLocalizedLabel:string,revenueLocalizedLabel:string,briefDescription:string>,
            images:struct<squareLogoUrl:string>,links:struct<corporateWebsite:string>>>,
        recruit:struct<viewJobUrl:string>>>>>>>""",
    records=lambda p: F.transform(p["data"]["jobSearch"]["results"], lambda x: x["job"]),
    required=lambda r: has_text(r["key"], r["title"]),
    description=lambda r, o: _text(r["description"]["html"], o),
    fields=_indeed_fields,
)


# ---- ZipRecruiter -----------------------------------------------------------------------------

def _zip_fields(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    country = F.when(r["job_country"] == "US", "usa").otherwise("canada")
    kind = job_types.job_type_of(F.lower(F.replace(r["employment_type"], F.lit("_"), F.lit(""))))
    return {
        "id": F.concat(F.lit("zr-"), r["listing_key"]),
        "title": r["name"],
        "company_name": r["hiring_company"]["name"],
        "location": location(r["job_city"], r["job_state"], country),
        "job_type": F.when(kind.isNotNull(), F.array(kind)),
        "compensation": salary.zip_compensation(
            r["compensation_interval"], r["compensation_min"], r["compensation_max"],
            r["compensation_currency"],
        ),
        "date_posted": dates.iso_date(F.rtrim(r["posted_time"], F.lit("Z"))),
        "job_url": urls.posting_url(F.lit("zip_recruiter"), r["listing_key"]),
        "emails": F.when(F.length(d) > 0, extract_emails(d)),
        "listing_type": _or(r["buyer_type"], ""),
    }


ZIP_RECRUITER = JsonSource(
    site="zip_recruiter",
    schema="""struct<jobs:array<struct<name:string,listing_key:string,job_description:string,
        buyer_type:string,hiring_company:struct<name:string>,job_country:string,job_city:string,
        job_state:string,employment_type:string,posted_time:string,compensation_interval:string,
        compensation_min:double,compensation_max:double,compensation_currency:string>>>""",
    records=lambda p: p["jobs"],
    required=lambda r: has_text(r["listing_key"], r["name"], r["posted_time"]),
    description=lambda r, o: _text(strip(_or(r["job_description"], "")), o),
    fields=_zip_fields,
)


# ---- Glassdoor --------------------------------------------------------------------------------

def _glassdoor_fields(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    base = f"https://{o.country_record['glassdoor_host'] or 'www.glassdoor.com'}/"
    header, job = r["header"], r["job"]
    elsewhere = header["locationType"] == "S"
    listing = job["listingId"].cast("string")
    return {
        "id": F.concat(F.lit("gd-"), listing),
        "title": job["jobTitleText"],
        "company_name": header["employerNameFromSearch"],
        "company_id": header["employer"]["id"],
        "company_url": F.concat(
            F.lit(f"{base}Overview/W-EI_IE"), header["employer"]["id"].cast("string"), F.lit(".htm")
        ),
        "date_posted": dates.age_in_days(header["ageInDays"], o.today),
        "job_url": F.concat(F.lit(f"{base}job-listing/j?jl="), listing),
        "location": F.when(
            ~F.coalesce(elsewhere, F.lit(False)), locations.loc_glassdoor(header["locationName"])
        ),
        "compensation": salary.glassdoor_compensation(header),
        "is_remote": F.coalesce(elsewhere, F.lit(False)),
        "emails": extract_emails(d),
        "company_logo": r["overview"]["squareLogoUrl"],
        "listing_type": F.lower(_or(header["adOrderSponsorshipLevel"], "")),
    }


GLASSDOOR = JsonSource(
    site="glassdoor",
    schema="""array<struct<data:struct<jobListings:struct<jobListings:array<struct<jobview:struct<
        header:struct<ageInDays:int,employerNameFromSearch:string,locationName:string,
            locationType:string,payCurrency:string,payPeriod:string,
            payPeriodAdjustedPay:struct<p10:double,p90:double>,adOrderSponsorshipLevel:string,
            employer:struct<id:bigint>>,
        job:struct<listingId:bigint,jobTitleText:string,description:string>,
        overview:struct<squareLogoUrl:string>>>>>>>>""",
    records=lambda p: F.transform(
        F.get(p, F.lit(0))["data"]["jobListings"]["jobListings"], lambda x: x["jobview"]
    ),
    required=lambda r: r["job"]["listingId"].isNotNull() & has_text(r["job"]["jobTitleText"]),
    description=lambda r, o: _text(non_empty(r["job"]["description"]), o),
    fields=_glassdoor_fields,
)


# ---- Naukri -----------------------------------------------------------------------------------

def _placeholder(r: Column, kind: str) -> Column:
    return F.get(F.filter(r["placeholders"], lambda p: p["type"] == kind), F.lit(0))["label"]


def _span_text(html: Column, name: str) -> Column:
    found = first_match(
        html, rf"(?is)<span[^>]*class=[\"'](?:[^\"']*\s)?{name}(?:\s[^\"']*)?[\"'][^>]*>(.*?)</span>"
    )
    return strip(F.regexp_replace(found, "<[^>]*>", ""))


def _naukri_fields(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    raw = r["jobDescription"] if o.full_description else F.lit(None).cast("string")
    place = _placeholder(r, "location")
    where = F.when(place.isNotNull(), locations.loc_naukri(place)).otherwise(
        location(None, None, F.lit("india"))
    )
    title = _or(r["title"], "N/A")
    kind = job_types.job_type_of(F.lower(F.replace(_span_text(raw, "job-type"), F.lit("-"), F.lit(""))))
    box = r["ambitionBoxData"]
    return {
        "id": F.concat(F.lit("nk-"), r["jobId"]),
        "title": title,
        "company_name": _or(r["companyName"], "N/A"),
        "company_url": F.concat(F.lit("https://www.naukri.com/"), non_empty(r["staticUrl"])),
        "location": where,
        "is_remote": remote.remote_keywords3(title, d, locations.display_location(where)),
        "date_posted": dates.naukri_label_date(
            r["footerPlaceholderLabel"], r["createdDate"], o.today
        ),
        "job_url": F.concat(
            F.lit("https://www.naukri.com"),
            F.coalesce(r["jdURL"], F.concat(F.lit("/job/"), r["jobId"])),
        ),
        "compensation": salary.indian_salary(_placeholder(r, "salary")),
        "job_type": F.when(kind.isNotNull(), F.array(kind)),
        "company_industry": _span_text(raw, "industry"),
        "emails": extract_emails(d),
        "company_logo": F.coalesce(non_empty(r["logoPathV3"]), r["logoPath"]),
        "skills": F.when(F.length(r["tagsAndSkills"]) > 0, F.split(r["tagsAndSkills"], ",")),
        "experience_range": r["experienceText"],
        "company_rating": box["AggregateRating"].try_cast("double"),
        "company_reviews_count": box["ReviewsCount"],
        "vacancy_count": r["vacancy"],
        "work_from_home_type": remote.work_from_home_type(place, title, d),
    }


NAUKRI = JsonSource(
    site="naukri",
    schema="""struct<jobDetails:array<struct<jobId:string,title:string,companyName:string,
        staticUrl:string,jdURL:string,jobDescription:string,tagsAndSkills:string,
        experienceText:string,vacancy:bigint,footerPlaceholderLabel:string,createdDate:bigint,
        logoPath:string,logoPathV3:string,placeholders:array<struct<type:string,label:string>>,
        ambitionBoxData:struct<AggregateRating:string,ReviewsCount:bigint>>>>""",
    records=lambda p: p["jobDetails"],
    required=lambda r: has_text(r["jobId"]),
    description=lambda r, o: (
        _text(r["jobDescription"], o) if o.full_description else F.lit(None).cast("string")
    ),
    fields=_naukri_fields,
)


# ---- Seek -------------------------------------------------------------------------------------

def _seek_fields(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    country = o.canonical_country
    label = F.coalesce(F.get(r["locations"], F.lit(0))["label"], F.lit(""))
    base = urls.seek_site(F.lit(country))["base_url"]
    return {
        "id": r["id"],
        "title": r["title"],
        "company_name": r["advertiser"]["description"],
        "location": locations.loc_first_comma(label, country),
        "date_posted": dates.iso_date(r["listingDate"]),
        "compensation": salary.seek_salary(r["salaryLabel"], F.lit(country)),
        "job_type": job_types.job_type_seek(r["workTypes"]),
        "job_url": F.concat(base, F.lit("/job/"), r["id"]),
        "is_remote": remote.remote_keywords3(
            r["title"], label, F.array_join(r["workTypes"], " ")
        ),
    }


def _seek_teaser(r: Column, o: ParseOptions) -> Column:
    bullets = F.when(
        F.size(r["bulletPoints"]) > 0,
        F.array_join(F.transform(r["bulletPoints"], lambda b: F.concat(F.lit("- "), b)), "\n"),
    )
    return join_present(F.array(r["teaser"], bullets))


SEEK = JsonSource(
    site="seek",
    schema="""struct<data:array<struct<id:string,title:string,advertiser:struct<description:string>,
        locations:array<struct<label:string>>,listingDate:string,salaryLabel:string,
        workTypes:array<string>,teaser:string,bulletPoints:array<string>>>>""",
    records=lambda p: p["data"],
    required=lambda r: has_text(r["id"], r["title"]),
    description=_seek_teaser,
    fields=_seek_fields,
)


# ---- Reed: a search page plus one detail record per posting -----------------------------------

def _reed_fields(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    place = _or(r["locationName"], "")
    types = job_types.job_type_reed_search(r["fullTime"], r["partTime"], r["contract"], r["temp"])
    return {
        "id": r["jobId"],
        "title": r["jobTitle"],
        "company_name": r["employerName"],
        "location": locations.loc_first_comma(place, "uk"),
        "date_posted": dates.day_first_date(r["date"]),
        "compensation": salary.reed_salary_search(
            r["minimumSalary"], r["maximumSalary"], r["currency"]
        ),
        "job_type": job_types.or_null(types),
        "job_url": urls.posting_url(F.lit("reed"), r["jobId"]),
        "is_remote": remote.remote_keywords3(r["jobTitle"], place),
    }


REED = JsonSource(
    site="reed",
    schema="""struct<results:array<struct<jobId:string,jobTitle:string,employerName:string,
        locationName:string,date:string,minimumSalary:string,maximumSalary:string,currency:string,
        fullTime:boolean,partTime:boolean,contract:boolean,temp:boolean>>>""",
    records=lambda p: p["results"],
    required=lambda r: has_text(r["jobId"], r["jobTitle"]),
    fields=_reed_fields,
)

_REED_DETAIL = """struct<jobId:string,locationName:string,minimumSalary:string,maximumSalary:string,
    salaryType:string,currency:string,jobType:string,contractType:string,jobUrl:string,
    externalUrl:string,jobDescription:string>"""


def parse_reed_details(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Detail records, one row per posting id (the id of the payload's URL if it has none)."""
    o = options or ParseOptions()
    d = F.col("d")
    rows = raw.withColumn("d", F.from_json("payload", _REED_DETAIL)).select(
        F.col("seq").alias("detail_seq"),
        F.coalesce(d["jobId"], F.element_at(F.split("url", "/"), -1)).alias("id"),
        d["locationName"].alias("place"),
        salary.reed_salary_details(
            d["minimumSalary"], d["maximumSalary"], d["salaryType"], d["currency"]
        ).alias("pay"),
        job_types.or_null(job_types.job_type_reed_details(d["jobType"], d["contractType"])).alias("types"),
        non_empty(d["jobUrl"]).alias("page"),
        non_empty(d["externalUrl"]).alias("outside"),
        _text(non_empty(d["jobDescription"]), o).alias("text"),
    )
    return first_per_key(rows.where(F.col("id").isNotNull()), ["id"], ["detail_seq"])


def parse_reed(
    raw: DataFrame, raw_details: DataFrame | None = None, options: ParseOptions | None = None
) -> DataFrame:
    """Search rows; where a detail record exists it decides pay, types, place, URL and text."""
    o = options or ParseOptions()
    listing = REED.parse(raw, o)
    if raw_details is None:
        return listing
    details = parse_reed_details(raw_details, o).withColumn("found", F.lit(True))
    joined = salted_join(listing, details, ["id"], "left")
    found = F.coalesce(F.col("found"), F.lit(False))
    place = locations.loc_first_comma(non_empty(F.col("place")), "uk")
    where = F.when(F.length("place") > 0, place).otherwise(F.col("location"))
    shown = F.concat_ws(", ", where["city"], where["state"])
    changed = {
        "location": where,
        "compensation": F.when(found, F.col("pay")).otherwise(F.col("compensation")),
        "job_type": F.when(found, F.col("types")).otherwise(F.col("job_type")),
        "job_url": F.coalesce(F.col("page"), F.col("job_url")),
        "job_url_direct": F.col("outside"),
        "description": F.col("text"),
        "is_remote": remote.remote_reed(F.col("title"), shown, F.col("text")),
    }
    return joined.select(
        *[(changed[c] if c in changed else F.col(c)).alias(c) for c in listing.columns]
    )


# ---- Google: positional records ---------------------------------------------------------------

def google_positional_job(records: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Rows of positional records (``seq, pos, record``). Records without title or URL are dropped."""
    o = options or ParseOptions()

    def at(path: str) -> Column:
        return F.try_variant_get(F.col("v"), f"$[{path}]", "string")

    read = (
        with_once(records, v=F.try_parse_json("record"))
        .select(
            "seq", "pos",
            at("0").alias("title"), at("1").alias("company"), at("2").alias("place"),
            F.try_variant_get("v", "$[3][0][0]", "string").alias("url"),
            F.when(F.schema_of_variant(F.variant_get("v", "$[12]", "variant")) == "STRING", at("12"))
            .alias("age"),
            at("19").alias("description"), at("28").alias("native"),
        )
        .where(has_text(F.col("title"), F.col("url")))
    )
    text = _or(F.col("description"), "")
    return read.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("google"),
            id=F.concat(F.lit("go-"), F.coalesce(F.col("native"), urls.url_hash(F.col("url")))),
            title=F.col("title"),
            company_name=F.col("company"),
            location=locations.loc_google(F.col("place")),
            job_url=F.col("url"),
            date_posted=dates.days_ago_number(F.col("age"), o.today),
            is_remote=remote.remote_google(text),
            description=text,
            emails=extract_emails(text),
            job_type=F.when(F.length(text) > 0, job_types.extract_job_type(text)),
        )
    )


def _initial_records(payload: Column) -> Column:
    pattern = r"(?d)520084652\":(\[.*?\]\s*])\s*}\s*]\s*]\s*]\s*]\s*]"
    return F.regexp_extract_all(payload, F.lit(pattern), F.lit(1))


def google_initial_records(raw: DataFrame) -> DataFrame:
    """Record texts embedded in the first result page."""
    return raw.select("seq", F.posexplode(_initial_records(F.col("payload"))).alias("pos", "record"))


def google_page_records(raw: DataFrame) -> DataFrame:
    """Record texts of the following result pages."""
    return raw.select("seq", F.posexplode(google_records(F.col("payload"))).alias("pos", "record"))


def parse_google_initial(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    return google_positional_job(google_initial_records(raw), options)


def parse_google_page(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    return google_positional_job(google_page_records(raw), options)


def _google_named(record: Column) -> Column:
    return let(
        F.try_parse_json(record),
        lambda v: has_text(F.try_variant_get(v, "$[0]", "string"), F.try_variant_get(v, "$[3][0][0]", "string")),
    )


def _google_reason(record: Column) -> Column:
    return F.when(F.try_parse_json(record).isNull(), "unreadable payload").otherwise("missing field")


def google_quarantine(records: DataFrame) -> DataFrame:
    """Record texts that are no JSON, or lack a title or URL."""
    record = F.col("record")
    return records.where(~F.coalesce(_google_named(record), F.lit(False))).select(
        "seq", "pos", _google_reason(record).alias("reason"), record.alias("payload")
    )


def quarantine_google(raw: DataFrame) -> DataFrame:
    """Bad records of first and following result pages, and pages without any record."""
    pages = raw.withColumn("later", google_records(F.col("payload")))
    none = F.array().cast("array<string>")
    records = F.concat(F.coalesce(_initial_records(F.col("payload")), none), F.coalesce(F.col("later"), none))
    found = rejects(F.col("payload"), records, _google_named, text=lambda r: r, reason=_google_reason)
    return pages.select("seq", F.inline(found))


JSON_BOARDS = {s.site: s for s in (INDEED, ZIP_RECRUITER, GLASSDOOR, NAUKRI, SEEK, REED)}
