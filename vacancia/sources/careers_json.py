"""Career platforms with a JSON interface. The company handle comes from the payload's URL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import dates, job_types, locations, salary, urls
from vacancia.functions.markdown import html_list_to_markdown, markdown
from vacancia.functions.text import extract_emails, join_present, non_empty
from vacancia.schema import location
from vacancia.sources.payloads import JsonSource, ParseOptions, has_text


def _slug(platform: str) -> Column:
    return urls.career_slug(F.col("url"), F.lit(platform))


def _id(platform: str, native: Column) -> Column:
    return F.concat_ws(":", F.lit(platform), _slug(platform), native)


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _says_remote(*texts: Column) -> Column:
    return F.contains(F.lower(F.concat_ws(" ", *texts)), F.lit("remote"))


def _typed(text: Column) -> Column:
    """Job types of a text that may be missing; null when there is none."""
    return F.when(F.length(text) > 0, job_types.extract_job_type(text))


# ---- Greenhouse -------------------------------------------------------------------------------

def _greenhouse(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    place = _text(r["location"]["name"])
    fallback = F.concat(
        F.lit("https://boards.greenhouse.io/"), _slug("greenhouse"), F.lit("/jobs/"), r["id"]
    )
    return {
        "id": _id("greenhouse", r["id"]),
        "title": r["title"],
        "company_name": F.col("company"),
        "job_url": F.coalesce(non_empty(r["absolute_url"]), fallback),
        "location": locations.loc_greenhouse(place),
        "is_remote": _says_remote(place),
        "date_posted": dates.iso_date(F.coalesce(non_empty(r["updated_at"]), r["created_at"])),
        "job_type": _typed(d),
        "emails": F.when(F.length(d) > 0, extract_emails(d)),
    }


GREENHOUSE = JsonSource(
    site="greenhouse",
    schema="""struct<jobs:array<struct<id:string,title:string,absolute_url:string,
        location:struct<name:string>,content:string,updated_at:string,created_at:string>>>""",
    records=lambda p: p["jobs"],
    required=lambda r: has_text(r["title"]),
    description=lambda r, o: markdown(_text(r["content"])),
    fields=_greenhouse,
)


# ---- Lever ------------------------------------------------------------------------------------

def _lever(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    place = _text(r["categories"]["location"])
    commitment = _text(r["categories"]["commitment"])
    return {
        "id": _id("lever", r["id"]),
        "title": r["text"],
        "company_name": F.col("company"),
        "job_url": F.coalesce(non_empty(r["hostedUrl"]), non_empty(r["applyUrl"]), F.lit("")),
        "location": locations.loc_lever(place),
        "is_remote": _says_remote(place, commitment),
        "date_posted": F.when(r["createdAt"] != 0, dates.epoch_ms_date(r["createdAt"])),
        "job_type": _typed(F.coalesce(non_empty(commitment), d)),
        "emails": extract_emails(d),
    }


def _lever_description(r: Column, o: ParseOptions) -> Column:
    """Opening, then heading and content of every section, then the closing text."""
    contents = F.concat(
        F.transform(r["lists"], lambda s: s["content"]), F.array(r["additional"])
    )
    converted = html_list_to_markdown(contents)
    headings = F.concat(
        F.transform(
            r["lists"],
            lambda s: F.when(F.length(s["text"]) > 0, F.concat(F.lit("## "), s["text"])),
        ),
        F.array(F.lit(None).cast("string")),
    )
    body = F.flatten(F.zip_with(headings, converted, lambda h, c: F.array(h, c)))
    opening = F.coalesce(non_empty(r["descriptionPlain"]), r["description"])
    return join_present(F.concat(F.array(opening), body))


LEVER = JsonSource(
    site="lever",
    schema="""array<struct<id:string,text:string,hostedUrl:string,applyUrl:string,
        categories:struct<location:string,commitment:string>,
        lists:array<struct<text:string,content:string>>,additional:string,description:string,
        descriptionPlain:string,createdAt:bigint>>""",
    records=lambda p: F.transform(
        p, lambda j: j.withField("lists", F.coalesce(j["lists"], F.array()))
    ),
    required=lambda r: has_text(r["text"]),
    description=_lever_description,
    fields=_lever,
)


# ---- Ashby ------------------------------------------------------------------------------------

def _ashby(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    place = _text(
        F.when(F.startswith(r["location"], F.lit("{")), F.get_json_object(r["location"], "$.name"))
        .otherwise(r["location"])
    )
    by_text = _typed(d)
    fallback = F.concat(
        F.lit("https://jobs.ashbyhq.com/"), _slug("ashby"), F.lit("/"), _text(r["id"])
    )
    return {
        "id": _id("ashby", _text(r["id"])),
        "title": r["title"],
        "company_name": F.col("company"),
        "job_url": F.coalesce(non_empty(r["jobUrl"]), fallback),
        "location": locations.loc_ashby_bamboo(place),
        "is_remote": F.coalesce(r["isRemote"], F.lit(False)) | _says_remote(place),
        "date_posted": dates.iso_date(F.coalesce(non_empty(r["publishedAt"]), r["updatedAt"])),
        "compensation": salary.ashby_compensation(r["compensation"]),
        "job_type": F.coalesce(job_types.or_null(by_text), _typed(r["employmentType"])),
        "emails": F.when(F.length(d) > 0, extract_emails(d)),
    }


ASHBY = JsonSource(
    site="ashby",
    schema="""struct<jobs:array<struct<id:string,title:string,jobUrl:string,location:string,
        descriptionHtml:string,description:string,publishedAt:string,updatedAt:string,
        isRemote:boolean,employmentType:string,compensation:struct<compensationTiers:array<struct<
            min:double,max:double,currencyCode:string,interval:string>>>>>>""",
    records=lambda p: p["jobs"],
    required=lambda r: has_text(r["title"]),
    description=lambda r, o: markdown(F.coalesce(non_empty(r["descriptionHtml"]), _text(r["description"]))),
    fields=_ashby,
)


# ---- SmartRecruiters --------------------------------------------------------------------------

def _smartrecruiters(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    native = F.coalesce(non_empty(r["id"]), _text(r["uuid"]))
    place = r["location"]
    return {
        "id": _id("smartrecruiters", native),
        "title": r["name"],
        "company_name": F.col("company"),
        "job_url": F.concat(
            F.lit("https://jobs.smartrecruiters.com/"), _slug("smartrecruiters"), F.lit("/"), native
        ),
        "location": location(
            non_empty(place["city"]), non_empty(place["region"]), non_empty(place["country"]), True
        ),
        "is_remote": F.coalesce(place["remote"], F.lit(False)),
        "date_posted": dates.iso_date(F.coalesce(non_empty(r["releasedDate"]), r["updatedOn"])),
        "compensation": salary.smartrecruiters_compensation(r["compensation"]),
        "job_type": _typed(r["typeOfEmployment"]["label"]),
    }


SMARTRECRUITERS = JsonSource(
    site="smartrecruiters",
    schema="""struct<content:array<struct<id:string,uuid:string,name:string,ref:string,
        location:struct<city:string,region:string,country:string,remote:boolean>,
        compensation:struct<min:string,max:string,currency:string>,releasedDate:string,
        updatedOn:string,typeOfEmployment:struct<label:string>>>>""",
    records=lambda p: p["content"],
    required=lambda r: has_text(r["name"]),
    fields=_smartrecruiters,
)


# ---- Workable ---------------------------------------------------------------------------------

def _workable(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    place, published = r["location"], r["published"]
    number = r"^[0-9]+(?:\.[0-9]+)?$"
    return {
        "id": _id("workable", r["shortcode"]),
        "title": r["title"],
        "company_name": F.col("company"),
        "job_url": F.concat(
            F.lit("https://apply.workable.com/"), _slug("workable"), F.lit("/j/"), r["shortcode"],
            F.lit("/"),
        ),
        "location": location(
            place["city"], place["region"],
            F.coalesce(non_empty(place["countryCode"]), place["country"]), True,
        ),
        "is_remote": F.coalesce(r["remote"], F.lit(False))
        | F.coalesce(_says_remote(r["workplace"]), F.lit(False)),
        "date_posted": F.when(
            published.rlike(number), dates.epoch_ms_date(published.try_cast("double"))
        ).otherwise(dates.iso_date(published)),
    }


WORKABLE = JsonSource(
    site="workable",
    schema="""struct<results:array<struct<shortcode:string,title:string,
        location:struct<city:string,region:string,country:string,countryCode:string>,
        remote:boolean,workplace:string,published:string>>>""",
    records=lambda p: p["results"],
    required=lambda r: has_text(r["shortcode"], r["title"]),
    fields=_workable,
)


# ---- BambooHR ---------------------------------------------------------------------------------

def _bamboohr(r: Column, d: Column, o: ParseOptions) -> dict[str, Column]:
    place = r["location"]

    def part(name: str) -> Column:
        return non_empty(F.get_json_object(place, f"$.{name}"))

    return {
        "id": _id("bamboohr", r["id"]),
        "title": F.coalesce(non_empty(r["jobOpeningName"]), r["title"]),
        "company_name": F.col("company"),
        "job_url": F.concat(
            F.lit("https://"), _slug("bamboohr"), F.lit(".bamboohr.com/careers/"), r["id"]
        ),
        "location": F.when(
            F.startswith(place, F.lit("{")), location(part("city"), part("state"), part("country"), True)
        ).otherwise(locations.loc_ashby_bamboo(place)),
        "is_remote": F.coalesce(r["isRemote"], F.lit(False)),
    }


BAMBOOHR = JsonSource(
    site="bamboohr",
    schema="""struct<result:array<struct<id:string,jobOpeningName:string,title:string,
        location:string,isRemote:boolean>>>""",
    records=lambda p: p["result"],
    required=lambda r: has_text(r["id"], F.concat_ws("", r["jobOpeningName"], r["title"])),
    fields=_bamboohr,
)

CAREER_PLATFORMS = {
    s.site: s for s in (GREENHOUSE, LEVER, ASHBY, SMARTRECRUITERS, WORKABLE, BAMBOOHR)
}


# ---- detail records, to be joined to the listings ---------------------------------------------

def _sections(*pieces: Column) -> Column:
    """Converted sections joined by a blank line."""
    return join_present(html_list_to_markdown(F.array(*pieces)))


def smartrecruiters_details(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``seq, id, job_url, description`` of detail payloads (the id ends the payload's URL)."""
    d = F.from_json(
        "payload",
        """struct<postingUrl:string,jobAd:struct<sections:struct<jobDescription:struct<text:string>,
        qualifications:struct<text:string>,additionalInformation:struct<text:string>>>>""",
    )
    s = F.col("d.jobAd.sections")
    company = F.get(F.split(F.col("url"), "/companies/"), F.lit(1))
    return raw.withColumn("d", d).select(
        "seq",
        *keep,
        F.concat_ws(
            ":", F.lit("smartrecruiters"), F.substring_index(company, "/", 1),
            F.element_at(F.split("url", "/"), -1),
        ).alias("id"),
        F.col("d.postingUrl").alias("job_url"),
        _sections(
            s["jobDescription"]["text"], s["qualifications"]["text"], s["additionalInformation"]["text"]
        ).alias("description"),
    )


def workable_details(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``seq, id, description``; the URL holds ``/accounts/<slug>/jobs/<code>``."""
    d = F.from_json("payload", "struct<description:string,requirements:string,benefits:string>")
    return raw.withColumn("d", d).select(
        "seq",
        *keep,
        F.concat_ws(
            ":", F.lit("workable"), F.regexp_extract("url", "/accounts/([^/]+)", 1),
            F.element_at(F.split("url", "/"), -1),
        ).alias("id"),
        _sections(F.col("d.description"), F.col("d.requirements"), F.col("d.benefits"))
        .alias("description"),
    )


def bamboohr_details(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``seq, id, description, date_posted, country``; the URL ends in ``/careers/<id>/detail``."""
    d = F.from_json(
        "payload",
        """struct<result:struct<jobOpening:struct<description:string,datePosted:string,
        location:struct<addressCountry:string,country:string>>>>""",
    )
    j = F.col("d.result.jobOpening")
    return raw.withColumn("d", d).select(
        "seq",
        *keep,
        F.concat_ws(
            ":", F.lit("bamboohr"), _slug("bamboohr"), F.regexp_extract("url", "/careers/([^/]+)", 1)
        ).alias("id"),
        markdown(non_empty(j["description"])).alias("description"),
        dates.iso_date(j["datePosted"]).alias("date_posted"),
        F.coalesce(non_empty(j["location"]["addressCountry"]), j["location"]["country"]).alias("country"),
    )

