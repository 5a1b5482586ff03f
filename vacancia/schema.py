"""The posting record and the fixed output layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCATION_DDL = "struct<country:string,country_raw:boolean,city:string,state:string>"
COMPENSATION_DDL = "struct<interval:string,min_amount:double,max_amount:double,currency:string>"

# The nested record every source produces. ``seq``/``pos`` carry arrival order: ``seq`` numbers the
# landed payload, ``pos`` the row inside it.
POSTING_FIELDS: dict[str, str] = {
    "seq": "bigint",
    "pos": "int",
    "site": "string",
    "id": "string",
    "title": "string",
    "company_name": "string",
    "company_id": "bigint",  # the board's own number, where it gives one
    "job_url": "string",
    "job_url_direct": "string",
    "location": LOCATION_DDL,
    "description": "string",
    "company_url": "string",
    "company_url_direct": "string",
    "job_type": "array<string>",
    "compensation": COMPENSATION_DDL,
    "date_posted": "date",
    "emails": "array<string>",
    "is_remote": "boolean",
    "listing_type": "string",
    "job_level": "string",
    "company_industry": "string",
    "company_addresses": "string",
    "company_num_employees": "string",
    "company_revenue": "string",
    "company_description": "string",
    "company_logo": "string",
    "banner_photo_url": "string",
    "job_function": "string",
    "skills": "array<string>",
    "experience_range": "string",
    "company_rating": "double",
    "company_reviews_count": "bigint",
    "vacancy_count": "bigint",
    "work_from_home_type": "string",
    "source_url": "string",  # page the record was read from
}
POSTING_DDL = ", ".join(f"{name} {kind}" for name, kind in POSTING_FIELDS.items())

# The 34 output columns, in order.
OUTPUT_FIELDS: dict[str, str] = {
    "id": "string",
    "site": "string",
    "job_url": "string",
    "job_url_direct": "string",
    "title": "string",
    "company": "string",
    "location": "string",
    "date_posted": "date",
    "job_type": "string",
    "salary_source": "string",
    "interval": "string",
    "min_amount": "double",
    "max_amount": "double",
    "currency": "string",
    "is_remote": "boolean",
    "job_level": "string",
    "job_function": "string",
    "listing_type": "string",
    "emails": "string",
    "description": "string",
    "company_industry": "string",
    "company_url": "string",
    "company_logo": "string",
    "company_url_direct": "string",
    "company_addresses": "string",
    "company_num_employees": "string",
    "company_revenue": "string",
    "company_description": "string",
    "skills": "string",
    "experience_range": "string",
    "company_rating": "double",
    "company_reviews_count": "bigint",
    "vacancy_count": "bigint",
    "work_from_home_type": "string",
}
OUTPUT_COLUMNS = list(OUTPUT_FIELDS)


def posting_columns(**given: Column) -> list[Column]:
    """Every posting field in order; fields not given become typed nulls."""
    unknown = set(given) - set(POSTING_FIELDS)
    if unknown:
        raise ValueError(f"not posting fields: {sorted(unknown)}")
    return [
        given[name].cast(kind).alias(name)
        if name in given
        else F.expr(f"CAST(NULL AS {kind}) AS {name}")
        for name, kind in POSTING_FIELDS.items()
    ]


def as_postings(df: DataFrame) -> DataFrame:
    """Complete a frame that holds some posting fields to the full record."""
    return df.select(*posting_columns(**{c: F.col(c) for c in df.columns if c in POSTING_FIELDS}))


def location(city=None, state=None, country=None, country_raw: bool = False) -> Column:
    """A location struct; ``country_raw`` marks free text as opposed to a known country name."""
    def text(value):
        return F.lit(None).cast("string") if value is None else value

    return F.struct(
        text(country).alias("country"),
        F.lit(country_raw).alias("country_raw"),
        text(city).alias("city"),
        text(state).alias("state"),
    )


def compensation(interval, min_amount, max_amount, currency) -> Column:
    """A compensation struct (present, even when its fields are null)."""
    return F.struct(
        interval.cast("string").alias("interval"),
        min_amount.cast("double").alias("min_amount"),
        max_amount.cast("double").alias("max_amount"),
        currency.cast("string").alias("currency"),
    )
