"""Request filters as predicates over the posting table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.text import strip
from vacancia.lookups import HASHTAG_GROUPS, JOB_TYPE_SYNONYMS, SYNONYM_TO_JOB_TYPE
from vacancia.registry import site_names

# Shortest texts taken for a posting.
MIN_TWEET, MIN_POST, MIN_BODY, MIN_JSON, MIN_PAGE_DESCRIPTION = 50, 30, 20, 200, 51


def window_days(hours: int) -> dict[str, int]:
    """Days each board looks back for a request in hours."""
    whole = hours // 24
    google = next((d for limit, d in ((24, 1), (72, 3), (168, 7)) if hours <= limit), 30)
    exact = -(-hours // 24)
    return {
        "indeed": exact,
        "linkedin": exact,
        "zip_recruiter": max(whole, 1),
        "glassdoor": max(whole, 1),
        "naukri": whole,
        "google": google,
    }


def filter_hours_old(df: DataFrame, hours: int, as_of: Column) -> DataFrame:
    """Postings inside the board's window; boards without the option pass everything."""
    days = window_days(hours)
    recent = reduce(
        lambda rules, entry: rules.when(
            F.col("site") == entry[0], F.col("date_posted") >= F.date_sub(as_of, entry[1])
        ),
        days.items(),
        F,
    )
    return df.where(recent.otherwise(F.lit(True)))


def filter_remote(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_remote"))


def filter_job_type(df: DataFrame, job_type: str, column: str = "job_type") -> DataFrame:
    """Postings that have the requested type; unknown requests are an error."""
    wanted = SYNONYM_TO_JOB_TYPE.get(job_type)
    if wanted is None:
        raise ValueError(f"unknown job type {job_type!r}; known: {sorted(JOB_TYPE_SYNONYMS)}")
    return df.where(F.array_contains(F.col(column), wanted))


def filter_easy_apply(df: DataFrame) -> DataFrame:
    """Postings applied for on the board itself: they name no outside link."""
    return df.where(F.col("job_url_direct").isNull())


def filter_company(
    df: DataFrame, name: str, order: Sequence[str] = ("seq",), column: str = "company_name"
) -> DataFrame:
    """Postings of the first company, in arrival order, whose name contains the request."""
    hit = F.contains(F.lower(F.col(column)), F.lit(name.lower()))
    first = df.where(hit).agg(
        F.min_by(F.col(column), F.struct(*[F.col(c) for c in order])).alias(column)
    )
    return df.join(F.broadcast(first), column, "left_semi")  # one row


def filter_company_ids(df: DataFrame, ids: Sequence[int], column: str = "company_id") -> DataFrame:
    return df.where(F.col(column).isin(*ids))


def filter_location(df: DataFrame, place: str) -> DataFrame:
    """Every comma part of the request appears in the posting's location."""
    shown = F.lower(F.concat_ws(", ", F.col("location.city"), F.col("location.state"),
                                F.col("location.country")))
    parts = [p.strip().lower() for p in place.split(",") if p.strip()]
    return df.where(reduce(lambda a, b: a & b, [F.contains(shown, F.lit(p)) for p in parts]))


def search_predicate(request: str, *fields: Column) -> Column:
    """``"exact phrase"``, ``-without``, ``(one OR other)`` and plain words, over the fields."""
    text = F.lower(F.concat_ws(" ", *fields))

    def has(term: str) -> Column:
        return F.contains(text, F.lit(term.lower()))

    rules = []
    for minus, phrase, group, word in re.findall(r'(-?)(?:"([^"]+)"|\(([^)]*)\)|([^\s"()]+))', request):
        if group:
            rule = reduce(
                lambda a, b: a | b, [has(t.strip().strip('"')) for t in group.split(" OR ")]
            )
        else:
            rule = has(phrase or word)
        rules.append(~rule if minus else rule)
    return reduce(lambda a, b: a & b, rules) if rules else F.lit(True)


def filter_search_terms(
    df: DataFrame, request: str, fields: Sequence[str] = ("title", "description")
) -> DataFrame:
    return df.where(search_predicate(request, *[F.col(f) for f in fields]))


def filter_hashtags(df: DataFrame, group: str = "general", column: str = "text") -> DataFrame:
    """Posts that carry one of a group's hashtags and are no reposts."""
    text = F.col(column)
    tags = search_predicate(f"({' OR '.join(HASHTAG_GROUPS[group])})", text)
    return df.where(tags & ~F.startswith(text, F.lit("RT @")))


def filter_min_length(df: DataFrame, column: str, at_least: int) -> DataFrame:
    return df.where(F.length(F.col(column)) >= at_least)


def filter_required_fields(
    df: DataFrame, fields: Sequence[str] = ("id", "title", "job_url")
) -> DataFrame:
    """Rows that have all required texts."""
    return df.where(reduce(lambda a, b: a & b, [F.length(strip(F.col(f))) > 0 for f in fields]))


def site_selection(df: DataFrame, sites: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of the named sites (all boards by default). Prunes a table partitioned by site."""
    return df.where(F.col("site").isin(*site_names(sites)))
