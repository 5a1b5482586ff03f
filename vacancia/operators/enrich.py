"""Listings completed with detail records and lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.job_types import extract_job_type
from vacancia.functions.locations import country_of
from vacancia.functions.text import extract_emails
from vacancia.functions.urls import board_domains, detect_platform, seek_site
from vacancia.operators.ranking import first_per_key
from vacancia.operators.skew import salted_join


def _present(column: Column, kind: str) -> Column:
    """Null for an empty text or array."""
    if kind == "string":
        return F.when(F.length(column) > 0, column)
    return F.when(F.size(column) > 0, column) if kind.startswith("array") else column


def enrich_with_details(
    listing: DataFrame,
    details: DataFrame,
    on: Sequence[str] = ("id",),
    override: Sequence[str] = ("description",),
    fill: Sequence[str] = (),
    job_type: str = "replace",
    hot: Sequence[int] = (),
) -> DataFrame:
    """Left join of the detail record of each posting.

    ``override`` columns take the detail's value where it has one, ``fill`` columns only where the
    listing has none. Details that carry ``seq`` may hold a key more than once: the first arrival
    counts. A new description renews the e-mails; it renews the job types too
    (``replace``), or only where there are none (``fill``), or never (``keep``).
    """
    on = list(on)
    if "seq" in details.columns:
        details = first_per_key(details, on, ("seq",))
    kinds = dict(details.dtypes)
    joined = salted_join(listing, detail_side(details, on, override, fill), on, "left", hot)
    return completed(joined, listing.columns, kinds, override, fill, job_type)


def detail_side(details: DataFrame, keep: Sequence[str], override: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of detail records, and what they give to a listing, under names of their own."""
    wanted = [c for c in (*override, *fill) if c in details.columns]
    prefixed = details.select(*keep, *[F.col(c).alias(f"__d_{c}") for c in wanted])
    if "description" not in override:
        return prefixed
    # Read once per detail record, not once per listing that shares it.
    fresh = _present(F.col("__d_description"), "string")
    return prefixed.withColumns(
        {"__new": fresh.isNotNull(), "__new_emails": extract_emails(fresh), "__new_types": extract_job_type(fresh)}
    )


def completed(
    joined: DataFrame, columns: Sequence[str], kinds: dict[str, str], override: Sequence[str], fill: Sequence[str], job_type: str
) -> DataFrame:
    """The listing's ``columns`` of rows joined with ``detail_side``; ``kinds`` are the types of the details."""
    renew = "description" in override
    new: dict[str, Column] = {}
    for name in [c for c in (*override, *fill) if c in kinds]:
        given = _present(F.col(f"__d_{name}"), kinds[name])
        mine = F.col(name)
        new[name] = F.coalesce(given, mine) if name in override else F.coalesce(mine, given)
    if renew and "emails" in columns:
        new["emails"] = F.when(F.col("__new"), F.col("__new_emails")).otherwise(F.col("emails"))
    if renew and "job_type" in columns and job_type != "keep":
        due = F.col("__new")
        if job_type == "fill":
            due = due & F.coalesce(F.size("job_type") <= 0, F.lit(True))
        new["job_type"] = F.when(due, F.col("__new_types")).otherwise(F.col("job_type"))
    return joined.select(*[(new[c] if c in new else F.col(c)).alias(c) for c in columns])


def country_lookup(df: DataFrame, column: str) -> DataFrame:
    """Adds the canonical country of an alias, and whether it is known."""
    found = country_of(F.col(column))
    return df.withColumn("country_name", found).withColumn("country_known", found.isNotNull())


def platform_lookup(df: DataFrame, url: str) -> DataFrame:
    return df.withColumn("platform", detect_platform(F.col(url)))


def country_domains(df: DataFrame, country: str) -> DataFrame:
    return df.select("*", board_domains(F.col(country)).alias("domains")).select(
        *df.columns, "domains.*"
    )


def site_config_lookup(df: DataFrame, country: str) -> DataFrame:
    return df.select("*", seek_site(F.col(country)).alias("config")).select(*df.columns, "config.*")
