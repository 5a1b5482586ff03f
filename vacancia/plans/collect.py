"""The main job: read landed payloads of many boards, apply a request, return the output table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.lookups import SYNONYM_TO_JOB_TYPE
from vacancia.operators import filters
from vacancia.operators.enrich import enrich_with_details
from vacancia.operators.assemble import normalize_postings, union_sites
from vacancia.operators.dedup import dedup_within_site
from vacancia.operators.ranking import rows_per_group
from vacancia.registry import DETAIL, Details, added, checked, site_names
from vacancia.sources import boards_html, boards_json, careers_json, social
from vacancia.sources.payloads import ParseOptions, unread


#: Platforms whose payloads have a parser here.
PLATFORMS_WITH_PARSERS = (*careers_json.CAREER_PLATFORMS, "jazzhr")


@dataclass(frozen=True)
class SearchSpec:
    """A request. Filters combine freely; ``None`` leaves one out.

    ``google_search_term`` takes the place of ``search_term`` on that board, ``linkedin_company_ids``
    narrows that board alone, and ``linkedin_fetch_description`` says whether its detail pages count.
    """

    site_name: str | Sequence[str] | None = None
    search_term: str | None = None
    google_search_term: str | None = None
    linkedin_company_ids: Sequence[int] | None = None
    linkedin_fetch_description: bool = True
    location: str | None = None
    is_remote: bool = False
    job_type: str | None = None
    easy_apply: bool | None = None
    company_name: str | None = None
    results_wanted: int | None = 15
    offset: int = 0
    hours_old: int | None = None
    country: str = "usa"
    enforce_annual_salary: bool = False
    description_format: str = "markdown"
    as_of: str = "current"

    def __post_init__(self) -> None:
        if self.job_type is not None and self.job_type not in SYNONYM_TO_JOB_TYPE:
            raise ValueError(f"unknown job type: {self.job_type}")
        site_names(self.site_name)

    def options(self) -> ParseOptions:
        return ParseOptions(
            as_of=self.as_of, country=self.country, description_format=self.description_format
        )


def parsers(options: ParseOptions) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Parser of every board and career platform, by the ``site`` of its payloads."""
    table: dict[str, Callable[[DataFrame], DataFrame]] = {}
    for name, source in {**boards_json.JSON_BOARDS, **careers_json.CAREER_PLATFORMS}.items():
        table[name] = lambda raw, source=source: source.parse(raw, options)
    for name, parse in boards_html.HTML_BOARDS.items():
        table[name] = lambda raw, parse=parse: parse(raw, options)
    table["google"] = lambda raw: union_sites(  # the first page differs from those that follow
        [boards_json.parse_google_initial(raw, options), boards_json.parse_google_page(raw, options)]
    )
    table["irish_jobs"] = lambda raw: union_sites(  # linked data where a page has no cards
        [boards_html.parse_irishjobs_cards(raw, options), boards_html.parse_irishjobs_jsonld(raw, options)]
    )
    table["twitter"] = lambda raw: social.parse_tweets(social.read_tweets(raw))
    table["linkedin_posts"] = lambda raw: social.parse_linkedin_posts(
        social.split_social_post_lines(raw), options
    )
    for name, board in added().items():
        table[name] = lambda raw, board=board: checked(board, board.parse(raw, options))
    return table


DETAILS = {
    "linkedin": Details(
        boards_html.parse_linkedin_detail,
        ("description", "job_level", "job_function", "job_type", "company_industry", "company_logo", "job_url_direct"),
    ),
    "zip_recruiter": Details(boards_html.parse_ziprecruiter_detail, ("description", "job_url_direct")),
    "seek": Details(boards_html.parse_seek_detail),
    "bdjobs": Details(boards_html.parse_bdjobs_detail, ("description", "job_type", "company_industry")),
    "smartrecruiters": Details(
        lambda raw, o: careers_json.smartrecruiters_details(raw), ("description", "job_url"), job_type="fill"
    ),
    "workable": Details(lambda raw, o: careers_json.workable_details(raw), job_type="fill"),
    "bamboohr": Details(lambda raw, o: careers_json.bamboohr_details(raw), fill=("date_posted",), job_type="fill"),
    "jazzhr": Details(boards_html.parse_jazzhr_detail, on=("job_url",), job_type="fill"),
}


def with_details(raw: DataFrame, site: str, listing: DataFrame, options: ParseOptions) -> DataFrame:
    """A site's listings with what its landed detail payloads (site name and ``_detail``) say."""
    landed = raw.where(F.col("site") == site + DETAIL)
    if site == "reed":
        return boards_json.parse_reed(raw.where(F.col("site") == site), landed, options)
    own = added().get(site)
    d = own.details if own else DETAILS.get(site)
    if d is None:
        return listing
    return enrich_with_details(listing, d.parse(landed, options), d.on, d.override, d.fill, d.job_type)


def parse_landed(
    raw: DataFrame, sites: Sequence[str], options: ParseOptions | None = None
) -> DataFrame:
    """Posting records of the named sites. Each branch reads only its own ``site`` partition."""
    table = parsers(options or ParseOptions())
    return union_sites([table[s](raw.where(F.col("site") == s)) for s in site_names(sites)])


def complete_landed(raw: DataFrame, sites: Sequence[str], options: ParseOptions, without: Sequence[str] = ()) -> DataFrame:
    """``parse_landed`` with the details that have landed, but for the sites named in ``without``."""
    table = parsers(options)
    listed = {s: table[s](raw.where(F.col("site") == s)) for s in site_names(sites)}
    return union_sites(
        [rows if s in without else with_details(raw, s, rows, options) for s, rows in listed.items()]
    )


def quarantines() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """What lists the unreadable payloads and records of every site that tells them apart."""
    table = {n: s.quarantine for n, s in {**boards_json.JSON_BOARDS, **careers_json.CAREER_PLATFORMS}.items()}
    table |= boards_html.HTML_QUARANTINE
    table |= {
        "google": boards_json.quarantine_google,
        "twitter": social.quarantine_tweets,
        "linkedin_posts": social.quarantine_linkedin_posts,
    }
    return table | {n: b.quarantine for n, b in added().items() if b.quarantine}


def quarantine_landed(
    raw: DataFrame, sites: Sequence[str] | None = None, options: ParseOptions | None = None
) -> DataFrame:
    """``site, seq, pos, reason, payload`` of what could not be read, for every site asked for.

    Unreadable payloads are listed whole, and each record, card or post that lacks what a posting needs by
    its place, whatever else its payload holds. Added boards without a quarantine of their own have their
    payloads listed when no posting was read of them.
    """
    by_record = quarantines()
    found = []
    for site in site_names(sites):
        part = raw.where(F.col("site") == site)
        if site in by_record:
            bad = by_record[site](part)
        else:
            bad = unread(part, parsers(options or ParseOptions())[site](part))
        found.append(bad.select(F.lit(site).alias("site"), "seq", "pos", "reason", "payload"))
    return reduce(DataFrame.unionByName, found)


def select_postings(postings: DataFrame, spec: SearchSpec) -> DataFrame:
    """Request filters, duplicates, offset and limit; narrow predicates come before the shuffle."""
    df = postings.where(F.col("site").isin(*site_names(spec.site_name)))
    if spec.is_remote:
        df = filters.filter_remote(df)
    if spec.job_type:
        df = filters.filter_job_type(df, spec.job_type)
    if spec.easy_apply:
        df = filters.filter_easy_apply(df)
    if spec.hours_old:
        df = filters.filter_hours_old(df, spec.hours_old, spec.options().today)
    if spec.location:
        df = filters.filter_location(df, spec.location)
    if spec.google_search_term:
        on_google = F.col("site") == "google"
        fields = F.col("title"), F.col("description")
        others = filters.search_predicate(spec.search_term or "", *fields)
        df = df.where(F.when(on_google, filters.search_predicate(spec.google_search_term, *fields)).otherwise(others))
    elif spec.search_term:
        df = filters.filter_search_terms(df, spec.search_term)
    if spec.linkedin_company_ids:
        df = df.where((F.col("site") != "linkedin") | F.col("company_id").isin(*spec.linkedin_company_ids))
    if spec.company_name:
        df = filters.filter_company(df, spec.company_name)
    df = dedup_within_site(df)
    if spec.results_wanted is not None:
        df = rows_per_group(df, spec.results_wanted, spec.offset)
    return df


def collect_postings(postings: DataFrame, spec: SearchSpec | None = None) -> DataFrame:
    """The output table of a request over posting records of any number of sites."""
    spec = spec or SearchSpec()
    return normalize_postings(
        select_postings(postings, spec), spec.country, spec.enforce_annual_salary
    )


def collect_landed(raw: DataFrame, spec: SearchSpec | None = None) -> DataFrame:
    """Landed payloads straight to the output table."""
    spec = spec or SearchSpec()
    without = () if spec.linkedin_fetch_description else ("linkedin",)
    return collect_postings(
        complete_landed(raw, site_names(spec.site_name), spec.options(), without), spec
    )
