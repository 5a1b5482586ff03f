"""Company career pages: split by platform, try the strategies in order, keep the first that works."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancia.functions.urls import detect_platform
from vacancia.operators.assemble import union_sites
from vacancia.operators.enrich import enrich_with_details
from vacancia.sources import career_pages, careers_json
from vacancia.sources.payloads import ParseOptions


def with_platform(raw: DataFrame) -> DataFrame:
    """Adds the career platform of each payload's URL."""
    return raw.withColumn("platform", detect_platform(F.col("url")))


def platform_postings(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Postings of all payloads that come from a known JSON platform."""
    known = with_platform(raw)
    return union_sites(
        [
            source.parse(known.where(F.col("platform") == name), options)
            for name, source in careers_json.CAREER_PLATFORMS.items()
        ]
    )


def page_strategies(
    pages: DataFrame,
    platform_rows: DataFrame | None = None,
    sitemaps: DataFrame | None = None,
    responses: DataFrame | None = None,
    listing_pages: DataFrame | None = None,
) -> DataFrame:
    """All strategies' postings with ``strategy_rank``; cheap and reliable ones rank first.

    ``platform_rows`` are postings of platforms the pages embed, ``listing_pages`` the pages behind
    their "all jobs" links; both carry the career page as ``source_url`` / ``url``. The pages are scanned once.
    """
    own = career_pages.page_offers(pages)
    return _beside(own, listing_pages, platform_rows=platform_rows, sitemaps=sitemaps, responses=responses)


def _given_strategies(platform_rows=None, sitemaps=None, responses=None) -> list:
    return [
        (3, platform_rows),
        (4, None if sitemaps is None else career_pages.sitemap_postings(sitemaps)),
        (5, None if responses is None else career_pages.parse_captured(responses)),
    ]


def _ranked(strategies: list) -> DataFrame:
    return union_sites(
        [df.withColumn("strategy_rank", F.lit(rank)) for rank, df in strategies if df is not None]
    )


def first_strategies(pages: DataFrame, listing_pages: DataFrame | None = None, **inputs) -> DataFrame:
    """``page_strategies`` without what a better strategy of the same page's row makes superfluous.

    The pages are scanned once, whatever the number of strategies that read their HTML.
    """
    return _beside(career_pages.page_cascade(pages), listing_pages, **inputs)


def _beside(own: DataFrame, listing_pages: DataFrame | None = None, **inputs) -> DataFrame:
    """What the pages' own HTML offers, and the strategies that read something else."""
    others = [*_given_strategies(**inputs),
              (7, None if listing_pages is None else career_pages.extract_job_links(listing_pages))]
    if all(df is None for _, df in others):
        return own
    return union_sites([own, _ranked(others)])


def career_postings(pages: DataFrame, detail_pages: DataFrame | None = None, **inputs) -> DataFrame:
    """Postings of the best strategy of every career page.

    Link and sitemap rows have no text; ``detail_pages`` (posting URL as ``url``) supply it.
    """
    # Pages of unknown URL are told apart by their number. Ranking reads the postings once, and each
    # map task passes on only the rows of a page's best strategy there.
    page = [F.col("source_url"), F.when(F.col("source_url").isNull(), F.col("seq"))]
    place = F.rank().over(Window.partitionBy(*page).orderBy("strategy_rank"))
    found = first_strategies(pages, **inputs).withColumn("__place", place)
    best = found.where(F.col("__place") == 1).drop("__place", "strategy_rank")
    if detail_pages is None:
        return best
    # One page per URL: the first that arrived.
    once = career_pages.page_description(detail_pages).groupBy(F.col("url").alias("job_url")).agg(
        F.min_by("description", "seq").alias("description")
    )
    return enrich_with_details(
        best, once, on=["job_url"], override=(), fill=("description",), job_type="keep"
    )
