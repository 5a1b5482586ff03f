"""Counts, and choices made per page. All are pre-aggregated before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.operators.skew import count_keys, keep_groups


def count_by_site(df: DataFrame) -> DataFrame:
    return df.groupBy("site").agg(F.count(F.lit(1)).alias("postings"))


def enrichment_coverage(df: DataFrame, column: str = "description") -> DataFrame:
    """How many postings of a site have a value."""
    return df.groupBy("site").agg(
        F.count(F.when(F.length(F.col(column)) > 0, 1)).alias("enriched"),
        F.count(F.lit(1)).alias("total"),
    )


def distinct_postings_count(df: DataFrame, key: str = "id", approximate: bool = False) -> DataFrame:
    """Distinct keys per site, exact or as a sketch."""
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.groupBy("site").agg(count.alias("distinct_postings"))


def postings_sketch(df: DataFrame, key: str = "id", bits: int = 12) -> DataFrame:
    """(site, sketch): a mergeable count of a run's distinct keys, to be kept for each run.

    2**bits registers a site, whatever its number of postings; the estimate is within about
    1.04 / sqrt(2**bits) of the exact count two times in three.
    """
    return df.groupBy("site").agg(F.hll_sketch_agg(key, F.lit(bits)).alias("sketch"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per site of those of any number of runs; a posting of several runs counts once."""
    return sketches.groupBy("site").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_from_sketches(sketches: DataFrame) -> DataFrame:
    """(site, distinct_postings) over all runs whose sketches are given."""
    return merged_sketches(sketches).select("site", F.hll_sketch_estimate("sketch").alias("distinct_postings"))


def min_support(df: DataFrame, keys: Sequence[str], at_least: int = 2) -> DataFrame:
    """Rows of the groups that have enough of them."""
    counts = count_keys(df, keys)
    return keep_groups(df, counts.where(F.col("n") >= at_least), keys)


def strategy_cascade(
    df: DataFrame, keys: Sequence[str], rank: str = "strategy_rank"
) -> DataFrame:
    """Rows of the best strategy that found anything, per group."""
    keys = list(keys)
    best = df.groupBy(*keys).agg(F.min(rank).alias(rank))
    return keep_groups(df, best, [*keys, rank])


def largest_array_wins(
    df: DataFrame, keys: Sequence[str], candidate: str = "candidate"
) -> DataFrame:
    """Rows of the candidate with most rows, per group; the earliest one wins a tie."""
    keys = list(keys)
    counts = count_keys(df, [*keys, candidate])
    best = counts.groupBy(*keys).agg(
        F.max_by(candidate, F.struct(F.col("n"), -F.col(candidate))).alias(candidate)
    )
    return keep_groups(df, best, [*keys, candidate])
