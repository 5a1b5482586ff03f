"""Duplicates: first arrival wins, every key is local to its own scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.functions.urls import normalized_url
from vacancia.operators.ranking import ARRIVAL
from vacancia.operators.skew import salted_join

# Boards whose postings are the same when their URL is; all others compare ids.
URL_KEYED_SITES = ("indeed", "glassdoor", "zip_recruiter", "google", "irish_jobs")


# Fixed value: beginning of a post by which it is told from others.
PREFIX_CHARS = 80


def posting_key() -> Column:
    return F.when(F.col("site").isin(*URL_KEYED_SITES), F.col("job_url")).otherwise(F.col("id"))


def _first_by(df: DataFrame, key: Column, scope: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key. Rows without a key are all kept: nothing says that they are the same.

    The input is read once. Rows without a key tie for the first rank, and are dealt out by their values
    so that no task gets all of them; each map task passes on only the first rank of a key.
    """
    has_key = F.col("__key").isNotNull()
    dealt = [*order, *[c for c in ("id", "job_url") if c in df.columns]]
    keyed = df.withColumn("__key", key).withColumn("__part", F.when(~has_key, F.xxhash64(*dealt)))
    window = Window.partitionBy(*scope, "__key", "__part").orderBy(*[F.when(has_key, F.col(c)) for c in order])
    ranked = keyed.withColumns({"__rank": F.rank().over(window), "__nth": F.row_number().over(window)})
    first = (F.col("__rank") == 1) & ((F.col("__nth") == 1) | ~has_key)
    return ranked.where(first).drop("__key", "__part", "__rank", "__nth")


def dedup_within_site(df: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """One row per posting of a site; the same posting on two sites stays twice."""
    return _first_by(df, posting_key(), ["site"], order)


def dedup_by_normalized_url(
    df: DataFrame, url: str = "job_url", scope: Sequence[str] = (), order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """One row per URL without trailing slash, query and fragment."""
    return _first_by(df, normalized_url(F.col(url)), list(scope), order)


def dedup_by_prefix(
    df: DataFrame, text: str = "text", length: int = PREFIX_CHARS, order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """One row per beginning of a post's body."""
    return _first_by(df, F.left(F.col(text), F.lit(length)), [], order)


def dedup_ordered_list(values: Column) -> Column:
    """Array without repeats, order kept."""
    return F.array_distinct(values)


def publish(
    df: DataFrame, table: str, path: str, on: Sequence[str] = ("site", "id"), buckets: int = 64,
) -> None:
    """Append postings to a table that is bucketed by its key, at ``path``.

    The number of buckets is fixed by the first call. Files of a bucket hold a key's rows of all runs,
    so that a join by key reads them where they lie.
    """
    df.write.mode("append").bucketBy(buckets, *on).sortBy(*on).option("path", path).saveAsTable(table)


def seen_anti_join(
    new: DataFrame, published: DataFrame, on: Sequence[str] = ("site", "id"), hot: Sequence[int] = ()
) -> DataFrame:
    """Rows whose key was not published before.

    A key that was published often is only looked for, so the published side is neither made distinct
    nor, if it is a table of :func:`publish`, shuffled: only the new rows move.
    """
    return salted_join(new, published.select(*on), on, "left_anti", hot)


def unpublished(new: DataFrame, table: str, on: Sequence[str] = ("site", "id")) -> DataFrame:
    """``seen_anti_join`` with a table of :func:`publish`, whatever its size: no side is sent to all tasks."""
    return seen_anti_join(new, new.sparkSession.table(table).hint("merge"), on)
