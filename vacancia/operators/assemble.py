"""From nested posting records to the fixed output table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.locations import display_location
from vacancia.functions.salary import annualize, extract_salary
from vacancia.operators.ranking import final_sort
from vacancia.schema import OUTPUT_FIELDS


def union_sites(frames: Iterable[DataFrame]) -> DataFrame:
    """All sites by column name; fields a site lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def joined_list(values: Column) -> Column:
    """``a, b, c``; null for a missing or empty array."""
    return F.when(F.size(values) > 0, F.array_join(values, ", "))


def resolved_salary(comp: Column, description: Column, usa: bool, annual: bool) -> Column:
    """``struct<comp, source>``.

    A present struct decides alone, even when all its fields are null. Only where there is none, and
    only for a request about the USA, the description is searched.
    """
    direct = F.struct((annualize(comp) if annual else comp).alias("comp"), F.lit("direct_data").alias("source"))
    if not usa:
        return F.when(comp.isNotNull(), direct)
    found = F.struct(
        extract_salary(description, annual=annual).alias("comp"), F.lit("description").alias("source")
    )
    return F.when(comp.isNotNull(), direct).otherwise(found)


def salary_source(source: Column, min_amount: Column) -> Column:
    """The source, where there is a lower bound other than zero."""
    return F.when(F.coalesce(min_amount, F.lit(0.0)) != 0, source)


def align_schema(df: DataFrame) -> DataFrame:
    """The 34 output columns in order: missing ones as null, others dropped."""
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in OUTPUT_FIELDS.items()
        ]
    )


def flatten_postings(df: DataFrame, country: str = "usa", annual: bool = False) -> DataFrame:
    """One flat row per posting. No shuffle: a single projection over the records."""
    usa = country.strip().lower() in ("usa", "us", "united states")
    pay = df.withColumn(
        "__pay", resolved_salary(F.col("compensation"), F.col("description"), usa, annual)
    )
    money = F.col("__pay.comp")
    flat = {
        "company": F.col("company_name"),
        "location": display_location(F.col("location")),
        "job_type": joined_list(F.col("job_type")),
        "emails": joined_list(F.col("emails")),
        "skills": joined_list(F.col("skills")),
        "interval": money["interval"],
        "min_amount": money["min_amount"],
        "max_amount": money["max_amount"],
        "currency": money["currency"],
        "salary_source": salary_source(F.col("__pay.source"), money["min_amount"]),
    }
    return pay.select(
        *[
            (flat[c] if c in flat else F.col(c)).cast(kind).alias(c)
            for c, kind in OUTPUT_FIELDS.items()
        ]
    )


def normalize_postings(
    df: DataFrame, country: str = "usa", annual: bool = False, sort: bool = True
) -> DataFrame:
    """The output table: flat, aligned and sorted.

    Sorting comes first: the sampling of a global sort runs its input, and the text rules should run
    only once. The projection keeps the order.
    """
    return flatten_postings(final_sort(df) if sort else df, country, annual)
