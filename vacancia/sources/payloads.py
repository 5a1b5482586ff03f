"""JSON payloads: one declaration per source, one shared plan.

The plan is ``from_json`` with an explicit schema (so only the fields read are materialised), explode
to records, one projection. There is no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.markdown import FORMATS
from vacancia.functions.text import let
from vacancia.lookups import ALIAS_TO_COUNTRY, country_records
from vacancia.schema import posting_columns


@dataclass(frozen=True)
class ParseOptions:
    """What the request fixes for all payloads of a run."""

    as_of: str = "current"  # a date, or "current" for the day of the run
    country: str = "usa"
    description_format: str = "markdown"
    full_description: bool = True

    def __post_init__(self) -> None:
        if self.description_format not in FORMATS:
            raise ValueError(f"unknown description format: {self.description_format}")
        if self.country.strip().lower() not in ALIAS_TO_COUNTRY:
            raise ValueError(f"unknown country: {self.country}")

    @property
    def today(self) -> Column:
        return F.current_date() if self.as_of == "current" else F.lit(self.as_of).cast("date")

    @property
    def canonical_country(self) -> str:
        return ALIAS_TO_COUNTRY[self.country.strip().lower()]

    @property
    def country_record(self) -> dict:
        return next(r for r in country_records() if r["country"] == self.canonical_country)


Fields = Callable[[Column, Column, ParseOptions], dict[str, Column]]


@dataclass(frozen=True)
class JsonSource:
    """How to read one kind of JSON payload."""

    site: str
    schema: str  # DDL of the payload
    records: Callable[[Column], Column]  # payload -> array of records
    required: Callable[[Column], Column]  # record -> has what a posting needs
    fields: Fields  # (record, description, options) -> posting fields
    description: Callable[[Column, ParseOptions], Column] = field(
        default=lambda r, o: F.lit(None).cast("string")
    )

    def _records(self) -> Column:
        return self.records(F.from_json("payload", self.schema))

    def parse(self, raw: DataFrame, options: ParseOptions | None = None, keep: Sequence[str] = ()) -> DataFrame:
        """Posting records of all readable payloads, with the columns ``keep`` of the payload's row."""
        options = options or ParseOptions()
        # Exploded as an expression: of a column Spark asks first whether it is empty, which reads the payload twice more.
        rows = (
            raw.select("seq", "url", "company", *keep, F.posexplode(self._records()).alias("pos", "record"))
            .where(F.coalesce(self.required(F.col("record")), F.lit(False)))
            .withColumn("description", self.description(F.col("record"), options))
        )
        given = self.fields(F.col("record"), F.col("description"), options)
        return rows.select(
            *posting_columns(
                **{
                    "seq": F.col("seq"),
                    "pos": F.col("pos"),
                    "site": F.lit(self.site),
                    "description": F.col("description"),
                    "source_url": F.col("url"),
                    **given,
                }
            ),
            *keep,
        )

    def quarantine(self, raw: DataFrame) -> DataFrame:
        """Payloads and records that could not be read, with the reason; one scan."""

        def judged(records: Column) -> Column:
            broken = F.array(reject(F.lit(None), F.lit("unreadable payload"), F.col("payload")))
            return F.when(records.isNull(), broken).otherwise(lacking(records, self.required))

        return raw.select("seq", F.inline(let(self._records(), judged)))


def unread(raw: DataFrame, postings: DataFrame) -> DataFrame:
    """Payloads of which no posting was read, for boards that list no records of their own."""
    read = postings.select(F.col("seq").alias("__read")).distinct()
    return raw.join(read, F.col("seq").eqNullSafe(F.col("__read")), "left_anti").select(
        "seq", F.lit(None).cast("int").alias("pos"), F.lit("no posting read").alias("reason"), "payload"
    )


def reject(pos: Column, reason: Column, payload: Column) -> Column:
    return F.struct(pos.cast("int").alias("pos"), reason.alias("reason"), payload.alias("payload"))


def lacking(
    records: Column,
    required: Callable[[Column], Column],
    text: Callable[[Column], Column] = F.to_json,
    reason: Callable[[Column], Column] = lambda r: F.lit("missing field"),
) -> Column:
    """``array<struct<pos, reason, payload>>`` of the records that lack what a posting needs."""
    placed = F.transform(records, lambda r, i: F.struct(i.alias("pos"), r.alias("record")))
    bad = F.filter(placed, lambda p: ~F.coalesce(required(p["record"]), F.lit(False)))
    return F.transform(bad, lambda p: reject(p["pos"], reason(p["record"]), text(p["record"])))


def rejects(payload: Column, records: Column, required: Callable[[Column], Column], **how) -> Column:
    """``lacking`` for sources whose payloads have no schema: a payload without any record is listed whole.

    All is decided inside the payload's row, so rejects take one scan and no join, and a good record
    hides no unreadable one beside it.
    """
    whole = F.array(reject(F.lit(None), F.lit("no posting read"), payload))
    return let(records, lambda found: F.when(F.size(found) > 0, lacking(found, required, **how)).otherwise(whole))


def has_text(*columns: Column) -> Column:
    result = F.length(columns[0]) > 0
    for c in columns[1:]:
        result = result & (F.length(c) > 0)
    return result
