"""Dates. "Now" is always an explicit ``as_of`` column, and nothing depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import first_match, let, rx, strip

# Units of relative times, English and Russian.
HOUR_OR_MINUTE_UNITS = ("h", "hr", "hrs", "hour", "hours", "ч", "час", "min", "мин", "минут")
DAY_UNITS = ("d", "day", "days", "д", "дн", "дня", "дней", "день")
WEEK_UNITS = ("w", "wk", "week", "weeks", "н", "нед")
MONTH_UNITS = ("m", "mo", "month", "months", "мес")

# Accepted absolute formats.
DEADLINE_FORMATS = ("d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "MMMM d, yyyy", "d/M/yyyy")
BOARD_FORMATS = ("d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d/M/yyyy")


def epoch_ms_date(ms: Column) -> Column:
    """Milliseconds since 1970 to a UTC date."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86_400_000).cast("int"))


def iso_date(text: Column) -> Column:
    """Calendar date of an ISO 8601 text in its own offset; null when malformed."""
    clock = r"(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
    zone = r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)"
    dashed = rf"^\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]{clock}{zone}?)?$"
    return F.when(text.rlike(dashed), F.left(text, F.lit(10)).try_cast("date")).when(
        text.rlike(r"^\d{8}$"),
        F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date"),
    )


def strict_date(text: Column) -> Column:
    """``YYYY-MM-DD`` only."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def _in_formats(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def days_before(as_of: Column, days: Column) -> Column:
    """``as_of`` minus a textual or numeric count of days; null when the count is unusable."""
    return F.date_sub(as_of, days.try_cast("int"))


def days_ago_number(text: Column, as_of: Column) -> Column:
    """The first integer in the text counts days, whatever its unit."""
    return days_before(as_of, first_match(text, r"(\d+)"))


def age_in_days(age: Column, as_of: Column) -> Column:
    return days_before(as_of, age)


def naukri_label_date(label: Column, created_ms: Column, as_of: Column) -> Column:
    """Footer label first; the creation time only where the label is absent or says nothing."""

    def by_label(text: Column) -> Column:
        return (
            F.when(text.rlike("today|just now|few hours"), as_of)
            .when(
                F.contains(text, F.lit("ago")),
                days_before(as_of, first_match(text, rx(r"(\d+)\s*day"))),
            )
            .otherwise(F.when(created_ms != 0, epoch_ms_date(created_ms)))
        )

    return F.when(F.length(label) > 0, let(F.lower(label), by_label)).otherwise(
        F.when(created_ms != 0, epoch_ms_date(created_ms))
    )


def irish_relative_date(label: Column, as_of: Column) -> Column:
    """Relative wording, then ISO, then the board's formats."""

    def parsed(text: Column) -> Column:
        def count(unit: str) -> Column:
            return first_match(text, rx(rf"(\d+)\s*{unit}s?\s*ago"))

        return (
            F.when(text.rlike("today|just now"), as_of)
            .when(F.contains(text, F.lit("yesterday")), F.date_sub(as_of, 1))
            .when(text.rlike(rx(r"\d+\s*(?:hours?|minutes?)\s*ago")), as_of)
            .when(count("day").isNotNull(), days_before(as_of, count("day")))
            .when(
                count("week").isNotNull(), days_before(as_of, count("week").try_cast("int") * 7)
            )
            .when(
                count("month").isNotNull(), days_before(as_of, count("month").try_cast("int") * 30)
            )
            .otherwise(F.coalesce(iso_date(text), _in_formats(text, BOARD_FORMATS)))
        )

    return F.when(F.length(label) > 0, let(F.lower(strip(label)), parsed))


def social_relative_date(label: Column, as_of: Column) -> Column:
    """``3d``, ``2w``, ``5 ч.``; months count 30 days, unknown units give null."""
    pattern = rx(r"^(\d+)\s*(\S+)")

    def parsed(text: Column) -> Column:
        n = F.regexp_extract(text, pattern, 1).try_cast("int")
        unit = F.rtrim(F.regexp_extract(text, pattern, 2), F.lit("."))
        return (
            F.when(unit.isin(*HOUR_OR_MINUTE_UNITS), as_of)
            .when(unit.isin(*DAY_UNITS), F.date_sub(as_of, n))
            .when(unit.isin(*WEEK_UNITS), F.date_sub(as_of, n * 7))
            .when(unit.isin(*MONTH_UNITS), F.date_sub(as_of, n * 30))
        )

    return let(F.rtrim(F.lower(strip(label)), F.lit(".")), parsed)


def deadline_date(text: Column) -> Column:
    """A date that may be introduced by ``Deadline:``."""
    clean = F.when(
        F.contains(text, F.lit("Deadline:")), strip(F.replace(text, F.lit("Deadline:"), F.lit("")))
    ).otherwise(text)
    return let(clean, lambda t: _in_formats(t, DEADLINE_FORMATS))


def day_first_date(text: Column) -> Column:
    """``dd/MM/yyyy``, else ISO."""
    return F.coalesce(_in_formats(text, ("d/M/yyyy",)), iso_date(text))
