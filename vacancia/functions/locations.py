"""Location texts to ``struct<country, country_raw, city, state>``; one rule set per source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import let, non_empty, rx, strip
from vacancia.lookups import ALIAS_TO_COUNTRY, COUNTRY_DISPLAY, lookup
from vacancia.schema import LOCATION_DDL, location


def country_of(text: Column) -> Column:
    """Canonical country of a name or alias, null when unknown."""
    return lookup(ALIAS_TO_COUNTRY, F.lower(strip(text)))


def display_location(place: Column) -> Column:
    """``city, state, country`` without the empty parts; null only for a null struct."""
    country = F.when(place["country_raw"], place["country"]).otherwise(
        lookup(COUNTRY_DISPLAY, place["country"])
    )
    return F.when(
        place.isNotNull(),
        F.concat_ws(", ", non_empty(place["city"]), non_empty(place["state"]), country),
    )


def _parts(text: Column, separator: str = ",") -> Column:
    return F.transform(F.split(text, separator), strip)


def _at(parts: Column, index: int) -> Column:
    return F.get(parts, F.lit(index))


def _country(default: Column | str) -> Column:
    return F.lit(default) if isinstance(default, str) else default


def loc_linkedin(text: Column, default_country: Column | str) -> Column:
    """Two parts keep the default country, three name their own, anything else has only the default."""
    home = _country(default_country)

    def by_size(p: Column) -> Column:
        return (
            F.when(F.size(p) == 2, location(_at(p, 0), _at(p, 1), home))
            .when(F.size(p) == 3, location(_at(p, 0), _at(p, 1), country_of(_at(p, 2))))
            .otherwise(location(None, None, home))
        )

    return let(F.split(strip(F.coalesce(text, F.lit("N/A"))), ", "), by_size)


def loc_glassdoor(text: Column) -> Column:
    """City before the first comma, the rest is the state (empty when there is no comma)."""
    known = (F.length(text) > 0) & (text != "Remote")
    return F.when(
        known,
        let(
            F.split(text, ", ", 2),
            lambda p: location(_at(p, 0), F.coalesce(_at(p, 1), F.lit("")), None),
        ),
    )


def loc_google(text: Column) -> Column:
    """City, state and the first extra part as free-text country."""
    return F.when(
        F.contains(text, F.lit(",")),
        let(_parts(text), lambda p: location(_at(p, 0), _at(p, 1), _at(p, 2), country_raw=True)),
    ).otherwise(location(text, None, None, country_raw=True))


def loc_first_comma(text: Column, country: Column | str) -> Column:
    """City before the first comma, everything after it is the state."""
    return F.when(
        F.length(text) > 0,
        let(
            F.split(text, ",", 2),
            lambda p: location(strip(_at(p, 0)), strip(_at(p, 1)), _country(country)),
        ),
    ).otherwise(location(None, None, _country(country)))


def loc_two_parts(text: Column, country: Column | str) -> Column:
    """The first two comma parts."""
    return F.when(
        F.length(text) > 0,
        let(_parts(text), lambda p: location(_at(p, 0), _at(p, 1), _country(country))),
    ).otherwise(location(None, None, _country(country)))


def loc_naukri(label: Column) -> Column:
    """First two ``", "`` parts of the location placeholder, always India."""
    return let(
        F.split(label, ", "), lambda p: location(_at(p, 0), _at(p, 1), F.lit("india"))
    )


def _empty() -> Column:
    return location(None, None, None, country_raw=True)


def loc_greenhouse(text: Column) -> Column:
    """The second of two parts is a state when it has two letters, else a country."""

    def by_size(p: Column) -> Column:
        second = _at(p, 1)
        return (
            F.when(F.size(p) >= 3, location(_at(p, 0), second, _at(p, 2), country_raw=True))
            .when(
                (F.size(p) == 2) & (F.length(second) == 2),
                location(_at(p, 0), second, None, country_raw=True),
            )
            .when(F.size(p) == 2, location(_at(p, 0), None, second, country_raw=True))
            .otherwise(location(_at(p, 0), None, None, country_raw=True))
        )

    return F.when(F.length(text) > 0, let(_parts(text), by_size)).otherwise(_empty())


def loc_lever(text: Column) -> Column:
    """The last part is a state when it is short, else a country."""

    def by_size(p: Column) -> Column:
        last = F.element_at(p, -1)
        short = F.length(last) <= 3
        return F.when(
            F.size(p) >= 2,
            location(
                _at(p, 0), F.when(short, last), F.when(~short, last), country_raw=True
            ),
        ).otherwise(location(_at(p, 0), None, None, country_raw=True))

    return F.when(F.length(text) > 0, let(_parts(text), by_size)).otherwise(_empty())


def loc_ashby_bamboo(text: Column) -> Column:
    """First part city, last part country."""
    return F.when(
        F.length(text) > 0,
        let(
            _parts(text),
            lambda p: location(
                _at(p, 0), None, F.when(F.size(p) >= 2, F.element_at(p, -1)), country_raw=True
            ),
        ),
    ).otherwise(_empty())


def _by_count(p: Column) -> Column:
    """1, 2 or 3+ parts: city; city and country; city, state and country."""
    return (
        F.when(F.size(p) >= 3, location(_at(p, 0), _at(p, 1), _at(p, 2), country_raw=True))
        .when(F.size(p) == 2, location(_at(p, 0), None, _at(p, 1), country_raw=True))
        .otherwise(location(_at(p, 0), None, None, country_raw=True))
    )


def _present_parts(text: Column) -> Column:
    return F.filter(_parts(text), lambda part: part != "")


def loc_jazzhr(text: Column) -> Column:
    """Without a leading ``Remote,`` and without remarks in parentheses."""
    no_remote = strip(F.regexp_replace(text, rx(r"^remote\s*,?\s*", ignore_case=True), ""))
    no_remarks = F.regexp_replace(no_remote, r"(?U)\([^)]*\)\s*,?\s*", "")
    return let(_present_parts(F.coalesce(no_remarks, F.lit(""))), _by_count)


def loc_loose(text: Column) -> Column:
    """Comma parts of free-form JSON."""
    return let(_present_parts(F.coalesce(text, F.lit(""))), _by_count)


def null_location() -> Column:
    return F.lit(None).cast(LOCATION_DDL)
