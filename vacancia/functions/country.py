"""Country of free text: six kinds of signals, strongest first. Codes are ISO 3166 alpha-2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import any_of, first_match, let, rx
from vacancia.lookups import (
    CALLING_CODES, CITIES, COUNTRY_NAMES, CURRENCIES, FLAG_CODES, TLDS, flag, literal_map, lookup,
)

POST_LINK = rx(r"https?://(?:t\.co|x\.com|twitter\.com|mobile\.twitter\.com)/\S*", ignore_case=True)


def country_by_flag(text: Column) -> Column:
    """First flag in table order, wherever it stands in the text."""
    chain = F.when(F.contains(text, F.lit(flag(FLAG_CODES[0]))), FLAG_CODES[0])
    for code in FLAG_CODES[1:]:
        chain = chain.when(F.contains(text, F.lit(flag(code))), code)
    # Flags are pairs of regional indicators; plain ASCII text, where bytes and characters are as
    # many, has none and is settled without a scan.
    indicators = (F.octet_length(text) > F.length(text)) & text.rlike(r"[\x{1F1E6}-\x{1F1FF}]")
    return F.when(indicators, chain)


def _by_word(text: Column, table: dict[str, str]) -> Column:
    # Matching lower-cased text is much cheaper than ignoring case at every comparison, and looking
    # at the first letter is cheaper than deciding whether a word starts here.
    first = "".join(sorted({word[0] for word in table}))
    pattern = rx(rf"(?=[{first}])\b({any_of(table)})\b")
    return lookup(table, first_match(F.lower(text), pattern))


def country_by_name(text: Column) -> Column:
    """Leftmost whole-word country name or alias."""
    return _by_word(text, COUNTRY_NAMES)


def country_by_city(text: Column) -> Column:
    """Leftmost whole-word city."""
    return _by_word(text, CITIES)


def country_by_phone(text: Column) -> Column:
    """Leftmost calling code; the shared one ends the search without a result."""
    pattern = rx(rf"(?<!\d)({any_of(CALLING_CODES)})(?=[\d\s().-])")
    known = {k: v for k, v in CALLING_CODES.items() if v}
    return F.when(F.contains(text, F.lit("+")), lookup(known, first_match(text, pattern)))


def _best_ranked(found: Column, ranked: list[str], codes: list[str]) -> Column:
    """Code of the found token that comes first in ``ranked``; null when none was found."""
    ranks = literal_map({token: i for i, token in enumerate(ranked)})
    best = F.array_min(F.transform(found, lambda t: F.try_element_at(ranks, t)))
    return F.get(F.array(*[F.lit(c) for c in codes]), best)


def country_by_tld(text: Column) -> Column:
    """Longest top-level domain present; table order among equals."""
    ranked = sorted(TLDS, key=len, reverse=True)
    pattern = rf"{any_of(TLDS)}(?![a-z])"
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return F.when(
        F.contains(text, F.lit(".")), _best_ranked(found, ranked, [TLDS[t] for t in ranked])
    )


def country_by_currency(text: Column) -> Column:
    """First currency in table order: codes as whole words, signs anywhere."""
    ranked = list(CURRENCIES)
    words = [t for t in ranked if t.isalpha()]
    signs = "".join(t for t in ranked if not t.isalpha())
    first = "".join(sorted({word[0] for word in words}))
    pattern = rx(rf"[{signs}]|(?<![a-z])(?=[{first}])\b{any_of(words)}\b")
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return _best_ranked(found, ranked, [CURRENCIES[t] for t in ranked])


def detect_country(
    text: Column, profile: Column | None = None, place_code: Column | None = None
) -> Column:
    """An explicit place code, else the strongest signal in the text, else in the author's profile."""
    signals = (
        country_by_flag, country_by_name, country_by_city, country_by_phone, country_by_tld,
        country_by_currency,
    )
    cleaned = F.regexp_replace(text, POST_LINK, " ")
    found = let(cleaned, lambda t: F.coalesce(*[s(t) for s in signals]))
    if profile is not None:
        found = F.coalesce(found, *[s(profile) for s in signals[:3]])
    if place_code is not None:
        found = F.coalesce(F.when(F.length(place_code) == 2, F.upper(place_code)), found)
    return found
