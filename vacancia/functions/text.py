"""Text helpers: regex flags, whitespace, title case, HTML to text, slugs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.lookups import literal_map

# Everything Unicode calls white space plus the ASCII separators.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def rx(pattern: str, ignore_case: bool = False, dot_all: bool = False) -> str:
    """A Java regex with Unicode classes and newline-only line ends.

    ``\\b``, ``\\w``, ``\\s`` and ``\\d`` then mean the same for accented and non-Latin text as
    they do for ASCII, and ``.`` stops at a newline only.
    """
    return f"(?{'i' if ignore_case else ''}{'s' if dot_all else ''}dU){pattern}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def non_empty(text: Column) -> Column:
    """Null for the empty string. For cheap expressions: it reads its argument twice."""
    return F.when(text != "", text)


def filled(text: Column) -> Column:
    """Null for the empty string, for expressions that are worth evaluating once."""
    return let(text, non_empty)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the leftmost match, null when there is none (or the group is empty)."""
    return filled(F.regexp_extract(text, pattern, group))


def any_of(words: Iterable[str]) -> str:
    """A regex for one of many words, the longest that fits.

    Common beginnings are shared, so a position costs a few comparisons instead of one per word.
    """
    words = set(words)
    endings: dict[str, list[str]] = {}
    for word in sorted(words - {""}):
        endings.setdefault(word[0], []).append(word[1:])
    branches = [re.escape(first) + any_of(rest) for first, rest in endings.items()]
    if not branches:
        return ""
    optional = "?" if "" in words else ""
    return branches[0] if len(branches) == 1 and not optional else f"(?:{'|'.join(branches)}){optional}"


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def title_case(text: Column) -> Column:
    """Upper-case every cased letter that follows a non-letter, lower-case the rest."""
    runs = F.regexp_extract_all(
        text, F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0)
    )
    return F.array_join(
        F.transform(
            runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2))))
        ),
        "",
    )


def slugify(text: Column) -> Column:
    kept = F.regexp_replace(F.lower(strip(text)), r"(?U)[^a-z0-9\s-]", "")
    return F.regexp_replace(kept, r"(?U)\s+", "-")


def industry_cleanup(text: Column) -> Column:
    """Board industry code to a readable name; null when empty."""
    named = F.replace(F.replace(text, F.lit("Iv1"), F.lit("")), F.lit("_"), F.lit(" "))
    return F.when(F.length(text) > 0, strip(title_case(named)))


def join_present(sections: Column, separator: str = "\n\n") -> Column:
    """Non-empty pieces of an array joined in order; null when nothing is left."""
    kept = F.filter(sections, lambda s: s.isNotNull() & (s != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, separator))


def extract_emails(text: Column) -> Column:
    """All e-mail addresses; null for missing or empty text, an empty array when none is found."""
    pattern = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The address pattern backtracks on long words; a plain scan for '@' settles most texts.
    none = F.array().cast("array<string>")
    return F.when(F.length(text) > 0, F.when(F.contains(text, F.lit("@")), found).otherwise(none))


# ---- HTML to plain text -----------------------------------------------------------------------

# What may stand in a tag after its name. Quotes count after an equals sign only, and nothing is tried
# twice (all quantifiers are possessive), so odd markup costs no more than clean markup.
TAG_TAIL = r"[^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+"

def _entity_table() -> dict[str, str]:
    """The classic named entities, with the trailing semicolon where it is required."""
    return {"&" + k: v for k, v in html5.items() if k.rstrip(";") in name2codepoint}


def unescape_html(text: Column) -> Column:
    """Replace character references. ``&amp;`` goes last so that its result is not read again."""
    token = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);?"
    names = literal_map(_entity_table())

    def code_point(hexa: Column) -> Column:
        return F.decode(F.unhex(F.lpad(hexa, 8, "0")), "UTF-32")

    def value(ref: Column) -> Column:
        return (
            F.when(ref.rlike("^&#[0-9]"), code_point(F.hex(
                F.regexp_extract(ref, "([0-9]+)", 1).try_cast("bigint"))))
            .when(ref.rlike("^&#[xX]"), code_point(F.regexp_extract(ref, "[xX]([0-9a-fA-F]+)", 1)))
            .otherwise(F.try_element_at(names, ref))
        )

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(token), F.lit(0)))
    ordered = F.sort_array(
        F.transform(
            found,
            lambda r: F.struct(
                F.startswith(r, F.lit("&amp")).alias("last"),
                (-F.length(r)).alias("longest_first"),
                r.alias("ref"),
            ),
        )
    )
    replaced = F.aggregate(
        ordered,
        text,
        lambda acc, e: F.replace(acc, e["ref"], F.coalesce(value(e["ref"]), e["ref"])),
    )
    return F.when(F.contains(text, F.lit("&")), replaced).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Visible text of a page: tags become spaces, white space collapses.

    Scripts, styles, templates, comments and declarations carry no text. Runs entirely in the JVM.
    """
    hidden = (
        r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>|<[!?][^>]*>"
        rf"|</?[a-z]{TAG_TAIL}>"
    )
    spaced = F.regexp_replace(html, hidden, " ")
    return strip(F.regexp_replace(unescape_html(spaced), r"(?U)\s+", " "))


def strip_attributes(html: Column) -> Column:
    """Drop the attributes of the outermost tag."""
    return F.regexp_replace(
        html, rf"^(\s*<[A-Za-z][A-Za-z0-9-]*+)(?=[\s/])(?!\s*/?>){TAG_TAIL}>", "$1>"
    )
