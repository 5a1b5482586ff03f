"""Fields of social posts, read from running text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import contains_any, first_match, let, non_empty, rx, strip
from vacancia.functions.urls import host

# Patterns in order of preference, each with texts of which one must be present.
TWEET_TITLES = (
    (
        r"(?:hiring|looking for|we need|open position|job opening|now hiring)[:\s]+(.+?)(?:\n|$)",
        ("hiring", "looking for", "we need", "open position", "job opening"),
    ),
    (r"^(.+?)\s+(?:needed|wanted|required)", ("needed", "wanted", "required")),
    (r"(?:role|position)[:\s]+(.+?)(?:\n|$)", ("role", "position")),
    (r"#hiring\s+(.+?)(?:\n|$|#)", ("#hiring",)),
)
POST_TITLES = (
    (
        r"\*{0,2}(?:hiring|looking for|we need|now hiring|ищем|ищу|набираем|вакансия|vacancy)[:\s*]+"
        r"(.+?)(?:\*{2}|\n|[.!](?:\s|$)|🏢|📍|💰|Employment|$)",
        ("hiring", "looking for", "we need", "ищем", "ищу", "набираем", "вакансия", "vacancy"),
    ),
    (
        r"(?:open position|job opening|hot job|job alert|job opportunity)[:\s]+(.+?)(?:\n|$)",
        ("open position", "job opening", "hot job", "job alert", "job opportunity"),
    ),
    (r"(?:role|position)[:\s]+(.+?)(?:\n|$)", ("role", "position")),
    (
        r"[\x{1F300}-\x{1FAFF}\s]*([A-Z][A-Za-z\s]+(?:Developer|Engineer|Designer|Manager|Lead"
        r"|Architect|Analyst|Consultant|Specialist|Intern|Coordinator|Director|VP|CTO|CEO)"
        r"[\w\s–\-/]*?)(?:\n|[.!](?:\s|$)|$)",
        (
            "developer", "engineer", "designer", "manager", "lead", "architect", "analyst",
            "consultant", "specialist", "intern", "coordinator", "director", "vp", "cto", "ceo",
        ),
    ),
)
TWEET_LOCATIONS = (
    (
        r"(?:location|based in|located in|office in)[:\s]+(.+?)(?:\n|$|\|)",
        ("location", "based in", "located in", "office in"),
    ),
    (r"\x{1F4CD}\s*(.+?)(?:\n|$)", ("\U0001F4CD",)),
    (r"\x{1F30D}\s*(.+?)(?:\n|$)", ("\U0001F30D",)),
)
POST_LOCATIONS = (
    (
        r"(?:location|based in|located in|office in|remote locations?)[:\s]+(.+?)(?:\n|$|\||🏢|💰|💻)",
        ("location", "based in", "located in", "office in"),
    ),
    (r"\x{1F4CD}\s*(.+?)(?:\n|$)", ("\U0001F4CD",)),
)
COMPANIES = (
    (r"(?:at|@|company)[:\s]+(.+?)(?:\n|$|\||#)", ("at", "@", "company")),
    (r"(?:join|work (?:at|for))\s+(.+?)(?:\n|$|\||#|!)", ("join", "work at", "work for")),
)
SUBTITLE_COMPANY = r"\bat\s+(.+?)(?:\s*[|·•]|$)"
OWN_HOSTS = ("twitter.com", "x.com", "t.co")
MIN_TWEET_LENGTH = 50
MIN_POST_LENGTH = 30
# Characters that are kept of what a post's text is read for, by default.
TITLE_CHARS, LINE_TITLE_CHARS, COMPANY_CHARS, PLACE_CHARS = 150, 100, 100, 100


def _without_hashtags(text: Column) -> Column:
    return strip(F.regexp_replace(text, rx(r"\s*#\S+"), ""))


def _first_good(text: Column, rules, clean, min_length: int, cut: int) -> Column:
    """Cleaned group of the first pattern whose result is long enough."""

    def candidate(low: Column, pattern: str, hints: tuple[str, ...]) -> Column:
        found = clean(strip(first_match(text, rx(pattern, ignore_case=True))))
        good = let(found, lambda f: F.when(F.length(f) > min_length, F.left(f, F.lit(cut))))
        return F.when(contains_any(low, hints), good)

    return let(F.lower(text), lambda low: F.coalesce(*[candidate(low, *r) for r in rules]))


def _first_line(text: Column, leading: str, min_length: int, cut: int) -> Column:
    """First line of more than ten characters, without its leading symbols."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: F.length(x) > 10)
    cleaned = F.transform(lines, lambda x: strip(F.regexp_replace(x, rx(f"^[{leading}]+"), "")))
    good = F.filter(cleaned, lambda x: F.length(x) > min_length)
    return F.left(F.get(good, F.lit(0)), F.lit(cut))


def tweet_title(text: Column, cut: int = TITLE_CHARS, line_cut: int = LINE_TITLE_CHARS) -> Column:
    return F.coalesce(
        _first_good(text, TWEET_TITLES, _without_hashtags, 10, cut),
        _first_line(text, r"#@\x{1F300}-\x{1FAFF}\s", 0, line_cut),
    )


def post_title(text: Column, cut: int = TITLE_CHARS, line_cut: int = LINE_TITLE_CHARS) -> Column:
    def clean(found: Column) -> Column:
        plain = _without_hashtags(F.regexp_replace(found, r"\*{2}", ""))
        return strip(F.rtrim(plain, F.lit("*:")))

    # What fails where a run of letters begins fails at all its letters, so only beginnings are tried.
    *rules, (run, hints) = POST_TITLES
    rules.append((r"(?<![A-Z\s])" + run, hints))
    return F.coalesce(
        _first_good(text, rules, clean, 5, cut),
        _first_line(text, r"\x{1F300}-\x{1FAFF}#@*\s", 5, line_cut),
    )


def tweet_company(text: Column, author: Column, cut: int = COMPANY_CHARS) -> Column:
    return F.coalesce(_first_good(text, COMPANIES, _without_hashtags, 1, cut), author)


def post_company(text: Column, author: Column, subtitle: Column, cut: int = COMPANY_CHARS) -> Column:
    """The employer named in the author's line wins over the text."""
    employer = F.left(
        strip(first_match(subtitle, rx(SUBTITLE_COMPANY, ignore_case=True))), F.lit(cut)
    )
    return F.coalesce(employer, tweet_company(text, author, cut))


def tweet_location(text: Column, place: Column | None = None, cut: int = PLACE_CHARS) -> Column:
    found = _first_good(text, TWEET_LOCATIONS, _without_hashtags, 0, cut)
    return found if place is None else F.coalesce(found, non_empty(place))


def post_location(text: Column, cut: int = PLACE_CHARS) -> Column:
    def clean(found: Column) -> Column:
        return strip(F.regexp_replace(F.rtrim(found, F.lit(",. ")), r"\*+", ""))

    return F.coalesce(_first_good(text, POST_LOCATIONS, clean, 0, cut), tweet_location(text, cut=cut))


def resolve_links(links: Column) -> Column:
    """Shown link text where it looks like a URL, else the (shortened) target; blanks dropped."""

    def one(link: Column) -> Column:
        shown = strip(F.coalesce(link["text"], F.lit("")))
        target = strip(F.coalesce(link["href"], F.lit("")))
        looks_like_url = F.contains(shown, F.lit("://")) | F.contains(
            F.substring_index(shown, "/", 1), F.lit(".")
        )
        full = F.when(F.startswith(shown, F.lit("http")), shown).otherwise(
            F.concat(F.lit("https://"), shown)
        )
        return F.when((shown != "") & looks_like_url, full).otherwise(non_empty(target))

    return F.filter(F.transform(links, one), lambda u: u.isNotNull())


def external_link(urls: Column, post_url: Column) -> Column:
    """First link that leaves the network, else the post itself. Hosts are compared whole."""

    def internal(url: Column) -> Column:
        return let(host(url), lambda h: h.isin(*OWN_HOSTS) | h.rlike(r"\.(?:twitter|x)\.com$"))

    outside = F.filter(urls, lambda u: ~F.coalesce(internal(u), F.lit(False)))
    return F.coalesce(F.get(outside, F.lit(0)), post_url)
