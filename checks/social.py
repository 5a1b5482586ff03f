"""Social posts: country signals, fields of running text, posts as postings."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.inputs import AS_OF, plain, raw, soc, soc_sql
from checks.registry import query
from checks.scalars import _TYPED
from vacancia import lookups
from vacancia.functions import country, remote, social
from vacancia.lookups import CITIES
from vacancia.operators.dictionary import first_names
from vacancia.sources import social as source
from vacancia.sources.payloads import ParseOptions

# ---- country signals: the same tables, written as SQL ----------------------------------------


def _case(pairs) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" if v else f"WHEN {c} THEN NULL" for c, v in pairs) + " END"


def _alts(tokens) -> str:
    return "|".join(re.escape(t).replace("'", "''") for t in sorted(tokens, key=len, reverse=True))


def _named(found: str, table: dict) -> str:
    return f"CASE {found} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items() if v) + " END"


CLEAN = r"regexp_replace(text, '(?i)https?://(?:t\.co|x\.com|twitter\.com|mobile\.twitter\.com)/\S*', ' ', 'g')"
FLAG = _case((f"contains(t, '{lookups.flag(c)}')", c) for c in lookups.FLAG_CODES)
NAME = _named(f"lower(regexp_extract(t, '(?i)\\b({_alts(lookups.COUNTRY_NAMES)})\\b', 1))", lookups.COUNTRY_NAMES)
CITY = _named(f"lower(regexp_extract(t, '(?i)\\b({_alts(lookups.CITIES)})\\b', 1))", lookups.CITIES)
PHONE = _named(
    f"regexp_extract(t, '(?:^|[^\\d])({_alts(lookups.CALLING_CODES)})[\\d\\s().-]', 1)", lookups.CALLING_CODES
)
TLD = _case(
    (f"regexp_matches(lower(t), '{re.escape(d)}([^a-z]|$)')", lookups.TLDS[d])
    for d in sorted(lookups.TLDS, key=len, reverse=True)
)
MONEY = _case(
    (f"regexp_matches(lower(t), '\\b{k}\\b')" if k.isalpha() else f"contains(lower(t), '{k}')", v)
    for k, v in lookups.CURRENCIES.items()
)
SIGNALS = {"flag": FLAG, "name": NAME, "city": CITY, "phone": PHONE, "tld": TLD, "currency": MONEY}
SIGNAL_STEPS = {
    "cleaned": f"SELECT *, {CLEAN} AS t FROM soc",
    "signals": "SELECT *, " + ", ".join(f"{v} AS by_{k}" for k, v in SIGNALS.items()) + " FROM cleaned",
    "coded": f"SELECT *, coalesce({', '.join(f'by_{k}' for k in SIGNALS)}) AS code FROM signals",
}
FUNCTIONS = {
    "flag": country.country_by_flag, "name": country.country_by_name, "city": country.country_by_city,
    "phone": country.country_by_phone, "tld": country.country_by_tld,
    "currency": country.country_by_currency,
}


def _register_signal(kind: str) -> None:
    # A flag is put in front of every other post, since the projected text has none.
    marked = "CASE WHEN id % 2 = 0 THEN '🇩🇪 🇺🇸 ' ELSE '' END || text" if kind == "flag" else "text"

    @query(
        f"country_by_{kind}",
        soc_sql(f"SELECT id, {SIGNALS[kind]} AS code FROM s", s=f"SELECT id, {marked} AS t FROM soc"),
    )
    def by_signal(spark, sf):
        df = soc(spark, sf)
        text = F.col("text")
        if kind == "flag":
            text = F.concat(F.when(F.col("id") % 2 == 0, "🇩🇪 🇺🇸 ").otherwise(""), text)
        return df.select("id", FUNCTIONS[kind](text).alias("code"))


for _kind in FUNCTIONS:
    _register_signal(_kind)


@query("detect_country", soc_sql("SELECT id, code FROM coded", **SIGNAL_STEPS))
def detect_country(spark, sf):
    return soc(spark, sf).select("id", country.detect_country(F.col("text")).alias("code"))


@query(
    "signal_lookup",
    soc_sql("SELECT id, " + ", ".join(f"by_{k}" for k in SIGNALS) + " FROM signals", **SIGNAL_STEPS),
)
def signal_lookup(spark, sf):
    """Every signal's own answer."""
    text = F.regexp_replace("text", country.POST_LINK, " ")
    df = soc(spark, sf).select("id", text.alias("t"))
    return df.select("id", *[f(F.col("t")).alias(f"by_{k}") for k, f in FUNCTIONS.items()])


@query("dictionary_cities", soc_sql(f"SELECT id, {SIGNALS['city']} AS code FROM s", s="SELECT id, text AS t FROM soc"))
def dictionary_cities(spark, sf):
    """The cities as a table: the same answer as the pattern's."""
    pairs = [F.struct(F.lit(n).alias("name"), F.lit(v).cast("string").alias("value")) for n, v in CITIES.items()]
    cities = spark.range(1).select(F.inline(F.array(*pairs)))  # of a size that the optimizer knows
    said = soc(spark, sf).select("id", "text")  # ids repeat
    found = first_names(said, cities, ["id", "text"])
    return said.join(found, ["id", "text"], "left").select("id", F.col("value").alias("code"))


@query(
    "dictionary_customers",
    """SELECT CAST(o_orderkey AS BIGINT) AS seq, lower(c_name) AS name, c_mktsegment AS segment
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def dictionary_customers(spark, sf):
    """Companies by a dictionary that grows with the data; a longer number that begins like a name is none."""
    firms = spark.read.parquet(f"{sf}/customer.parquet")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    said = F.concat(F.lit("Ask "), "c_name", F.lit("0, work at "), "c_name", F.lit(" or CUSTOMER#000000001"))
    texts = orders.join(firms, orders.o_custkey == firms.c_custkey).select(
        F.col("o_orderkey").cast("long").alias("seq"), said.alias("text")
    )
    names = firms.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("value"))
    return first_names(texts, names, ["seq"]).select("seq", "name", F.col("value").alias("segment"))


# ---- fields of running text -------------------------------------------------------------------


def _sql_rx(pattern: str) -> str:
    return "(?i)" + pattern.replace("'", "''")


def _untag(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '\\s*#\\S+', '', 'g'))"


def _first_good(patterns, min_length: int, cut: int, clean=_untag) -> str:
    tries = []
    for p, _ in patterns:
        found = clean(f"trim(regexp_extract(text, '{_sql_rx(p)}', 1))")
        tries.append(f"CASE WHEN length({found}) > {min_length} THEN left({found}, {cut}) END")
    return f"coalesce({', '.join(tries)})"


LINES = "[trim(x) FOR x IN string_split(text, chr(10)) IF length(trim(x)) > 10]"
FIRST_LINE = f"left([y FOR y IN [trim(regexp_replace(x, '^[#@\\s]+', '')) FOR x IN {LINES}] IF length(y) > 0][1], 100)"
TITLE = f"coalesce({_first_good(social.TWEET_TITLES, 10, 150)}, {FIRST_LINE})"
COMPANY = f"coalesce({_first_good(social.COMPANIES, 1, 100)}, handle)"
PLACE = _first_good(social.TWEET_LOCATIONS, 0, 100)


@query("social_title", soc_sql(f"SELECT id, {TITLE} AS title FROM soc"))
def social_title(spark, sf):
    return soc(spark, sf).select("id", social.tweet_title(F.col("text")).alias("title"))


@query("social_company", soc_sql(f"SELECT id, {COMPANY} AS company FROM soc"))
def social_company(spark, sf):
    return soc(spark, sf).select(
        "id", social.tweet_company(F.col("text"), F.col("handle")).alias("company")
    )


@query("social_location", soc_sql(f"SELECT id, {PLACE} AS place FROM soc"))
def social_location(spark, sf):
    return soc(spark, sf).select("id", social.tweet_location(F.col("text")).alias("place"))


@query(
    "remote_social",
    soc_sql("""SELECT id, CASE WHEN regexp_matches(lower(text), 'remote|wfh|work from home|work-from-home|anywhere') THEN true END AS tweet,
      CASE WHEN regexp_matches(lower(text), 'remote|wfh|work from home|work-from-home') THEN true END AS post FROM soc"""),
)
def remote_social(spark, sf):
    t = F.col("text")
    return soc(spark, sf).select(
        "id", remote.remote_tweet(t).alias("tweet"), remote.remote_post(t).alias("post")
    )


def tweets(spark, sf):
    """Posts with links: a shortened one whose shown text is the real URL, and an internal one."""
    link = F.struct(
        F.lit("https://t.co/abc").alias("href"),
        F.concat(F.lit("jobs.acme.co.uk/r/"), F.col("id").cast("string")).alias("text"),
    )
    internal = F.struct(F.lit("https://x.com/acme/status/1").alias("href"), F.lit("our post").alias("text"))
    return soc(spark, sf).select(
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("id"),
        "handle",
        F.lit(None).cast("string").alias("name"),
        "text",
        "iso",
        F.concat(
            F.lit("https://x.com/"), "handle", F.lit("/status/"), F.col("id").cast("string")
        ).alias("permalink"),
        F.when(F.col("id") % 3 == 0, F.array(internal, link))
        .when(F.col("id") % 3 == 1, F.array(internal))
        .otherwise(F.array().cast("array<struct<href:string,text:string>>")).alias("links"),
    )


LINKED = """CASE WHEN id % 3 = 0 THEN 'https://jobs.acme.co.uk/r/' || CAST(id AS VARCHAR)
  ELSE 'https://x.com/' || handle || '/status/' || CAST(id AS VARCHAR) END"""


@query(
    "resolve_links",
    soc_sql("""SELECT id AS seq, CASE id % 3 WHEN 0 THEN 'https://x.com/acme/status/1 https://jobs.acme.co.uk/r/' || CAST(id AS VARCHAR)
      WHEN 1 THEN 'https://x.com/acme/status/1' ELSE '' END AS urls FROM soc"""),
)
def resolve_links(spark, sf):
    return tweets(spark, sf).select(
        "seq", F.array_join(social.resolve_links(F.col("links")), " ").alias("urls")
    )


@query("external_link", soc_sql(f"SELECT id AS seq, {LINKED} AS url FROM soc"))
def external_link(spark, sf):
    found = social.external_link(social.resolve_links(F.col("links")), F.col("permalink"))
    return tweets(spark, sf).select("seq", found.alias("url"))


def _posting_out(df):
    return plain(
        df.select(
            "seq", "title", "company_name", "job_url", F.col("location.city").alias("city"),
            F.col("location.country").alias("country"), "date_posted", "is_remote",
            F.array_join("job_type", ", ").alias("job_type"),
        )
    )


@query(
    "parse_tweets",
    soc_sql(
        f"""SELECT id AS seq, {TITLE} AS title, {COMPANY} AS company_name, {LINKED} AS job_url, {PLACE} AS city, code AS country,
      iso AS date_posted, CASE WHEN regexp_matches(lower(text), 'remote|wfh|work from home|work-from-home|anywhere') THEN true END AS is_remote,
      nullif({_TYPED.format(t='text')}, 'none') AS job_type FROM coded WHERE length(text) >= 50""",
        **SIGNAL_STEPS,
    ),
)
def parse_tweets(spark, sf):
    return _posting_out(source.parse_tweets(tweets(spark, sf)))


# ---- posts ------------------------------------------------------------------------------------

# Inner text of a rendered post, with everything around the body that must go.
def inner_texts(spark, sf):
    df = soc(spark, sf)
    nl = F.lit("\n")
    subtitle = F.when(F.col("id") % 4 != 1, "Recruiter at Foo Inc | talent\n").otherwise("")
    when = F.when(F.col("id") % 3 == 0, "3d • Edited\n").when(F.col("id") % 3 == 1, "2 нед. •\n").otherwise("")
    inner = F.concat(
        F.lit("Feed post\n"), F.col("handle"), F.lit("\n• 3rd+\n"), subtitle, when, F.col("text"), nl,
        F.lit("… see more\nLike\n5 comments"),
    )
    url = F.concat(F.lit("https://www.linkedin.com/feed/update/"), F.col("id").cast("string"))
    return raw(df, inner, "linkedin_posts", url, "none", "id")


# Without a time line the whole inner text up to the buttons is body, and what follows the author may
# look like a subtitle. Body lines keep their order; the rest is dropped.
SPLIT = """SELECT id AS seq, handle AS author, 'https://www.linkedin.com/feed/update/' || CAST(id AS VARCHAR) AS url,
  CASE WHEN id % 4 <> 1 THEN 'Recruiter at Foo Inc | talent' WHEN id % 3 = 2 THEN string_split(text, chr(10))[1] ELSE '' END AS subtitle,
  CASE id % 3 WHEN 0 THEN '3d  Edited' WHEN 1 THEN '2 нед.' ELSE '' END AS time,
  CASE WHEN id % 3 = 2 THEN 'Feed post' || chr(10) || handle || chr(10) || '• 3rd+' || chr(10)
     || CASE WHEN id % 4 <> 1 THEN 'Recruiter at Foo Inc | talent' || chr(10) ELSE '' END || text ELSE text END AS text FROM soc"""


@query("split_social_post_lines", soc_sql(SPLIT))
def split_social_post_lines(spark, sf):
    return source.split_social_post_lines(inner_texts(spark, sf))


def _unstar(expr: str) -> str:
    return f"trim(rtrim({_untag(f'''regexp_replace({expr}, '[*]{{2}}', '', 'g')''')}, '*:'))"


POST_TITLE = f"""coalesce({_first_good(social.POST_TITLES, 5, 150, _unstar)},
  left([y FOR y IN [trim(regexp_replace(x, '^[\\x{{1F300}}-\\x{{1FAFF}}#@*\\s]+', '')) FOR x IN {LINES}] IF length(y) > 5][1], 100))"""
POST_PLACE = f"""coalesce({_first_good(social.POST_LOCATIONS, 0, 100, lambda e: f"trim(regexp_replace(rtrim({e}, ',. '), '[*]+', '', 'g'))")}, {PLACE})"""
POST_COMPANY = f"""coalesce(left(nullif(trim(regexp_extract(subtitle, '(?i)\\bat\\s+(.+?)(?:\\s*[|·•]|$)', 1)), ''), 100),
  {_first_good(social.COMPANIES, 1, 100)}, author)"""
PROFILE = "coalesce(" + ", ".join(
    SIGNALS[k].replace("(t,", "(subtitle,").replace("extract(t,", "extract(subtitle,") for k in ("flag", "name", "city")
) + ")"


@query(
    "parse_linkedin_posts",
    soc_sql(
        f"""SELECT seq, {POST_TITLE} AS title, {POST_COMPANY} AS company_name, url AS job_url, {POST_PLACE} AS city,
      coalesce(by_all, {PROFILE}) AS country,
      CAST(CASE time WHEN '3d  Edited' THEN DATE '{AS_OF}' - 3 WHEN '2 нед.' THEN DATE '{AS_OF}' - 14 END AS VARCHAR) AS date_posted,
      CASE WHEN regexp_matches(lower(text), 'remote|wfh|work from home|work-from-home') THEN true END AS is_remote,
      nullif({_TYPED.format(t='text')}, 'none') AS job_type FROM found WHERE length(text) >= 30 AND {POST_TITLE} <> ''""",
        posts=SPLIT,
        cleaned=f"SELECT *, {CLEAN} AS t FROM posts",
        found="SELECT *, coalesce(" + ", ".join(SIGNALS.values()) + ") AS by_all FROM cleaned",
    ),
)
def parse_linkedin_posts(spark, sf):
    posts = source.split_social_post_lines(inner_texts(spark, sf))
    return _posting_out(source.parse_linkedin_posts(posts, ParseOptions(as_of=AS_OF)))
