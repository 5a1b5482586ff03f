"""Scalar rules: pay, dates, places, remote flags, job types, text and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.assembly import EMAIL, PAY_STEPS, REC
from checks.inputs import AS_OF, plain, pst, pst_sql, table
from checks.registry import query
from vacancia.functions import dates, job_types, locations, remote, salary, text, urls
from vacancia.lookups import TWO_PART_TLDS


def today():
    return F.lit(AS_OF).cast("date")


def _pay(df, comp, *keep):
    """Keep columns plus the fields of a compensation expression."""
    return df.select(*keep, comp.alias("comp")).select(*keep, "comp.*")


def _place(df, place, *keep):
    return df.select(*keep, place.alias("place")).select(
        *keep, "place.city", "place.state", "place.country"
    )


# ---- pay --------------------------------------------------------------------------------------


@query(
    "extract_salary",
    pst_sql(
        "SELECT seq, d_interval AS interval, d_min AS min_amount, d_max AS max_amount, d_currency AS currency FROM pay",
        rec=REC,
        **PAY_STEPS,
    ),
)
def extract_salary(spark, sf):
    return _pay(pst(spark, sf), salary.extract_salary(F.col("description")), "seq")


@query(
    "extract_salary_annual",
    pst_sql(
        "SELECT seq, d_interval AS interval, d_min * fac AS min_amount, d_max * fac AS max_amount, d_currency AS currency FROM pay",
        rec=REC,
        **PAY_STEPS,
    ),
)
def extract_salary_annual(spark, sf):
    return _pay(pst(spark, sf), salary.extract_salary(F.col("description"), annual=True), "seq")


@query(
    "parse_currency_number",
    pst_sql("""SELECT seq, round(TRY_CAST(head || CASE WHEN contains(tail, '.') THEN tail ELSE replace(tail, ',', '.') END AS DOUBLE), 2) AS amount
      FROM (SELECT seq, regexp_replace(left(k, greatest(length(k) - 3, 0)), '[.,]', '', 'g') AS head, right(k, 3) AS tail
        FROM (SELECT seq, regexp_replace(salary_label, '[^-0-9.,]', '', 'g') AS k FROM pst))"""),
)
def parse_currency_number(spark, sf):
    return pst(spark, sf).select(
        "seq", salary.parse_currency_number(F.col("salary_label")).alias("amount")
    )


@query(
    "linkedin_salary",
    pst_sql("""SELECT seq, CAST(NULL AS VARCHAR) AS interval, CAST(a AS DOUBLE) AS min_amount, CAST(b AS DOUBLE) AS max_amount, 'USD' AS currency
      FROM (SELECT seq, 30000 + seq % 40 * 1000 AS a, 80000 + seq % 9 * 1000 AS b FROM pst WHERE seq % 3 = 0)
      UNION ALL SELECT seq, NULL, NULL, NULL, NULL FROM pst WHERE seq % 3 <> 0"""),
)
def linkedin_salary(spark, sf):
    """Two thirds of the labels have only one number."""
    low = F.format_number(30000 + F.col("seq") % 40 * 1000, 2)
    high = F.format_number(80000 + F.col("seq") % 9 * 1000, 2)
    label = F.when(
        F.col("seq") % 3 == 0, F.concat(F.lit(" $"), low, F.lit(" - $"), high)
    ).otherwise(F.concat(F.lit("$"), low))
    return _pay(pst(spark, sf), salary.linkedin_salary(label), "seq")


@query(
    "indian_salary",
    pst_sql("""SELECT seq, CAST(NULL AS VARCHAR) AS interval, CASE WHEN hit THEN trunc(CAST(a AS DOUBLE) * u) END AS min_amount,
      CASE WHEN hit THEN trunc(CAST(b AS DOUBLE) * u) END AS max_amount, CASE WHEN hit THEN 'INR' END AS currency
      FROM (SELECT seq, regexp_matches(salary_label, '^(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)\\s*(Lacs|Lakh|Cr)') AS hit,
        regexp_extract(salary_label, '^(\\d+(?:\\.\\d+)?)', 1) AS a, regexp_extract(salary_label, '-\\s*(\\d+(?:\\.\\d+)?)', 1) AS b,
        CASE WHEN contains(salary_label, 'Cr') THEN 10000000 ELSE 100000 END AS u FROM pst)"""),
)
def indian_salary(spark, sf):
    return _pay(pst(spark, sf), salary.indian_salary(F.col("salary_label")), "seq")


_NUMBERS = """SELECT seq, lower(trim(salary_label)) AS t, [y FOR y IN [TRY_CAST(replace(x, ',', '') AS DOUBLE) FOR x IN regexp_extract_all({src}, '[\\d,]+(?:\\.\\d+)?')] IF y IS NOT NULL] AS a FROM pst"""


@query(
    "seek_salary",
    pst_sql(
        """SELECT seq, CASE WHEN len(a) > 0 THEN CASE WHEN regexp_matches(t, 'per hour|hourly|/hr') THEN 'hourly' ELSE 'yearly' END END AS interval,
      a[1] AS min_amount, coalesce(a[2], a[1]) AS max_amount, CASE WHEN len(a) > 0 THEN 'AUD' END AS currency FROM n""",
        n=_NUMBERS.format(src="salary_label"),
    ),
)
def seek_salary(spark, sf):
    return _pay(pst(spark, sf), salary.seek_salary(F.col("salary_label")), "seq")


@query(
    "irish_salary",
    pst_sql(
        """SELECT seq, CASE WHEN len(a) > 0 THEN CASE WHEN contains(t, 'per hour') THEN 'hourly' ELSE 'yearly' END END AS interval,
      a[1] AS min_amount, coalesce(a[2], a[1]) AS max_amount, CASE WHEN len(a) > 0 THEN 'EUR' END AS currency FROM n""",
        n=_NUMBERS.format(src="salary_label"),
    ),
)
def irish_salary(spark, sf):
    return _pay(pst(spark, sf), salary.irish_salary(F.col("salary_label")), "seq")


@query(
    "reed_salary_search",
    pst_sql("""SELECT seq, CASE WHEN r IS NOT NULL THEN CASE WHEN r < 350 THEN 'hourly' WHEN r < 1000 THEN 'daily' ELSE 'yearly' END END AS interval,
      lo AS min_amount, hi AS max_amount, CASE WHEN r IS NOT NULL THEN 'GBP' END AS currency FROM
      (SELECT *, coalesce(lo, hi) AS r FROM (SELECT seq, CASE WHEN comp_min * m > 0 THEN comp_min * m END AS lo, CASE WHEN comp_max * m > 0 THEN comp_max * m END AS hi
        FROM (SELECT *, CASE seq % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 10 ELSE 1000 END AS m FROM pst)))"""),
)
def reed_salary_search(spark, sf):
    scale = F.element_at(F.array(*[F.lit(v) for v in (0, 1, 10, 1000)]), (F.col("seq") % 4 + 1).cast("int"))
    df = pst(spark, sf).withColumn("m", scale)
    comp = salary.reed_salary_search(F.col("comp_min") * F.col("m"), F.col("comp_max") * F.col("m"))
    return _pay(df, comp, "seq")


# ---- dates ------------------------------------------------------------------------------------


@query("epoch_ms_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def epoch_ms_date(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return plain(
        table(spark, sf, "events").select("event_id", dates.epoch_ms_date(ms).alias("day"))
    )


@query(
    "iso_date",
    pst_sql("""SELECT seq, CASE WHEN seq % 5 < 3 THEN CAST(date_posted AS VARCHAR) END AS day FROM pst"""),
)
def iso_date(spark, sf):
    """Plain dates, offsets that must not shift the day, and malformed texts."""
    d = F.col("date_posted").cast("string")
    label = (
        F.when(F.col("seq") % 5 == 0, d)
        .when(F.col("seq") % 5 == 1, F.concat(d, F.lit("T23:30:00-05:00")))
        .when(F.col("seq") % 5 == 2, F.concat(d, F.lit("T10:30:00.123Z")))
        .when(F.col("seq") % 5 == 3, F.lit("soon"))
        .otherwise(F.replace(d, F.lit("-"), F.lit("/")))
    )
    return plain(pst(spark, sf).select("seq", dates.iso_date(label).alias("day")))


@query(
    "days_ago_number",
    pst_sql(f"""SELECT seq, CAST(DATE '{AS_OF}' - CAST(nullif(regexp_extract(date_label, '\\d+'), '') AS INTEGER) AS VARCHAR) AS day FROM pst"""),
)
def days_ago_number(spark, sf):
    return plain(
        pst(spark, sf).select(
            "seq", dates.days_ago_number(F.col("date_label"), today()).alias("day")
        )
    )


@query(
    "age_in_days",
    pst_sql(f"SELECT seq, CAST(DATE '{AS_OF}' - CAST(CASE WHEN seq % 9 > 0 THEN seq % 45 END AS INTEGER) AS VARCHAR) AS day FROM pst"),
)
def age_in_days(spark, sf):
    age = F.when(F.col("seq") % 9 > 0, F.col("seq") % 45)
    return plain(pst(spark, sf).select("seq", dates.age_in_days(age, today()).alias("day")))


@query(
    "naukri_label_date",
    pst_sql(f"""SELECT seq, CAST(CASE
      WHEN seq % 10 = 0 THEN date_posted
      WHEN regexp_matches(lower(date_label), 'today|just now|few hours') THEN DATE '{AS_OF}'
      WHEN contains(lower(date_label), 'ago') THEN DATE '{AS_OF}' - CAST(nullif(regexp_extract(lower(date_label), '(\\d+)\\s*day', 1), '') AS INTEGER)
      ELSE date_posted END AS VARCHAR) AS day FROM pst"""),
)
def naukri_label_date(spark, sf):
    """Every tenth row has no label, so its creation time counts."""
    created = F.unix_date("date_posted").cast("bigint") * 86_400_000 + 3_600_000
    label = F.when(F.col("seq") % 10 != 0, F.col("date_label"))
    day = dates.naukri_label_date(label, created, today())
    return plain(pst(spark, sf).select("seq", day.alias("day")))


@query(
    "irish_relative_date",
    pst_sql(f"""SELECT seq, CAST(CASE date_label WHEN 'Today' THEN DATE '{AS_OF}' WHEN '3 days ago' THEN DATE '{AS_OF}' - 3
      WHEN 'posted 2 weeks ago' THEN DATE '{AS_OF}' - 14 WHEN '15 Jan 2024' THEN DATE '2024-01-15' END AS VARCHAR) AS day FROM pst"""),
)
def irish_relative_date(spark, sf):
    return plain(
        pst(spark, sf).select(
            "seq", dates.irish_relative_date(F.col("date_label"), today()).alias("day")
        )
    )


@query(
    "social_relative_date",
    pst_sql(f"""SELECT seq, CAST(CASE WHEN u IN ('h', 'мин') THEN DATE '{AS_OF}' WHEN u IN ('d', 'дн') THEN DATE '{AS_OF}' - n
      WHEN u IN ('w', 'нед') THEN DATE '{AS_OF}' - 7 * n WHEN u = 'mo' THEN DATE '{AS_OF}' - 30 * n END AS VARCHAR) AS day
      FROM (SELECT seq, CAST(1 + seq % 11 AS INTEGER) AS n, ['h', 'd', 'w', 'mo', 'yr', 'дн', 'нед', 'мин'][CAST(seq % 8 + 1 AS INTEGER)] AS u FROM pst)"""),
)
def social_relative_date(spark, sf):
    units = F.array(*[F.lit(u) for u in ("h", "d", "w", "mo", "yr", "дн.", "нед.", "мин")])
    label = F.concat(
        (1 + F.col("seq") % 11).cast("string"),
        F.when(F.col("seq") % 2 == 0, " ").otherwise(""),
        F.element_at(units, (F.col("seq") % 8 + 1).cast("int")),
        F.lit(" • Edited"),
    )
    return plain(
        pst(spark, sf).select("seq", dates.social_relative_date(label, today()).alias("day"))
    )


@query(
    "multi_format_date",
    pst_sql("""SELECT seq, CASE WHEN seq % 7 < 5 THEN CAST(date_posted AS VARCHAR) END AS deadline,
      CASE WHEN seq % 2 = 0 OR seq % 7 = 4 THEN CAST(date_posted AS VARCHAR) END AS board,
      CASE WHEN seq % 2 = 0 THEN CAST(date_posted AS VARCHAR) END AS strict FROM pst"""),
)
def multi_format_date(spark, sf):
    d, k = F.col("date_posted"), F.col("seq") % 7
    label = (
        F.when(k == 0, F.concat(F.lit("Deadline: "), F.date_format(d, "d MMM yyyy")))
        .when(k == 1, F.date_format(d, "dd-MMM-yyyy"))
        .when(k == 2, F.date_format(d, "d MMMM yyyy"))
        .when(k == 3, F.date_format(d, "MMMM d, yyyy"))
        .when(k == 4, F.date_format(d, "dd/MM/yyyy"))
        .when(k == 5, F.date_format(d, "yyyy.MM.dd"))
        .otherwise("unknown")
    )
    board = F.when(F.col("seq") % 2 == 0, d.cast("string")).otherwise(
        F.when(k == 4, F.date_format(d, "dd/MM/yyyy")).otherwise("x")
    )
    return plain(
        pst(spark, sf).select(
            "seq", dates.deadline_date(label).alias("deadline"),
            dates.day_first_date(board).alias("board"), dates.strict_date(board).alias("strict"),
        )
    )


# ---- places -----------------------------------------------------------------------------------

# Comma parts of the location text, trimmed.
_PARTS = "SELECT seq, location_text AS t, [trim(x) FOR x IN string_split(location_text, ',')] AS p FROM pst"
_PLACE = "SELECT seq, {city} AS city, {state} AS state, {country} AS country FROM p"


def place_sql(city="p[1]", state="CAST(NULL AS VARCHAR)", country="CAST(NULL AS VARCHAR)", where=""):
    return pst_sql(_PLACE.format(city=city, state=state, country=country) + where, p=_PARTS)


@query(
    "loc_linkedin",
    place_sql(
        "CASE WHEN len(p) IN (2, 3) THEN p[1] END", "CASE WHEN len(p) IN (2, 3) THEN p[2] END",
        "CASE WHEN len(p) = 3 THEN CASE p[3] WHEN 'Ireland' THEN 'ireland' END ELSE 'usa' END",
    ),
)
def loc_linkedin(spark, sf):
    return _place(pst(spark, sf), locations.loc_linkedin(F.col("location_text"), "usa"), "seq")


@query(
    "loc_glassdoor",
    place_sql(
        "CASE WHEN t <> 'Remote' THEN split_part(t, ', ', 1) END",
        "CASE WHEN t <> 'Remote' THEN CASE WHEN contains(t, ', ') THEN substr(t, position(', ' IN t) + 2) ELSE '' END END",
    ),
)
def loc_glassdoor(spark, sf):
    return _place(pst(spark, sf), locations.loc_glassdoor(F.col("location_text")), "seq")


@query("loc_google", place_sql("CASE WHEN len(p) > 1 THEN p[1] ELSE t END", "p[2]", "p[3]"))
def loc_google(spark, sf):
    return _place(pst(spark, sf), locations.loc_google(F.col("location_text")), "seq")


@query(
    "loc_first_comma",
    place_sql("p[1]", "CASE WHEN contains(t, ',') THEN trim(substr(t, position(',' IN t) + 1)) END", "'uk'"),
)
def loc_first_comma(spark, sf):
    return _place(pst(spark, sf), locations.loc_first_comma(F.col("location_text"), "uk"), "seq")


@query("loc_two_parts", place_sql("p[1]", "p[2]", "'ireland'"))
def loc_two_parts(spark, sf):
    return _place(pst(spark, sf), locations.loc_two_parts(F.col("location_text"), "ireland"), "seq")


@query(
    "loc_greenhouse",
    place_sql(
        "p[1]", "CASE WHEN len(p) >= 3 OR (len(p) = 2 AND length(p[2]) = 2) THEN p[2] END",
        "CASE WHEN len(p) >= 3 THEN p[3] WHEN len(p) = 2 AND length(p[2]) <> 2 THEN p[2] END",
    ),
)
def loc_greenhouse(spark, sf):
    return _place(pst(spark, sf), locations.loc_greenhouse(F.col("location_text")), "seq")


@query(
    "loc_lever",
    place_sql(
        "p[1]", "CASE WHEN len(p) >= 2 AND length(p[-1]) <= 3 THEN p[-1] END",
        "CASE WHEN len(p) >= 2 AND length(p[-1]) > 3 THEN p[-1] END",
    ),
)
def loc_lever(spark, sf):
    return _place(pst(spark, sf), locations.loc_lever(F.col("location_text")), "seq")


@query("loc_ashby_bamboo", place_sql("p[1]", "CAST(NULL AS VARCHAR)", "CASE WHEN len(p) >= 2 THEN p[-1] END"))
def loc_ashby_bamboo(spark, sf):
    return _place(pst(spark, sf), locations.loc_ashby_bamboo(F.col("location_text")), "seq")


@query(
    "loc_jazzhr",
    place_sql("nullif(p[1], 'Remote')", "CASE WHEN len(p) >= 3 THEN p[2] END",
              "CASE WHEN len(p) >= 3 THEN p[3] WHEN len(p) = 2 THEN p[2] END"),
)
def loc_jazzhr(spark, sf):
    """Half of the texts get a ``Remote,`` prefix or a remark, which must make no difference."""
    t = F.col("location_text")
    marked = F.when(F.col("seq") % 2 == 0, F.concat(F.lit("Remote, (Hybrid, x), "), t)).otherwise(t)
    return _place(
        pst(spark, sf), locations.loc_jazzhr(F.regexp_replace(marked, r"^Remote, \(Hybrid, x\), Remote$", "Remote")), "seq"
    )


@query(
    "loc_loose",
    place_sql("p[1]", "CASE WHEN len(p) >= 3 THEN p[2] END",
              "CASE WHEN len(p) >= 3 THEN p[3] WHEN len(p) = 2 THEN p[2] END"),
)
def loc_loose(spark, sf):
    """Empty parts between commas are ignored."""
    t = F.regexp_replace("location_text", ", ", " , , ")
    return _place(pst(spark, sf), locations.loc_loose(t), "seq")


# ---- remote flags -----------------------------------------------------------------------------

_TEXT = "lower(concat_ws(' ', title, location_text, description))"


def _flags(df, flag):
    return df.select("seq", flag.alias("flag"))


@query(
    "remote_keywords3",
    pst_sql(f"SELECT seq, regexp_matches({_TEXT}, 'remote|work from home|wfh') AS flag FROM pst"),
)
def remote_keywords3(spark, sf):
    return _flags(
        pst(spark, sf),
        remote.remote_keywords3(F.col("title"), F.col("location_text"), F.col("description")),
    )


@query(
    "remote_reed",
    """SELECT doc_id, regexp_matches(lower(concat_ws(' ', source, lang, left(regexp_replace(lower(text), 'th[a-z]', 'wfh', 'g'), 500))), 'remote|work from home|wfh') AS flag FROM documents""",
)
def remote_reed(spark, sf):
    """The board's rule looks at the first 500 characters; the tested text says ``wfh`` often."""
    marked = F.regexp_replace(F.lower("text"), "th[a-z]", "wfh")
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        remote.remote_reed(F.col("source"), F.col("lang"), marked).alias("flag"),
    )


@query(
    "remote_indeed",
    pst_sql("""SELECT seq, coalesce(contains(lower(job_type_text), 'remote'), false) OR seq % 8 = 0
      OR regexp_matches(lower(concat_ws(' ', description, location_text)), 'remote|work from home|wfh') AS flag FROM pst"""),
)
def remote_indeed(spark, sf):
    labels = F.array(
        F.coalesce("job_type_text", F.lit("")), F.when(F.col("seq") % 8 == 0, "WFH option").otherwise("x")
    )
    return _flags(
        pst(spark, sf),
        remote.remote_indeed(labels, F.col("description"), F.col("location_text")),
    )


@query(
    "remote_bdjobs",
    pst_sql("SELECT seq, regexp_matches(lower(concat_ws(' ', title, location_text)), 'remote|work from home|wfh|home based') AS flag FROM pst"),
)
def remote_bdjobs(spark, sf):
    return _flags(pst(spark, sf), remote.remote_bdjobs(F.col("title"), F.col("location_text")))


@query(
    "remote_google",
    pst_sql("SELECT seq, regexp_matches(lower(coalesce(description, '')), 'remote|wfh') AS flag FROM pst"),
)
def remote_google(spark, sf):
    return _flags(pst(spark, sf), remote.remote_google(F.col("description")))


@query(
    "remote_irish",
    pst_sql("SELECT seq, regexp_matches(concat_ws(chr(10), description, title, location_text), '(?i)\\b(remote|wfh|work from home)\\b') AS flag FROM pst"),
)
def remote_irish(spark, sf):
    return _flags(
        pst(spark, sf),
        remote.remote_irish(F.col("description"), F.col("title"), F.col("location_text")),
    )


@query(
    "remote_ats",
    pst_sql("""SELECT seq, CASE seq % 7 WHEN 0 THEN says WHEN 1 THEN says OR works WHEN 2 THEN flagged OR says WHEN 3 THEN flagged OR works
      WHEN 4 THEN flagged WHEN 5 THEN flagged ELSE says END AS flag FROM
      (SELECT seq, contains(lower(coalesce(location_text, '')), 'remote') AS says, contains(lower(coalesce(description, '')), 'remote') AS works,
        seq % 5 = 0 AS flagged FROM pst)"""),
)
def remote_ats(spark, sf):
    names = ("greenhouse", "lever", "ashby", "workable", "smartrecruiters", "bamboohr", "jazzhr")
    platform = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("seq") % 7 + 1).cast("int"))
    return _flags(
        pst(spark, sf),
        remote.remote_ats(
            platform, F.col("seq") % 5 == 0, F.col("location_text"), F.col("description")
        ),
    )


@query(
    "work_from_home_type",
    pst_sql(f"""SELECT seq, CASE WHEN seq % 10 = 0 THEN 'Hybrid' WHEN contains({_TEXT}, 'remote') THEN 'Remote' ELSE 'Work from office' END AS kind FROM pst"""),
)
def work_from_home_type(spark, sf):
    title = F.when(F.col("seq") % 10 == 0, F.concat("title", F.lit(" (HYBRID)"))).otherwise(F.col("title"))
    kind = remote.work_from_home_type(F.col("location_text"), title, F.col("description"))
    return pst(spark, sf).select("seq", kind.alias("kind"))


# ---- job types --------------------------------------------------------------------------------


def _listed(df, types, *keep):
    """Types as text; ``none`` for an empty array, null for none."""
    return df.select(
        *keep,
        F.when(F.size(types) == 0, "none").otherwise(F.array_join(types, ", ")).alias("types"),
    )


_TYPED = """CASE WHEN coalesce({t}, '') = '' THEN 'none' ELSE nullif(concat_ws(', ',
  CASE WHEN regexp_matches({t}, 'full\\s?time', 'i') THEN 'fulltime' END, CASE WHEN regexp_matches({t}, 'part\\s?time', 'i') THEN 'parttime' END,
  CASE WHEN regexp_matches({t}, 'internship', 'i') THEN 'internship' END, CASE WHEN regexp_matches({t}, 'contract', 'i') THEN 'contract' END), '') END"""


@query("extract_job_type", pst_sql(f"SELECT seq, {_TYPED.format(t='description')} AS types FROM pst"))
def extract_job_type(spark, sf):
    return _listed(pst(spark, sf), job_types.extract_job_type(F.col("description")), "seq")


@query(
    "normalize_job_type",
    pst_sql("""SELECT seq, CASE job_type_text WHEN 'full-time' THEN 'fulltime' WHEN 'Part Time' THEN 'parttime'
      WHEN 'Contract' THEN 'contract' WHEN 'Praktikum' THEN 'internship' END AS kind FROM pst"""),
)
def normalize_job_type(spark, sf):
    return pst(spark, sf).select(
        "seq", job_types.normalize_job_type(F.col("job_type_text")).alias("kind")
    )


@query(
    "job_type_seek",
    pst_sql("""SELECT seq, CASE WHEN seq % 3 = 0 THEN 'parttime' || CASE WHEN seq % 5 IN (1, 2) THEN ', ' || CASE seq % 5 WHEN 1 THEN 'parttime' ELSE 'contract' END ELSE '' END
      ELSE CASE seq % 5 WHEN 1 THEN 'parttime' WHEN 2 THEN 'contract' END END AS types FROM pst"""),
)
def job_type_seek(spark, sf):
    labels = F.array(F.when(F.col("seq") % 3 == 0, "Casual").otherwise("?"), F.col("job_type_text"))
    types = job_types.job_type_seek(labels)
    return pst(spark, sf).select("seq", F.array_join(types, ", ").alias("types"))


@query(
    "job_type_reed",
    pst_sql("""SELECT seq, coalesce(nullif(concat_ws(', ', CASE WHEN seq % 5 = 1 THEN 'parttime' END,
        CASE WHEN seq % 4 = 0 THEN 'fulltime' WHEN seq % 4 = 1 THEN 'contract' END), ''), 'none') AS types,
      coalesce(nullif(concat_ws(', ', CASE WHEN seq % 2 = 0 THEN 'fulltime' END, CASE WHEN seq % 3 = 0 THEN 'parttime' END,
        CASE WHEN seq % 5 = 0 THEN 'contract' END, CASE WHEN seq % 7 = 0 THEN 'temporary' END), ''), 'none') AS found FROM pst"""),
)
def job_type_reed(spark, sf):
    contract = (
        F.when(F.col("seq") % 4 == 0, "Permanent").when(F.col("seq") % 4 == 1, "contract ")
    )
    detail = job_types.job_type_reed_details(F.col("job_type_text"), contract)
    search = job_types.job_type_reed_search(*[F.col("seq") % m == 0 for m in (2, 3, 5, 7)])
    df = pst(spark, sf)
    return _listed(df.withColumn("s", search), detail, "seq", "s").select(
        "seq", "types",
        F.when(F.size("s") == 0, "none").otherwise(F.array_join("s", ", ")).alias("found"),
    )


@query(
    "job_type_irish",
    pst_sql("""SELECT seq, nullif(concat_ws(', ', CASE WHEN contains(t, 'full') AND contains(t, 'time') THEN 'fulltime' END,
      CASE WHEN contains(t, 'part') AND contains(t, 'time') THEN 'parttime' END, CASE WHEN contains(t, 'contract') THEN 'contract' END,
      CASE WHEN contains(t, 'temp') THEN 'temporary' END, CASE WHEN contains(t, 'intern') THEN 'internship' END,
      CASE WHEN contains(t, 'permanent') THEN 'fulltime' END), '') AS types
      FROM (SELECT seq, lower(concat_ws(' ', job_type_text, title, CASE WHEN seq % 6 = 0 THEN 'Permanent' END)) AS t FROM pst)"""),
)
def job_type_irish(spark, sf):
    label = F.concat_ws(" ", "job_type_text", "title", F.when(F.col("seq") % 6 == 0, "Permanent"))
    types = job_types.job_type_irish(label)
    return pst(spark, sf).select("seq", F.array_join(types, ", ").alias("types"))


# ---- text -------------------------------------------------------------------------------------


@query(
    "extract_emails",
    f"SELECT doc_id, array_to_string(regexp_extract_all(text, '{EMAIL}'), ', ') AS emails FROM documents WHERE length(text) > 0",
)
def extract_emails(spark, sf):
    docs = table(spark, sf, "documents").where(F.length("text") > 0)
    return docs.select(
        "doc_id", F.array_join(text.extract_emails(F.col("text")), ", ").alias("emails")
    )


_WS = r"[\s\x0B\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


@query(
    "slugify",
    f"""SELECT doc_id, regexp_replace(regexp_replace(trim(regexp_replace(lower(text), '^{_WS}+|{_WS}+$', '', 'g')), '[^a-z0-9\\s\\x0B-]', '', 'g'), '[\\s\\x0B]+', '-', 'g') AS slug FROM documents""",
)
def slugify(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.slugify(F.col("text")).alias("slug"))


@query(
    "title_case",
    """SELECT p_partkey, array_to_string([upper(substr(r, 1, 1)) || lower(substr(r, 2)) FOR r IN regexp_extract_all(t, '\\p{L}+|[^\\p{L}]+')], '') AS t
      FROM (SELECT p_partkey, p_name || '-o''' || p_name || ' 3rd' AS t FROM part)""",
)
def title_case(spark, sf):
    name = F.concat("p_name", F.lit("-o'"), "p_name", F.lit(" 3rd"))
    return table(spark, sf, "part").select("p_partkey", text.title_case(name).alias("t"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))"


@query(
    "url_parts",
    f"""SELECT page_id, {_HOST} AS host, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin,
      regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages""",
)
def url_parts(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.host(u).alias("host"), urls.origin(u).alias("origin"), urls.path(u).alias("path")
    )


_TLD2 = ", ".join(f"'{t}'" for t in TWO_PART_TLDS)


@query(
    "parent_domain",
    f"""SELECT page_id, CASE WHEN len(p) > 2 THEN CASE WHEN p[-2] || '.' || p[-1] IN ({_TLD2})
        THEN CASE WHEN len(p) > 3 THEN p[-3] || '.' || p[-2] || '.' || p[-1] END ELSE p[-2] || '.' || p[-1] END END AS parent
      FROM (SELECT page_id, string_split({_HOST} || CASE page_id % 3 WHEN 0 THEN '.co.uk' ELSE '' END, '.') AS p FROM pages)""",
)
def parent_domain(spark, sf):
    name = F.concat(urls.host(F.col("url")), F.when(F.col("page_id") % 3 == 0, ".co.uk").otherwise(""))
    return table(spark, sf, "pages").select("page_id", urls.parent_domain(name).alias("parent"))


@query(
    "strip_query",
    "SELECT page_id, regexp_replace(url, '\\?[^#]*', '') AS bare, regexp_extract(url, '/([0-9]+)[^/]*/?$', 1) AS n FROM pages",
)
def strip_query(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.strip_query(u).alias("bare"),
        F.regexp_extract(urls.path(u), "/([0-9]+)[^/]*/?$", 1).alias("n"),
    )


@query(
    "unquote_direct_url",
    pst_sql("SELECT seq, job_url AS target FROM pst"),
)
def unquote_direct_url(spark, sf):
    """The URL, percent-encoded into a redirect comment and read back."""
    code = F.concat(
        F.lit('<!--"https://x.test/redir?url='),
        F.replace(F.url_encode("job_url"), F.lit("+"), F.lit("%20")), F.lit('"-->'),
    )
    return pst(spark, sf).select("seq", urls.unquote_direct_url(code).alias("target"))


@query(
    "id_from_url",
    pst_sql("""SELECT seq, CASE seq % 3 WHEN 0 THEN CAST(seq AS VARCHAR) WHEN 1 THEN CAST(seq AS VARCHAR) ELSE 'c' || CAST(seq AS VARCHAR) END AS id,
      'role' AS last FROM pst"""),
)
def id_from_url(spark, sf):
    k = F.col("seq").cast("string")
    url = (
        F.when(F.col("seq") % 3 == 0, F.concat(F.lit("https://a.test/d.asp?jobid="), k, F.lit("&ln=1")))
        .when(F.col("seq") % 3 == 1, F.concat(F.lit("/dev-role-job"), k))
        .otherwise(F.concat(F.lit("https://b.test/apply/c"), k, F.lit("/role")))
    )
    return pst(spark, sf).select(
        "seq", urls.id_from_url(url).alias("id"),
        urls.apply_code(F.lit("https://b.test/jobs/role/")).alias("last"),
    )


@query(
    "absolute_url",
    """SELECT page_id, origin || '/a/b' AS rooted, origin || folder || 'c.html' AS bare,
      origin || regexp_replace(folder, '[^/]+/$', '') || 'd?e/../f' AS up, origin || path || '?q=1' AS query,
      origin || folder || 'x/z/' AS dots, CAST(NULL AS VARCHAR) AS mail, 'https://A.test/B' AS shouted,
      split_part(url, '//', 1) || '//cdn.test/x' AS scheme, url AS kept FROM (SELECT page_id, url, origin, path,
        coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') AS folder FROM (SELECT page_id, url,
        regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages))""",
)
def absolute_url(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.absolute_url(F.lit("/a/b"), u).alias("rooted"),
        urls.absolute_url(F.lit(" c.html "), u).alias("bare"),
        urls.absolute_url(F.lit("../d?e/../f"), u).alias("up"),
        urls.absolute_url(F.lit("?q=1"), u).alias("query"),
        urls.absolute_url(F.lit("./x/y/../z/."), u).alias("dots"),
        urls.absolute_url(F.lit("mailto:hr@a.test"), u).alias("mail"),
        urls.absolute_url(F.lit("HTTPS://A.test/B"), u).alias("shouted"),
        urls.absolute_url(F.lit("//cdn.test/x"), u).alias("scheme"),
        urls.absolute_url(u, F.lit("https://other.test/")).alias("kept"),
    )
