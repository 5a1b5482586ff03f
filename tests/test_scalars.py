"""Hand-derived cases of the scalar rules."""

from datetime import date

from pyspark.sql import functions as F

from vacancia.functions import country, dates, job_types, locations, markdown, markup, remote, salary, social, text, urls
from vacancia.schema import compensation, location

D = date(2024, 2, 15)


def today():
    return F.lit("2024-02-15").cast("date")


def pay(row):
    return None if row is None else (row["interval"], row["min_amount"], row["max_amount"], row["currency"])


def place(row):
    return None if row is None else (row["city"], row["state"], row["country"])


def test_extract_salary(values):
    cases = {
        "$50k - $80k": ("yearly", 50000, 80000, "USD"),
        "$25.50–$30/hr": ("hourly", 25, 30, "USD"),
        "$120,000 - 150,000": ("yearly", 120000, 150000, "USD"),
        "$90-110K": ("yearly", 90000, 110000, "USD"),
        "$2,500 - $3,500 monthly": ("monthly", 2500, 3500, "USD"),
        "$100\xa0-\xa0$200": ("hourly", 100, 200, "USD"),
        "$100 - $400": None,
        "$5000 - $40000": None,
        "$80,000 - $80,000": None,
        "$400,000 - $800,000": None,
        "$0.4 - $0.9": None,
        "$300 - $340": None,
        "$1,000,000 - $2,000,000": None,
        "no pay": None,
        "": None,
    }
    found = values(salary.extract_salary, *cases)
    assert [pay(r) for r in found] == list(cases.values())


def test_extract_salary_annual_keeps_the_interval(values):
    found = values(lambda c: salary.extract_salary(c, annual=True), "$25.50 - $30/hr", "$2,500 - $3,500")
    assert [pay(r) for r in found] == [("hourly", 52000, 62400, "USD"), ("monthly", 30000, 42000, "USD")]


def test_parse_currency_number(values):
    found = values(
        salary.parse_currency_number, "$1,234.50", "€50.000,75", "$75,000", "$75,000.00/yr", "£9.5", "12,5", "x", None
    )
    assert found == [1234.5, 50000.75, 75000.0, 75000.0, 9.5, 12.5, None, None]


def test_linkedin_salary(values):
    found = values(salary.linkedin_salary, " $50,000.00 - $70,000.00 ", "€1.000 - €2.000", "$50,000")
    assert [pay(r) for r in found] == [(None, 50000, 70000, "USD"), (None, 1000, 2000, "€"), None]


def test_indian_salary(values):
    found = values(salary.indian_salary, "12-16 Lacs P.A.", "1-2.5 Cr", "3 - 4 LAKH", "Not disclosed", "Upto 5 Lacs", None)
    assert [pay(r) for r in found] == [
        (None, 1200000, 1600000, "INR"), (None, 10000000, 25000000, "INR"), (None, 300000, 400000, "INR"), None, None, None
    ]


def test_seek_salary(values):
    found = values(
        salary.seek_salary, "$80,000 - $100,000 per year", "NZ$35 per hour", "$80k - $100k", "Competitive, great team", "$400 daily"
    )
    assert [pay(r) for r in found] == [
        ("yearly", 80000, 100000, "AUD"), ("hourly", 35, 35, "NZD"), ("yearly", 80, 100, "AUD"), None, ("daily", 400, 400, "AUD")
    ]


def test_irish_salary(values):
    found = values(
        salary.irish_salary, "€50,000 - €70,000 per annum", "€30 - €45 per hour", "€50,000+", "Competitive, DOE", "Negotiable", "€900 p/w"
    )
    assert [pay(r) for r in found] == [
        ("yearly", 50000, 70000, "EUR"), ("hourly", 30, 45, "EUR"), ("yearly", 50000, 50000, "EUR"), None, None, ("weekly", 900, 900, "EUR")
    ]


def test_reed_salary_search(values):
    found = values(salary.reed_salary_search, (20.0, 30.0), (500.0, None), (30000.0, 40000.0), (0.0, 0.0), kind="double")
    assert [pay(r) for r in found] == [
        ("hourly", 20, 30, "GBP"), ("daily", 500, None, "GBP"), ("yearly", 30000, 40000, "GBP"), None
    ]


def test_annualize(spark):
    rows = [("hourly", 25.0, 30.0), ("weekly", 1000.0, 1200.0), ("daily", 100.0, 200.0), ("monthly", 1000.0, 2000.0), ("hourly", 0.0, 30.0), ("yearly", 1.0, 2.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a string, b double, c double")
    once = df.select(salary.annualize(compensation(F.col("a"), F.col("b"), F.col("c"), F.lit("USD"))).alias("x"))
    twice = once.select(salary.annualize(F.col("x")).alias("x"))
    expected = [
        ("yearly", 52000, 62400, "USD"), ("yearly", 52000, 62400, "USD"), ("yearly", 26000, 52000, "USD"), ("yearly", 12000, 24000, "USD"),
        ("hourly", 0, 30, "USD"), ("yearly", 1, 2, "USD"), (None, 1, 2, "USD"),
    ]
    assert [pay(r["x"]) for r in once.collect()] == expected
    assert [pay(r["x"]) for r in twice.collect()] == expected


def test_iso_date(values):
    found = values(
        dates.iso_date, "2024-01-15T23:30:00-05:00", "2024-01-15T10:30:00Z", "2024-01-15", "20240115", "soon", "2024-13-01", "2024-01-15T25:00", "", None
    )
    assert found == [date(2024, 1, 15)] * 4 + [None] * 5


def test_days_ago_number(values):
    found = values(lambda c: dates.days_ago_number(c, today()), "5 hours ago", "yesterday", "99999999999 days")
    assert found == [date(2024, 2, 10), None, None]


def test_naukri_label_date(values):
    found = values(
        lambda c: dates.naukri_label_date(c, F.lit(1705312800000), today()), "3 Days Ago", "30+ Days Ago", "Few Hours Ago", None, "", "?"
    )
    assert found == [date(2024, 2, 12), None, D] + [date(2024, 1, 15)] * 3


def test_irish_relative_date(values):
    found = values(
        lambda c: dates.irish_relative_date(c, today()),
        "Posted 2 days ago", "Posted yesterday", "1 hour ago", "3 weeks ago", "2 months ago", "15 Jan 2024", "2024-01-03", "January 3, 2024", "junk",
    )
    assert found == [
        date(2024, 2, 13), date(2024, 2, 14), D, date(2024, 1, 25), date(2023, 12, 17), date(2024, 1, 15), date(2024, 1, 3), date(2024, 1, 3), None
    ]


def test_social_relative_date(values):
    found = values(lambda c: dates.social_relative_date(c, today()), "3d", "1w • Edited", "2mo", "3 m", "5 ч.", "2 нед.", "1yr", "x")
    assert found == [
        date(2024, 2, 12), date(2024, 2, 8), date(2023, 12, 17), date(2023, 11, 17), D, date(2024, 2, 1), None, None
    ]


def test_deadline_date(values):
    found = values(
        dates.deadline_date, "Deadline: 15 Jan 2024", "15-Jan-2024", "January 15, 2024", "15/01/2024", "15 january 2024", "2024.01.15"
    )
    assert found == [date(2024, 1, 15)] * 5 + [None]


def test_location_rules(values):
    def run(fn, *texts):
        return [place(r) for r in values(fn, *texts)]

    assert run(locations.loc_greenhouse, "San Francisco, CA", "London, UK", "Berlin, Germany", "Paris, IDF, France") == [
        ("San Francisco", "CA", None), ("London", "UK", None), ("Berlin", None, "Germany"), ("Paris", "IDF", "France")
    ]
    assert run(locations.loc_lever, "London, GBR", "Berlin, Germany", "Berlin") == [
        ("London", "GBR", None), ("Berlin", None, "Germany"), ("Berlin", None, None)
    ]
    assert run(locations.loc_ashby_bamboo, "Berlin, BE, Germany") == [("Berlin", None, "Germany")]
    assert run(locations.loc_jazzhr, "Remote, ITPL Bangalore, India", "(Hybrid), Manila", "Remote") == [
        ("ITPL Bangalore", None, "India"), ("Manila", None, None), (None, None, None)
    ]
    assert run(lambda c: locations.loc_first_comma(c, "australia"), "Sydney CBD, Inner West & Eastern Suburbs") == [
        ("Sydney CBD", "Inner West & Eastern Suburbs", "australia")
    ]
    assert run(locations.loc_google, "Austin, TX, USA, x", "Austin") == [("Austin", "TX", "USA"), ("Austin", None, None)]
    assert run(locations.loc_glassdoor, "Austin, TX", "Austin", "Remote", "") == [("Austin", "TX", None), ("Austin", "", None), None, None]
    assert run(lambda c: locations.loc_linkedin(c, "usa"), "Cork, Munster", "Cork, Munster, Ireland", "Cork") == [
        ("Cork", "Munster", "usa"), ("Cork", "Munster", "ireland"), (None, None, "usa")
    ]


def test_display_location(spark):
    rows = [
        ("Arlington", "VA", "usa", False, "Arlington, VA, USA"), ("London", None, "uk", False, "London, UK"),
        ("Prague", None, "czech republic", False, "Prague, Czech Republic"), ("Istanbul", None, "türkiye", False, "Istanbul, Türkiye"),
        ("Toronto", "ON", "usa/ca", False, "Toronto, ON"), (None, None, "worldwide", False, ""), ("Paris", "", "FR", True, "Paris, FR"),
    ]
    df = spark.createDataFrame(rows, "city string, state string, country string, free boolean, want string")
    spot = F.when(F.col("free"), location(F.col("city"), F.col("state"), F.col("country"), True)).otherwise(
        location(F.col("city"), F.col("state"), F.col("country"))
    )
    for row in df.select(locations.display_location(spot).alias("got"), "want").collect():
        assert row["got"] == row["want"]
    assert df.select(locations.display_location(locations.null_location()).alias("x")).first()["x"] is None


def test_country_of(values):
    assert values(locations.country_of, " United States", "CZECHIA", "turkey", "atlantis") == ["usa", "czech republic", "türkiye", None]


def test_detect_country(values):
    cases = {
        "🇩🇪 hiring in London": "DE", "🇸🇪🇩🇪": "DE", "based in Dublin": "IE", "call +44 20 7946 0000": "GB", "call +353 1 555": "IE", "call +1 415 555": None,
        "£60k": "GB", "€60k": None, "see https://t.co/abc": None, "apply at https://acme.co.uk/jobs": "GB", "x MÜNCHEN y": "DE", "Engineering": None,
        "besieged": None, "pay in SEK": "SE", "a.information": None, "south korea or korea": "KR", "New Delhi": "IN",
    }
    assert values(country.detect_country, *cases) == list(cases.values())
    with_profile = values(lambda t, p: country.detect_country(t, p), ("nothing", "Paris"), ("Rome", "Paris"), ("x", "+44 1"))
    assert with_profile == ["FR", "IT", None]
    assert values(lambda t, p: country.detect_country(t, None, p), ("Rome", "us"), ("Rome", "xyz")) == ["US", "IT"]


def test_job_types(values):
    assert values(job_types.extract_job_type, "Full time or contractor", "full-time", "", None, "INTERNSHIP") == [
        ["fulltime", "contract"], None, [], [], ["internship"]
    ]
    assert values(job_types.job_type_irish, "Full Time, Permanent", "International", "Other", None) == [
        ["fulltime", "fulltime"], ["internship"], None, None
    ]
    assert values(job_types.normalize_job_type, "Full-Time", "part_time", "Vollzeit", "?") == ["fulltime", "parttime", "fulltime", None]


def test_remote(values):
    assert values(remote.remote_keywords3, "WFH ok", "on site") == [True, False]
    assert values(remote.remote_irish, "remotely", "Remote!") == [False, True]
    assert values(remote.remote_tweet, "from anywhere", "office") == [True, None]
    assert values(remote.remote_post, "from anywhere", "work-from-home") == [None, True]
    assert values(remote.work_from_home_type, ("Hybrid - Pune", "x", None), ("x", "Remote dev", None), ("x", "y", "z")) == [
        "Hybrid", "Remote", "Work from office"
    ]


def test_social_fields(values):
    assert values(
        social.tweet_title, "Now hiring: Senior PHP Developer #php", "Backend Engineer needed in our team", "#hiring Data Analyst", "Role: QA",
        "#jobs @you 🚀 a longer first line",
    ) == ["Senior PHP Developer", "Backend Engineer", "Data Analyst", None, "jobs @you 🚀 a longer first line"]
    assert values(social.post_title, "HIRING: PHP Developer – $50–120/hour", "🚀 Senior PHP Developer needed", "**Вакансия:** Инженер данных\nтекст") == [
        "PHP Developer – $50–120/hour", "Senior PHP Developer needed", "Инженер данных"
    ]
    assert values(lambda c: social.tweet_company(c, F.lit("me")), "We grow, join Acme Corp! today", "working at Foo #x", "none") == [
        "Acme Corp", "Foo", "me"
    ]
    assert values(lambda a, b: social.post_company(a, F.lit("me"), b), ("join Foo!", "Lead at Bar | x"), ("join Foo!", "Lead")) == ["Bar", "Foo"]
    assert values(social.tweet_location, "📍 Berlin #de", "based in Cork | x", "none") == ["Berlin", "Cork", None]


def test_links(spark):
    df = spark.sql(
        "SELECT array(named_struct('href','https://t.co/a','text','x.com/me'), named_struct('href','https://t.co/b','text','netflix.com/jobs/1'), "
        "named_struct('href','https://t.co/c','text','read')) AS links"
    )
    row = df.select(social.resolve_links(F.col("links")).alias("u")).select("u", social.external_link(F.col("u"), F.lit("own")).alias("e")).first()
    assert row["u"] == ["https://x.com/me", "https://netflix.com/jobs/1", "https://t.co/c"]
    assert row["e"] == "https://netflix.com/jobs/1"


def test_text(values):
    assert values(text.extract_emails, "hr@x.com, a.b@c.org", "none", "", None) == [["hr@x.com", "a.b@c.org"], [], None, None]
    assert values(text.slugify, "Software Engineer (C++)") == ["software-engineer-c"]
    assert values(text.title_case, "a-b o'neil", "3rd ÉTÉ") == ["A-B O'Neil", "3Rd Été"]
    assert values(text.industry_cleanup, "IT_servicesIv1", "") == ["It Services", None]
    assert values(text.html_to_text, "<p>a &amp; b&#8217;s &copy; &euro; &amp;lt;</p><script>x<y</script>b<!-- c -->", "<a title='>'>t</a>") == [
        "a & b’s © € &lt; b", "t"
    ]
    assert values(text.strip_attributes, '<div class="a>" id=b><p x=1>q</p></div>', "<br/>", "<p>x</p>") == ["<div><p x=1>q</p></div>", "<br/>", "<p>x</p>"]


def test_any_of_prefers_the_longest():
    import re

    pattern = re.compile(text.any_of(["co", "co.uk", "com", "c"]))
    assert [pattern.match(t).group() for t in ("co.uk", "comx", "cox", "cx")] == ["co.uk", "com", "co", "c"]


def test_urls(values):
    assert values(urls.normalized_url, "https://a.com/jobs/x/", "https://a.com/jobs/x/?p=1", "https://a.com/x#y?z") == [
        "https://a.com/jobs/x", "https://a.com/jobs/x/", "https://a.com/x"
    ]
    assert values(urls.title_from_slug, "https://a.com/careers/senior-data-engineer/12345", "https://a.com/x/dev_79ddaec9-d32b-46c5-822b-f439074d896c") == [
        "Senior Data Engineer", "Dev"
    ]
    assert values(urls.parent_domain, "jobs.netflix.com", "jobs.example.co.uk", "example.co.uk", "a.com") == ["netflix.com", "example.co.uk", None, None]
    assert values(urls.detect_platform, "https://acme.bamboohr.com/careers", "https://jobs.lever.co/acme", "https://bamboohr.com", "nonsense") == [
        "bamboohr", "lever", "custom", "custom"
    ]
    assert values(
        lambda u: urls.career_slug(u, urls.detect_platform(u)),
        "https://boards.greenhouse.io/embed/job_board/js?for=acme", "https://boards-api.greenhouse.io/v1/boards/acme/jobs", "https://acme.applytojob.com/apply",
        "https://jobs.lever.co/acme/123", "https://example.com/jobs/here/",
    ) == ["acme", "acme", "acme", "acme", "here"]
    assert values(urls.host, "https://u:p@Jobs.Example.com:80/x", "//c.test/x", "/x") == ["jobs.example.com", "c.test", None]
    assert values(urls.unquote_direct_url, 'x?url=https%3A%2F%2Fa.b%2Fc+d"', "none") == ["https://a.b/c+d", None]
    assert values(urls.is_loose_title, "QA", "Remote", "Data Analyst", "Principal-Staff-Engineer", "Engineer") == [False, False, True, True, False]


def test_html_scan():
    stops, parents, tags, attrs, texts, _, _ = markup.scan_html(
        "<p>un<br>closed<p>two</x><script>a<b</script><div/>t &amp; u<i title='a>b' don't>x</i>"
    )
    assert tags == ["p", "#text", "br", "#text", "p", "#text", "script", "div", "#text", "i", "#text"]
    assert stops[0] == len(tags) and parents[4] == 0
    assert texts[6] == "a<b" and texts[8] == "t & u" and attrs[9]["title"] == "a>b" and texts[10] == "x"


def test_page_links(values):
    html = "<a class=x href='/a?x=1&amp;y=2'> A <b>b</b></a><!-- <a href=/no>n</a> --><a href=/c>c</a><a name=z>no</a>"
    found = values(markup.page_links, html)[0]
    assert [(r["href"], r["text"]) for r in found] == [("/a?x=1&y=2", "A b"), ("/c", "c")]


def test_markdown():
    md = markdown.to_markdown
    assert md("<h2>Title</h2><p>a <b>bold</b> x<br>y</p>") == "Title\n-----\n\na **bold** x  \ny"
    assert md("<ul><li>one</li><li>two<ul><li>in</li></ul></li></ul>") == "* one\n* two\n  + in"
    assert md("<ol><li>q</li><li>r</li></ol><h3>t</h3>text") == "1. q\n2. r\n\n### t\n\ntext"
    assert md("<li>x</li>") == "- x"
    assert md('<a href="https://x.y">https://x.y</a> <a href="/z">z</a>') == "<https://x.y> [z](/z)"
    assert md("<blockquote><p>q</p></blockquote><pre>a\n b</pre>") == "> q\n\n```\na\n b\n```"
    assert md("a * b_c") == "a \\* b\\_c"
    assert md("<p> </p><script>no</script>") == ""
    assert md("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>") == "| a | b |\n| --- | --- |\n| 1 | 2 |"


def test_markdown_shortcut_agrees_with_the_converter(values):
    samples = ["plain text, $5", " trimmed ", "a & b", "line\nbreak", "two  blanks", "x_y*z", "<b>k</b>", "", None]
    assert values(markdown.markdown, *samples) == [None if t is None else markdown.to_markdown(t) for t in samples]


def test_links_resolve_as_in_a_browser(values):
    cases = [
        ("role-1", "https://a.com/x/jobs/", "https://a.com/x/jobs/role-1"), ("role-1", "https://a.com/x/jobs", "https://a.com/x/role-1"),
        ("../b", "https://a.com/", "https://a.com/b"), ("../../b?c=../d", "https://a.com/x/y/z", "https://a.com/b?c=../d"),
        ("?p=2", "https://a.com/x?p=1#f", "https://a.com/x?p=2"), ("#top", "https://a.com/x?p=1#f", "https://a.com/x?p=1#top"),
        ("", "https://a.com/x#f", "https://a.com/x"), ("/r", "https://a.com", "https://a.com/r"), ("r", "https://a.com", "https://a.com/r"),
        ("mailto:hr@a.com", "https://a.com/", None), ("javascript:void(0)", "https://a.com/", None), ("tel:+1", "https://a.com/", None),
        ("HTTP://B.com/C", "https://a.com/", "http://B.com/C"), ("//c.com/d", "https://a.com/", "https://c.com/d"),
        (" /s ", "https://a.com/x", "https://a.com/s"), ("a/..", "https://a.com/x/", "https://a.com/x/"), ("/a/./b/..", "https://a.com/", "https://a.com/a/"),
        (None, "https://a.com/", None), ("x", None, None),
    ]
    assert values(urls.absolute_url, *[c[:2] for c in cases]) == [c[2] for c in cases]
